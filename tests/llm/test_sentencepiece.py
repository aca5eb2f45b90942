"""Encoding and decoding against the library."""

from __future__ import annotations

import hashlib
import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tables import no_documents, odd_documents, odd_texts, plain_rows

from tallygate.llm import sentencepiece_bpe as sp

sentencepiece = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sp.default_model())


@pytest.fixture(scope="module")
def encoder():
    return sp.Encoder(sp.read_vocabulary(sp.default_model()))


def test_odd_texts(encoder, library):
    for text in odd_texts():
        ids = library.encode(text or "")
        assert encoder.encode(text or "") == ids
        assert encoder.decode(ids) == library.decode(ids)


def test_texts_made_of_pieces(encoder, library):
    rng = random.Random(5)
    pieces = list(encoder.vocabulary.pieces)
    for _ in range(5000):
        text = "".join(rng.choice(pieces) for _ in range(rng.randint(1, 9)))
        assert encoder.encode(text) == library.encode(text), text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=40))
def test_any_text(encoder, library, text):
    ids = library.encode(text)
    assert encoder.encode(text) == ids
    assert encoder.decode(ids) == library.decode(ids)


def test_whole_segments_without_cuts(encoder, library):
    """The backtracking alone, over whole texts, gives the same as with cuts."""
    rng = random.Random(8)
    letters = ["a", "b", "er", "ing", sp.SPACE, sp.SPACE * 3, ".", ",", "0", "é", "☃", "\n"]
    for _ in range(500):
        marked = sp.SPACE + "".join(rng.choice(letters) for _ in range(60))
        text = marked[1:].replace(sp.SPACE, " ")
        pieces = encoder.pieces_of(marked)
        assert b",".join(
            [(encoder.entries.get(p) or encoder._spelled_out(p))[0] for p in pieces]
        ) == ",".join(map(str, library.encode(text))).encode()


def test_long_runs_take_linear_time(encoder, library):
    """Characters without a piece, alone and between ones that have some."""
    for unit in ("\U0001f9ff", "☃a", "\U0001f9ff☃bc", "аb\U0001f9ff", "ꙮ\U0001f9ffer"):
        text = unit * (100_000 // len(unit))
        started = time.perf_counter()
        ids = encoder.encode(text)
        assert time.perf_counter() - started < 3
        assert ids == library.encode(text)


def test_documents(spark, library):
    docs = odd_documents(spark)
    wanted = []
    for row in docs.collect():
        ids = library.encode(row.text or "")
        wanted.append(
            (
                row.doc_id,
                len(ids),
                hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(library.decode(ids).encode()).hexdigest(),
                ids,
            )
        )
    found = sp.tokens(docs, sp.default_model())
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert plain_rows(found) == sorted(wanted, key=str)


def test_no_documents(spark):
    assert plain_rows(sp.tokens(no_documents(spark), sp.default_model())) == []
