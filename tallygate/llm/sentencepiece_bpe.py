"""SentencePiece (merge type) encoding by backtracking over longest matches, and decoding.

A merge-type tokenizer starts from single characters and joins, again and again, the
neighbours whose union has the best score. The result is the only split into pieces in which
every two neighbours, merged by themselves from their characters, give just these two pieces
again: the first merge across a border of the whole text would also be the first across that
border in the pair alone. So a text is encoded from the left by taking the longest piece that
matches and goes with the piece before it, else the next shorter one, else stepping back;
positions from which no split goes on are kept in a bitfield and not tried again.

Only the vocabulary file is read, once, on the driver; its pieces (tens of thousands) travel
with the tasks. Nothing else of the library is used for encoding or decoding.
"""

from __future__ import annotations

import hashlib
import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = "▁"
#: Segments and pairs remembered by one task before its memory is emptied.
REMEMBERED = 250_000
#: Tokens of one batch of results; a longer text is a batch of its own.
BATCH_TOKENS = 500_000
NEVER = float("-inf")
NO_IDS = np.zeros(0, np.int32)


@dataclass(frozen=True)
class Vocabulary:
    """What a model file says; ``pieces`` can be matched in texts, ``bytes`` spell the rest."""

    pieces: dict[str, tuple[int, float]]  # piece -> (id, score)
    byte_ids: list[int]
    names: list[str]  # by id, for decoding
    hidden: frozenset[int]  # control pieces: decoded as nothing
    unknown: int


def read_vocabulary(path: str) -> Vocabulary:
    """From a SentencePiece model of the merge type with byte fallback and no normalization."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, byte_ids, hidden = {}, [0] * 256, set()
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte_ids[int(name[3:5], 16)] = i
        elif model.is_control(i):
            hidden.add(i)
        elif not model.is_unknown(i):
            pieces[name] = (i, model.get_score(i))
    return Vocabulary(pieces, byte_ids, names, frozenset(hidden), model.unk_id())


@dataclass
class Encoder:
    """Ids of texts, and texts of ids."""

    vocabulary: Vocabulary
    known: dict = field(default_factory=dict)  # segment -> (ids as text, count, decoded bytes)
    pairs: dict = field(default_factory=dict)

    def __post_init__(self):
        vocabulary, pieces = self.vocabulary, self.vocabulary.pieces
        self.automaton = ahocorasick.Automaton()
        for piece in pieces:
            self.automaton.add_word(piece, len(piece))
        self.automaton.make_automaton()
        self.reach = max(map(len, pieces))
        self.spelled = [name.replace(SPACE, " ").encode() for name in vocabulary.names]
        for value, i in enumerate(vocabulary.byte_ids):
            self.spelled[i] = bytes([value])
        for i in vocabulary.hidden:
            self.spelled[i] = b""
        self.spelled[vocabulary.unknown] = " ⁇ ".encode()
        self.scores = {piece: score for piece, (_, score) in pieces.items()}
        # All pieces that match at a place are beginnings of the longest one there.
        self.shorter = {
            piece: next((piece[:n] for n in range(len(piece) - 1, 0, -1) if piece[:n] in pieces),
                        piece[0] if len(piece) > 1 else None)
            for piece in pieces
        }
        self.entries = {piece: self._entry([i]) for piece, (i, _) in pieces.items()}
        self._find_cuts()

    def _find_cuts(self) -> None:
        """Where a text can be cut because no piece lies across.

        Neighbouring characters that no piece contains are never merged. Where the
        vocabulary allows it, cuts are made before spaces, around line ends, and between
        ASCII punctuation and anything but a space before it. Texts with one of the few
        characters that some piece joins to such a sign are only cut at spaces and lines.
        """
        joined = {p[i : i + 2] for p in self.vocabulary.pieces for i in range(len(p) - 1)}
        if any(b == SPACE and a != SPACE for a, b in joined):
            self.segments = self.coarse = re.compile("(?s:.+)").findall
            self.bridged = re.compile("(?!)").search
            return
        signs = set(string.punctuation)
        bridges = {
            c
            for a, b in joined
            if SPACE not in a + b and (a in signs) != (b in signs)
            for c in (a, b)
            if c not in signs
        }
        line = "" if any("\n" in pair for pair in joined) else "\n"
        lines, marked = f"{line}+|" if line else "", re.escape(string.punctuation)
        self.coarse = re.compile(f" *[^ {line}]+|{lines} +").findall
        word, run = f" *[^ {line}{marked}]+", f" *[{marked}]+"
        self.segments = re.compile(f"{word}|{run}|{lines} +").findall
        bridging = f"[{re.escape(''.join(sorted(bridges)))}]" if bridges else "(?!)"
        self.bridged = re.compile(bridging).search

    # --- Encoding -----------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """Segments that can be encoded one by one; together a space and the text.

        Spaces stand for the mark that takes their place, which itself counts as a space.
        """
        if not text:
            return []
        find = self.coarse if self.bridged(text) else self.segments
        return find(" " + (text.replace(SPACE, " ") if SPACE in text else text))

    def look_up(self, segment: str) -> tuple[bytes, int, bytes]:
        """Ids as text, their number, and the decoded bytes of one segment."""
        found = self.known.get(segment)
        if found is None:
            entries = self.entries
            pieces = self.pieces_of(segment.replace(" ", SPACE))
            own = [entries.get(piece) or self._spelled_out(piece) for piece in pieces]
            if len(own) == 1:
                found = own[0]
            else:
                digits, counts, spelled = zip(*own)
                found = (b",".join(digits), sum(counts), b"".join(spelled))
            if len(segment) < 200:
                if len(self.known) > REMEMBERED:
                    self.known.clear()
                self.known[segment] = found
        return found

    def _entry(self, ids: list[int]) -> tuple[bytes, int, bytes]:
        return (
            b",".join([b"%d" % i for i in ids]),
            len(ids),
            b"".join([self.spelled[i] for i in ids]),
        )

    def _spelled_out(self, character: str) -> tuple[bytes, int, bytes]:
        """A character without a piece: a byte piece for each of its bytes."""
        return self._entry([self.vocabulary.byte_ids[b] for b in character.encode()])

    def longest(self, text: str, at: int) -> str:
        """The longest piece that matches at a position, or the character there.

        The search ends where the longest of all pieces would: it must not run on, through
        characters that no piece has, to a match far away.
        """
        for last, length in self.automaton.iter_long(text, at, min(at + self.reach, len(text))):
            if last - length + 1 == at:
                return text[at : last + 1]
            break
        return text[at]

    def pieces_of(self, text: str) -> list[str]:
        """The split of ``text`` into pieces (and single characters that have none)."""
        size, go_on, shorter = len(text), self.go, self.shorter
        failed = bytearray(size + 1)  # positions from which no split goes on
        taken: list[str] = []
        at, before = 0, None
        piece: str | None = self.longest(text, 0) if text else None
        while at < size:
            while piece and (
                failed[at + len(piece)] or before is not None and not go_on(before, piece)
            ):
                piece = shorter.get(piece)
            if piece:
                taken.append(piece)
                at += len(piece)
                before = piece
                if at < size:
                    piece = self.longest(text, at)
            elif taken:
                failed[at] = 1
                last = taken.pop()
                at -= len(last)
                before = taken[-1] if taken else None
                piece = shorter.get(last)
            else:
                raise ValueError("no split; the vocabulary is not of the merge type")
        return taken

    def go(self, left: str, right: str) -> bool:
        """Whether the two, merged from their characters, come out as these two again."""
        found = self.pairs.get((left, right))
        if found is None:
            if len(self.pairs) > REMEMBERED:
                self.pairs.clear()
            found = self.pairs[left, right] = self._stay_apart(left, right)
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        """Merge both from their characters, best score first, then leftmost: do they come
        out as two, without a merge across their border?"""
        parts, border, score = [*left, *right], len(left), self.scores.get
        joins = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while joins and (best := max(joins)) > NEVER:
            at = joins.index(best)
            if at == border - 1:
                return False
            border -= at < border - 1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del joins[at]
            if at:
                joins[at - 1] = score(parts[at - 1] + parts[at], NEVER)
            if at < len(joins):
                joins[at] = score(parts[at] + parts[at + 1], NEVER)
        return len(parts) == 2

    def encode(self, text: str) -> list[int]:
        ids = b",".join([self.look_up(s)[0] for s in self.split(text)])
        return [int(i) for i in ids.split(b",")] if ids else []

    def decode(self, ids: list[int]) -> str:
        """The text of ids: without the space that encoding puts first."""
        spelled = b"".join([self.spelled[i] for i in ids])
        return spelled.removeprefix(b" ").decode("utf-8", errors="replace")


def tokens(
    docs: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row of ``docs``.

    The digests are those of the decimal ids joined by commas, and of the text that the ids
    decode to. Null counts as empty: no ids, digests of nothing. Texts are taken whole,
    segment by segment, so a very long one needs no more memory than itself and its ids.
    """
    vocabulary = read_vocabulary(model_path)

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for rows in batches:
            start = 0
            while start < rows.num_rows:
                done = _some_rows(encoder, rows.slice(start), with_ids)
                yield done
                start += done.num_rows

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(batch, schema + (", ids array<int>" if with_ids else ""))


def _some_rows(encoder: Encoder, rows: pa.RecordBatch, with_ids: bool) -> pa.RecordBatch:
    """The first rows of a batch, up to ``BATCH_TOKENS`` of them: bounds what is held at once."""
    counts, id_digests, text_digests, ids = [], [], [], []
    held = 0
    for text in rows.column(1):
        found = [encoder.look_up(s) for s in encoder.split(text.as_py() or "")]
        joined = b",".join([f[0] for f in found])
        decoded = b"".join([f[2] for f in found]).removeprefix(b" ")
        counts.append(sum([f[1] for f in found]))
        id_digests.append(hashlib.sha256(joined).hexdigest())
        text_digests.append(hashlib.sha256(decoded).hexdigest())
        if with_ids:
            spelled = joined.decode()
            ids.append(np.fromstring(spelled, np.int32, sep=",") if spelled else NO_IDS)
        held += counts[-1]
        if held > BATCH_TOKENS:
            break
    columns = {
        "doc_id": rows.column(0).slice(0, len(counts)),
        "n_tokens": pa.array(counts, pa.int64()),
        "ids_sha256": pa.array(id_digests, pa.string()),
        "decoded_sha256": pa.array(text_digests, pa.string()),
    }
    if with_ids:
        ends = np.cumsum([0, *counts], dtype=np.int32)
        columns["ids"] = pa.ListArray.from_arrays(ends, np.concatenate(ids))
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def default_model() -> str:
    """Where the public vocabulary lies that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tokens(docs, default_model(), with_ids=False)
