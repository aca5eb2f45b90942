"""Byte-level BPE encoding and decoding by Spark's higher-order functions.

Texts are cut into words by the tokenizer's own pattern. The distinct words of some millions
(``BATCH_WORDS``) are gathered into one row, as arrays of bytes, so that a word is merged once
however often it stands in them. Merging is a fold over a word's bytes: the state holds the
token ids so far and the rank of every two neighbours, each step joins the leftmost neighbours
of the lowest rank. Ranks are looked up in a literal map of two arrays (``PairRanks``), as a
lookup in Spark's own maps walks through all their keys. Decoding concatenates the binary pieces
of the ids. Documents are put together from their words inside the row; nothing is shuffled,
and nothing is broadcast but the vocabulary and a bounded number of common words, which are
merged once, by the same fold, before all others.

Words of more than ``LONG_WORD`` bytes would cost the fold the square of their length. They are
merged by a queue of neighbours instead, in the step that gathers the words.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import cut

#: Words (with repeats) whose distinct ones are merged together; bounds what a task holds.
BATCH_WORDS = 1_200_000
#: The commonest words of so many documents are merged beforehand, and not again in every
#: batch. Which ones they are changes no result.
SAMPLE_DOCUMENTS, COMMON_WORDS = 40_000, 800_000
#: Documents of one batch of results.
DOCS_AT_ONCE = 1_000
#: Bytes of the longest word that the fold merges.
LONG_WORD = 200
#: More than any array has, and short of where `slice` runs over.
MOST = 1 << 30

# --- Fixed values: white space, and what Unicode 16 added after Python's tables -----------
SPACES = r"\t-\r \x85\xA0  -     　"
UNICODE_16_LETTERS = (
    (0x1C89, 0x1C8A),
    (0xA7CB, 0xA7CD),
    (0xA7DA, 0xA7DC),
    (0x105C0, 0x105F3),
    (0x10D4A, 0x10D65),
    (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4),
    (0x11380, 0x11389),
    (0x1138B, 0x1138B),
    (0x1138E, 0x1138E),
    (0x11390, 0x113B5),
    (0x113B7, 0x113B7),
    (0x113D1, 0x113D1),
    (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0),
    (0x13460, 0x143FA),
    (0x16100, 0x1611D),
    (0x16D40, 0x16D6C),
    (0x18CFF, 0x18CFF),
    (0x1E5D0, 0x1E5ED),
    (0x1E5F0, 0x1E5F0),
)
UNICODE_16_NUMBERS = (
    (0x10D40, 0x10D49),
    (0x116D0, 0x116E3),
    (0x11BF0, 0x11BF9),
    (0x16130, 0x16139),
    (0x16D70, 0x16D79),
    (0x1CCF0, 0x1CCF9),
    (0x1E5F1, 0x1E5FA),
)


@dataclass(frozen=True)
class Vocabulary:
    """``pieces`` by id; the id of a piece is its rank."""

    pieces: tuple[bytes, ...]

    def ranks(self) -> dict[bytes, int]:
        return {piece: i for i, piece in enumerate(self.pieces)}


def read_vocabulary(path: str) -> Vocabulary:
    """From a file with a line for each piece: its bytes in base 64, and its rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(piece) for piece, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without gaps")
    vocabulary = Vocabulary(tuple(ranks[i] for i in range(len(ranks))))
    if not {bytes([b]) for b in range(256)} <= set(vocabulary.pieces):
        raise ValueError("every byte must have a piece")
    return vocabulary


class PairRanks:
    """Rank of the piece that two neighbouring pieces make, as two arrays.

    The pairs of one left piece are laid out by their right piece from ``starts[left]`` on, so
    that no two pairs share a place: ``places[starts[left] + right]`` has the left piece in its
    upper bits if the pair makes a piece, and that piece in its lower ``bits``.
    """

    def __init__(self, vocabulary: Vocabulary):
        ranks = vocabulary.ranks()
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        rights: dict[int, list[tuple[int, int]]] = {}
        for piece, rank in ranks.items():
            for cut in range(1, len(piece)):
                left, right = ranks.get(piece[:cut]), ranks.get(piece[cut:])
                if left is not None and right is not None:
                    rights.setdefault(left, []).append((right, rank))
        self.bits = len(ranks).bit_length()
        #: Stands for "these two make no piece"; more than any rank.
        self.none = 1 << self.bits
        room = 4 * sum(map(len, rights.values())) + 1
        rng = np.random.default_rng(0)
        taken = np.zeros(room + len(ranks), bool)
        self.starts = np.zeros(len(ranks), np.int64)
        #: A place that no pair is at: its upper bits are no piece's number.
        self.free = len(ranks) << self.bits
        self.places = np.full(room + len(ranks), self.free, np.int64)
        for left, found in sorted(rights.items(), key=lambda item: -len(item[1])):
            pairs, free = np.array(found), np.zeros(0, np.int64)
            while not len(free):
                tries = rng.integers(room, size=64)
                free = tries[~taken[tries[:, None] + pairs[:, 0]].any(axis=1)]
            self.starts[left] = free[0]
            taken[free[0] + pairs[:, 0]] = True
            self.places[free[0] + pairs[:, 0]] = (left << self.bits) | pairs[:, 1]

    def rank(self, left: int, right: int) -> int:
        """``none`` or more, if the two make no piece."""
        return int(self.places[self.starts[left] + right]) ^ (left << self.bits)


# --- Words ---------------------------------------------------------------------------------


def java_pattern(pattern: str) -> str:
    """The tokenizer's pattern in Java's notation, where ``\\s`` alone is ASCII only."""
    return (
        pattern.replace(r"[^\s", f"[^{SPACES}")
        .replace(r"\s", f"[{SPACES}]")
        .replace(r"\S", f"[^{SPACES}]")
    )


def _kind(character: str) -> str:
    """A character that stands for all letters, numbers or others that are not ASCII."""
    if character.isascii() or character.isspace():
        return character
    code, kind = ord(character), unicodedata.category(character)[0]
    if kind == "L" or any(a <= code <= b for a, b in UNICODE_16_LETTERS):
        return "é"
    return "²" if kind == "N" or any(a <= code <= b for a, b in UNICODE_16_NUMBERS) else "¤"


def words_of(text: str, pattern: str) -> list[str]:
    """The words of a text with characters that the JVM's Unicode tables do not know yet."""
    kinds = {c: _kind(c) for c in set(text)}
    found = regex.compile(pattern).finditer("".join([kinds[c] for c in text]))
    return [text[m.start() : m.end()] for m in found]


def merge_long(word: bytes, pairs: PairRanks) -> list[int]:
    """Ids of a long word: neighbours wait in a queue by rank, then place."""
    ids = [pairs.byte_ids[b] for b in word]
    before, after = list(range(-1, len(ids) - 1)), list(range(1, len(ids) + 1))
    queue: list[tuple[int, int, int, int]] = []

    def wait(at: int) -> None:
        if at >= 0 and after[at] < len(ids):
            left, right = ids[at], ids[after[at]]
            rank = pairs.rank(left, right)
            if rank < pairs.none:
                heapq.heappush(queue, (rank, at, left, right))

    for at in range(len(ids)):
        wait(at)
    while queue:
        rank, at, left, right = heapq.heappop(queue)
        if ids[at] != left or after[at] >= len(ids) or ids[after[at]] != right:
            continue  # one of the two has been merged with another since
        gone = after[at]
        ids[at], ids[gone], after[at] = rank, -1, after[gone]
        if after[at] < len(ids):
            before[after[at]] = at
        wait(before[at])
        wait(at)
    return [i for i in ids if i >= 0]


def _in_one_row(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _gathered(pattern: str, vocabulary: Vocabulary, common: pa.Table, batch_words: int):
    """Rows (doc_id, words, odd text) to fewer rows (words, ready, docs): distinct words as
    bytes, ids and decoded bytes of the common and the long ones, and for each document the places of its words
    in the two. ``common``: words and their ids."""
    known_words, known_ids = (c.combine_chunks() for c in common.columns)

    def row(parts: list[pa.RecordBatch], merge: Callable[[bytes], dict]) -> pa.RecordBatch:
        lists = []
        for part in parts:
            found, odd = part.column(1), part.column(2)
            if odd.null_count < len(odd):
                cut = [
                    list(w or ()) if o is None else words_of(o, pattern)
                    for w, o in zip(found.to_pylist(), odd.to_pylist())
                ]
                found = pa.array(cut, pa.list_(pa.string()))
            lists.append(found)
        sizes = np.concatenate([f.value_lengths().fill_null(0).to_numpy() for f in lists])
        words = pa.concat_arrays([f.flatten().cast(pa.binary()) for f in lists])
        coded = words.dictionary_encode()
        distinct, places = coded.dictionary, coded.indices.to_numpy()
        lengths = pc.binary_length(distinct).to_numpy()
        known = pc.index_in(distinct, value_set=known_words)
        # First come the words still to be merged, then the common ones, then the long ones.
        order = np.where(lengths > LONG_WORD, 2, known.is_valid().to_numpy(zero_copy_only=False))
        number = np.empty(len(order), np.int32)
        number[np.argsort(order, kind="stable")] = np.arange(len(order), dtype=np.int32)
        short = b"".join(distinct.filter(pa.array(order == 0)).to_pylist())
        ends = np.concatenate([[0], np.cumsum(lengths[order == 0])]).astype(np.int32)
        letters = np.frombuffer(short, np.uint8).astype(np.int32)
        long = [merge(word) for word in distinct.filter(pa.array(order == 2)).to_pylist()]
        spelled = pa.array([answer["spelled"] for answer in long], pa.binary())
        ids = pa.array([answer["ids"] for answer in long], known_ids.type)
        common = pa.array(order == 1)
        ready = pa.StructArray.from_arrays(
            [
                pa.concat_arrays([known_ids.take(known.filter(common)), ids]),
                pa.concat_arrays([distinct.filter(common), spelled]),
            ],
            names=["ids", "spelled"],
        )
        starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        docs = pa.StructArray.from_arrays(
            [
                pa.concat_arrays([part.column(0) for part in parts]),
                pa.ListArray.from_arrays(starts, pa.array(number[places])),
            ],
            names=["doc_id", "places"],
        )
        columns = {
            "words": pa.ListArray.from_arrays(ends, pa.array(letters)),
            "ready": ready,
            "docs": docs,
        }
        return pa.RecordBatch.from_arrays(
            [_in_one_row(c) for c in columns.values()], names=list(columns)
        )

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = None

        def merge(word: bytes) -> dict:
            nonlocal pairs
            pairs = pairs or PairRanks(vocabulary)  # most tasks see no long word
            ids = merge_long(word, pairs)
            return {"ids": ids, "spelled": b"".join([vocabulary.pieces[i] for i in ids])}

        held, parts = 0, []
        for batch in found:
            sizes = batch.column(1).value_lengths().fill_null(0).to_numpy()
            start = 0
            while start < batch.num_rows:
                room = int(np.searchsorted(np.cumsum(sizes[start:]), batch_words - held, "right"))
                if room == 0 and not parts:
                    room = 1  # a text of more words than that has a row of its own
                some = batch.slice(start, room)
                start += room
                if start < batch.num_rows:
                    yield row([*parts, some] if room else parts, merge)
                    held, parts = 0, []
                else:
                    # Copied, so that what waits for more does not keep its whole batch.
                    parts.append(some.take(pa.array(np.arange(room))))
                    held += int(sizes[start - room :].sum())
        if parts:
            yield row(parts, merge)

    return batches


# --- Merging, by higher-order functions ----------------------------------------------------


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _numbers(values, kind: str) -> Column:
    """A literal array, written as one string, which the optimizer turns into the array. What
    is no number there is null."""
    return F.split(F.lit(",".join(map(str, values))), ",").try_cast(f"array<{kind}>")


@dataclass(frozen=True)
class Known:
    """The vocabulary as literals, and what it takes to read them."""

    literals: Column
    bits: int

    @staticmethod
    def of(vocabulary: Vocabulary) -> Known:
        pairs, ranks = PairRanks(vocabulary), vocabulary.ranks()
        letters = [bytes([b]) for b in range(256)]
        first = [ranks.get(a + b, pairs.none) for a in letters for b in letters]
        columns = {
            "starts": _numbers(pairs.starts, "int"),
            "places": _numbers(["" if p == pairs.free else p for p in pairs.places], "bigint"),
            "byte_ids": _numbers(pairs.byte_ids, "int"),
            "byte_pairs": _numbers(first, "bigint"),
            "hex": F.split(F.lit(",".join(piece.hex() for piece in vocabulary.pieces)), ","),
        }
        return Known(F.struct(*[c.alias(name) for name, c in columns.items()]), pairs.bits)

    def bound(self, body: Callable[[Column], Column]) -> Column:
        """``body`` of the literals, which stand in the plan once for all its uses."""
        return _let(self.literals, body)


def encode(word: Column, known: Column, bits: int) -> Column:
    """Token ids of an array of bytes, by a fold of ranked merges; see ``Known``."""
    none = F.lit(1 << bits)

    def rank(left: Column, right: Column) -> Column:
        place = F.get(known["places"], F.get(known["starts"], left) + right)
        return place.bitwiseXOR(F.shiftleft(left.cast("bigint"), bits))

    def join(*parts: Column) -> Column:
        return F.flatten(F.array(*parts))

    def step(state: Column, _) -> Column:
        """The leftmost neighbours of the lowest rank become one."""
        ids, ranks = state["ids"], state["ranks"]
        lowest = F.array_min(ranks)

        def merged(at: Column) -> Column:
            piece = F.get(ranks, at - 1).cast("int")
            after = F.coalesce(rank(piece, F.get(ids, at + 1)), none.cast("bigint"))
            around = F.when(at > 1, F.array(rank(F.get(ids, at - 2), piece), after)).otherwise(
                F.array(after)
            )
            return F.struct(
                join(
                    F.slice(ids, F.lit(1), at - 1), F.array(piece), F.slice(ids, at + 2, F.lit(MOST))
                ).alias("ids"),
                join(
                    F.slice(ranks, F.lit(1), F.greatest(at - 2, F.lit(0))),
                    around,
                    F.slice(ranks, at + 2, F.lit(MOST)),
                ).alias("ranks"),
            )

        place = F.array_position(ranks, lowest).cast("int")
        return F.when(lowest < none, _let(place, merged)).otherwise(state)

    next_byte = F.slice(word, F.lit(2), F.lit(MOST))
    first = F.struct(
        F.transform(word, lambda b: F.get(known["byte_ids"], b)).alias("ids"),
        F.zip_with(word, next_byte, lambda a, b: F.get(known["byte_pairs"], a * 256 + b)).alias(
            "ranks"
        ),
    )
    return F.aggregate(word, first, step, lambda state: state["ids"])


def decode(ids: Column, known: Column) -> Column:
    """The bytes of token ids: their pieces, one after the other."""
    return F.aggregate(
        ids, F.lit(b""), lambda done, i: F.concat(done, F.unhex(F.get(known["hex"], i)))
    )


# --- Documents -----------------------------------------------------------------------------


def _put_together(with_ids: bool):
    """Rows (merged, ready, docs) to a row for each document."""

    def some(docs: list, pieces: np.ndarray, spelled: np.ndarray, kind: pa.DataType):
        joined = [b"".join(pieces[places].tolist()) for _, places in docs]
        columns = {
            "doc_id": pa.array([i for i, _ in docs], kind),
            "n_tokens": pa.array([len(j) // 4 for j in joined], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(j).hexdigest() for j in joined]),
            "decoded_sha256": pa.array(
                [
                    hashlib.sha256(b"".join(spelled[places].tolist())).hexdigest()
                    for _, places in docs
                ]
            ),
        }
        if with_ids:
            columns["ids"] = pa.array(
                [np.frombuffer(j, "<u4").astype(np.int32) for j in joined], pa.list_(pa.int32())
            )
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            for at in range(batch.num_rows):
                merged, ready, docs = (c.slice(at, 1).flatten() for c in batch.columns)
                answers = zip(merged.flatten(), ready.flatten())
                found, spelled = (pa.concat_arrays(both) for both in answers)
                ids = found.flatten().to_numpy().astype("<u4").tobytes()
                ends = 4 * np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
                pieces = np.empty(len(found), object)
                pieces[:] = [ids[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                spelled = spelled.to_numpy(zero_copy_only=False)
                keys, places = docs.flatten()
                for start in range(0, len(docs), DOCS_AT_ONCE):
                    part = list(
                        zip(
                            keys.slice(start, DOCS_AT_ONCE).to_pylist(),
                            [p.values.to_numpy() for p in places.slice(start, DOCS_AT_ONCE)],
                        )
                    )
                    yield some(part, pieces, spelled, keys.type)

    return batches


def _common(texts: DataFrame, known: Known, most: int) -> pa.Table:
    """(word, ids) of the commonest words in some documents, at most ``most``, whose ids decode
    to them, as all do."""
    words = (
        texts.select(F.explode("words").alias("word"))
        .select(F.col("word").cast("binary"))
        .where(F.length("word") <= LONG_WORD)
        .groupBy("word")
        .count()
        .orderBy(F.desc("count"))
        .limit(most)
    )
    # Stored first, so that the plan with the literals has a single step.
    spread = cut(words.select("word").repartition("word"))
    spelled = spread.mapInArrow(_as_bytes, "word binary, bytes array<int>")
    merged = known.bound(lambda literals: _merged(F.array("bytes"), literals, known.bits)[0])
    answers = spelled.select("word", merged.alias("m")).where("word = m.spelled")
    return answers.select("word", "m.ids").toArrow()


def _merged(words: Column, literals: Column, bits: int) -> Column:
    """(ids, spelled) of every word: its token ids, and the bytes that these decode to."""
    return F.transform(
        words,
        lambda word: _let(
            encode(word, literals, bits),
            lambda ids: F.struct(ids.alias("ids"), decode(ids, literals).alias("spelled")),
        ),
    )


def _as_bytes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        words = batch.column(0)
        lengths = pc.binary_length(words).to_numpy()
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        letters = np.frombuffer(b"".join(words.to_pylist()), np.uint8).astype(np.int32)
        spelled = pa.ListArray.from_arrays(ends, pa.array(letters))
        yield pa.RecordBatch.from_arrays([words, spelled], names=["word", "bytes"])


def tokens(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
    batch_words: int = BATCH_WORDS,
    common_words: int = COMMON_WORDS,
) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) for every row of ``docs``.

    The digests are those of the ids as little-endian unsigned 32-bit integers, and of the
    bytes that the ids decode to. Null counts as empty: no ids, digests of nothing. Every row
    is encoded by itself, whatever its id (null or there twice). Texts are taken whole; one of
    more than ``batch_words`` words has a row of words for itself.
    """
    vocabulary = read_vocabulary(vocabulary_path)
    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(text_column), F.lit(""))
    # Characters that the JVM's Unicode tables do not have are cut elsewhere.
    odd = text.rlike(r"\p{Cn}")
    words = F.regexp_extract_all(text, F.lit(java_pattern(pattern)), F.lit(0))

    def cut_up(some: DataFrame) -> DataFrame:
        return some.select(
            F.col(id_column).alias("doc_id"),
            F.when(~odd, words).alias("words"),
            F.when(odd, text).alias("odd"),
        )

    known = Known.of(vocabulary)
    share = min(1.0, SAMPLE_DOCUMENTS / max(docs.count(), 1))
    common = _common(cut_up(docs.sample(share, seed=1)), known, common_words)
    answer = "struct<ids: array<int>, spelled: binary>"
    gathered = cut_up(docs).mapInArrow(
        _gathered(pattern, vocabulary, common, batch_words),
        f"words array<array<int>>, ready array<{answer}>, "
        f"docs array<struct<doc_id: {kind}, places: array<int>>>",
    )
    merged = gathered.select(
        known.bound(lambda literals: _merged(F.col("words"), literals, known.bits)).alias("merged"),
        "ready",
        "docs",
    )
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return merged.mapInArrow(
        _put_together(with_ids), schema + (", ids array<int>" if with_ids else "")
    )


def default_vocabulary() -> tuple[str, str]:
    """Where the public vocabulary lies that the query uses, and its pattern."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op12_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return tokens(docs, *default_vocabulary(), with_ids=False)
