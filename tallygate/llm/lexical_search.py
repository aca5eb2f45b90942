"""Ranked lexical search by per-term geometric blocking: exact best documents of every item.

Documents become vectors of the items' terms. They are searched in shards, each of which one
task holds (``SHARD_POSTINGS`` bounds it). In a shard every term has a posting list, which is
clustered: documents go to the most similar of some leaders out of the same list, in a small
random projection of their vectors. A block, which is a cluster or a part of one, keeps for
every term that items ask beside the list's own the largest impact that any of its documents
has. Weighted like an item, this summary bounds the score of every document in the block, so a
block is skipped only if its bound is below the score that the last of the best documents has
by then. Lists are read from the one that can add most; once all others together can add less
than that score, no document outside the lists read can be among the best. Nothing is
approximate: clustering decides how much is skipped, not what is found.

Items are taken some hundreds at a time. Each shard gives its best documents for each item, and
the best of these are the best of all. Documents are not moved.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tallygate.llm.common import cut, lower_ascii

# --- Fixed values: terms, and the constants of the scores -----------------------------------
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: The same characters, said by what they are: Java matches that three times as fast.
SAME_TERM = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
BEST = 50
LENGTH_SHARE = 50

#: Items that are searched for in one pass over the documents.
ITEMS_AT_ONCE = 500
#: Postings of one shard.
SHARD_POSTINGS = 2_000_000
#: Documents of a block, most leaders of a list, and dimensions in which they are compared.
BLOCK, LEADERS, DIMENSIONS = 32, 256, 16
#: Rows of a list that are compared with its leaders at a time.
COMPARED = 16_384


def _cut_up(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(SAME_TERM), F.lit(0))


def terms(text: Column) -> Column:
    """The terms of a text, in order, with repeats."""
    return _cut_up(lower_ascii(text))


def weight(documents: int, holders: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holders + 1)))


# --- Vectors --------------------------------------------------------------------------------


def _counted(vocabulary: pa.Array):
    """Rows (doc_id, words) to (doc_id, n, terms, counts), terms by their number."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            # Here and not in Spark, where a filter on words would cut every text twice.
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(1)), 0))
            words = batch.column(1)
            sizes = words.value_lengths().to_numpy().astype(np.int64)
            found = pc.index_in(pc.ascii_lower(words.flatten()), value_set=vocabulary)
            held = found.is_valid().to_numpy(zero_copy_only=False)
            document = np.repeat(np.arange(len(sizes)), sizes)[held]
            key = document * len(vocabulary) + found.drop_null().to_numpy()
            key, counts = np.unique(key, return_counts=True)
            of_each = np.bincount(key // max(len(vocabulary), 1), minlength=len(sizes))
            ends = np.concatenate([[0], np.cumsum(of_each)]).astype(np.int32)
            term = (key % max(len(vocabulary), 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes),
                    pa.ListArray.from_arrays(ends, pa.array(term)),
                    pa.ListArray.from_arrays(ends, pa.array(counts.astype(np.int32))),
                ],
                names=["doc_id", "n", "terms", "counts"],
            )

    return batches


def vectors(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(doc_id, n, terms, counts) of all documents that have a term: the number of their terms,
    and which of ``vocabulary`` they have how often."""
    # Words first and small letters later, in Arrow: ``translate`` costs ten times the cutting.
    words = docs.select("doc_id", _cut_up(F.col("text")).alias("words"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return words.mapInArrow(
        _counted(pa.array(vocabulary, pa.string())),
        f"doc_id {kind}, n bigint, terms array<int>, counts array<int>",
    )


# --- Shards ---------------------------------------------------------------------------------


@dataclass
class Blocks:
    """The posting list of one term: documents block by block, and what bounds each block."""

    documents: np.ndarray
    starts: np.ndarray  # of the blocks, in ``documents``; and the end
    terms: np.ndarray  # of the summaries
    maxima: np.ndarray
    summaries: np.ndarray  # where each block's begins

    def bounds(self, weights: np.ndarray) -> np.ndarray:
        return np.add.reduceat(weights[self.terms] * self.maxima, self.summaries)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the runs that begin at ``starts``, one run after the other."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Shard:
    """Some documents and, as items come to need them, the blocks of their posting lists."""

    def __init__(self, n, sizes, terms, counts, items: list[np.ndarray], weights, documents, length):
        """``sizes``: how many of ``terms`` and ``counts`` each document has, at least one;
        ``documents`` and ``length``: N and L of the corpus."""
        self.sizes, self.terms, self.items, self.weights = sizes, terms, items, weights
        self.starts = np.cumsum(sizes) - sizes
        m = 100 - LENGTH_SHARE + (LENGTH_SHARE * n.astype(np.int64) * documents) // length
        counts = counts.astype(np.int64)
        self.impacts = (1_000_000_000 * counts) // (1000 * counts + 20 * np.repeat(m, sizes))
        by_term = np.argsort(terms, kind="stable")
        self.holders = np.repeat(np.arange(len(sizes)), sizes)[by_term]
        self.lists = np.searchsorted(terms[by_term], np.arange(len(weights) + 1))
        self.largest = np.zeros(len(weights), np.int64)
        np.maximum.at(self.largest, terms, self.impacts)
        self.asked_by: dict[int, list[int]] = {}
        for item, own in enumerate(items):
            for term in own.tolist():
                self.asked_by.setdefault(term, []).append(item)
        self.made: dict[int, Blocks] = {}
        self.projected: np.ndarray | None = None
        self.seen_blocks = self.skipped_blocks = 0

    def _directions(self) -> np.ndarray:
        """Documents as short vectors of length 1: near each other if their terms are."""
        if self.projected is None:
            axes = np.random.default_rng(1).standard_normal((DIMENSIONS, len(self.weights)))
            heavy = self.weights[self.terms] * self.impacts.astype(np.float64)
            sums = [np.add.reduceat(heavy * axis[self.terms], self.starts) for axis in axes]
            long = np.stack(sums, axis=1)
            size = np.linalg.norm(long, axis=1, keepdims=True)
            self.projected = (long / np.where(size > 0, size, 1)).astype(np.float32)
        return self.projected

    def blocks(self, term: int) -> Blocks:
        if term not in self.made:
            self.made[term] = self._clustered(term)
        return self.made[term]

    def _clustered(self, term: int) -> Blocks:
        held = self.holders[self.lists[term] : self.lists[term + 1]]
        leaders = min(-(-len(held) // BLOCK), LEADERS)
        if leaders > 1:
            place = self._directions()
            lead = place[held[np.linspace(0, len(held) - 1, leaders).astype(np.int64)]].T
            nearest = np.concatenate(
                [
                    np.argmax(place[held[at : at + COMPARED]] @ lead, axis=1)
                    for at in range(0, len(held), COMPARED)
                ]
            )
            order = np.argsort(nearest, kind="stable")
            held, nearest = held[order], nearest[order]
            first = np.concatenate([[True], nearest[1:] != nearest[:-1]])
            at = np.arange(len(held))
            in_cluster = at - np.maximum.accumulate(np.where(first, at, 0))
            first |= in_cluster % BLOCK == 0
        else:
            first = np.arange(len(held)) == 0
        block = np.cumsum(first) - 1
        # Only terms that some item asks together with this one can ever count.
        beside = np.zeros(len(self.weights), bool)
        for item in self.asked_by[term]:
            beside[self.items[item]] = True
        entries = _spread(self.starts[held], self.sizes[held])
        counts = beside[self.terms[entries]]
        entries = entries[counts]
        key = np.repeat(block, self.sizes[held])[counts] * len(self.weights) + self.terms[entries]
        order = np.argsort(key, kind="stable")
        key, own = key[order], self.impacts[entries[order]]
        begins = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key = key[begins]
        return Blocks(
            held,
            np.concatenate([np.flatnonzero(first), [len(held)]]),
            key % len(self.weights),
            np.maximum.reduceat(own, begins),
            np.searchsorted(key, np.arange(block[-1] + 1) * len(self.weights)),
        )

    def scores(self, held: np.ndarray, weights: np.ndarray) -> np.ndarray:
        sizes = self.sizes[held]
        entries = _spread(self.starts[held], sizes)
        return np.add.reduceat(
            weights[self.terms[entries]] * self.impacts[entries], np.cumsum(sizes) - sizes
        )

    def search(self, item: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores: the best of the shard, and all that score like the last."""
        own = self.items[item]
        most = self.weights[own] * self.largest[own]
        own, most = own[most > 0], most[most > 0]
        weights = np.zeros(len(self.weights), np.int64)
        weights[own] = self.weights[own]
        seen = np.zeros(len(self.sizes), bool)
        documents, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, left = 1, int(most.sum())  # what a document must score; what lists can still add
        for at in np.argsort(-most, kind="stable"):
            if left < least:
                break
            left -= int(most[at])
            blocks = self.blocks(int(own[at]))
            bounds = blocks.bounds(weights)
            order = np.argsort(-bounds, kind="stable")
            self.seen_blocks += len(order)
            start, step = 0, 4
            while start < len(order):
                some = order[start : start + step]
                some = some[bounds[some] >= least]
                if not len(some):
                    self.skipped_blocks += len(order) - start
                    break
                self.skipped_blocks += len(order[start : start + step]) - len(some)
                start, step = start + step, 2 * step
                begin = blocks.starts[some]
                held = blocks.documents[_spread(begin, blocks.starts[some + 1] - begin)]
                held = held[~seen[held]]
                if not len(held):
                    continue
                seen[held] = True
                found = self.scores(held, weights)
                documents = np.concatenate([documents, held])
                scores = np.concatenate([scores, found])
                if len(scores) >= best:
                    least = max(least, int(np.partition(scores, -best)[-best]))
                    documents, scores = documents[scores >= least], scores[scores >= least]
        return documents[scores >= least], scores[scores >= least]


def _searched(items: list[tuple], weights: np.ndarray, documents: int, length: int, best: int):
    """Rows of vectors to (item, item_id, doc_id, score): every shard's best for every item."""
    asked = [own for _, own in items]

    def shard(parts: list[pa.RecordBatch], item_type) -> pa.RecordBatch:
        ids = pa.concat_arrays([p.column(0) for p in parts])
        n, sizes, terms, counts = (
            np.concatenate(a)
            for a in zip(
                *[
                    (
                        p.column(1).to_numpy(),
                        p.column(2).value_lengths().to_numpy().astype(np.int64),
                        p.column(2).flatten().to_numpy(),
                        p.column(3).flatten().to_numpy(),
                    )
                    for p in parts
                ]
            )
        )
        index = Shard(n, sizes, terms, counts, asked, weights, documents, length)
        rows = []
        for item, (item_id, _) in enumerate(items):
            held, scores = index.search(item, best)
            names = ids.take(pa.array(held)).to_pylist()
            found = sorted(zip((-scores).tolist(), [i is not None for i in names], names))
            rows += [(item, item_id, name, -score) for score, _, name in found[:best]]
        kinds = (pa.int32(), item_type, ids.type, pa.int64())
        columns = list(zip(*rows)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["item", "item_id", "doc_id", "score"],
        )

    def batches(rows: Iterator[pa.RecordBatch], item_type) -> Iterator[pa.RecordBatch]:
        held, parts = 0, []
        for batch in rows:
            batch = batch.filter(pc.greater(pc.list_value_length(batch.column(2)), 0))
            ends = np.cumsum(batch.column(2).value_lengths().to_numpy().astype(np.int64))
            start, before = 0, 0
            while start < batch.num_rows:
                stop = max(int(np.searchsorted(ends, before + SHARD_POSTINGS - held)), start + 1)
                parts.append(batch.slice(start, stop - start))
                last = int(ends[min(stop, batch.num_rows) - 1])
                held, before, start = held + last - before, last, stop
                if held >= SHARD_POSTINGS or start < batch.num_rows:
                    yield shard(parts, item_type)
                    held, parts = 0, []
        if parts:
            yield shard(parts, item_type)

    return batches


def _best(found: DataFrame, best: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return ranked.select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame, items: DataFrame, best: int = BEST, items_at_once: int = ITEMS_AT_ONCE
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``best`` documents (doc_id, text) of every item
    (item_id, text) that score above 0.

    Equal scores go by doc_id, null first. Every row is a document or an item of its own, also
    where an id is null or there twice. Null and empty texts have no terms: such documents are
    counted nowhere, such items find nothing. Other columns are not looked at. Only a pass's
    items, and numbers for each of their terms, are ever held by the driver.
    """
    spark = docs.sparkSession
    schema = (
        f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, "
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score bigint"
    )
    asked = items.select("item_id", F.array_distinct(terms(F.col("text"))).alias("terms"))
    rows, result = asked.where(F.size("terms") > 0).toLocalIterator(), None
    while some := list(islice(rows, items_at_once)):
        found = _best(_one_pass(docs, some, items, best), best)
        result = found if result is None else result.union(found)
    return spark.createDataFrame([], schema) if result is None else result


def _one_pass(docs: DataFrame, some: list, items: DataFrame, best: int) -> DataFrame:
    vocabulary = sorted({term for row in some for term in row.terms})
    number = {term: i for i, term in enumerate(vocabulary)}
    known = cut(vectors(docs, vocabulary))
    total = known.agg(F.count("*").alias("n"), F.sum("n").alias("length")).first()
    holders = np.zeros(len(vocabulary), np.int64)
    for row in known.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        holders[row["term"]] = row["count"]
    weights = np.array([weight(total["n"], int(h)) for h in holders], np.int64)
    wanted = [(row.item_id, np.array(sorted(number[t] for t in row.terms))) for row in some]
    batches = _searched(wanted, weights, total["n"], total["length"] or 1, best)
    id_kind, item_kind = known.schema["doc_id"], items.schema["item_id"]
    item_type = to_arrow_type(item_kind.dataType)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches(rows, item_type)

    return known.mapInArrow(
        run,
        f"item int, item_id {item_kind.dataType.simpleString()}, "
        f"doc_id {id_kind.dataType.simpleString()}, score bigint",
    )


def op11_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP11_SQL = r"""
WITH words AS (
    SELECT d, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)
), sizes AS (
    SELECT d, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY d
), totals AS (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS length FROM sizes
), counts AS (
    SELECT d, term, count(*) AS tf FROM words GROUP BY d, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, totals GROUP BY term
), asked AS (
    SELECT DISTINCT i, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)
), scores AS (
    SELECT i, any_value(item_id) AS item_id, d, any_value(s.doc_id) AS doc_id,
        CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))
            AS BIGINT) AS score
    FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes AS s USING (d), totals
    GROUP BY i, d
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS r
    FROM scores WHERE score > 0
)
SELECT item_id, CAST(r AS INTEGER) AS rank, doc_id, score FROM ranked WHERE r <= 50
"""
