"""SimHash near-duplicates: fingerprints, the pairs of them within a few bits, groups.

Fingerprints within ``MAX_BITS`` bits are found by the general pigeonhole principle. The
64 bits are put into parts, correlated bits together. Every fingerprint is filed under its
value in each part, and looks up, part by part, the values within the part's threshold of
its own. Thresholds are unequal and chosen per fingerprint by dynamic programming over
estimated candidate counts: writing u for a part's threshold plus one (0: the part is not
looked at), any choice with the u of all parts adding up to ``MAX_BITS + 1`` finds every
partner, because a pair that is at least u bits apart in every part is more than
``MAX_BITS`` apart. Candidates are verified on all bits.

A value that more than ``BUCKET`` fingerprints share would make a candidate of every two of
them. Its fingerprints (the filed ones and those that look it up) meet instead at the values
at most one bit away from them: two fingerprints at most two bits apart share such a value,
at most 65 fingerprints share one, and any two that share one are at most two bits apart.
Every two that meet are a link, so that the work follows the links there are: at most 2,080
of a fingerprint (64 one bit away, 2,016 two), however large the group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import cut
from tallygate.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
#: Fingerprints filed under one value from which on it is handled without pairs.
BUCKET = 32
BITS = 64
#: Shingles hashed before their bits are counted: bounds the memory of a very long text.
BLOCK = 1 << 16

#: For each byte value, its eight bits, lowest first.
BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def simhash(text: bytes | None) -> int:
    """The fingerprint as a signed 64-bit number; 0 for a text without words (or null)."""
    words = text.lower().split() if text else []  # bytes: only A-Z, and ASCII white space
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        count, shingles = 1, iter([b" ".join(words)])
    else:
        count = len(words) - SHINGLE_WORDS + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE_WORDS))))
    ones = np.zeros(BITS, dtype=np.int64)
    lanes = np.arange(8) * 256
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, BLOCK):
        size = min(BLOCK, count - start)
        hashes = np.fromiter((digest(s, SEED) for s in _take(shingles, size)), np.uint64, size)
        values = hashes.astype("<u8").view(np.uint8).reshape(size, 8) + lanes
        seen = np.bincount(values.ravel(), minlength=2048).reshape(8, 256)
        ones += (seen @ BYTE_BITS.astype(np.int64)).ravel()
    majority = np.packbits(2 * ones > count, bitorder="little")
    return int(majority.view("<i8")[0])


def _take(items: Iterator, count: int) -> Iterator:
    for _, item in zip(range(count), items):
        yield item


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """(doc_id, row_key, fp) for every row of ``docs``. Null, empty and blank texts have fp 0."""

    def batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            found = [simhash(text.as_py()) for text in rows.column(2)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(found, pa.int64())],
                names=["doc_id", "row_key", "fp"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    narrow = docs.select(
        F.col(id_column).alias("doc_id"),
        row_key(id_column, text_column).alias("row_key"),
        F.col(text_column).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(batch, f"doc_id {kind}, row_key string, fp bigint")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- Parts, estimates and thresholds ---------------------------------------


def _together(nodes: DataFrame) -> np.ndarray:
    """How often each two bits agree, over all fingerprints: 64 x 64 counts, whatever the input."""

    def count(batches):
        both = np.zeros((BITS, BITS))
        for rows in batches:
            signs = _bits(rows.column(0).to_numpy()).astype(np.float32) * 2 - 1
            both += signs.T @ signs
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(BITS * BITS), pa.int32()), pa.array(both.ravel().astype(np.int64))],
            names=["at", "n"],
        )

    counted = nodes.select("fp").mapInArrow(count, "at int, n bigint")
    table = np.zeros(BITS * BITS)
    for row in counted.groupBy("at").agg(F.sum("n").alias("n")).collect():  # 4096 rows
        table[row["at"]] = row["n"]
    return table.reshape(BITS, BITS)


def _bits(fps: np.ndarray) -> np.ndarray:
    """One row of 64 zeros and ones for each fingerprint."""
    view = np.ascontiguousarray(fps, dtype="<i8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(view, axis=1, bitorder="little")


def group_bits(together: np.ndarray, parts: int) -> list[list[int]]:
    """Bits dealt into ``parts`` groups of equal size (or one less), correlated ones together."""
    strength = np.abs(together) - np.diag(np.diag(np.abs(together)))
    left, groups = set(range(BITS)), []
    for part in range(parts):
        size = (len(left) + parts - part - 1) // (parts - part)
        rest = sorted(left)
        group = [max(rest, key=lambda b: strength[b, rest].max())]
        left.remove(group[0])
        while len(group) < size:
            best = max(sorted(left), key=lambda b: strength[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(group)
    return groups


class Plan:
    """How fingerprints are cut into parts, and what a lookup in each part costs."""

    def __init__(self, groups: list[list[int]], total: int):
        self.groups = groups
        self.total = total
        # Each part's values are counted in two halves, taken as independent.
        self.halves = [(g[: len(g) // 2], g[len(g) // 2 :]) for g in groups]
        self.near: list[list[np.ndarray]] = []

    def learn(self, counts: dict[tuple[int, int], np.ndarray]) -> None:
        """From how often each half has each value: how often a value exactly r bits off occurs."""
        for part, halves in enumerate(self.halves):
            for half, bits in enumerate(halves):
                share = counts[part, half] / max(1, self.total)
                rings = [share, np.zeros_like(share), np.zeros_like(share)]
                at = np.arange(len(share))
                for one in range(len(bits)):
                    rings[1] += share[at ^ (1 << one)]
                    for two in range(one):
                        rings[2] += share[at ^ (1 << one) ^ (1 << two)]
                self.near.append(rings)

    def values(self, bits: np.ndarray, group: list[int]) -> np.ndarray:
        return bits[:, group].astype(np.int64) @ (1 << np.arange(len(group), dtype=np.int64))

    def costs(self, bits: np.ndarray) -> np.ndarray:
        """Estimated rows [fingerprint, part, u]: values looked up and candidates found."""
        cost = np.zeros((len(bits), len(self.groups), MAX_BITS + 2))
        for part, halves in enumerate(self.halves):
            low, high = (self.values(bits, half) for half in halves)
            lows, highs = self.near[2 * part], self.near[2 * part + 1]
            for u in range(1, MAX_BITS + 2):
                off = u - 1
                found = sum(lows[i][low] * highs[off - i][high] for i in range(off + 1))
                looked_up = len(_masks(len(self.groups[part]), off, exactly=True))
                cost[:, part, u] = cost[:, part, u - 1] + looked_up + self.total * found
        return cost

    def thresholds(self, bits: np.ndarray) -> np.ndarray:
        """u [fingerprint, part] of least estimated cost, adding up to MAX_BITS + 1."""
        cost, need = self.costs(bits), MAX_BITS + 1
        best = np.full((len(bits), need + 1), np.inf)
        best[:, 0] = 0
        chosen = []
        for part in range(len(self.groups)):
            options = np.full((len(bits), need + 1, need + 1), np.inf)  # [row, total, u]
            for total in range(need + 1):
                for u in range(total + 1):
                    options[:, total, u] = best[:, total - u] + cost[:, part, u]
            chosen.append(options.argmin(axis=2))
            best = options.min(axis=2)
        u = np.zeros((len(bits), len(self.groups)), dtype=np.int64)
        left = np.full(len(bits), need)
        for part in reversed(range(len(self.groups))):
            u[:, part] = chosen[part][np.arange(len(bits)), left]
            left -= u[:, part]
        return u


def _masks(width: int, bits: int, exactly: bool = False) -> np.ndarray:
    """Numbers of ``width`` bits with up to (or exactly) ``bits`` of them set, for bits 0 to 2."""
    ones = [1 << i for i in range(width)]
    rings = [[0], ones, [a | b for i, a in enumerate(ones) for b in ones[:i]]]
    return np.array(rings[bits] if exactly else sum(rings[: bits + 1], []), dtype=np.int64)


def _make_plan(nodes: DataFrame, total: int) -> Plan:
    """Parts at least as wide as the number of fingerprints is long, so that few meet by chance."""
    width = max(1, int(total).bit_length())
    plan = Plan(group_bits(_together(nodes), min(MAX_BITS + 1, max(2, BITS // width))), total)

    def count(batches):
        tables = {}
        for rows in batches:
            bits = _bits(rows.column(0).to_numpy())
            for part, halves in enumerate(plan.halves):
                for half, own in enumerate(halves):
                    seen = np.bincount(plan.values(bits, own), minlength=1 << len(own))
                    tables[part, half] = tables.get((part, half), 0) + seen
        for (part, half), seen in tables.items():
            used = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(used), 2 * part + half, np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(seen[used].astype(np.int64)),
                ],
                names=["half", "value", "n"],
            )

    counted = nodes.select("fp").mapInArrow(count, "half int, value int, n bigint")
    counts = {
        (part, half): np.zeros(1 << len(own))
        for part, halves in enumerate(plan.halves)
        for half, own in enumerate(halves)
    }
    # At most 2 x 2 x 65,536 rows, as halves have 16 bits at most.
    for row in counted.groupBy("half", "value").agg(F.sum("n").alias("n")).collect():
        counts[divmod(row["half"], 2)][row["value"]] = row["n"]
    plan.learn(counts)
    return plan


# --- Links ------------------------------------------------------------------


def _entries(nodes: DataFrame, plan: Plan) -> DataFrame:
    """(key, fp, lookup): where each fingerprint is filed, and what it looks up."""

    def batch(batches):
        for rows in batches:
            fps = rows.column(0).to_numpy()
            bits = _bits(fps)
            u = plan.thresholds(bits)
            for part, group in enumerate(plan.groups):
                values = plan.values(bits, group)
                yield entry_batch(part, values, fps, False)
                for threshold in range(1, MAX_BITS + 2):
                    own = np.flatnonzero(u[:, part] == threshold)
                    masks = _masks(len(group), threshold - 1)
                    step = max(1, 200_000 // len(masks))
                    for start in range(0, len(own), step):
                        some = own[start : start + step]
                        near = (values[some][:, None] ^ masks).ravel()
                        yield entry_batch(part, near, np.repeat(fps[some], len(masks)), True)

    def entry_batch(part, values, fps, lookup):
        return pa.RecordBatch.from_arrays(
            [
                pa.array((np.int64(part) << 58) | values),
                pa.array(fps),
                pa.array(np.full(len(fps), lookup)),
            ],
            names=["key", "fp", "lookup"],
        )

    return nodes.select("fp").mapInArrow(batch, "key bigint, fp bigint, lookup boolean")


def _neighbourhood_links(fps: DataFrame) -> DataFrame:
    """(a, b), a < b: every two fingerprints at most two bits apart, once.

    Two of them have two values at most one bit away in common, v and a ^ b ^ v (one bit
    apart: these are a and b). They are linked at the smaller one.
    """
    flips = F.transform(
        F.sequence(F.lit(0), F.lit(BITS - 1)),
        lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)),
    )
    near = fps.select("fp", F.explode(F.concat(F.array("fp"), flips)).alias("value"))
    other = F.col("a").bitwiseXOR(F.col("b")).bitwiseXOR(F.col("value"))
    return (
        near.groupBy("value")
        .agg(F.collect_list("fp").alias("members"))  # 65 at most: fps are distinct
        .where(F.size("members") > 1)
        .select("value", "members", F.explode("members").alias("a"))
        .select("value", "a", F.explode("members").alias("b"))
        .where(F.col("a") < F.col("b"))
        .where(F.col("value") < other)
        .select("a", "b")
    )


def near_links(nodes: DataFrame) -> DataFrame:
    """(a, b), a < b: every two fingerprints within MAX_BITS of each other, and no others.

    ``nodes`` has distinct ``fp``. A link may come more than once, as two fingerprints may
    meet under several values.
    """
    total = nodes.count()
    entries = _entries(nodes, _make_plan(nodes, total))
    filed = entries.where("not lookup").groupBy("key").agg(F.count("*").alias("n"))
    # One filed alone stays: another fingerprint may look its value up from a few bits away.
    known = cut(entries.join(filed, "key"))
    small = known.where(F.col("n") <= BUCKET)
    pairs = (
        small.where("not lookup")
        .select("key", F.col("fp").alias("a"))
        .join(small.where("lookup").select("key", F.col("fp").alias("b")), "key")
        .where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        .select("a", "b")
    )
    crowded = known.where(F.col("n") > BUCKET).select("fp").distinct()
    return pairs.union(_neighbourhood_links(crowded))


def near_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, row_key, fp, component_id, keep) for every row of ``docs``.

    component_id is the smallest id that links reach, the row's own included; null ids are
    no candidates, so a group without any other id has null. ``row_key`` names a row by its
    id and text. ``keep`` marks the row that stands for its group: the one with that id and,
    should several texts bear the id, one of them (rows repeated whole are all marked).
    Null and blank texts share fingerprint 0 and so one group. An empty table gives an
    empty result.
    """
    marked = cut(fingerprints(docs, id_column, text_column))
    nodes = cut(
        marked.groupBy("fp").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")).alias(
                "first"
            )
        )
    )
    roots = components(near_links(nodes)).withColumnRenamed("node", "fp")
    placed = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = placed.groupBy("root").agg(F.min("first").alias("best"))
    of_fp = placed.join(best, "root").select("fp", "best")
    return marked.join(of_fp, "fp").select(
        "doc_id",
        "row_key",
        "fp",
        F.col("best.doc_id").alias("component_id"),
        (F.col("row_key") == F.col("best.row_key")).alias("keep"),
    )


def row_key(id_column: str, text_column: str) -> Column:
    """A name, never null, that rows share if they have the same id and text."""
    return F.concat_ws(
        "/",
        F.coalesce(F.col(id_column).cast("string"), F.lit("none")),
        F.xxhash64(text_column).cast("string"),
    )


def keep_one_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"):
    """The rows of ``docs`` that stand for their group, one for each group, columns unchanged."""
    key = "_tallygate_row_key"
    chosen = near_groups(docs, id_column, text_column).where("keep")
    return (
        docs.withColumn(key, row_key(id_column, text_column))
        .join(chosen.select(F.col("row_key").alias(key)).distinct(), key, "left_semi")
        .dropDuplicates([key])  # rows repeated whole; they are together already
        .drop(key)
    )


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_groups(docs).select(
        "doc_id", hex_digits(F.col("fp")).alias("fingerprint"), "component_id", "keep"
    )
