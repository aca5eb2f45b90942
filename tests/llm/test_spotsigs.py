"""Fingerprints, edited texts and likeness against sets built word by word."""

from __future__ import annotations

import hashlib

import pytest
import regex
from helpers import plan_text
from pyspark.sql import functions as F
from tables import no_documents, odd_documents, plain_rows

from tallygate.llm import spotsigs

ANCHORS = set(spotsigs.ANCHORS.split())


def signatures(text: str) -> set:
    words = regex.findall(r"[\p{L}\p{N}]+", text.lower())
    found = set()
    for i, word in enumerate(words):
        if word in ANCHORS:
            chain = [w for w in words[i + 1 :] if w not in ANCHORS][: spotsigs.CHAIN]
            if len(chain) == spotsigs.CHAIN:
                found.add((word, *chain))
    return found or ({tuple(words)} if words else set())


def jaccard(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def check(docs, found):
    """``docs``: (doc_id, text) with distinct ids."""
    order = sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0), reverse=True)
    rows = {r.doc_id: r for r in found}
    assert len(rows) == len(order)
    prints: dict[str, str] = {}
    for i, (doc_id, text) in enumerate(order):
        text, row = text or "", rows[doc_id]
        following = order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other, after = signatures(text), signatures(edited), signatures(following)
        assert len(row.fingerprint) == 8 * len(own)
        assert row.near_edited == pytest.approx(jaccard(own, other))
        assert row.near_next == pytest.approx(jaccard(own, after))
        for t, p in ((text, row.fingerprint), (edited, row.edited_fingerprint)):
            assert prints.setdefault(t, p) == p


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_odd_texts(spark, monkeypatch, block):
    monkeypatch.setattr(spotsigs, "BLOCK", block)
    docs = odd_documents(spark).where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).cache()
    rows = [(r.doc_id * r.doc_id, r.text) for r in docs.collect()]  # with gaps
    spread = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    check(rows, spotsigs.compared(spread).collect())


def test_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    check([(r.doc_id, r.text) for r in docs.collect()], spotsigs.compared(docs).collect())


def test_null_ids_repeated_ids_and_rows(spark):
    rows = [(3, "b the one two"), (3, "a the one two"), (None, "z of x y"), (1, "q"), (1, "q")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = spotsigs.compared(docs)
    order = ["a the one two", "b the one two", "q", "q", "z of x y"]
    edited = sorted(
        hashlib.sha256(
            (t[: len(t) - len(t) // 2] + order[(i + 1) % 5][: len(t) // 2]).encode()
        ).hexdigest()
        for i, t in enumerate(order)
    )
    assert sorted(r.edited_sha256 for r in found.collect()) == edited


def test_one_document_follows_itself(spark):
    docs = spark.createDataFrame([(9, "abcdef")], "doc_id bigint, text string")
    row = spotsigs.compared(docs).first()
    assert row.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert row.near_next == 1.0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    assert spotsigs.compared(docs).count() == docs.count()


def test_no_documents(spark):
    assert plain_rows(spotsigs.compared(no_documents(spark))) == []


def test_pruning_only_leaves_out_the_unlike(spark):
    rows = [(list(range(a)), list(range(b))) for a in range(0, 60, 7) for b in range(0, 60, 5)]
    from pyspark.sql import functions as F

    sets = spark.createDataFrame(rows, "a array<int>, b array<int>")
    for least in (0.05, 0.3, 0.8):
        near = spotsigs.likeness(F.col("a"), F.col("b"), least).alias("near")
        for row in sets.select("a", "b", near).collect():
            exact = jaccard(set(row.a), set(row.b))
            assert row.near == pytest.approx(exact) or (row.near == 0 and exact < least)


def test_plan_has_no_python_and_moves_texts_once(spark):
    plan = plan_text(spotsigs.compared(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")))
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("hashpartitioning(block") == 1 and plan.count("hashpartitioning(") == 1


def test_small_likenesses_are_given(spark):
    chains = [f"the x{i} y{i}" for i in range(400)]
    docs = spark.createDataFrame(
        [(2, " ".join(chains)), (1, " ".join(chains[:19]))], "doc_id bigint, text string"
    )
    found = {r.doc_id: r.near_next for r in spotsigs.compared(docs).collect()}
    assert found[2] == pytest.approx(19 / 400) and found[1] == found[2]


def test_null_ids_have_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "BLOCK", 4)
    texts = [f"word{i:03}" + "x" * (i % 5 + 7) for i in range(60)]
    rows = [(None if i % 3 else i, text) for i, text in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.text: r.next_text for r in spotsigs.with_next(docs).collect()}
    assert len(found) == 60 and sorted(found.values()) == sorted(texts)  # each follows one
    at, order = texts[57], []
    while at not in order:
        order.append(at)
        at = found[at]
    assert len(order) == 60 and order[:20] == texts[57::-3]  # one round; ids first, descending
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    parts = spotsigs.with_next(docs.where("doc_id IS NULL")).select(F.spark_partition_id())
    assert parts.distinct().count() > 1
    spark.conf.set(coalesce, before)
