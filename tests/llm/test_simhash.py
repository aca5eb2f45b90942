"""SimHash groups against all pairs, with and without crowded values."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from tables import no_documents, odd_documents, plain_rows

from tallygate.llm import simhash
from tallygate.llm.components import components


def brute_fingerprint(text: str | None) -> int:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = [sum(h >> b & 1 for h in hashes) for b in range(64)]
    return sum(1 << b for b, ones in enumerate(bits) if 2 * ones > len(hashes))


def brute_groups(fps: list[int]) -> dict[int, int]:
    """Smallest member (unsigned) of each one's group, by comparing all pairs."""
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if a < b and (a ^ b).bit_count() <= simhash.MAX_BITS:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {fp: find(fp) for fp in root}


def signed(number: int) -> int:
    return number - (1 << 64) if number >> 63 else number


def test_fingerprints_and_groups(spark):
    docs = odd_documents(spark)
    texts = [(row.doc_id, row.text) for row in docs.collect()]
    roots = brute_groups([brute_fingerprint(t) for _, t in texts])
    first: dict[int, int | None] = {}
    for doc_id, text in texts:
        root = roots[brute_fingerprint(text)]
        known = [i for i in (first.get(root), doc_id) if i is not None]
        first[root] = min(known, default=None)
    found = simhash.near_groups(docs).collect()
    assert len(found) == len(texts)
    wanted = sorted(
        ((i, signed(brute_fingerprint(t)), first[roots[brute_fingerprint(t)]]) for i, t in texts),
        key=str,
    )
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in found), key=str) == wanted


def test_blank_texts_are_one_group(spark):
    rows = {(r.doc_id, r.fp): r for r in simhash.near_groups(odd_documents(spark)).collect()}
    assert [rows[i, 0].component_id for i in (0, 1, 2)] == [0, 0, 0]


@pytest.mark.parametrize("bucket", [0, 1, 4, 32])
def test_links_of_random_and_clustered_fingerprints(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(bucket)
    fps = {rng.getrandbits(64) for _ in range(300)}
    center = rng.getrandbits(64)
    for _ in range(400):  # a crowd around one value, and chains leading away from it
        near = center
        for _ in range(rng.randint(0, 5)):
            near ^= 1 << rng.randrange(64)
        fps.add(near)
    step = rng.getrandbits(64)
    for bit in range(0, 40, 2):
        step ^= 3 << bit
        fps.add(step)
    nodes = spark.createDataFrame([(signed(fp),) for fp in fps], "fp bigint").repartition(3)
    links = simhash.near_links(nodes).collect()
    known = {signed(fp) for fp in fps}
    assert all(a in known and b in known for a, b in links)
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= simhash.MAX_BITS for a, b in links)
    found = {r.node: r.root for r in components(
        spark.createDataFrame([tuple(r) for r in links], "a bigint, b bigint")).collect()}
    groups: dict[int, set[int]] = {}
    for fp, root in brute_groups(list(fps)).items():
        groups.setdefault(root, set()).add(signed(fp))
    ours: dict[int, set[int]] = {}
    for fp in known:
        ours.setdefault(found.get(fp, fp), set()).add(fp)
    assert sorted(map(sorted, ours.values())) == sorted(map(sorted, groups.values()))


def far_apart_but_one_part(count: int) -> set[int]:
    """Fingerprints alike in 22 bits, so that lookups go elsewhere, each with a partner whose two
    bits lie anywhere: often one bit in each of the parts that are looked at."""
    rng = random.Random(5)
    top = rng.getrandbits(22) << 42
    fps = set()
    for _ in range(count):
        fp = top | rng.getrandbits(42)
        fps |= {fp, fp ^ sum(1 << bit for bit in rng.sample(range(42), 2))}
    return fps


def test_partners_filed_alone_are_found(spark, monkeypatch):
    """A value that one fingerprint is filed under may be looked up from a bit away."""
    monkeypatch.setattr(simhash, "BUCKET", 10_000)
    fps = far_apart_but_one_part(600)
    nodes = spark.createDataFrame([(signed(fp),) for fp in fps], "fp bigint").repartition(3)
    found = {tuple(row) for row in simhash.near_links(nodes).select("a", "b").collect()}
    near = {
        tuple(sorted((signed(a), signed(b))))
        for a in fps
        for b in fps
        if a < b and (a ^ b).bit_count() <= simhash.MAX_BITS
    }
    assert len(near) >= 590
    assert {tuple(sorted(pair)) for pair in found} == near


@pytest.mark.parametrize("bucket", [0, 32])
def test_every_link_within_crowded_values(spark, monkeypatch, bucket):
    """All pairs within the bits are there, also among those that share a crowded value."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng = random.Random(7)
    fps = {rng.getrandbits(64) for _ in range(100)}
    for center in [rng.getrandbits(64) for _ in range(3)]:  # both signs in each crowd
        weak = [63, *rng.sample(range(63), 7)]
        for _ in range(200):
            fps.add(center ^ sum(1 << bit for bit in rng.sample(weak, rng.randint(0, 8))))
    nodes = spark.createDataFrame([(signed(fp),) for fp in fps], "fp bigint").repartition(3)
    found = {tuple(sorted(row)) for row in simhash.near_links(nodes).select("a", "b").collect()}
    near = {
        tuple(sorted((signed(a), signed(b))))
        for a in fps
        for b in fps
        if a < b and (a ^ b).bit_count() <= simhash.MAX_BITS
    }
    assert len(near) > 5 * len(fps)
    assert found == near


def test_thresholds_always_add_up():
    rng = np.random.default_rng(1)
    for parts in (2, 3):
        plan = simhash.Plan(simhash.group_bits(rng.random((64, 64)), parts), 1000)
        assert sorted(b for g in plan.groups for b in g) == list(range(64))
        plan.learn(
            {
                (p, h): rng.integers(0, 20, 1 << len(own)).astype(float)
                for p, halves in enumerate(plan.halves)
                for h, own in enumerate(halves)
            }
        )
        bits = rng.integers(0, 2, (500, 64)).astype(np.uint8)
        assert (plan.thresholds(bits).sum(axis=1) == simhash.MAX_BITS + 1).all()


def test_one_row_of_each_group_stays(spark):
    docs = odd_documents(spark)
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns
    roots = brute_groups([brute_fingerprint(r.text) for r in docs.collect()])
    smallest: dict = {}
    for row in docs.collect():
        root = roots[brute_fingerprint(row.text)]
        ids = [i for i in (smallest.get(root), row.doc_id) if i is not None]
        smallest[root] = min(ids, default=None)
    rows = kept.collect()
    found = [(roots[brute_fingerprint(r.text)], r.doc_id) for r in rows]
    assert sorted(found) == sorted(smallest.items())


def test_a_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.simhash(text.encode()) == whole == signed(brute_fingerprint(text))


def test_no_documents(spark):
    assert plain_rows(simhash.near_groups(no_documents(spark))) == []
    assert plain_rows(simhash.keep_one_each(no_documents(spark))) == []


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    roots = {r.node: r.root for r in found}
    assert all(roots[i] == 0 for i in range(1, 201))
    assert all(roots[1000 + i] == 1000 for i in range(1, 300))
    assert len(roots) == 200 + 299
