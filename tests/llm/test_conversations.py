"""Repairs against trying all edits, and against a plain reading of the contract."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import sys
import zlib

import pytest
from pyspark.sql import functions as F
from tables import plain_rows, write_tables

from tallygate.llm import conversations as conv

sys.setrecursionlimit(20_000)
SPACE = re.compile(r"[\x20\x09-\x0D]")
SCHEMA = (
    "conv_id bigint, turn bigint, role string, text string, "
    # names that the operator uses for columns of its own
    "gaps int, cost string, digest int, symbol string, is_plan int, facts int, _again int"
)
EXTRA = (7, "c", 7, "s", 7, 7, 7)


# --- Brute force ----------------------------------------------------------------------------


def faults_of(rows):
    """'', blank, duplicate or truncated for each (role, text)."""
    seen, found = set(), []
    for role, text in rows:
        plain = SPACE.sub("", text)
        if not plain:
            found.append("blank")
        elif (role, text) in seen:
            found.append("duplicate")
        else:
            found.append("" if plain[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return found


def best(rows, faults, most_inserted):
    """(cost, audit, repaired rows) by trying every combination of edits."""
    tries = [
        "DKR" if not fault or fault == "truncated" else "D" for fault in faults
    ]
    found = None
    for edits in itertools.product(*tries):
        for inserted in itertools.product(range(most_inserted + 1), repeat=len(rows) + 1):
            for roles in itertools.product(
                ("user", "assistant"), repeat=sum(inserted) + edits.count("R")
            ):
                roles_left, cost, audit, out = iter(roles), 0, "", []
                for at in range(len(rows) + 1):
                    for _ in range(inserted[at]):
                        out.append((next(roles_left), ""))
                        audit, cost = audit + "I", cost + 3
                    if at == len(rows):
                        break
                    (role, text), edit = rows[at], edits[at]
                    audit += edit
                    cost += {"D": 4, "K": 0, "R": 3}[edit]
                    if edit != "D":
                        cost += 3 * (faults[at] == "truncated")
                        out.append((next(roles_left) if edit == "R" else role, text))
                initials = "".join(r[:1] or "_" for r, _ in out)
                if re.fullmatch("(s?(ua)+)?", initials):
                    found = min(found or (cost, audit, out), (cost, audit, out))
    return found


def quick(rows, faults):
    """The same by going back from the end, for longer ones."""
    from functools import cache

    grammar = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    full = {"u": "user", "a": "assistant"}

    @cache
    def go(at, state, inserted):
        ways = [(0, "", ())] if at == len(rows) and state in ("", "a") else []
        if inserted < 2:
            for initial, name in full.items():
                if (state, initial) in grammar:
                    cost, audit, out = go(at, grammar[state, initial], inserted + 1)
                    ways.append((cost + 3, "I" + audit, ((name, ""), *out)))
        if at < len(rows):
            (role, text), fault = rows[at], faults[at]
            cost, audit, out = go(at + 1, state, 0)
            ways.append((cost + 4, "D" + audit, out))
            if fault in ("", "truncated"):
                more = 3 * (fault == "truncated")
                if (state, role[:1]) in grammar:
                    cost, audit, out = go(at + 1, grammar[state, role[:1]], 0)
                    ways.append((cost + more, "K" + audit, ((role, text), *out)))
                for initial, name in full.items():
                    if (state, initial) in grammar:
                        cost, audit, out = go(at + 1, grammar[state, initial], 0)
                        ways.append((cost + more + 3, "R" + audit, ((name, text), *out)))
        return min(ways) if ways else (10**9, "~", ())

    cost, audit, out = go(0, "", 0)
    return cost, audit, list(out)


def wanted(conv_id, rows):
    """A row of the report; ``rows``: (turn, role, text)."""
    rows = sorted(
        ((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
        key=lambda row: (
            row[0] is not None, row[0] or 0, row[1], hashlib.sha256(row[2].encode()).digest(),
        ),
    )
    said = [(r, x) for _, r, x in rows]
    faults = faults_of(said)
    cost, audit, out = quick(said, faults)
    turns = [t for t, _, _ in rows if t is not None]
    return (
        conv_id,
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
        sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
        cost,
        audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def damage(rows):
    """The contract's damage, row by row; ``rows``: (conv_id, turn, role, text)."""
    for conv_id, turn, role, text in rows:
        conv, at = (" " if v is None else str(v) for v in (conv_id, turn))
        role, text = (" " if v is None else v for v in (role, text))
        harm = zlib.crc32(f"{conv}:{at}".encode()) % 20
        if harm == 0:
            continue
        text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
        for _ in range(2 if harm == 3 else 1):
            yield conv_id, turn, "user" if harm == 4 else role, text


def by_conversation(rows):
    groups = {}
    for conv_id, *row in rows:
        groups.setdefault(conv_id, []).append(tuple(row))
    return groups


# --- Tests ----------------------------------------------------------------------------------


def letter(role, fault):
    return conv.LETTERS[
        4 * "sua".find(role) % 16 + ["", "blank", "duplicate", "truncated"].index(fault)
    ]


def plan(rows, faults):
    roles = [(r[:1] if r[:1] in ("s", "u", "a") else "o") for r, _ in rows]
    signature = "".join(
        "-" if f in ("blank", "duplicate") else r.upper() if f else r
        for r, f in zip(roles, faults)
    )
    nodes = [conv.END]
    for symbol in reversed(signature):
        nodes.append(conv.node(symbol, nodes[-1]))
    return nodes[-1][conv.START][0], conv.audit(signature, nodes), signature


def test_all_edits_of_short_conversations():
    roles = ("system", "user", "assistant", "bot", "")
    faults = ("", "blank", "truncated")
    for size in range(3):
        for said in itertools.product(itertools.product(roles, faults), repeat=size):
            rows = [(r, str(i)) for i, (r, _) in enumerate(said)]
            cost, audit, out = best(rows, [f for _, f in said], 2 if size < 2 else 1)
            assert plan(rows, [f for _, f in said])[:2] == (cost, audit), said
            assert quick(rows, [f for _, f in said]) == (cost, audit, out)


def test_longer_conversations():
    rng = random.Random(2)
    for _ in range(2000):
        size = rng.randint(0, 12)
        rows = [(rng.choice(["system", "user", "assistant", "x"]), str(i)) for i in range(size)]
        faults = [rng.choice(["", "", "blank", "truncated"]) for _ in rows]
        assert plan(rows, faults)[:2] == quick(rows, faults)[:2]


def test_letters():
    assert bytes(conv.LETTERS).decode() == "s--Su--Ua--Ao--O"


def test_one_node_for_each_ending(spark):
    rng = random.Random(4)
    signatures = {"".join(rng.choice("sua-AU") for _ in range(rng.randint(0, 7))) for _ in range(400)}
    df = spark.createDataFrame([(s,) for s in signatures] * 3, "signature string")
    rows = conv.plans(df.repartition(5)).collect()
    assert sorted(r.signature for r in rows) == sorted(signatures)
    endings = {s[i:] for s in signatures for i in range(len(s))}
    tasks = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    made = sum(r.new_nodes for r in rows)
    assert len(endings) <= made <= len(endings) + 7 * int(tasks)
    for row in rows:
        nodes = [conv.END]
        for symbol in reversed(row.signature):
            nodes.append(conv.node(symbol, nodes[-1]))
        assert row.cost == nodes[-1][conv.START][0]
        assert row.audit == conv.audit(row.signature, nodes)


def odd_rows(seed=6):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "  ", "", None, "cut", "Ünï… ok?", "a\nb.", "x" * 70_000, ". ", "\x0b.\x0c"]
    roles = ["user", "assistant", "user", "assistant", "system", None, "", "tool", "unknown"]
    rows = []
    for conv_id in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            at = rng.choice([turn, turn, turn, 2 * turn, None])
            rows.append((conv_id, at, rng.choice(roles), rng.choice(texts)))
    rows += [rows[5], rows[5], (900, None, None, None), (901, 3, "user", "One.")]
    rows += [(i, 1, "user", "All of it?") for i in range(2000, 2060)]
    rows += [(902, t, "ua"[t % 2] + "x", f"Line {t}.") for t in range(1000)]
    return rows


def test_report(spark):
    rows = odd_rows()
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    right = [wanted(k, g) for k, g in by_conversation(rows).items()]
    assert plain_rows(conv.report(df)) == sorted(right, key=str)


def test_repaired_rows(spark):
    rows = odd_rows(7)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(4)
    out = by_conversation(tuple(r) for r in conv.repaired(df).collect())
    digests = {r.conv_id: r.repaired_sha256 for r in conv.report(df).collect()}
    for conv_id, digest in digests.items():
        said = [(r, x) for _, r, x in sorted(out.get(conv_id, []))]
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in said))
        text = "\n".join(f"{r}:{x}" for r, x in said)
        assert hashlib.sha256(text.encode()).hexdigest() == digest


@pytest.mark.parametrize("letters", [0, conv.BROADCAST_LETTERS])
def test_query(spark, tmp_path, monkeypatch, letters):
    """Damage and all, with plans sent to all tasks and with plans that are shuffled."""
    monkeypatch.setattr(conv, "BROADCAST_LETTERS", letters)
    rows = odd_rows(8)
    df = spark.createDataFrame([(*r, *EXTRA) for r in rows], SCHEMA).repartition(3)
    after = by_conversation(damage(rows))
    right = [wanted(k, after.get(k, [])) for k in by_conversation(rows)]
    folder = write_tables(tmp_path, conversations=df)
    assert 0 < len(by_conversation(rows).keys() - after.keys())
    assert plain_rows(conv.op13_conversation_repair(spark, folder)) == sorted(right, key=str)


def test_given_conversations(spark):
    """Every conversation of the smallest table."""
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    after = by_conversation(damage(rows))
    right = [wanted(k, after.get(k, [])) for k in by_conversation(rows)]
    assert plain_rows(conv.op13_conversation_repair(spark, folder)) == sorted(right, key=str)


def test_no_rows(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert conv.report(empty).count() == 0
    folder = write_tables(tmp_path, conversations=empty)
    assert conv.op13_conversation_repair(spark, folder).count() == 0


def test_rows_of_one_conversation_stay_together(spark):
    """However many partitions there are."""
    rows = [(1, t, "user", f"{t}.") for t in range(3000)]
    df = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    found = conv.report(df.repartition(64)).select("conv_id", F.length("audit").alias("n")).collect()
    assert len(found) == 1 and found[0].n >= 3000
