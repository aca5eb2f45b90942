"""Queries against SQL, where there is SQL, and against the shape the contract fixes."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tallygate.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "labels", "benchmark")

COLUMNS = {
    "op1": {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"},
    "op2": {
        "page_id": "bigint", "payload_bytes": "bigint", "payload_digest": "string",
        "record_type": "string", "refers_to": "bigint",
    },
    "op3": {
        "page_id": "bigint", "host": "string", "path": "string", "rule": "string",
        "verdict": "string",
    },
    "op4": {
        "doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
        "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean",
        "kept": "boolean",
    },
    "op5": {
        "doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint",
        "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double",
    },
    "op6": {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string",
        "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double",
        "near_next": "double",
    },
    "op7": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op8": {
        "doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double",
        "taken": "bigint",
    },
    "op9": {
        "doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string",
        "decoded_sha256": "string",
    },
    "op10": {
        "doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int",
    },
    "op11": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op12": {
        "doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string",
        "decoded_sha256": "string",
    },
    "op13": {
        "conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint",
        "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
        "repaired_sha256": "string",
    },
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{Path(SF_DIR, name)}.parquet'"
        )
    yield connection
    connection.close()


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = sorted(map(tuple, result.select(*columns).collect()), key=str)
    listed = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(
        database.execute(f"SELECT {listed} FROM ({ORACLES[name]})").fetchall(), key=str
    )
    assert len(ours) == len(theirs) > 0
    wrong = [(a, b) for a, b in zip(ours, theirs) if not all(map(same, a, b))]
    assert not wrong, wrong[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract_columns_come_first(spark, name):
    wanted = COLUMNS[name.split("_")[0]]
    result = QUERIES[name](spark, SF_DIR)
    assert dict(result.dtypes[: len(wanted)]).keys() <= set(result.columns)
    assert {c: dict(result.dtypes)[c] for c in wanted} == wanted
    if name.startswith("op11"):
        assert result.groupBy("item_id").agg({"rank": "max"}).where("`max(rank)` > 50").isEmpty()
    elif "conv_id" in wanted:
        table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
        assert result.count() == table.select("conv_id").distinct().count()
    else:
        table = "pages" if "page_id" in wanted else "documents"
        assert result.count() == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
