"""Every registered query against its SQL on the same tables, values and types."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

from tallygate.plans.catalog import QUERIES
from tallygate.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.01"

SQL_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in sorted(Path(SF_DIR).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    yield connection
    connection.close()


def comparable(rows):
    def key(row):
        return tuple((value is not None, str(value)) for value in row)

    return sorted((tuple(row) for row in rows), key=key)


def same(left, right):
    if isinstance(left, float) and isinstance(right, float):
        return math.isclose(left, right, rel_tol=1e-12, abs_tol=1e-9)
    return left == right


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    result = QUERIES[name](spark, SF_DIR)
    columns = sorted(result.columns)
    ours = comparable(result.select(*columns).collect())

    relation = database.sql(ORACLES[name])
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert sorted(relation.columns) == columns
    quoted = ", ".join(f'"{column}"' for column in columns)
    theirs = comparable(relation.project(quoted).fetchall())

    assert {c: t for c, t in result.dtypes} == {c: SQL_TYPES[t] for c, t in types.items()}
    assert len(ours) == len(theirs)
    assert len(ours) > 0
    wrong = [
        (mine, other)
        for mine, other in zip(ours, theirs)
        if not all(same(a, b) for a, b in zip(mine, other))
    ]
    assert not wrong, f"{len(wrong)} rows differ, first: {wrong[0]}"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_driver_contract(spark):
    import __spark_entry__ as contract

    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        elsewhere = sorted(map(tuple, contract.entry(spark).collect()), key=str)
        assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert elsewhere == sorted(map(tuple, contract.entry(spark).collect()), key=str)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
