"""What several operators of this folder need: inputs without surprises, cut lineage, ranks."""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate import session

#: Rows of a few numbers or short texts that are sent to every executor, some 20 MB.
BROADCAST_ROWS = 250_000

# --- Fixed values: the contract's word, in Java's notation -----------------
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, ASCII_UPPER, ASCII_LOWER)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, stored in the cluster's shared folder, without their lineage."""
    shared_base(df.sparkSession)
    return df.checkpoint()


def shared_base(spark: SparkSession) -> str:
    """The cluster's shared folder. Where a local session (a test) has none, it is given one."""
    context = spark.sparkContext
    base = session.shared_base(spark)
    if base is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallygate-llm-")
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(base)
    return base


def small(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` narrow rows, to be broadcast in a join if that is few enough.

    Beyond the bound the join is left to Spark, which shuffles both sides.
    """
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def ranked(df: DataFrame, order: list[Column], group: str | None = None) -> DataFrame:
    """``df`` with ``rank``: 1, 2, ... in ``order``, within ``group`` if one is named.

    ``order`` must begin with the group. No group is brought together in one task, however
    large it is: rows are dealt out by range and stored, each range is numbered by itself,
    and the counts of the ranges before it are added. Only a row per range (and group) is
    summed up in a single place. Give narrow rows.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    keys = [group] if group else []
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("_range", *keys)
        .agg(F.count("*").alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n")
    )
    numbered = dealt.withColumn(
        "_at", F.row_number().over(Window.partitionBy("_range", *keys).orderBy(*order))
    )
    match = F.col("l._range") == F.col("r._range")
    if group:
        match &= F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}"))
    return (
        numbered.alias("l")
        .join(offsets.alias("r"), match)
        .select("l.*", (F.col("_at") + F.col("_before")).alias("rank"))
        .drop("_range", "_at")
    )


def shared_place(spark: SparkSession, purpose: str) -> str:
    """A place in the shared folder where nothing is yet; it goes away with the session."""
    shared_base(spark)
    return session.shared_folder(spark, purpose)


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to a new place in the shared folder, and read again."""
    path = shared_place(df.sparkSession, name.replace(" ", "-"))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
