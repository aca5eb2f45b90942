"""Mixing sources to target weights by systematic sampling.

Each source gets a target number of words. Its documents are put in order of size; each
adds the same expected number of copies (target / source size), and a copy is emitted for
every whole number that the running sum, begun at one random offset, passes. Because sizes
only grow along the order, the words taken miss the target by at most about the longest
document of the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.llm.common import WORD, ranked

#: Weights of sources in order of their names, repeated as often as needed.
WEIGHTS = (1, 2, 3)
#: A target is at most so many times its source's size, and so are a document's copies.
MOST_COPIES = 3
SEED = "mix"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) for each source.

    Targets are min(cap, level * weight), the level such that they add up to the size of
    all: what capped sources leave over is shared by the others in proportion. With sources
    sorted by cap / weight, the capped ones come first, so running sums find the level.
    This is the one place where all sources meet: a row each, not their documents.
    """
    listed = ", ".join(map(str, weights))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_room = Window.orderBy("room")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    after = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    exact = "decimal(25,0)"
    return (
        sizes.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", F.expr(f"array({listed})[(place - 1) % {len(weights)}]"))
        .withColumn("cap", (F.col("source_size") * MOST_COPIES).cast(exact))
        .withColumn("room", F.struct(F.col("cap") / F.col("weight"), "place"))
        .withColumn(
            "rest",
            F.sum("source_size").over(Window.partitionBy()).cast(exact)
            - F.coalesce(F.sum("cap").over(before), F.lit(0)).cast(exact),
        )
        .withColumn("weights", F.sum("weight").over(after))
        .withColumn(
            "level",
            F.when(
                F.col("rest") * F.col("weight") <= F.col("cap") * F.col("weights"),
                F.struct("rest", "weights"),
            ),
        )
        # The first source below its cap fixes the level for itself and all after it.
        .withColumn("level", F.first("level", ignorenulls=True).over(by_room))
        .select(
            "source",
            "source_size",
            F.coalesce(
                (F.col("level.rest") * F.col("weight")).cast("double")
                / F.col("level.weights").cast("double"),
                F.col("cap").cast("double"),
            ).alias("target"),
        )
    )


def random_offset(source: Column, seed: str = SEED) -> Column:
    """In [0, 1): the same for a source and seed on every run."""
    name = F.coalesce(F.concat(F.lit("="), source), F.lit("-"))
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}/"), name)), 1, 8)
    return F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)


def copies(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    seed: str = SEED,
    tie: Column | None = None,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies[, tie]) for every row of ``docs``.

    ``tie`` orders rows that are alike in id, source and size; without it they are the same.

    Size is the number of words, 0 for null and blank texts; those get copies like others.
    Null is a source of its own, the last. A source without any word has target 0 and no
    copies. Rows repeated whole count each, and get equal or neighbouring numbers of
    copies. An empty table gives an empty result.

    Documents are numbered in their source by range (see ``ranked``), so a source that
    holds a third of all rows is spread over as many tasks as its rows need.
    """
    sized = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source_column).alias("source"),
        F.coalesce(F.regexp_count(text_column, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        *([] if tie is None else [tie.alias("tie")]),
    )
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.col("doc_id").asc_nulls_last()]
    order += [] if tie is None else [F.col("tie")]
    numbered = ranked(sized, order, "source")
    sources = numbered.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, weights)
    same = F.col("d.source").eqNullSafe(F.col("t.source"))
    joined = numbered.alias("d").join(targets.alias("t"), same)
    rate = F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))
    passed = F.floor(F.col("rate") * F.col("rank") + F.col("start"))
    passed_before = F.floor(F.col("rate") * (F.col("rank") - 1) + F.col("start"))
    # With rate <= MOST_COPIES only the rounding of huge ranks could pass one number more.
    emitted = F.least(F.coalesce(passed - passed_before, F.lit(0)), F.lit(MOST_COPIES))
    return (
        joined.select("d.*", "t.source_size", "t.target", rate.alias("rate"))
        .withColumn("start", random_offset(F.col("source"), seed))
        .select(
            "doc_id", "source", "size", "source_size", "target",
            emitted.cast("bigint").alias("copies"), *([] if tie is None else ["tie"]),
        )
    )


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, columns unchanged.

    Copies are decided on narrow rows, in the order of source, size, id and a digest of the
    whole row, and joined back on that digest. So a rerun takes the same rows in whatever order
    they are read. Rows that are equal as a whole are one row with the copies of all: each map
    task sends one of them.
    """
    key = "_tallygate_mix_key"
    others = [name for name in docs.columns if name != "text"]
    row = F.sha2(
        F.concat_ws(
            "/",
            F.sha2(F.coalesce("text", F.lit("")), 256),
            F.to_json(F.struct(*others, F.col("text").isNull().alias(key))),
        ),
        256,
    )
    decided = (
        copies(docs, tie=row)
        .groupBy(F.col("tie").alias(key))
        .agg(F.sum("copies").alias("_copies"))
        .where("_copies > 0")
    )
    return (
        docs.select(row.alias(key), F.struct(*docs.columns).alias("_doc"))
        .groupBy(key)
        .agg(F.first("_doc").alias("_doc"))
        .join(decided, key)
        .select("_doc", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
        .select(*[F.col(f"_doc.{name}") for name in docs.columns])
    )


def op8_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return copies(docs).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


OP8_SQL = f"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source
),
weighted AS (
  SELECT *, (place - 1) % 3 + 1 AS weight, CAST(source_size AS HUGEINT) * {MOST_COPIES} AS cap
  FROM sources
),
running AS (
  SELECT *,
         sum(source_size) OVER ()
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, place
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, place
                           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM weighted
),
level AS (
  SELECT rest, weights, cap / weight AS room, place FROM running
  WHERE rest * weight <= cap * weights ORDER BY room, place LIMIT 1
),
targets AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.cap / s.weight < l.room OR (s.cap / s.weight = l.room AND s.place < l.place)
              THEN CAST(s.cap AS DOUBLE)
              ELSE CAST(l.rest * s.weight AS DOUBLE) / CAST(l.weights AS DOUBLE) END AS target
  FROM running s CROSS JOIN level l
),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         t.target / nullif(t.source_size, 0) AS rate,
         CAST(('0x' || substr(md5('{SEED}/' || coalesce('=' || d.source, '-')), 1, 8)) AS BIGINT)
           / 4294967296.0 AS start,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id NULLS LAST) AS rank
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
),
emitted AS (
  SELECT *, least({MOST_COPIES}, CAST(coalesce(
           floor(rate * rank + start) - floor(rate * (rank - 1) + start), 0) AS BIGINT)) AS copies
  FROM placed
)
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM emitted
"""
