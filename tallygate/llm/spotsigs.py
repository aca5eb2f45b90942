"""SpotSigs document fingerprints, and how alike they are.

A signature is a very common word (an anchor) with the chain of ``CHAIN`` content words that
follow it; other common words in between are stepped over. A text's fingerprint is the set of
its signatures, as sorted 32-bit numbers. The k-th anchor of a text, at word i, has i - k
content words before it, so its chain is a lookup in the list of content words and no search.

Sets of a and b signatures can be alike by min(a, b) / max(a, b) at most. Where a least
likeness is asked for, ``likeness`` puts sets into partitions by length such that two that are
more than one partition apart can not reach it, and compares only the others. ``compared``
looks at neighbouring documents, whose sets are together anyway, and asks for none: its
likenesses are exact. Everything is built-in functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallygate.llm.common import cut, ranked, small

# --- Fixed values: very common words that anchor signatures ---------------------
ANCHORS = (
    "the of and to in is that it for with on as are be was by an this at from a or have not"
    " der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch"
    " le la les de des et un une est que qui dans en pour par sur au avec ce du il elle"
    " el los las y por con para es se su al lo como del"
)
CHAIN = 2
#: Ids that are put in order together: rows of a block are sorted in one task.
BLOCK = 1024
#: Blocks of null ids have the numbers from here down; those of ids do not reach so low.
NULL_BLOCKS = -(1 << 54)


def signatures(text: str) -> str:
    """SQL for the sorted set of signatures (array of int) of the column ``text``.

    Words are runs of letters and digits, lower-cased. A text that has words but no whole
    signature gets one for all its words; a text without words (or null) has the empty set.
    """
    anchors = ", ".join(f"'{word}'" for word in sorted(set(ANCHORS.split())))
    words = f"array_remove(split(lower(coalesce({text}, '')), '[^\\\\p{{L}}\\\\p{{N}}]+'), '')"
    chain = ", ".join(f"get(p.c, a.j + {step})" for step in range(CHAIN))
    # transform(array(x), name -> ...)[0] names x, so that it is computed once.
    return f"""
      transform(
        transform(
          transform(
            array({words}),
            w -> named_struct(
              'w', w,
              'c', filter(w, x -> x NOT IN ({anchors})),
              'a', filter(transform(w, (x, i) -> named_struct('x', x, 'i', i)),
                          s -> s.x IN ({anchors})))
          ),
          p -> named_struct(
            'w', p.w,
            's', transform(
              filter(transform(p.a, (a, k) -> named_struct('x', a.x, 'j', a.i - k)),
                     a -> a.j + {CHAIN} <= size(p.c)),
              a -> hash(a.x, {chain})))
        ),
        q -> CASE WHEN size(q.s) > 0 THEN sort_array(array_distinct(q.s))
                  WHEN size(q.w) > 0 THEN array(hash(q.w))
                  ELSE cast(array() AS array<int>) END
      )[0]
    """


def fingerprint(signature_set: Column) -> Column:
    """A set as text: eight hex digits for each signature, in order."""
    digits = F.transform(signature_set, lambda s: F.lpad(F.hex(F.pmod(
        s.cast("bigint"), F.lit(1 << 32))), 8, "0"))
    return F.lower(F.array_join(digits, ""))


def length_partition(length: Column, least: float) -> Column:
    """Lengths of neighbouring partitions, or the same, may differ by a factor of 1 / least."""
    return F.floor(F.log(F.greatest(length, F.lit(1)).cast("double")) / math.log(1 / least))


def likeness(one: Column, other: Column, least: float | None = None) -> Column:
    """Jaccard likeness of two sets: 1 for two empty ones. With ``least`` it is 0, uncompared,
    where their lengths put them more than one partition apart, so that it is under that."""
    a, b = F.size(one), F.size(other)
    both = F.size(F.array_intersect(one, other)).cast("double")
    apart = F.lit(False)
    if least is not None:
        apart = F.abs(length_partition(a, least) - length_partition(b, least)) > 1
    return (
        F.when((a == 0) & (b == 0), F.lit(1.0))
        .when((a == 0) | (b == 0) | apart, F.lit(0.0))
        .otherwise(both / (a + b - both))
    )


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, sigs, next_text, next_sigs): each document beside the one after it.

    After means descending doc_id, null ids last, equal ids by text; the last is followed by
    the first. Documents are sorted in blocks of ids, a task for each. To every block the
    first document of the next lower block that has any is added at the end. Texts are
    shuffled once, to their block. Null ids are dealt to blocks by a hash of their text, as
    many as they need, and are in the order of block and hash. (Ids far apart make many blocks
    of few documents, and the added documents more; copies without an id share a block.)
    """
    text = F.coalesce("text", F.lit(""))
    nulls = docs.where("doc_id IS NULL").count()
    null_block = F.lit(NULL_BLOCKS) - F.pmod(F.xxhash64(text), F.lit(max(1, -(-nulls // BLOCK))))
    narrow = docs.select(
        F.coalesce(F.expr(f"doc_id div {BLOCK}"), null_block).alias("block"),
        "doc_id",
        text.alias("text"),
        F.when(F.col("doc_id").isNull(), F.xxhash64(text)).alias("null_at"),
    )
    heads = narrow.groupBy("block").agg(
        F.max("doc_id").alias("head"), F.min("null_at").alias("head_at")
    )
    blocks = cut(ranked(heads, [F.col("block").desc()]))
    known = blocks.count()
    count = F.lit(max(1, known))
    followers = (
        blocks.select(F.col("block").alias("to_block"), (F.col("rank") % count + 1).alias("rank"))
        .join(blocks.select("rank", "head", "head_at"), "rank")
        .select("to_block", "head", "head_at")
    )
    first = F.col("doc_id").eqNullSafe(F.col("head"))
    first &= F.col("null_at").eqNullSafe(F.col("head_at"))
    added = narrow.join(small(followers, known), first).select(
        F.col("to_block").alias("block"), "doc_id", "text", "null_at", F.lit(True).alias("added")
    )
    order = Window.partitionBy("block").orderBy(
        "added", F.col("doc_id").desc_nulls_last(), "null_at", "text"
    )
    return (
        narrow.withColumn("added", F.lit(False))
        .unionByName(added)
        .repartition("block")
        .withColumn("sigs", F.expr(signatures("text")))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_sigs", F.lead("sigs").over(order))
        .where("NOT added")
        .drop("added", "block", "null_at")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how alike they are.

    The edited text has the last half of its code points (rounded down) replaced by as many
    of the next document's first, or all of them. Null texts are empty ones. Rows repeated
    whole are documents of their own, next to each other. A single document follows itself.
    """
    half = F.expr("char_length(text) div 2")
    length = F.char_length("text")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), (length - half).cast("int")),
        F.substring(F.col("next_text"), F.lit(1), half.cast("int")),
    )
    return (
        with_next(docs)
        .select("doc_id", length.cast("bigint").alias("n_chars"), edited.alias("edited"),
                "sigs", "next_sigs")
        .withColumn("edited_sigs", F.expr(signatures("edited")))
        .select(
            "doc_id",
            "n_chars",
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            fingerprint(F.col("sigs")).alias("fingerprint"),
            fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
            likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
            likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        )
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, its edited text, and their likeness."""
    return compared(spark.read.parquet(f"{sf_dir}/documents.parquet"))
