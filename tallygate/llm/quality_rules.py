"""Quality rules: a table of thresholds compiled into one projection.

Every measure is made of built-in functions over the text's own words and lines, so the
operator is a map over the rows: no shuffle, no user function, nothing that depends on
other documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import WORD

# --- Fixed values: very common words of the languages looked at -------------
STOP_WORDS = {
    "en": "the of and to in is that it for with on as are be was by an this at from",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "fr": "le la les de des et un une est que qui dans en pour par sur au avec ce du",
    "es": "el la los las y de que en un una por con para es se su al lo como del",
}
SYMBOLS = "#*$%&|<>"
#: Base rules of the contract: fewer words fail, and a larger percentage of repeated ones.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``measure`` (SQL over the measures) must lie in [least, most]; None: no bound."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None

    def broken(self) -> Column:
        """True if out of bounds; a measure that is null (no words, no lines) breaks nothing."""
        value = F.expr(self.measure)
        out = F.lit(False)
        if self.least is not None:
            out |= value < F.lit(float(self.least))
        if self.most is not None:
            out |= value > F.lit(float(self.most))
        return F.coalesce(out, F.lit(False))


#: The method's own thresholds. Names of measures are those of ``measures``.
RULES = (
    Rule("word_length", "word_chars / nullif(n_words, 0)", least=1.5, most=20),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", most=0.1),
    Rule("stop_words", "n_stop_words / nullif(n_words, 0)", least=0.02),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", most=0.7),
)


def _stop_word_list() -> list[str]:
    return sorted({word for words in STOP_WORDS.values() for word in words.split()})


def _repeated_positions(words: str) -> str:
    """SQL: where 3-word windows stand that occur again in the text, in order.

    Windows are sorted with their places; equal ones are then neighbours.
    """
    count = f"greatest(size({words}) - 2, 0)"  # of windows
    windows = f"""
        slice(arrays_zip(slice({words}, 1, {count}), slice({words}, 2, {count}),
                         slice({words}, 3, {count}), sequence(1, greatest({count}, 1))),
              1, {count})
    """
    return f"""
        sort_array(array_distinct(flatten(transform(
          filter(
            transform(array(sort_array({windows})),
                      s -> arrays_zip(s, slice(s, 2, greatest(size(s), 1))))[0],
            p -> p.s['0'] = p['1']['0'] AND p.s['1'] = p['1']['1'] AND p.s['2'] = p['1']['2']
          ),
          p -> array(p.s['3'], p['1']['3'])
        ))))
    """


def measures(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for every row of ``docs``: its id and what the rules look at.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word),
    n_dup_lines (those equal to an earlier one), n_repeat_words (words in 3-word windows
    that the text has twice or more), n_stop_words. All are 0 for null and blank texts.
    """
    blank = "concat(' ', char(9), char(10), char(11), char(12), char(13))"
    stop = ", ".join(f"'{word}'" for word in _stop_word_list())
    values = {
        "n_words": "size(words)",
        "word_chars": f"char_length(translate(text, {blank}, ''))",
        "n_symbols": f"char_length(text) - char_length(translate(text, '{SYMBOLS}', ''))",
        "n_lines": "size(lines)",
        "n_dup_lines": "size(lines) - size(array_distinct(lines))",
        # A window covers three words, or as many as there are up to the next one.
        "n_repeat_words": "aggregate(zip_with(places, slice(places, 2, greatest(size(places), 1)),"
        " (a, b) -> least(3, coalesce(b - a, 3))), 0, (s, x) -> s + x)",
        "n_stop_words": f"size(filter(words, x -> lower(x) IN ({stop})))",
    }
    # Filters do not cross the inline, so no measure is computed again for one.
    return (
        docs.select(
            F.col(id_column).alias("doc_id"), F.coalesce(text_column, F.lit("")).alias("text")
        )
        .select(
            "*",
            F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
            F.expr(f"filter(split(text, char(10)), x -> btrim(x, {blank}) <> '')").alias("lines"),
        )
        .select("*", F.expr(_repeated_positions("words")).alias("places"))
        .select("doc_id", F.inline(F.array(F.struct(*(F.expr(v).cast("bigint").alias(k)
                                                      for k, v in values.items())))))
    )


def verdicts(
    docs: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The measures of every row, ``base_failed``, the names of broken ``rules``, and ``kept``.

    Each row is judged by itself: repeated rows get equal rows, an empty table none.
    """
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    broken = F.array_compact(F.array(*(F.when(r.broken(), F.lit(r.name)) for r in rules)))
    return measures(docs, id_column, text_column).select(
        "*",
        failed.alias("base_failed"),
        F.concat_ws(",", broken).alias("broken_rules"),
        (~failed & (F.size(broken) == 0)).alias("kept"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, columns unchanged. Decided in the row's own map task."""
    whole = docs.select(F.struct("*").alias("_row"), F.col("text").alias("_text"))
    judged = verdicts(whole, rules, "_row", "_text")
    return judged.where("kept").select("doc_id.*")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return verdicts(docs)


OP4_SQL = f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t FROM documents
),
w AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)),
                     lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM d
),
p AS (
  SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS i FROM w
),
windows AS (
  SELECT doc_id, i, x,
         lead(x, 1) OVER (PARTITION BY doc_id ORDER BY i) AS y,
         lead(x, 2) OVER (PARTITION BY doc_id ORDER BY i) AS z
  FROM p
),
again AS (
  SELECT doc_id, i
  FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM windows
        WHERE z IS NOT NULL)
  WHERE n > 1
),
covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM again)
  GROUP BY doc_id
),
m AS (
  SELECT doc_id,
         CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(len(list_filter(ws, lambda x: lower(x) IN
              ({", ".join(f"'{word}'" for word in _stop_word_list())}))) AS BIGINT)
           AS n_stop_words
  FROM w LEFT JOIN covered USING (doc_id)
),
judged AS (
  SELECT *,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words
           AS base_failed,
         concat_ws(',',
           CASE WHEN word_chars / nullif(n_words, 0) < 1.5
                  OR word_chars / nullif(n_words, 0) > 20 THEN 'word_length' END,
           CASE WHEN n_symbols / nullif(n_words, 0) > 0.1 THEN 'symbols' END,
           CASE WHEN n_stop_words / nullif(n_words, 0) < 0.02 THEN 'stop_words' END,
           CASE WHEN n_dup_lines / nullif(n_lines, 0) > 0.7 THEN 'repeated_lines' END
         ) AS broken_rules
  FROM m
)
SELECT *, NOT base_failed AND broken_rules = '' AS kept FROM judged
"""
