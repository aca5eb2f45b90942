"""URL filters: host and path rules, then a list of URLs behind a blocked Bloom filter.

Listed URLs are canonical texts. Each sets eight bits in one block of 256: the filter is a
table of blocks, looked up by a join on the block's number. Only URLs whose bits are all set
go on to the exact join with the list, which removes the false positives; the others, nearly
all, are never shuffled for it. The filter is broadcast up to a bound on its rows
(``common.small``); beyond it, Spark joins it by shuffling narrow rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallygate.llm.common import lower_ascii, small

#: Bits of filter for each listed URL; about one in a thousand others then passes.
BITS_PER_URL = 16
BLOCK_BITS = 256
LANES = 4  # words of 64 bits in a block; each URL sets two bits in each


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for URLs of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        of_host = (host == self.host) | host.endswith("." + self.host)
        return of_host & path.startswith(self.path)


# --- Fixed values: the contract's rules --------------------------------------
RULES = (
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://``, A-Z lower-cased; empty for null or without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(found, F.lit("")))


def path_of(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def canonical(url: Column) -> Column:
    """One text for the spellings of an address; null without a host.

    Scheme, default ports, fragment, trailing slashes and utm_ parameters are left out.
    """
    host = F.regexp_replace(host_of(url), r":(80|443)\z", "")
    path = F.regexp_replace(path_of(url), r"/+\z", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, r"(^|&)utm_[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    tail = F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit(""))
    return F.when(host != "", F.concat(host, path, tail))


def matching_rule(host: Column, path: Column, rules: tuple[UrlRule, ...], wanted: str) -> Column:
    """``wanted`` (name or verdict) of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        found = F.when(rule.fits(host, path), F.lit(getattr(rule, wanted))).otherwise(found)
    return found


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: Column) -> list[Column]:
    """For each lane, the two bits that a key sets."""
    bits = F.xxhash64(key, F.lit("bits"))
    one = F.lit(1).cast("bigint")

    def bit(at: int) -> Column:
        place = F.shiftright(bits, 6 * at).bitwiseAND(F.lit(63)).cast("int")
        return F.call_function("shiftleft", one, place)

    return [
        bit(2 * lane).bitwiseOR(bit(2 * lane + 1)).alias(f"mask{lane}") for lane in range(LANES)
    ]


def bloom_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, lane0..3) of the blocks that any ``canonical`` of ``listed`` sets bits in."""
    keys = listed.select(_block(F.col("canonical"), blocks).alias("block"),
                         *_masks(F.col("canonical")))
    return keys.groupBy("block").agg(
        *(F.bit_or(f"mask{lane}").alias(f"lane{lane}") for lane in range(LANES))
    )


def judged(
    pages: DataFrame,
    block_list: DataFrame,
    rules: tuple[UrlRule, ...] = RULES,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """(page_id, host, path, rule, listed, verdict) for every row of ``pages``.

    ``block_list`` has a column ``url``; what it lists is blocked, unless a rule says
    otherwise; all else is allowed. Null URLs and those without a host are never listed;
    null or repeated entries of the list count for nothing or once. Rows repeated whole are
    judged alike; an empty list blocks nothing.
    """
    listed = (
        block_list.select(canonical(F.col("url")).alias("canonical"))
        .where("canonical IS NOT NULL")
        .distinct()
    )
    blocks = max(1, -(-listed.count() * BITS_PER_URL // BLOCK_BITS))
    key = F.col("canonical")
    # URLs without a canonical text are dealt out by their id: they have to meet no one.
    block = F.coalesce(F.when(key.isNotNull(), _block(key, blocks)),
                       _block(F.coalesce(F.col("page_id").cast("string"), F.lit("")), blocks))
    urls = pages.select(F.col(id_column).alias("page_id"), F.col(url_column).alias("url"))
    parts = urls.select(
        "page_id",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        canonical(F.col("url")).alias("canonical"),
    )
    all_set = F.lit(True)
    for lane in range(LANES):
        mask = F.col(f"mask{lane}")
        all_set &= F.col(f"lane{lane}").bitwiseAND(mask) == mask
    probed = (
        parts.select("*", block.alias("block"), *_masks(key))
        .join(small(bloom_filter(listed, blocks), blocks), "block", "left")
        .select(*parts.columns,
                F.coalesce(all_set & key.isNotNull(), F.lit(False)).alias("possible"))
    )
    exact = listed.withColumn("listed", F.lit(True))
    hits = probed.where("possible").join(exact, "canonical", "left")
    others = probed.where("NOT possible").withColumn("listed", F.lit(False))
    columns = ["page_id", "host", "path", "listed"]
    host, path = F.col("host"), F.col("path")
    return (
        hits.select(*columns)
        .unionAll(others.select(*columns))
        .select(
            "page_id",
            "host",
            "path",
            matching_rule(host, path, rules, "name").alias("rule"),
            F.coalesce("listed", F.lit(False)).alias("listed"),
            matching_rule(host, path, rules, "verdict").alias("verdict"),
        )
        .withColumn(
            "verdict",
            F.coalesce("verdict", F.when(F.col("listed"), "block").otherwise(F.lit("allow"))),
        )
    )


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL judged; the list holds the URLs of the pages with an id divisible by 50."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return judged(pages, pages.where("page_id % 50 = 0").select("url"))


OP3_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_replace(regexp_replace(
           regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1),
           '(^|&)utm_[^&]*', '', 'g'), '^&+', '') AS query
  FROM pages
),
canonical AS (
  SELECT page_id, host, path,
         CASE WHEN host <> '' THEN
           regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
             || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS address
  FROM parts
),
listed AS (
  SELECT DISTINCT address FROM canonical WHERE page_id % 50 = 0 AND address IS NOT NULL
),
found AS (
  SELECT page_id, host, path, coalesce(address IN (SELECT address FROM listed), false) AS listed,
         host = 'com' OR ends_with(host, '.com') AS com,
         host = 'net' OR ends_with(host, '.net') AS net,
         host = 'example.com' OR ends_with(host, '.example.com') AS example,
         host = 'www.example.com' OR ends_with(host, '.www.example.com') AS www
  FROM canonical
),
ruled AS (
  SELECT *,
         CASE WHEN www AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN example AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN net AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN net AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN com AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM found
)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL OR listed THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
