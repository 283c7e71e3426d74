"""URL filters: captures against the list entries active when they were fetched.

A list entry (kind, key, verdict, listed) says from its date on what holds for a host,
a domain with all below it, or a path under a host: ``block``, ``allow`` or ``none``
(taken off the list). It stays valid until the key's next entry, so the dated entries
become intervals that don't overlap. A capture has one key for its host, one for each
domain above, one for each folder of its path. Captures with one url and fetch time are
one, and so are keys with one fetch time; an as-of join (the union of intervals and
points in time order, the last interval carried on) finds the interval that each key and
time stands in. So a domain over a third of all captures is one row per fetch time, and
many dated entries of one key never multiply with its captures. Of several active
entries the most specific decides (path over host over domain, then the longest key),
and only ``block`` and ``allow`` count.

Cases: columns of captures with the name of a result column are returned with ``_before``
behind their names; a null or malformed url has no keys and no verdict; a capture without a fetch
time meets nothing; of two entries for a key with one date the verdict that comes first
in the alphabet (allow, block, none) is taken; repeated captures are judged one by one;
entries with null keys or dates are void; empty tables work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import materialize, named, table

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#@]+)"
PATH = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def keys_of(url: Column) -> Column:
    """Structs (kind, key) that list entries for this url can have."""
    host, path = host_of(url), F.regexp_extract(url, PATH, 1)
    labels, folders = F.split(host, r"\."), F.split(path, "/")

    def keys(kind: str, values: Column) -> Column:
        return F.transform(values, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    above = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    under = F.transform(F.sequence(F.lit(2), F.greatest(F.lit(2), F.size(folders))), lambda i: F.concat(host, F.array_join(F.slice(folders, 1, i - 1), "/"), F.lit("/")))
    under = F.when(F.size(folders) > 1, F.array_distinct(under)).otherwise(F.array().cast("array<string>"))
    all_keys = F.concat(keys("host", F.array(host)), keys("domain", above), keys("path", under))
    return F.when(host != "", all_keys).otherwise(F.array().cast("array<struct<kind:string,key:string>>"))


def intervals(entries: DataFrame) -> DataFrame:
    """Entries (kind, key, verdict, listed) as valid_from (inclusive) and valid_to (exclusive, null: open)."""
    one = entries.where("kind is not null and key is not null and verdict is not null and listed is not null").groupBy("kind", "key", "listed").agg(F.min("verdict").alias("verdict"))
    later = Window.partitionBy("kind", "key").orderBy("listed")
    return one.select("kind", "key", "verdict", F.col("listed").alias("valid_from"), F.lead("listed").over(later).alias("valid_to")).where("verdict <> 'none'")


def _as_of(points: DataFrame, valid: DataFrame) -> DataFrame:
    """Points (kind, key, at) that stand in an interval, with its verdict and valid_from."""
    interval = F.struct("verdict", "valid_from", "valid_to")
    starts = valid.select("kind", "key", F.col("valid_from").alias("at"), interval.alias("i"), F.lit(0).alias("point"))
    both = starts.unionByName(points.select("kind", "key", "at", F.lit(None).cast(starts.schema["i"].dataType).alias("i"), F.lit(1).alias("point")))
    upto = Window.partitionBy("kind", "key").orderBy("at", "point").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("i", F.last("i", ignorenulls=True).over(upto)).where("point = 1 and i is not null")
    return carried.where("i.valid_to is null or at < i.valid_to").select("kind", "key", "at", "i.verdict", "i.valid_from")


def judge(captures: DataFrame, entries: DataFrame, *, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """All captures with verdict (block, allow or none) and the deciding entry (kind, key, listed)."""
    keyed = captures.select(named(url).alias("url"), named(fetched).alias("at")).where("url is not null and at is not null").distinct()
    keyed = keyed.withColumn("k", F.explode(keys_of(F.col("url")))).select("url", "at", "k.kind", "k.key")
    # written, so that the join below deals its rows by key and time and can split a hot one
    active = materialize(_as_of(keyed.select("kind", "key", "at").distinct(), intervals(entries)), "url-active")
    valid = keyed.join(active, ["kind", "key", "at"])
    rank = F.when(F.col("kind") == "path", 3).when(F.col("kind") == "host", 2).otherwise(1)
    best = valid.groupBy("url", "at").agg(
        F.max(F.struct(rank.alias("rank"), F.length("key").alias("size"), F.col("kind"), F.col("key"), F.col("verdict"), F.col("valid_from"))).alias("best")
    )
    names = {}  # a column with a result's name gets another that nothing has
    for c in captures.columns:
        new = c
        while new in ("verdict", "rule_kind", "rule_key", "listed") or (new != c and new in captures.columns) or new in names.values():
            new += "_before"
        names[c] = new
    kept = captures.select(F.struct(*(named(c).alias(f"c{k}") for k, c in enumerate(captures.columns))).alias("__capture"), named(url).alias("__url"), named(fetched).alias("__at"))
    joined = kept.join(best.withColumnsRenamed({"url": "__best_url", "at": "__best_at"}), (F.col("__url") == F.col("__best_url")) & (F.col("__at") == F.col("__best_at")), "left")
    return joined.select(
        *(F.col("__capture")[f"c{k}"].alias(names[c]) for k, c in enumerate(captures.columns)),
        F.coalesce(F.col("best.verdict"), F.lit("none")).alias("verdict"),
        F.col("best.kind").alias("rule_kind"),
        F.col("best.key").alias("rule_key"),
        F.col("best.valid_from").alias("listed"),
    )


def _day(text: Column, salt: str, days: int) -> Column:
    """A day number below ``days`` that the text alone decides."""
    return (F.conv(F.substring(F.md5(F.concat(F.lit(salt), text)), 1, 6), 16, 10).cast("bigint") % days).cast("int")


def sample_list(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of ``pages``: each host is blocked, some are let go, blocked again or allowed below a path.

    The tables hold no list of their own; dates and verdicts follow from digests of
    the names, so SQL can make the same list. It has a few entries per host.
    """
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct()
    start = F.lit("2024-01-01").cast("date")

    def entry(kind: str, key: Column, verdict: str, salt: str, days: int, share: int) -> DataFrame:
        chosen = hosts.where(_day(F.col("host"), salt + "?", 100) < share)
        return chosen.select(F.lit(kind).alias("kind"), key.alias("key"), F.lit(verdict).alias("verdict"), F.date_add(start, _day(F.col("host"), salt, days)).alias("listed"))

    host = F.col("host")
    parts = (
        entry("host", host, "block", "a", 200, 70),
        entry("host", host, "none", "b", 300, 40),
        entry("host", host, "block", "c", 360, 20),
        entry("path", F.concat(host, F.lit("/en/")), "allow", "d", 300, 50),
        entry("path", F.concat(host, F.lit("/de/")), "block", "e", 300, 30),
        entry("domain", F.regexp_replace(host, r"^[^.]+\.", ""), "block", "f", 360, 15),
    )
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # pages carry no fetch time: day page_id mod 365 of 2024
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(365)).cast("int")))
    return judge(captures, sample_list(pages)).select("page_id", "fetched", "verdict", "rule_kind", "rule_key", "listed")


def _sql() -> str:
    def day(salt: str, days: int) -> str:
        return f"CAST(('0x' || substr(md5('{salt}' || host), 1, 6))::BIGINT % {days} AS INTEGER)"

    def entry(kind: str, key: str, verdict: str, salt: str, days: int, share: int) -> str:
        return f"SELECT '{kind}' AS kind, {key} AS key, '{verdict}' AS verdict, DATE '2024-01-01' + {day(salt, days)} AS listed FROM hosts WHERE {day(salt + '?', 100)} < {share}"

    parts = "\n  UNION ALL ".join(
        (
            entry("host", "host", "block", "a", 200, 70),
            entry("host", "host", "none", "b", 300, 40),
            entry("host", "host", "block", "c", 360, 20),
            entry("path", "host || '/en/'", "allow", "d", 300, 50),
            entry("path", "host || '/de/'", "block", "e", 300, 30),
            entry("domain", r"regexp_replace(host, '^[^.]+\.', '')", "block", "f", 360, 15),
        )
    )
    return rf"""
WITH captures AS (SELECT row_number() OVER () AS r, page_id, url, DATE '2024-01-01' + CAST(page_id % 365 AS INTEGER) AS fetched,
  regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '\.$', '') AS host, string_split(regexp_extract(url, '{PATH}', 1), '/') AS folders FROM pages),
hosts AS (SELECT DISTINCT host FROM captures WHERE host <> ''),
entries AS ({parts}),
one AS (SELECT kind, key, listed, min(verdict) AS verdict FROM entries GROUP BY ALL),
valid AS (SELECT kind, key, verdict, listed, lead(listed) OVER (PARTITION BY kind, key ORDER BY listed) AS until FROM one),
keys AS (
  SELECT r, fetched, 'host' AS kind, host AS key FROM captures WHERE host <> ''
  UNION ALL SELECT r, fetched, 'domain', unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) FROM captures WHERE host <> ''
  UNION ALL SELECT r, fetched, 'path', unnest(list_distinct(list_transform(range(2, len(folders) + 1), lambda i: host || array_to_string(folders[1:i-1], '/') || '/'))) FROM captures WHERE host <> '' AND len(folders) > 1),
active AS (SELECT k.r, v.kind, v.key, v.verdict, v.listed, row_number() OVER (PARTITION BY k.r ORDER BY CASE v.kind WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(v.key) DESC, v.key DESC) AS place
  FROM keys k JOIN valid v ON k.kind = v.kind AND k.key = v.key AND v.listed <= k.fetched AND (v.until IS NULL OR k.fetched < v.until) WHERE v.verdict <> 'none')
SELECT c.page_id, c.fetched, coalesce(a.verdict, 'none') AS verdict, a.kind AS rule_kind, a.key AS rule_key, a.listed
FROM captures c LEFT JOIN active a ON a.r = c.r AND a.place = 1
"""


QUERIES = {"op9_url_filter": op9_url_filter}
ORACLES = {"op9_url_filter": _sql()}
