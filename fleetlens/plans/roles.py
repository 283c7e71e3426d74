"""Generated tables in the roles of the registry's tables, each with the same view in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Product names that exercise every rule; a part takes one by its key.
NAMES = (
    "纯电动轿车", "插电式混合动力多用途乘用车", "插电式增程混合动力越野车", "燃料电池客车", "混合动力城市客车", "自卸汽车", "载货汽车底盘",
    "低平板半挂车", "正三轮载客摩托车", "纯电动厢式运输车", "汽车起重机", "随车起重运输车（底盘）", "牵引汽车", "多用途货车", "轿车",
    "非完整车辆", "修井机", "旅居装置", "电动自行车", "越野车(右舵)",
)
FUELS = ("", "汽油", "柴油", "纯电动", "汽油/电混合动力", "氢气", "电", "双燃料", "天然气")
CATALOG_ENERGY = ("", "纯电动", "插电式混合动力", "增程式", "新能源", "燃料电池", "其他")
CATEGORIES = ("", "乘用车", "客车", "载货汽车", "专用汽车", "插电式混合动力乘用车", "其他")


def _pick(values: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def _sql_pick(values: tuple[str, ...], key: str) -> str:
    return f"([{', '.join(repr(v) for v in values)}])[CAST({key} AS BIGINT) % {len(values)} + 1]"


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as the catalogue: several rows share a model code."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    return p.select(
        k.alias("id"),
        F.concat(F.upper(F.substring("p_type", 1, 2)), F.substring_index("p_brand", "#", -1), F.lit("-"), F.col("p_size")).alias("model_code"),
        (173 + F.pmod(k * 7, F.lit(240))).cast("string").alias("batch"),
        F.pmod(k * 13, F.lit(500)).cast("string").alias("seq"),
        F.col("p_brand").alias("trademark"),
        F.col("p_name").alias("common_name"),
        F.col("p_type").alias("category"),
        _pick(NAMES, k).alias("product_name"),
        _pick(FUELS, F.floor(k / 3)).alias("fuel"),
        _pick(CATALOG_ENERGY, F.floor(k / 5)).alias("energy_type"),
        _pick(CATEGORIES, F.floor(k / 7)).alias("official_category"),
        F.when(k % 11 == 0, "D").otherwise("Z").alias("tag"),
        F.when(k % 4 == 0, "").otherwise((F.col("p_size") * 10).cast("string")).alias("range_km"),
        F.col("p_retailprice").alias("price"),
    )


def dealt_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue dealt over all cores, for work that is long per row.

    part is a small file, which a scan reads as one task or a few; adaptive execution leaves
    a number of partitions that is asked for.
    """
    return catalog(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism, "id")


SQL_CATALOG = f"""catalog AS (SELECT p_partkey AS id, upper(substr(p_type, 1, 2)) || split_part(p_brand, '#', 2) || '-' || p_size AS model_code,
  CAST(173 + (p_partkey * 7) % 240 AS VARCHAR) AS batch, CAST((p_partkey * 13) % 500 AS VARCHAR) AS seq, p_brand AS trademark, p_name AS common_name, p_type AS category,
  {_sql_pick(NAMES, 'p_partkey')} AS product_name, {_sql_pick(FUELS, 'p_partkey // 3')} AS fuel, {_sql_pick(CATALOG_ENERGY, 'p_partkey // 5')} AS energy_type,
  {_sql_pick(CATEGORIES, 'p_partkey // 7')} AS official_category, CASE WHEN p_partkey % 11 = 0 THEN 'D' ELSE 'Z' END AS tag,
  CASE WHEN p_partkey % 4 = 0 THEN '' ELSE CAST(p_size * 10 AS VARCHAR) END AS range_km, p_retailprice AS price FROM part)"""


def occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products in official batches: a part in the month of an order; months count from 1995 on."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", ((F.year("o_orderdate") - 1995) * 12 + F.month("o_orderdate")).cast("bigint").alias("batch"))
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("product"))
    return li.join(o, "o_orderkey").select("product", "batch", F.col("o_orderstatus").alias("status"))


SQL_OCCURRENCES = """occurrences AS (SELECT l_partkey AS product, CAST((year(o_orderdate) - 1995) * 12 + month(o_orderdate) AS BIGINT) AS batch, o_orderstatus AS status
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a run ledger: an outcome per user and day, runs in time order."""
    status = F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.get_json_object("props", "$.k").cast("int") % len(OUTCOMES)) + 1)
    return table(spark, sf_dir, "events").select(
        F.concat_ws("-", "user_id", F.dayofmonth("ts")).alias("key"), F.col("event_id").alias("run_id"), status.alias("status"), "user_id", "ts", "event_type", "value"
    )


OUTCOMES = ("querying", "query_failed", "no_match", "interrupted", "partial", "awaiting_effective", "done", "skipped")
SQL_RUNS = f"""runs AS (SELECT user_id || '-' || day(ts) AS key, event_id AS run_id,
  ([{', '.join(map(repr, OUTCOMES))}])[CAST(json_extract_string(props, '$.k') AS INTEGER) % {len(OUTCOMES)} + 1] AS status, user_id, ts, event_type, value FROM events)"""

SQL_RANK = "CASE status WHEN 'done' THEN 5 WHEN 'partial' THEN 4 WHEN 'no_match' THEN 3 WHEN 'awaiting_effective' THEN 3 WHEN 'query_failed' THEN 2 WHEN 'interrupted' THEN 2 WHEN 'querying' THEN 1 ELSE 0 END"


def sql_regex(words: dict | tuple) -> str:
    return "|".join(words)
