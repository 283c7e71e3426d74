"""Catalogue queries: search, export, latest rows, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules, text, values
from ..operators import latest, reconcile
from .roles import SQL_CATALOG, catalog


def catalog_search_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    hit = F.col("model_code").ilike("%s%") & (F.col("common_name").ilike("%RED%") | F.col("trademark").ilike("%#1%") | F.col("category").ilike("%promo%"))
    return c.where(hit).orderBy(values.text_int(F.col("batch")).desc(), "category", values.text_int(F.col("seq")), "id").limit(50).select("id", "model_code", "batch", "category", "seq")


def catalog_export_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).where(F.col("common_name").ilike("%blue%") | F.col("model_code").ilike("%blue%") | F.col("category").ilike("%blue%"))
    return c.select(
        F.row_number().over(Window.partitionBy("category").orderBy(values.text_int(F.col("batch")).desc(), values.text_int(F.col("seq")), "model_code", "id")).cast("bigint").alias("place"),
        "category", "batch", "seq", "model_code", "id",
    )


def export_by_category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    group = F.coalesce(rules.category(F.col("official_category")), F.lit("other"))
    return catalog(spark, sf_dir).groupBy(group.alias("category_group")).agg(F.count("*").alias("n"), F.countDistinct("model_code").alias("models"))


def prefix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    return c.where(rules.matches_prefixes(F.col("model_code"), ["st", "LA", "pr1"], ["ST2", "pr11-3"]) & F.contains("common_name", F.lit("e"))).select("id", "model_code")


def latest_batch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_batch_rows(catalog(spark, sf_dir), "batch").select("id", "batch")


def latest_per_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_per_key(catalog(spark, sf_dir), ["model_code"], [values.text_int(F.col("batch")).desc(), F.col("id").asc()]).select("model_code", "id", "batch")


def latest_per_model_tie_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.latest_per_key(catalog(spark, sf_dir), ["category"], [values.text_int(F.col("batch")).desc(), F.col("id").desc()]).select("category", "id", "batch")


def candidates_not_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("batch", values.text_int(F.col("batch")))
    known = c.where("id % 3 = 0").select("model_code")
    rank = F.when(F.col("category") == "PROMO", 0).when(F.col("category") == "SMALL", 1).otherwise(2)
    return reconcile.candidates(c, known, [F.col("batch").desc(), rank, values.text_int(F.col("seq")), F.col("id")], offset=10, limit=40).select("id", "model_code", "batch", "category")


def gap_dedupe_by_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("b", values.text_int(F.col("batch")))
    covered = c.where("id % 2 = 0").select("model_code").distinct()
    gap = c.join(covered, "model_code", "left_anti")
    return gap.groupBy("model_code").agg(
        F.max(F.struct("b", (-F.col("id")).alias("i"), "product_name"))["product_name"].alias("product_name"), F.countDistinct("b").alias("batches"), F.min("b").alias("first_batch"), F.max("b").alias("last_batch")
    )


def catalog_supplement(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("o1", F.when(F.col("category") == "LARGE", 0).otherwise(1)).withColumn("o2", -values.text_int(F.col("batch")))
    return latest.first_filled_per_key(c, ["model_code"], ["o1", "o2", "id"], ["range_km", "energy_type", "fuel"])


def catalog_energy_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    specific = F.col("energy_type").isin(*rules.NEV)
    return latest.specific_energy(catalog(spark, sf_dir), "model_code", "id", "energy_type", specific)


def scope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rules.scope(F.col("product_name"), F.col("official_category"), F.col("tag"))
    return catalog(spark, sf_dir).select("id", s["gate"].alias("gate"), s["reason"].alias("reason"))


def energy_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rules.energy(F.col("fuel"), F.col("product_name"), F.col("model_code"), F.col("energy_type"))
    return catalog(spark, sf_dir).select("id", e["energy"].alias("energy"), e["source"].alias("source"))


def channel_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = rules.channel(F.col("model_code"), F.col("product_name"), F.col("official_category"), F.col("energy_type"))
    return catalog(spark, sf_dir).select("id", c["channel"].alias("channel"), c["code"].alias("code"))


def energy_scope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("e", rules.energy(F.col("fuel"), F.col("product_name"), F.col("model_code"), F.col("energy_type"))["energy"])
    gate = rules.scope(F.col("product_name"), F.col("official_category"), F.col("tag"))["gate"]
    return c.select("id", rules.energy_group(F.col("e")).alias("energy_group"), rules.energy_scope(F.col("e"), F.col("batch")).alias("scope"), rules.inventory_group(gate, F.col("e"), F.col("batch")).alias("grp"), rules.band(F.col("batch")).alias("band"))


def universe_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("e", rules.energy(F.col("fuel"), F.col("product_name"), F.col("model_code"), F.col("energy_type"))["energy"])
    gate = rules.scope(F.col("product_name"), F.col("official_category"), F.col("tag"))["gate"]
    u = c.select(rules.inventory_group(gate, F.col("e"), F.col("batch")).alias("grp"), rules.band(F.col("batch")).alias("band"), F.col("category").alias("state"))
    u.createOrReplaceTempView("__universe")
    return spark.sql("SELECT grp, band, state, count(*) AS n FROM __universe GROUP BY GROUPING SETS ((grp, state), (grp, band, state), (grp))")


def in_scope_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("e", rules.energy(F.col("fuel"), F.col("product_name"), F.col("model_code"), F.col("energy_type"))["energy"])
    gate = rules.scope(F.col("product_name"), F.col("official_category"), F.col("tag"))["gate"]
    u = c.select(rules.inventory_group(gate, F.col("e"), F.col("batch")).alias("grp"), "category")
    states = [F.count_if(F.col("category") == s.upper()).alias(s) for s in ("economy", "large", "promo")]
    totals = u.groupBy("grp").agg(F.count("*").alias("total"), *states)
    # reads the total, so that the filter isn't pushed below and the rules evaluated twice
    return totals.where(F.when(F.col("grp").isin(*rules.IN_SCOPE), F.col("total")).otherwise(0) > 0)


def multi_label_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    tags = F.array_compact(F.array(*(F.when(F.contains("product_name", F.lit(w)), F.lit(w)) for w in ("电", "混合", "货", "客", "车"))))
    return c.withColumn("tag_", F.explode(tags)).groupBy(F.col("tag_").alias("label")).agg(F.count("*").alias("n"), F.countDistinct("model_code").alias("models"))


def prefix_suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    return c.groupBy("trademark").agg(F.array_join(F.array_sort(F.collect_set(text.prefix_of_code(F.col("model_code")))), ",").alias("prefixes"))


def carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("filled", F.when(F.col("id") % 5 == 0, F.col("common_name")).otherwise(""))
    return latest.carry_forward(c, ["category"], ["id"], ["filled"]).select("id", "category", "filled")


def display_name_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest.numbered_names(catalog(spark, sf_dir), ["category"], "common_name", ["id"], "shown").select("id", "shown")


def sequence_synthesis(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).withColumn("seq", F.when(F.col("id") % 3 == 0, "").otherwise(F.col("seq")))
    return latest.synthesised_sequence(c, ["trademark"], ["id"], "seq").select("id", "seq")


def keyword_union_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    scans = [c.where(F.contains("common_name", F.lit(w))).withColumn("ordinal", F.lit(i) * 1_000_000_000 + F.col("id")).withColumn("keyword", F.lit(w)) for i, w in enumerate(("red", "bolt", "small"))]
    every = scans[0].unionByName(scans[1]).unionByName(scans[2])
    return latest.first_seen(every, "model_code", "ordinal").select("model_code", "keyword", "id")


def common_name_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog(spark, sf_dir).groupBy("trademark").agg(F.array_join(F.array_sort(F.array_distinct(F.collect_list("common_name"))), "|").alias("names"), F.min("price").alias("low_price"))


def batch_interval_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = values.digits_int(F.col("batch"))
    agg = catalog(spark, sf_dir).groupBy("category").agg(F.min(b).alias("lo"), F.max(b).alias("hi"))
    return agg.select("category", F.when(F.col("lo") == F.col("hi"), F.col("lo").cast("string")).otherwise(F.concat_ws("-", "lo", "hi")).alias("label"))


_T = "coalesce(TRY_CAST(regexp_extract(batch, '^\\s*([+-]?[0-9]+)', 1) AS BIGINT), 0)"
_S = "coalesce(TRY_CAST(regexp_extract(seq, '^\\s*([+-]?[0-9]+)', 1) AS BIGINT), 0)"

_KEY = " ".join(f"WHEN contains({{t}}, '{w}') THEN '{v}'" for w, v in rules.ENERGY_KEYWORDS)
_PLUG = " ".join(f"WHEN contains({{t}}, '{w}') THEN '{v}'" for w, v in rules.ENERGY_KEYWORDS if v in rules.PLUG_IN)
_FUEL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.FUELS.items())
_ALIAS = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.CATEGORY_ALIASES.items())
_CHANNEL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in rules.CHANNELS.items())
SQL_RULES = SQL_CATALOG + f""",
base AS (SELECT *, regexp_replace(product_name, '[（(][^()（）]*[)）]', '', 'g') AS short, CASE official_category {_ALIAS} END AS cat, product_name || ' ' || model_code AS txt FROM catalog),
told AS (SELECT *, CASE fuel {_FUEL} END AS exact, CASE {_PLUG.format(t='txt')} END AS plug, CASE {_PLUG.format(t='energy_type')} END AS hinted, CASE {_KEY.format(t='txt')} END AS said,
  CASE {_KEY.format(t='energy_type')} END AS cat_said, contains(fuel, '混合动力') OR contains(fuel, '双燃料') AS hybrid FROM base),
ruled AS (SELECT *,
  CASE WHEN regexp_matches(product_name, '{rules.NON_ROAD_ANYWHERE}') OR regexp_matches(short, '{rules.NON_ROAD_TAIL}') THEN 'excluded'
    WHEN regexp_matches(product_name, '{rules.PART_ANYWHERE}') OR regexp_matches(short, '{rules.PART_TAIL}') OR tag = 'D' THEN 'excluded'
    WHEN regexp_matches(short, '{rules.WHOLE_TAIL}') OR cat IS NOT NULL THEN 'accepted' ELSE 'pending_review' END AS gate,
  CASE WHEN regexp_matches(product_name, '{rules.NON_ROAD_ANYWHERE}') OR regexp_matches(short, '{rules.NON_ROAD_TAIL}') THEN 'non_automotive'
    WHEN regexp_matches(product_name, '{rules.PART_ANYWHERE}') OR regexp_matches(short, '{rules.PART_TAIL}') OR tag = 'D' THEN 'incomplete_vehicle_or_component'
    WHEN regexp_matches(short, '{rules.WHOLE_TAIL}') THEN 'official_complete_vehicle_name' WHEN cat IS NOT NULL THEN 'official_catalog_category' ELSE 'insufficient_scope_evidence' END AS reason,
  CASE WHEN exact IS NOT NULL THEN exact WHEN hybrid AND plug IS NOT NULL THEN plug WHEN hybrid AND hinted IS NOT NULL THEN hinted WHEN hybrid THEN '混合动力'
    WHEN said = '混合动力' AND hinted IS NOT NULL THEN hinted WHEN said IS NOT NULL THEN said WHEN cat_said IS NOT NULL THEN cat_said WHEN energy_type = '新能源' THEN '未知' WHEN fuel <> '' THEN '燃油' ELSE '未知' END AS energy,
  CASE WHEN exact IS NOT NULL THEN 'fuel_type' WHEN hybrid AND plug IS NOT NULL THEN 'fuel_type+product_name' WHEN hybrid AND hinted IS NOT NULL THEN 'fuel_type+jianmian' WHEN hybrid THEN 'fuel_type'
    WHEN said = '混合动力' AND hinted IS NOT NULL THEN 'product_name+jianmian' WHEN said IS NOT NULL THEN 'product_name' WHEN cat_said IS NOT NULL THEN 'jianmian' WHEN energy_type = '新能源' THEN 'jianmian' WHEN fuel <> '' THEN 'fuel_type' ELSE 'none' END AS source,
  regexp_extract(model_code, '^[A-Z]+([0-9])', 1) AS code FROM told),
scoped AS (SELECT *, CASE WHEN energy IN ('纯电动', '插电式混合动力', '增程式', '燃料电池') THEN 'nev' WHEN CAST(batch AS BIGINT) >= 408 THEN 'non_nev_batch' WHEN energy IN ('燃油', '混合动力') THEN 'outside' ELSE 'needs_nev_evidence' END AS scope,
  CASE WHEN CAST(batch AS BIGINT) >= 408 THEN '408+' WHEN CAST(batch AS BIGINT) BETWEEN 173 AND 299 THEN '173-299' WHEN CAST(batch AS BIGINT) BETWEEN 300 AND 349 THEN '300-349'
    WHEN CAST(batch AS BIGINT) BETWEEN 350 AND 399 THEN '350-399' WHEN CAST(batch AS BIGINT) BETWEEN 400 AND 407 THEN '400-407' ELSE 'other' END AS band FROM ruled),
grouped AS (SELECT *, CASE WHEN gate = 'excluded' THEN 'excluded' WHEN gate = 'pending_review' THEN 'scope_review' WHEN scope = 'nev' THEN 'nev' WHEN scope = 'non_nev_batch' AND energy IN ('燃油', '混合动力') THEN 'fuel_authorized'
  WHEN scope = 'non_nev_batch' THEN 'unknown_authorized' WHEN scope = 'outside' THEN 'fuel_outside' ELSE 'unknown_energy_outside' END AS grp FROM scoped)
"""

W = "WITH " + SQL_CATALOG
ORACLES = {
    "catalog_search_topk": f"{W} SELECT id, model_code, batch, category, seq FROM catalog WHERE model_code ILIKE '%s%' AND (common_name ILIKE '%red%' OR trademark ILIKE '%#1%' OR category ILIKE '%promo%') ORDER BY {_T} DESC, category, {_S}, id LIMIT 50",
    "catalog_export_sorted": f"{W} SELECT row_number() OVER (PARTITION BY category ORDER BY {_T} DESC, {_S}, model_code, id) AS place, category, batch, seq, model_code, id FROM catalog WHERE common_name ILIKE '%blue%' OR model_code ILIKE '%blue%' OR category ILIKE '%blue%'",
    "export_by_category_counts": f"{W} SELECT coalesce(CASE official_category {_ALIAS} END, 'other') AS category_group, count(*) AS n, count(DISTINCT model_code) AS models FROM catalog GROUP BY 1",
    "prefix_filter": f"{W} SELECT id, model_code FROM catalog WHERE (starts_with(model_code, 'ST') OR starts_with(model_code, 'LA') OR starts_with(model_code, 'PR1')) AND NOT starts_with(model_code, 'ST2') AND NOT starts_with(model_code, 'PR11-3') AND contains(common_name, 'e')",
    "latest_batch_rows": f"{W} SELECT id, batch FROM catalog WHERE CAST(batch AS BIGINT) = (SELECT max(CAST(batch AS BIGINT)) FROM catalog)",
    "latest_per_model": f"{W} SELECT model_code, id, batch FROM catalog QUALIFY row_number() OVER (PARTITION BY model_code ORDER BY {_T} DESC, id) = 1",
    "latest_per_model_tie_desc": f"{W} SELECT category, id, batch FROM catalog QUALIFY row_number() OVER (PARTITION BY category ORDER BY {_T} DESC, id DESC) = 1",
    "candidates_not_existing": f"{W} SELECT id, model_code, {_T} AS batch, category FROM (SELECT * FROM catalog c WHERE NOT EXISTS (SELECT 1 FROM catalog k WHERE k.id % 3 = 0 AND k.model_code = c.model_code) QUALIFY row_number() OVER (PARTITION BY model_code ORDER BY {_T} DESC, id) = 1) ORDER BY {_T} DESC, CASE category WHEN 'PROMO' THEN 0 WHEN 'SMALL' THEN 1 ELSE 2 END, {_S}, id LIMIT 40 OFFSET 10",
    "gap_dedupe_by_model": f"{W}, gap AS (SELECT *, {_T} AS b FROM catalog WHERE model_code NOT IN (SELECT model_code FROM catalog WHERE id % 2 = 0)) SELECT model_code, arg_max(product_name, b * 1000000000 - id) AS product_name, count(DISTINCT b) AS batches, min(b) AS first_batch, max(b) AS last_batch FROM gap GROUP BY 1",
    "catalog_supplement": f"{W}, o AS (SELECT *, row_number() OVER (PARTITION BY model_code ORDER BY CASE WHEN category = 'LARGE' THEN 0 ELSE 1 END, -{_T}, id) AS k FROM catalog) SELECT model_code, arg_min(range_km, k) FILTER (range_km <> '') AS range_km, arg_min(energy_type, k) FILTER (energy_type <> '') AS energy_type, arg_min(fuel, k) FILTER (fuel <> '') AS fuel FROM o GROUP BY 1",
    "catalog_energy_pick": f"{W} SELECT model_code, arg_min(energy_type, CASE WHEN energy_type IN ('纯电动', '插电式混合动力', '增程式', '燃料电池') THEN 0 ELSE 1000000000 END + id) FILTER (energy_type <> '') AS energy_type FROM catalog GROUP BY 1",
    "scope_rules": f"WITH {SQL_RULES} SELECT id, gate, reason FROM grouped",
    "energy_rules": f"WITH {SQL_RULES} SELECT id, energy, source FROM grouped",
    "channel_rules": f"""WITH {SQL_RULES} SELECT id, code, CASE WHEN CASE cat {_CHANNEL} END IS NOT NULL THEN CASE cat {_CHANNEL} END WHEN regexp_matches(product_name, '乘用车|轿车') THEN 'passenger' WHEN code = '5' THEN 'special'
  WHEN contains(product_name, '客车') THEN 'bus' WHEN regexp_matches(product_name, '货车|载货汽车|自卸汽车|牵引车') THEN 'truck' WHEN code IN ('7', '2', '6') THEN 'passenger' WHEN code IN ('1', '3', '4') THEN 'truck' ELSE 'special' END AS channel FROM grouped""",
    "energy_scope_rules": f"WITH {SQL_RULES} SELECT id, CASE WHEN energy IN ('纯电动', '插电式混合动力', '增程式', '燃料电池') THEN 'NEV' WHEN energy IN ('燃油', '混合动力') THEN 'fuel' END AS energy_group, scope, grp, band FROM grouped",
    "universe_counts": f"WITH {SQL_RULES} SELECT grp, band, category AS state, count(*) AS n FROM grouped GROUP BY GROUPING SETS ((grp, category), (grp, band, category), (grp))",
    "in_scope_totals": f"WITH {SQL_RULES} SELECT grp, count(*) AS total, count(*) FILTER (category = 'ECONOMY') AS economy, count(*) FILTER (category = 'LARGE') AS large, count(*) FILTER (category = 'PROMO') AS promo FROM grouped WHERE grp IN ('nev', 'fuel_authorized', 'unknown_authorized') GROUP BY 1",
    "multi_label_explode": f"{W}, t AS (SELECT model_code, unnest(list_filter(['电', '混合', '货', '客', '车'], lambda w: contains(product_name, w))) AS label FROM catalog) SELECT label, count(*) AS n, count(DISTINCT model_code) AS models FROM t GROUP BY 1",
    "prefix_suggestions": f"{W} SELECT trademark, array_to_string(list_sort(list_distinct(list(regexp_replace(model_code, '[0-9]+$', '')))), ',') AS prefixes FROM catalog GROUP BY 1",
    "carry_forward": f"{W} SELECT id, category, last_value(CASE WHEN id % 5 = 0 THEN common_name END IGNORE NULLS) OVER (PARTITION BY category ORDER BY id ROWS UNBOUNDED PRECEDING) AS filled FROM catalog",
    "display_name_dedup": f"{W}, n AS (SELECT id, common_name, row_number() OVER (PARTITION BY category, common_name ORDER BY id) AS k FROM catalog) SELECT id, CASE WHEN k = 1 THEN common_name ELSE common_name || ' (' || k || ')' END AS shown FROM n",
    "sequence_synthesis": f"{W} SELECT id, CASE WHEN id % 3 = 0 THEN CAST(row_number() OVER (PARTITION BY trademark ORDER BY id) AS VARCHAR) ELSE seq END AS seq FROM catalog",
    "keyword_union_first": f"{W}, s AS (SELECT *, 'red' AS keyword, 0 AS o FROM catalog WHERE contains(common_name, 'red') UNION ALL SELECT *, 'bolt', 1 FROM catalog WHERE contains(common_name, 'bolt') UNION ALL SELECT *, 'small', 2 FROM catalog WHERE contains(common_name, 'small')) SELECT model_code, keyword, id FROM s QUALIFY row_number() OVER (PARTITION BY model_code ORDER BY o, id) = 1",
    "common_name_distinct": f"{W} SELECT trademark, array_to_string(list_sort(list_distinct(list(common_name))), '|') AS names, min(price) AS low_price FROM catalog GROUP BY 1",
    "batch_interval_labels": f"{W} SELECT category, CASE WHEN min(CAST(batch AS BIGINT)) = max(CAST(batch AS BIGINT)) THEN CAST(min(CAST(batch AS BIGINT)) AS VARCHAR) ELSE min(CAST(batch AS BIGINT)) || '-' || max(CAST(batch AS BIGINT)) END AS label FROM catalog GROUP BY 1",
}
QUERIES = {name: globals()[name] for name in ORACLES}
