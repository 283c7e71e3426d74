"""Queries over snapshots, profiles, attachments, photos and the progress of runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import details
from ..operators import recovery
from .catalog import SQL_RULES
from .roles import SQL_CATALOG, _pick, _sql_pick, catalog, table

STATES = ("pdf", "pending_source", "pdf", "fetch_failed", "pdf")
CATALOGUES = ("", "目录", "购置税目录", "车船税目录", "推荐车型目录")
STEM_TITLES = ("《道路机动车辆生产企业及产品》（第404批）", "《新能源汽车推广应用推荐车型目录》（2022年第5批）", "其他")
KINDS = ("known_source_absent", "partial_failed", "invalid_cache", "missing_cache", "complete")
BASE = "http://registry.example/query"
SHA = "ab12"


def recovered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the snapshot against live ones: equal, engine block refreshed, or a field changed."""
    c, k = catalog(spark, sf_dir), F.col("id")
    old = F.create_map(F.lit("name"), F.col("common_name"), F.lit("engine_model"), F.lit("E1"))
    new = F.create_map(F.lit("engine_model"), F.lit("E2"), F.lit("name"), F.when(k % 3 == 0, F.lower("category")).otherwise(F.col("common_name")))
    records = c.select(k.alias("product"), F.lit("s1").alias("snapshot"), _pick(STATES, k).alias("availability"), old.alias("fields"))
    live = c.where("tag = 'Z'").select(k.alias("product"), F.when(k % 7 != 0, "s1").alias("marker"), new.alias("fields"))
    return recovery.recovered(records, live, ["engine_model"]).select("product", "availability")


def orphan_photos(spark: SparkSession, sf_dir: str) -> DataFrame:
    photos = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("public"), F.col("l_linenumber").alias("photo"))
    announcements = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("public"))
    return recovery.orphans(photos, announcements, "public")


def photo_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber")
    photos = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("public"), F.concat(F.lit("p/q/"), line, F.lit(".jpg")).alias("path"), F.when(line % 2 == 0, F.col("l_suppkey")).alias("pdf_offset"), F.concat(F.lit("h"), line).alias("sha256"), F.col("l_partkey").alias("bytes")
    )
    announcements = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("public"), F.col("o_custkey").alias("product"), F.col("o_orderpriority").alias("model"), F.month("o_orderdate").alias("batch"))
    m = recovery.photo_manifests(photos, announcements)
    return m.withColumn("images", F.array_join(F.transform("images", lambda x: F.concat_ws(":", x["file"], x["bytes"].cast("string"))), "|"))


def recovered_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    series = c.select(F.col("id").alias("series"), F.col("common_name").alias("name"), F.when(F.col("id") % 4 == 0, "catalogue").otherwise("profile").alias("source"))
    rows = c.where("id % 10 <> 1").select((F.floor(F.col("id") / 3) * 3 + 1).alias("series"), F.col("id").alias("product"), F.col("model_code").alias("model"))
    p = recovery.recovered_profiles(series, rows)
    return p.select("name", F.array_join("model_prefixes", "|").alias("prefixes"), F.array_join(F.transform("products", lambda x: x.cast("string")), "|").alias("products"))


def profile_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    names = c.groupBy(F.col("model_code").alias("name")).agg(F.when(F.min("id") % 3 != 0, F.array(F.substring("model_code", 1, 3))).alias("prefixes"))
    rows = c.where("id % 5 <> 0").select(F.col("model_code").alias("name"), "trademark", "product_name")
    p = recovery.profile_entries(names, rows)
    return p.withColumn("prefixes", F.array_join("prefixes", "|")).withColumn("notes", F.array_join("notes", "|"))


def profile_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles by brand, of which every second name is known under an alias."""
    c = catalog(spark, sf_dir)
    old = c.where("id % 2 = 0").select(F.col("id").alias("ordinal"), recovery.profile_keys(F.concat(F.lit("P_"), F.col("id")), F.array(F.concat(F.lit("alias "), F.floor(F.col("id") / 4)))).alias("keys"))
    new = c.select(F.concat(F.lit("Alias-"), F.col("id")).alias("name")).withColumn("keys", recovery.profile_keys(F.col("name"), F.array(F.lit(""))))
    return recovery.profile_actions(old, new, overwrite=True).drop("keys")


def cache_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    d = c.select(
        _pick(KINDS, k).alias("category"), F.when(k % 3 != 0, k).alias("batch"), F.when(k % 4 != 0, F.concat(k, F.lit(".json"))).alias("file"), F.when(k % 2 == 0, "2024-01-01").otherwise("").alias("fetched_at"),
        F.when(k % 7 != 0, "超时").alias("reason"), (k % 6 == 0).alias("retained"),
    )
    return recovery.cache_messages(d)


def known_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).groupBy("model_code").agg(F.min(F.struct("id", "common_name", "batch", "category", "trademark")).alias("r")).select("model_code", "r.*")
    shape = (F.col("common_name").alias("name"), "batch", "category", F.col("trademark").alias("company"))
    vehicles = c.where("id % 3 = 0").select(F.lower("model_code").alias("model"), *shape)
    catalogue = c.where("id % 2 = 0").select(F.col("model_code").alias("model"), F.lit(None).cast("string").alias("name"), *shape[1:])
    return recovery.known_items(c.select(F.col("model_code").alias("model")), vehicles, catalogue)


def store_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    ok = k % 3 == 0
    status = F.when(ok, F.when(k % 2 == 0, "downloaded").otherwise("")).otherwise(_pick(recovery.PRODUCT_OUTCOMES[1:], k))
    return recovery.store_outcomes(c.select("id", ok.alias("ok"), status.alias("status")))


def vehicle_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    known = c.where("id % 4 = 0").groupBy(F.col("model_code").alias("model")).agg(F.min("id").alias("vehicle"))
    return recovery.vehicle_rows(c.select("id", F.col("model_code").alias("model"), F.col("product_name").alias("name"), "batch"), known)


def resumable_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    runs = c.select("id", F.when(k % 2 == 0, SHA).otherwise("other").alias("sha256"), F.when(k % 3 == 0, "all").otherwise("nev").alias("scope"), F.when(k % 5 == 0, "query").otherwise(recovery.MANIFEST_MODE).alias("mode"))
    return recovery.resumable(runs, SHA.upper(), "nev").select("id")


def run_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("l_partkey")
    status = F.when(k % 4 == 0, None).otherwise(_pick(recovery.PRODUCT_OUTCOMES, k))
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("run"), status.alias("status"), F.col("l_orderkey").alias("bytes"), F.when(k % 5 != 1, F.col("l_linenumber").cast("bigint")).alias("seconds"))
    return recovery.progress(rows)


def plan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    return recovery.plan_keys(c.select(F.array("category", "trademark").alias("changed_keys"), F.when(F.col("tag") == "D", F.array("trademark")).otherwise(F.array().cast("array<string>")).alias("preserved_keys")))


def uncovered_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    found = c.select(F.concat(F.lit(" "), F.col("model_code"), F.lit(" ")).alias("product"), "id")
    return recovery.uncovered(found, c.where("tag = 'D'").select(F.col("model_code").alias("product")).distinct())


def renamed_attachments(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    rows = c.select("id", F.col("batch").alias("article"), F.concat("seq", F.lit(".doc")).alias("attachment"))
    renames = rows.where("id % 3 = 0").select("article", "attachment").distinct().withColumn("new_name", F.concat(F.lit("购置税目录第"), F.col("article"), F.lit("批.doc")))
    return recovery.renamed(rows, renames)


def attachment_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    kind, title = _pick(CATALOGUES, k), _pick(STEM_TITLES, F.floor(k / 5))
    return c.select("id", details.attachment_stem(kind, F.when(k % 2 == 0, F.col("batch")).otherwise("")).alias("stem"), details.stem_of_title(kind, title).alias("by_title"), details.article_folder(k.cast("string"), title).alias("folder"))


def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    path = F.when(k % 6 == 0, F.concat(k, F.lit(".pdf"))).otherwise(F.concat("trademark", F.lit("/a/"), k, F.when(k % 5 == 0, ".json").otherwise(".pdf")))
    return recovery.category_counts(catalog(spark, sf_dir).select(path.alias("path")))


def first_parameter(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    items = c.select("trademark", F.floor(F.col("id") / 2).alias("ordinal"), F.col("category").alias("label"), F.when(F.col("id") % 3 == 0, " ").otherwise(F.col("model_code")).alias("spec"), F.col("seq").alias("value"))
    return recovery.first_parameter(items, "PROMO", ["trademark"])


def first_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    hits = c.select("model_code", F.col("id").alias("rank"), F.col("seq").alias("series"), F.col("common_name").alias("name"), (F.col("id") % 3 == 0).alias("is_series"))
    return recovery.first_series(hits, ["model_code"])


def cache_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    return recovery.cache_files(catalog(spark, sf_dir).select(k.alias("batch"), (k % 7 == 0).alias("absent"), (k % 3).alias("failures"))).select("batch", "file")


def retried_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("id")
    index = F.when(k % 5 == 0, None).when(k % 5 == 1, '{"failed": ').when(k % 5 == 2, '{"status": "ok"}').otherwise(F.concat(F.lit('{"failed": '), k % 4, F.lit("}")))
    return recovery.retried_images(catalog(spark, sf_dir).select(k.alias("product"), index.alias("index")))


def report_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    return c.select("id", details.score_text(F.when(k % 9 != 0, (k % 21) / 4 - 0.5), F.when(k % 2 == 0, k)).alias("score"), details.sales_label(F.when(k % 3 == 0, "5月").otherwise("")).alias("sales"))


def sales_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.when(F.col("id") % 4 == 0, "").otherwise(F.concat(F.col("id") % 3, F.lit("月")))
    return catalog(spark, sf_dir).groupBy("model_code").agg(details.sales_header(month).alias("header"))


def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with own photos (one twice), a foreign picture, a page of another batch, and a link of another product."""
    c, k = catalog(spark, sf_dir), F.col("id").cast("string")
    shown = F.when(F.col("id") % 5 == 0, "0").otherwise(F.col("batch"))
    other = F.when(F.col("id") % 7 == 0, "x").otherwise(k)
    html = F.concat(
        F.lit("<table><tr><td>产品ID</td><td> "), k, F.lit("</td><td>批次</td><td><b>"), shown, F.lit("</b></td></tr><tr><td>车辆型号</td><td>"), F.col("model_code"), F.lit("</td></tr></table><img src='http://else.example/a.gif'>"),
        F.lit("<img alt='' src='getPic?gid="), k, F.lit("&amp;pc="), F.col("batch"), F.lit("&amp;zpname=a%20b.jpg'><img src=\"/query/getPic?zpname=a+b.jpg&pc="), F.col("batch"), F.lit("&gid="), k, F.lit("\">"),
        F.lit("<img src='" + BASE + "/getPic?gid="), other, F.lit("&pc="), F.col("batch"), F.lit("&zpname=c.jpg'>"),
    )
    found = details.image_names(html, k, F.col("batch"), F.col("model_code"), BASE)
    return c.select("id", found.alias("f")).select("id", F.array_join("f.names", "|").alias("names"), "f.error")


C = f"WITH {SQL_CATALOG}"
_STATUS = f"CASE WHEN l_partkey % 4 <> 0 THEN {_sql_pick(recovery.PRODUCT_OUTCOMES, 'l_partkey')} END"
ORACLES = {
    "recovered_rows": f"{C}, r AS (SELECT id AS product, {_sql_pick(STATES, 'id')} AS availability, tag, id FROM catalog) SELECT product, availability FROM r WHERE availability <> 'pdf' OR (tag = 'Z' AND id % 7 <> 0 AND id % 3 <> 0)",
    "orphan_photos": "SELECT l_orderkey AS public, l_linenumber AS photo FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')",
    "photo_manifests": """WITH p AS (SELECT l_orderkey AS public, CASE WHEN l_linenumber % 2 = 0 THEN 'recovered_h' || l_linenumber ELSE CAST(l_linenumber AS VARCHAR) END || '.jpg' AS f, l_partkey AS b, 'h' || l_linenumber AS h FROM lineitem),
g AS (SELECT public, count(*) AS n, string_agg(f || ':' || b, '|' ORDER BY f, b, h) AS images FROM p GROUP BY 1)
SELECT public, o_custkey AS product, o_orderpriority AS model, CAST(month(o_orderdate) AS INTEGER) AS batch, 'ok' AS status, CAST(n AS INTEGER) AS downloaded, 0 AS failed, images FROM g JOIN orders ON o_orderkey = public""",
    "recovered_profiles": f"""{C}, m AS (SELECT id // 3 * 3 + 1 AS series, string_agg(DISTINCT model_code, '|' ORDER BY model_code) AS prefixes, string_agg(CAST(id AS VARCHAR), '|' ORDER BY id) AS products FROM catalog WHERE id % 10 <> 1 GROUP BY 1)
SELECT common_name AS name, coalesce(prefixes, '') AS prefixes, coalesce(products, '') AS products FROM catalog LEFT JOIN m ON series = id WHERE id % 4 <> 0""",
    "profile_entries": f"""{C}, n AS (SELECT model_code AS name, CASE WHEN min(id) % 3 <> 0 THEN substr(model_code, 1, 3) ELSE '' END AS prefixes, count(DISTINCT trademark) FILTER (id % 5 <> 0) AS m, min(trademark) FILTER (id % 5 <> 0) AS mark,
  count(DISTINCT product_name) FILTER (id % 5 <> 0) AS t, min(product_name) FILTER (id % 5 <> 0) AS title FROM catalog GROUP BY 1)
SELECT name, CASE WHEN m = 1 THEN mark ELSE '' END AS trademark, CASE WHEN t = 1 THEN title END AS product_name, prefixes, concat_ws('|', CASE WHEN m <> 1 THEN 'trademark' END, CASE WHEN t > 1 THEN 'product_name' END, CASE WHEN prefixes = '' THEN 'prefixes' END) AS notes FROM n""",
    "profile_actions": f"{C}, o AS (SELECT id // 4 AS k, min(id) AS target FROM catalog WHERE id % 2 = 0 GROUP BY 1) SELECT 'Alias-' || id AS name, target, CASE WHEN target IS NULL THEN 'added' ELSE 'updated' END AS action FROM catalog LEFT JOIN o ON k = id",
    "cache_messages": f"""{C}, d AS (SELECT {_sql_pick(KINDS, 'id')} AS category, CASE WHEN id % 3 <> 0 THEN id END AS batch, CASE WHEN id % 3 <> 0 THEN '第 ' || id || ' 批' ELSE '批次未识别' END || '（' || CASE WHEN id % 4 <> 0 THEN id || '.json' ELSE '无缓存文件' END || '；'
  || CASE WHEN id % 2 = 0 THEN '2024-01-01' ELSE '时间未记录' END || '）：' || CASE WHEN id % 7 <> 0 THEN '超时' ELSE '原因未记录' END || CASE WHEN id % 6 = 0 THEN '；保留该批旧完整缓存作为历史基线' ELSE '' END AS shown FROM catalog)
SELECT category, batch, CASE WHEN category = 'known_source_absent' THEN 'notice' ELSE 'warning' END AS severity, CASE category WHEN 'known_source_absent' THEN '上游接口不可用，属于来源范围说明：' || shown || '；不作为成功的完整空批次，也不能据此认定该批公告不存在'
  WHEN 'partial_failed' THEN '部分枚举失败：' || shown WHEN 'invalid_cache' THEN '缓存校验失败：' || shown ELSE '缓存缺失且无来源证据：' || shown END AS message FROM d WHERE category <> 'complete'""",
    "known_items": f"""{C}, f AS (SELECT * FROM catalog QUALIFY row_number() OVER (PARTITION BY model_code ORDER BY id) = 1)
SELECT model_code AS model, CASE WHEN id % 3 = 0 THEN common_name ELSE '' END AS name, batch, category, trademark AS company, CASE WHEN id % 3 = 0 THEN 'registry' ELSE 'catalogue' END AS origin FROM f WHERE id % 3 = 0 OR id % 2 = 0""",
    "store_outcomes": f"{C}, o AS (SELECT id, id % 3 = 0 AS ok, CASE WHEN id % 3 = 0 THEN 'downloaded' ELSE {_sql_pick(recovery.PRODUCT_OUTCOMES[1:], 'id')} END AS status FROM catalog) SELECT *, status IN ('downloaded', 'parse_failed') AS has_pdf FROM o",
    "vehicle_rows": f"""WITH {SQL_RULES}, v AS (SELECT model_code, min(id) AS vehicle FROM catalog WHERE id % 4 = 0 GROUP BY 1), k AS (SELECT c.*, vehicle, regexp_extract(c.model_code, '^[A-Z]+([0-9])', 1) AS code FROM catalog c LEFT JOIN v USING (model_code))
SELECT id, model_code AS model, product_name AS name, batch, vehicle, CASE WHEN vehicle IS NULL THEN CASE WHEN regexp_matches(product_name, '乘用车|轿车') THEN '乘用车' WHEN code = '5' THEN '专用车' WHEN contains(product_name, '客车') THEN '客车'
  WHEN regexp_matches(product_name, '货车|载货汽车|自卸汽车|牵引车') THEN '货车' WHEN code IN ('7', '2', '6') THEN '乘用车' WHEN code IN ('1', '3', '4') THEN '货车' ELSE '专用车' END END AS category FROM k""",
    "resumable_runs": f"{C} SELECT id FROM catalog WHERE id % 2 = 0 AND id % 3 <> 0 AND id % 5 <> 0",
    "run_progress": f"""WITH r AS (SELECT l_suppkey AS run, {_STATUS} AS status, l_orderkey AS bytes, CASE WHEN l_partkey % 5 <> 1 THEN l_linenumber END AS seconds FROM lineitem),
g AS (SELECT run, count(*) AS selected, count(status) AS processed, count(*) - count(status) AS remaining, count(*) FILTER (status IN ('downloaded', 'skipped_existing')) AS successful, CAST(coalesce(sum(bytes) FILTER (status = 'downloaded'), 0) AS BIGINT) AS accepted_bytes,
  count(seconds) FILTER (status IS NOT NULL) AS attempts, sum(seconds) FILTER (status IS NOT NULL) AS s FROM r GROUP BY 1)
SELECT * EXCLUDE (s), CASE WHEN attempts > 0 THEN CAST(round_even(CAST(s AS DOUBLE) / attempts * remaining, 0) AS BIGINT) END AS estimated_seconds FROM g""",
    "plan_keys": f"{C}, e AS (SELECT 'changed' AS kind, category AS key FROM catalog UNION ALL SELECT 'changed', trademark FROM catalog UNION ALL SELECT 'preserved', trademark FROM catalog WHERE tag = 'D') SELECT kind, key, count(*) AS n FROM e GROUP BY 1, 2",
    "uncovered_products": f"{C} SELECT ' ' || model_code || ' ' AS product, id FROM catalog WHERE model_code NOT IN (SELECT model_code FROM catalog WHERE tag = 'D')",
    "renamed_attachments": f"{C}, n AS (SELECT DISTINCT batch, seq FROM catalog WHERE id % 3 = 0) SELECT id, c.batch AS article, CASE WHEN n.batch IS NULL THEN c.seq || '.doc' ELSE '购置税目录第' || c.batch || '批.doc' END AS attachment FROM catalog c LEFT JOIN n ON n.batch = c.batch AND n.seq = c.seq",
    "attachment_names": f"""{C}, a AS (SELECT id, batch, {_sql_pick(CATALOGUES, 'id')} AS k, id // 5 % 3 AS t FROM catalog)
SELECT id, CASE WHEN id % 2 = 1 OR k IN ('', '目录') THEN '' WHEN k = '推荐车型目录' THEN '推荐目录第' || batch || '批' ELSE k || '第' || batch || '批' END AS stem,
  CASE WHEN k IN ('', '目录') AND t = 0 THEN '公告第404批附件' WHEN k = '推荐车型目录' AND t = 1 THEN '推荐目录2022年第5批' ELSE '' END AS by_title, CASE WHEN t = 0 THEN id || '_公告第404批' ELSE CAST(id AS VARCHAR) END AS folder FROM a""",
    "category_counts": f"{C} SELECT trademark AS category, count(*) AS n FROM catalog WHERE id % 6 <> 0 AND id % 5 <> 0 GROUP BY 1",
    "first_parameter": f"{C}, h AS (SELECT *, id // 2 AS o, min(id // 2) OVER (PARTITION BY trademark) AS f FROM catalog WHERE contains(category, 'PROMO')) SELECT trademark, model_code AS spec, seq AS value FROM h WHERE o = f AND id % 3 <> 0",
    "first_series": f"{C} SELECT model_code, arg_min(seq, id) FILTER (id % 3 = 0) AS series, arg_min(common_name, id) FILTER (id % 3 = 0) AS name, CASE WHEN count(*) FILTER (id % 3 = 0) = 0 THEN 'brand_only' ELSE 'found' END AS verdict FROM catalog GROUP BY 1",
    "cache_files": f"{C} SELECT id AS batch, id || CASE WHEN id % 7 = 0 THEN '.absent.json' WHEN id % 3 > 0 THEN '.partial.json' ELSE '.json' END AS file FROM catalog",
    "retried_images": f"{C} SELECT id AS product FROM catalog WHERE id % 5 = 1 OR (id % 5 IN (3, 4) AND id % 4 > 0)",
    "report_labels": f"{C}, s AS (SELECT id, CASE WHEN id % 9 <> 0 THEN id % 21 / 4.0 - 0.5 ELSE 0 END AS s FROM catalog) SELECT id, CASE WHEN s > 0 THEN printf('%.2f', s) WHEN id % 2 = 0 AND id <> 0 THEN '-（样本 ' || id || ' 条）' ELSE '-' END AS score, CASE WHEN id % 3 = 0 THEN '5月销量' ELSE '月销量（月份未获取）' END AS sales FROM s",
    "sales_headers": f"{C}, m AS (SELECT model_code, list_distinct(list(id % 3) FILTER (id % 4 <> 0)) AS l FROM catalog GROUP BY 1) SELECT model_code, CASE WHEN coalesce(len(l), 0) = 0 THEN '月销量' WHEN len(l) = 1 THEN l[1] || '月销量' ELSE '月销量（含月份）' END AS header FROM m",
    "image_names": f"{C} SELECT id, CASE WHEN id % 5 <> 0 AND id % 7 <> 0 THEN 'a b.jpg|c.jpg' END AS names, CASE WHEN id % 5 = 0 THEN 'identity' WHEN id % 7 = 0 THEN 'link' END AS error FROM catalog",
}
QUERIES = {name: globals()[name] for name in ORACLES}
