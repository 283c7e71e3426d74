"""Queries over names, cells, scripts, the inventory and the ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import details, rules, text, values
from ..operators import latest, ledger, matrix, reconcile
from .catalog import SQL_RULES
from .roles import OUTCOMES, SQL_CATALOG, SQL_OCCURRENCES, _pick, _sql_pick, catalog, occurrences, table

CELLS = ("询底价", "12.5万", " 8 - 10万 ", "某汽车公司", "BYD6470BEV", "2024款 Pro", "--", "某厂ABC1234", "秦L", "查看报价 9万", "JL7001EV1", "广告 打开", "对比图片")
PATHS = ("a/b.pdf", "/a", "../a", "C:/x", "", "a/../b", "a..b/c")
HINTS = ("", "目录", "推荐车型目录", "减免车辆购置税目录", " ")
TITLES = ("减免车辆购置税的新能源汽车车型目录（第1批）", "车船税减免目录公示", "车船税减免的车型目录", "道路机动车辆生产企业及产品公告（第 79 批）", "《道路机动车辆生产企业及产品》（第80批）")
SPECS = ("秦 PLUS 2024款", "秦L", "2023款 汉 EV", "宋 Pro DM-i 2025款", "")
LEVELS = ("全部SUV", "中型SUV", "MPV", "全部轿车", "紧凑型轿车")
WANTED = ("SUV", "MPV", "轿车", "紧凑型轿车", "型轿车", "皮卡", "")
SECTIONS = ["PROMO", "LARGE"]


def file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    raw = F.when(k % 50 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("common_name"), F.lit(':?"'), k, F.lit("|* ")))
    stem = F.concat(F.lit("a b_"), k, F.when(k % 2 == 0, F.lit("__20240102T030405Z")).otherwise(""), F.lit(".pdf"))
    return c.select(
        "id", text.safe_file_name(raw).alias("safe"), text.file_stem_id(F.concat(F.lit("[x]_m_"), k, F.lit(".html"))).alias("product"), text.revision_name(stem).alias("plain"), text.safe_relative(_pick(PATHS, k)).alias("inside")
    )


def cell_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).select("id", _pick(CELLS, F.col("id")).alias("v"))
    return c.select(
        "id", text.compare_value(F.col("v")).alias("shown"), rules.looks_like_price(F.col("v")).alias("price"), rules.looks_like_company(F.col("v")).alias("company"), rules.looks_like_code(F.col("v")).alias("code"),
        rules.looks_electric(F.col("v")).alias("electric"), rules.expands_to_all_trims(F.col("v")).alias("whole_series"), F.array_join(text.split_fused(F.col("v")), "|").alias("cells"),
        details.is_noise_group(F.col("v")).alias("noise"), details.is_ignored_parameter(F.col("v")).alias("ignored"),
    )


def name_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    raw = F.concat(F.col("common_name"), F.lit("，"), F.col("trademark"), F.lit(", ,"), F.col("common_name"), F.lit("\n"), F.col("category"))
    options = text.key_values(F.concat(F.lit("a="), F.col("id"), F.lit(";b="), F.col("seq")))
    return c.select("id", F.array_join(text.split_names(raw), "|").alias("names"), F.array_join(text.split_args(raw), "|").alias("args"), F.try_element_at(options, F.lit("a")).alias("a"), F.try_element_at(options, F.lit("b")).alias("b"))


def markdown_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    line = F.concat(F.lit("看 ["), F.col("common_name"), F.lit("](http://x/spec/"), k, F.lit(") &nbsp; ![图"), k, F.lit("](u)  完"))
    link = F.when(k % 3 == 0, F.concat(F.lit("http://x/spec/"), k, F.lit("/a"))).when(k % 3 == 1, F.concat(F.lit("?specid="), k)).otherwise("none")
    return c.select("id", text.markdown_text(line).alias("line"), text.spec_id(link).alias("spec"))


def label_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    pairs = F.map_from_arrays(F.array(F.lit("车型级别"), F.lit("综合续航(km)"), F.when(k % 2 == 0, "纯电续航").otherwise("油箱容积")), F.array("category", "range_km", "seq"))
    dims = values.dims_text(F.when(k % 4 == 0, None).otherwise(F.col("seq")), F.when(k % 8 != 4, F.col("range_km")).otherwise(""), F.when(k % 4 != 0, F.col("batch")))
    return c.select("id", values.by_alias(pairs, ["纯电", "续航"]).alias("range"), values.by_alias(pairs, ["没有"]).alias("none"), dims.alias("dims"))


def script_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects over several lines, several on one line, with braces and quotes in strings, and one that never closes."""
    c, k = catalog(spark, sf_dir), F.col("id")
    body = F.concat(F.lit('{"a":{"n":'), k, F.lit('},\n "s":"}\\"{"}'))
    script = F.concat(F.lit('var myconfig = {"no":1}; var config = '), body, F.lit('; var option = {"b":2}'), F.when(k % 5 == 0, F.lit("; var open = {")).otherwise(""))
    return c.select("id", details.script_json(script, "config").alias("config"), details.script_json(script, "option").alias("option"), details.script_json(script, "open").alias("open"))


def code_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.when(F.col("id") % 12 == 11, "ABC").otherwise(F.concat(F.lit("BYD"), F.col("id") % 10, F.lit("70")))
    return catalog(spark, sf_dir).select("id", details.category_of_code(code, F.col("product_name")).alias("category"))


def search_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Series hits of a search per model code, the three to try; and the score of a spec of that name."""
    c, k = catalog(spark, sf_dir), F.col("id")
    hits = c.select(
        "model_code", k.alias("rank"), details.is_series(F.when(k % 3 == 0, "CarSeries").when(k % 3 == 1, "Brand"), F.when(k % 6 == 2, F.lit(4)).when(k % 6 == 5, F.lit(None).cast("int"))).alias("series"),
        details.search_score(F.lit(" 秦l"), _pick(SPECS, k), F.col("id") % 40).alias("score"), details.spec_score(F.lit("秦 plus_2024款"), _pick(SPECS, k), F.col("id") % 40).alias("spec_score"),
    )
    return ledger.candidates_first(hits.where("series"), ["model_code"]).select("model_code", "rank", "score", "spec_score", F.col("place").cast("bigint").alias("place"))


def release_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    a = c.select("id", _pick(TITLES, k).alias("title"), _pick(HINTS, F.floor(k / 5)).alias("hint"))
    failed = details.is_failed_catalogue(F.when(F.col("id") % 7 == 0, "x").otherwise(""), F.col("hint"), F.col("id") % 9 != 0)
    return a.select("id", details.is_release(F.col("title")).alias("release"), details.is_other_document(F.col("hint")).alias("other"), failed.alias("failed"))


def score_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).select("id", F.round(details.bar_width((F.col("id") % 60) / 10), 6).alias("width"), F.array_join(details.removed_batches(F.concat(F.lit("408, "), F.col("id") + 409)), "|").alias("removed"))
    return c


def run_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return e.select("user_id", values.duration_text(F.col("a"), F.col("b")).alias("took"))


def section_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of each parameter when preferred sections come first."""
    rows = catalog(spark, sf_dir).groupBy(F.col("category").alias("section"), F.col("trademark").alias("param")).agg(F.count("*").alias("n"))
    ordered = matrix.in_section_order(rows, SECTIONS)
    return ordered.limit(20)  # the report shows its first twenty lines


def full_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    second = 173 + F.pmod(F.col("id") * 3, F.lit(260))
    products = c.select(
        F.col("id").alias("product"), F.col("model_code").alias("model"), F.col("product_name").alias("name"), F.greatest(F.col("batch").cast("bigint"), second).alias("batch"), F.array(F.col("batch").cast("bigint"), second).alias("batches"),
        "trademark", F.col("common_name").alias("company"), F.col("official_category").alias("category"), "tag",
    )
    state = F.when(F.max("batch") % 2 == 0, "parsed").otherwise("non_pdf")
    business = occurrences(spark, sf_dir).where("status = 'F'").groupBy("product").agg(F.max("batch").alias("db_batch"), state.alias("state")).join(c.select(F.col("id").alias("product"), "fuel"), "product")
    energies = latest.specific_energy(c, "model_code", "id", "energy_type", F.col("energy_type").isin(*rules.NEV)).select(F.col("model_code").alias("model"), F.col("energy_type").alias("label"))
    out = ledger.inventory(products, business, energies)
    return out.withColumn("batches", F.array_join("batches", ",")).withColumn("batch", F.col("batch").cast("bigint")).drop("channel")


def _announcements(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("announcement"), F.col("o_custkey").alias("vehicle"), (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("bigint").alias("batch"))


def pdf_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("announcement"), F.col("l_linenumber").alias("document"), (F.col("l_returnflag") != "A").cast("int").alias("is_pdf"))
    vehicles = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("vehicle"), F.col("c_mktsegment").alias("segment"))
    batches = _announcements(spark, sf_dir).select("batch").distinct().where("batch % 5 <> 0").withColumn("batch_name", F.concat(F.lit("b"), F.col("batch")))
    return ledger.with_documents(documents, _announcements(spark, sf_dir), vehicles, batches).select("announcement", "document", "vehicle", "segment", "batch", "batch_name")


def admitted_energies(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    return ledger.admitted_energies(c.select(F.col("id").alias("product"), F.col("model_code").alias("model")), c.select(F.col("model_code").alias("model"), F.col("energy_type").alias("label")))


def registrable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    articles = o.select(
        F.col("o_orderkey").alias("article"), F.concat(F.lit("《道路机动车辆生产企业及产品》（第 "), F.col("o_orderkey") % 4 + 78, F.lit(" 批）")).alias("title"),
        F.date_format("o_orderdate", "yyyy/MM/dd").alias("published"), F.when(F.col("o_orderkey") % 3 == 0, "error").otherwise("ok").alias("status"),
    )
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("article"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("id")).join(catalog(spark, sf_dir), "id")
    rows = rows.select("article", F.concat_ws("-", "model_code", "line").alias("model"), F.col("product_name").alias("name"), F.col("official_category").alias("category"), "tag")
    return ledger.registrable(articles, rows, F.lit("1997-06-30").cast("date"), F.lit(80))


def latest_formal(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(F.when(F.col("event_type") == "view", "formal").otherwise("notice").alias("kind"), F.col("user_id").alias("batch"))
    return ledger.latest_formal_batch(catalog(spark, sf_dir).select("batch"), events)


def rank_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    levels = spark.createDataFrame(list(enumerate(LEVELS)), "ordinal int, level string")
    return ledger.resolved_levels(catalog(spark, sf_dir).select(_pick(WANTED, F.col("id")).alias("name")), levels)


def _run_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.get_json_object("props", "$.k").cast("int") % len(OUTCOMES)) + 1)
    return table(spark, sf_dir, "events").select(F.dayofmonth("ts").alias("run"), F.col("event_id").alias("event"), (F.col("user_id") % 700 + 1).alias("vehicle"), status.alias("status"), "event_type", "ts")


def run_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    vehicles = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("vehicle"), F.concat("p_brand", F.lit("-"), F.col("p_partkey")).alias("code"))
    p = ledger.problems(_run_rows(spark, sf_dir).select("run", "vehicle", "status").distinct(), vehicles)
    return p.withColumn("place", F.col("place").cast("bigint"))


def run_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _run_rows(spark, sf_dir)
    events = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("event"), F.concat(F.lit("m"), F.col("o_custkey")).alias("model"), F.month("o_orderdate").alias("batch"), F.col("o_orderpriority").alias("kind"))
    return ledger.attempts_of_runs(r.select("run", "event", "status"), events)


def event_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _run_rows(spark, sf_dir)
    before = r.select("event", F.lit("open").alias("status"), (F.col("vehicle") % 3).alias("attempts"), F.to_date("ts").alias("next_check"))
    return ledger.backed_off(before, r.where("event_type <> 'click'").select("event", "status"), F.lit("2024-02-01").cast("date"))


def identity_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    rows = c.select(F.when(F.col("id") % 2 == 0, F.lower("model_code")).otherwise(F.concat(F.lit(" "), F.col("model_code"))).alias("model"), (F.col("id") % 5).cast("string").alias("product"), "batch", F.col("id").alias("place"))
    return ledger.first_of_identity(rows, "place")


def availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.availability(catalog(spark, sf_dir).select(F.col("category").alias("availability"), F.col("trademark").alias("series")))


def unfinished_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _run_rows(spark, sf_dir).groupBy("run").agg(F.min("ts").alias("started_at"), F.max(F.when(F.col("event_type") == "signup", F.col("ts"))).alias("done_at"), F.max("ts").alias("last"))
    return ledger.unfinished(r.withColumn("completed_at", F.when(F.dayofmonth("last") % 3 == 0, F.col("done_at")))).select("run")


def numbered_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir).select("id", F.concat(F.lit("d.x/"), F.col("trademark"), F.when(F.col("id") % 2 == 0, ".pdf").otherwise("")).alias("path"))
    return ledger.numbered_paths(c, "path", "id")


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.fingerprint(occurrences(spark, sf_dir))


C = f"WITH {SQL_CATALOG}"
_V = f"{C}, v AS (SELECT id, {_sql_pick(CELLS, 'id')} AS v FROM catalog)"
_R = f"""r AS (SELECT CAST(day(ts) AS INTEGER) AS run, event_id AS event, user_id % 700 + 1 AS vehicle, ([{', '.join(map(repr, OUTCOMES))}])[CAST(json_extract_string(props, '$.k') AS INTEGER) % {len(OUTCOMES)} + 1] AS status, event_type, ts FROM events)"""
_ANY = " OR ".join
_RULES = SQL_RULES.removeprefix(SQL_CATALOG)
_AN = "an AS (SELECT o_orderkey AS announcement, o_custkey AS vehicle, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS batch FROM orders)"
ORACLES = {
    "file_names": f"""{C}, n AS (SELECT id, CASE WHEN id % 50 = 0 THEN ' ' ELSE ' ' || common_name || ':?"' || id || '|* ' END AS raw, {_sql_pick(PATHS, 'id')} AS p FROM catalog)
SELECT id, CASE WHEN trim(raw) = '' THEN 'export' ELSE trim(regexp_replace(raw, '[\\\\/:*?"<>|]+', '_', 'g')) END AS safe, CAST(id AS VARCHAR) AS product, 'a b_' || id || '.pdf' AS plain, p IN ('a/b.pdf', 'a..b/c') AS inside FROM n""",
    "cell_values": f"""{_V}, s AS (SELECT *, trim(regexp_replace(regexp_replace(v, '询底价|查看报价', '', 'g'), '\\s+', ' ', 'g')) AS w FROM v)
SELECT id, CASE WHEN w = '' THEN '-' ELSE w END AS shown, regexp_matches(trim(v), '^[0-9]+(\\.[0-9]+)?\\s*(-\\s*[0-9]+(\\.[0-9]+)?\\s*)?万$') AS price, regexp_matches(v, '(公司|集团|厂)$') AS company, regexp_matches(v, '^[A-Z]{{2,4}}[0-9][0-9A-Z/()（）-]*$') AS code,
  regexp_matches(v, '(BEV|PHEV|EV|FCEV|SHEV)[0-9A-Z]*$') AS electric, NOT regexp_matches(lower(v), '20[0-9][0-9]|版|款|型|max|pro|plus|ultra|[0-9]+\\s*km') AS whole_series, CASE WHEN v = '某厂ABC1234' THEN '某厂|ABC1234' ELSE v END AS cells,
  {_ANY(f"contains(v, '{w}')" for w in details.NOISE)} AS noise, {_ANY(f"contains(v, '{w}')" for w in details.IGNORED)} AS ignored FROM s""",
    "name_lists": f"{C} SELECT id, concat_ws('|', common_name, trademark, common_name || chr(10) || category) AS names, concat_ws('|', common_name, trademark, category) AS args, CAST(id AS VARCHAR) AS a, seq AS b FROM catalog",
    "markdown_lines": f"{C} SELECT id, '看 ' || common_name || ' 图' || id || ' 完' AS line, CASE WHEN id % 3 = 2 THEN NULL ELSE CAST(id AS VARCHAR) END AS spec FROM catalog",
    "label_lookup": f"{C} SELECT id, CASE WHEN id % 2 = 0 THEN seq ELSE range_km END AS range, CAST(NULL AS VARCHAR) AS none, CASE WHEN id % 4 = 0 THEN '' ELSE seq || '×' || range_km || '×' || batch END AS dims FROM catalog",
    "script_objects": f"""{C} SELECT id, '{{"a":{{"n":' || id || '}},' || chr(10) || ' "s":"}}\\"{{"}}' AS config, '{{"b":2}}' AS option, '' AS open FROM catalog""",
    "code_categories": f"{C} SELECT id, CASE WHEN id % 12 = 11 THEN '未分类' WHEN id % 10 IN (2, 7) THEN '乘用车' WHEN id % 10 = 6 THEN CASE WHEN contains(product_name, '客车') THEN '客车' ELSE '乘用车' END WHEN id % 10 IN (1, 3, 4) THEN '货车' WHEN id % 10 = 5 THEN '专用车' ELSE '未分类' END AS category FROM catalog",
    "search_candidates": f"""{C}, h AS (SELECT model_code, id AS rank, lower({_sql_pick(SPECS, 'id')}) AS t FROM catalog WHERE id % 3 = 0 OR id % 6 = 2 OR id % 6 = 5),
s AS (SELECT model_code, rank, 100 - rank % 40 + CASE WHEN t = '秦l' THEN 20 ELSE 0 END AS score, 100 - rank % 40 + 12 * (contains(t, '秦')::INT + contains(t, 'plus')::INT + contains(t, '2024款')::INT) + coalesce(TRY_CAST(nullif(regexp_extract(t, '(20[0-9][0-9])款', 1), '') AS INT), 0) AS spec_score FROM h)
SELECT *, row_number() OVER (PARTITION BY model_code ORDER BY score DESC, rank) AS place FROM s QUALIFY place <= 3""",
    "release_articles": f"""{C}, a AS (SELECT id, {_sql_pick(TITLES, 'id')} AS t, trim({_sql_pick(HINTS, 'id // 5')}) AS h FROM catalog)
SELECT id, NOT contains(t, '公示') AND (contains(t, '减免车辆购置税') OR contains(t, '车船税减免')) AS release, h = '目录' OR contains(h, '推荐') AS other, id % 9 = 0 OR id % 7 = 0 OR (h <> '' AND NOT (h = '目录' OR contains(h, '推荐'))) AS failed FROM a""",
    "score_bars": f"{C} SELECT id, round(greatest(2, least(100, id % 60 / 10.0 / 5 * 100)), 6) AS width, '408|' || (id + 409) AS removed FROM catalog",
    "run_durations": "WITH d AS (SELECT user_id, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS s FROM events GROUP BY 1) SELECT user_id, printf('%dh %02dm %02ds', s // 3600, s // 60 % 60, s % 60) AS took FROM d",
    "section_order": f"{C} SELECT category AS section, trademark AS param, count(*) AS n FROM catalog GROUP BY 1, 2 ORDER BY CASE category WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 2 ELSE 3 END, 1, 2 LIMIT 20",
    "full_inventory": f"""{C}, {SQL_OCCURRENCES}, biz AS (SELECT product, max(batch) AS db_batch, CASE WHEN max(batch) % 2 = 0 THEN 'parsed' ELSE 'non_pdf' END AS state FROM occurrences WHERE status = 'F' GROUP BY 1),
cat_e AS (SELECT model_code, arg_min(energy_type, CASE WHEN energy_type IN ('纯电动', '插电式混合动力', '增程式', '燃料电池') THEN 0 ELSE 1000000000 END + id) FILTER (energy_type <> '') AS e FROM catalog GROUP BY 1),
listed AS (SELECT c.* REPLACE (CASE WHEN biz.product IS NOT NULL THEN c.fuel ELSE '' END AS fuel, coalesce(cat_e.e, '') AS energy_type, CAST(greatest(CAST(c.batch AS BIGINT), 173 + id * 3 % 260) AS VARCHAR) AS batch),
  list_sort([CAST(c.batch AS BIGINT), 173 + id * 3 % 260]) AS batches, db_batch, state FROM catalog c LEFT JOIN biz ON biz.product = c.id LEFT JOIN cat_e ON cat_e.model_code = c.model_code),
pre AS (WITH catalog AS (SELECT * FROM listed){_RULES} SELECT id, energy FROM grouped),
moved AS (SELECT l.*, l.batch AS latest_batch, CASE WHEN p.energy NOT IN ('纯电动', '插电式混合动力', '增程式', '燃料电池') AND list_max(list_filter(batches, lambda x: x >= 408)) IS NOT NULL THEN CAST(list_max(list_filter(batches, lambda x: x >= 408)) AS VARCHAR) ELSE l.batch END AS b FROM listed l JOIN pre p USING (id)),
post AS (WITH catalog AS (SELECT * REPLACE (b AS batch) FROM moved){_RULES} SELECT * FROM grouped)
SELECT id AS product, model_code AS model, product_name AS name, trademark, common_name AS company, CAST(batch AS BIGINT) AS batch, CAST(latest_batch AS BIGINT) AS latest_batch, array_to_string(batches, ',') AS batches, energy, source AS energy_source, energy_type AS catalog_energy, gate, grp, coalesce(state, 'missing') AS state, db_batch, tag FROM post""",
    "pdf_documents": f"WITH {_AN} SELECT l_orderkey AS announcement, l_linenumber AS document, vehicle, c_mktsegment AS segment, batch, CASE WHEN batch % 5 <> 0 THEN 'b' || batch END AS batch_name FROM lineitem JOIN an ON announcement = l_orderkey JOIN customer ON c_custkey = vehicle WHERE l_returnflag <> 'A'",
    "admitted_energies": f"""{C}, d AS (SELECT DISTINCT model_code, energy_type FROM catalog WHERE energy_type NOT IN ('', '新能源')), k AS (SELECT model_code, count(DISTINCT CASE energy_type WHEN '其他' THEN 'x' ELSE energy_type END) AS n, min(energy_type) AS e FROM d GROUP BY 1)
SELECT id AS product, c.model_code AS model, CASE WHEN n = 1 THEN CASE e WHEN '其他' THEN '未知' ELSE e END END AS energy, coalesce(n = 1 AND e <> '其他', false) AS admitted FROM catalog c LEFT JOIN k USING (model_code)""",
    "registrable_rows": f"""WITH {SQL_RULES}, a AS (SELECT o_orderkey AS article, o_orderkey % 4 + 78 AS batch, CAST(o_orderdate AS DATE) AS event_date FROM orders WHERE o_orderkey % 3 <> 0)
SELECT article, a.batch, event_date, model_code || '-' || l_linenumber AS model, product_name AS name FROM a JOIN lineitem ON l_orderkey = article JOIN grouped g ON g.id = l_partkey
WHERE DATE '1997-06-30' - event_date BETWEEN 0 AND 60 AND a.batch IN (79, 80) AND gate <> 'excluded' AND reason <> 'non_automotive'""",
    "latest_formal": f"{C} SELECT greatest((SELECT max(CAST(batch AS BIGINT)) FROM catalog), coalesce((SELECT max(user_id) FROM events WHERE event_type = 'view'), 0)) AS batch",
    "rank_levels": f"""{C}, n AS (SELECT DISTINCT {_sql_pick(WANTED, 'id')} AS name FROM catalog), l AS (SELECT unnest({list(LEVELS)!r}) AS level, unnest(range({len(LEVELS)})) AS o)
SELECT name, coalesce((SELECT level FROM l WHERE level = name), (SELECT level FROM l WHERE level = '全部' || name), (SELECT arg_min(level, o) FROM l WHERE name <> '' AND contains(level, name))) AS level FROM n""",
    "run_problems": f"WITH {_R}, d AS (SELECT DISTINCT run, vehicle, status FROM r WHERE status <> 'done'), p AS (SELECT run, p_brand || '-' || p_partkey AS code, status, row_number() OVER (PARTITION BY run ORDER BY status, p_brand || '-' || p_partkey, vehicle) AS place, greatest(0, count(*) OVER (PARTITION BY run) - 50) AS remaining FROM d JOIN part ON p_partkey = vehicle) SELECT * FROM p WHERE place <= 50",
    "run_attempts": f"WITH {_R} SELECT run, event, 'm' || o_custkey AS model, CAST(month(o_orderdate) AS INTEGER) AS batch, o_orderpriority AS kind, status FROM r JOIN orders ON o_orderkey = event",
    "event_backoff": f"WITH {_R} SELECT event, CASE WHEN event_type <> 'click' THEN status ELSE 'open' END AS status, vehicle % 3 + CASE WHEN event_type <> 'click' THEN 1 ELSE 0 END AS attempts, CASE WHEN event_type <> 'click' THEN DATE '2024-02-08' ELSE CAST(ts AS DATE) END AS next_check FROM r",
    "identity_union": f"{C} SELECT upper(model_code) AS model, CAST(id % 5 AS VARCHAR) AS product, batch, min(id) AS place FROM catalog GROUP BY 1, 2, 3",
    "availability": f"{C} SELECT category AS availability, count(*) AS n, count(DISTINCT trademark) AS series FROM catalog GROUP BY 1",
    "unfinished_runs": f"WITH {_R} SELECT run FROM r GROUP BY run HAVING run % 3 <> 0 OR count(*) FILTER (event_type = 'signup') = 0",
    "numbered_paths": f"{C}, p AS (SELECT id, 'd.x/' || trademark AS stem, CASE WHEN id % 2 = 0 THEN '.pdf' ELSE '' END AS ext, row_number() OVER (PARTITION BY trademark, id % 2 ORDER BY id) AS n FROM catalog) SELECT id, stem || ext AS path, CASE WHEN n = 1 THEN stem || ext ELSE stem || '_' || n || ext END AS unique_path FROM p",
    "fingerprint": f"WITH {SQL_OCCURRENCES}, d AS (SELECT md5(product || '|' || batch || '|' || status) AS h FROM occurrences) SELECT count(*) AS n, {', '.join(f'CAST(sum(CAST(' + chr(39) + '0x' + chr(39) + f' || substr(h, {k}, 8) AS BIGINT)) AS BIGINT) AS part{i}' for i, k in enumerate((1, 9, 17, 25)))} FROM d",
}
QUERIES = {name: globals()[name] for name in ORACLES}
