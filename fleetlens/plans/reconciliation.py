"""Queries that reconcile official batches, collected documents, runs and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import rules, values
from ..operators import latest, merge, reconcile
from .roles import OUTCOMES, SQL_CATALOG, SQL_OCCURRENCES, SQL_RANK, SQL_RUNS, catalog, occurrences, runs, table

TODAY = "2024-01-30"


def republished_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = occurrences(spark, sf_dir)
    local = o.where("status = 'F'").groupBy("product").agg(F.max("batch").alias("local_batch"))
    gate = F.when(F.col("product") % 17 == 0, "excluded").when(F.col("product") % 5 == 0, "pending_review").otherwise("accepted")
    return reconcile.republished(o.withColumn("gate", gate), local)


def republished_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    page, count = latest.limited(republished_products(spark, sf_dir), [F.col("batch").desc(), F.col("product").asc()], 20, 100)
    return page.join(F.broadcast(count)).select("product", "batch", "total", "remaining")


def official_list_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = occurrences(spark, sf_dir).select("product", "batch").distinct()
    events = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("product"), (F.pmod("p_partkey", F.lit(80)) + 1).cast("bigint").alias("batch"))
    listed = o.withColumn("listed", F.lit(True))
    return events.join(listed, ["product", "batch"], "left").select("product", "batch", F.coalesce("listed", F.lit(False)).alias("listed"))


def db_only_by_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (173 + F.pmod("o_orderkey", F.lit(250))).cast("string").alias("batch"))
    listed = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return orders.join(listed, "o_orderkey", "left_anti").groupBy(rules.band(F.col("batch")).alias("band")).agg(F.count("*").alias("n"))


def best_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.best_outcomes(runs(spark, sf_dir)).select("key", F.col("rank").cast("bigint").alias("rank"), "status")


def outcome_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.best_outcomes(runs(spark, sf_dir)).groupBy("status").agg(F.count("*").alias("n"))


def _coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)


    code = F.col("model_code")
    documents = c.where("id % 7 < 3").select(code.alias("code"), F.when(F.col("id") % 7 == 0, 1).otherwise(0).alias("is_pdf"), (F.col("id") % 5 * 100).alias("bytes"), F.when(F.col("id") % 10 == 0, rules.FAILED_DOWNLOAD).otherwise("").alias("error"))
    status = F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.pmod(F.col("id"), F.lit(len(OUTCOMES))) + 1).cast("int"))
    outcomes = reconcile.best_outcomes(c.where("id % 3 = 1").select(code.alias("key"), F.col("id").alias("run_id"), status.alias("status")))
    vehicles = c.where("id % 4 = 1").select(code.alias("code"))
    return reconcile.coverage(c.select(code.alias("code")), documents, outcomes, vehicles)


SQL_COVERAGE = f"""{SQL_CATALOG}, docs AS (SELECT model_code AS code, CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END AS is_pdf, id % 5 * 100 AS bytes, CASE WHEN id % 10 = 0 THEN '{rules.FAILED_DOWNLOAD}' ELSE '' END AS error FROM catalog WHERE id % 7 < 3),
outs AS (SELECT model_code AS code, id, ([{', '.join(map(repr, OUTCOMES))}])[id % {len(OUTCOMES)} + 1] AS status FROM catalog WHERE id % 3 = 1),
best AS (SELECT code, status FROM outs QUALIFY row_number() OVER (PARTITION BY code ORDER BY {SQL_RANK} DESC, id DESC) = 1),
seen AS (SELECT code, bool_or(is_pdf = 1) AS pdf, bool_or(is_pdf = 0 AND bytes > 0 AND error = '') AS other FROM docs GROUP BY 1),
coverage AS (SELECT c.code, CASE WHEN s.pdf THEN 'downloaded' WHEN s.other THEN 'no_pdf' WHEN b.status = 'no_match' AND s.code IS NULL THEN 'absent'
  WHEN v.code IS NULL AND s.code IS NULL THEN 'unseen' WHEN b.status = 'awaiting_effective' THEN 'waiting' ELSE 'retry' END AS bucket
  FROM (SELECT DISTINCT model_code AS code FROM catalog) c LEFT JOIN seen s USING (code) LEFT JOIN best b USING (code) LEFT JOIN (SELECT DISTINCT model_code AS code FROM catalog WHERE id % 4 = 1) v USING (code))"""


def coverage_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coverage(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"))


def coverage_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _coverage(spark, sf_dir).groupBy("bucket").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total)).select("bucket", values.percent_text(F.col("n"), F.col("total")).alias("share"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("model"), (F.pmod("event_id", F.lit(4)) + 77).alias("batch"), F.when(k % 3 == 0, "").otherwise((k % 20).cast("string")).alias("product"),
        F.to_date("ts").alias("event_date"), F.when(k % 13 == 0, "excluded").when(k % 11 == 0, "pending_review").otherwise("accepted").alias("gate"),
        F.when(k % 4 == 0, "done").otherwise("open").alias("status"), F.date_add(F.to_date("ts"), (k % 40).cast("int")).alias("next_check"),
    )


def _event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        (F.pmod("o_custkey", F.lit(150))).alias("model"), (F.pmod("o_orderkey", F.lit(4)) + 77).alias("batch"), F.pmod("o_orderkey", F.lit(20)).cast("string").alias("product"), (F.col("o_orderstatus") != "P").alias("valid")
    )


SQL_EVENTS = """ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
evs AS (SELECT event_id, user_id AS model, event_id % 4 + 77 AS batch, CASE WHEN k % 3 = 0 THEN '' ELSE CAST(k % 20 AS VARCHAR) END AS product, CAST(ts AS DATE) AS event_date,
  CASE WHEN k % 13 = 0 THEN 'excluded' WHEN k % 11 = 0 THEN 'pending_review' ELSE 'accepted' END AS gate, CASE WHEN k % 4 = 0 THEN 'done' ELSE 'open' END AS status, CAST(ts AS DATE) + CAST(k % 40 AS INTEGER) AS next_check FROM ev),
edocs AS (SELECT o_custkey % 150 AS model, o_orderkey % 4 + 77 AS batch, CAST(o_orderkey % 20 AS VARCHAR) AS product, o_orderstatus <> 'P' AS valid FROM orders)"""


def event_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    today = F.lit(TODAY).cast("date")
    return _events(spark, sf_dir).select("event_id", rules.in_window(F.col("event_date"), today, F.col("batch"), F.lit(80), days=20).alias("inside"))


def event_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = reconcile.event_buckets(_events(spark, sf_dir), _event_documents(spark, sf_dir), F.lit(TODAY).cast("date"), F.lit(80))
    return b.groupBy("bucket").agg(F.count("*").alias("n"))


def retry_plan_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir).withColumn("last_checked", F.when(F.col("event_id") % 3 == 0, F.date_format("event_date", "yyyy-MM-dd")))
    return reconcile.retry_plan(e, 40).select("event_id", "plan")


def missing_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    status = F.element_at(F.array(*map(F.lit, OUTCOMES)), (F.pmod(F.col("id"), F.lit(len(OUTCOMES))) + 1).cast("int"))
    missing = c.select(F.col("id").alias("product"), F.col("model_code").alias("model"))
    best = reconcile.best_outcomes(c.where("official_category in ('专用车', '客车')").select(F.col("model_code").alias("key"), F.col("id").alias("run_id"), status.alias("status")))
    events = table(spark, sf_dir, "events").select(F.col("user_id").alias("product"), F.col("event_type").alias("event"))
    return reconcile.missing_reasons(
        missing, c.where("official_category = '乘用车' and energy_type = '纯电动'").select(F.col("model_code").alias("model")), best.select(F.col("key").alias("model"), "status"),
        c.where("official_category = '载货汽车'").select(F.col("model_code").alias("model")), events,
    )


def mean_size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = o.select(F.col("c_mktsegment").alias("channel"), F.floor("o_totalprice").alias("bytes"), "o_orderstatus")
    return reconcile.size_estimate(rows.where("o_orderstatus = 'F'"), rows.where("o_orderstatus = 'P'"))


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    i = F.col("doc_id")
    return d.select(
        "doc_id", F.col("quality").alias("is_pdf"), F.when(i % 9 == 0, 0).otherwise(F.col("n_chars")).alias("size"), F.when(i % 19 == 0, "").otherwise(F.concat(F.lit("f/"), i)).alias("path"),
        F.when(F.col("toxic") == 1, rules.FAILED_DOWNLOAD).otherwise("").alias("error"), F.when(i % 7 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars")).alias("found_size"),
        F.when(F.col("quality") == 1, "%PDF").otherwise("<htm").alias("magic"), F.when(i % 5 == 0, "bad table").otherwise("").alias("parse_error"), "lang",
    )


def document_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = rules.document_state(F.col("is_pdf"), F.col("size"), F.col("path"), F.col("error"), F.col("found_size"), F.col("magic"), F.col("parse_error"), F.array("lang"))
    return _documents(spark, sf_dir).select("doc_id", s.alias("state"))


def cache_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    prefixes = F.when(k % 4 == 0, F.array(F.lit("B"), F.lit("A"), F.lit("A"))).when(k % 4 == 1, F.array(F.lit("A"))).otherwise(F.array(F.lit("A"), F.lit("B")))
    fetched = F.when(k % 10 == 0, "never").otherwise(F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"), F.lit("T08:00:00+00:00")))
    failures = F.when(k % 12 == 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    ok = reconcile.complete_cache(F.when(k % 6 == 0, 3).otherwise(4), k % 5 != 0, k % 15 == 1, prefixes, ["A", "B"], F.lit(0), failures, fetched, F.lit("2024-01-20 00:00:00").cast("timestamp"), days=7)
    return c.select("id", ok.alias("complete"))


def cache_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("user_id").alias("batch"), F.col("ts").cast("timestamp").alias("at"), (F.col("event_type") == "error").alias("partial"), (F.col("event_type") == "view").alias("main"))
    complete = e.where("main").groupBy("batch").agg(F.max("at").alias("complete_at"))
    return reconcile.superseded_evidence(e.where("not main"), complete).select("batch", "partial", "superseded")


def missing_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "documents").select(F.pmod("n_chars", F.lit(700)).cast("bigint").alias("batch"))
    return reconcile.missing_batches(b)


def sound_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select((F.pmod("o_custkey", F.lit(400))).alias("batch"), F.when(F.col("o_orderkey") % 997 == 0, None).otherwise(F.col("o_orderkey")).cast("string").alias("product"), F.when(F.col("o_orderkey") % 499 == 0, -1).otherwise(F.pmod("o_custkey", F.lit(400))).alias("row_batch"))
    return reconcile.sound_batches(o).select("batch", "product")


def non_pdf_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    one = F.concat(F.lit("未取得 PDF：/data/第"), F.col("batch"), F.lit("批/[国]"), F.col("trademark"), F.lit("_"), F.col("model_code"), F.lit("_"), F.when(F.col("id") % 6 == 0, "1").otherwise(F.col("batch")), F.lit("_"), F.col("id"), F.lit(".html"))
    log = c.withColumn("error", F.when(F.col("id") % 5 == 0, "其他错误").otherwise(F.concat_ws("; ", one, F.when(F.col("id") % 2 == 0, one))))
    attempts = reconcile.attempt_evidence(log.select(F.col("id").alias("run_id"), "error"))
    return latest.latest_per_key(attempts, ["product", "batch", "model"], [F.col("run_id").desc()]).select("product", "batch", "model", "run_id")


def stored_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models with an underscore and a slash; runs that are not completed, outcomes that are not partial, paths and batches that don't fit."""
    c, k = catalog(spark, sf_dir), F.col("id")
    model = F.concat(F.lit("A_"), F.replace("model_code", F.lit("-"), F.lit("/")))
    file = F.concat(F.when(k % 11 == 0, "../").otherwise("downloads/"), F.lit("第"), F.col("batch"), F.lit("批/国_"), F.replace(model, F.lit("/"), F.lit("_")), F.lit("_"), F.when(k % 7 == 0, "172").otherwise(F.col("batch")), F.lit("_p"), k % 400, F.lit(".html"))
    error = F.concat_ws("; ", F.when(k % 3 == 0, "查询失败"), F.concat(F.lit("接口返回非 PDF，已存为 HTML；原文件："), file))
    rows = c.select(k.alias("run_id"), F.when(k % 5 == 0, "").otherwise("2024-01-01").alias("completed_at"), F.when(k % 13 == 0, "done").otherwise("partial").alias("status"), model.alias("model"), error.alias("error"))
    return reconcile.stored_answers(rows).select("product", "batch", "key", "run_id", "model")


def refresh_unavailable(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    refresh = c.select(F.col("id").alias("product"), "batch", F.lower("model_code").alias("model"))
    attempts = c.select(F.col("id").alias("product"), F.when(F.col("id") % 2 == 0, "999").otherwise(F.col("batch")).alias("batch"), F.col("model_code").alias("model"))
    return reconcile.refresh_split(refresh, attempts)


def download_slots_10min(spark: SparkSession, sf_dir: str) -> DataFrame:
    slot = F.substring(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), 1, 15)
    return table(spark, sf_dir, "events").groupBy(slot.alias("slot")).agg(F.count("*").alias("n"))


def batch_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    lo = F.pmod("p_partkey", F.lit(50)) + 300
    e = F.concat(lo.cast("string"), F.lit("-"), (lo + F.col("p_size") % 5).cast("string"), F.lit(", "), (lo + 2).cast("string"), F.lit("，"), F.lit("173"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(values.batch_list(e).cast("array<string>"), ",").alias("batches"))


def generation_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").alias("generation")).agg(F.count("*").alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))
    w = Window.orderBy("generation")  # one row per generation
    return g.select("generation", "n", "errors", (F.col("n") - F.lag("n").over(w)).alias("n_delta"), (F.col("errors") - F.lag("errors").over(w)).alias("errors_delta"))


def generation_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy(F.dayofmonth("ts").alias("generation")).agg(F.count("*").alias("n"))
    g.withColumn("previous", F.when(F.col("generation") > 1, F.col("generation") - 1)).createOrReplaceTempView("__generations")
    return spark.sql("""
        WITH RECURSIVE chain(generation, n, previous, depth) AS (
          SELECT generation, n, previous, 1 FROM __generations WHERE generation = 30
          UNION ALL SELECT g.generation, g.n, g.previous, depth + 1 FROM __generations g JOIN chain c ON g.generation = c.previous WHERE depth < 10)
        SELECT generation, n, depth FROM chain""")


def added_removed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = catalog(spark, sf_dir).where("id % 3 <> 0").groupBy(F.col("batch").alias("name")).agg(F.sum("id").cast("string").alias("digest"))
    before = catalog(spark, sf_dir).where("id % 5 <> 0").groupBy(F.col("batch").alias("name")).agg(F.sum("id").cast("string").alias("digest"))
    return merge.changed_since(now, before, "name", "digest")


def consecutive_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return reconcile.failure_runs(e, ["ts", "event_id"], ["user_id"], F.col("event_type") == "error").where("length >= 2").select("user_id", F.col("first").cast("bigint").alias("first"), F.col("length").cast("bigint").alias("length"))


def event_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "value")

    old = e.where("ts < '2024-01-15'").groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"), F.max("value").alias("value"))
    new = e.where("ts >= '2024-01-10'").groupBy("user_id", "event_type").agg(F.min("ts").alias("first_seen"), F.max("value").alias("value"))
    return merge.upsert(old, new, ["user_id", "event_type"], keep_old=["first_seen"])


def event_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    result = F.when(F.col("event_type").isin("view", "click"), "ok").when(F.col("event_type") == "signup", "non_pdf").otherwise("failed")
    per = reconcile.event_status(e.select(F.concat_ws("-", "user_id", F.dayofmonth("ts"), F.floor(F.hour("ts") / 6)).alias("event_id"), result.alias("result")))
    models = reconcile.model_status(per.withColumn("model", F.substring_index("event_id", "-", 1)))
    return per.groupBy("status").agg(F.count("*").alias("events")).join(models.groupBy("status").agg(F.count("*").alias("models")), "status", "full").select("status", F.coalesce("events", F.lit(0)).alias("events"), F.coalesce("models", F.lit(0)).alias("models"))


def scope_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    gate = F.when(F.col("product") % 2 == 0, "accepted").when(F.col("product") % 3 == 0, "excluded").otherwise("pending_review")
    o = occurrences(spark, sf_dir).select(F.pmod("product", F.lit(40)).alias("model"), "batch", gate.alias("gate"))
    return reconcile.scope_evidence(o)


def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = runs(spark, sf_dir)
    return r.groupBy("user_id").agg(*(F.count_if(F.col("status") == s).alias(s) for s in ("done", "partial", "no_match", "query_failed")), F.count("*").alias("models"))


def map_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    old = F.create_map(F.lit("a"), F.col("fuel"), F.lit("b"), F.col("batch"), F.lit("engine"), F.col("seq"))
    new = F.create_map(F.lit("a"), F.col("energy_type"), F.lit("c"), F.col("trademark"), F.lit("engine"), F.col("range_km"))
    get = lambda m, k: F.coalesce(F.try_element_at(m, F.lit(k)), F.lit("<none>"))
    merged, filled, over, default = values.merge_fields(old, new, ["engine"]), values.fill_blank(old, new), values.overwrite(old, new), values.set_default(old, new)
    return c.select("id", get(merged, "engine").alias("merged"), get(filled, "a").alias("filled"), get(over, "a").alias("overwritten"), get(default, "a").alias("defaulted"), F.array_join(values.changed_keys(old, new), ",").alias("changed"))


_D = f"DATE '{TODAY}'"
O, C = "WITH " + SQL_OCCURRENCES, "WITH " + SQL_CATALOG
SQL_REPUBLISHED = SQL_OCCURRENCES + """, local AS (SELECT product, max(batch) AS local_batch FROM occurrences WHERE status = 'F' GROUP BY 1), top AS (SELECT product, max(batch) AS batch FROM occurrences WHERE product % 17 <> 0 GROUP BY 1),
rep AS (SELECT product, local_batch, batch FROM top JOIN local USING (product) WHERE local_batch < batch)"""
_STATUS = f"([{', '.join(map(repr, OUTCOMES))}])[id % {len(OUTCOMES)} + 1]"
ORACLES = {
    "republished_products": f"WITH {SQL_REPUBLISHED} SELECT * FROM rep",
    "republished_limited": f"WITH {SQL_REPUBLISHED} SELECT product, batch, (SELECT count(*) FROM rep) AS total, greatest((SELECT count(*) FROM rep) - 120, 0) AS remaining FROM rep ORDER BY batch DESC, product LIMIT 100 OFFSET 20",
    "official_list_flag": f"{O} SELECT p_partkey AS product, p_partkey % 80 + 1 AS batch, EXISTS (SELECT 1 FROM occurrences o WHERE o.product = p_partkey AND o.batch = p_partkey % 80 + 1) AS listed FROM part",
    "db_only_by_band": "SELECT CASE WHEN b >= 408 THEN '408+' WHEN b BETWEEN 173 AND 299 THEN '173-299' WHEN b BETWEEN 300 AND 349 THEN '300-349' WHEN b BETWEEN 350 AND 399 THEN '350-399' WHEN b BETWEEN 400 AND 407 THEN '400-407' ELSE 'other' END AS band, count(*) AS n FROM (SELECT 173 + o_orderkey % 250 AS b FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)) GROUP BY 1",
    "best_outcome": f"WITH {SQL_RUNS} SELECT key, CAST({SQL_RANK} AS BIGINT) AS rank, status FROM runs QUALIFY row_number() OVER (PARTITION BY key ORDER BY {SQL_RANK} DESC, run_id DESC) = 1",
    "outcome_tally": f"WITH {SQL_RUNS}, b AS (SELECT key, status FROM runs QUALIFY row_number() OVER (PARTITION BY key ORDER BY {SQL_RANK} DESC, run_id DESC) = 1) SELECT status, count(*) AS n FROM b GROUP BY 1",
    "coverage_buckets": f"WITH {SQL_COVERAGE} SELECT bucket, count(*) AS n FROM coverage GROUP BY 1",
    "coverage_pct": f"WITH {SQL_COVERAGE} SELECT bucket, printf('%.1f%%', count(*) * 100.0 / (SELECT count(*) FROM coverage)) AS share FROM coverage GROUP BY 1",
    "event_window": f"WITH {SQL_EVENTS} SELECT event_id, batch > 78 AND batch <= 80 AND {_D} - event_date BETWEEN 0 AND 20 AS inside FROM evs",
    "event_buckets": f"""WITH {SQL_EVENTS}, v AS (SELECT model, batch, bool_and(valid) AS ok FROM edocs GROUP BY 1, 2), v1 AS (SELECT model, batch, product, bool_and(valid) AS ok FROM edocs GROUP BY 1, 2, 3)
SELECT CASE WHEN gate <> 'accepted' THEN gate WHEN NOT (e.batch > 78 AND e.batch <= 80 AND {_D} - event_date BETWEEN 0 AND 60) THEN CASE WHEN status = 'done' THEN 'out_of_window_done' ELSE 'dormant' END
  WHEN coalesce(CASE WHEN e.product = '' THEN v.ok ELSE v1.ok END, false) THEN 'resolved_valid_pdf' WHEN next_check > {_D} THEN 'deferred' ELSE 'due' END AS bucket, count(*) AS n
FROM evs e LEFT JOIN v ON v.model = e.model AND v.batch = e.batch LEFT JOIN v1 ON v1.model = e.model AND v1.batch = e.batch AND v1.product = e.product GROUP BY 1""",
    "retry_plan_groups": f"WITH {SQL_EVENTS}, o AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN CAST(event_date AS VARCHAR) ELSE '' END AS c FROM evs), g AS (SELECT model, batch, min((c, event_id)) AS f FROM o GROUP BY 1, 2), r AS (SELECT model, batch, row_number() OVER (ORDER BY f) AS k FROM g) SELECT event_id, CASE WHEN k <= 40 THEN 'pending' ELSE 'remaining' END AS plan FROM o JOIN r USING (model, batch)",
    "missing_reasons": f"""{C}, best AS (SELECT model_code AS model, status FROM (SELECT *, {_STATUS} AS status FROM catalog WHERE official_category IN ('专用车', '客车')) QUALIFY row_number() OVER (PARTITION BY model_code ORDER BY {SQL_RANK} DESC, id DESC) = 1),
e AS (SELECT user_id AS product, array_to_string(list_sort(list_distinct(list(event_type))), ';') AS events FROM events GROUP BY 1)
SELECT c.id AS product, c.model_code AS model, CASE WHEN c.model_code IN (SELECT model_code FROM catalog WHERE official_category = '乘用车' AND energy_type = '纯电动') THEN 'model_has_other_pdf' WHEN status = 'no_match' THEN 'no_match' WHEN status IN ('query_failed', 'interrupted', 'querying') THEN 'query_failed'
  WHEN c.model_code IN (SELECT model_code FROM catalog WHERE official_category = '载货汽车') THEN 'vehicle_known' WHEN events IS NOT NULL THEN 'has_events' ELSE 'never_seen' END AS reason, coalesce(events, '') AS events
FROM catalog c LEFT JOIN best ON best.model = c.model_code LEFT JOIN e ON e.product = c.id""",
    "mean_size_estimate": "WITH r AS (SELECT c_mktsegment AS channel, CAST(floor(o_totalprice) AS BIGINT) AS bytes, o_orderstatus AS s FROM orders JOIN customer ON o_custkey = c_custkey), m AS (SELECT channel, avg(bytes) AS mean FROM r WHERE s = 'F' GROUP BY 1) SELECT channel, count(*) AS n, CAST(round_even(count(*) * any_value(mean), 0) AS BIGINT) AS estimated FROM r LEFT JOIN m USING (channel) WHERE s = 'P' GROUP BY 1",
    "document_states": f"""WITH d AS (SELECT doc_id, quality AS is_pdf, CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END AS size, CASE WHEN doc_id % 19 = 0 THEN '' ELSE 'f/' || doc_id END AS path, toxic = 1 AS failed, CASE WHEN doc_id % 7 = 0 THEN n_chars + 1 ELSE n_chars END AS found FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, CASE WHEN is_pdf IS NULL THEN 'no_document' WHEN failed OR (is_pdf = 0 AND size = 0) THEN 'download_failed' WHEN path = '' OR size = 0 OR found <> size THEN 'pdf_invalid' WHEN is_pdf = 0 THEN 'non_pdf' WHEN doc_id % 5 = 0 THEN 'pdf_unparsed' ELSE 'parsed' END AS state FROM d""",
    "cache_completeness": f"{C} SELECT id, id % 6 <> 0 AND id % 5 <> 0 AND id % 15 <> 1 AND id % 4 <> 1 AND id % 12 <> 0 AND id % 10 <> 0 AND id % 28 + 1 <= 19 AND id % 28 + 1 >= 13 AS complete FROM catalog",
    "cache_diagnostics": "WITH c AS (SELECT user_id AS batch, max(ts) AS complete_at FROM events WHERE event_type = 'view' GROUP BY 1), n AS (SELECT user_id AS batch, ts, event_type = 'error' AS partial FROM events WHERE event_type <> 'view' QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type = 'error' DESC) = 1) SELECT batch, partial, coalesce(complete_at > ts, false) AS superseded FROM n LEFT JOIN c USING (batch)",
    "missing_batches": f"WITH b AS (SELECT DISTINCT CAST(n_chars % 700 AS BIGINT) AS batch FROM documents) SELECT s AS batch FROM (SELECT unnest(range((SELECT min(batch) FROM b), (SELECT max(batch) + 1 FROM b))) AS s) WHERE s NOT IN (SELECT batch FROM b)",
    "sound_batches": "WITH o AS (SELECT o_custkey % 400 AS batch, CASE WHEN o_orderkey % 997 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS product, CASE WHEN o_orderkey % 499 = 0 THEN -1 ELSE o_custkey % 400 END AS rb FROM orders) SELECT batch, product FROM o WHERE batch NOT IN (SELECT batch FROM o WHERE product IS NULL OR rb <> batch)",
    "non_pdf_attempts": f"{C} SELECT CAST(id AS VARCHAR) AS product, batch, upper(model_code) AS model, id AS run_id FROM catalog WHERE id % 5 <> 0 AND (id % 6 <> 0 OR batch = '1')",
    "stored_answers": f"""{C}, a AS (SELECT 'p' || (id % 400) AS product, CAST(batch AS BIGINT) AS batch, upper('A_' || replace(model_code, '-', '/')) AS key, id AS run_id, 'A_' || replace(model_code, '-', '/') AS model FROM catalog
  WHERE id % 5 <> 0 AND id % 13 <> 0 AND id % 11 <> 0 AND (id % 7 <> 0 OR batch = '172')) SELECT product, batch, key, max(run_id) AS run_id, arg_max(model, run_id) AS model FROM a GROUP BY product, batch, key""",
    "refresh_unavailable": f"{C} SELECT id AS product, batch, model_code AS model, CASE WHEN id % 2 <> 0 THEN 'refresh_source_unavailable' ELSE 'refresh' END AS list FROM catalog",
    "download_slots_10min": "SELECT substr(strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 15) AS slot, count(*) AS n FROM events GROUP BY 1",
    "batch_expression": "SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat([173], range(300 + p_partkey % 50, 300 + p_partkey % 50 + p_size % 5 + 1), [302 + p_partkey % 50]))), ',') AS batches FROM part",
    "generation_delta": "WITH g AS (SELECT CAST(day(ts) AS INTEGER) AS generation, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1) SELECT *, n - lag(n) OVER (ORDER BY generation) AS n_delta, errors - lag(errors) OVER (ORDER BY generation) AS errors_delta FROM g",
    "generation_chain": "SELECT CAST(day(ts) AS INTEGER) AS generation, count(*) AS n, CAST(31 - day(ts) AS INTEGER) AS depth FROM events WHERE day(ts) BETWEEN 21 AND 30 GROUP BY 1, 3",
    "added_removed_batches": f"{C}, a AS (SELECT batch, sum(id) AS d FROM catalog WHERE id % 3 <> 0 GROUP BY 1), b AS (SELECT batch, sum(id) AS d FROM catalog WHERE id % 5 <> 0 GROUP BY 1) SELECT coalesce(a.batch, b.batch) AS name, CASE WHEN b.d IS NULL THEN 'added' WHEN a.d IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.batch = b.batch WHERE a.d IS DISTINCT FROM b.d",
    "consecutive_failures": "WITH n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events), i AS (SELECT *, k - sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS g FROM n) SELECT user_id, min(k) AS first, count(*) AS length FROM i WHERE event_type = 'error' GROUP BY user_id, g HAVING count(*) >= 2",
    "event_upsert": "WITH o AS (SELECT user_id, event_type, min(ts) AS first_seen, max(value) AS value FROM events WHERE ts < '2024-01-15' GROUP BY 1, 2), n AS (SELECT user_id, event_type, min(ts) AS first_seen, max(value) AS value FROM events WHERE ts >= '2024-01-10' GROUP BY 1, 2) SELECT user_id, event_type, coalesce(o.first_seen, n.first_seen) AS first_seen, CASE WHEN n.user_id IS NOT NULL THEN n.value ELSE o.value END AS value FROM o FULL JOIN n USING (user_id, event_type)",
    "event_status_rollup": """WITH r AS (SELECT user_id, user_id || '-' || day(ts) || '-' || (hour(ts) // 6) AS e, CASE WHEN event_type IN ('view', 'click') THEN 'ok' WHEN event_type = 'signup' THEN 'non_pdf' ELSE 'failed' END AS r FROM events),
s AS (SELECT user_id, e, CASE WHEN bool_and(r = 'ok') THEN 'done' WHEN bool_and(r IN ('ok', 'non_pdf')) AND NOT bool_or(r = 'ok') THEN 'no_document' ELSE 'partial' END AS status FROM r GROUP BY 1, 2),
m AS (SELECT user_id, CASE WHEN bool_and(status = 'done') THEN 'done' WHEN bool_or(status = 'done') THEN 'partial' ELSE 'no_match' END AS status FROM s GROUP BY 1),
a AS (SELECT status, count(*) AS events FROM s GROUP BY 1), b AS (SELECT status, count(*) AS models FROM m GROUP BY 1) SELECT status, coalesce(events, 0) AS events, coalesce(models, 0) AS models FROM a FULL JOIN b USING (status)""",
    "scope_evidence": f"{O}, g AS (SELECT product % 40 AS model, batch, CASE WHEN product % 2 = 0 THEN 'accepted' WHEN product % 3 = 0 THEN 'excluded' ELSE 'pending_review' END AS gate FROM occurrences) SELECT model, batch, CASE WHEN min(gate) = max(gate) AND min(gate) <> 'pending_review' THEN min(gate) ELSE 'pending_review' END AS gate, min(gate) <> max(gate) AS conflicting FROM g GROUP BY 1, 2",
    "run_counters": f"WITH {SQL_RUNS} SELECT user_id, {', '.join(f'count(*) FILTER (status = {s!r}) AS {s}' for s in ('done', 'partial', 'no_match', 'query_failed'))}, count(*) AS models FROM runs GROUP BY 1",
    "map_merge": f"{C} SELECT id, range_km AS merged, CASE WHEN fuel <> '' THEN fuel ELSE energy_type END AS filled, CASE WHEN energy_type <> '' THEN energy_type ELSE fuel END AS overwritten, fuel AS defaulted, concat_ws(',', CASE WHEN fuel <> energy_type THEN 'a' END, 'b', 'c', CASE WHEN seq <> range_km THEN 'engine' END) AS changed FROM catalog",
}
QUERIES = {name: globals()[name] for name in ORACLES}
