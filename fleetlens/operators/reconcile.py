"""Reconciling what official batches list with what has been collected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import norm_model, safe_part, safe_relative


def best_outcomes(runs: DataFrame, key: str = "key", status: str = "status", run: str = "run_id") -> DataFrame:
    """Best outcome of each key over all runs: highest rank, the later run on ties."""
    best = F.max(F.struct(rules.outcome_rank(F.col(status)).alias("rank"), F.col(run), F.col(status)))
    return runs.groupBy(key).agg(best.alias("best")).select(key, F.col("best.rank").alias("rank"), F.col(f"best.{status}").alias("status"))


def coverage(catalog: DataFrame, documents: DataFrame, outcomes: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Bucket of every distinct catalogue code; the buckets exclude each other.

    catalog (code), documents (code, is_pdf, bytes, error), outcomes (key, status), vehicles (code).
    """
    failed = F.coalesce(F.col("error"), F.lit("")).startswith(rules.FAILED_DOWNLOAD)
    seen = documents.groupBy(norm_model(F.col("code")).alias("code")).agg(
        F.max(F.col("is_pdf") == 1).alias("pdf"), F.max((F.col("is_pdf") == 0) & (F.col("bytes") > 0) & ~failed).alias("other"), F.lit(True).alias("announced")
    )
    best = outcomes.select(norm_model(F.col("key")).alias("code"), "status")
    pool = vehicles.select(norm_model(F.col("code")).alias("code"), F.lit(True).alias("pooled")).distinct()
    every = catalog.select(norm_model(F.col("code")).alias("code")).where("code <> ''").distinct()
    joined = every.join(seen, "code", "left").join(best, "code", "left").join(pool, "code", "left")
    bucket = (
        F.when(F.col("pdf"), "downloaded")
        .when(F.col("other"), "no_pdf")
        .when((F.col("status") == "no_match") & F.col("announced").isNull(), "absent")
        .when(F.col("pooled").isNull() & F.col("announced").isNull(), "unseen")
        .when(F.col("status") == "awaiting_effective", "waiting")
        .otherwise("retry")
    )
    return joined.select("code", bucket.alias("bucket"))


def republished(universe: DataFrame, local: DataFrame) -> DataFrame:
    """Products whose highest listed batch lies above the local one; excluded ones stay out.

    universe (product, batch, gate), local (product, local_batch). The highest batch is
    taken before the join, so it sees a row per product.
    """
    top = universe.where("gate <> 'excluded'").groupBy("product").agg(F.max("batch").alias("batch"))
    return top.join(local, "product").where("local_batch < batch").select("product", "local_batch", "batch")


def candidates(catalog: DataFrame, vehicles: DataFrame, order: list[Column], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Latest catalogue row per model that isn't a known vehicle yet, in collection order."""
    from .latest import latest_per_key

    new = catalog.where("model_code <> ''").join(vehicles.select("model_code").distinct(), "model_code", "left_anti")
    one = latest_per_key(new, ["model_code"], [F.col("batch").desc(), F.col("id").asc()])
    page = one.orderBy(*order).offset(offset)
    return page if limit is None else page.limit(limit)


def sound_batches(products: DataFrame) -> DataFrame:
    """Products of batches in which every row has an id, the right batch and an id of its own."""
    ok = products.groupBy("batch").agg(
        F.every((F.col("product") != "") & F.col("product").isNotNull() & (F.col("row_batch") == F.col("batch"))).alias("whole"),
        (F.countDistinct("product") == F.count("*")).alias("unique"),
    )
    return products.join(ok.where("whole and `unique`").select("batch"), "batch", "left_semi")


def complete_cache(version: Column, complete: Column, absent: Column, prefixes: Column, expected: list[str], missed: Column, failures: Column,
                   fetched: Column, now: Column, current_version: int = 4, days: int | None = None) -> Column:
    """Whether a batch cache may be used: right version, complete, verified by just the expected prefixes, dated in the past."""
    same = F.array_sort(F.array_distinct(F.coalesce(prefixes, F.array().cast("array<string>")))) == F.array_sort(F.array_distinct(F.array(*map(F.lit, expected)).cast("array<string>")))
    at = F.try_to_timestamp(fetched)
    good = (version == current_version) & complete & ~F.coalesce(absent, F.lit(False)) & same & (F.coalesce(missed, F.lit(0)) == 0) & (F.size(failures) <= 0) & (at <= now)
    if days is not None:
        good = good & (at >= now - F.expr(f"INTERVAL {days} DAYS"))
    return F.coalesce(good, F.lit(False))


def superseded_evidence(evidence: DataFrame, complete: DataFrame) -> DataFrame:
    """Newest evidence per batch, marked superseded where a complete cache is newer.

    evidence (batch, at, partial, main), complete (batch, complete_at).
    """
    w = Window.partitionBy("batch").orderBy(F.col("at").desc(), F.col("partial").desc(), F.col("main").desc())
    newest = evidence.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return newest.join(complete, "batch", "left").withColumn("superseded", F.coalesce(F.col("complete_at") > F.col("at"), F.lit(False)))


def missing_batches(present: DataFrame, batch: str = "batch") -> DataFrame:
    """Numbers between the least and greatest batch that don't occur."""
    ends = present.agg(F.min(batch).alias("lo"), F.max(batch).alias("hi")).where("lo is not null")
    return ends.select(F.explode(F.sequence("lo", "hi")).alias(batch)).join(present.select(batch).distinct(), batch, "left_anti")


def event_buckets(events: DataFrame, documents: DataFrame, today: Column, latest: Column) -> DataFrame:
    """Events with their bucket: gate, done, dormant, resolved, deferred or due.

    An event without product stands for all products of its model and batch and is
    resolved only if all are valid. The optional key makes two equi-joins, not one with OR.
    """
    valid = documents.groupBy("model", "batch").agg(F.every("valid").alias("all_valid"))
    one = documents.groupBy("model", "batch", "product").agg(F.every("valid").alias("all_valid"))
    named, open_ = events.where("product <> ''"), events.where("coalesce(product, '') = ''")
    matched = named.join(one, ["model", "batch", "product"], "left").unionByName(open_.join(valid, ["model", "batch"], "left"), allowMissingColumns=True)
    window = rules.in_window(F.col("event_date"), today, F.col("batch"), latest)
    bucket = (
        F.when(F.col("gate") != "accepted", F.col("gate"))
        .when(~window & (F.col("status") == "done"), "out_of_window_done")
        .when(~window, "dormant")
        .when(F.coalesce(F.col("all_valid"), F.lit(False)), "resolved_valid_pdf")
        .when(F.col("next_check") > today, "deferred")
        .otherwise("due")
    )
    return matched.withColumn("bucket", bucket)


def retry_plan(events: DataFrame, limit: int) -> DataFrame:
    """Events in check order, split by whether their (model, batch) is among the first ``limit`` groups.

    Only one row per group is ranked; the ranking of groups is a sort of the groups.
    """
    order = F.struct(F.coalesce(F.col("last_checked"), F.lit("")).alias("c"), F.col("event_id"))
    groups = events.groupBy("model", "batch").agg(F.min(order).alias("first"))
    chosen = groups.orderBy("first.c", "first.event_id").limit(limit).select("model", "batch", F.lit(True).alias("__in"))
    return events.join(chosen, ["model", "batch"], "left").withColumn("plan", F.when(F.col("__in"), "pending").otherwise("remaining")).drop("__in")


def event_status(results: DataFrame) -> DataFrame:
    """Status of an event from the results (event_id, result) of its products."""
    bad = results.withColumn("ok", F.col("result") == "ok").withColumn("no_pdf", F.col("result") == "non_pdf")
    agg = bad.groupBy("event_id").agg(F.every("ok").alias("all_ok"), F.every(F.col("ok") | F.col("no_pdf")).alias("soft"), F.some("ok").alias("any_ok"))
    return agg.select("event_id", F.when(F.col("all_ok"), "done").when(F.col("soft") & ~F.col("any_ok"), "no_document").otherwise("partial").alias("status"))


def model_status(events: DataFrame) -> DataFrame:
    """Status of a model from those of its events (model, status)."""
    done = F.col("status") == "done"
    return events.groupBy("model").agg(F.every(done).alias("all"), F.some(done).alias("any")).select(
        "model", F.when(F.col("all"), "done").when(F.col("any"), "partial").otherwise("no_match").alias("status")
    )


def scope_evidence(products: DataFrame) -> DataFrame:
    """Verdict per (model, batch): its products' common gate, pending_review where they differ."""
    g = products.groupBy("model", "batch").agg(F.min("gate").alias("lo"), F.max("gate").alias("hi"))
    same = F.col("lo") == F.col("hi")
    return g.select("model", "batch", F.when(same & F.col("lo").isin("accepted", "excluded"), F.col("lo")).otherwise("pending_review").alias("gate"), (~same).alias("conflicting"))


def refresh_split(refresh: DataFrame, attempts: DataFrame) -> DataFrame:
    """Refresh candidates, those with a failed attempt for just this (product, batch, model) set aside."""
    tried = attempts.select("product", "batch", norm_model(F.col("model")).alias("model"), F.lit(True).alias("tried")).distinct()
    joined = refresh.withColumn("model", norm_model(F.col("model"))).join(tried, ["product", "batch", "model"], "left")
    return joined.withColumn("list", F.when(F.col("tried"), "refresh_source_unavailable").otherwise("refresh")).drop("tried")


def missing_reasons(missing: DataFrame, valid_models: DataFrame, outcomes: DataFrame, vehicles: DataFrame, events: DataFrame) -> DataFrame:
    """Why a listed product has no document; the first reason that holds.

    missing (product, model), valid_models (model), outcomes (model, status), vehicles (model), events (product, event).
    """
    v, k = (d.select("model", F.lit(True).alias(n)).distinct() for d, n in ((valid_models, "has_pdf"), (vehicles, "known")))
    e = events.groupBy("product").agg(F.array_join(F.array_sort(F.collect_set("event")), ";").alias("events"))
    joined = missing.join(v, "model", "left").join(outcomes, "model", "left").join(k, "model", "left").join(e, "product", "left")
    reason = (
        F.when(F.col("has_pdf"), "model_has_other_pdf")
        .when(F.col("status") == "no_match", "no_match")
        .when(F.col("status").isin("query_failed", "interrupted", "querying"), "query_failed")
        .when(F.col("known"), "vehicle_known")
        .when(F.col("events").isNotNull(), "has_events")
        .otherwise("never_seen")
    )
    return joined.select("product", "model", reason.alias("reason"), F.coalesce("events", F.lit("")).alias("events"))


def size_estimate(present: DataFrame, missing: DataFrame) -> DataFrame:
    """Bytes to expect for missing products: their channel's mean, rounded half to even."""
    mean = present.groupBy("channel").agg(F.avg("bytes").alias("mean"))
    return missing.groupBy("channel").count().join(mean, "channel", "left").select("channel", F.col("count").alias("n"), F.bround(F.col("count") * F.col("mean")).cast("bigint").alias("estimated"))


def attempt_evidence(rows: DataFrame, text: str = "error") -> DataFrame:
    """Attempts named in error texts: path '.../第{batch}批/[prefix]{trademark}_{model}_{batch}_{product}.html'.

    Both batches must agree; a text may name several files.
    """
    path = r"第(\d+)批/([^/;]+)\.html"
    found = rows.withColumn("__f", F.explode(F.regexp_extract_all(F.col(text), F.lit(path), 0)))
    parts = F.split(F.regexp_extract("__f", path, 2), "_")
    n = F.size(parts)
    out = found.withColumn("batch", F.regexp_extract("__f", path, 1)).withColumn("product", F.get(parts, n - 1)).withColumn("__b", F.get(parts, n - 2)).withColumn("model", F.upper(F.get(parts, n - 3)))
    return out.where("size(split(__f, '_')) >= 4 and __b = batch and product <> ''").drop("__f", "__b")


#: Fixed value: how a stored answer names its file.
STORED_ANSWER = r"(?:^|; )接口返回非 PDF，已存为 HTML；原文件：([^;\r\n]+?\.html)(?=; |$)"
#: The first batch that is kept in folders of its own.
FIRST_BATCH = 173


def stored_answers(attempts: DataFrame) -> DataFrame:
    """Answers other than PDF that completed runs have stored for products: one row each, the last run's.

    attempts (run_id, completed_at, status, model, error). A text may name several files
    '第{batch}批/{prefix}_{model}_{batch}_{product}.html', below other folders or not. It
    counts if the run is completed and the model's outcome is partial, the path stays below
    its root, both batches agree and are kept in folders, and the prefix ends in the
    model's own name as files have it, underscores included.
    """
    done = attempts.where("coalesce(completed_at, '') <> '' AND status = 'partial'").withColumn("model", F.trim("model")).where("model <> ''")
    named = done.withColumn("path", F.explode(F.regexp_extract_all("error", F.lit(STORED_ANSWER), 1))).withColumn("path", F.replace("path", F.lit("\\"), F.lit("/")))
    part = lambda k: F.regexp_extract("path", r"(?:^|/)第(\d+)批/(?:([^/]*)_)([0-9]+)_([^_/]+)\.html$", k)
    cut = named.where(safe_relative(F.col("path"))).select("*", *(part(k).alias(a) for k, a in enumerate(("folder", "prefix", "number", "product"), 1)))
    batch = F.expr("try_cast(number AS bigint)")
    agreed = cut.where((F.col("product") != "") & (F.col("folder") == batch.cast("string")) & (batch >= FIRST_BATCH) & F.endswith("prefix", F.concat(F.lit("_"), safe_part(F.col("model")))))
    found = agreed.select("product", batch.alias("batch"), F.upper("model").alias("key"), F.struct("run_id", F.col("completed_at").alias("checked_at"), "model", "path").alias("last"))
    return found.groupBy("product", "batch", "key").agg(F.max("last").alias("last")).select("product", "batch", "key", "last.*")


def failure_runs(log: DataFrame, order: list[str], group: list[str], failed: Column) -> DataFrame:
    """Runs of consecutive failures (gaps and islands): group, first place, length."""
    base = Window.partitionBy(*group).orderBy(*order)
    n = log.withColumn("__bad", failed).withColumn("__n", F.row_number().over(base))
    island = n.withColumn("__i", F.col("__n") - F.sum(F.col("__bad").cast("int")).over(base.rowsBetween(Window.unboundedPreceding, 0)))
    return island.where("__bad").groupBy(*group, "__i").agg(F.min("__n").alias("first"), F.count("*").alias("length")).drop("__i")


def fingerprint(rows: DataFrame) -> DataFrame:
    """Rows and four sums of their digests' quarters, whatever the order of rows; equal rows don't cancel.

    Sums combine before the shuffle. A null counts as an empty text.
    """
    h = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rows.columns)))
    parts = [F.sum(F.conv(F.substring(h, k, 8), 16, 10).cast("bigint")).alias(f"part{i}") for i, k in enumerate((1, 9, 17, 25))]
    return rows.agg(F.count("*").alias("n"), *parts)


def revision_class(old: Column, new: Column, identity: list[str], significant: list[str]) -> Column:
    """Kind of a revised document from its old and new fields."""
    from ..functions.values import changed_keys

    keys = changed_keys(old, new)
    return (
        F.when(F.arrays_overlap(keys, F.array(*map(F.lit, identity))), "identity_changed")
        .when(F.arrays_overlap(keys, F.array(*map(F.lit, significant))), "parameters_changed")
        .when(F.size(keys) > 0, "minor_changes")
        .otherwise("same_content")
    )


def republish_check(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Selected republished products against a fresh query: confirmed, stale_record, missing or failed."""
    joined = expected.join(found, "product", "left")
    state = (
        F.when(F.col("error").isNotNull(), "failed")
        .when(F.col("found_batch").isNull(), "missing")
        .when(rules.at_least(F.col("found_batch"), F.col("batch")), "confirmed")
        .otherwise("stale_record")
    )
    return joined.select("product", "batch", "found_batch", state.alias("state"))
