"""Snapshots and what is recovered from them: evidence, photos, profiles, renames, messages and progress."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import blank_to_null, norm_key

# States of a snapshot's rows that nothing has replaced.
PLACEHOLDERS = ("pending_source", "fetch_failed")
# Outcomes of one product; only the first counts as success.
PRODUCT_OUTCOMES = ("downloaded", "skipped_existing", "image_failed", "download_failed", "non_pdf", "parse_failed", "publish_failed", "storage_failed")
# Names of channels as the registry stores them.
CHANNEL_LABELS = {"passenger": "乘用车", "truck": "货车", "bus": "客车", "special": "专用车"}
# Kinds of cache diagnostics that warn, with their names.
WARNINGS = {"partial_failed": "部分枚举失败", "invalid_cache": "缓存校验失败", "missing_cache": "缓存缺失且无来源证据"}
# Mode of runs that follow a manifest.
MANIFEST_MODE = "cached_product_manifest"


def evidence(fields: Column, engine_keys: list[str]) -> Column:
    """Fields without those of the engine block, as sorted entries: equal maps give equal arrays."""
    kept = F.map_filter(F.coalesce(fields, F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin(*engine_keys))
    return F.array_sort(F.map_entries(kept))


def recovered(records: DataFrame, live: DataFrame, engine_keys: list[str]) -> DataFrame:
    """Snapshot rows that still count: placeholders, and rows that the live registry has not replaced.

    records (product, snapshot, availability, fields), live (product, marker, fields), one
    row per product. A refresh of the engine block alone replaces nothing.
    """
    now = live.select("product", F.struct("marker", evidence(F.col("fields"), engine_keys).alias("fields")).alias("__now"))
    same = F.col("__now.marker").eqNullSafe(F.col("snapshot")) & (F.col("__now.fields") == evidence(F.col("fields"), engine_keys))
    return records.join(now, "product", "left").where(F.col("availability").isin(*PLACEHOLDERS) | (F.col("__now").isNotNull() & same)).drop("__now")


def orphans(photos: DataFrame, announcements: DataFrame, key: str) -> DataFrame:
    """Photos without an announcement; a sound snapshot has none."""
    return photos.join(announcements.select(key), key, "left_anti")


def photo_manifests(photos: DataFrame, announcements: DataFrame) -> DataFrame:
    """An index of photos for each announcement that has some.

    photos (public, path, pdf_offset, sha256, bytes), announcements (public, product, model,
    batch). A photo inside a PDF is named after its digest, another one keeps its name.
    The index is one document, so its entries are one row; an announcement has few photos.
    """
    name = F.when(F.col("pdf_offset").isNotNull(), F.concat(F.lit("recovered_"), F.col("sha256"), F.lit(".jpg"))).otherwise(F.substring_index("path", "/", -1))
    entry = F.struct(name.alias("file"), "bytes", "sha256")
    grouped = photos.groupBy("public").agg(F.array_sort(F.collect_list(entry)).alias("images"))
    return announcements.join(grouped, "public").select("public", "product", "model", "batch", F.lit("ok").alias("status"), F.size("images").alias("downloaded"), F.lit(0).alias("failed"), "images")


def recovered_profiles(series: DataFrame, rows: DataFrame) -> DataFrame:
    """Profiles of a snapshot's profile series, with the model codes and products of their members.

    series (series, name, source), rows (series, product, model).
    """
    members = rows.groupBy("series").agg(F.array_sort(F.collect_set("model")).alias("model_prefixes"), F.array_sort(F.collect_list("product")).alias("products"))
    kind = rows.schema["product"].dataType.simpleString()
    return series.where("source = 'profile'").join(members, "series", "left").select(
        "name", F.coalesce("model_prefixes", F.from_json(F.lit("[]"), "array<string>")).alias("model_prefixes"), F.coalesce("products", F.from_json(F.lit("[]"), f"array<{kind}>")).alias("products")
    )


def profile_entries(names: DataFrame, rows: DataFrame) -> DataFrame:
    """Profiles from announcements: what is not certain stays blank and is noted.

    names (name, prefixes), rows (name, trademark, product_name). notes holds the reasons in
    order: trademark not single, product name not single, no prefixes.
    """
    found = rows.groupBy("name").agg(
        F.array_sort(F.collect_set(blank_to_null(F.trim("trademark")))).alias("__marks"), F.array_sort(F.collect_set(blank_to_null(F.trim("product_name")))).alias("__titles")
    )
    none = F.array().cast("array<string>")
    j = names.join(found, "name", "left").select("name", F.coalesce("prefixes", none).alias("prefixes"), F.coalesce("__marks", none).alias("m"), F.coalesce("__titles", none).alias("t"))
    notes = F.array_compact(F.array(F.when(F.size("m") != 1, "trademark"), F.when(F.size("t") > 1, "product_name"), F.when(F.size("prefixes") == 0, "prefixes")))
    one = F.when(F.size("m") == 1, F.get("m", F.lit(0))).otherwise("")
    return j.select("name", one.alias("trademark"), F.when(F.size("t") == 1, F.get("t", F.lit(0))).alias("product_name"), "prefixes", notes.alias("notes"))


def profile_keys(name: Column, aliases: Column) -> Column:
    """Every key that a profile answers to."""
    named = F.filter(F.concat(F.array(name), F.coalesce(aliases, F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != ""))
    return F.array_distinct(F.transform(named, lambda x: norm_key(x)))


def profile_actions(old: DataFrame, new: DataFrame, overwrite: bool = False) -> DataFrame:
    """What becomes of each new profile: added, or updated or skipped where a key is known already.

    old (ordinal, keys), new (name, keys). target is the first profile of ``old`` that
    shares a key; others that share one stay. New profiles are compared with ``old`` only.
    """
    known = old.select("ordinal", F.explode("keys").alias("k")).groupBy("k").agg(F.min("ordinal").alias("ordinal"))
    hit = new.select("name", F.explode("keys").alias("k")).join(known, "k").groupBy("name").agg(F.min("ordinal").alias("target"))
    action = F.when(F.col("target").isNull(), "added").otherwise("updated" if overwrite else "skipped")
    return new.join(hit, "name", "left").withColumn("action", action)


def cache_messages(diagnostics: DataFrame) -> DataFrame:
    """Saved diagnostics as messages (severity, message); sources known to be absent are notices.

    diagnostics (category, batch, file, fetched_at, reason, retained).
    """
    batch = F.when(F.col("batch").isNull(), "批次未识别").otherwise(F.concat(F.lit("第 "), F.col("batch"), F.lit(" 批")))
    shown = F.concat(
        batch, F.lit("（"), F.coalesce(blank_to_null(F.col("file")), F.lit("无缓存文件")), F.lit("；"), F.coalesce(blank_to_null(F.col("fetched_at")), F.lit("时间未记录")), F.lit("）："),
        F.coalesce(blank_to_null(F.col("reason")), F.lit("原因未记录")), F.when(F.col("retained"), "；保留该批旧完整缓存作为历史基线").otherwise(""),
    )
    label = F.create_map(*(F.lit(x) for kv in WARNINGS.items() for x in kv))
    absent = F.col("category") == "known_source_absent"
    notice = F.concat(F.lit("上游接口不可用，属于来源范围说明："), shown, F.lit("；不作为成功的完整空批次，也不能据此认定该批公告不存在"))
    rows = diagnostics.where(absent | F.col("category").isin(*WARNINGS))
    return rows.select(
        "category", "batch", F.when(absent, "notice").otherwise("warning").alias("severity"), F.when(absent, notice).otherwise(F.concat(F.try_element_at(label, F.col("category")), F.lit("："), shown)).alias("message")
    )


def known_items(models: DataFrame, vehicles: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Identity of models: the registry's row, else the catalogue's. Codes are compared in upper case.

    vehicles and catalogue: (model, name, batch, category, company), one row per code.
    """

    def side(rows: DataFrame, at: str) -> DataFrame:
        return rows.select(F.upper("model").alias("__key"), F.struct(*(F.coalesce(c, F.lit("")).alias(c) for c in ("name", "batch", "category", "company")), F.lit(at).alias("origin")).alias(at))

    j = models.withColumn("__key", F.upper("model")).join(side(vehicles, "registry"), "__key", "left").join(side(catalogue, "catalogue"), "__key", "left")
    return j.select("model", F.coalesce("registry", "catalogue").alias("i")).where("i is not null").select("model", "i.*")


def store_outcomes(rows: DataFrame) -> DataFrame:
    """Typed outcomes: (ok, status) agree or the row is an error; a PDF that failed to parse is a PDF too."""
    status = F.coalesce(blank_to_null(F.col("status")), F.when(F.col("ok"), "downloaded"))
    sound = status.isin(*PRODUCT_OUTCOMES) & ((status == "downloaded") == F.col("ok"))
    checked = F.when(sound, status).otherwise(F.raise_error(F.concat(F.lit("outcome and status disagree: "), F.coalesce(status, F.lit("none")))))
    return rows.withColumn("status", checked).withColumn("has_pdf", F.col("status").isin("downloaded", "parse_failed"))


def vehicle_rows(listed: DataFrame, vehicles: DataFrame) -> DataFrame:
    """Vehicles that a manifest's products need: known ones by id, new ones with a category by channel.

    listed (model, name, batch), vehicles (model, vehicle).
    """
    found = rules.channel(F.col("model"), F.col("name"), F.lit(""), F.lit(""))["channel"]
    label = F.try_element_at(F.create_map(*(F.lit(x) for kv in CHANNEL_LABELS.items() for x in kv)), found)
    return listed.join(vehicles, "model", "left").withColumn("category", F.when(F.col("vehicle").isNull(), label))


def resumable(runs: DataFrame, sha256: str, scope: str) -> DataFrame:
    """Runs that may go on with a manifest: same digest, same scope, same mode."""
    return runs.where((F.col("sha256") == sha256.lower()) & (F.col("scope") == scope) & (F.col("mode") == MANIFEST_MODE))


def progress(products: DataFrame) -> DataFrame:
    """Counters of each run: processed, successful, bytes, and the seconds that the rest should take.

    products (run, status, bytes, seconds); a product without status is still to come;
    seconds are those of an attempted download.
    """
    done = F.col("status").isNotNull()
    tries = F.count(F.when(done, F.col("seconds")))
    left = F.count(F.when(~done, 1))
    return products.groupBy("run").agg(
        F.count("*").alias("selected"), F.count(F.when(done, 1)).alias("processed"), left.alias("remaining"), F.count(F.when(F.col("status").isin("downloaded", "skipped_existing"), 1)).alias("successful"),
        F.coalesce(F.sum(F.when(F.col("status") == "downloaded", F.col("bytes"))), F.lit(0)).alias("accepted_bytes"), tries.alias("attempts"),
        F.when(tries > 0, F.rint(F.sum(F.when(done, F.col("seconds"))) / tries * left).cast("bigint")).alias("estimated_seconds"),
    )


def plan_keys(changes: DataFrame) -> DataFrame:
    """How often a plan changes and preserves each key; changes (changed_keys, preserved_keys)."""

    def of(kind: str, keys: str) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    both = changes.select(F.explode(F.concat(of("changed", "changed_keys"), of("preserved", "preserved_keys"))).alias("e"))
    return both.groupBy("e.kind", "e.key").agg(F.count("*").alias("n"))


def uncovered(found: DataFrame, products: DataFrame) -> DataFrame:
    """Products of a search by prefix that the enumeration lacks, by trimmed id."""
    key = F.trim(F.coalesce("product", F.lit("")))
    return found.withColumn("__key", key).join(products.select(F.col("product").alias("__key")), "__key", "left_anti").drop("__key")


def renamed(rows: DataFrame, renames: DataFrame) -> DataFrame:
    """Rows after attachments got new names; renames (article, attachment, new_name)."""
    j = rows.join(renames, ["article", "attachment"], "left")
    return j.withColumn("attachment", F.coalesce("new_name", "attachment")).drop("new_name")


def category_counts(paths: DataFrame, path: str = "path") -> DataFrame:
    """PDF files below each directory of a root; paths are relative to it."""
    inside = paths.where(F.col(path).rlike(r"^[^/]+/.*\.pdf$"))
    return inside.groupBy(F.substring_index(path, "/", 1).alias("category")).agg(F.count("*").alias("n"))


def first_parameter(items: DataFrame, keyword: str, group: list[str]) -> DataFrame:
    """Values by spec of the first parameter whose label holds the keyword; blank spec ids don't count.

    items (ordinal, label, spec, value) and the group's columns.
    """
    hit = items.where(F.contains("label", F.lit(keyword))).withColumn("__first", F.min("ordinal").over(Window.partitionBy(*group)))
    return hit.where((F.col("ordinal") == F.col("__first")) & (F.trim(F.coalesce("spec", F.lit(""))) != "")).select(*group, "spec", "value")


def first_series(hits: DataFrame, group: list[str]) -> DataFrame:
    """The first hit that is a series; without one, whether brands were found or nothing sound.

    hits (rank, series, name, is_series) and the group's columns.
    """
    best = F.min(F.when(F.col("is_series"), F.struct("rank", "series", "name"))).alias("b")
    return hits.groupBy(*group).agg(best).select(*group, "b.series", "b.name", F.when(F.col("b").isNull(), "brand_only").otherwise("found").alias("verdict"))


def cache_files(batches: DataFrame) -> DataFrame:
    """File that a batch's enumeration is written to: absent upstream, partial with failures, else complete."""
    ending = F.when(F.col("absent"), ".absent.json").when(F.col("failures") > 0, ".partial.json").otherwise(".json")
    return batches.withColumn("file", F.concat(F.col("batch").cast("string"), ending))


def retried_images(manifests: DataFrame) -> DataFrame:
    """Products whose images are fetched again: the last index counts failures or can't be read.

    manifests (product, index: JSON text, null where there is none).
    """
    failed = F.get_json_object("index", "$.failed").try_cast("int")
    broken = F.try_parse_json("index").isNull()
    return manifests.where(F.col("index").isNotNull() & (broken | (F.coalesce(failed, F.lit(0)) > 0))).select("product")
