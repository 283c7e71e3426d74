"""Integrity of a site snapshot: every damage is a row (kind, subject, detail).

Tables: meta (key, value), rows (id, source_product_id, public_id, availability,
fields_json, is_pdf, doc_path, doc_bytes, doc_sha256), photos (public_id,
announcement_public_id, photo_path, pdf_offset, photo_bytes, photo_sha256, width, height),
series, indexed (the search index), and assets (path, length, content), as the source
``binaryFile`` gives them. Assets are hashed where they are read; only those with photos
inside travel with their content. A snapshot may be published if no row is found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_relative

#: What a snapshot must say of itself, and states of an announcement: fixed values.
SCHEMA_VERSION, SCOPE = "3", "automotive_complete_v1"
AVAILABILITY = ("published", "no_document", "pending_source", "fetch_failed")
PUBLIC_ID = "^[0-9a-f]{12}$"


def assets(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root``: path from there on, length and content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select(F.regexp_extract("path", f"{root.rstrip('/').split(':')[-1]}/(.*)$", 1).alias("path"), "length", "content")


def _found(df: DataFrame, subject: str, kinds: dict[str, Column], detail: Column | None = None) -> DataFrame:
    """A row for each of ``kinds`` that holds."""
    each = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(k)) for k, c in kinds.items()]), lambda k: k.isNotNull())
    said = F.lit("") if detail is None else F.coalesce(detail.cast("string"), F.lit(""))
    return df.select(F.explode(each).alias("kind"), F.coalesce(F.col(subject).cast("string"), F.lit("")).alias("subject"), said.alias("detail"))


def of_meta(meta: DataFrame, rows: DataFrame, series: DataFrame, indexed: DataFrame) -> DataFrame:
    """What the snapshot says of itself against what it holds."""
    said = meta.groupBy().pivot("key", ["schema_version", "collection_scope", "source_rows", "series_count", "published_rows"]).agg(F.first("value"))
    held = rows.agg(F.count("*").alias("held"), F.count_if(F.col("availability") == "published").alias("published"))
    one = said.select("*", F.lit("meta").alias("subject"))
    for name, df in (("held_rows", held.select("held")), ("held_published", held.select("published")), ("held_series", series.agg(F.count("*"))), ("held_indexed", indexed.agg(F.count("*")))):
        one = one.withColumn(name, df.scalar())
    number = lambda c: F.coalesce(F.expr(f"try_cast({c} AS bigint)"), F.lit(-1))
    return _found(one, "subject", {
        "schema_version": ~F.col("schema_version").eqNullSafe(SCHEMA_VERSION), "collection_scope": ~F.col("collection_scope").eqNullSafe(SCOPE), "source_rows": number("source_rows") != F.col("held_rows"),
        "series_count": number("series_count") != F.col("held_series"), "search_rows": F.col("held_rows") != F.col("held_indexed"), "published_rows": number("published_rows") != F.col("held_published"),
    })


def repeated(rows: DataFrame, column: str, kind: str) -> DataFrame:
    n = rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).where("n > 1")
    return _found(n, column, {kind: F.lit(True)}, F.col("n"))


def of_rows(rows: DataFrame) -> DataFrame:
    shape = F.expr("try_variant_get(try_parse_json(coalesce(nullif(fields_json, ''), '{}')), '$', 'map<string, variant>')")
    own = _found(rows, "source_product_id", {
        "no_product_id": F.coalesce(F.col("source_product_id"), F.lit("")) == "", "public_id_form": ~F.coalesce(F.col("public_id").rlike(PUBLIC_ID), F.lit(False)),
        "availability": ~F.coalesce(F.col("availability").isin(*AVAILABILITY), F.lit(False)), "fields_no_object": shape.isNull(),
    }, F.col("public_id"))
    return own.unionByName(repeated(rows, "source_product_id", "repeated_product")).unionByName(repeated(rows, "public_id", "repeated_public_id"))


def of_documents(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Published documents against the files they name."""
    known = files.select(F.col("path").alias("doc_path"), "length", (F.substring("content", 1, 4) == F.lit(b"%PDF")).alias("pdf"), F.sha2("content", 256).alias("sha"))
    d = rows.where("availability = 'published'").join(known, "doc_path", "left")
    safe, there = F.coalesce(safe_relative(F.col("doc_path")), F.lit(False)), F.col("length").isNotNull()
    return _found(d, "source_product_id", {
        "document_path": ~safe, "document_missing": safe & ~there, "document_flag": ~F.col("is_pdf").cast("int").eqNullSafe(1), "document_kind": there & ~F.col("pdf"),
        "document_bytes": there & ~F.col("length").eqNullSafe(F.col("doc_bytes").cast("bigint")), "document_digest": there & ~F.col("sha").eqNullSafe(F.col("doc_sha256")),
    }, F.col("doc_path"))


def of_photos(photos: DataFrame, rows: DataFrame, files: DataFrame) -> DataFrame:
    """Photos, alone in a file or inside their announcement's document."""
    owner = rows.groupBy(F.col("public_id").alias("announcement_public_id")).agg(F.min("doc_path").alias("owner_path"), F.lit(True).alias("owned"))
    p = photos.join(owner, "announcement_public_id", "left")
    inside, offset, n = F.col("pdf_offset").isNotNull(), F.col("pdf_offset").cast("bigint"), F.col("photo_bytes").cast("bigint")
    own = _found(p, "public_id", {
        "photo_owner": F.col("owned").isNull(), "photo_document": inside & F.col("owned") & ~F.col("photo_path").eqNullSafe(F.col("owner_path")), "photo_offset": inside & (offset < 0),
        "photo_size": (F.coalesce(n, F.lit(0)) <= 0) | (F.coalesce(F.col("width").cast("bigint"), F.lit(0)) <= 0) | (F.coalesce(F.col("height").cast("bigint"), F.lit(0)) <= 0),
        "photo_path": ~F.coalesce(safe_relative(F.col("photo_path")), F.lit(False)),
    }, F.col("photo_path"))
    hosts = photos.where(inside).select(F.col("photo_path").alias("path")).distinct()
    whole = files.select("path", "length", F.sha2("content", 256).alias("sha"))
    alone = photos.where(~inside).join(whole.withColumnRenamed("path", "photo_path"), "photo_path", "left").withColumn("wrong_size", ~F.col("length").eqNullSafe(n))
    parts = photos.where(inside).join(files.join(hosts, "path", "left_semi").withColumnRenamed("path", "photo_path"), "photo_path", "left")
    cut = F.substring(F.col("content"), (offset + 1).cast("int"), n.cast("int"))
    parts = parts.withColumn("sha", F.when((offset >= 0) & (n > 0), F.sha2(cut, 256))).withColumn("wrong_size", F.lit(False)).drop("content")
    there = F.col("length").isNotNull()
    stored = _found(alone.unionByName(parts), "public_id", {"photo_missing": ~there & F.coalesce(safe_relative(F.col("photo_path")), F.lit(False)), "photo_bytes": there & F.col("wrong_size"), "photo_digest": there & ~F.col("sha").eqNullSafe(F.col("photo_sha256"))}, F.col("photo_path"))
    return own.unionByName(stored)


def violations(meta: DataFrame, rows: DataFrame, photos: DataFrame, series: DataFrame, indexed: DataFrame, files: DataFrame, checks: DataFrame | None = None) -> DataFrame:
    """All damages; ``checks`` (check, detail) are those of the snapshot's own file."""
    found = [of_meta(meta, rows, series, indexed), of_rows(rows), of_documents(rows, files), of_photos(photos, rows, files)]
    if checks is not None:
        found.append(checks.select(F.col("check").alias("kind"), F.lit("snapshot").alias("subject"), F.coalesce("detail", F.lit("")).alias("detail")))
    return reduce(DataFrame.unionByName, found)
