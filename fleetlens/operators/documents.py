"""Stored documents against the files they name: what a resumed run may skip, and answers that are the source's own fault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import safe_relative

# Messages of stored answers, and marks of a page that the source failed to make.
NOT_PDF, ORIGINAL = "接口返回非 PDF", "；原文件："
FAILED_PAGE, REASONS = "获取参数页发生错误", ("Byte data not found at location", "没有找到参数页")
NO_FIELDS, BAD_FIELDS, NOT_PARSED = "已有有效 PDF 缺少解析字段", "已有有效 PDF 的解析字段 JSON 异常", "已有 PDF 解析问题，未重复下载："


def original_path(message: Column) -> Column:
    """The file that a message about an answer other than PDF names; null if it names none below the root."""
    m = F.coalesce(message, F.lit(""))
    path = F.nullif(F.regexp_extract(m, f"(?s){ORIGINAL}(.*)$", 1), F.lit(""))
    return F.when(m.startswith(NOT_PDF) & safe_relative(path), path)


def source_failures(answers: DataFrame, files: DataFrame) -> DataFrame:
    """answers (message) with source_failure: whether the file named there is a page that the source failed to make.

    files (path, content). Files are looked at where they are read; only their paths are joined.
    """
    has = lambda t: F.contains(F.col("content"), F.lit(t).cast("binary"))
    marked = files.where(has(FAILED_PAGE) & (has(REASONS[0]) | has(REASONS[1]))).select(F.col("path").alias("__path")).distinct().withColumn("__failed", F.lit(True))
    named = answers.withColumn("__named", original_path(F.col("message")))
    return named.join(marked, F.col("__named") == F.col("__path"), "left").withColumn("source_failure", F.coalesce("__failed", F.lit(False))).drop("__named", "__path", "__failed")


def verified(documents: DataFrame, files: DataFrame) -> DataFrame:
    """Documents whose file is there and whole, with outcome and message; a resumed run fetches all others.

    documents (product, path, is_pdf, bytes, sha256, error, fields_json, parse_error),
    files (path, length, content). Outcomes: ``skipped_existing``, or ``parse_failed``
    where the fields are absent, no JSON object or known to be bad. A path that leaves the
    root is an error, as in the registry: such a row must not be taken for a missing file.
    """
    checked = F.when(safe_relative(F.col("path")), F.col("path")).otherwise(F.raise_error(F.concat(F.lit("a document's path leaves the root: "), F.coalesce(F.col("path"), F.lit("")))))
    claimed = documents.where("is_pdf = 1 AND bytes > 0 AND coalesce(sha256, '') <> ''").withColumn("path", checked)
    whole = files.where(F.substring("content", 1, 4) == F.lit(b"%PDF")).select("path", F.col("length").alias("__length"), F.sha2("content", 256).alias("__sha"))
    there = claimed.join(whole, "path").where("bytes = __length AND sha256 = __sha").drop("__length", "__sha")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    kind = F.expr("schema_of_variant(try_parse_json(fields_json))")
    fields = F.expr("try_variant_get(try_parse_json(fields_json), '$', 'map<string, variant>')")
    unread = F.when(blank("fields_json") == "", NO_FIELDS).when(kind.isNull(), BAD_FIELDS).when(F.coalesce(F.size(fields), F.lit(0)) <= 0, NO_FIELDS).otherwise("")
    why = F.coalesce(F.nullif(blank("parse_error"), F.lit("")), F.nullif(blank("error"), F.lit("")), unread)
    out = there.withColumn("__why", why)
    return out.withColumn("outcome", F.when(F.col("__why") == "", "skipped_existing").otherwise("parse_failed")).withColumn("message", F.when(F.col("__why") == "", "").otherwise(F.concat(F.lit(NOT_PARSED), "__why"))).drop("__why")


def unresolved(wanted: DataFrame, documents: DataFrame, files: DataFrame) -> DataFrame:
    """wanted (product) without those that have a verified document."""
    return wanted.join(verified(documents, files).select("product").distinct(), "product", "left_anti")
