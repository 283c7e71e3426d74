"""Queries over site snapshots and over enumerations that heal themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents, enumeration, snapshots
from .roles import table


def snapshot_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a snapshot whose every kind of damage stands for some keys."""
    i = F.col("p_partkey")
    nth = lambda m, k: i % m == k
    body = F.when(nth(50, 4), F.concat(F.lit("HTML-"), F.col("p_name"))).otherwise(F.concat(F.lit("%PDF-"), F.col("p_name")))
    p = table(spark, sf_dir, "part").select(
        i.alias("id"), F.concat(F.lit("P"), F.when(nth(50, 9), i - 1).otherwise(i)).alias("source_product_id"), F.when(nth(50, 6), "XYZ").otherwise(F.substring(F.md5(i.cast("string")), 1, 12)).alias("public_id"),
        F.when(nth(50, 7), "gone").when(nth(10, 0), "pending_source").otherwise("published").alias("availability"), F.when(nth(50, 5), "[1]").when(nth(50, 15), "{").otherwise('{"a": 1}').alias("fields_json"),
        F.when(nth(50, 8), 0).otherwise(1).alias("is_pdf"), F.concat(F.when(nth(50, 2), "../").otherwise("docs/"), i, F.lit(".pdf")).alias("doc_path"), F.octet_length(body).alias("doc_bytes"),
        F.sha2(body, 256).alias("doc_sha256"), F.when(nth(50, 1), "%PDF-changed").otherwise(body).cast("binary").alias("content"), "p_name",
    )
    files = p.where("id % 50 <> 3").select(F.concat(F.lit("docs/"), "id", F.lit(".pdf")).alias("path"), F.octet_length("content").cast("bigint").alias("length"), "content")
    photos = p.where("id % 4 = 0").select(
        F.concat(F.lit("F"), "id").alias("public_id"), F.when(F.col("id") % 40 == 12, "nobody").otherwise(F.col("public_id")).alias("announcement_public_id"), F.col("doc_path").alias("photo_path"),
        F.when(F.col("id") % 40 == 4, -1).otherwise(5).alias("pdf_offset"), F.octet_length("p_name").alias("photo_bytes"), F.sha2(F.when(F.col("id") % 40 == 16, "x").otherwise(F.col("p_name")), 256).alias("photo_sha256"),
        F.when(F.col("id") % 40 == 8, 0).otherwise(640).alias("width"), F.lit(480).alias("height"),
    )
    held = p.agg(F.count("*").cast("string").alias("value"), F.lit("source_rows").alias("key"))
    said = spark.createDataFrame([("3", "schema_version"), (snapshots.SCOPE, "collection_scope"), ("999999999", "published_rows"), ("5", "series_count")], "value string, key string")
    series = table(spark, sf_dir, "region").select("r_name")
    return snapshots.violations(said.unionByName(held), p.drop("content", "p_name"), photos, series, p.where("id % 10 < 9").select("id"), files)


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as a listing: companies and prefixes overlap, but for every fifth part, which stands alone."""
    i = F.col("p_partkey")
    alone = i % 5 == 0
    named = F.concat(F.when(F.col("p_brand") == "Brand#11", F.lit("Motor ")).otherwise(F.lit("House ")), F.substring_index("p_brand", "#", -1), F.lit("-"), F.col("p_size") % 17)
    company = F.when(alone, F.concat(F.lit("Lone "), i)).otherwise(named)
    return table(spark, sf_dir, "part").select(i.alias("product"), company.alias("company"), F.concat(F.when(alone, F.lit("L")).otherwise(F.lit("P")), F.when(alone, i).otherwise(F.floor(i / 3))).alias("prefix"))


def healed_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enumeration.enumerated(_listing(spark, sf_dir), ["Motor"], most=30)
    return found.select("product", "company", "round", "missed")


def sampled_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefixes of every tenth group against an enumeration by keyword alone."""
    listing = _listing(spark, sf_dir)
    sample = listing.where("prefix LIKE '%7'").select("prefix")
    return enumeration.sampled_coverage(listing, listing.where(enumeration.covered(F.col("company"), ["Motor", "House 1"])), sample)


def verified_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as stored files; every seventh is no PDF, every eleventh has other bytes than its row says, every thirteenth is missing."""
    d, i = table(spark, sf_dir, "documents"), F.col("doc_id")
    body = F.concat(F.when(i % 7 == 0, "HTML-").otherwise("%PDF-"), F.coalesce("text", F.lit("")))
    path = F.concat(F.lit("d/"), i, F.lit(".pdf"))
    files = d.where("doc_id % 13 <> 0").select(path.alias("path"), F.octet_length(body).cast("bigint").alias("length"), body.cast("binary").alias("content"))
    rows = d.select(
        i.alias("product"), path.alias("path"), F.lit(1).alias("is_pdf"), F.octet_length(body).alias("bytes"), F.sha2(F.when(i % 11 == 0, "x").otherwise(body), 256).alias("sha256"), F.lit("").alias("error"),
        F.when(i % 3 == 0, "").when(i % 3 == 1, '{"a": 1}').otherwise("{").alias("fields_json"), F.when(i % 5 == 0, "p").alias("parse_error"),
    )
    return documents.verified(rows, files).select("product", "outcome", "message")


SQL_LISTING = """listing AS (SELECT p_partkey AS product, CASE WHEN p_partkey % 5 = 0 THEN 'Lone ' || p_partkey ELSE CASE WHEN p_brand = 'Brand#11' THEN 'Motor ' ELSE 'House ' END || split_part(p_brand, '#', 2) || '-' || (p_size % 17) END AS company,
 CASE WHEN p_partkey % 5 = 0 THEN 'L' || p_partkey ELSE 'P' || (p_partkey // 3) END AS prefix FROM part)"""

ORACLES = {
    "verified_documents": f"""WITH d AS (SELECT doc_id AS product, CASE WHEN doc_id % 5 = 0 THEN 'p' WHEN doc_id % 3 = 0 THEN '{documents.NO_FIELDS}' WHEN doc_id % 3 = 2 THEN '{documents.BAD_FIELDS}' ELSE '' END AS why FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 11 <> 0 AND doc_id % 13 <> 0)
 SELECT product, CASE WHEN why = '' THEN 'skipped_existing' ELSE 'parse_failed' END AS outcome, CASE WHEN why = '' THEN '' ELSE '{documents.NOT_PARSED}' || why END AS message FROM d""",
    "snapshot_violations": """WITH p AS (SELECT p_partkey AS id, 'P' || CASE WHEN p_partkey % 50 = 9 THEN p_partkey - 1 ELSE p_partkey END AS pid, CASE WHEN p_partkey % 50 = 6 THEN 'XYZ' ELSE substr(md5(CAST(p_partkey AS VARCHAR)), 1, 12) END AS public,
  CASE WHEN p_partkey % 50 = 7 THEN 'gone' WHEN p_partkey % 10 = 0 THEN 'pending_source' ELSE 'published' END AS availability, CASE WHEN p_partkey % 50 = 2 THEN '../' ELSE 'docs/' END || p_partkey || '.pdf' AS path,
  CASE WHEN p_partkey % 50 = 4 THEN 'HTML-' ELSE '%PDF-' END || p_name AS want, p_name FROM part), d AS (SELECT *, CASE WHEN id % 50 = 1 THEN '%PDF-changed' ELSE want END AS got FROM p),
 photo AS (SELECT *, 'F' || id AS f, CASE WHEN id % 40 = 4 THEN -1 ELSE 5 END AS off FROM d WHERE id % 4 = 0)
 SELECT 'published_rows' AS kind, 'meta' AS subject, '' AS detail UNION ALL SELECT 'search_rows', 'meta', '' WHERE EXISTS (SELECT 1 FROM p WHERE id % 10 = 9)
 UNION ALL SELECT 'public_id_form', pid, public FROM p WHERE id % 50 = 6 UNION ALL SELECT 'availability', pid, public FROM p WHERE id % 50 = 7 UNION ALL SELECT 'fields_no_object', pid, public FROM p WHERE id % 50 IN (5, 15)
 UNION ALL SELECT 'repeated_product', pid, CAST(count(*) AS VARCHAR) FROM p GROUP BY pid HAVING count(*) > 1 UNION ALL SELECT 'repeated_public_id', public, CAST(count(*) AS VARCHAR) FROM p GROUP BY public HAVING count(*) > 1
 UNION ALL SELECT 'document_path', pid, path FROM p WHERE availability = 'published' AND id % 50 = 2 UNION ALL SELECT 'document_missing', pid, path FROM p WHERE availability = 'published' AND id % 50 = 3
 UNION ALL SELECT 'document_flag', pid, path FROM p WHERE availability = 'published' AND id % 50 = 8 UNION ALL SELECT 'document_kind', pid, path FROM p WHERE availability = 'published' AND id % 50 = 4
 UNION ALL SELECT 'document_bytes', pid, path FROM d WHERE availability = 'published' AND id % 50 NOT IN (2, 3) AND strlen(got) <> strlen(want) UNION ALL SELECT 'document_digest', pid, path FROM d WHERE availability = 'published' AND id % 50 NOT IN (2, 3) AND got <> want
 UNION ALL SELECT 'photo_owner', f, path FROM photo WHERE id % 40 = 12 UNION ALL SELECT 'photo_document', f, path FROM photo WHERE public = 'XYZ' AND id % 40 <> 12 AND path <> (SELECT min(path) FROM p WHERE public = 'XYZ')
 UNION ALL SELECT 'photo_offset', f, path FROM photo WHERE off < 0 UNION ALL SELECT 'photo_size', f, path FROM photo WHERE id % 40 = 8 UNION ALL SELECT 'photo_path', f, path FROM photo WHERE id % 50 = 2
 UNION ALL SELECT 'photo_missing', f, path FROM photo WHERE id % 50 = 3
 UNION ALL SELECT 'photo_digest', f, path FROM photo WHERE id % 50 NOT IN (2, 3) AND (off < 0 OR id % 40 = 16 OR substr(got, 6, strlen(p_name)) <> p_name)""",
    "healed_enumeration": f"""WITH RECURSIVE {SQL_LISTING}, reach(company, round) AS (SELECT DISTINCT company, 0 FROM listing WHERE contains(company, 'Motor')
  UNION SELECT b.company, r.round + 1 FROM reach r JOIN (SELECT DISTINCT company, prefix FROM listing) a ON a.company = r.company JOIN (SELECT DISTINCT company, prefix FROM listing) b ON a.prefix = b.prefix AND b.company <> a.company WHERE r.round < 30),
 least AS (SELECT company, CAST(min(round) AS INT) AS round FROM reach GROUP BY company) SELECT product, company, round, NOT contains(company, 'Motor') AS missed FROM listing LEFT JOIN least USING (company)""",
    "sampled_coverage": f"WITH {SQL_LISTING} SELECT prefix, count(*) AS listed, count(*) FILTER (WHERE NOT (contains(company, 'Motor') OR contains(company, 'House 1'))) AS uncovered FROM listing WHERE prefix LIKE '%7' GROUP BY prefix",
}
QUERIES = {name: globals()[name] for name in ORACLES}
