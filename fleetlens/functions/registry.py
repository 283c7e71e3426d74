"""Functions under SQL names."""

from __future__ import annotations

from pyspark.sql import SparkSession


#: SQL name -> (parameters, body); bodies are SQL so that the optimiser sees through them.
SQL_FUNCTIONS = {
    "norm_key": ("s STRING", "STRING", r"lower(regexp_replace(coalesce(s, ''), '(?U)[\\s_-]+', ''))"),
    "text_int": ("s STRING", "BIGINT", r"CASE WHEN s IS NOT NULL THEN coalesce(try_cast(nullif(regexp_extract(s, '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT), 0L) END"),
    "safe_part": ("s STRING", "STRING", r"coalesce(nullif(regexp_replace(regexp_replace(coalesce(s, ''), '[\\\\/:*?\"<>|\\s]+', '_'), '^[._]+|[._]+$', ''), ''), 'unknown')"),
    "model_prefix": ("s STRING", "STRING", "regexp_replace(s, '[0-9]+$', '')"),
}


def register(spark: SparkSession) -> None:
    for name, (parameters, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
    from ..sources import parsers

    spark.udtf.register("parse_catalog_html", parsers.CatalogHtml)
    spark.udtf.register("parse_catalog_docx", parsers.CatalogDocx)
    spark.udtf.register("parse_notice_table", parsers.NoticeTable)
