"""Queries over vehicle pages of no known form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import generic_pages
from .roles import SQL_CATALOG, catalog, table


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue rows as pages of five forms: a table, a list, running text, nested tables with other cells, and no labels."""
    c, k = catalog(spark, sf_dir), F.col("id")
    t = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    seq, name, kind = F.col("seq"), F.col("common_name"), F.when(F.col("fuel") == "", "无").otherwise(F.col("fuel"))
    head = t("<html><head><title>〖", name, " 2024款〗参数配置表_x_", F.col("trademark"), "_汽车之家</title></head><body>")
    form = (
        F.when(k % 5 == 0, t("<table><tr><th>能源类型</th><td>", kind, "</td></tr><tr><td>轴距(mm)</td><td>1,", seq, " mm</td></tr><tr><td>厂商指导价</td><td>暂无</td></tr></table>"))
        .when(k % 5 == 1, t("<ul><li>能源类型：", kind, "</li><li>长*宽*高: 4", seq, "x1900x1500</li><li>轴距:", seq, "</li></ul>"))
        .when(k % 5 == 2, t("<div>", F.repeat(F.lit("很长的介绍"), 30), " CLTC续航里程：", seq, "km 月销量 ", k, "辆 轴距 2", seq, "mm</div>"))
        .when(k % 5 == 3, t("<table><tr><td>a</td><td>b</td><td>c</td></tr><tr><td><table><tr><td>车门数</td><td>", seq, "门</td></tr></table></td></tr></table><p>发动机：2.0T L4</p><p>发动机：again</p>"))
        .otherwise(F.lit("<p>nothing</p>"))
    )
    return c.select("id", t("http://x/", k).alias("url"), t(head, form, "</body></html>").alias("html"))


def generic_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = generic_pages.read_pages(_pages(spark, sf_dir), "id")
    return generic_pages.page_summaries(read, "id").select(
        "id", "brand", "series_name", "model_name", "energy_type", "official_price", "sales_volume", "engine", "displacement", "intake_type", "cltc_range_km", "length_mm", "width_mm", "wheelbase_mm", "doors"
    )


def page_label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and values of all raw pages, one row each; titles and links of the pages counted."""
    read = generic_pages.read_pages(table(spark, sf_dir, "pages"), "page_id", site="/")
    return read.select("page_id", "title", F.size("links").alias("links"), F.explode_outer("pairs").alias("label", "value"))


ORACLES = {
    "generic_summaries": f"""WITH {SQL_CATALOG}, f AS (SELECT *, id % 5 AS form FROM catalog)
 SELECT id, trademark AS brand, CASE WHEN length(common_name || ' ') <= 30 AND NOT regexp_matches(common_name, '[0-9]') THEN trim(common_name) ELSE '' END AS series_name, '2024款〗' AS model_name,
  CASE WHEN form IN (0, 1) THEN fuel ELSE '' END AS energy_type, '' AS official_price, CASE WHEN form = 2 THEN id || '辆' ELSE '' END AS sales_volume, CASE WHEN form = 3 THEN '2.0T L4' ELSE '' END AS engine,
  '' AS displacement, CASE WHEN form = 3 THEN '涡轮增压' ELSE '' END AS intake_type, CASE WHEN form = 2 THEN seq ELSE '' END AS cltc_range_km, CASE WHEN form = 1 THEN '4' || seq ELSE '' END AS length_mm, CASE WHEN form = 1 THEN '1900' ELSE '' END AS width_mm,
  CASE form WHEN 0 THEN '1' || seq WHEN 1 THEN seq WHEN 2 THEN '2' || seq ELSE '' END AS wheelbase_mm, CASE WHEN form = 3 THEN seq ELSE '' END AS doors FROM f""",
}
QUERIES = {name: globals()[name] for name in (*ORACLES, "page_label_values")}
