"""Queries over texts, pages and the event stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, text, values
from ..operators import compare, reconcile
from ..session import shared_dir
from ..sources import parsers
from ..streaming import events as stream
from .roles import SQL_CATALOG, catalog, table


def text_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit(" _-"), F.col("p_brand"), F.lit("\t("), F.col("p_type"), F.lit(") /*?"))
    return p.select(
        "p_partkey", text.norm_key(raw).alias("key"), text.norm_space(raw).alias("spaced"), text.safe_part(raw).alias("part"), text.strip_brackets(raw).alias("bare"),
        F.array_join(text.tokens(F.col("p_name")), "|").alias("tokens"), text.model_token(F.concat("p_name", F.lit(" A"), F.col("p_size"))).alias("token"), text.html_escape(F.concat(F.lit("<a&'\">"), F.col("p_name"))).alias("escaped"),
    )


def number_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("约 "), F.col("p_partkey") * 1000, F.lit("*"), F.col("p_size"), F.lit("*"), F.col("p_partkey") % 7, F.lit("mm"))
    m = text.three_measures(raw)
    return p.select("p_partkey", text.first_number(raw).alias("first"), F.array_join(m, "x").alias("measures"), text.leading_percent(F.concat(F.col("p_size"), F.lit(".5%的用户"))).alias("percent"), values.text_int(F.concat(F.lit(" "), F.col("p_size"), F.lit("abc"))).alias("number"), values.plain_number(F.col("p_size") / 4).alias("plain"), values.page_count(F.col("p_partkey"), 50).alias("pages"))


def date_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd HH:mm")).when(k == 1, F.date_format(d, "yyyyMMdd")).when(k == 2, F.date_format(d, "yyyy/MM/dd")).when(k == 3, F.concat(F.year(d), F.lit("年"), F.month(d), F.lit("月"), F.dayofmonth(d), F.lit("日发布"))).otherwise("不详")
    return o.select("o_orderkey", values.parse_date(raw).alias("day"))


def cn_numerals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numerals of 1 to 999 written in characters, read back."""
    k = (F.col("p_partkey") % 999 + 1).cast("int")
    d = F.array(*map(F.lit, "零一二三四五六七八九"))
    at = lambda n: F.element_at(d, n.cast("int") + 1)
    h, t, o = F.floor(k / 100), F.floor(k / 10) % 10, k % 10
    tens = F.when((t == 1) & (h == 0), F.lit("十")).when(t > 0, F.concat(at(t), F.lit("十"))).when((h > 0) & (o > 0), F.lit("零")).otherwise("")
    written = F.concat(F.when(h > 0, F.concat(at(h), F.lit("百"))).otherwise(""), tens, F.when(o > 0, at(o)).otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", values.chinese_int(written).alias("value"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.array_distinct(F.regexp_extract_all("html", F.lit(r'<a href="([^"]*)"'), 1))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("place", "link")).select("page_id", F.col("place").cast("bigint").alias("place"), "link")


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(title).alias("title"), F.length(text.strip_tags(F.col("html"))).cast("bigint").alias("chars"))


def access_block(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    blocked = rules.blocked_page(F.when(F.col("page_id") % 3 == 0, 403).otherwise(200), F.col("url"), F.col("html"), ("### onaiaux",), ("tionble", "the", "que"))
    return p.select("page_id", blocked.alias("blocked"))


def review_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("role = 'assistant'")
    s = F.concat(F.lit("85%的用户 "), F.col("conv_id"), F.when(F.col("turn") % 4 == 1, "但部分用户 no").when(F.col("turn") % 4 == 3, "但也有用户 x但有用户反馈 y").otherwise(""))
    parts = text.split_review(s, compare.TURNS)
    return c.select("conv_id", "turn", parts["praise"].alias("praise"), parts["blame"].alias("blame"), text.leading_percent(s).alias("percent"))


def tag_literals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag lists written as Python literals, read as JSON."""
    p = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("[{'Combination': '"), F.col("p_name"), F.lit("', 'Volume': "), F.col("p_size"), F.lit(", 'Extra': None, 'Seen': True}, {'Combination': 'b', 'Volume': 2, 'Extra': None, 'Seen': False}]"))
    tags = F.from_json(values.literal_json(raw), "array<struct<Combination:string,Volume:int,Seen:boolean>>")
    return p.select("p_partkey", F.explode(tags).alias("t")).select("p_partkey", F.col("t.Combination").alias("name"), F.col("t.Volume").alias("volume"), F.col("t.Seen").alias("seen"))


def zipped_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    ids = F.concat_ws(",", F.col("p_partkey"), F.col("p_partkey") + 1, F.col("p_partkey") + 2)
    z = values.zip_ids(ids, F.concat_ws(",", F.col("p_name"), F.col("p_type")))
    return p.select("p_partkey", F.posexplode(z).alias("place", "z")).select("p_partkey", F.col("place").cast("bigint").alias("place"), "z.id", "z.name")


def catalog_html_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue pages made of parts, read by the table function."""
    c = catalog(spark, sf_dir)
    cell = lambda *cs: F.concat(*(x for v in cs for x in (v, F.lit("<span></span>"))))
    row = F.struct("id", cell(F.col("trademark"), F.concat(F.upper(F.substring("category", 1, 2)), F.lpad(F.col("id").cast("string"), 5, "0")), F.col("common_name"), F.lit("300")).alias("cells"))
    pages = c.groupBy("trademark").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    numbered = F.transform("rows", lambda r, i: F.concat((i + 1).cast("string"), F.lit("<span></span>某公司<span></span>"), r["cells"]))
    head = "<p>新能源汽车目录（第十二批）</p><p>一、纯电动</p><p>乘用车</p><p>序号<span></span>企业名称<span></span>商标<span></span>车辆型号<span></span>通用名称<span></span>续驶里程<span></span>"
    html = F.concat(F.lit(head), F.array_join(numbered, ""), F.lit("</p>"))
    pages.select("trademark", html.alias("html")).createOrReplaceTempView("__catalog_pages")
    spark.udtf.register("parse_catalog_html", parsers.CatalogHtml)
    return spark.sql("SELECT p.trademark AS page, r.batch, r.energy, r.category, r.row_no, r.model_code, r.common_name, r.range_km FROM __catalog_pages p, LATERAL parse_catalog_html(p.html) r")


def words_to_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter pages as positioned words, read into fields."""
    c = catalog(spark, sf_dir)

    def word(t, x: float, top: float):
        return F.struct(t.alias("text"), F.lit(x).alias("x0"), F.lit(x + 60).alias("x1"), F.lit(top).alias("top"))

    lit = F.lit
    page = F.array(
        word(F.concat(lit("第"), F.col("batch"), lit("批")), 10.0, 5.0), word(F.concat(lit("产品型号:"), F.col("model_code")), 10.0, 30.0), word(F.concat(lit("总质量(kg):"), F.col("id")), 200.0, 31.5),
        word(lit("发动机型号"), 10.0, 60.0), word(lit("功率"), 200.0, 60.0), word(F.concat(lit("E"), F.col("id")), 10.0, 80.0), word(F.col("seq"), 200.0, 80.0), word(lit("其他:"), 10.0, 120.0), word(F.col("common_name"), 60.0, 120.0),
    )
    f = parsers.words_to_fields(c.select("id", page.alias("words")), "id", "words")
    get = lambda k: F.col("fields")[k].alias(k)
    return f.select("id", get("batch"), get("model"), get("mass"), get("engine_model"), get("power"), get("other"))


def notice_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    td = lambda v: F.concat(F.lit("<td>"), v, F.lit("</td>"))
    short = F.when(F.col("id") % 10 == 0, "").otherwise(F.concat(F.lit("<td><a href='/d/"), F.col("id"), F.lit("'>看</a></td>")))
    html = F.concat(F.lit("<table><tr><th>批次</th><th>车辆型号</th><th>变更内容</th></tr><tr>"), td(F.col("batch")), td(F.col("model_code")), short, F.lit("</tr><tr><td>合计1条</td></tr></table>"))
    c.select("id", html.alias("html")).createOrReplaceTempView("__notices")
    spark.udtf.register("parse_notice_table", parsers.NoticeTable)
    return spark.sql("SELECT n.id, r.batch, r.model, r.detail_url, r.error FROM __notices n, LATERAL parse_notice_table(n.html) r")


def stream_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts made by a stream over the landed events; equal to the batch answer."""
    place = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    query = stream.run_to(stream.windowed_counts(stream.read_events(spark, f"{sf_dir}/event[s].parquet")), f"{place}/out", f"{place}/checkpoint")
    query.awaitTermination()
    out = spark.read.parquet(f"{place}/out")
    return out.select(F.to_date("start").alias("day"), "event_type", "n", F.round("total", 4).alias("total"))


def event_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    i = stream.event_identity(F.concat(F.lit("m"), F.col("user_id")), F.col("event_id") % 5, F.col("event_type"), F.lit(""))
    return e.groupBy(i.alias("identity")).agg(F.count("*").alias("n"))


def revision_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    old = F.create_map(F.lit("model"), F.col("model_code"), F.lit("mass"), F.col("seq"), F.lit("note"), F.col("fuel"))
    new = F.create_map(F.lit("model"), F.when(F.col("id") % 7 == 0, "X").otherwise(F.col("model_code")), F.lit("mass"), F.when(F.col("id") % 3 == 0, "1").otherwise(F.col("seq")), F.lit("note"), F.when(F.col("id") % 2 == 0, "n").otherwise(F.col("fuel")))
    return c.select("id", reconcile.revision_class(old, new, ["model"], ["mass"]).alias("kind"))


def republish_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = catalog(spark, sf_dir)
    found = c.where("id % 4 <> 0").select(F.col("id").alias("product"), F.when(F.col("id") % 3 == 0, "170").otherwise(F.col("batch")).alias("found_batch"), F.when(F.col("id") % 9 == 1, "timeout").alias("error"))
    return reconcile.republish_check(c.select(F.col("id").alias("product"), "batch"), found)


C = "WITH " + SQL_CATALOG
ORACLES = {
    "text_normalize": r"""WITH p AS (SELECT *, '  ' || p_name || ' _-' || p_brand || chr(9) || '(' || p_type || ') /*?' AS raw FROM part) SELECT p_partkey, lower(regexp_replace(raw, '[\s_-]+', '', 'g')) AS key, trim(regexp_replace(raw, '\s+', ' ', 'g')) AS spaced,
  regexp_replace(regexp_replace(raw, '[\\/:*?"<>|\s]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS part, regexp_replace(raw, '[(][^()]*[)]', '', 'g') AS bare, replace(p_name, ' ', '|') AS tokens, lower(regexp_extract(replace(p_name || ' A' || p_size, ' ', ''), '[A-Za-z0-9]+$')) AS token, '&lt;a&amp;&#x27;&quot;&gt;' || p_name AS escaped FROM p""",
    "number_extract": "SELECT p_partkey, CAST(p_partkey * 1000 AS VARCHAR) AS first, (p_partkey * 1000) || 'x' || p_size || 'x' || (p_partkey % 7) AS measures, p_size || '.5' AS percent, CAST(p_size AS BIGINT) AS number, regexp_replace(regexp_replace(printf('%.6f', p_size / 4.0), '0+$', ''), '\\.$', '') AS plain, CAST(ceil(p_partkey / 50.0) AS BIGINT) AS pages FROM part",
    "date_parse": "SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 4 THEN CAST(o_orderdate AS DATE) END AS day FROM orders",
    "cn_numerals": "SELECT p_partkey, CAST(p_partkey % 999 + 1 AS INTEGER) AS value FROM part",
    "page_links": """WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS a FROM pages), u AS (SELECT page_id, list_filter(a, lambda x, i: list_position(a, x) = i) AS a FROM l) SELECT page_id, unnest(range(len(a))) AS place, unnest(a) AS link FROM u""",
    "page_text": r"SELECT page_id, trim(replace(replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&amp;', '&')) AS title, length(trim(replace(replace(regexp_replace(html, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&amp;', '&'))) AS chars FROM pages",
    "access_block": "WITH f AS (SELECT page_id, url, contains(html, '### onaiaux') AS s, CAST(contains(html, 'tionble') AS INT) + CAST(contains(html, 'the') AS INT) + CAST(contains(html, 'que') AS INT) AS w FROM pages) SELECT page_id, s OR w + CAST(s AS INT) >= 2 OR (w + CAST(s AS INT) >= 1 AND (page_id % 3 = 0 OR regexp_matches(url, '(?i)login|passport|verify'))) AS blocked FROM f",
    "review_split": "SELECT conv_id, turn, '85%的用户 ' || conv_id || CASE WHEN turn % 4 = 3 THEN '但也有用户 x' ELSE '' END AS praise, CASE turn % 4 WHEN 1 THEN '但部分用户 no' WHEN 3 THEN '但有用户反馈 y' ELSE '' END AS blame, '85' AS percent FROM conversations WHERE role = 'assistant'",
    "tag_literals": "SELECT p_partkey, p_name AS name, p_size AS volume, true AS seen FROM part UNION ALL SELECT p_partkey, 'b', 2, false FROM part",
    "zipped_ids": "SELECT p_partkey, 0::BIGINT AS place, CAST(p_partkey AS VARCHAR) AS id, p_name AS name FROM part UNION ALL SELECT p_partkey, 1, CAST(p_partkey + 1 AS VARCHAR), p_type FROM part UNION ALL SELECT p_partkey, 2, CAST(p_partkey + 2 AS VARCHAR), '' FROM part",
    "catalog_html_rows": f"{C} SELECT trademark AS page, CAST(12 AS INTEGER) AS batch, '纯电动' AS energy, '乘用车' AS category, CAST(row_number() OVER (PARTITION BY trademark ORDER BY id) AS INTEGER) AS row_no, upper(substr(category, 1, 2)) || lpad(CAST(id AS VARCHAR), 5, '0') AS model_code, common_name, '300' AS range_km FROM catalog",
    "words_to_fields": f"{C} SELECT id, batch, model_code AS model, CAST(id AS VARCHAR) AS mass, 'E' || id AS engine_model, seq AS power, common_name AS other FROM catalog",
    "notice_rows": f"{C} SELECT id, batch, model_code AS model, CASE WHEN id % 10 = 0 THEN '' ELSE '/d/' || id END AS detail_url, CASE WHEN id % 10 = 0 THEN 'short row' END AS error FROM catalog",
    "stream_event_counts": "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "event_identities": """SELECT substr(sha256('["M' || user_id || '","' || (event_id % 5) || '","' || event_type || '",""]'), 1, 24) AS identity, count(*) AS n FROM events GROUP BY 1""",
    "revision_classes": f"{C} SELECT id, CASE WHEN id % 7 = 0 THEN 'identity_changed' WHEN id % 3 = 0 AND seq <> '1' THEN 'parameters_changed' WHEN id % 2 = 0 AND fuel <> 'n' THEN 'minor_changes' ELSE 'same_content' END AS kind FROM catalog",
    "republish_check": f"{C} SELECT id AS product, batch, CASE WHEN id % 4 = 0 THEN NULL WHEN id % 3 = 0 THEN '170' ELSE batch END AS found_batch, CASE WHEN id % 4 = 0 THEN 'missing' WHEN id % 9 = 1 THEN 'failed' WHEN id % 3 = 0 THEN 'stale_record' ELSE 'confirmed' END AS state FROM catalog",
}
QUERIES = {name: globals()[name] for name in ORACLES}
