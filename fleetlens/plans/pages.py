"""Queries over captured comparison pages and parameter pages, written around the generated catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import captures, parameter_pages
from .roles import SQL_CATALOG, catalog, dealt_catalog

SHOWN = ("common_name", "trademark", "category", "range_km", "seq", "batch")


def _filled(template: str, **values: Column) -> Column:
    """Template whose marks <name> are replaced by columns."""
    out = F.lit(template)
    for name, value in values.items():
        if f"<{name}>" in template:
            out = F.replace(out, F.lit(f"<{name}>"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def _columns() -> dict[str, Column]:
    return {c: F.col(c) for c in ("id", *SHOWN)}


SUBJECTS = '{"simple_result":{"entity_result":[{"belong_to_brand":" <trademark> "}],"simple_intent":{"subjects":[{"id":"<id>, 7,","subject_s_name":"<common_name>","class_name":"CarSeries"},{"id":"7","subject_s_name":"again"},{"id":"8","subject_s_name":"<common_name>","class_name":"Brand"},{"id":"9"}]}}}'
INTENTS = '{"simple_result":{"queryintent":[{"id":"-1","entityName":"none"},{"id":<id>,"entityName":"<category>","ruleType":4},{"id":"8","entityName":"b","ruleType":3}]}}'
TERMS = '{"qp_result":{"term":[{"id":"5","entityName":" "},{"id":"<id>","entityName":"<common_name>"},{"id":"<id>","entityName":"again"}]}}'


def search_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of search responses; their three levels and broken ones take turns."""
    k = F.col("id") % 4
    c = dealt_catalog(spark, sf_dir).withColumn("payload", F.when(k == 0, _filled(SUBJECTS, **_columns())).when(k == 1, _filled(INTENTS, **_columns())).when(k == 2, _filled(TERMS, **_columns())).otherwise('{"simple'))
    found = captures.search_candidates(c.select("id", "common_name", "payload"), "common_name")
    return found.select("id", F.col("rank").cast("bigint").alias("rank"), "series_id", "title", F.col("score").cast("bigint").alias("score"), "brand")


API = """{"result":{"bread":{"seriesname":"<trademark>"},"titlelist":[{"itemtype":"基本参数","items":[{"titleid":1,"itemname":"车型名称"},{"titleid":9,"itemname":"级别"},{"titleid":10,"itemname":"图片"},{"titleid":13,"itemname":"续航"}]},
{"itemtype":"广告","items":[{"titleid":11,"itemname":"x"}]},{"itemtype":"颜色","items":[{"titleid":12,"itemname":"外观颜色"}]}],"datalist":[
{"specid":<id>,"specname":"<common_name>","minprice":"<seq>万起询底价","paramconflist":[{"titleid":9,"itemname":"<category>"},{"titleid":13,"itemname":"","sublist":[{"name":"CLTC","value":"<range_km>","priceinfo":null},{"name":"WLTC","value":"●","priceinfo":"<seq>元"}]},
{"titleid":12,"colorinfo":{"list":[{"name":"红","price":<seq>},{"name":"白","price":0}]}}]},{"specid":"","specname":"x"},{"specid":"s<id>","specname":"二","paramconflist":[{"titleid":9,"itemname":"--"}]}]}}"""


def api_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dealt_catalog(spark, sf_dir).select("id", _filled(API, **_columns()).alias("payload"))
    return captures.api_params(c).drop("payload")


def api_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dealt_catalog(spark, sf_dir).select("id", _filled(API, **_columns()).alias("payload"))
    return captures.api_models(c).drop("payload")


PAGE = """<script>var config = {"result":{"paramtypeitems":[{"name":"<b>基本参数</b>","paramitems":[{"id":-1,"name":"车型","valueitems":[{"specid":"<id>","value":"<common_name>"},{"specid":"999999999","value":"乙"}]},
{"id":-1,"name":"?","valueitems":[]},{"id":-1,"name":"?","valueitems":[{"specid":999999999,"value":"<trademark>"}]},{"id":53,"name":"?","valueitems":[{"specid":<id>,"value":"<category>"}]}]},{"name":"热门推荐","paramitems":[{"id":5,"name":"y","valueitems":[]}]}]}};
var option = {"result":{"configtypeitems":[{"name":"","configitems":[{"name":"气囊","valueitems":[{"specid":<id>,"value":"●","sublist":[{"subname":"主","subvalue":"1"},{"subname":"副","subvalue":"<range_km>"}]}]}]}]}}
var color = {"result":{"specitems":[{"specid":999999999,"coloritems":[{"name":"红}","price":<seq>}]}]}}; var bag = {"result":{"bagtypeitems":[{"name":"包","bagitems":[{"specid":<id>,"valueitems":[]},{"specid":999999999,"valueitems":[{"name":"冬","value":"<batch>"}]},{"specid":-5,"valueitems":[]}]}]}};</script>"""


def page_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dealt_catalog(spark, sf_dir).select("id", F.when(F.col("id") % 10 == 9, "<html>").otherwise(_filled(PAGE, **_columns())).alias("html"))
    return captures.page_params(c).drop("html")


BLOCKS = '[{"auto":{"list":[{"category1Name":" 空间 ","reviewContent":"<seq>%的用户满意<common_name>。<turn>"},{"category1Name":"空间","reviewContent":"again"},{"category1Name":"动力","reviewContent":" "}]},"n":3},{"Summary":"[]"},{"more":{"list":[{"category1Name":"动力","reviewContent":"但部分用户嫌慢"}]}}]'


def structured_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.when(F.col("id") % 3 == 0, F.concat(F.lit("但有用户反馈"), F.col("trademark")))
    c = dealt_catalog(spark, sf_dir).select("id", F.when(F.col("id") % 8 == 7, "[]").otherwise(_filled(BLOCKS, turn=turn, **_columns())).alias("structuredlist"))
    return captures.structured_reviews(c)


MARKDOWN = """共 2 款车型
[<common_name>](http://x/spec/<id>/)
[<common_name>](http://x/spec/999999999/)
厂商指导价
<seq>万
9万 询底价
经销商报价
暂无
8万
基本参数
级别
<category>
--
图片
a
b
车身
[长](http://x/p)
<range_km>1
<batch>
颜色
外观颜色
[红](http://x/spec/<id>/)
白
[<trademark>](http://x/spec/999999999/)
内饰颜色
黑
灰
选装包
标配 ● 选配 ○
冬季包
标配
__<trademark>__
选配 <seq>元
关于我们
"""


def markdown_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = dealt_catalog(spark, sf_dir).select("id", F.when(F.col("id") % 9 == 8, "共 2 款车型").otherwise(_filled(MARKDOWN, **_columns())).alias("text"))
    return captures.markdown_params(c, "id").withColumn("value", F.when(F.col("kind") == "unparsed", "").otherwise(F.col("value")))


def _words(*words: tuple[Column | str, float, float]) -> Column:
    return F.array(*(F.struct((F.lit(t) if isinstance(t, str) else t).alias("text"), F.lit(float(x)).alias("x0"), F.lit(float(x + 30)).alias("x1"), F.lit(float(y)).alias("top")) for t, x, y in words))


def parameter_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of pages in both layouts; every third is a converted vehicle's, every twelfth of these lacks a heading."""
    c, k = dealt_catalog(spark, sf_dir), F.col("id")

    def text(t: str) -> Column:
        return _filled(t, model_code=F.replace("model_code", F.lit("#"), F.lit("")), **_columns())

    head = [(text("产品型号名称:<model_code>型<trademark>"), 40, 10), (text("总质量(kg):<seq>"), 300, 10), (text("外形尺寸(长×宽×高)(mm):"), 40, 30), (text("长:<seq>"), 200, 30), ("货厢栏板内尺寸(长×宽×高)(mm):", 40, 50), (text("长:<range_km>"), 240, 50), (text("高:<seq>"), 300, 50), (text("批次 <batch>"), 40, 60)]
    plain = [*head, ("发动机型号", 40, 110), ("功率(kw)", 250, 110), ("车身反光标识说明", 390, 110), (text("E<id>"), 42, 130), (text("<seq>"), 250, 130), (text("<batch>"), 250, 145), ("轴荷:1/2", 40, 200), ("其他:", 390, 150), (text("<category>"), 391, 170), ("车辆识别代号", 40, 220), ("LGX×车身", 40, 240)]
    table = [("底盘", 40, 100), ("ID", 72, 100), ("底盘型号", 110, 100), ("底盘名称", 310, 100), (text("P<id>"), 40, 120), (text("<batch>"), 111, 120), ("底盘", 311, 120), (text("Q<seq>"), 40, 140), ("B2", 111, 140), ("其他:", 40, 220), (text("<category>"), 80, 220)]
    pages = c.select("id", F.when(k % 36 == 0, _words(*head, *table)).when(k % 3 == 0, _words(*head, *table, ("底盘类别", 210, 100))).otherwise(_words(*plain)).alias("words"))
    got = parameter_pages.parameter_pages(pages, "id")
    names = ("model_code", "product_name", "batch", "gross_mass", "outline_length", "cargo_dims", "engine_model", "engine_power", "axle_load", "vin", "chassis", "other", "layout")
    return got.select("id", *(F.coalesce(F.try_element_at("fields", F.lit(n)), F.lit("")).alias(n) for n in names), F.map_contains_key("fields", F.lit("error")).alias("error"))


def catalogue_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = catalog(spark, sf_dir), F.col("id")
    rows = c.select("model_code", F.when(k % 2 == 0, "减免车辆购置税目录").otherwise("车船税").alias("catalog"), F.when(k % 7 == 0, "x").otherwise(F.col("batch")).alias("batch"), "common_name", "range_km", F.lit("").alias("fuel_consumption"), F.when(k % 5 == 0, F.col("seq")).alias("battery_mass"), F.col("seq").alias("battery_energy"))
    return parameter_pages.catalogue_values(rows)


def review_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = dealt_catalog(spark, sf_dir), F.col("id")
    fields = F.map_from_arrays(F.array(*map(F.lit, ("model_code", "batch", "range_km", "common_name"))), F.array("model_code", "batch", "range_km", F.when(k % 5 == 0, "N/A").otherwise("")))
    return parameter_pages.review_form(c.select("trademark", k.alias("product"), fields.alias("fields")), ["trademark"], "product")


_C = f"WITH {SQL_CATALOG}"
_FORM = ", ".join(f"({i}, '{label}', '{field}', {field in parameter_pages.CATALOGUE})" for i, (label, field) in enumerate(parameter_pages.TEMPLATE))


def _rows(*rows: str) -> str:
    return " UNION ALL ".join(rows)


ORACLES = {
    "search_responses": f"""{_C}, h AS (
  SELECT id, unnest([CAST(id AS VARCHAR), '7', '8', '9']) AS series_id, unnest([1, 2, 3, 4]) AS n, common_name AS title, trademark AS brand FROM catalog WHERE id % 4 = 0
  UNION ALL SELECT id, CAST(id AS VARCHAR), 1, category, '' FROM catalog WHERE id % 4 = 1 UNION ALL SELECT id, CAST(id AS VARCHAR), 1, common_name, '' FROM catalog WHERE id % 4 = 2),
d AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY id, series_id ORDER BY n) = 1), r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n) AS rank FROM d)
SELECT id, rank, series_id, title, CASE WHEN title = common_name THEN 120 ELSE 100 END - rank AS score, brand FROM r JOIN (SELECT id, common_name FROM catalog) USING (id) WHERE series_id <> '8' OR n = 1""",
    "api_params": f"""{_C} {_rows(
        "SELECT id, 'param' AS kind, '基本参数' AS section, '级别' AS param, 0 AS place, CAST(id AS VARCHAR) AS spec, category AS value FROM catalog",
        "SELECT id, 'param', '基本参数', '级别', 2, 's' || id, '-' FROM catalog",
        "SELECT id, 'param', '基本参数', '续航', 0, CAST(id AS VARCHAR), 'CLTC' || CASE WHEN range_km = '' THEN '' ELSE ':' || range_km END || chr(10) || 'WLTC(' || seq || '元)' FROM catalog",
        "SELECT id, 'param', '基本参数', '续航', 2, 's' || id, '-' FROM catalog",
        "SELECT id, 'colour', '颜色', '外观颜色', 0, CAST(id AS VARCHAR), '红' || CASE WHEN seq = '0' THEN '' ELSE '(+' || seq || ')' END || chr(10) || '白' FROM catalog",
        "SELECT id, 'colour', '颜色', '外观颜色', 2, 's' || id, '-' FROM catalog")}""",
    "api_models": f"""{_C} {_rows(
        "SELECT id, 0 AS place, CAST(id AS VARCHAR) AS spec, trademark || ' ' || common_name AS model, seq || '万' AS guide_price, '-' AS dealer_price FROM catalog",
        "SELECT id, 2, 's' || id, trademark || ' 二', '-', '-' FROM catalog")}""",
    "page_params": f"""{_C}, m AS (SELECT *, 0 AS place, CAST(id AS VARCHAR) AS spec, common_name AS model FROM catalog WHERE id % 10 <> 9 UNION ALL SELECT *, 1, '999999999', '乙' FROM catalog WHERE id % 10 <> 9) {_rows(
        "SELECT id, 'param' AS kind, '基本参数' AS section, '厂商' AS param, place, spec, model, CASE place WHEN 1 THEN trademark ELSE '-' END AS value FROM m",
        "SELECT id, 'param', '基本参数', '级别', place, spec, model, CASE place WHEN 0 THEN category ELSE '-' END FROM m",
        "SELECT id, 'option', '配置', '气囊', place, spec, model, CASE place WHEN 0 THEN '●' || chr(10) || '主 / 副' || CASE WHEN range_km = '' THEN '' ELSE ':' || range_km END ELSE '-' END FROM m",
        "SELECT id, 'colour', '颜色', '外观颜色', place, spec, model, CASE place WHEN 1 THEN '红}' || CASE WHEN seq = '0' THEN '' ELSE '(+' || seq || ')' END ELSE '-' END FROM m",
        "SELECT id, 'colour', '颜色', '内饰颜色', place, spec, model, '-' FROM m",
        "SELECT id, 'package', '选装包', CASE place WHEN 0 THEN '包' ELSE '冬' END, place, spec, model, CASE place WHEN 0 THEN '-' ELSE batch END FROM m")}""",
    "structured_reviews": f"""{_C}, s AS (SELECT * FROM catalog WHERE id % 8 <> 7) {_rows(
        "SELECT id, 0 AS place, '空间' AS category, seq AS percent, seq || '%的用户满意' || common_name || '。' AS praise, CASE WHEN id % 3 = 0 THEN '但有用户反馈' || trademark ELSE '' END AS blame FROM s",
        "SELECT id, 1, '动力', '', '', '但部分用户嫌慢' FROM s")}""",
    "markdown_params": f"""{_C}, m AS (SELECT *, 0 AS place, CAST(id AS VARCHAR) AS spec, common_name AS model FROM catalog WHERE id % 9 <> 8 UNION ALL SELECT *, 1, '999999999', common_name || ' (2)' FROM catalog WHERE id % 9 <> 8) {_rows(
        "SELECT id, 'price' AS kind, '' AS section, '厂商指导价' AS param, place, spec, model, CASE place WHEN 0 THEN seq || '万' ELSE '9万' END AS value FROM m",
        "SELECT id, 'price', '', '经销商报价', place, spec, model, CASE place WHEN 0 THEN '8万' ELSE '-' END FROM m",
        "SELECT id, 'param', '基本参数', '级别', place, spec, model, CASE place WHEN 0 THEN category ELSE '-' END FROM m",
        "SELECT id, 'param', '车身', '长', place, spec, model, CASE place WHEN 0 THEN range_km || '1' ELSE batch END FROM m",
        "SELECT id, 'colour', '颜色', '外观颜色', place, spec, model, CASE place WHEN 0 THEN '红' || chr(10) || '白' ELSE trademark END FROM m",
        "SELECT id, 'colour', '颜色', '内饰颜色', place, spec, model, CASE place WHEN 0 THEN '黑' ELSE '灰' END FROM m",
        "SELECT id, 'package', '选装包', '冬季包', place, spec, model, CASE place WHEN 0 THEN '标配' || chr(10) || trademark ELSE '选配 ' || seq || '元' END FROM m",
        "SELECT id, 'unparsed', '', '', 0, '', '', '' FROM catalog WHERE id % 9 = 8")}""",
    "parameter_fields": f"""{_C}, p AS (SELECT *, id % 3 = 0 AS converted, id % 36 = 0 AS lacking FROM catalog)
SELECT id, CASE WHEN lacking THEN '' ELSE model_code END AS model_code, CASE WHEN lacking THEN '' ELSE trademark END AS product_name, CASE WHEN lacking THEN '' ELSE batch END AS batch, CASE WHEN lacking THEN '' ELSE seq END AS gross_mass,
  CASE WHEN lacking THEN '' ELSE seq END AS outline_length, CASE WHEN lacking THEN '' ELSE range_km || '××' || seq END AS cargo_dims, CASE WHEN converted THEN '' ELSE 'E' || id END AS engine_model,
  CASE WHEN converted THEN '' ELSE seq || ';' || batch END AS engine_power, CASE WHEN converted THEN '' ELSE '1/2' END AS axle_load, CASE WHEN converted THEN '' ELSE 'LGX×' END AS vin,
  CASE WHEN lacking THEN '' WHEN converted THEN batch || ';B2' ELSE '车身' END AS chassis, CASE WHEN lacking THEN '' ELSE category END AS other, CASE WHEN converted AND NOT lacking THEN 'converted' ELSE '' END AS layout, lacking AS error FROM p""",
    "catalogue_values": f"""{_C}, r AS (SELECT *, id % 2 AS tax, CASE WHEN id % 7 = 0 THEN 0 ELSE -CAST(batch AS INTEGER) END AS late FROM catalog)
SELECT model_code, {', '.join(f"(SELECT min({v}) FROM r x WHERE x.model_code = m.model_code AND {v} <> '' AND (x.tax, x.late) = (SELECT (tax, late) FROM r y WHERE y.model_code = m.model_code AND {v.replace('x.', 'y.')} <> '' ORDER BY tax, late LIMIT 1)) AS {n}"
        for n, v in (('common_name', 'x.common_name'), ('range_km', 'x.range_km'), ('battery_mass', "CASE WHEN x.id % 5 = 0 THEN x.seq ELSE '' END"), ('battery_energy', 'x.seq')))}, CAST(NULL AS VARCHAR) AS fuel_consumption
FROM (SELECT DISTINCT model_code FROM catalog) m""",
    "review_form": f"""{_C}, t(place, label, field, cat) AS (VALUES {_FORM}),
v AS (SELECT trademark, id AS product, place, label, cat, nullif(CASE field WHEN 'model_code' THEN model_code WHEN 'batch' THEN batch WHEN 'range_km' THEN range_km WHEN 'common_name' THEN CASE WHEN id % 5 = 0 THEN 'N/A' ELSE '' END END, '') AS value FROM catalog, t)
SELECT trademark, place, label, product, coalesce(value, 'N/A') AS value, CASE WHEN coalesce(max(value <> 'N/A') OVER (PARTITION BY trademark, place), false) THEN CASE WHEN cat THEN '减免车辆购置税目录' ELSE '公告参数页' END
  ELSE CASE WHEN cat THEN '减免车辆购置税目录未命中' ELSE '公告参数页未显示/未解析' END END AS note FROM v""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
