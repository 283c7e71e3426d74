import json
import random

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.details import script_json
from fleetlens.plans import pages
from fleetlens.sources import captures


def frame(spark, values, name="payload"):
    return spark.createDataFrame([(i, v if v is None or isinstance(v, str) else json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)], f"id int, {name} string")


def test_search_levels(spark):
    subjects = {"simple_result": {"entityName": "e", "entity_result": [{"belong_to_brand": " B "}], "simple_intent": {"subjects": [
        {"id": "7, 8,", "subject_s_name": "秦 L", "class_name": "CarSeries"}, {"id": "8", "subject_s_name": "x"}, {"id": "9", "subject_s_name": "y", "class_name": "Brand"}]}}}
    intents = {"simple_result": {"simple_intent": {"subjects": []}, "queryintent": [{"id": "-1", "entityName": "no"}, {"id": 5, "entityName": "", "ruleType": 4}, {"id": "6", "entityName": "b", "ruleType": 3}]}}
    terms = {"qp_result": {"term": [{"id": "1", "entityName": " "}, {"id": "2", "entityName": "t"}, {"id": "2", "entityName": "u"}]}}
    df = frame(spark, [subjects, intents, terms, {}, "{broken", None, ""])
    got = sorted((r.id, r.rank, r.series_id, r.name, r.series) for r in captures.search_hits(df).collect())
    assert got == [(0, 1, "7", "秦 L", True), (0, 2, "8", "", True), (0, 3, "9", "y", False), (1, 1, "5", "", True), (1, 2, "6", "b", False), (2, 1, "2", "t", True)]
    best = captures.search_candidates(df.withColumn("wanted", F.lit("秦  l")), "wanted").collect()
    assert sorted((r.id, r.series_id, r.title, r.score, r.brand) for r in best) == [(0, "7", "秦 L", 119, "B"), (0, "8", "秦  l", 118, "B"), (1, "5", "秦  l", 119, ""), (2, "2", "t", 99, "")]


def test_configuration_api(spark):
    payload = {"result": {"bread": {"seriesname": "秦"}, "titlelist": [
        {"itemtype": "基本参数", "items": [{"titleid": 1, "itemname": "车型名称"}, {"titleid": 9, "itemname": "级别"}, {"titleid": 10, "itemname": "图片集"}, {"titleid": -4, "itemname": "no"}]},
        {"itemtype": "广告位", "items": [{"titleid": 11, "itemname": "x"}]}, {"itemtype": "颜色", "items": [{"titleid": 12, "itemname": "外观颜色"}]}, {"itemtype": "", "items": [{"titleid": 9, "itemname": "等级"}]}],
        "datalist": [
            {"specid": 100, "specname": " A  款", "minprice": "9.98万起询底价", "dealerprice": "暂无", "paramconflist": [
                {"titleid": 9, "itemname": "紧凑", "sublist": [{"name": "a", "value": "●", "priceinfo": None}, {"name": "b", "value": "2", "priceinfo": "100元"}, {"name": "", "value": "3"}, {"name": "--", "value": "--"}]},
                {"titleid": 12, "colorinfo": {"list": [{"name": "红", "price": 2000}, {"name": "白", "price": 0}, {"name": "--"}]}}]},
            {"specid": "", "specname": "x"}, {"specid": "101", "specname": "B", "paramconflist": [{"titleid": 9, "itemname": "old"}, {"titleid": 9, "itemname": "--", "sublist": [{"name": "only"}]}]}]}}
    df = frame(spark, [payload, None, "{"])
    got = sorted((r.kind, r.section, r.param, r.place, r.spec, r.value) for r in captures.api_params(df).collect())
    assert got == [
        ("colour", "颜色", "外观颜色", 0, "100", "红(+2000)\n白"), ("colour", "颜色", "外观颜色", 2, "101", "-"),
        ("param", "未分类", "等级", 0, "100", "紧凑\na\nb:2(100元)\n3"), ("param", "未分类", "等级", 2, "101", "only"),
    ]
    models = sorted((r.spec, r.model, r.guide_price, r.dealer_price) for r in captures.api_models(df).collect())
    assert models == [("100", "秦 A 款", "9.98万", "-"), ("101", "秦 B", "-", "-")]


def page(**scripts):
    return "<html><script>" + ";\n".join(f"var {k} = {json.dumps(v, ensure_ascii=False)}" for k, v in scripts.items()) + ";</script>"


def test_page_scripts(spark):
    def values(*pairs):
        return [{"specid": s, "value": v} for s, v in pairs]

    config = {"result": {"paramtypeitems": [
        {"name": "<b>基本参数</b>", "paramitems": [{"id": -1, "name": "车型名", "valueitems": values((1, "甲"), (2, "乙"))}, {"id": -1, "name": "厂()", "valueitems": values((1, "9万"))}, {"id": -1, "name": "?", "valueitems": values((1, "厂家"))}, {"id": 53, "name": "?", "valueitems": values((1, "旧"), (1, "紧凑"))}]},
        {"name": "热门推荐", "paramitems": [{"id": 5, "name": "x", "valueitems": []}]}]}}
    option = {"result": {"configtypeitems": [{"name": "", "configitems": [{"name": "气囊", "valueitems": [{"specid": 2, "value": "●", "sublist": [{"subname": "主", "subvalue": "1"}, {"subname": "副", "subvalue": "选"}, {"subname": "", "subvalue": "3"}]}]}, {"name": "对比", "valueitems": []}]}]}}
    colour = {"result": {"specitems": [{"specid": 1, "coloritems": [{"name": "红", "price": 500}, {"name": "<i>白</i>"}]}]}}
    bag = {"result": {"bagtypeitems": [{"name": "包", "bagitems": [{"specid": 1, "valueitems": []}, {"specid": 2, "valueitems": [{"name": "冬", "value": "--"}, {"name": "", "value": "4"}]}, {"specid": 3, "valueitems": []}]}]}}
    df = frame(spark, [page(config=config, option=option, color=colour, bag=bag), page(option=option), None, "x"], "html")
    got = sorted((r.kind, r.section, r.param, r.place, r.model, r.value) for r in captures.page_params(df).collect())
    assert got == sorted([
        ("param", "基本参数", "厂商", 0, "甲", "厂家"), ("param", "基本参数", "厂商", 1, "乙", "-"), ("param", "基本参数", "级别", 0, "甲", "紧凑"), ("param", "基本参数", "级别", 1, "乙", "-"),
        ("option", "配置", "气囊", 0, "甲", "-"), ("option", "配置", "气囊", 1, "乙", "●\n主 / 副:选 / 3"),
        ("colour", "颜色", "外观颜色", 0, "甲", "红(+500)\n白"), ("colour", "颜色", "外观颜色", 1, "乙", "-"), ("colour", "颜色", "内饰颜色", 0, "甲", "-"), ("colour", "颜色", "内饰颜色", 1, "乙", "-"),
        ("package", "选装包", "包", 0, "甲", "-"), ("package", "选装包", "冬", 1, "乙", "-"), ("package", "选装包", "包", 1, "乙", "4"),
    ])


def test_structured_reviews(spark):
    blocks = [{"autodrive": {"list": [{"category1Name": " 空间 ", "reviewContent": "85%的用户满意。但有用户反馈小"}, {"category1Name": "动力", "reviewContent": " "}]}, "n": 3}, {"Summary": "[]"}, {"o": {"list": [{"category1Name": "空间", "reviewContent": "again"}, {"category1Name": "动力", "reviewContent": "但部分用户嫌慢"}]}}]
    got = captures.structured_reviews(frame(spark, [blocks, [], None, "{"], "structuredlist")).collect()
    assert [(r.id, r.category, r.percent, r.praise, r.blame) for r in got] == [(0, "空间", "85", "85%的用户满意。", "但有用户反馈小"), (0, "动力", "", "", "但部分用户嫌慢")]


MARKDOWN = """共 2 款车型
[甲](http://x/spec/1/) 询底价
[乙](http://x/spec/2/)
厂商指导价
9万
10万 询底价
经销商报价
暂无
8万
基本参数
级别
紧凑
--
车身
[长](http://x/p)
4000
4100
图片
a
b
发动机
[排量](http://x/p)
1.5
2.0
颜色
外观颜色
[红](http://x/spec/1/)
白
[蓝](http://x/spec/2/)
内饰颜色
黑
灰
选装包
标配 ● 选配 ○
冬季包
标配
__热座__
选配 1000元
关于我们
"""


def test_markdown(spark):
    df = frame(spark, [MARKDOWN, MARKDOWN.replace("经销商报价", "报价"), None, ""], "text")
    got = captures.markdown_params(df, "id").collect()
    assert sorted(r.id for r in got if r.kind == "unparsed") == [1, 3]
    have = {(r.kind, r.section, r.param, r.spec): r.value for r in got if r.id == 0}
    want = {
        ("price", "", "厂商指导价"): ("9万", "10万"), ("price", "", "经销商报价"): ("8万", "-"), ("param", "基本参数", "级别"): ("紧凑", "-"), ("param", "车身", "长"): ("4000", "4100"),
        ("param", "发动机", "排量"): ("1.5", "2.0"), ("colour", "颜色", "外观颜色"): ("红\n白", "蓝"), ("colour", "颜色", "内饰颜色"): ("黑", "灰"), ("package", "选装包", "冬季包"): ("标配\n热座", "选配 1000元"),
    }
    assert have == {(*k, str(i + 1)): v for k, vs in want.items() for i, v in enumerate(vs)}


def test_shares_cover_all_cells():
    random.seed(3)
    for _ in range(500):
        models = random.randint(1, 5)
        each = random.randint(1, 4)
        first = random.randint(0, models - 1)
        owner = [m if m == first and k == 0 else None for m in range(models) for k in range(each)]
        got = captures.shares(owner, models)
        if first == 0:
            assert got == [(m, m * each, m * each + each) for m in range(models)]
        covered = sorted(i for _, lo, hi in got for i in range(lo, hi))
        assert covered == list(range(len(owner)))
    assert captures.shares([None] * 6, 3) == [(0, 0, 2), (1, 2, 4), (2, 4, 6)]
    assert captures.shares([0, 0, 0, None], 2) == [(0, 0, 3), (1, 3, 4)]
    with pytest.raises(ValueError):
        captures.shares([None] * 5, 2)


def test_script_json_reads_names_strings_and_open_ends(spark):
    texts = ['xconfig={"a":1};config = {"b":"}{\\"","c":{"d":{}}};config={}', 'config={"a":"}', '$config={};a.config={"😀":1}x', "config={{}", None, 'config={"a":"\\\\"}}']
    c = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")
    got = [r[0] for r in c.orderBy("id").select(script_json(F.col("t"), "config")).collect()]
    assert got == ['{"b":"}{\\"","c":{"d":{}}}', "", '{"😀":1}', "", "", '{"a":"\\\\"}']


def test_pages_are_read_by_many_tasks_and_scripts_once(spark):
    data = "/root/testdata/sf0.001"
    for name in ("page_params", "api_params", "parameter_fields"):
        assert pages.QUERIES[name](spark, data).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    plan = pages.QUERIES["page_params"](spark, data)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 5
