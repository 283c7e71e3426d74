"""Generic pages: pairs of irregular HTML, fields from labels, text and title, series pages."""

import json

from fleetlens.sources import generic_pages as pages

PAGE = """<html><head><title>〖秦 2024款 冠军版〗参数配置表_价格单_比亚迪_汽车之家</title><style>p{a:b}</style><script>var x = "x: y";</script></head><body>
<table><tr><th>最大功率(kW)</th><td> 145 kW </td></tr><tr><td>a</td><td>b</td><td>c</td></tr><tr><td></td><td>电池类型</td><td>磷酸<b>铁锂</b></td></tr>
<tr><td>outer</td><td><table><tr><td>inner</td><td>9</td></tr></table></td></tr></table>
<ul><li>厂商指导价：9.98万<li>变速箱: E-CVT：固定</ul><div><span>轴距：</span><span>2718mm</span></div><p>长x宽x高：4765*1837*1495</p>
<div>发动机：1.5L 自然吸气 L4</div><p>厂商指导价: again</p><p>：no label</p><p>座位数: 5座 &amp; more</p>
<a href="/config/1.html">x</a><a href="https://www.autohome.com.cn/s"><i>参数配置</i></a><a href="http://other.com/config/2">n</a><a href="/config/1.html">again</a><a>none</a></body>"""


def tree(html):
    t = pages._Tree()
    t.feed(html)
    t.close()
    return t


def test_pairs_of_irregular_html():
    got = tree(PAGE).pairs()
    assert got["最大功率(kW)"] == "145 kW" and got["电池类型"] == "磷酸 铁锂" and got["inner"] == "9" and "a" not in got and "outer" not in got
    assert got["厂商指导价"] == "9.98万 变速箱: E-CVT：固定" and got["轴距"] == "2718mm" and got["发动机"] == "1.5L 自然吸气 L4" and "" not in got and "x" not in got
    assert tree("<p>" + "k" * 119 + ":v</p><p>k:" + "v" * 118 + "</p></div></p>x").pairs() == {"k": "v" * 118} and tree("").pairs() == {}


def test_links_to_configurations():
    assert tree(PAGE).links("https://car.autohome.com.cn/a/b", "autohome.com.cn") == ["https://car.autohome.com.cn/config/1.html", "https://www.autohome.com.cn/s"]


def test_summary_of_a_page(spark):
    df = spark.createDataFrame([(1, "u", PAGE), (2, "u", None), (3, "u", "<p>返回 宋 上市时间2024.05 CLTC续航里程 501km 快充0.5小时 月销量 1,234辆</p>")], "id long, url string, html string")
    rows = {r.id: r for r in pages.page_summaries(pages.read_pages(df, "id"), "id").collect()}
    one = rows[1].asDict()
    want = {
        "brand": "比亚迪", "series_name": "秦", "max_power_kw": "145", "battery_type": "磷酸 铁锂", "official_price": "9.98万 变速箱: E-CVT：固定", "wheelbase_mm": "2718", "length_mm": "4765", "width_mm": "1837", "height_mm": "1495",
        "engine": "1.5L 自然吸气 L4", "displacement": "1.5", "intake_type": "自然吸气", "seats": "5", "doors": "",
    }
    assert {k: one[k] for k in want} == want
    assert set(rows[2].asDict().values()) == {2, "u", ""}
    three = rows[3].asDict()
    assert {k: v for k, v in three.items() if v and k not in ("id", "url")} == {
        "series_name": "宋 上市时间2024.05 CLTC续航里程 501km 快充0.5小时 月销量 1,234辆", "market_date": "2024.05", "cltc_range_km": "501", "fast_charge_time": "0.5小时", "sales_volume": "1,234辆",
    }


CONFIG = {"result": {"paramtypeitems": [
    {"name": "<span>基本</span>参数", "paramitems": [
        {"id": 567, "name": "车型<i>名称</i>", "valueitems": [{"specid": "11", "value": "秦 2023款 基础版"}, {"specid": "12", "value": "秦 2024款 冠军版"}, {"specid": "13", "value": "秦 2024款 旗舰版"}]},
        {"id": -1, "name": "厂 ( )", "valueitems": [{"specid": "12", "value": "9.98"}, {"specid": "13", "value": "12"}]}, {"id": -1, "name": "x", "valueitems": [{"specid": "13", "value": "比亚迪汽车"}]},
        {"id": 1148, "name": "", "valueitems": [{"specid": "13", "value": "4765*1837*1495"}]}, {"id": 9124, "name": "排", "valueitems": [{"specid": "13", "value": "-"}]}, {"id": 1182, "name": "", "valueitems": [{"specid": "13", "value": "1498"}]},
    ]}, {"name": "none", "paramitems": None}, {"name": "车身", "paramitems": [{"id": 1173, "name": "", "valueitems": [{"specid": "13", "value": "5"}]}, {"id": 5, "name": "", "valueitems": [{"specid": "13", "value": "lost"}]}, {"id": 1173, "name": "", "valueitems": [{"specid": "13", "value": "7"}]}]},
]}}


def test_summary_of_a_series_page(spark):
    # an alias takes the first label that holds it ('厂商' the price's), a placeholder comes back by the exact label
    html = f"<title>汽车之家|秦PLUS|报价大全</title><script>var config = {json.dumps(CONFIG, ensure_ascii=False)};</script>"
    df = spark.createDataFrame([(1, "u", html, "秦 旗舰版", None), (2, "u", "<p></p>", "秦", "b")], "id long, url string, html string, wanted string, brand_name string")
    rows = {r.id: r.asDict() for r in pages.series_summaries(df, "id").collect()}
    want = {
        "spec": "13", "url": "https://car.autohome.com.cn/config/spec/13.html", "series_name": "秦PLUS", "model_name": "秦 2024款 旗舰版", "official_price": "12", "brand": "12", "length_mm": "4765", "height_mm": "1495",
        "displacement": "-", "seats": "7", "engine": "",
    }
    assert {k: rows[1][k] for k in want} == want
    assert (rows[2]["spec"], rows[2]["url"], rows[2]["brand"], rows[2]["model_name"]) == (None, "u", "b", "")
    long = pages.summary_rows(pages.series_summaries(df.where("id = 1"), "id"), "id").orderBy("place").collect()
    assert len(long) == 32 and (long[0].section, long[0].param, long[0].value) == ("基础信息", "品牌", "12") and long[8].value == "-"
