import io
import json
import sqlite3
import zipfile

from fleetlens.sinks import tables
from fleetlens.sources import landing, parsers, sqlite


def test_catalog_html():
    sep = "<span></span>"
    html = (
        "<p>减免车船税目录（第二十八批）</p><p>一、插电式混合动力</p><p>乘用车</p>"
        f"<p>{sep.join(['序号', '企业名称', '商标', '车辆型号', '通用名称', '续驶里程', '1', '甲公司', '牌', 'AB1234', '名一', '60', '2', 'AB1235', '名二', '70', '客车'])}{sep}</p>"
        f"<p>{sep.join(['序号', '企业名称', '商标', '车辆型号', '通用名称', '续驶里程', '1', '乙公司', '乙', 'CD6', '名三', '80'])}{sep}</p>"
        f"<p>{sep.join(['序号', '企业名称', '商标', '车辆型号', '通用名称', '其他', '1', '乙公司', '乙', 'CD7', '名四', '80'])}{sep}</p>"
    )
    got = [(r[0], r[3], r[4], r[5], r[6 + 1], r[6 + 3], r[6 + 5]) for r in parsers.catalog_html(html)]
    assert got == [
        (1, 28, "插电式混合动力", "乘用车", "甲公司", "AB1234", "60"), (1, 28, "插电式混合动力", "乘用车", "甲公司", "AB1235", "70"), (2, 28, "插电式混合动力", "客车", "乙公司", "CD6", "80"),
    ]
    assert list(parsers.catalog_html(None)) == [] and list(parsers.catalog_html("<p>x")) == []


def test_a_value_that_equals_the_next_number_begins_no_row():
    names = ["seq", "company", "trademark", "model_code", "common_name", "range_km", "battery_mass"]

    def read(*cells):
        return [dict(zip(names, r)) for r in parsers.split_rows(names, list(cells))]

    whole = ["1", "甲公司", "牌", "AB1", "名", "2", "2", "2", "牌", "AB2", "名", "70", "3"]
    assert [(r["seq"], r["model_code"], r["range_km"], r["battery_mass"]) for r in read(*whole)] == [("1", "AB1", "2", "2"), ("2", "AB2", "70", "3")]
    # the last row ends with the number that would be next
    assert [(r["model_code"], r["range_km"]) for r in read("1", "甲公司", "牌", "AB1", "名", "2")] == [("AB1", "2")]
    # a number does begin a row where values or leading columns were left out
    for rest in (["2", "乙公司", "牌", "AB2"], ["2", "AB2", "名"], ["2", "牌", "AB2", "名", "7"]):
        assert [(r["seq"], "AB2" in r.values()) for r in read("1", "甲公司", "牌", "AB1", "名", *rest)] == [("1", False), ("2", True)]


def test_catalog_docx():
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    cell = lambda t, m="": f"<w:tc><w:tcPr>{m}</w:tcPr><w:p><w:r><w:t>{t}</w:t></w:r></w:p></w:tc>"
    head = "".join(map(cell, ("序号", "企业名称", "车辆型号", "续驶里程")))
    first = cell("") + cell("甲公司", '<w:vMerge w:val="restart"/>') + cell("AB1") + cell("10")
    second = cell("") + cell("", "<w:vMerge/>") + cell("AB2") + cell("20")
    xml = f"<w:document {w}><w:body><w:p><w:r><w:t>某目录（第三批）</w:t></w:r></w:p><w:tbl><w:tr>{head}</w:tr><w:tr>{first}</w:tr><w:tr>{head}</w:tr><w:tr>{second}</w:tr></w:tbl></w:body></w:document>"
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("word/document.xml", xml)
    got = [(r[3], r[6], r[7], r[9], r[11]) for r in parsers.catalog_docx(buffer.getvalue())]
    assert got == [(3, "1", "甲公司", "AB1", "10"), (3, "2", "甲公司", "AB2", "20")]


def test_notice_errors():
    html = "<table><tr><th>型号</th><th>批次</th><th>变更</th></tr><tr><td>A</td><td>1</td><td>x</td></tr><tr><td colspan=2>B</td><td>y</td></tr><tr><td>共2条</td></tr></table>"
    assert [(r[4], r[1], r[-1]) for r in parsers.notice_table(html)] == [("A", "1", None), ("B", "y", "merged cells")]


def test_words():
    word = lambda t, x, top: {"text": t, "x0": x, "x1": x + 10, "top": top}
    words = [word("产品型号:AB1", 10, 10), word("总质量(kg):99", 200, 11), word("第409批", 10, 1), word("发动机型号", 10, 30), word("功率", 200, 30), word("E1", 12, 40), word("77", 195, 40), word("其他:好", 10, 60)]
    assert parsers.fields_of(words) == {"batch": "409", "model": "AB1", "mass": "99", "engine_model": "E1", "power": "77", "other": "好"}
    assert parsers.fields_of([]) == {}


def test_sqlite(spark, tmp_path):
    path = str(tmp_path / "x.db")
    db = sqlite3.connect(path)
    db.execute("CREATE TABLE t (id INTEGER, name TEXT, v REAL)")
    db.executemany("INSERT INTO t VALUES (?, ?, ?)", [(i, f"n{i}", i / 2) for i in range(100)] + [(None, None, None)])
    db.commit()
    df = sqlite.read(spark, path, table="t", column="id", lower="0", upper="100", parts="4")
    assert df.rdd.getNumPartitions() == 4 and df.count() == 101 and df.agg({"v": "sum"}).first()[0] == 2475.0
    assert sqlite.read(spark, path, query="SELECT name FROM t WHERE id < 3").count() == 3


def test_caches(spark, tmp_path):
    doc = {"batch": 409, "cache_version": 4, "complete": True, "fetched_at": "2024-01-01T00:00:00+00:00", "failures": [], "verify_prefixes": ["A"], "verify_missed": 0, "products": [{"cpid": "", "gid": " g1 ", "clxh": "ab1", "gppc": "", "pc": "0409"}]}
    (tmp_path / "409.json").write_text(json.dumps(doc), encoding="utf-8")
    (tmp_path / "410.partial.json").write_text("{broken", encoding="utf-8")
    c = landing.caches(spark, str(tmp_path))
    assert sorted(r.kind for r in c.collect()) == ["complete", "partial"]
    p = landing.cache_products(c).collect()
    assert [(r.product, r.model, r.row_batch) for r in p] == [("g1", "AB1", 409)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a<b"), (2, None)], "id int, name string")
    tables.workbook(str(tmp_path / "x.xlsx"), {"one": df, "two": df.limit(1)})
    with zipfile.ZipFile(tmp_path / "x.xlsx") as z:
        assert "a&lt;b" in z.read("xl/worksheets/sheet1.xml").decode() and "xl/worksheets/sheet2.xml" in z.namelist()
    tables.html_report(str(tmp_path / "x.html"), "T", {"s": df})
    assert "<td>a&lt;b</td>" in (tmp_path / "x.html").read_text(encoding="utf-8")
    tables.markdown_report(str(tmp_path / "x.md"), "T", {"s": df}, limit=1)
    assert "... and 1 more" in (tmp_path / "x.md").read_text(encoding="utf-8")
    tables.csv_folder(df, str(tmp_path / "csv"))
    assert next((tmp_path / "csv").glob("*.csv")).read_bytes().startswith(b"\xef\xbb\xbf")
    tables.replace_articles(df.withColumnRenamed("id", "art_id"), str(tmp_path / "t"))
    tables.replace_articles(spark.createDataFrame([(2, "new")], "art_id int, name string"), str(tmp_path / "t"))
    assert sorted((r.art_id, r.name) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [(1, "a<b"), (2, "new")]


def test_upsert_profiles_replaces_the_first_that_shares_a_key(spark):
    old = spark.createDataFrame([(0, "A", ["a", "x"]), (1, "B", ["b", "x"]), (2, "C", ["c"])], "ordinal long, name string, keys array<string>")
    new = spark.createDataFrame([("N", ["x"]), ("M", ["m"]), ("L", ["l"])], "name string, keys array<string>")
    after = {(r["ordinal"], r["name"]) for r in landing.upsert_profiles(old, new).collect()}
    assert after == {(0, "N"), (1, "B"), (2, "C"), (None, "M"), (None, "L")}
    kept = {r["name"] for r in landing.upsert_profiles(old, new, overwrite=False).collect()}
    assert kept == {"A", "B", "C", "M", "L"}
