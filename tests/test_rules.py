"""Truth tables of the classification rules."""

import pytest
from pyspark.sql import functions as F

from fleetlens.functions import rules

SCOPE = [
    ("纯电动轿车", "", "Z", "accepted", "official_complete_vehicle_name"),
    ("三轮载货车", "", "Z", "excluded", "non_automotive"),
    ("低平板半挂车", "货车", "Z", "excluded", "non_automotive"),
    ("载货汽车底盘", "", "Z", "excluded", "incomplete_vehicle_or_component"),
    ("轿车", "", "d", "excluded", "incomplete_vehicle_or_component"),
    ("越野车（右舵）", "", "", "accepted", "official_complete_vehicle_name"),
    ("旅居设备", "专用汽车", "", "accepted", "official_catalog_category"),
    ("旅居设备", "其他", "", "pending_review", "insufficient_scope_evidence"),
    (None, None, None, "pending_review", "insufficient_scope_evidence"),
    ("  纯电动　轿车 ", "", "", "accepted", "official_complete_vehicle_name"),
]
ENERGY = [
    ("纯电动", "x", "", "", "纯电动", "fuel_type"),
    ("氢气", "x", "", "", "燃料电池", "fuel_type"),
    ("汽油/电混合动力", "插电式混合动力轿车", "", "", "插电式混合动力", "fuel_type+product_name"),
    ("汽油/电混合动力", "轿车", "", "增程式", "增程式", "fuel_type+jianmian"),
    ("汽油/电混合动力", "轿车", "", "", "混合动力", "fuel_type"),
    ("", "混合动力轿车", "", "插电式混合动力", "插电式混合动力", "product_name+jianmian"),
    ("汽油", "纯电动客车", "", "", "纯电动", "product_name"),
    ("", "轿车", "", "燃料电池", "燃料电池", "jianmian"),
    ("", "轿车", "", "新能源", "未知", "jianmian"),
    ("汽油", "轿车", "", "", "燃油", "fuel_type"),
    (None, None, None, None, "未知", "none"),
]
CHANNEL = [
    ("AB7000", "多用途车", "客车", "", "bus"), ("AB1000", "纯电动轿车", "", "", "passenger"), ("AB5030", "厢式运输车", "", "", "special"),
    ("AB6100", "城市客车", "", "", "bus"), ("AB6100", "多用途车", "", "", "passenger"), ("AB3040", "某车", "", "", "truck"), ("ab3040", "某车", "", "货车", "truck"), (None, None, None, None, "special"),
]


def test_scope(spark):
    df = spark.createDataFrame(SCOPE, "name string, cat string, tag string, gate string, reason string")
    got = df.select(rules.scope(F.col("name"), F.col("cat"), F.col("tag")).alias("s"), "gate", "reason").collect()
    assert [(r.s.gate, r.s.reason) for r in got] == [(r.gate, r.reason) for r in got]


def test_energy(spark):
    df = spark.createDataFrame(ENERGY, "fuel string, name string, model string, cat string, energy string, source string")
    got = df.select(rules.energy(*map(F.col, ("fuel", "name", "model", "cat"))).alias("e"), "energy", "source").collect()
    assert [(r.e.energy, r.e.source) for r in got] == [(r.energy, r.source) for r in got]


def test_channel(spark):
    df = spark.createDataFrame(CHANNEL, "model string, name string, cat string, hint string, channel string")
    got = df.select(rules.channel(*map(F.col, ("model", "name", "cat", "hint"))).alias("c"), "channel").collect()
    assert [r.c.channel for r in got] == [r.channel for r in got]


@pytest.mark.parametrize(
    ("energy", "batch", "expected"),
    [("纯电动", "1", "nev"), ("燃油", "408", "non_nev_batch"), ("燃油", "0409", "non_nev_batch"), ("燃油", "407", "outside"), ("未知", "407", "needs_nev_evidence"), ("未知", "408a", "needs_nev_evidence"), ("混合动力", None, "outside")],
)
def test_energy_scope(spark, energy, batch, expected):
    df = spark.createDataFrame([(energy, batch)], "e string, b string")
    assert df.select(rules.energy_scope(F.col("e"), F.col("b"))).first()[0] == expected


def test_document_states(spark):
    rows = [
        (None, 1, "a", "", 1, "%PDF", "", 1, "no_document"), (2, 1, "a", "", 1, "%PDF", "", 1, "error"), (1, 5, "a", "下载失败 x", 5, "%PDF", "", 1, "download_failed"), (0, 0, "a", "", 0, "", "", 0, "download_failed"),
        (1, 5, "", "", 5, "%PDF", "", 1, "pdf_invalid"), (1, 5, "a", "", 6, "%PDF", "", 1, "pdf_invalid"), (1, 5, "a", "", 5, "<htm", "", 1, "pdf_invalid"), (0, 5, "a", "", 5, "<htm", "", 1, "non_pdf"),
        (1, 5, "a", "", 5, "%PDF", "bad", 1, "pdf_unparsed"), (1, 5, "a", "", 5, "%PDF", "", 0, "pdf_unparsed"), (1, 5, "a", "", 5, "%PDF", "", 1, "parsed"),
    ]
    df = spark.createDataFrame(rows, "is_pdf int, size int, path string, error string, fs int, magic string, pe string, n int, want string")
    fields = F.when(F.col("n") > 0, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    got = df.select(rules.document_state(*map(F.col, ("is_pdf", "size", "path", "error", "fs", "magic", "pe")), fields).alias("s"), "want").collect()
    assert [r.s for r in got] == [r.want for r in got]


def test_window_and_prefixes(spark):
    df = spark.createDataFrame([("2024-01-01", 410), ("2024-03-05", 410), (None, 410), ("2024-03-01", 408)], "d string, b int")
    w = rules.in_window(F.col("d").cast("date"), F.lit("2024-03-10").cast("date"), F.col("b"), F.lit(410))
    assert [r[0] for r in df.select(w).collect()] == [False, True, True, False]
    codes = spark.createDataFrame([("ab1",), ("AB2",), ("cd",), (None,)], "c string")
    assert [r[0] for r in codes.select(rules.matches_prefixes(F.col("c"), ["Ab"], ["ab2"])).collect()] == [True, False, False, False]
