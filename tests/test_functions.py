import datetime

from pyspark.sql import functions as F

from fleetlens.functions import text, values


def col(spark, rows, f):
    df = spark.createDataFrame([(r,) for r in rows], "s string")
    return [r[0] for r in df.select(f(F.col("s"))).collect()]


def test_numerals(spark):
    assert col(spark, ["二十八", "三十", "十", "一百零三", "26", "甲", None], values.chinese_int) == [28, 30, 10, 103, 26, None, None]


def test_batches(spark):
    assert col(spark, ["409", "405-407", "405, 407，405", "100-100", ""], values.batch_list) == [[409], [405, 406, 407], [405, 407], [100], []]


def test_text_int(spark):
    assert col(spark, ["32abc", "abc", "", "0405", None, " -7 "], values.text_int) == [32, 0, 0, 405, None, -7]


def test_dates(spark):
    d = datetime.date(2024, 1, 31)
    assert col(spark, ["2024-01-31 08:00", "20240131", "2024/01/31", "2024年1月31日发布", "31.1.2024", "", None], values.parse_date) == [d, d, d, d, None, None, None]


def test_months(spark):
    df = spark.createDataFrame([(202601,)], "m int")
    r = df.select(values.shift_month(F.col("m"), -1), values.month_range_label(F.col("m"), 12), values.shift_month(F.col("m"), 12)).first()
    assert tuple(r) == (202512, "2025-02 ~ 2026-01", 202701)


def test_keys_and_names(spark):
    assert col(spark, [" Ab_c-D　e ", None], text.norm_key) == ["abcde", ""]
    assert col(spark, ["a/b: c*", "...", ""], text.safe_part) == ["a_b_c", "unknown", "unknown"]
    assert col(spark, ["x, y，x", ""], text.split_names) == [["x", "y", "x"], []]
    assert col(spark, ["x, y\nx", "0, 10"], text.split_args) == [["x", "y"], ["0", "10"]]
    assert col(spark, ["某公司AB1234", "某公司"], text.split_fused) == [["某公司", "AB1234"], ["某公司"]]
    assert col(spark, ["../x", "/x", "a/b", "a/../b", ""], text.safe_relative) == [False, False, True, False, False]


def test_tokens(spark):
    df = spark.createDataFrame([("brand009", "009"), ("x1009", "009"), ("m9x", "m9")], "n string, t string")
    assert [r[0] for r in df.select(text.has_token(F.col("n"), F.col("t"))).collect()] == [True, False, True]


def test_maps(spark):
    df = spark.sql("SELECT map('a', '1', 'b', '', 'e', 'x') AS o, map('a', '2', 'b', '3', 'c', '4') AS n")
    get = lambda f: dict(df.select(f(F.col("o"), F.col("n"))).first()[0])
    assert get(lambda o, n: values.merge_fields(o, n, ["e", "c"])) == {"a": "1", "b": "", "c": "4"}
    assert get(values.fill_blank) == {"a": "1", "b": "3", "c": "4", "e": "x"}
    assert get(values.overwrite) == {"a": "2", "b": "3", "c": "4", "e": "x"}
    assert get(values.set_default) == {"a": "1", "b": "", "c": "4", "e": "x"}
    assert df.select(values.changed_keys(F.col("o"), F.col("n"))).first()[0] == ["a", "b", "c", "e"]


def test_sql_names(spark):
    r = spark.sql("SELECT norm_key(' A_b '), text_int('12x'), safe_part('a b'), model_prefix('AB12')").first()
    assert tuple(r) == ("ab", 12, "a_b", "AB")
