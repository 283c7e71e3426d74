import pytest
from pyspark.sql import functions as F

from fleetlens.operators import compare, latest, match, matrix, merge, reconcile


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_latest_batch(spark):
    df = spark.createDataFrame([("1", "0405"), ("2", "405"), ("3", "404"), ("4", "x")], "id string, b string")
    assert rows(latest.latest_batch_rows(df, "b")) == [("1", "0405"), ("2", "405")]
    none = spark.createDataFrame([("1", "x"), ("2", None)], "id string, b string")
    assert latest.latest_batch_rows(none, "b").count() == 2


def test_first_filled_and_carry(spark):
    df = spark.createDataFrame([("m", 1, "", "x"), ("m", 2, "a", "y"), ("m", 3, "b", "")], "k string, o int, u string, v string")
    assert rows(latest.first_filled_per_key(df, ["k"], ["o"], ["u", "v"])) == [("m", "a", "x")]
    assert [r.u for r in latest.carry_forward(df, ["k"], ["o"], ["u"]).orderBy("o").collect()] == [None, "a", "b"]


def test_coverage_has_one_of_each(spark):
    catalog = spark.createDataFrame([(c,) for c in (" a", "b", "c", "d", "e", "f", "F", "")], "code string")
    documents = spark.createDataFrame([("A", 1, 5, ""), ("b", 0, 5, ""), ("F", 0, 5, "下载失败")], "code string, is_pdf int, bytes int, error string")
    runs = spark.createDataFrame([("c", 1, "no_match"), ("c", 2, "querying"), ("e", 1, "awaiting_effective")], "key string, run_id int, status string")
    vehicles = spark.createDataFrame([("e",), ("f",)], "code string")
    got = reconcile.coverage(catalog, documents, reconcile.best_outcomes(runs), vehicles)
    assert rows(got) == [("A", "downloaded"), ("B", "no_pdf"), ("C", "absent"), ("D", "unseen"), ("E", "waiting"), ("F", "retry")]


def test_event_without_product_needs_all(spark):
    events = spark.createDataFrame([(1, "m", 1, ""), (2, "m", 1, "p"), (3, "n", 1, None)], "event_id int, model string, batch int, product string")
    events = events.selectExpr("*", "date'2024-01-01' AS event_date", "'accepted' AS gate", "'open' AS status", "date'2024-01-01' AS next_check")
    documents = spark.createDataFrame([("m", 1, "p", True), ("m", 1, "q", False)], "model string, batch int, product string, valid boolean")
    got = reconcile.event_buckets(events, documents, F.lit("2024-01-05").cast("date"), F.lit(1)).select("event_id", "bucket")
    assert rows(got) == [(1, "due"), (2, "resolved_valid_pdf"), (3, "due")]


def test_cache_completeness(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 4, true, false, array('B','A','A'), '2024-01-01T00:00:00+00:00'), (2, 3, true, false, array('A','B'), '2024-01-01T00:00:00+00:00'),
        (3, 4, true, false, array('A'), '2024-01-01T00:00:00+00:00'), (4, 4, true, false, array('A','B'), '2025-01-01T00:00:00+00:00'), (5, 4, true, true, array('A','B'), '2024-01-01T00:00:00+00:00'), (6, 4, true, false, array('A','B'), 'x') t(id, v, c, a, p, f)""")
    ok = reconcile.complete_cache(F.col("v"), F.col("c"), F.col("a"), F.col("p"), ["A", "B"], F.lit(0), F.array(), F.col("f"), F.lit("2024-02-01").cast("timestamp"))
    assert [r[0] for r in df.orderBy("id").select(ok).collect()] == [True, False, False, False, False, False]


def test_attempt_evidence(spark):
    df = spark.createDataFrame([("x /d/第409批/[国]牌_AB1_409_p1.html; /d/第409批/[国]牌_AB2_408_p2.html",), ("nothing",), (None,)], "error string")
    assert rows(reconcile.attempt_evidence(df).select("batch", "model", "product")) == [("409", "AB1", "p1")]


def test_series_match(spark):
    sales = spark.createDataFrame([(1, "品牌1009"), (2, "LATIN 009"), (3, "ab M9"), (4, "cd M9"), (5, "Exact")], "ordinal int, series string")
    names = spark.createDataFrame([("e xact",), ("某车009",), ("x M9",), ("Ex",)], "name string")
    assert rows(match.match_series(names, sales)) == [("Ex", 2, "Exact"), ("e xact", 1, "Exact"), ("某车009", 3, "LATIN 009")]


def test_trims_are_taken_once(spark):
    asked = spark.createDataFrame([(1, 1, "Pro"), (1, 2, "Pro"), (1, 3, "zzz")], "g int, place long, request string")
    models = spark.createDataFrame([(1, 1, "X Pro"), (1, 2, "X Pro Max")], "g int, position long, model string")
    assert rows(match.assign_trims(asked, models, "g").select("place", F.coalesce("model", F.lit("-")))) == [(1, "X Pro"), (2, "X Pro Max"), (3, "-")]


@pytest.mark.parametrize(
    ("values", "expected"),
    [(["a", "a"], "a"), (["●", "-"], "区分高低配"), (["3200", "2995", "3200"], "2995/3200"), (["63", "-"], "63（部分无）"), (["", None], "-"), (["x", "y"], "x/y"), ([c * 30 for c in "abcd"], "/".join(c * 30 for c in "abc") + "…等4种")],
)
def test_summaries(spark, values, expected):
    df = spark.createDataFrame([(values,)], "v array<string>")
    assert df.select(matrix.summarise(F.col("v"))).first()[0] == expected


def test_powertrains(spark):
    cells = [("m", 1, "能源类型", "增程式"), ("m", 2, "驱动方式", "双电机四驱"), ("m", 3, "电池能量(kWh)", "60.0"), ("m", 4, "座位数", "6"), ("n", 1, "能源类型", "-")]
    df = spark.createDataFrame(cells, "model string, position int, param string, value string")
    assert rows(matrix.powertrain_labels(df, ["model"])) == [("m", "增程四驱60度电池6座"), ("n", "未分组")]


def test_scores_leave_out_invalid(spark):
    df = spark.createDataFrame([(1, True, 4.5), (1, False, 4.4), (1, False, 4.36), (1, False, 0.0)], "g int, own boolean, score double")
    r = compare.score_vs_mean(df, ["g"]).first()
    assert round(r["diff"], 2) == 0.12 and r["excluded"] == 1


def test_merges(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id int, v string, w string")
    new = spark.createDataFrame([(2, "", "z"), (3, "c", "q")], "id int, v string, w string")
    assert rows(merge.upsert(old, new, ["id"], keep_old=["w"], keep_if_blank=["v"])) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "q")]
    assert rows(merge.replace_groups(old, new, ["id"])) == [(1, "a", "x"), (2, "", "z"), (3, "c", "q")]
    plan = spark.createDataFrame([(1, "x", "A")], "id int, w string, v string")
    assert rows(merge.guarded_update(old, plan, ["id"], "w", "v")) == [(1, "A", "x"), (2, "b", "y")]
    stale = spark.createDataFrame([(1, "other", "A")], "id int, w string, v string")
    with pytest.raises(Exception, match="changed since"):
        merge.guarded_update(old, stale, ["id"], "w", "v").collect()


def test_fingerprint_ignores_order(spark):
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    assert reconcile.fingerprint(df).first() == reconcile.fingerprint(df.orderBy(F.desc("id")).repartition(3)).first()
    assert reconcile.fingerprint(df).first() != reconcile.fingerprint(df.where("id < 99")).first()


def test_contained_is_all_pairs(spark):
    names = ["a", "ab", "abcdefghij", "bcdefghijk", "abcdefghijk", "aab", "", "秦", "秦l", "bb", "zz"]
    inner = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, part string")
    outer = spark.createDataFrame([(j, n) for j, n in enumerate([*names, "ab"])], "j int, whole string")
    got = rows(match.contained(inner, "part", outer, "whole").select("i", "j"))
    assert got == sorted((i, j) for i, a in enumerate(names) for j, b in enumerate([*names, "ab"]) if a and b and a in b)
    plan = match.contained(inner, "part", outer, "whole")._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in plan and "__piece" in plan


def test_names_without_characters_take_the_first(spark):
    wanted = spark.createDataFrame([(" ",), ("秦PLUS",), ("汉 77",), ("唐",)], "name string")
    sales = spark.createDataFrame([(1, "宋77"), (2, "秦"), (3, "汉177")], "ordinal int, series string")
    assert rows(match.match_series(wanted, sales)) == [(" ", 2, "宋77"), ("汉 77", 3, "宋77"), ("秦PLUS", 2, "秦")]


def test_stored_answers_with_odd_names(spark):
    say = "接口返回非 PDF，已存为 HTML；原文件："
    good = f"{say}x/第409批/国_B_1_C_409_p1.html"
    log = [
        (1, "t", "partial", "B_1/C", good), (2, "t", "partial", " b_1/c ", f"超时; {say}第409批/国_b_1_c_409_p1.html; {say}第410批\\国_b_1_c_410_p2.html"), (3, "", "partial", "B_1/C", good), (4, "t", "done", "B_1/C", good), (5, "t", "partial", "1/C", good),
        (6, "t", "partial", "B_1/C", f"{say}../第409批/国_B_1_C_409_p3.html"), (7, "t", "partial", "B_1/C", f"{say}第172批/国_B_1_C_172_p4.html"), (8, "t", "partial", "B_1/C", f"{say}第409批/国_B_1_C_408_p5.html"), (9, "t", "partial", None, good), (10, "t", "partial", "B_1/C", None),
        (11, "t", "partial", "B_1/C", f"前{say}第409批/国_B_1_C_409_p6.html"), (12, "t", "partial", "B_1/C", f"{say}第409批/B_1_C_409_p7.html"),
    ]
    df = spark.createDataFrame(log, "run_id int, completed_at string, status string, model string, error string")
    got = sorted((r["product"], r.batch, r.key, r.run_id) for r in reconcile.stored_answers(df).collect())
    assert got == [("p1", 409, "1/C", 5), ("p1", 409, "B_1/C", 2), ("p2", 410, "B_1/C", 2)]
