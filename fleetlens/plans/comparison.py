"""Competitor analytics and comparison matrices."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text, values
from ..operators import compare, match, matrix
from .roles import SQL_CATALOG, catalog, table

LEXICON = {"flow": ["thing", "ouch"], "pace": ["lich", "ción"], "room": ["eau", "tion"], "voice": ["heit", "ada"]}


def _user_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations").where("role = 'user'")
    return c.select((F.col("conv_id") % 7).alias("series"), (F.col("conv_id") * 100 + F.col("turn")).alias("ordinal"), "text")


def complaint_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = compare.complaint_categories(_user_texts(spark, sf_dir), ["series"], "text", "ordinal", LEXICON)
    return c.select("series", "category", "n", F.array_join(F.transform("samples", lambda x: F.md5(x)), ",").alias("samples"))


def tag_cloud(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    tags = e.select((F.col("user_id") % 10).alias("series"), F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "click", 1).otherwise(3).alias("sentiment"), F.when(F.hour("ts") == 0, "全部").otherwise(F.concat(F.lit("t"), F.hour("ts"))).alias("name"), F.get_json_object("props", "$.k").cast("int").alias("volume"))
    return compare.tag_cloud(tags, ["series"]).withColumn("share", F.round("share", 6))


def quotes_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.quotes(_user_texts(spark, sf_dir), ["series"], "text", "ordinal", 3).select("series", F.col("place").cast("bigint").alias("place"), "ordinal")


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of series on dimensions in comparisons; one part each."""
    p = table(spark, sf_dir, "part")
    series = F.substring_index("p_brand", "#", -1).cast("int")
    return p.select(
        (F.col("p_size") % 10).alias("grp"), series.alias("series"), (series % 6 == 0).alias("own"), F.col("p_type").alias("dim"), F.ascii("p_type").alias("ordinal"),
        F.when(F.col("p_partkey") % 9 == 0, 0.0).otherwise(F.round(F.pmod("p_partkey", F.lit(97)) / 20.0, 2)).alias("score"), F.col("p_retailprice").alias("price"),
    )


SQL_SCORES = "scores AS (SELECT p_size % 10 AS grp, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS series, CAST(split_part(p_brand, '#', 2) AS INTEGER) % 6 = 0 AS own, p_type AS dim, ascii(p_type) AS ordinal, CASE WHEN p_partkey % 9 = 0 THEN 0.0 ELSE round(p_partkey % 97 / 20.0, 2) END AS score, p_retailprice AS price FROM part)"


def _one_per_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).groupBy("grp", "series", "own").agg(F.max("score").alias("score"), F.min("price").alias("price"))


def dim_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = compare.dim_gaps(_scores(spark, sf_dir), ["grp"])
    return g.withColumn("best_gap", F.round("best_gap", 6)).withColumn("worst_gap", F.round("worst_gap", 6))


def score_vs_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = compare.score_vs_mean(_one_per_series(spark, sf_dir), ["grp"])
    return s.select("grp", "own_score", F.round("mean", 6).alias("mean"), F.round("diff", 6).alias("diff"), "excluded")


def price_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = _one_per_series(spark, sf_dir).where("series in (6, 1, 2, 3)")
    return compare.price_position(own, ["grp"]).withColumn("mean", F.round("mean", 6))


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    spans = F.explode(F.array(*(F.struct(F.lit(src).alias("source"), F.lit(sp).alias("span"), F.lit(i).alias("i")) for i, (src, sp) in enumerate((a, b) for a in ("dongchedi", "autohome") for b in ("year", "half_year", "latest")))))
    long = s.select(k.alias("series"), "s_nationkey", spans.alias("x")).select("series", "s_nationkey", "x.*")
    return long.withColumn("count", F.when((F.col("series") + F.col("i")) % 3 == 0, 0).otherwise(F.pmod(F.col("series") * 37 + F.col("i") * 11, F.lit(200))))


SQL_SALES = "sales AS (SELECT s_suppkey AS series, s_nationkey, source, span, i, CASE WHEN (s_suppkey + i) % 3 = 0 THEN 0 ELSE (s_suppkey * 37 + i * 11) % 200 END AS count FROM supplier, (VALUES ('dongchedi', 'year', 0), ('dongchedi', 'half_year', 1), ('dongchedi', 'latest', 2), ('autohome', 'year', 3), ('autohome', 'half_year', 4), ('autohome', 'latest', 5)) v(source, span, i))"


def headline_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare.headline_sales(_sales(spark, sf_dir)).withColumn("count", F.col("count").cast("bigint"))


def sales_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = compare.headline_sales(_sales(spark, sf_dir)).join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("series"), "s_nationkey"), "series")
    return compare.sales_ranks(h, ["s_nationkey"], "series").select("series", "s_nationkey", F.col("place").cast("bigint").alias("place"))


def sales_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = _sales(spark, sf_dir).select("series", F.concat_ws("_", "source", "span").alias("c"), "count")
    return cells.groupBy("series").pivot("c", ["dongchedi_year", "dongchedi_latest", "autohome_year"]).agg(F.first("count").cast("bigint"))


def suggestions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = compare.complaint_categories(_user_texts(spark, sf_dir).withColumnRenamed("series", "grp"), ["grp"], "text", "ordinal", LEXICON)
    s = compare.suggestions(c.select("grp", "category", "n"), _scores(spark, sf_dir).where("series in (6, 1, 2)").withColumn("grp", F.col("grp").cast("bigint")), ["grp"])
    return s.withColumn("weight", F.round("weight", 6))


def overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    one, dims = _one_per_series(spark, sf_dir), _scores(spark, sf_dir)
    ranks = compare.sales_ranks(one.withColumn("count", (F.col("score") * 100).cast("bigint")), ["grp"], "series").where("series = 6")
    o = compare.overview(compare.score_vs_mean(one, ["grp"]), compare.dim_gaps(dims, ["grp"]), compare.price_position(one, ["grp"]), ranks, ["grp"])
    return o.select("grp", "wins", "verdict")


def month_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").select("o_orderkey", (F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("m"))
    return m.select("o_orderkey", values.shift_month(F.col("m"), -1).alias("previous"), values.month_label(F.col("m")).alias("label"), values.month_range_label(F.col("m"), 6).alias("half_year"), values.month_range_label(F.col("m"), 12).alias("year"))


def sales_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    names = p.select(F.concat("p_name", F.lit(" "), F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.concat(F.lit("X"), F.col("p_size")))).alias("name")).distinct()
    n = table(spark, sf_dir, "nation")
    rank = n.select(F.col("n_nationkey").cast("int").alias("ordinal"), F.when(F.col("n_nationkey") % 2 == 0, F.concat(F.lit("Red Widget"), F.col("n_nationkey"))).when(F.col("n_nationkey") < 6, F.lit("blue bolt")).otherwise(F.concat(F.lit("品牌X"), F.col("n_nationkey") + 20)).alias("series"))
    return match.match_series(names, rank).select("name", F.col("pass"), "series")


def profile_fuzzy_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = table(spark, sf_dir, "part").select(F.concat("p_name", F.lit("_"), F.col("p_size")).alias("name")).distinct()
    prof = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("ordinal"), F.concat(F.lit("P"), F.col("n_nationkey")).alias("profile"), F.element_at(F.array(*map(F.lit, ("Red-", "small ring", "BOLT", "g_e", "widget 1", "red ring-4", "gear"))), (F.col("n_nationkey") % 7 + 1).cast("int")).alias("alias"))
    return match.match_profiles(names, prof)


PARAMS = ("能源类型", "驱动方式", "电池能量(kWh)", "座位数", "长度(mm)", "天窗", "雷达", "油箱(L)")
VALUES = {"能源类型": ("纯电动", "插电式混合动力", "汽油"), "驱动方式": ("前置四驱", "后驱", "-"), "电池能量(kWh)": ("60.5", "100", ""), "座位数": ("5", "7", "6"), "长度(mm)": ("4800", "5100.5", "4800"), "天窗": ("●", "○", "-"), "雷达": ("-", "-", "●激光"), "油箱(L)": ("63", "-", "55")}


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells (cmp, section, param, position, model, value) of comparisons, one per parameter and model."""
    p = table(spark, sf_dir, "part")
    i = F.pmod("p_partkey", F.lit(len(PARAMS))).cast("int")
    value = F.element_at(F.array(*(F.array(*map(F.lit, VALUES[x])) for x in PARAMS)), i + 1)
    raw = p.select((F.floor(F.col("p_partkey") / len(PARAMS)) % 12).alias("cmp"), F.when(i < 4, "基本").otherwise("配置").alias("section"), F.element_at(F.array(*map(F.lit, PARAMS)), i + 1).alias("param"), i.alias("position"), F.col("p_brand").alias("model"), "p_partkey", F.element_at(value, (F.col("p_size") % 3 + 1)).alias("value"))
    return raw.groupBy("cmp", "section", "param", "position", "model").agg(F.min(F.struct("p_partkey", "value"))["value"].alias("value"))


SQL_CELLS = f"""cells AS (SELECT p_partkey // 8 % 12 AS cmp, CASE WHEN p_partkey % 8 < 4 THEN '基本' ELSE '配置' END AS section, ([{', '.join(map(repr, PARAMS))}])[p_partkey % 8 + 1] AS param, CAST(p_partkey % 8 AS INTEGER) AS position, p_brand AS model,
  arg_min((([{', '.join('[' + ', '.join(map(repr, VALUES[x])) + ']' for x in PARAMS)}])[p_partkey % 8 + 1])[p_size % 3 + 1], p_partkey) AS value FROM part GROUP BY 1, 2, 3, 4, 5),
cl AS (SELECT *, CASE WHEN trim(coalesce(value, '')) IN ('-', '--', '无') THEN '' ELSE trim(coalesce(value, '')) END AS v FROM cells)"""
SQL_LABELS = SQL_CELLS + """, m AS (SELECT cmp, model, coalesce(arg_min(v, position) FILTER (regexp_matches(param, '能源类型|燃料形式')), '') AS e, coalesce(arg_min(v, position) FILTER (regexp_matches(param, '驱动方式')), '') AS d,
  coalesce(arg_min(v, position) FILTER (regexp_matches(param, '电池能量|电池容量')), '') AS b, coalesce(arg_min(v, position) FILTER (regexp_matches(param, '座位数')), '') AS s FROM cl GROUP BY 1, 2),
labels_ AS (SELECT cmp, model, CASE WHEN l = '' THEN '未分组' ELSE l END AS label FROM (SELECT cmp, model, CASE WHEN contains(e, '纯电') THEN '纯电' WHEN contains(e, '增程') THEN '增程' WHEN contains(e, '插电') THEN '插混' WHEN regexp_matches(e, '油电|混合|混动') THEN '混动' WHEN regexp_matches(e, '汽油|柴油|燃油') THEN '燃油' ELSE '' END
  || CASE WHEN contains(d, '四驱') THEN '四驱' WHEN d <> '' THEN '两驱' ELSE '' END || CASE WHEN b <> '' THEN regexp_replace(regexp_replace(printf('%.6f', CAST(regexp_extract(b, '[0-9]+(\\.[0-9]+)?') AS DOUBLE)), '0+$', ''), '\\.$', '') || '度电池' ELSE '' END
  || CASE WHEN s <> '' THEN regexp_extract(s, '[0-9]+') || '座' ELSE '' END AS l FROM m)),
lists AS (SELECT cmp, section, param, position, label, list(CASE WHEN v = '' THEN '-' ELSE v END ORDER BY model) AS l FROM cl JOIN labels_ USING (cmp, model) GROUP BY ALL),
dist AS (SELECT *, list_filter(l, lambda x, i: list_position(l, x) = i) AS u FROM lists),
sums AS (SELECT cmp, section, param, position, label, CASE WHEN len(u) = 1 THEN u[1] WHEN len(list_filter(u, lambda x: contains(x, '●') OR contains(x, '○'))) > 0 THEN '区分高低配'
  WHEN len(list_filter(u, lambda x: x <> '-' AND NOT regexp_matches(x, '^-?[0-9]+(\\.[0-9]+)?$'))) = 0 THEN array_to_string(list_transform(list_sort(list_transform(list_filter(u, lambda x: x <> '-'), lambda x: CAST(x AS DOUBLE))), lambda x: regexp_replace(regexp_replace(printf('%.6f', x), '0+$', ''), '\\.$', '')), '/') || CASE WHEN list_contains(u, '-') THEN '（部分无）' ELSE '' END
  WHEN length(array_to_string(u, '/')) <= 60 THEN array_to_string(u, '/') ELSE array_to_string(u[1:3], '/') || '…等' || len(u) || '种' END AS summary FROM dist)"""


def powertrain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.powertrain_labels(_cells(spark, sf_dir), ["cmp", "model"])


def _summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cells(spark, sf_dir)
    return matrix.group_summary(c.join(matrix.powertrain_labels(c, ["cmp", "model"]), ["cmp", "model"]), ["cmp", "section", "param", "position", "label"], "model")


def group_pivot_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _summaries(spark, sf_dir).select("cmp", "section", "param", "label", "summary")


def cell_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.cell_flags(_summaries(spark, sf_dir), ["cmp", "section", "param"]).select("cmp", "param", "label", "flag")


def unique_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    few = _cells(spark, sf_dir).where("model in ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4')")
    return matrix.unique_config(few, ["cmp", "section", "param"], "model")


def config_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.config_strength(_cells(spark, sf_dir), ["cmp", "model"])


def merge_compare_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cells(spark, sf_dir).where("cmp < 3 and model in ('Brand#1', 'Brand#2', 'Brand#3')").select(F.col("cmp").alias("dataset"), F.col("model").alias("spec"), "section", "param", "value")
    return matrix.merge_long(c)


def compare_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.wide(_cells(spark, sf_dir).where("cmp = 1"), ["section", "param"], "model", ["Brand#1", "Brand#2", "Brand#3"])


def review_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Template rows times products, filled from each product's field map, with a note of its source."""
    c = catalog(spark, sf_dir).where("category = 'PROMO'")
    fields = F.create_map(F.lit("model"), F.col("model_code"), F.lit("range"), F.col("range_km"), F.lit("energy"), F.col("energy_type"), F.lit("fuel"), F.col("fuel"))
    template = spark.createDataFrame([(i, n) for i, n in enumerate(("model", "range", "energy", "mass"))], "place int, field string")
    rows = c.select("id", F.explode(fields).alias("field", "value"))
    grid = c.select("id", "model_code").join(F.broadcast(template))
    filled = grid.join(rows, ["id", "field"], "left")
    return filled.select("id", "place", "field", text.placeholder_to_blank(F.col("value")).alias("raw"), F.coalesce(text.blank_to_null(F.col("value")), F.lit("-")).alias("value"), F.when(F.col("field") == "range", "catalogue").when(F.col("field") == "mass", "missing").otherwise("announcement").alias("source"))


S = "WITH " + SQL_SCORES
_ONE = SQL_SCORES + ", one AS (SELECT grp, series, own, max(score) AS score, min(price) AS price FROM scores GROUP BY ALL)"
_GAPS = "per AS (SELECT grp, dim, any_value(ordinal) AS ordinal, max(score) FILTER (own AND score > 0) AS mine, avg(score) FILTER (NOT own AND score > 0) AS others FROM scores GROUP BY 1, 2), gap AS (SELECT grp, dim, ordinal, mine - others AS gap FROM per WHERE mine IS NOT NULL AND others IS NOT NULL), ends AS (SELECT grp, first(dim ORDER BY gap DESC, ordinal, dim DESC) AS best_dim, max(gap) AS best_gap, first(dim ORDER BY gap, ordinal, dim) AS worst_dim, min(gap) AS worst_gap FROM gap GROUP BY 1)"
_LEX = " UNION ALL ".join(f"SELECT series, ordinal, text, '{c}' AS category FROM t WHERE regexp_matches(text, '{'|'.join(w)}')" for c, w in LEXICON.items())
_TEXTS = f"t AS (SELECT conv_id % 7 AS series, conv_id * 100 + turn AS ordinal, text FROM conversations WHERE role = 'user'), hit AS ({_LEX})"
_HEAD = SQL_SALES + ", head AS (SELECT series, s_nationkey, source, span, CAST(count AS BIGINT) AS count FROM sales WHERE count > 0 QUALIFY row_number() OVER (PARTITION BY series ORDER BY i) = 1)"
_MOVE = "CAST((CAST(year(d) AS BIGINT) * 12 + month(d) - 1 + {n}) // 12 AS VARCHAR) || '-' || lpad(CAST((CAST(year(d) AS BIGINT) * 12 + month(d) - 1 + {n}) % 12 + 1 AS VARCHAR), 2, '0')"
ORACLES = {
    "complaint_categories": f"WITH {_TEXTS}, r AS (SELECT *, row_number() OVER (PARTITION BY series, category ORDER BY ordinal) AS k FROM hit) SELECT series, category, count(*) AS n, string_agg(md5(text), ',' ORDER BY k) FILTER (k <= 2) AS samples FROM r GROUP BY 1, 2",
    "tag_cloud": "WITH t AS (SELECT user_id % 10 AS series, CASE WHEN event_type = 'error' THEN 2 ELSE 3 END AS sentiment, 't' || hour(ts) AS name, max(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS volume FROM events WHERE event_type <> 'click' AND hour(ts) <> 0 AND CAST(json_extract_string(props, '$.k') AS INTEGER) > 0 GROUP BY 1, 2, 3) SELECT *, round(volume * 1.0 / max(volume) OVER (PARTITION BY series, sentiment), 6) AS share FROM t",
    "quotes_topk": f"WITH {_TEXTS}, r AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY ordinal) AS place FROM t WHERE length(trim(text)) >= 20) SELECT series, place, ordinal FROM r WHERE place <= 3",
    "dim_gaps": f"{S}, {_GAPS} SELECT grp, best_dim, round(best_gap, 6) AS best_gap, worst_dim, round(worst_gap, 6) AS worst_gap FROM ends",
    "score_vs_mean": f"WITH {_ONE}, a AS (SELECT grp, max(score) FILTER (own AND score > 0) AS own_score, avg(score) FILTER (NOT own AND score > 0) AS mean, count(*) FILTER (NOT own AND score <= 0) AS excluded FROM one GROUP BY 1) SELECT grp, own_score, round(mean, 6) AS mean, round(own_score - mean, 6) AS diff, excluded FROM a WHERE own_score IS NOT NULL AND mean IS NOT NULL",
    "price_position": f"WITH {_ONE}, a AS (SELECT grp, max(price) FILTER (own) AS price, min(price) FILTER (NOT own) AS lo, max(price) FILTER (NOT own) AS hi, avg(price) FILTER (NOT own) AS mean FROM one WHERE series IN (6, 1, 2, 3) GROUP BY 1) SELECT grp, price, lo, hi, round(mean, 6) AS mean, CASE WHEN price <= lo THEN 'lowest' WHEN price >= hi THEN 'highest' ELSE 'middle' END AS position FROM a WHERE price IS NOT NULL AND lo IS NOT NULL",
    "headline_sales": f"WITH {_HEAD} SELECT series, source, span, count FROM head",
    "sales_rank": f"WITH {_HEAD} SELECT series, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY count DESC, series) AS place FROM head",
    "sales_matrix": f"WITH {SQL_SALES} SELECT series, CAST(max(count) FILTER (source = 'dongchedi' AND span = 'year') AS BIGINT) AS dongchedi_year, CAST(max(count) FILTER (source = 'dongchedi' AND span = 'latest') AS BIGINT) AS dongchedi_latest, CAST(max(count) FILTER (source = 'autohome' AND span = 'year') AS BIGINT) AS autohome_year FROM sales GROUP BY 1",
    "suggestions": f"WITH {_TEXTS}, {SQL_SCORES}, c AS (SELECT series AS grp, category, count(*) AS n FROM hit GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, category) AS p FROM c), b AS (SELECT grp, dim, max(score) FILTER (own) AS mine, max(score) FILTER (NOT own) AS best FROM scores WHERE series IN (6, 1, 2) GROUP BY 1, 2) SELECT grp, 'complaint' AS kind, category AS topic, CAST(n AS DOUBLE) AS weight FROM k WHERE p <= 4 UNION ALL SELECT CAST(grp AS BIGINT), 'dimension', dim, round(best - mine, 6) FROM b WHERE best - mine >= 0.15",
    "overview": f"""WITH {_ONE}, {_GAPS}, a AS (SELECT grp, max(score) FILTER (own AND score > 0) - avg(score) FILTER (NOT own AND score > 0) AS diff, max(price) FILTER (own) AS price, min(price) FILTER (NOT own) AS lo FROM one GROUP BY 1),
r AS (SELECT grp, series, row_number() OVER (PARTITION BY grp ORDER BY CAST(trunc(score * 100) AS BIGINT) DESC, series) AS place FROM one), j AS (SELECT a.grp, concat_ws(',', CASE WHEN place = 1 THEN 'sales' END, CASE WHEN diff >= 0 THEN 'score' END, CASE WHEN price <= lo THEN 'price' END) AS wins, CASE WHEN best_gap > 0.05 THEN best_dim END AS lead_, CASE WHEN worst_gap < -0.05 THEN worst_dim END AS lack
FROM a LEFT JOIN ends USING (grp) LEFT JOIN r ON r.grp = a.grp AND r.series = 6) SELECT grp, wins, concat_ws('; ', CASE WHEN wins <> '' OR lead_ IS NOT NULL THEN concat_ws('; ', CASE WHEN wins <> '' THEN 'ahead in ' || replace(wins, ',', ', ') END, 'best in ' || lead_) ELSE 'close to competitors' END, 'short in ' || lack) AS verdict FROM j""",
    "month_labels": f"WITH o AS (SELECT o_orderkey, o_orderdate AS d FROM orders) SELECT o_orderkey, CAST((CAST(year(d) AS BIGINT) * 12 + month(d) - 2) // 12 * 100 + (CAST(year(d) AS BIGINT) * 12 + month(d) - 2) % 12 + 1 AS INTEGER) AS previous, strftime(d, '%Y-%m') AS label, {_MOVE.format(n=-5)} || ' ~ ' || strftime(d, '%Y-%m') AS half_year, {_MOVE.format(n=-11)} || ' ~ ' || strftime(d, '%Y-%m') AS year FROM o",
    "sales_fuzzy_match": r"""WITH n AS (SELECT DISTINCT p_name || ' ' || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'X' || p_size END AS name FROM part), k AS (SELECT name, lower(regexp_replace(name, '\s+', '', 'g')) AS key, lower(regexp_extract(replace(name, ' ', ''), '[A-Za-z0-9]+$')) AS tok FROM n),
s AS (SELECT n_nationkey AS o, CASE WHEN n_nationkey % 2 = 0 THEN 'Red Widget' || n_nationkey WHEN n_nationkey < 6 THEN 'blue bolt' ELSE '品牌X' || (n_nationkey + 20) END AS series FROM nation), sn AS (SELECT *, lower(regexp_replace(series, '\s+', '', 'g')) AS norm FROM s),
e AS (SELECT name, 1 AS pass, arg_min(series, o) AS series FROM k JOIN sn ON key = norm GROUP BY 1), c AS (SELECT name, 2 AS pass, arg_min(series, o) AS series FROM k JOIN sn ON contains(norm, key) OR contains(key, norm) WHERE name NOT IN (SELECT name FROM e) GROUP BY 1),
t AS (SELECT name, 3 AS pass, min(series) AS series FROM k JOIN sn ON CASE WHEN regexp_matches(tok, '^[0-9]+$') THEN regexp_matches(norm, '(^|[^0-9])' || tok || '([^0-9]|$)') ELSE contains(norm, tok) END WHERE length(tok) >= 2 AND name NOT IN (SELECT name FROM e) AND name NOT IN (SELECT name FROM c) GROUP BY 1 HAVING count(*) = 1)
SELECT * FROM e UNION ALL SELECT * FROM c UNION ALL SELECT * FROM t""",
    "profile_fuzzy_match": r"""WITH n AS (SELECT DISTINCT p_name || '_' || p_size AS name FROM part), k AS (SELECT name, lower(regexp_replace(name, '[\s_-]+', '', 'g')) AS key FROM n), p AS (SELECT n_nationkey AS o, 'P' || n_nationkey AS profile, lower(regexp_replace((['Red-', 'small ring', 'BOLT', 'g_e', 'widget 1', 'red ring-4', 'gear'])[n_nationkey % 7 + 1], '[\s_-]+', '', 'g')) AS norm FROM nation),
e AS (SELECT name, true AS exact, arg_min(profile, o) AS profile FROM k JOIN p ON key = norm GROUP BY 1) SELECT * FROM e UNION ALL SELECT name, false, first(profile ORDER BY length(norm) DESC, o) FROM k JOIN p ON contains(norm, key) OR contains(key, norm) WHERE name NOT IN (SELECT name FROM e) GROUP BY 1""",
    "powertrain_labels": f"WITH {SQL_LABELS} SELECT cmp, model, label FROM labels_",
    "group_pivot_summary": f"WITH {SQL_LABELS} SELECT cmp, section, param, label, summary FROM sums",
    "cell_flags": f"WITH {SQL_LABELS}, f AS (SELECT *, count(*) OVER w AS n, sum(CASE WHEN contains(summary, '●') OR contains(summary, '○') THEN 1 ELSE 0 END) OVER w AS k, min(summary) OVER w AS lo, max(summary) OVER w AS hi FROM sums WINDOW w AS (PARTITION BY cmp, section, param)) SELECT cmp, param, label, CASE WHEN n > 1 AND contains(summary, '●') AND k = 1 THEN 'advantage' WHEN n > 1 AND summary <> '-' AND lo <> hi THEN 'difference' ELSE '' END AS flag FROM f",
    "unique_config": f"WITH {SQL_CELLS} SELECT cmp, section, param, max(model) FILTER (v <> '') AS model, max(value) FILTER (v <> '') AS value FROM cl WHERE model IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') GROUP BY 1, 2, 3 HAVING count(*) FILTER (v <> '') = 1 AND count(*) > 1",
    "config_strength": f"WITH {SQL_CELLS} SELECT cmp, model, count(*) FILTER (contains(value, '●')) AS standard, count(*) FILTER (contains(value, '○')) AS optional, count(*) FILTER (v = '') AS missing FROM cl GROUP BY 1, 2",
    "merge_compare_long": f"WITH {SQL_CELLS}, d AS (SELECT cmp AS dataset, model AS spec, section, param, value FROM cells WHERE cmp < 3 AND model IN ('Brand#1', 'Brand#2', 'Brand#3')), g AS (SELECT * FROM (SELECT DISTINCT dataset, spec FROM d), (SELECT DISTINCT section, param FROM d)) SELECT dataset, spec, section, param, coalesce(value, '-') AS value FROM g LEFT JOIN d USING (dataset, spec, section, param)",
    "compare_wide": f"WITH {SQL_CELLS} SELECT section, param, {', '.join(f'''coalesce(max(value) FILTER (model = 'Brand#{i}'), '-') AS "Brand#{i}"''' for i in (1, 2, 3))} FROM cells WHERE cmp = 1 GROUP BY 1, 2",
    "review_matrix": f"WITH {SQL_CATALOG}, t(place, field) AS (VALUES (0, 'model'), (1, 'range'), (2, 'energy'), (3, 'mass')), g AS (SELECT id, CAST(place AS INTEGER) AS place, field, CASE field WHEN 'model' THEN model_code WHEN 'range' THEN range_km WHEN 'energy' THEN energy_type END AS value FROM catalog, t WHERE category = 'PROMO') SELECT id, place, field, coalesce(value, '') AS raw, coalesce(nullif(value, ''), '-') AS value, CASE field WHEN 'range' THEN 'catalogue' WHEN 'mass' THEN 'missing' ELSE 'announcement' END AS source FROM g",
}
QUERIES = {name: globals()[name] for name in ORACLES}
