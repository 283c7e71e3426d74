"""Competitor analytics: reviews, scores, sales and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Complaint categories and their words.
COMPLAINTS = {
    "车机/智能化": ["车机", "卡顿", "死机", "语音", "导航", "蓝牙", "OTA", "软件", "app", "APP", "地图", "智驾", "辅助驾驶", "泊车", "屏幕"],
    "续航/能耗": ["续航", "掉电", "油耗", "电耗", "充电", "亏电", "打折", "耗电"],
    "舒适性/NVH": ["异响", "噪音", "胎噪", "风噪", "颠", "悬挂", "悬架", "滤震", "座椅硬", "晕车", "隔音"],
    "空间/储物": ["空间", "后备箱", "腿部", "头部", "第三排", "储物", "拥挤"],
    "动力/操控": ["动力", "加速", "刹车", "转向", "操控", "顿挫", "肉", "推背"],
    "内饰做工": ["内饰", "做工", "塑料", "异味", "装配", "缝隙", "品控", "质感"],
    "外观细节": ["外观", "颜值", "造型", "车漆", "轮毂"],
    "价格/服务": ["价格", "降价", "保值", "优惠", "服务", "售后", "交付", "保险", "维修", "贵"],
}
# Words at which a summary turns from praise to criticism.
TURNS = ("但有部分用户反馈", "但有用户反馈", "但部分用户", "但也有用户")
# Sources and spans of sales by preference.
SALES_SOURCES = ("dongchedi", "autohome")
SALES_SPANS = ("year", "half_year", "latest")

GAP, LAG, TOP_COMPLAINTS = 0.05, 0.15, 4


def valid_score(c: Column) -> Column:
    """Scores of zero or less mean too few reviews."""
    return F.when(c > 0, c)


def complaint_categories(texts: DataFrame, group: list[str], text: str, ordinal: str, lexicon: dict[str, list[str]] = COMPLAINTS, samples: int = 2) -> DataFrame:
    """Texts per category (each counts once) with its first samples; ties by category name.

    Samples are the first texts by ordinal; the limit on the row number applies before the shuffle too, so few texts move.
    """
    hits = F.array_compact(F.array(*(F.when(F.col(text).rlike("|".join(words)), F.lit(c)) for c, words in lexicon.items())))
    long = texts.withColumn("category", F.explode(hits))
    counts = long.groupBy(*group, "category").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group, "category").orderBy(ordinal)
    first = long.withColumn("__n", F.row_number().over(w)).where(F.col("__n") <= samples)
    shown = first.groupBy(*group, "category").agg(F.array_sort(F.collect_list(F.struct("__n", F.col(text).alias("t")))).alias("s"))
    return counts.join(shown, [*group, "category"]).withColumn("samples", F.transform("s", lambda x: x["t"])).drop("s")


def tag_cloud(tags: DataFrame, group: list[str]) -> DataFrame:
    """Largest volume of each tag per sentiment (3 good, 2 bad) and its share of the group's largest.

    The tag for everything and tags without volume are none.
    """
    best = tags.where("name <> '' and name <> '全部' and volume > 0 and sentiment in (2, 3)").groupBy(*group, "sentiment", "name").agg(F.max("volume").alias("volume"))
    top = best.groupBy(*group, "sentiment").agg(F.max("volume").alias("top"))
    return best.join(top, [*group, "sentiment"]).withColumn("share", F.col("volume") / F.col("top")).drop("top")


def quotes(texts: DataFrame, group: list[str], text: str, ordinal: str, limit: int, least: int = 20) -> DataFrame:
    """First texts of at least ``least`` characters per group."""
    w = Window.partitionBy(*group).orderBy(ordinal)
    return texts.where(F.length(F.trim(text)) >= least).withColumn("place", F.row_number().over(w)).where(F.col("place") <= limit)


def headline_sales(sales: DataFrame, key: str = "series") -> DataFrame:
    """A series' sales from the first source and span, by preference, with any."""
    rank = F.array_position(F.array(*map(F.lit, SALES_SOURCES)), F.col("source")) * 10 + F.array_position(F.array(*map(F.lit, SALES_SPANS)), F.col("span"))
    best = F.min(F.struct(rank.alias("rank"), "source", "span", "count"))
    return sales.where("count > 0").groupBy(key).agg(best.alias("b")).select(key, "b.source", "b.span", "b.count")


def sales_ranks(headline: DataFrame, group: list[str], ordinal: str) -> DataFrame:
    """Places by sales within a comparison, and how many were ranked; equal sales keep their order."""
    w = Window.partitionBy(*group)
    return headline.withColumn("place", F.row_number().over(w.orderBy(F.col("count").desc(), F.col(ordinal)))).withColumn("ranked", F.count("*").over(w))


def score_vs_mean(scores: DataFrame, group: list[str]) -> DataFrame:
    """Own score against the mean of competitors with valid scores; those without are counted.

    scores (group, own flag, score).
    """
    v = valid_score(F.col("score"))
    agg = scores.groupBy(*group).agg(
        F.max(F.when(F.col("own"), v)).alias("own_score"), F.avg(F.when(~F.col("own"), v)).alias("mean"), F.count(F.when(~F.col("own") & v.isNull(), 1)).alias("excluded")
    )
    return agg.where("own_score is not null and mean is not null").withColumn("diff", F.col("own_score") - F.col("mean"))


def dim_gaps(dims: DataFrame, group: list[str]) -> DataFrame:
    """Per group the dimensions with the greatest and least gap to the competitors' mean.

    dims (group, own, dim, ordinal, score); the earlier dimension wins ties.
    """
    v = valid_score(F.col("score"))
    per = dims.groupBy(*group, "dim").agg(
        F.max(F.when(F.col("own"), v)).alias("mine"), F.min(F.when(F.col("own"), F.col("ordinal"))).alias("ordinal"), F.avg(F.when(~F.col("own"), v)).alias("others")
    ).where("mine is not null and others is not null").withColumn("gap", F.col("mine") - F.col("others"))
    ends = per.groupBy(*group).agg(
        F.max(F.struct("gap", (-F.col("ordinal")).alias("o"), "dim")).alias("hi"), F.min(F.struct("gap", "ordinal", "dim")).alias("lo")
    )
    return ends.select(*group, F.col("hi.dim").alias("best_dim"), F.col("hi.gap").alias("best_gap"), F.col("lo.dim").alias("worst_dim"), F.col("lo.gap").alias("worst_gap"))


def price_position(prices: DataFrame, group: list[str]) -> DataFrame:
    """Own price among competitors' prices: lowest, highest or middle."""
    agg = prices.groupBy(*group).agg(
        F.max(F.when(F.col("own"), F.col("price"))).alias("price"),
        *(f(F.when(~F.col("own"), F.col("price"))).alias(n) for f, n in ((F.min, "lo"), (F.max, "hi"), (F.avg, "mean"))),
    ).where("price is not null and lo is not null")
    return agg.withColumn("position", F.when(F.col("price") <= F.col("lo"), "lowest").when(F.col("price") >= F.col("hi"), "highest").otherwise("middle"))


def suggestions(complaints: DataFrame, dims: DataFrame, group: list[str]) -> DataFrame:
    """Most frequent complaint categories and dimensions that lag the best competitor; here scores of 0 count."""
    w = Window.partitionBy(*group).orderBy(F.col("n").desc(), F.col("category"))
    top = complaints.withColumn("__p", F.row_number().over(w)).where(F.col("__p") <= TOP_COMPLAINTS)
    first = top.select(*group, F.lit("complaint").alias("kind"), F.col("category").alias("topic"), F.col("n").cast("double").alias("weight"))
    best = dims.groupBy(*group, "dim").agg(F.max(F.when(F.col("own"), F.col("score"))).alias("mine"), F.max(F.when(~F.col("own"), F.col("score"))).alias("best"))
    lag = best.where(F.col("best") - F.col("mine") >= LAG).select(*group, F.lit("dimension").alias("kind"), F.col("dim").alias("topic"), (F.col("best") - F.col("mine")).alias("weight"))
    return first.unionByName(lag)


def overview(scores: DataFrame, gaps: DataFrame, prices: DataFrame, ranks: DataFrame, group: list[str]) -> DataFrame:
    """Findings of a comparison side by side, and its verdict in words; a place counts among two or more."""
    j = scores.join(gaps, group, "full").join(prices.select(*group, "position"), group, "full").join(ranks.select(*group, "place", "ranked"), group, "full")
    wins = F.array_compact(F.array(F.when((F.col("place") == 1) & (F.col("ranked") > 1), "sales"), F.when(F.col("diff") >= 0, "score"), F.when(F.col("position") == "lowest", "price")))
    lead = F.when(F.col("best_gap") > GAP, F.col("best_dim"))
    lack = F.when(F.col("worst_gap") < -GAP, F.col("worst_dim"))
    head = F.when((F.size(wins) > 0) | lead.isNotNull(), F.concat_ws("; ", F.when(F.size(wins) > 0, F.concat(F.lit("ahead in "), F.array_join(wins, ", "))), F.concat(F.lit("best in "), lead))).otherwise("close to competitors")
    return j.withColumn("wins", F.array_join(wins, ",")).withColumn("verdict", F.concat_ws("; ", head, F.concat(F.lit("short in "), lack)))
