"""Comparison matrices. Cells stay in long form (dataset, section, param, ordinal, value) until output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import plain_number

# Labels of energies and the words they are told by, in order.
ENERGY_LABELS = (("纯电", ("纯电",)), ("增程", ("增程",)), ("插混", ("插电",)), ("混动", ("油电", "混合", "混动")), ("燃油", ("汽油", "柴油", "燃油")))
# Words of the parameters that make a powertrain label.
PARAMETERS = {"energy": ("能源类型", "燃料形式"), "drive": ("驱动方式",), "battery": ("电池能量", "电池容量"), "seats": ("座位数",)}
MIXED, UNGROUPED = "区分高低配", "未分组"


def clean(value: Column) -> Column:
    """'' for a value that is missing or a dash."""
    t = F.trim(F.coalesce(value, F.lit("")))
    return F.when(t.isin("-", "--", "无"), "").otherwise(t)


def is_standard(value: Column) -> Column:
    return F.contains(F.coalesce(value, F.lit("")), F.lit("●"))


def is_optional(value: Column) -> Column:
    return F.contains(F.coalesce(value, F.lit("")), F.lit("○"))


def powertrain_labels(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Label of each model (keys) from the first rows about energy, drive, battery and seats.

    cells (keys, position of the row, param, value).
    """
    def first(words: tuple[str, ...]) -> Column:
        hit = F.col("param").rlike("|".join(words))
        return F.min(F.when(hit, F.struct("position", clean(F.col("value")).alias("v"))))["v"]

    m = cells.groupBy(*keys).agg(*(F.coalesce(first(w), F.lit("")).alias(n) for n, w in PARAMETERS.items()))
    energy = F.lit("")
    for label, words in reversed(ENERGY_LABELS):
        energy = F.when(F.col("energy").rlike("|".join(words)), label).otherwise(energy)
    drive = F.when(F.contains("drive", F.lit("四驱")), "四驱").when(F.col("drive") != "", "两驱").otherwise("")
    size, seats = F.regexp_extract("battery", r"\d+(?:\.\d+)?", 0), F.regexp_extract("seats", r"\d+", 0)
    battery = F.when(size != "", F.concat(plain_number(size.try_cast("double")), F.lit("度电池"))).otherwise("")
    label = F.concat(energy, drive, battery, F.when(seats != "", F.concat(seats, F.lit("座"))).otherwise(""))
    return m.select(*keys, F.when(label == "", UNGROUPED).otherwise(label).alias("label"))


def summarise(values: Column) -> Column:
    """One cell for the values (in order) of a group of models."""
    distinct = F.array_distinct(F.transform(values, lambda v: F.when(clean(v) == "", "-").otherwise(clean(v))))
    filled = F.filter(distinct, lambda v: v != "-")
    numeric = F.forall(filled, lambda v: v.rlike(r"^-?\d+(\.\d+)?$"))
    ordered = F.array_sort(F.transform(filled, lambda v: F.struct(v.try_cast("double").alias("n"), v.alias("v"))))
    numbers = F.array_join(F.transform(ordered, lambda x: plain_number(x["n"])), "/")
    joined = F.array_join(distinct, "/")
    return (
        F.when(F.size(distinct) == 1, F.get(distinct, 0))
        .when(F.exists(distinct, lambda v: is_standard(v) | is_optional(v)), MIXED)
        .when(numeric, F.when(F.array_contains(distinct, "-"), F.concat(numbers, F.lit("（部分无）"))).otherwise(numbers))
        .when(F.length(joined) <= 60, joined)
        .otherwise(F.concat(F.array_join(F.slice(distinct, 1, 3), "/"), F.lit("…等"), F.size(distinct), F.lit("种")))
    )


def group_summary(cells: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """Summary per keys (section, param, label, ...); a group is the models of one comparison."""
    return cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.coalesce("value", F.lit("")).alias("v")))).alias("__l")).select(
        *keys, summarise(F.transform("__l", lambda x: x["v"])).alias("summary")
    )


def cell_flags(summaries: DataFrame, row: list[str]) -> DataFrame:
    """Advantage (only this cell is standard or optional) and difference flags of cells in a row."""
    w = Window.partitionBy(*row)
    n = F.count("*").over(w)
    marked = F.sum((is_standard(F.col("summary")) | is_optional(F.col("summary"))).cast("int")).over(w)
    same = (F.min("summary").over(w) == F.max("summary").over(w))
    advantage = (n > 1) & is_standard(F.col("summary")) & (marked == 1)
    return summaries.withColumn("flag", F.when(advantage, "advantage").when((n > 1) & (F.col("summary") != "-") & ~same, "difference").otherwise(""))


def unique_config(cells: DataFrame, row: list[str], model: str) -> DataFrame:
    """Parameters that exactly one of several models has."""
    has = clean(F.col("value")) != ""
    agg = cells.groupBy(*row).agg(F.count_if(has).alias("n"), F.count("*").alias("m"), F.max(F.when(has, F.col(model))).alias(model), F.max(F.when(has, F.col("value"))).alias("value"))
    return agg.where("n = 1 and m > 1").drop("n", "m")


def config_strength(cells: DataFrame, keys: list[str]) -> DataFrame:
    v = F.col("value")
    return cells.groupBy(*keys).agg(F.count_if(is_standard(v)).alias("standard"), F.count_if(is_optional(v)).alias("optional"), F.count_if(clean(v) == "").alias("missing"))


def merge_long(datasets: DataFrame) -> DataFrame:
    """Datasets (dataset, spec, section, param, value) over the union of parameters; gaps become '-'."""
    rows = datasets.select("section", "param").distinct()
    specs = datasets.select("dataset", "spec").distinct()
    grid = specs.crossJoin(rows)  # the matrix itself: every spec has a cell for every parameter
    return grid.join(datasets, ["dataset", "spec", "section", "param"], "left").withColumn("value", F.coalesce("value", F.lit("-")))


def wide(cells: DataFrame, row: list[str], column: str, columns: list, value: str = "value") -> DataFrame:
    """Matrix with one column per entry of ``columns`` (given, so that no pass finds them)."""
    return cells.groupBy(*row).pivot(column, columns).agg(F.first(value)).na.fill("-")


def in_section_order(rows: DataFrame, sections: list[str]) -> DataFrame:
    """Preferred sections first, others behind by name, then parameters by name."""
    place = F.array_position(F.array(*map(F.lit, sections)), F.col("section"))
    return rows.orderBy(F.when(place == 0, len(sections) + 1).otherwise(place), "section", "param")
