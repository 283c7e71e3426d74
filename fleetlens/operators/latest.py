"""Latest, first and carried values per key. Orders are total wherever a result depends on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..functions.values import digits_int


def latest_batch_rows(rows: DataFrame, batch: str) -> DataFrame:
    """Rows of the highest numeric batch; all rows if no batch is a number.

    The maximum is one row: it joins as a broadcast, so rows aren't gathered for it.
    """
    top = rows.agg(F.max(digits_int(F.col(batch))).alias("__top"))
    return rows.join(F.broadcast(top)).where("__top is null").drop("__top").unionByName(
        rows.withColumn("__b", digits_int(F.col(batch))).join(F.broadcast(top), F.col("__b") == F.col("__top")).drop("__b", "__top")
    )


def latest_per_key(rows: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key in an order; sort-based, with a group limit before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def first_filled_per_key(rows: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """For each key and column the first value that isn't blank, in the order of ``order``.

    A minimum over (order, value) per column: it combines before the shuffle.
    """
    def first(c: str) -> Column:
        filled = F.when(blank_to_null(F.col(c)).isNotNull(), F.struct(*order, F.col(c)))
        return F.min(filled)[c].alias(c)

    return rows.groupBy(*keys).agg(*(first(c) for c in columns))


def specific_energy(rows: DataFrame, key: str, ordinal: str, energy: str, specific: Column) -> DataFrame:
    """First specific energy of a key, or its first energy at all."""
    e = blank_to_null(F.col(energy))
    best = F.min(F.when(e.isNotNull(), F.struct((~specific).alias("vague"), F.col(ordinal), F.col(energy))))
    return rows.groupBy(key).agg(best[energy].alias(energy))


def carry_forward(rows: DataFrame, group: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Blank cells take the value above them in their group, as merged cells mean it."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumns({c: F.last(blank_to_null(F.col(c)), ignorenulls=True).over(w) for c in columns})


def numbered_names(rows: DataFrame, group: list[str], name: str, order: list[str], out: str) -> DataFrame:
    """Repeated names of a group get ' (2)', ' (3)', ..."""
    n = F.row_number().over(Window.partitionBy(*group, name).orderBy(*order))
    return rows.withColumn(out, F.when(n == 1, F.col(name)).otherwise(F.concat(F.col(name), F.lit(" ("), n, F.lit(")"))))


def synthesised_sequence(rows: DataFrame, group: list[str], order: list[str], seq: str) -> DataFrame:
    """Blank sequence numbers become the row's place in its group."""
    n = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return rows.withColumn(seq, F.coalesce(blank_to_null(F.col(seq)), n.cast("string")))


def first_seen(rows: DataFrame, key: str, ordinal: str) -> DataFrame:
    """First row per key; rows without a key all stay."""
    named = rows.withColumn("__k", F.coalesce(blank_to_null(F.col(key)), F.concat(F.lit("\0"), F.col(ordinal).cast("string"))))
    return latest_per_key(named, ["__k"], [F.col(ordinal).asc()]).drop("__k")


def limited(rows: DataFrame, order: list[Column], offset: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """A page of rows, and one row (total, remaining)."""
    page = rows.orderBy(*order).offset(offset).limit(limit)
    count = rows.agg(F.count("*").alias("total")).withColumn("remaining", F.greatest(F.col("total") - offset - limit, F.lit(0)))
    return page, count
