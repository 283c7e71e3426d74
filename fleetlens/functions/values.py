"""Numbers, dates, arrays, maps and JSON as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_int(c: Column) -> Column:
    """Integer a text starts with; 0 without one, null for null."""
    digits = F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1)
    return F.when(c.isNotNull(), F.coalesce(F.nullif(digits, F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint")))


def digits_int(c: Column) -> Column:
    """Integer of a text that is nothing but ASCII digits, else null."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("bigint"))


def parse_date(c: Column) -> Column:
    """Date in one of four forms: 2024-01-31, 20240131, 2024/01/31, 2024年1月31日; null otherwise."""
    t = F.trim(c)
    return F.coalesce(
        F.try_to_date(F.substring(t, 1, 10), "yyyy-MM-dd"),
        F.when(F.substring(t, 1, 8).rlike("^[0-9]{8}$"), F.try_to_date(F.substring(t, 1, 8), "yyyyMMdd")),
        F.try_to_date(F.substring(t, 1, 10), "yyyy/MM/dd"),
        F.try_to_date(F.regexp_extract(t, r"^[0-9]{4}年[0-9]{1,2}月[0-9]{1,2}日", 0), "yyyy年M月d日"),
    )


def shift_month(yyyymm: Column, by: int) -> Column:
    """Month as an integer yyyymm, ``by`` months later."""
    n = F.floor(yyyymm / 100) * 12 + yyyymm % 100 - 1 + by
    return (F.floor(n / 12) * 100 + F.pmod(n, F.lit(12)) + 1).cast("int")


def month_label(yyyymm: Column) -> Column:
    return F.concat(F.floor(yyyymm / 100).cast("string"), F.lit("-"), F.lpad((yyyymm % 100).cast("string"), 2, "0"))


def month_range_label(last: Column, months: int) -> Column:
    return F.concat(month_label(shift_month(last, 1 - months)), F.lit(" ~ "), month_label(last))


#: Chinese digits and units.
CHINESE_DIGITS = {"零": 0, "〇": 0, "一": 1, "二": 2, "两": 2, "三": 3, "四": 4, "五": 5, "六": 6, "七": 7, "八": 8, "九": 9}
CHINESE_UNITS = {"十": 10, "百": 100}


def chinese_int(c: Column) -> Column:
    """Chinese or Arabic number below a thousand; null for anything else.

    A fold over the characters keeps the sum so far and the digit that waits for its unit.
    """
    t = F.trim(c)
    digit = F.create_map(*(F.lit(x) for kv in CHINESE_DIGITS.items() for x in kv))
    unit = F.create_map(*(F.lit(x) for kv in CHINESE_UNITS.items() for x in kv))
    start = F.struct(F.lit(0).alias("sum"), F.lit(-1).alias("held"))

    def step(a: Column, x: Column) -> Column:
        u, d = F.try_element_at(unit, x), F.try_element_at(digit, x)
        return F.when(u.isNotNull(), F.struct((a["sum"] + F.when(a["held"] < 0, 1).otherwise(a["held"]) * u).alias("sum"), F.lit(-1).alias("held"))).otherwise(
            F.struct(a["sum"].alias("sum"), F.coalesce(d, F.lit(0)).alias("held"))
        )

    folded = F.aggregate(F.filter(F.split(t, ""), lambda x: x != ""), start, step, lambda a: a["sum"] + F.greatest(a["held"], F.lit(0)))
    letters = "".join(CHINESE_DIGITS) + "".join(CHINESE_UNITS)
    return F.when(t.rlike("^[0-9]+$"), t.try_cast("int")).when(t.rlike(f"^[{letters}]+$"), folded)


def plain_number(c: Column) -> Column:
    """Number as text without trailing zeros."""
    t = F.regexp_replace(F.format_string("%.6f", c.cast("double")), "0+$", "")
    return F.regexp_replace(t, r"\.$", "")


def percent_text(part: Column, whole: Column) -> Column:
    return F.format_string("%.1f%%", F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0)))


def duration_text(start: Column, stop: Column) -> Column:
    """Hours, minutes and seconds between two timestamps."""
    s = F.unix_timestamp(stop) - F.unix_timestamp(start)
    return F.format_string("%dh %02dm %02ds", F.floor(s / 3600), F.floor(s / 60) % 60, s % 60)


def page_count(total: Column, size: int) -> Column:
    return F.ceil(total / F.lit(size)).cast("bigint")


def batch_list(c: Column) -> Column:
    """'409', '405-409' or '405,407' as ascending distinct numbers."""
    parts = F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,，]"), lambda v: F.trim(v)), lambda x: x != "")

    def span(x: Column) -> Column:
        ends = F.transform(F.split(x, "-"), lambda y: F.trim(y).cast("int"))
        return F.sequence(F.get(ends, 0), F.get(ends, F.size(ends) - 1))

    return F.array_sort(F.array_distinct(F.flatten(F.transform(parts, span))))


def merge_fields(old: Column, new: Column, owned: list[str]) -> Column:
    """Map where keys in ``owned`` come from ``new`` only and others stay."""
    kept = F.map_filter(old, lambda k, _: ~k.isin(*owned))
    return F.map_concat(kept, F.map_filter(new, lambda k, _: k.isin(*owned)))


def fill_blank(old: Column, other: Column) -> Column:
    """Map of both; blank or missing values of ``old`` are taken from ``other``."""
    return F.map_zip_with(old, other, lambda _, a, b: F.coalesce(F.nullif(a, F.lit("")), b, a))


def overwrite(old: Column, other: Column) -> Column:
    """Map of both; non-blank values of ``other`` win."""
    return F.map_zip_with(old, other, lambda _, a, b: F.coalesce(F.nullif(b, F.lit("")), a, b))


def set_default(old: Column, other: Column) -> Column:
    """Map of both; keys of ``old`` keep even blank values."""
    return F.map_concat(F.map_filter(other, lambda k, _: ~F.map_contains_key(old, k)), old)


def changed_keys(a: Column, b: Column) -> Column:
    """Keys, sorted, whose values differ or that only one map has."""
    keys = F.array_union(F.map_keys(a), F.map_keys(b))
    return F.array_sort(F.filter(keys, lambda k: ~F.try_element_at(a, k).eqNullSafe(F.try_element_at(b, k))))


def by_alias(pairs: Column, aliases: list[str]) -> Column:
    """Value of the first label that contains an alias; earlier aliases first, then map order."""

    def first(alias: str) -> Column:
        return F.get(F.map_values(F.map_filter(pairs, lambda k, _: F.contains(k, F.lit(alias)))), 0)

    return F.coalesce(*(first(a) for a in aliases))


def literal_json(c: Column) -> Column:
    """Python literal text as JSON text (None, True and False outside of quotes)."""
    for a, b in (("None", "null"), ("True", "true"), ("False", "false")):
        c = F.regexp_replace(c, rf"(?<=[:\[,]\s?){a}(?=\s*[,\]}}])", b)
    return c


def zip_ids(ids: Column, names: Column) -> Column:
    """Two comma lists as structs (id, name); names may be fewer."""
    i, n = (F.transform(F.split(F.coalesce(x, F.lit("")), ","), lambda v: F.trim(v)) for x in (ids, names))
    return F.filter(F.transform(i, lambda x, k: F.struct(x.alias("id"), F.coalesce(F.get(n, k), F.lit("")).alias("name"))), lambda s: s["id"] != "")


def dims_text(*parts: Column) -> Column:
    """Dimensions joined by '×' when there is any; missing ones stay empty."""
    filled = [F.coalesce(p, F.lit("")) for p in parts]
    return F.when(F.concat(*filled) != "", F.concat_ws("×", *filled)).otherwise("")
