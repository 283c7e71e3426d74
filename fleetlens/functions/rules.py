"""Classification rules as column expressions; each is decided by its first condition that holds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import SPACES, first_filled, strip_brackets
from .values import digits_int

# Words of the scope rules.
NON_ROAD_ANYWHERE = "摩托|三轮|低速汽车|低速货车|自行车|电动两轮车|有轨电车|铁路机车|轨道车|列车|拖拉机|叉车|场地车|非道路"
NON_ROAD_TAIL = "挂车[)）]?$"
PART_ANYWHERE = "非完整车辆"
PART_TAIL = "(底盘|零部件|上装|车身|车厢|货箱|货厢|总成|装置)[)）]?$"
WHOLE_TAIL = "(车|汽车起重机|全地面起重机|修井机)$"
CATEGORY_ALIASES = {
    "乘用车": "乘用车",
    "插电式混合动力乘用车": "乘用车",
    "客车": "客车",
    "货车": "货车",
    "载货汽车": "货车",
    "专用车": "专用车",
    "专用汽车": "专用车",
}

# Energy classes, keywords by priority, fuel names.
ENERGY_KEYWORDS = (
    ("燃料电池", "燃料电池"),
    ("插电式增程", "增程式"),
    ("增程式", "增程式"),
    ("增程插电", "增程式"),
    ("插电式", "插电式混合动力"),
    ("插电", "插电式混合动力"),
    ("纯电动", "纯电动"),
    ("混合动力", "混合动力"),
)
FUELS = {"纯电动": "纯电动", "电": "纯电动", "氢气": "燃料电池", "燃料电池": "燃料电池"}
PLUG_IN = ("增程式", "插电式混合动力")
NEV = ("纯电动", "插电式混合动力", "增程式", "燃料电池")
COMBUSTION = ("燃油", "混合动力")
FIRST_NON_NEV_BATCH = 408

# Channels of categories and words.
CHANNELS = {"乘用车": "passenger", "客车": "bus", "货车": "truck", "专用车": "special"}

# Upper batches of the bands.
BANDS = ((173, 299), (300, 349), (350, 399), (400, 407))

IN_SCOPE = ("nev", "fuel_authorized", "unknown_authorized")
RANKS = {"done": 5, "partial": 4, "no_match": 3, "awaiting_effective": 3, "query_failed": 2, "interrupted": 2, "querying": 1}
FAILED_DOWNLOAD = "下载失败"


def category(c: Column) -> Column:
    """Official category of an alias, else null."""
    known = F.create_map(*(F.lit(x) for kv in CATEGORY_ALIASES.items() for x in kv))
    return F.try_element_at(known, F.trim(F.coalesce(c, F.lit(""))))


def scope(name: Column, category_: Column, tag: Column) -> Column:
    """Struct (gate, reason): accepted, excluded or pending_review."""
    full = F.regexp_replace(F.coalesce(name, F.lit("")), rf"{SPACES}+", "")
    base = strip_brackets(full)

    def verdict(gate: str, reason: str) -> Column:
        return F.struct(F.lit(gate).alias("gate"), F.lit(reason).alias("reason"))

    return (
        F.when(full.rlike(NON_ROAD_ANYWHERE) | base.rlike(NON_ROAD_TAIL), verdict("excluded", "non_automotive"))
        .when(full.rlike(PART_ANYWHERE) | base.rlike(PART_TAIL) | (F.upper(F.coalesce(tag, F.lit(""))) == "D"), verdict("excluded", "incomplete_vehicle_or_component"))
        .when(base.rlike(WHOLE_TAIL), verdict("accepted", "official_complete_vehicle_name"))
        .when(category(category_).isNotNull(), verdict("accepted", "official_catalog_category"))
        .otherwise(verdict("pending_review", "insufficient_scope_evidence"))
    )


def is_non_automotive(name: Column) -> Column:
    return (scope(name, F.lit(""), F.lit(""))["reason"] == "non_automotive")


def _keyword(text: Column, values: tuple[str, ...] | None = None) -> Column:
    """Class of the first keyword, by priority, that a text contains; only classes in ``values``."""
    found = F.lit(None).cast("string")
    for word, value in reversed(ENERGY_KEYWORDS):
        if values is None or value in values:
            found = F.when(F.contains(text, F.lit(word)), value).otherwise(found)
    return found


def energy(fuel: Column, name: Column, model: Column, catalog: Column) -> Column:
    """Struct (energy, source): one of seven classes and what it was told by."""
    fuel, catalog = (F.trim(F.coalesce(x, F.lit(""))) for x in (fuel, catalog))
    text = F.concat(F.coalesce(name, F.lit("")), F.lit(" "), F.coalesce(model, F.lit("")))
    exact = F.try_element_at(F.create_map(*(F.lit(x) for kv in FUELS.items() for x in kv)), fuel)
    plug, hinted, said = _keyword(text, PLUG_IN), _keyword(catalog, PLUG_IN), _keyword(text)
    hybrid = F.contains(fuel, F.lit("混合动力")) | F.contains(fuel, F.lit("双燃料"))

    def told(value: Column | str, source: str) -> Column:
        return F.struct((F.lit(value) if isinstance(value, str) else value).alias("energy"), F.lit(source).alias("source"))

    return (
        F.when(exact.isNotNull(), told(exact, "fuel_type"))
        .when(hybrid & plug.isNotNull(), told(plug, "fuel_type+product_name"))
        .when(hybrid & hinted.isNotNull(), told(hinted, "fuel_type+jianmian"))
        .when(hybrid, told("混合动力", "fuel_type"))
        .when((said == "混合动力") & hinted.isNotNull(), told(hinted, "product_name+jianmian"))
        .when(said.isNotNull(), told(said, "product_name"))
        .when(_keyword(catalog).isNotNull(), told(_keyword(catalog), "jianmian"))
        .when(catalog == "新能源", told("未知", "jianmian"))
        .when(fuel != "", told("燃油", "fuel_type"))
        .otherwise(told("未知", "none"))
    )


def energy_group(e: Column) -> Column:
    return F.when(e.isin(*NEV), "NEV").when(e.isin(*COMBUSTION), "fuel")


def non_nev_batch(batch: Column) -> Column:
    return F.coalesce(digits_int(batch) >= FIRST_NON_NEV_BATCH, F.lit(False))


def energy_scope(e: Column, batch: Column) -> Column:
    return (
        F.when(e.isin(*NEV), "nev").when(non_nev_batch(batch), "non_nev_batch").when(e.isin(*COMBUSTION), "outside").otherwise("needs_nev_evidence")
    )


def inventory_group(gate: Column, e: Column, batch: Column) -> Column:
    s = energy_scope(e, batch)
    return (
        F.when(gate == "excluded", "excluded")
        .when(gate == "pending_review", "scope_review")
        .when(s == "nev", "nev")
        .when((s == "non_nev_batch") & e.isin(*COMBUSTION), "fuel_authorized")
        .when(s == "non_nev_batch", "unknown_authorized")
        .when(s == "outside", "fuel_outside")
        .otherwise("unknown_energy_outside")
    )


def channel(model: Column, name: Column, category_: Column, hint: Column) -> Column:
    """Struct (channel, code); the code is the digit behind a model's leading capitals."""
    code = F.regexp_extract(F.trim(F.coalesce(model, F.lit(""))), "^[A-Z]+([0-9])", 1)
    name = F.coalesce(name, F.lit(""))
    of = F.create_map(*(F.lit(x) for kv in CHANNELS.items() for x in kv))
    direct, hinted = F.try_element_at(of, category(category_)), F.try_element_at(of, category(hint))
    found = (
        F.when(direct.isNotNull(), direct)
        .when(name.rlike("乘用车|轿车"), "passenger")
        .when(code == "5", "special")
        .when(name.rlike("客车"), "bus")
        .when(name.rlike("货车|载货汽车|自卸汽车|牵引车"), "truck")
        .when(code.isin("7", "2", "6"), "passenger")
        .when(code.isin("1", "3", "4"), "truck")
        .when((code == "") & hinted.isNotNull(), hinted)
        .otherwise("special")
    )
    return F.struct(found.alias("channel"), code.alias("code"))


def band(batch: Column) -> Column:
    b = digits_int(batch)
    out = F.when(b >= FIRST_NON_NEV_BATCH, f"{FIRST_NON_NEV_BATCH}+")
    for lo, hi in BANDS:
        out = out.when(b.between(lo, hi), f"{lo}-{hi}")
    return out.otherwise("other")


def document_state(is_pdf: Column, size: Column, path: Column, error: Column, found_size: Column, found_magic: Column, parse_error: Column, fields: Column) -> Column:
    """State of a stored document against the file that was found for it."""
    failed = F.coalesce(error, F.lit("")).startswith(FAILED_DOWNLOAD)
    sane = is_pdf.isin(0, 1) & (size >= 0)
    magic_ok = (found_magic == "%PDF") == (is_pdf == 1)
    return (
        F.when(is_pdf.isNull(), "no_document")
        .when(~F.coalesce(sane, F.lit(False)), "error")
        .when(failed | ((is_pdf == 0) & (size == 0)), "download_failed")
        .when((F.coalesce(path, F.lit("")) == "") | (size == 0) | found_size.isNull() | (found_size != size) | ~F.coalesce(magic_ok, F.lit(False)), "pdf_invalid")
        .when(is_pdf == 0, "non_pdf")
        .when((F.trim(F.coalesce(parse_error, F.lit(""))) != "") | (F.coalesce(F.size(fields), F.lit(0)) <= 0), "pdf_unparsed")
        .otherwise("parsed")
    )


def outcome_rank(status: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in RANKS.items() for x in kv)), status), F.lit(0))


def at_least(actual: Column, expected: Column) -> Column:
    """Batches compare as numbers where both are, else by equality."""
    a, e = digits_int(actual), digits_int(expected)
    return F.when(a.isNotNull() & e.isNotNull(), a >= e).otherwise(actual == expected)


def in_window(event: Column, today: Column, batch: Column, latest: Column, days: int = 60, batches: int = 2) -> Column:
    """Event of the last ``days`` days and ``batches`` batches; without a date the batch decides."""
    age = F.datediff(today, event)
    recent = (batch <= latest) & (batch > latest - batches)
    return recent & F.when(event.isNull(), True).otherwise(age.between(0, days))


def blocked_page(status: Column, url: Column, text: Column, strong: tuple[str, ...], weak: tuple[str, ...]) -> Column:
    """Access block: a strong word, two words, or a weak one with an odd status or a log-in address."""
    n = sum((F.contains(text, F.lit(w)).cast("int") for w in strong + weak), F.lit(0))
    s = sum((F.contains(text, F.lit(w)).cast("int") for w in strong), F.lit(0))
    return (s >= 1) | (n >= 2) | ((n >= 1) & ((status != 200) | url.rlike("(?i)login|passport|verify")))


def matches_prefixes(code: Column, include: list[str], exclude: list[str]) -> Column:
    """Code starts with one of ``include`` (any, if none is given) and with none of ``exclude``; case is ignored."""
    upper = F.upper(F.trim(F.coalesce(code, F.lit(""))))

    def any_of(prefixes: list[str]) -> Column:
        out = F.lit(False)
        for p in prefixes:
            out = out | upper.startswith(p.strip().upper())
        return out

    return (any_of(include) if include else F.lit(True)) & ~any_of(exclude)


def expands_to_all_trims(name: Column) -> Column:
    """A name that says nothing of a trim stands for the whole series."""
    return ~F.coalesce(name, F.lit("")).rlike(r"(?i)20\d\d|版|款|型|max|pro|plus|ultra|\d+\s*km")


def looks_like_price(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))).rlike(r"^\d+(?:\.\d+)?\s*(?:-\s*\d+(?:\.\d+)?\s*)?万$")


def looks_like_company(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))).rlike("(公司|集团|厂)$")


def looks_like_code(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit(""))).rlike(r"^[A-Z]{2,4}[0-9][0-9A-Z/()（）-]*$")


def looks_electric(code: Column) -> Column:
    return F.upper(F.coalesce(code, F.lit(""))).rlike(r"(BEV|PHEV|EV|FCEV|SHEV)[0-9A-Z]*$")


def product_id(cpid: Column, gid: Column) -> Column:
    return F.trim(first_filled(cpid, gid))
