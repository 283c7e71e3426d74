"""Captured pages of comparison sites: search responses, configuration JSON, script variables, markdown, reviews.

JSON is read by native expressions, a row of captures at a time and without a shuffle.
Markdown is scanned in Python, batch by batch: lines become letters, and patterns over the
letters find sections, rows and packages.

Cases: null, empty and malformed captures give no rows (markdown: one row of kind
'unparsed' with the reason, unless null); absent and null members count as ''.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import accumulate, chain, groupby, islice, repeat, takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.details import IGNORED, NOISE, is_ignored_parameter, is_noise_group, is_series, script_json, search_score
from ..functions.text import leading_percent, norm_space, once, split_review, strip_tags
from ..operators.compare import TURNS

_RULED = "class_name:string,ruleType:int"
_ENTITY = f"array<struct<id:string,entityName:string,{_RULED}>>"
SEARCH = f"simple_result struct<entityName:string,entity_result:array<struct<belong_to_brand:string>>,simple_intent:struct<subjects:array<struct<id:string,subject_s_name:string,{_RULED}>>>,queryintent:{_ENTITY}>, qp_result struct<term:{_ENTITY}>"
_PRICED = "array<struct<name:string,price:double>>"
_API_ITEM = f"struct<titleid:int,itemname:string,sublist:array<struct<name:string,value:string,priceinfo:string>>,colorinfo:struct<list:{_PRICED}>>"
API = f"result struct<bread:struct<seriesname:string>,titlelist:array<struct<itemtype:string,items:array<struct<titleid:int,itemname:string>>>>,datalist:array<struct<specid:string,specname:string,minprice:string,dealerprice:string,paramconflist:array<{_API_ITEM}>>>>"
_SUBLIST = "sublist:array<struct<subname:string,subvalue:string>>"
_VALUES = f"array<struct<specid:string,value:string,{_SUBLIST}>>"
CONFIG = f"result struct<paramtypeitems:array<struct<name:string,paramitems:array<struct<id:int,name:string,valueitems:{_VALUES}>>>>>"
OPTION = f"result struct<configtypeitems:array<struct<name:string,configitems:array<struct<name:string,valueitems:{_VALUES}>>>>>"
COLOURS = f"result struct<specitems:array<struct<specid:string,coloritems:{_PRICED}>>>"
BAGS = f"result struct<bagtypeitems:array<struct<name:string,bagitems:array<struct<specid:string,valueitems:array<struct<name:string,value:string,{_SUBLIST}>>>>>>>"

# Labels by parameter id where a page's own label is unreadable.
LABELS = {
    52: "厂商", 53: "级别", 8453: "上市时间", 1149: "能源类型", 8214: "WLTC纯电续航里程(km)", 8428: "CLTC纯电续航里程(km)", 9028: "电池快充时间(小时)",
    9029: "电池慢充时间(小时)", 9030: "电池快充电量范围(%)", 9031: "电池慢充电量范围(%)", 1185: "最大功率(kW)", 9167: "最大扭矩(N·m)",
}
# What stands for no value, and what says only that a part exists.
NO_VALUE = ("", "--", "暂无", "未公布")
PRESENT = ("", "-", "1")
#: Titles of the configuration API that repeat name and prices.
API_HEAD = (1, 2, 3)
# Sections of a comparison page.
SECTIONS = (
    "基本参数", "车身", "发动机", "电动机", "电池/充电", "变速箱", "底盘转向", "车轮制动", "被动安全", "主动安全", "驾驶操控", "驾驶硬件", "驾驶功能",
    "外观/防盗", "车外灯光", "天窗/玻璃", "外后视镜", "互联/智能化", "方向盘/内后视镜", "车内充电", "座椅配置", "音响/车内灯光", "空调/冰箱", "颜色", "选装包",
)


def cell_value(c: Column) -> Column:
    """Cell without price inquiries; '-' where it says nothing."""
    t = F.trim(F.replace(F.regexp_replace(norm_space(c), "起?询底价", ""), F.lit("获取底价"), F.lit("")))
    return once(t, lambda t: F.when(t.isin(*NO_VALUE), "-").otherwise(t))


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _joined(parts: Column, separator: str) -> Column:
    return F.array_join(F.filter(parts, lambda x: x != ""), separator)


def _each(items: Column, f: Callable) -> Column:
    return F.transform(F.filter(items, lambda x: x.isNotNull()), f)


def _dashed(c: Column) -> Column:
    return once(c, lambda c: F.when(F.coalesce(c, F.lit("")) == "", "-").otherwise(c))


def search_hits(responses: DataFrame, payload: str = "payload") -> DataFrame:
    """Series and brands of search responses, with all columns of ``responses``: rank (from 1), series_id, name, series.

    Of subjects, query intents and terms the first level with hits counts; a subject may
    list several ids. Of equal ids the first stays.
    """

    def hit(series_id: Column, name: Column, item: Column) -> Column:
        return F.struct(series_id.alias("series_id"), name.alias("name"), is_series(item["class_name"], item["ruleType"]).alias("series"))

    def listed(c: Column) -> Column:
        return F.filter(F.transform(F.split(norm_space(c), ","), lambda x: F.trim(x)), lambda x: x != "")

    def entities(items: Column, sound: Callable) -> Column:
        return F.filter(_each(items, lambda t: hit(_blank(t["id"]), norm_space(t["entityName"]), t)), lambda h: (h["series_id"] != "") & (h["series_id"] != "-1") & sound(h))

    r, s = F.col("__j"), F.col("__j.simple_result")
    subjects = F.flatten(_each(s["simple_intent"]["subjects"], lambda x: F.transform(listed(x["id"]), lambda i, n: hit(i, F.coalesce(F.get(listed(x["subject_s_name"]), n), F.lit("")), x))))
    intents = entities(s["queryintent"], lambda h: F.lit(True))
    terms = entities(r["qp_result"]["term"], lambda h: h["name"] != "")
    found = responses.withColumn("__j", F.from_json(payload, SEARCH)).withColumn("__h", F.when(F.size(subjects) > 0, subjects).when(F.size(intents) > 0, intents).otherwise(terms))
    first = F.filter("__h", lambda h, i: F.array_position(F.transform("__h", lambda x: x["series_id"]), h["series_id"]) == i + 1)
    brand = norm_space(F.get(s["entity_result"], F.lit(0))["belong_to_brand"])
    out = found.select(*responses.columns, brand.alias("brand"), F.posexplode(first).alias("rank", "__x"))
    return out.select(*responses.columns, "brand", (F.col("rank") + 1).alias("rank"), "__x.*")


def search_candidates(responses: DataFrame, wanted: str, payload: str = "payload") -> DataFrame:
    """Series hits with title (the query where a hit has no name) and score."""
    hits = search_hits(responses, payload).where("series")
    title = F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col(wanted))
    return hits.withColumn("title", title).withColumn("score", search_score(F.col(wanted), F.col("title"), F.col("rank"))).drop("series", "name")


def _coloured(items: Column) -> Column:
    def shown(c: Column) -> Column:
        def priced(name: Column) -> Column:
            return F.when(name == "-", "").when(c["price"] > 0, F.concat(name, F.lit("(+"), c["price"].cast("bigint"), F.lit(")"))).otherwise(name)

        return once(cell_value(strip_tags(c["name"])), priced)

    return _dashed(_joined(_each(items, shown), "\n"))


def _api_value(item: Column) -> Column:
    def part(s: Column) -> Column:
        def shown(c: Column) -> Column:
            head = F.when(c["name"] == "-", "").otherwise(c["name"])
            kept = F.when(c["value"].isin("-", "●"), head).when(head == "", c["value"]).otherwise(F.concat(head, F.lit(":"), c["value"]))
            return once(kept, lambda kept: F.when(c["price"].isin("-", "None"), kept).when(kept == "", c["price"]).otherwise(F.concat(kept, F.lit("("), c["price"], F.lit(")"))))

        return once(F.struct(*(cell_value(s[c]).alias(n) for c, n in (("name", "name"), ("value", "value"), ("priceinfo", "price")))), shown)

    def whole(c: Column) -> Column:
        return F.when(c["details"] == "", c["name"]).when(c["name"] == "-", c["details"]).otherwise(F.concat(c["name"], F.lit("\n"), c["details"]))

    details = F.coalesce(_joined(_each(item["sublist"], part), "\n"), F.lit(""))
    return once(F.struct(cell_value(item["itemname"]).alias("name"), details.alias("details")), whole)


def api_models(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Models of configuration API responses, with all columns of ``payloads``: place, spec, model and both prices."""
    specs = payloads.withColumn("__j", F.from_json(payload, API)).select(*payloads.columns, norm_space(F.col("__j.result.bread.seriesname")).alias("__s"), F.posexplode("__j.result.datalist").alias("place", "__d"))
    name = norm_space(F.col("__d.specname"))
    out = specs.select(*payloads.columns, "place", _blank(F.col("__d.specid")).alias("spec"), F.trim(F.concat("__s", F.lit(" "), name)).alias("model"), *(cell_value(F.col(f"__d.{c}")).alias(n) for c, n in (("minprice", "guide_price"), ("dealerprice", "dealer_price"))), name.alias("__n"))
    return out.where("spec <> '' and __n <> ''").drop("__n")


def api_params(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Long values of configuration API responses, with all columns of ``payloads``: kind, section, param, place, spec, value.

    Titles times specs; a title given twice keeps its first place and its last name, a
    spec's item given twice its last value. Kind is 'colour' in the section of colours;
    titles of names and prices are left out of the others.
    """
    j = payloads.withColumn("__j", F.from_json(payload, API))
    titles = F.flatten(_each(F.col("__j.result.titlelist"), lambda g: F.transform(g["items"], lambda i: F.struct(
        F.coalesce(F.nullif(norm_space(g["itemtype"]), F.lit("")), F.lit("未分类")).alias("section"), i["titleid"].alias("id"), norm_space(i["itemname"]).alias("param")))))
    sound = F.filter(titles, lambda t: (t["id"] >= 0) & ~is_noise_group(t["section"]) & ~is_ignored_parameter(t["param"]))
    j = j.withColumn("__t", sound)
    first = F.filter("__t", lambda t, i: F.array_position(F.transform("__t", lambda x: x["id"]), t["id"]) == i + 1)
    last = F.transform(first, lambda t: F.element_at(F.filter("__t", lambda x: x["id"] == t["id"]), -1))
    grid = j.select(*payloads.columns, F.col("__j.result.datalist").alias("__d"), F.explode(last).alias("__t")).select(*payloads.columns, "__t", F.posexplode("__d").alias("place", "__s"))
    item = F.try_element_at(F.filter(F.col("__s.paramconflist"), lambda x: x["titleid"] == F.col("__t.id")), F.lit(-1))
    colour = F.col("__t.section") == "颜色"
    out = grid.where((_blank(F.col("__s.specid")) != "") & (norm_space(F.col("__s.specname")) != "") & (colour | ~F.col("__t.id").isin(*API_HEAD)))
    value = once(item, lambda item: F.when(colour, _dashed(_coloured(item["colorinfo"]["list"]))).otherwise(_dashed(_api_value(item))))
    return out.select(*payloads.columns, F.when(colour, "colour").otherwise("param").alias("kind"), "__t.section", "__t.param", "place", _blank(F.col("__s.specid")).alias("spec"), value.alias("value"))


def _page_value(v: Column) -> Column:
    """Value with its sub-entries; those that only say 'present' show their name."""

    def part(s: Column) -> Column:
        def shown(c: Column) -> Column:
            return F.when(c["value"].isin(*PRESENT), c["name"]).when(c["name"] == "", c["value"]).otherwise(F.concat(c["name"], F.lit(":"), c["value"]))

        return once(F.struct(norm_space(strip_tags(s["subname"])).alias("name"), cell_value(strip_tags(s["subvalue"])).alias("value")), shown)

    base = once(cell_value(strip_tags(v["value"])), lambda base: F.when(base == "-", "").otherwise(base))
    subs = F.coalesce(_joined(_each(v["sublist"], part), " / "), F.lit(""))
    return _dashed(_joined(F.array(base, subs), "\n"))


def _page_models(j: Column) -> Column:
    items = F.flatten(_each(j["result"]["paramtypeitems"], lambda g: F.coalesce(g["paramitems"], F.array().cast(_ITEMS))))
    named = F.filter(items, lambda i: F.contains(norm_space(strip_tags(i["name"])), F.lit("车型")))
    models = F.filter(F.get(named, F.lit(0))["valueitems"], lambda v: _blank(v["specid"]) != "")
    return F.transform(models, lambda v, i: F.struct(i.cast("int").alias("place"), _blank(v["specid"]).alias("spec"), cell_value(strip_tags(v["value"])).alias("model")))


_ITEMS = f"array<struct<id:int,name:string,valueitems:{_VALUES}>>"


def page_params(pages: DataFrame, html: str = "html") -> DataFrame:
    """Long values of comparison pages, with all columns of ``pages``: kind, section, param, place, spec, model, value.

    The page's scripts hold them: parameters (kind 'param') and equipment ('option') of
    every model, colours outside and inside ('colour') and packages ('package', only of
    models that list them). A parameter without a readable label is named by its id, the
    first three of the basic section by their place. Pages without models give no rows.
    """
    keep = pages.columns
    names = {"__c": ("config", CONFIG), "__o": ("option", OPTION), "__x": ("color", COLOURS), "__i": ("innerColor", COLOURS), "__b": ("bag", BAGS)}
    j = pages.select(*keep, *(F.from_json(script_json(F.col(html), v), s).alias(a) for a, (v, s) in names.items()))
    j = j.withColumn("__m", _page_models(F.col("__c")))  # no filter on it: it would read the scripts once more
    row = "array<struct<kind:string,section:string,param:string,spec:string,value:string>>"

    def rows(kind: str, section: Column, param: Column, spec: Column, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), section.alias("section"), param.alias("param"), spec.alias("spec"), value.alias("value"))

    def titled(c: Column, otherwise: str) -> Column:
        return once(norm_space(strip_tags(c)), lambda t: F.when(t == "", otherwise).otherwise(t))

    known = F.create_map(*(F.lit(x) for kv in LABELS.items() for x in kv))

    def label(group: Column, item: Column, n: Column) -> Column:
        own = F.coalesce(F.try_element_at(known, item["id"]), norm_space(strip_tags(item["name"])))
        basic = (group == "基本参数") & (item["id"] == -1)
        return F.when(basic & (n == 0), "车型").when(basic & (n == 1), "厂商指导价").when(basic & (n == 2), "厂商").otherwise(own)

    def values_of(kind: str, group: Column, name: Column, items: Column) -> Column:
        # a value given twice for a spec: the last
        return F.transform(F.col("__m"), lambda m: rows(kind, group, name, m["spec"], F.coalesce(_page_value(F.try_element_at(F.filter(items, lambda v: _blank(v["specid"]) == m["spec"]), F.lit(-1))), F.lit("-"))))

    def of_groups(kind: str, groups: Column, member: str, otherwise: str, named: Callable) -> Column:
        def of_group(g: Column) -> Column:
            def of_item(group: Column, i: Column, name: Column) -> Column:
                wanted = ~is_ignored_parameter(name) & ~name.isin("车型", "厂商指导价", "经销商报价") if kind == "param" else ~is_ignored_parameter(name)
                return F.when(wanted, values_of(kind, group, name, i["valueitems"])).otherwise(F.array().cast(row))

            def of_items(group: Column) -> Column:
                items = F.transform(F.coalesce(g[member], F.array()), lambda i, n: once(named(group, i, n), lambda name: of_item(group, i, name)))
                return F.when(is_noise_group(group), F.array().cast(row)).otherwise(F.flatten(items))

            return once(titled(g["name"], otherwise), of_items)

        return F.flatten(_each(groups, of_group))

    def colours(c: str, category: str) -> Column:
        specs = F.filter(F.col(c)["result"]["specitems"], lambda s: _blank(s["specid"]) != "")
        own = lambda m: F.try_element_at(F.filter(specs, lambda s: _blank(s["specid"]) == m["spec"]), F.lit(-1))
        return F.transform("__m", lambda m: rows("colour", F.lit("颜色"), F.lit(category), m["spec"], F.coalesce(_coloured(own(m)["coloritems"]), F.lit("-"))))

    def packages(g: Column) -> Column:
        def of_spec(group: Column, b: Column) -> Column:
            spec = _blank(b["specid"])
            listed = F.transform(b["valueitems"], lambda v: rows("package", F.lit("选装包"), F.coalesce(F.nullif(norm_space(strip_tags(v["name"])), F.lit("")), group), spec, _page_value(v)))
            return F.when(F.size(b["valueitems"]) > 0, listed).otherwise(F.array(rows("package", F.lit("选装包"), group, spec, F.lit("-"))))

        return once(titled(g["name"], "选装包"), lambda group: F.flatten(_each(g["bagitems"], lambda b: of_spec(group, b))))

    every = [
        of_groups("param", F.col("__c.result.paramtypeitems"), "paramitems", "未分类", label),
        of_groups("option", F.col("__o.result.configtypeitems"), "configitems", "配置", lambda g, i, n: norm_space(strip_tags(i["name"]))),
        colours("__x", "外观颜色"), colours("__i", "内饰颜色"), F.flatten(_each(F.col("__b.result.bagtypeitems"), packages)),
    ]
    long = j.select(*keep, "__m", F.explode(F.concat(*(F.coalesce(e.cast(row), F.array().cast(row)) for e in every))).alias("__r"))
    model = F.get(F.filter("__m", lambda m: m["spec"] == F.col("__r.spec")), F.lit(0))
    return long.withColumn("__m", model).where("__m is not null").select(*keep, "__r.kind", "__r.section", "__r.param", "__m.place", "__r.spec", "__m.model", "__r.value")


def structured_reviews(reviews: DataFrame, blocks: str = "structuredlist") -> DataFrame:
    """Official summaries by category, with all columns of ``reviews`` but the JSON of blocks: place, category, percent, praise, blame.

    A block names its parts freely; those with a list count. Of a category the first
    summary that says something stays.
    """
    parts = F.flatten(_each(F.from_json(blocks, "array<map<string,string>>"), lambda b: F.map_values(b)))
    items = F.flatten(_each(F.transform(parts, lambda p: F.from_json(p, "list array<struct<category1Name:string,reviewContent:string>>")), lambda p: F.coalesce(p["list"], F.array().cast("array<struct<category1Name:string,reviewContent:string>>"))))
    sound = F.filter(F.transform(items, lambda i: F.struct(_blank(i["category1Name"]).alias("category"), _blank(i["reviewContent"]).alias("text"))), lambda i: i["text"] != "")
    keep = [c for c in reviews.columns if c != blocks]
    r = reviews.select(*keep, sound.alias("__i"))
    first = F.filter("__i", lambda x, n: F.array_position(F.transform("__i", lambda y: y["category"]), x["category"]) == n + 1)
    long = r.select(*keep, F.posexplode(first).alias("place", "__x")).withColumn("__s", split_review(F.col("__x.text"), TURNS))
    return long.select(*keep, "place", "__x.category", leading_percent(F.col("__s.praise")).alias("percent"), "__s.praise", "__s.blame")


NBSP = "\u00a0"
_LINK = re.compile(r"\[([^\]]+)\]\(([^)]+)\)")
_SPEC = re.compile(r"/spec/(\d+)/|spec-(\d+)-")
_COUNT = re.compile(r"共\s*\d+\s*款车型")


def _plain(line: str) -> str:
    text = _LINK.sub(r"\1", line).replace("__", " ")
    for word in NOISE:
        text = text.replace(word, "")
    return " ".join(text.split())


def _shown(line: str) -> str:
    text = _plain(line)
    return "-" if text in NO_VALUE else text


def _spec(line: str) -> str | None:
    found = _SPEC.search(line)
    return found and (found[1] or found[2])


def shares(owner: list[int | None], models: int) -> list[tuple[int, int, int]]:
    """Ranges (model, start, end) of a run of cells that lists all models one after the other.

    owner: the model a cell links to, if any. Cells belong to the model linked last; the
    unlinked models up to the next linked one get equal parts of the end of its cells: as
    near to an even division as whole cells are, at least one each, and none of the cells
    that begin with its own links. Without links the cells are divided evenly.
    """
    held = list(accumulate(owner, lambda last, own: last if own is None else own))
    runs = [(m, len(list(cells))) for m, cells in groupby(held)]
    if not any(m is not None for m, _ in runs):
        if not models or len(owner) % models:
            raise ValueError("colours can't be divided among the models")
        runs = [(m, len(owner) // models) for m in range(models)]
    out, at = [], 0
    if runs[:1] and runs[0][0] is None:
        at = runs.pop(0)[1]
        out.append((runs[0][0], 0, at))
    for (m, size), (following, _) in zip(runs, [*runs[1:], (models, 0)]):
        end, others = at + size, following - m - 1
        if others > 0:
            room = (size - sum(1 for _ in takewhile(lambda own: own == m, owner[at:end]))) // others
            if room < 1:
                raise ValueError("bounds between models can't be told")
            each = min(room, max(1, (2 * size + others + 1) // (2 * (others + 1))))
            edges = [at, *range(end - others * each, end + 1, each)]
            out += [(m + k, lo, hi) for k, (lo, hi) in enumerate(zip(edges, edges[1:]))]
        elif others == 0:
            out.append((m, at, end))
        at = end
    return out


#: Lines that structure a page, by their whole text; and a letter for each.
_MARKS = {"经销商报价": "D", "基本参数": "B", "颜色": "C", "选装包": "P", "外观颜色": "O", "内饰颜色": "I"}


class _Scan:
    """Lines of a page with two strings of a letter a line: its mark, and its role as a cell.

    Roles: E empty, S heading of a section, + continues the cell before it. Patterns over
    these strings cut the page.
    """

    def __init__(self, text: str):
        self.lines = text.splitlines()
        self.plain = [_plain(line) for line in self.lines]
        raw = [line.replace(NBSP, " ").strip() for line in self.lines]
        self.marks = "".join(
            _MARKS.get(t) or ("N" if _COUNT.search(t) else "G" if "厂商指导价" in t else "F" if "关于我们" in t else ".") for t in self.plain
        )
        opens = [r.startswith("[") and "](" in r and "/spec/" not in r for r in [*raw[1:], ""]]
        self.roles = "".join(
            "E" if not t else "S" if t in SECTIONS and after else "+" if r.startswith("__") or t.startswith(("选配", "标配")) else "." for t, r, after in zip(self.plain, raw, opens)
        )

    def place(self, mark: str, start: int = 0) -> int:
        at = self.marks.find(mark, start)
        if at < 0:
            raise ValueError(f"no line of kind {mark}")
        return at

    def filled(self, start: int, stop: int) -> list[int]:
        return [i for i in range(start, stop) if self.plain[i]]

    def shown(self, places: Iterable[int]) -> list[str]:
        return [_shown(self.lines[i]) for i in places]


def _models(scan: _Scan) -> list[tuple[str, str, str]]:
    """Models of a page: spec, name, and the name numbered where it was there before."""
    start = scan.place("N")
    links = (_LINK.search(line) for line in scan.lines[start : scan.place("G", start)])
    found = [(spec, " ".join(link[1].split())) for link in links if link and (spec := _spec(link[2]))]
    if not found:
        raise ValueError("no models")
    names = [name for _, name in found]
    return [(spec, name, name if (n := names[:k].count(name)) == 0 else f"{name} ({n + 1})") for k, (spec, name) in enumerate(found)]


def _prices(scan: _Scan, n: int) -> Iterator[tuple[str, str, list[str]]]:
    guide = scan.place("G")
    dealer = scan.place("D", guide + 1)
    for param, lo, hi in (("厂商指导价", guide, dealer), ("经销商报价", dealer, scan.place("B", dealer))):
        yield "", param, [*islice(chain((v for v in scan.shown(range(lo + 1, hi)) if v != "-"), repeat("-")), n)]


def _parameters(scan: _Scan, n: int, start: int, stop: int) -> Iterator[tuple[str, str, list[str]]]:
    """Headings of sections, and parameters with a cell for each of ``n`` models, which may reach beyond ``stop``."""
    section = "基本参数"
    for m in re.compile(f"E|(?P<section>S)|(?P<row>.).{{{n}}}|(?P<end>.)").finditer(scan.roles, start):
        if m.start() >= stop or m["end"]:
            return
        if m["section"]:
            section = scan.plain[m.start()]
        elif m["row"] and not any(word in scan.plain[m.start()] for word in IGNORED):
            yield section, scan.plain[m.start()], scan.shown(range(m.start() + 1, m.end()))


def _colours(scan: _Scan, models: list[tuple[str, str, str]], start: int) -> Iterator[tuple[str, str, list[str]]]:
    place = {spec: i for i, (spec, _, _) in enumerate(models)}
    block = re.compile("[^P]*").match(scan.marks, start)
    for m in re.compile("([OI])([^OI]*)").finditer(scan.marks, start, block.end()):
        cells = scan.filled(*m.span(2))
        own: list[list[str]] = [[] for _ in models]
        for model, lo, hi in shares([place.get(_spec(scan.lines[i])) for i in cells], len(models)):
            own[model] += [v for v in scan.shown(cells[lo:hi]) if v and v not in models[model][1:]]
        yield "颜色", scan.plain[m.start()], ["\n".join(v) or "-" for v in own]


def _packages(scan: _Scan, n: int, start: int) -> Iterator[tuple[str, str, list[str]]]:
    """A title and an entry for each model; an entry takes the lines that continue it, as long as one is left for each model after."""
    cells = scan.filled(start + 2, scan.place("F", start))
    roles, at = "".join(scan.roles[i] for i in cells), 0
    whole = re.compile("." + "(.\\+*)" * n)
    while at < len(cells):
        if m := whole.match(roles, at):
            spans, end = [m.span(k) for k in range(1, n + 1)], m.end()
        else:  # the page ends within the entries
            spans, end = [(k, k + 1) for k in range(at + 1, len(cells))], len(cells)
        entries = ["\n".join(scan.plain[i] for i in cells[lo:hi]) for lo, hi in spans]
        yield "选装包", scan.plain[cells[at]], [*entries, *["-"] * (n - len(entries))]
        at = end


def markdown_capture(text: str) -> Iterator[tuple[str, str, str, int, str, str, str]]:
    """Rows (kind, section, param, place, spec, model, value) of a page captured as markdown; ValueError if it is none."""
    scan = _Scan(text)
    models = _models(scan)
    n, basic = len(models), scan.place("B", scan.place("D", scan.place("G") + 1))
    colour, package = (scan.marks.find(mark, basic) for mark in "CP")
    parts: list[tuple[str, Iterable[tuple[str, str, list[str]]]]] = [("price", _prices(scan, n))]
    parts.append(("param", _parameters(scan, n, basic + 1, next((at for at in (colour, package) if at >= 0), len(scan.lines)))))
    if colour >= 0:
        parts.append(("colour", _colours(scan, models, colour)))
    if package >= 0:
        parts.append(("package", _packages(scan, n, package)))
    for kind, rows in parts:
        for section, param, values in rows:
            for i, value in enumerate(values):
                yield kind, section, param, i, models[i][0], models[i][2], value


def markdown_params(captures: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Long values of markdown captures: key, kind, section, param, place, spec, model, value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t is None:
                    continue
                try:
                    out += [(k, *r) for r in markdown_capture(t)]
                except ValueError as why:
                    out.append((k, "unparsed", "", "", 0, "", "", str(why)))
            columns = list(zip(*out)) or [()] * 8
            kinds = [batch.schema.field(0).type, *[pa.string()] * 3, pa.int32(), *[pa.string()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], [key, "kind", "section", "param", "place", "spec", "model", "value"])

    kind = captures.schema[key].dataType.simpleString()
    return captures.select(key, text).mapInArrow(run, f"`{key}` {kind}, kind string, section string, param string, place int, spec string, model string, value string")
