"""Pages of vehicles of no known form: labels and values, and a summary of 32 fields.

A page's HTML is read as a tree in Arrow batches: rows of tables with two cells, then
list items, paragraphs and inline parts with a colon, are label and value. Everything
after that is native: fields are taken from labels by aliases, else from the text by
patterns, then from title and breadcrumb, and numbers are cut out.

Series pages carry a configuration object instead; the model that fits the wanted name
best is chosen, and its column of the configuration gives the labels.

Cases: null pages count as empty; pages without labels give blank fields, only the name
asked for and what the title says; a series page without models has ``spec`` null.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice, takewhile
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.details import script_json, spec_score
from ..functions.text import compare_value, first_number, norm_space, strip_tags, three_measures
from ..functions.values import by_alias
from .captures import CONFIG, LABELS

# Aliases of the fields' labels, earlier ones first.
ALIASES = {
    "brand": ("品牌",), "series_name": ("车系", "返回"), "model_name": ("车型名称", "车型"), "energy_type": ("能源类型", "能 源", "能源"), "market_date": ("上市时间", "上市日期"),
    "official_price": ("厂商指导价", "官方指导价", "指导价", "价格"), "sales_volume": ("销量", "月销量"), "engine": ("发动机",), "displacement": ("排量", "发动机排量"), "intake_type": ("进气形式",),
    "max_power_kw": ("最大功率", "发动机最大功率", "总功率"), "max_torque_nm": ("最大扭矩", "发动机最大扭矩", "总扭矩"), "horsepower": ("马力", "最大马力"),
    "motor_power_kw": ("电动机总功率", "电动机最大功率", "电机总功率"), "motor_torque_nm": ("电动机总扭矩", "电动机最大扭矩", "电机总扭矩"), "gearbox": ("变速箱",), "drive_type": ("驱动方式", "驱动形式"),
    "battery_type": ("电池类型",), "battery_capacity_kwh": ("电池容量", "电池能量"), "cltc_range_km": ("CLTC纯电续航里程", "CLTC续航里程"), "wltc_range_km": ("WLTC纯电续航里程", "WLTC续航里程"),
    "fast_charge_time": ("快充时间", "快充"), "slow_charge_time": ("慢充时间", "慢充"), "length_mm": (), "width_mm": (), "height_mm": (), "wheelbase_mm": ("轴距",), "seats": ("座位数", "座椅数"), "doors": ("车门数",),
    "curb_weight_kg": ("整备质量",), "trunk_volume_l": ("行李厢容积", "后备厢容积", "行李箱容积"),
}
# Patterns of fields in a page's text, which is one line.
PATTERNS = {
    "brand": ("价格单_([^_]+?)_汽车之家",), "series_name": (r"返回\s*([^\n\r]+)",), "model_name": (r"当前位置：.*?>\s*(\d{4}款[^>\n\r]+?)\s*>参数配置", r"(\d{4}款[^\n\r]+?)(?:参数配置|价格单)"),
    "market_date": (r"上市时间[:：]?\s*([0-9]{4}[.\-/年][0-9]{1,2})",), "official_price": (r"(?:厂商指导价|官方指导价|指导价)[:：]?\s*([0-9.\-~至万元]+)",), "sales_volume": (r"(?:月销量|销量)\s*([0-9,]+辆)",),
    "engine": (r"发动机[:：]?\s*([^\n\r]{1,80})",), "gearbox": (r"变速箱[:：]?\s*([^\n\r]{1,80})",), "drive_type": (r"驱动方式[:：]?\s*([^\n\r]{1,40})",), "seats": (r"座位数[:：]?\s*(\d+座)",),
    "energy_type": (r"(?:能源类型|能\s*源)[:：]?\s*([^\n\r]{1,80})",), "battery_capacity_kwh": (r"(?i)(?:电池容量|电池能量)[:：]?\s*([0-9.]+)\s*kWh",), "cltc_range_km": (r"(?i)CLTC(?:纯电)?续航里程[:：]?\s*([0-9.]+)\s*km",),
    "wltc_range_km": (r"(?i)WLTC(?:纯电)?续航里程[:：]?\s*([0-9.]+)\s*km",), "fast_charge_time": (r"快充(?:时间)?[:：]?\s*([0-9.]+小时)",), "slow_charge_time": (r"慢充(?:时间)?[:：]?\s*([0-9.]+小时)",),
    "wheelbase_mm": (r"(?i)轴距[:：]?\s*([0-9.]+)\s*mm",), "curb_weight_kg": (r"(?i)整备质量[:：]?\s*([0-9.]+)\s*kg",), "trunk_volume_l": (r"(?i)(?:行李厢容积|后备厢容积|行李箱容积)[:：]?\s*([0-9.]+)\s*L",),
}
# More labels by parameter id, labels that stand in for a field, and texts for no value.
MORE_LABELS = {
    9030: "电池快充电量范围(%)", 9031: "电池慢充电量范围(%)", 1147: "车身结构", 1150: "发动机", 1148: "长*宽*高(mm)", 1171: "整备质量(kg)", 1255: "整车质保", 5886: "长度(mm)", 5887: "宽度(mm)", 5888: "高度(mm)",
    1169: "轴距(mm)", 1170: "前轮距(mm)", 9004: "后轮距(mm)", 1172: "车门数(个)", 1173: "座位数(个)", 1175: "后备厢容积(L)", 8444: "车门开启方式", 8445: "最大满载质量(kg)", 8446: "电能当量燃料消耗量(L/100km)",
    8447: "官方首任车主权益", 9148: "官方100-0km/h制动(m)", 1182: "排量(mL)", 9124: "排量(L)", 1183: "进气形式", 1294: "最大马力(Ps)", 1198: "电动机(Ps)", 1265: "变速箱简称", 1230: "变速箱类型",
}
EXACT = {
    "displacement": ("排量(L)", "排量(mL)"), "length_mm": ("长度(mm)",), "width_mm": ("宽度(mm)",), "height_mm": ("高度(mm)",), "wheelbase_mm": ("轴距(mm)",), "seats": ("座位数(个)",), "doors": ("车门数(个)",),
    "curb_weight_kg": ("整备质量(kg)",), "trunk_volume_l": ("后备厢容积(L)",), "official_price": ("厂商指导价",),
}
NOTHING = ("-", "--", "暂无", "未公布", "无")
NUMERIC = ("max_power_kw", "max_torque_nm", "horsepower", "motor_power_kw", "motor_torque_nm", "battery_capacity_kwh", "cltc_range_km", "wltc_range_km", "length_mm", "width_mm", "height_mm", "wheelbase_mm", "doors", "curb_weight_kg", "trunk_volume_l")
# Sections of a single model's comparison, with each field's label.
SECTIONS = {
    "基础信息": {"brand": "品牌", "series_name": "车系", "model_name": "车型", "url": "Autohome 链接", "energy_type": "能源类型", "market_date": "上市时间", "official_price": "厂商指导价", "sales_volume": "销量"},
    "动力总成": {
        "engine": "发动机", "displacement": "排量", "intake_type": "进气形式", "max_power_kw": "最大功率(kW)", "max_torque_nm": "最大扭矩(N·m)", "horsepower": "最大马力(Ps)", "motor_power_kw": "电机功率(kW)",
        "motor_torque_nm": "电机扭矩(N·m)", "gearbox": "变速箱", "drive_type": "驱动方式",
    },
    "电池与电动化": {"battery_type": "电池类型", "battery_capacity_kwh": "电池容量(kWh)", "cltc_range_km": "CLTC续航(km)", "wltc_range_km": "WLTC续航(km)", "fast_charge_time": "快充时间", "slow_charge_time": "慢充时间"},
    "车身与空间": {"length_mm": "长度(mm)", "width_mm": "宽度(mm)", "height_mm": "高度(mm)", "wheelbase_mm": "轴距(mm)", "seats": "座位数", "doors": "车门数", "curb_weight_kg": "整备质量(kg)", "trunk_volume_l": "后备厢容积(L)"},
}
FIELDS = tuple(ALIASES)

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_UNREAD = frozenset(("script", "style", "template"))
_INLINE = frozenset(("li", "p", "div", "span"))
#: Characters of a part that may be a label and its value.
PART = 120


class _Tree(HTMLParser):
    """Texts of a page in order, and for each element of interest the range of texts inside it."""

    def __init__(self) -> None:
        super().__init__()
        self.texts: list[str] = []
        self.sizes = [0]
        self.open: list[list] = []
        self.elements: list[list] = []  # tag, first text, after the last, attributes

    def handle_starttag(self, tag: str, attrs: list) -> None:
        element = [tag, len(self.texts), None, dict(attrs)]
        if tag == "tr" or tag in _INLINE or tag in ("td", "th", "a", "title"):
            self.elements.append(element)
        if tag not in _VOID:
            self.open.append(element)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if any(e[0] == tag for e in self.open):
            while True:
                element = self.open.pop()
                element[2] = len(self.texts)
                if element[0] == tag:
                    return

    def handle_data(self, data: str) -> None:
        if data := " ".join(data.split()):
            if not any(e[0] in _UNREAD for e in self.open):
                self.texts.append(data)
                self.sizes.append(self.sizes[-1] + len(data) + 1)

    def close(self) -> None:
        super().close()
        for element in self.open:
            element[2] = len(self.texts)

    def text(self, element: list, most: int | None = None) -> str:
        """Texts inside, '' where they are longer than ``most``; nothing is put together for that."""
        a, b = element[1], len(self.texts) if element[2] is None else element[2]
        if most is not None and self.sizes[b] - self.sizes[a] - 1 > most:
            return ""
        return " ".join(self.texts[a:b])

    def pairs(self) -> dict[str, str]:
        found: dict[str, str] = {}
        for at, row in enumerate(self.elements):
            if row[0] != "tr":
                continue
            end, inside = len(self.texts) if row[2] is None else row[2], []
            for e in takewhile(lambda e: e[1] < end and len(inside) < 3, islice(self.elements, at + 1, None)):
                if e[0] in ("td", "th") and (text := self.text(e)):
                    inside.append(text)
            if len(inside) == 2:
                found.setdefault(*inside)
        for e in self.elements:
            if e[0] in _INLINE and (text := self.text(e, PART)):
                label, colon, value = text.partition("：" if "：" in text else ":")
                if colon and (label := label.strip()) and (value := value.strip()):
                    found.setdefault(label, value)
        return found

    def links(self, base: str, site: str) -> list[str]:
        """Addresses on ``site`` that lead to a configuration, in order, each once."""
        found: dict[str, None] = {}
        for e in self.elements:
            if e[0] == "a" and (href := (e[3].get("href") or "").strip()):
                try:
                    address = urljoin(base, href)
                except ValueError:
                    continue
                if site in address and ("/config/" in address or "参数配置" in self.text(e)):
                    found.setdefault(address)
        return list(found)


READ = "title string, text string, pairs map<string,string>, links array<string>"


def read_pages(pages: DataFrame, key: str, *, html: str = "html", url: str = "url", site: str = "autohome.com.cn") -> DataFrame:
    """key, url, and what the page holds: title, text in one line, pairs (first of equal labels), links to configurations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for address, page in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                tree = _Tree()
                tree.feed(page or "")
                tree.close()
                title = next((e for e in tree.elements if e[0] == "title"), None)
                rows.append((tree.text(title) if title else "", " ".join(tree.texts), list(tree.pairs().items()), tree.links(address or "", site)))
            title, text, pairs, links = zip(*rows) if rows else ((),) * 4
            columns = [pa.array(title, pa.string()), pa.array(text, pa.string()), pa.array(pairs, pa.map_(pa.string(), pa.string())), pa.array(links, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], [key, url, "title", "text", "pairs", "links"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, url, html).mapInArrow(run, f"`{key}` {kind}, `{url}` string, {READ}")


def _value(c: Column) -> Column:
    t = norm_space(c)
    return F.when(t.isin(*NOTHING), "").otherwise(t)


def _first(*columns: Column) -> Column:
    """The first that isn't ''."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns), F.lit(""))


def _matched(text: Column, patterns: tuple[str, ...]) -> list[Column]:
    return [norm_space(F.regexp_extract(text, p, 1)) for p in patterns]


def _aliased(pairs: Column, field: str) -> Column:
    return F.coalesce(by_alias(pairs, list(ALIASES[field])), F.lit("")) if ALIASES[field] else F.lit("")


def _numbers(df: DataFrame, pairs: Column, text: Column) -> DataFrame:
    """Sizes from a label or the text; numbers alone where a field is one; what the engine says of displacement and intake."""
    sized = F.get(F.map_values(F.map_filter(pairs, lambda k, _: F.contains(k, F.lit("长")) & F.contains(k, F.lit("宽")) & F.contains(k, F.lit("高")))), 0)
    size = _first(F.coalesce(sized, F.lit("")), F.regexp_extract(text, r"长[/×xX*]\s*宽[/×xX*]\s*高[:：]?\s*([0-9.\s/×xX*]+)", 1))
    df = df.withColumn("__size", three_measures(size))
    df = df.withColumns({f: _first(F.coalesce(F.get("__size", k), F.lit("")), F.col(f)) for k, f in enumerate(("length_mm", "width_mm", "height_mm"))})
    df = df.withColumns({f: F.when(F.col(f) == "", "").otherwise(first_number(F.col(f))) for f in (*NUMERIC, "seats")})
    litres = F.regexp_extract("engine", r"(?i)(\d+(?:\.\d+)?)L", 1)
    intake = F.when(F.contains("engine", F.lit("涡轮")) | F.contains("engine", F.lit("T")), "涡轮增压").when(F.contains("engine", F.lit("自然吸气")), "自然吸气").otherwise("")
    return df.withColumns({"displacement": _first(F.col("displacement"), litres), "intake_type": _first(F.col("intake_type"), intake)}).drop("__size")


def page_summaries(pages: DataFrame, key: str, *, url: str = "url") -> DataFrame:
    """key, url and the fields of pages that ``read_pages`` has read."""
    pairs, text, title = F.col("pairs"), F.col("text"), F.col("title")
    found = pages.select(key, url, "pairs", "text", "title", *(_value(_first(_aliased(pairs, f), *_matched(text, PATTERNS.get(f, ())))).alias(f) for f in FIELDS))
    cleaned = F.split(F.regexp_replace(title, "参数配置表|价格单|[〖〗]", ""), "_")[0]
    named = {
        "brand": _matched(title, ("_([^_]+?)_汽车之家",)), "series_name": [*_matched(text, (r"返回\s*([^\n\r]+)",)), *_matched(title, (r"〖([^0-9]{1,30}?)(?:\d{4}款)",))],
        "model_name": [*_matched(text, (r"(\d{4}款[^\n\r]+?)(?:车型首页|参数配置|价格单)",)), norm_space(cleaned)],
    }
    found = found.withColumns({f: _first(F.col(f), *otherwise) for f, otherwise in named.items()})
    return _numbers(found, pairs, text).select(key, url, *FIELDS)


def series_summaries(pages: DataFrame, key: str, *, html: str = "html", url: str = "url", wanted: str = "wanted", brand: str = "brand_name") -> DataFrame:
    """key, spec, url and the fields of the model of a series page that fits the ``wanted`` name best; ``brand`` stands in for none."""
    text = lambda c: norm_space(strip_tags(c))
    j = pages.select(key, url, html, wanted, brand, F.from_json(script_json(F.col(html), "config"), CONFIG).alias("__c"))
    groups = F.filter(F.coalesce(F.col("__c.result.paramtypeitems"), F.array()), lambda g: g["paramitems"].isNotNull())
    j = j.withColumn("__g", groups)
    items = F.flatten(F.transform("__g", lambda g: g["paramitems"]))
    models = F.get(F.filter(items, lambda i: F.contains(text(i["name"]), F.lit("车型"))), 0)["valueitems"]
    scored = F.transform(models, lambda v, i: F.struct((-spec_score(F.col(wanted), text(v["value"]), i + 1)).alias("rank"), i.alias("i"), v["specid"].alias("spec"), text(v["value"]).alias("name")))
    j = j.withColumn("__m", F.array_min(scored))
    known = F.create_map(*(F.lit(x) for kv in (LABELS | MORE_LABELS).items() for x in kv))

    def pair(group: Column, item: Column, n: Column) -> Column:
        value = F.coalesce(text(F.get(F.filter(item["valueitems"], lambda v: F.trim(F.coalesce(v["specid"], F.lit(""))) == F.trim(F.col("__m.spec"))), 0)["value"]), F.lit(""))
        price, basic = value.rlike(r"^\d+(\.\d+)?$"), text(group["name"]) == "基本参数"
        own = F.coalesce(F.try_element_at(known, item["id"]), text(item["name"]))
        # the page may show only parts of the second and third label: their place tells
        label = F.when(own == "", "").when(basic & (n == 1) & price, "厂商指导价").when(basic & (n == 2) & ~price, "厂商").otherwise(own)
        return F.struct(label.alias("k"), value.alias("v"))

    flat = F.flatten(F.transform("__g", lambda g: F.transform(g["paramitems"], lambda i, n: pair(g, i, n))))
    j = j.withColumn("__p", F.filter(flat, lambda p: (p["k"] != "") & (p["v"] != "")))
    labels = F.array_distinct(F.transform("__p", lambda p: p["k"]))
    # a label keeps its first place and takes its last value
    j = j.withColumn("pairs", F.map_from_arrays(labels, F.transform(labels, lambda k: F.element_at(F.filter("__p", lambda p: p["k"] == k), -1)["v"])))
    j = j.withColumn("title", text(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))
    pairs = F.col("pairs")
    exact = lambda f: [F.coalesce(F.try_element_at(pairs, F.lit(k)), F.lit("")) for k in EXACT.get(f, ())]
    found = j.select(key, F.col("__m.spec").alias("spec"), url, "pairs", "title", F.col("__m.name").alias("__name"), F.col(brand).alias("__brand"), *(_first(_value(_aliased(pairs, f)), *exact(f)).alias(f) for f in FIELDS))
    found = found.withColumn("series_name", _first(F.col("series_name"), *_matched(F.col("title"), (r"汽车之家\|([^|]+)\|报价大全",)))).withColumn("model_name", _first(F.col("model_name"), F.coalesce("__name", F.lit(""))))
    maker = _value(F.coalesce(by_alias(pairs, ["品牌", "厂商"]), F.lit("")))
    found = found.withColumn("brand", _first(F.col("brand"), _value(F.coalesce("__brand", F.lit(""))), maker))
    address = F.when(F.coalesce("spec", F.lit("")) != "", F.concat(F.lit("https://car.autohome.com.cn/config/spec/"), F.trim("spec"), F.lit(".html"))).otherwise(F.col(url))
    return _numbers(found.withColumn(url, address), pairs, F.array_join(F.map_values(pairs), " ")).select(key, "spec", url, *FIELDS)


def summary_rows(summaries: DataFrame, key: str) -> DataFrame:
    """A single model's summary as rows of a comparison: key, place, section, param, value."""
    rows = [(section, label, field) for section, fields in SECTIONS.items() for field, label in fields.items()]
    each = F.array(*(F.struct(F.lit(i).alias("place"), F.lit(s).alias("section"), F.lit(label).alias("param"), compare_value(F.col(f).cast("string")).alias("value")) for i, (s, label, f) in enumerate(rows)))
    return summaries.select(key, F.explode(each).alias("r")).select(key, "r.*")
