"""Small predicates and scores as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import once

from .text import norm_space

# Words of captured groups that are no parameters, and of parameters left out.
NOISE = ("广告", "热门推荐", "app下载", "打开汽车之家", "立即打开", "询底价", "获取底价", "降价提醒", "经销商优惠", "点击了解", "查看完整参数", "参数纠错")
IGNORED = ("图片", "视频", "报价图片", "经销商", "询价", "底价", "对比", "关注度")
# Category of a model code's first digit (6 depends on the name).
CODE_CATEGORIES = {"1": "货车", "2": "乘用车", "3": "货车", "4": "货车", "5": "专用车", "7": "乘用车"}
UNCLASSIFIED = "未分类"


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def _contains_any(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(_text(c), F.lit(w))
    return out


def category_of_code(code: Column, name: Column) -> Column:
    """Category by the digit behind a model code's letters."""
    digit = F.regexp_extract(_text(code), r"^[A-Za-z]+(\d)", 1)
    bus = F.when(F.contains(_text(name), F.lit("客车")), "客车").otherwise("乘用车")
    plain = F.try_element_at(F.create_map(*(F.lit(x) for kv in CODE_CATEGORIES.items() for x in kv)), digit)
    return F.when(digit == "6", bus).otherwise(F.coalesce(plain, F.lit(UNCLASSIFIED)))


def is_release(title: Column) -> Column:
    """A published catalogue, not a draft put up for comment."""
    t = _text(title)
    return ~F.contains(t, F.lit("公示")) & (F.contains(t, F.lit("减免车辆购置税")) | F.contains(t, F.lit("车船税减免")))


def is_other_document(hint: Column) -> Column:
    """A title seen in advance that is certainly no catalogue; without a title nothing is certain."""
    h = F.trim(_text(hint))
    return (h != "") & ((h == "目录") | F.contains(h, F.lit("推荐")))


def is_failed_catalogue(catalogue: Column, hint: Column, converted: Column) -> Column:
    """No rows, though the document should have some: to be read again."""
    h = F.trim(_text(hint))
    return ~converted | (F.trim(_text(catalogue)) != "") | ((h != "") & ~is_other_document(hint))


def is_noise_group(name: Column) -> Column:
    return _contains_any(name, NOISE)


def is_ignored_parameter(label: Column) -> Column:
    return (_text(label) == "") | _contains_any(label, IGNORED)


def is_series(class_name: Column, rule_type: Column) -> Column:
    """By class, else by rule type, else yes."""
    c = F.trim(_text(class_name))
    return F.when(c != "", c == "CarSeries").when(rule_type.isNotNull(), rule_type == 4).otherwise(True)


def spec_score(wanted: Column, candidate: Column, place: Column) -> Column:
    """Points of a candidate: early place, words of the query, model year."""
    low = F.lower(norm_space(candidate))
    words = F.filter(F.split(F.lower(norm_space(wanted)), r"[\s,，/_-]+"), lambda w: w != "")
    hits = F.size(F.filter(words, lambda w: F.contains(low, w)))
    year = F.regexp_extract(candidate, r"(20\d{2})款", 1)
    return F.lit(100) - place + 12 * hits + F.coalesce(F.nullif(year, F.lit("")).cast("int"), F.lit(0))


def search_score(wanted: Column, title: Column, rank: Column) -> Column:
    same = F.lower(norm_space(title)) == F.lower(norm_space(wanted))
    return F.lit(100) - rank + F.when(same, 20).otherwise(0)


def bar_width(score: Column) -> Column:
    """Width in per cent of a bar for a score out of five."""
    return F.greatest(F.lit(2.0), F.least(F.lit(100.0), score / 5 * 100))


def removed_batches(c: Column) -> Column:
    """'408,409' as numbers; an error unless all are positive and differ."""
    parts = F.transform(F.split(_text(c), ","), lambda x: F.trim(x))
    sound = F.forall(parts, lambda x: x.rlike("^[0-9]+$") & ~x.rlike("^0*$")) & (F.size(F.array_distinct(F.transform(parts, lambda x: x.try_cast("bigint")))) == F.size(parts))
    return F.when(sound, F.transform(parts, lambda x: x.try_cast("bigint"))).otherwise(F.raise_error(F.concat(F.lit("not distinct positive batches: "), _text(c))))


#: From where the last piece ended up to a brace outside of strings; an open string ends it all.
_TO_BRACE = r'(?s)\G[^"{}]*+(?:"[^"\\]*+(?:\\.[^"\\]*+)*+"[^"{}]*+)*+[{}]'


def script_json(c: Column, name: str) -> Column:
    """JSON object assigned to a script variable, up to the brace that closes it; '' if none does.

    A fold over the braces outside of strings counts them; a piece is a brace and all since the one before.
    """
    # the name first: a search for letters is quick, for a class before them slow
    assigned = F.regexp_extract(_text(c), rf"(?s){name}(?<![A-Za-z0-9_$]{name})\s*=\s*(\{{.*)", 1)
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("n"), F.lit(False).alias("done"))

    def step(a: Column, x: Column) -> Column:
        depth = a["depth"] + F.when(F.endswith(x, F.lit("{")), 1).otherwise(-1)
        return F.when(a["done"], a).otherwise(F.struct(depth.alias("depth"), (a["n"] + F.length(x)).alias("n"), (depth == 0).alias("done")))

    def cut(rest: Column) -> Column:
        return F.aggregate(F.regexp_extract_all(rest, F.lit(_TO_BRACE), 0), start, step, lambda end: F.when(end["done"], F.substring(rest, F.lit(1), end["n"])).otherwise(""))

    return once(assigned, cut)


def attachment_stem(catalogue: Column, batch: Column) -> Column:
    """Readable name of a catalogue's attachment; '' where catalogue or batch is unknown."""
    c, b = _text(catalogue), _text(batch)
    kind = F.when(F.contains(c, F.lit("购置税")), "购置税").when(F.contains(c, F.lit("车船税")), "车船税").when(F.contains(c, F.lit("推荐")), "推荐")
    return F.when((c == "") | (b == "") | kind.isNull(), "").otherwise(F.concat(kind, F.lit("目录第"), b, F.lit("批")))


def _announced(title: Column) -> Column:
    return F.regexp_extract(_text(title), r"《道路机动车辆生产企业及产品》[（(]第(\d+)批[）)]", 1)


def stem_of_title(catalogue: Column, title: Column) -> Column:
    """Name by the article's title, for attachments that don't tell their batch."""
    c, b = _text(catalogue), _announced(title)
    listed = F.regexp_extract(_text(title), r"《新能源汽车推广应用推荐车型目录》[（(]([^）)]+)[）)]", 1)
    formal = F.when(b == "", "").otherwise(F.concat(F.lit("公告第"), b, F.lit("批附件")))
    return F.when(c.isin("", "目录"), formal).when(F.contains(c, F.lit("推荐")) & (listed != ""), F.concat(F.lit("推荐目录"), listed)).otherwise("")


def article_folder(article: Column, title: Column) -> Column:
    b = _announced(title)
    return F.when(b == "", article).otherwise(F.concat(article, F.lit("_公告第"), b, F.lit("批")))


def score_text(score: Column, reviews: Column) -> Column:
    """A score with two digits; of too few reviews '-' and their number."""
    n = F.coalesce(reviews, F.lit(0))
    few = F.when(n != 0, F.concat(F.lit("-（样本 "), n, F.lit(" 条）"))).otherwise("-")
    return F.when(F.coalesce(score, F.lit(0.0)) <= 0, few).otherwise(F.format_string("%.2f", score))


def sales_label(month: Column) -> Column:
    return F.when(_text(month) == "", "月销量（月份未获取）").otherwise(F.concat(month, F.lit("销量")))


def sales_header(month: Column) -> Column:
    """Header over several vehicles (an aggregate): the month where all share one."""
    m = F.nullif(month, F.lit(""))
    return F.when(F.count(m) == 0, "月销量").when(F.min(m) == F.max(m), F.concat(F.min(m), F.lit("销量"))).otherwise("月销量（含月份）")


def image_names(html: Column, product: Column, batch: Column, model: Column, base: str) -> Column:
    """Struct (names, error) of a detail page's photos: links below base + '/getPic', first of equal names.

    A page of another product, batch or model, or with a link of another product, gives an
    error and no names; pictures from elsewhere are passed over. Relative links belong to base.
    """
    # Labels of the page's cells.
    labels = {"产品ID": product, "批次": batch, "车辆型号": model}
    rows = F.regexp_extract_all(_text(html), F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?is)<td[^>]*>(.*?)</td>"), F.lit(1)), lambda c: F.trim(F.regexp_replace(c, r"<[^>]*>", ""))))
    pairs = F.flatten(F.transform(cells, lambda c: F.when(F.size(c) > 1, F.arrays_zip(F.slice(c, F.lit(1), F.size(c) - 1).alias("k"), F.slice(c, 2, F.size(c)).alias("v"))).otherwise(F.array())))

    def field(label: str) -> Column:
        return F.try_element_at(F.filter(pairs, lambda p: p["k"] == label), F.lit(-1))["v"]

    same = F.lit(True)
    for label, value in labels.items():
        same = same & field(label).eqNullSafe(_text(value))
    same = same & (_text(product) != "") & (_text(batch) != "")
    sources = F.transform(F.regexp_extract_all(_text(html), F.lit(r"(?is)<img\s[^>]*?src=[\"']([^\"']*)[\"']"), F.lit(1)), lambda u: F.regexp_replace(u, "&amp;", "&"))
    full = F.transform(sources, lambda u: F.when(u.rlike("^[a-z]+://"), u).when(F.startswith(u, F.lit("/")), F.concat(F.lit("/".join(base.split("/")[:3])), u)).otherwise(F.concat(F.lit(base + "/"), u)))
    links = F.filter(full, lambda u: F.substring_index(u, "?", 1) == base + "/getPic")

    def values(u: Column, key: str) -> Column:
        return F.regexp_extract_all(F.concat(F.lit("&"), F.substring_index(u, "?", -1)), F.lit(f"&{key}=([^&#]+)"), F.lit(1))

    own = F.forall(links, lambda u: (values(u, "gid") == F.array(product)) & (values(u, "pc") == F.array(batch)) & (F.size(values(u, "zpname")) == 1))
    error = F.when(~same, "identity").when(~own, "link")
    names = F.array_distinct(F.transform(links, lambda u: F.try_url_decode(values(u, "zpname")[0])))
    return F.struct(F.when(error.isNull(), names).alias("names"), error.alias("error"))
