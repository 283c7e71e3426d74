"""Text functions as column expressions. White space is Unicode white space unless said otherwise."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space beyond ASCII, spelled out so that other regex engines can share the pattern.
SPACES = r"[\s\x{0B}\x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once, however often ``f`` uses it.

    Inside lambdas Spark shares no subexpressions: a column used twice is computed twice,
    and nested uses multiply.
    """
    return F.get(F.transform(F.array(value), f), F.lit(0))


def blank_to_null(c: Column) -> Column:
    """'' counts as absent."""
    return F.nullif(c, F.lit(""))


def first_filled(*columns: Column) -> Column:
    """The first that is neither null nor ''."""
    return F.coalesce(*(blank_to_null(c.cast("string")) for c in columns))


def norm_key(c: Column) -> Column:
    """Name as a key: no white space, underscores or hyphens, lower case."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), rf"({SPACES}|[_-])+", ""))


def norm_series(c: Column) -> Column:
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{SPACES}+", ""))


def norm_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"{SPACES}+", " "))


def norm_model(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def safe_part(c: Column) -> Column:
    """Part of a path: runs of unsafe characters and white space become one underscore."""
    cut = F.regexp_replace(F.coalesce(c, F.lit("")), r"[\\/:*?\"<>|\s]+", "_")
    cut = F.regexp_replace(cut, r"^[._]+|[._]+$", "")
    return F.when(cut == "", "unknown").otherwise(cut)


def safe_file_name(c: Column, fallback: str = "export") -> Column:
    cut = F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"[\\/:*?\"<>|]+", "_"))
    return F.when(cut == "", fallback).otherwise(cut)


def placeholder_to_blank(c: Column, placeholders: tuple[str, ...] = ("-", "--", "N/A", "n/a", "null", "None")) -> Column:
    t = norm_space(c)
    return F.when(t.isin(*placeholders), "").otherwise(t)


def compare_value(c: Column, noise: tuple[str, ...] = ("询底价", "查看报价")) -> Column:
    """Cell of a comparison: without price-inquiry text; '-' when nothing is left."""
    t = norm_space(F.regexp_replace(F.coalesce(c, F.lit("")), "|".join(noise), ""))
    return F.when(t == "", "-").otherwise(t)


def tokens(c: Column) -> Column:
    """Lower-case parts between white space, hyphens, underscores and slashes."""
    return F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), r"[\s\-_/]+"), lambda x: x != "")


def split_names(c: Column) -> Column:
    """Names between commas of either width, trimmed, without empty ones."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,，]"), lambda v: F.trim(v)), lambda x: x != "")


def split_args(c: Column) -> Column:
    """Like split_names, line feeds separate too, first of equal names only."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "[,，\n]"), lambda v: F.trim(v)), lambda x: x != ""))


def strip_tags(c: Column) -> Column:
    """Text without tags; the two entities that tables use are resolved."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), "<[^>]*>", "")
    return F.trim(F.replace(F.replace(t, F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&")))


def strip_brackets(c: Column) -> Column:
    """Without annotations in brackets of either width."""
    return F.regexp_replace(c, "[（(][^()（）]*[)）]", "")


def first_number(c: Column) -> Column:
    """First signed number, thousands separators ignored, else the text."""
    t = F.replace(F.coalesce(c, F.lit("")), F.lit(","), F.lit(""))
    return first_filled(F.regexp_extract(t, r"-?\d+(?:\.\d+)?", 0), F.trim(F.coalesce(c, F.lit(""))))


def three_measures(c: Column) -> Column:
    """First three numbers of a text, null if there are fewer."""
    found = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d+(?:\.\d+)?)"), 1)
    return F.when(F.size(found) >= 3, F.slice(found, 1, 3))


def model_token(c: Column) -> Column:
    """Letters and digits that end a name, in lower case; '' below two characters."""
    t = F.regexp_extract(F.replace(F.coalesce(c, F.lit("")), F.lit(" "), F.lit("")), "[A-Za-z0-9]+$", 0)
    return F.when(F.length(t) >= 2, F.lower(t)).otherwise("")


def has_token(name: Column, token: Column) -> Column:
    """Digits must be a whole run of digits of the name; letters a part of it."""
    run = F.concat(F.lit("(^|[^0-9])"), token, F.lit("([^0-9]|$)"))
    return (token != "") & (name != "") & F.when(token.rlike("^[0-9]+$"), F.regexp_like(name, run)).otherwise(F.contains(name, token))


def split_fused(c: Column) -> Column:
    """Cell with a company and a model code glued together as two cells, else one."""
    company, code = (F.regexp_extract(c, r"^(.*(?:公司|集团|厂))([A-Z]{2,4}\d[0-9A-Z/]*)$", i) for i in (1, 2))
    return F.when(code != "", F.array(company, code)).otherwise(F.array(c))


def leading_percent(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"^(\d+(?:\.\d+)?)%", 1)


def prefix_of_code(c: Column) -> Column:
    """Model code without its last digits."""
    return F.regexp_replace(c, r"[0-9]+$", "")


def split_review(c: Column, turns: tuple[str, ...]) -> Column:
    """Praise and criticism of a summary: cut at the first of ``turns``, in their order, that it contains."""
    praise, blame = F.trim(c), F.lit("")
    for turn in reversed(turns):
        at = F.locate(turn, c)
        praise = F.when(at > 0, F.trim(F.substring(c, F.lit(1), at - 1))).otherwise(praise)
        blame = F.when(at > 0, F.trim(F.substring(c, at, F.length(c)))).otherwise(blame)
    return F.struct(praise.alias("praise"), blame.alias("blame"))


def key_values(c: Column) -> Column:
    """'a=1;b=2' as a map."""
    return F.str_to_map(F.coalesce(c, F.lit("")), F.lit(";"), F.lit("="))


def file_stem_id(c: Column) -> Column:
    """Product id that ends a file name: the part behind the last underscore, without suffix."""
    return F.regexp_extract(c, r"_([^_/.]+)\.[A-Za-z]+$", 1)


def revision_name(c: Column) -> Column:
    """File name without a revision's time stamp before the suffix."""
    return F.regexp_replace(c, r"__\d{8}T\d{6}Z?(?=\.[A-Za-z]+$)", "")


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def spec_id(c: Column) -> Column:
    return first_filled(F.regexp_extract(c, r"/spec/(\d+)", 1), F.regexp_extract(c, r"specid=(\d+)", 1))


def markdown_text(c: Column) -> Column:
    """Line of markdown as text: links keep their words, non-breaking spaces become spaces."""
    t = F.regexp_replace(c, r"!?\[([^\]]*)\]\([^)]*\)", "$1")
    return norm_space(F.replace(t, F.lit("&nbsp;"), F.lit(" ")))


def safe_relative(path: Column) -> Column:
    """Whether a path stays below its root: relative, no parent steps, not empty."""
    p = F.coalesce(path, F.lit(""))
    return (p != "") & ~p.startswith("/") & ~p.rlike(r"^[A-Za-z]:") & ~p.rlike(r"(^|[/\\])\.\.([/\\]|$)")
