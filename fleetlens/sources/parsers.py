"""Row-generating parsers: table functions over whole documents, and positioned words."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from html.parser import HTMLParser
from itertools import islice, takewhile
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.functions import udtf

# Header words of catalogue columns.
COLUMNS = (
    ("seq", ("序号",)),
    ("company", ("企业名称", "汽车生产企业")),
    ("trademark", ("商标",)),
    ("model_code", ("车辆型号", "产品型号")),
    ("common_name", ("通用名称", "产品名称", "车型名称")),
    ("range_km", ("续驶里程", "续航里程")),
    ("fuel_consumption", ("燃料消耗量",)),
    ("battery_mass", ("电池组总质量", "电池总质量")),
    ("battery_energy", ("电池组总能量", "电池总能量")),
    ("remark", ("备注",)),
)
NEEDED = ("range_km", "battery_mass", "battery_energy")
# Words of structural paragraphs.
ENERGIES = ("插电式混合动力", "纯电动", "燃料电池", "增程式")
CATEGORIES = ("乘用车", "客车", "货车", "专用车")
_CODE = re.compile(r"^[A-Z]{2,4}\d[0-9A-Z/()（）-]*$")
_COMPANY = re.compile(r"(公司|集团|厂)$")
_BATCH = re.compile(r"第([零〇一二两三四五六七八九十百\d]+)批")
ROW = "table_no int, row_no int, catalog string, batch int, energy string, category string, " + ", ".join(f"{c} string" for c, _ in COLUMNS) + ", extra map<string,string>"


def chinese_int(text: str) -> int | None:
    """Chinese or Arabic number below a thousand."""
    if text.isascii() and text.isdigit():
        return int(text)
    digits, total, held = "零一二三四五六七八九", 0, None
    for c in text.replace("〇", "零").replace("两", "二"):
        if c in digits:
            held = digits.index(c)
        elif c in "十百":
            total += (1 if held is None else held) * (10 if c == "十" else 100)
            held = None
        else:
            return None
    return total + (held or 0) if text else None


def column_of(header: str) -> str:
    text = re.sub(r"\s+", "", header)
    for name, words in COLUMNS:
        if any(w in text for w in words):
            return name
    return f"extra:{text}"


class Context:
    """What headings above a table say of its rows."""

    def __init__(self) -> None:
        self.catalog, self.batch, self.energy, self.category = "", None, "", ""

    def read(self, text: str) -> bool:
        """Takes a paragraph in; false if it says nothing."""
        t = re.sub(r"\s+", "", text)
        known = False
        if "目录" in t and len(t) <= 60 and not re.search("[。；，]", t):
            title = _BATCH.sub("", t).replace("（）", "")
            if title != self.catalog:
                self.catalog, self.batch, self.energy, self.category = title, None, "", ""
            known = True
        if m := _BATCH.search(t):
            self.batch, known = chinese_int(m[1]), True
        if len(t) <= 30:
            if e := next((e for e in ENERGIES if e in t), None):
                self.energy, self.category, known = e, "", True
            if c := next((c for c in CATEGORIES if c in t.replace("汽车", "车")), None):
                self.category, known = c, True
        return known

    def values(self) -> tuple:
        return self.catalog, self.batch, self.energy, self.category


def qualifies(names: list[str], catalog: str) -> bool:
    """A table of vehicles has models and a range or battery column; recommended catalogues don't count."""
    return "model_code" in names and any(n in names for n in NEEDED) and "推荐" not in catalog


def records(names: list[str], rows: list[list[str]], context: Context, table_no: int) -> Iterator[tuple]:
    """Rows as tuples of ROW: company and trademark carried down, missing sequence numbers made up."""
    above = {"company": "", "trademark": ""}
    for row_no, cells in enumerate(rows, 1):
        got = dict(zip(names, cells))
        for k in above:
            got[k] = above[k] = got.get(k) or above[k]
        if not got.get("seq"):
            got["seq"] = str(row_no)
        if not got.get("model_code"):
            continue
        extra = {k.removeprefix("extra:"): v for k, v in got.items() if k.startswith("extra:")}
        if len(cells) > len(names):
            got["remark"] = " ".join(x for x in (got.get("remark", ""), *cells[len(names) :]) if x)
        yield (table_no, row_no, *context.values(), *(got.get(c, "") for c, _ in COLUMNS), extra)


class _Flat(HTMLParser):
    """Paragraphs as lists of cells; an empty span separates cells."""

    def __init__(self) -> None:
        super().__init__()
        self.paragraphs: list[list[str]] = []
        self.cells: list[str] | None = None
        self.span: str | None = None

    def handle_starttag(self, tag, attrs):
        if tag == "p":
            self.cells = [""]
        elif tag == "span" and self.cells is not None:
            self.span = ""

    def handle_endtag(self, tag):
        if tag == "p" and self.cells is not None:
            self.paragraphs.append([c.strip() for c in self.cells])
            self.cells = None
        elif tag == "span" and self.span is not None and self.cells is not None:
            if self.span.strip():
                self.cells[-1] += self.span
            else:
                self.cells.append("")
            self.span = None

    def handle_data(self, data):
        if self.span is not None:
            self.span += data
        elif self.cells is not None:
            self.cells[-1] += data


def _starts_row(cell: str, expected: int) -> bool:
    return cell == str(expected) or bool(_COMPANY.search(cell))


def _is_value(cells: list[str], at: int, columns: int, model_at: int) -> bool:
    """Whether the next row's number is a value of the row that still lacks ``columns``.

    So it is if no model can follow, or if the same number stands once more before a
    company or model begins the next row.
    """
    if columns <= 0:
        return False
    ahead = list(takewhile(lambda c: not _COMPANY.search(c) and not _CODE.match(c), islice(cells, at + 1, at + 1 + max(columns, model_at))))
    return cells[at] in ahead[:columns] or at + 1 + len(ahead) == len(cells) <= at + model_at


def split_rows(names: list[str], cells: list[str]) -> list[list[str]]:
    """Cells of a flattened table as rows: a new one begins at the next number, a company, or a model out of place."""
    rows: list[list[str]] = []
    model_at = names.index("model_code")
    for at, cell in enumerate(cells):
        expected = len(rows) + 1
        full = rows and len(rows[-1]) > model_at
        second_model = full and _CODE.match(cell) and any(_CODE.match(c) for c in rows[-1])
        begins = full and _starts_row(cell, expected) and not (cell == str(expected) and _is_value(cells, at, len(names) - len(rows[-1]), model_at))
        if not rows or begins or second_model:
            rows.append([])
            # leading columns that merged cells left out
            first = "seq" if cell == str(expected) else "company" if _COMPANY.search(cell) else "model_code" if _CODE.match(cell) else names[0]
            if first in names:
                rows[-1] += [""] * names.index(first)
        elif len(rows[-1]) < model_at and _CODE.match(cell):
            rows[-1] += [""] * (model_at - len(rows[-1]))
        rows[-1].append(cell)
    return rows


def catalog_html(html: str) -> Iterator[tuple]:
    parser, context, table_no = _Flat(), Context(), 0
    parser.feed(html or "")
    for cells in parser.paragraphs:
        if len(cells) < 6:
            context.read("".join(cells))
            continue
        filled = [c for c in cells if c]
        while filled and context.read(filled[0]) and column_of(filled[0]).startswith("extra:"):
            filled = filled[1:]
        at = next((i for i, c in enumerate(filled) if c == "1" or _COMPANY.search(c) or _CODE.match(c)), len(filled))
        names = [column_of(c) for c in filled[:at]]
        if len(names) < 5 or at == len(filled) or not qualifies(names, context.catalog):
            continue
        body, later = filled[at:], []
        while body and Context().read(body[-1]) and not _CODE.match(body[-1]) and not _COMPANY.search(body[-1]):
            later.insert(0, body.pop())
        table_no += 1
        yield from records(names, split_rows(names, body), context, table_no)
        for text in later:  # a heading at the end of a table is the next one's
            context.read(text)


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def catalog_docx(content: bytes) -> Iterator[tuple]:
    """Tables of a word-processor document; vertically merged cells repeat what stands above."""
    context, table_no = Context(), 0
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    for block in body if body is not None else []:
        if block.tag == f"{_W}p":
            context.read("".join(t.text or "" for t in block.iter(f"{_W}t")))
            continue
        if block.tag != f"{_W}tbl":
            continue
        grid: list[list[str]] = []
        above: list[str] = []  # the last row that isn't a header again
        for tr in block.iter(f"{_W}tr"):
            cells = []
            for i, tc in enumerate(tr.iter(f"{_W}tc")):
                text = "".join(t.text or "" for t in tc.iter(f"{_W}t")).strip()
                merge = tc.find(f"{_W}tcPr/{_W}vMerge")
                if merge is not None and merge.get(f"{_W}val") != "restart" and i < len(above):
                    text = text or above[i]
                cells.append(text)
            if not grid or cells != grid[0]:
                above = cells
            grid.append(cells)
        names = [column_of(c) for c in grid[0]] if grid else []
        if not qualifies(names, context.catalog):
            continue
        table_no += 1
        yield from records(names, [r for r in grid[1:] if [column_of(c) for c in r] != names], context, table_no)


# Header words of change notices.
NOTICE = (("batch", ("批次",)), ("company", ("企业名称",)), ("trademark", ("商标",)), ("model", ("型号",)), ("name", ("名称",)), ("change", ("变更", "扩展")), ("date", ("日期", "时间")), ("note", ("备注",)))
NOTICE_ROW = "row_no int, " + ", ".join(f"{c} string" for c, _ in NOTICE) + ", detail_url string, error string"


class _Tables(HTMLParser):
    """Rows of all tables: (text, span, link) per cell."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[list[list]] = []
        self.cell: list | None = None

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "tr":
            self.rows.append([])
        elif tag in ("td", "th") and self.rows:
            spans = int(a.get("colspan") or 1) > 1 or int(a.get("rowspan") or 1) > 1
            self.cell = ["", spans, ""]
            self.rows[-1].append(self.cell)
        elif tag == "a" and self.cell is not None:
            self.cell[2] = a.get("href") or self.cell[2]

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self.cell = None

    def handle_data(self, data):
        if self.cell is not None:
            self.cell[0] += data.strip()


def notice_table(html: str) -> Iterator[tuple]:
    """Rows of a notice by its headers; merged or short rows come with an error, the summary row not at all."""
    parser = _Tables()
    parser.feed(html or "")
    names: list[str | None] = []
    for row_no, row in enumerate(parser.rows):
        texts = [c[0] for c in row]
        if not names:
            found = [next((n for n, words in NOTICE if any(w in t for w in words)), None) for t in texts]
            if len([n for n in found if n]) >= 3:
                names = found
            continue
        if texts and re.match(r"^(合计|共\d+)", texts[0]):
            continue
        got = dict(zip(names, texts))
        error = "merged cells" if any(c[1] for c in row) else "short row" if len(row) < len(names) else None
        yield (row_no, *(got.get(n, "") for n, _ in NOTICE), next((c[2] for c in row if c[2]), ""), error)


@udtf(returnType=ROW)
class CatalogHtml:
    """parse_catalog_html(html): rows of a flattened catalogue page."""

    def eval(self, html: str):
        yield from catalog_html(html)


@udtf(returnType=ROW)
class CatalogDocx:
    """parse_catalog_docx(content): rows of a catalogue document."""

    def eval(self, content: bytes):
        yield from catalog_docx(content)


@udtf(returnType=NOTICE_ROW)
class NoticeTable:
    """parse_notice_table(html): rows of a change notice."""

    def eval(self, html: str):
        yield from notice_table(html)


# Layout thresholds of parameter pages, in points.
LINE, SLACK, LEFT, RIGHT = 3.0, 10.0, 145.0, 380.0
# Labels of parameter pages and the engine table's columns.
LABELS = {"产品商标": "trademark", "产品型号": "model", "产品名称": "name", "企业名称": "company", "燃料种类": "fuel", "总质量": "mass", "整备质量": "curb_mass", "最高车速": "top_speed", "轴距": "wheelbase", "轮胎规格": "tyres", "额定载客": "seats", "其他": "other"}
ENGINE = {"发动机型号": "engine_model", "发动机生产企业": "engine_company", "排量": "displacement", "功率": "power"}


def lines_of(words: list[dict]) -> list[list[dict]]:
    """Words in lines, top to bottom and left to right; tops within LINE are one line."""
    out: list[list[dict]] = []
    for w in sorted(words, key=lambda w: (w["top"], w["x0"])):
        if out and w["top"] - out[-1][0]["top"] <= LINE:
            out[-1].append(w)
        else:
            out.append([w])
    return [sorted(line, key=lambda w: w["x0"]) for line in out]


def fields_of(words: list[dict]) -> dict[str, str]:
    """Fields of a parameter page: label and colon pairs, the batch, the engine table by its header's columns."""
    fields: dict[str, str] = {}
    pattern = re.compile("(" + "|".join(map(re.escape, LABELS)) + r")[^:：]{0,12}[:：]")
    lines = lines_of(words)
    heads: list[tuple[float, str]] = []
    for line in lines:
        text = " ".join(w["text"] for w in line)
        if m := re.search(r"第\s*(\d+)\s*批", text):
            fields.setdefault("batch", m[1])
        found = [(w["x0"], ENGINE[k]) for w in line for k in ENGINE if w["text"].startswith(k)]
        if len(found) >= 2:
            heads = sorted(found)
            continue
        marks = list(pattern.finditer(text))
        for m, nxt in zip(marks, [*marks[1:], None]):
            value = text[m.end() : nxt.start() if nxt else len(text)].strip()
            if value and not fields.get(LABELS[m[1]]):
                fields[LABELS[m[1]]] = value
        if marks:
            heads = []
        for w in line if heads and not marks else ():
            if column := next((n for x, n in reversed(heads) if w["x0"] >= x - SLACK), None):
                fields[column] = f"{fields.get(column, '')} {w['text']}".strip()
    if m := re.search(r"\b([A-HJ-NPR-Z0-9]{8,17})\b", " ".join(w["text"] for line in lines for w in line if w["x0"] < LEFT and len(w["text"]) >= 8 and w["text"].isalnum())):
        fields.setdefault("vin", m[1])
    return fields


def words_to_fields(pages: DataFrame, key: str, words: str) -> DataFrame:
    """One map of fields per document; words is array<struct<text,x0,x1,top>>."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [[dict(w) if isinstance(w, dict) else w.asDict() for w in (ws if ws is not None else [])] for ws in pdf[words]]
            yield pd.DataFrame({key: pdf[key], "fields": [fields_of(r) for r in rows]})

    return pages.select(key, words).mapInPandas(run, f"`{key}` {kind}, fields map<string,string>")
