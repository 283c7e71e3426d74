"""Table outputs. Large ones are written by executors; workbooks and reports hold small results."""

from __future__ import annotations

import zipfile
from collections.abc import Iterable
from html import escape
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows that a workbook sheet or a report may hold; larger results go to CSV.
SHEET_ROWS = 1_000_000


def csv_folder(df: DataFrame, path: str) -> None:
    """CSV files that start with a byte-order mark, so that spreadsheets read UTF-8."""
    first = df.columns[0]
    df.withColumnRenamed(first, f"﻿{first}").write.mode("overwrite").option("header", True).csv(path)


def json_lines(df: DataFrame, path: str, append: bool = True) -> None:
    df.write.mode("append" if append else "overwrite").json(path)


def by_category(df: DataFrame, path: str, category: str) -> None:
    """A folder per category; only categories that are written are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(category).parquet(path)


def replace_articles(df: DataFrame, path: str, article: str = "art_id") -> None:
    """Rows of the articles in ``df`` take the place of what these articles had."""
    by_category(df, path, article)


def new_only(df: DataFrame, path: str) -> None:
    """Writes a table that must not exist yet."""
    df.write.mode("errorifexists").parquet(path)


def generation(df: DataFrame, root: str, number: int) -> str:
    """An immutable generation, then the pointer to it."""
    path = f"{root}/generation={number}"
    df.write.mode("errorifexists").parquet(path)
    df.sparkSession.createDataFrame([(number,)], "generation int").coalesce(1).write.mode("overwrite").json(f"{root}/latest")
    return path


def _small(df: DataFrame, limit: int) -> list[tuple]:
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; write CSV instead")
    return [tuple(r) for r in rows]


def _sheet(header: list[str], rows: Iterable[tuple]) -> str:
    def cell(v: object) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, bool) or not isinstance(v, (int, float)):
            return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'
        return f"<c><v>{v}</v></c>"

    body = "".join(f"<row>{''.join(map(cell, r))}</row>" for r in (header, *rows))
    return f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>'


def workbook(path: str, sheets: dict[str, DataFrame], limit: int = SHEET_ROWS) -> None:
    """A spreadsheet file of small results, one sheet each."""
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    names = list(sheets)
    part = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    types = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{part}.worksheet+xml"/>' for i in range(1, len(names) + 1))
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'<?xml version="1.0"?><Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{part}.sheet.main+xml"/>{types}</Types>')
        z.writestr("_rels/.rels", f'<?xml version="1.0"?><Relationships xmlns="{package}/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n)[:31]}" sheetId="{i}" r:id="r{i}"/>' for i, n in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0"?><Relationships xmlns="{package}/relationships">{links}</Relationships>')
        for i, n in enumerate(names, 1):
            z.writestr(f"xl/worksheets/sheet{i}.xml", _sheet(sheets[n].columns, _small(sheets[n], limit)))


def html_report(path: str, title: str, sections: dict[str, DataFrame], limit: int = 500) -> None:
    """A page of tables that needs nothing else; all text is escaped."""
    parts = []
    for name, df in sections.items():
        head = "".join(f"<th>{escape(c)}</th>" for c in df.columns)
        rows = "".join("<tr>" + "".join(f"<td>{escape('-' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in _small(df, limit))
        parts.append(f"<section><h2>{escape(name)}</h2><table><tr>{head}</tr>{rows}</table></section>")
    page = f'<!doctype html><html><head><meta charset="utf-8"><title>{escape(title)}</title></head><body><h1>{escape(title)}</h1>{"".join(parts)}</body></html>'
    Path(path).write_text(page, encoding="utf-8")


def markdown_report(path: str, title: str, sections: dict[str, DataFrame], limit: int = 50) -> None:
    """Tables of Markdown; sections longer than ``limit`` say how many rows are left."""
    out = [f"# {title}", ""]
    for name, df in sections.items():
        total = df.agg(F.count("*")).first()[0]
        rows = df.limit(limit).collect()
        out += [f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        out += ["| " + " | ".join("-" if v is None else str(v).replace("|", "\\|") for v in r) + " |" for r in rows]
        out += [f"... and {total - limit} more" if total > limit else "", ""]
    Path(path).write_text("\n".join(out), encoding="utf-8")
