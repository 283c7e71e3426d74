"""Data source ``sqlite``: a table or query of an SQLite file, read-only.

Options: path, query (or table), and for parallel reads column, lower, upper and
parts over an integer column. Files must be on a path every executor sees; the
Python standard library reads them, so no driver is needed.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

BATCH = 5000


@dataclass
class _Part(InputPartition):
    where: str


def _open(path: str) -> sqlite3.Connection:
    db = sqlite3.connect(f"file:{path}?mode=ro", uri=True)
    db.execute("PRAGMA query_only = ON")
    db.execute("BEGIN")  # one consistent snapshot
    return db


def _query(options: dict[str, str]) -> str:
    return options.get("query") or f'SELECT * FROM "{options["table"]}"'


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.options, self.names = options, schema.fieldNames()

    def partitions(self) -> list[_Part]:
        o = self.options
        n = int(o.get("parts", 1))
        if n == 1 or "column" not in o:
            return [_Part("")]
        lo, hi = int(o["lower"]), int(o["upper"])
        edges = [lo + (hi - lo) * i // n for i in range(1, n)]
        c = f'"{o["column"]}"'
        cuts = [f"{c} < {edges[0]} OR {c} IS NULL", *(f"{c} >= {a} AND {c} < {b}" for a, b in zip(edges, edges[1:])), f"{c} >= {edges[-1]}"]
        return [_Part(f" WHERE {x}") for x in cuts]

    def read(self, partition: _Part) -> Iterator[tuple]:
        db = _open(self.options["path"])
        try:
            columns = ", ".join(f'"{n}"' for n in self.names)
            cursor = db.execute(f"SELECT {columns} FROM ({_query(self.options)}){partition.where}")
            while rows := cursor.fetchmany(BATCH):
                yield from rows
        finally:
            db.close()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        """Types by SQLite's affinity of declared types; computed columns are text."""
        db = _open(self.options["path"])
        try:
            cursor = db.execute(f"SELECT * FROM ({_query(self.options)}) LIMIT 1")
            names = [d[0] for d in cursor.description]
            declared = {}
            if "table" in self.options:
                declared = {r[1]: (r[2] or "").upper() for r in db.execute(f'PRAGMA table_info("{self.options["table"]}")')}
        finally:
            db.close()
        kind = lambda t: LongType() if "INT" in t else DoubleType() if any(x in t for x in ("REAL", "FLOA", "DOUB")) else BinaryType() if "BLOB" in t else StringType()
        return StructType([StructField(n, kind(declared.get(n, ""))) for n in names])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(dict(self.options), schema)


def read(spark, path: str, **options: str):
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").option("path", path)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()
