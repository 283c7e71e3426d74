"""Data source ``snapshot``: tables of a sealed SQLite file, scanned by ranges of row ids.

A sealed file has no journal beside it and is opened as immutable, so all partitions read
one state. Options: path, table, parts (ranges of row ids), push. With push, comparisons
with constants are passed down to the file; Spark applies them again, as types of a column
may vary by row. Ask for it only where a plan reads the relation once: Spark keeps what is
pushed with the relation, so a second branch of the same plan would get it too. The table ``#checks`` has a row (check,
detail) for each thing that is wrong with the file itself. Values are cast to the schema
that is asked for.
"""

from __future__ import annotations

import os
import sqlite3
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

BATCH = 5000
CHECKS = "#checks"
_SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def journals(path: str) -> list[str]:
    return [s for s in ("-wal", "-shm", "-journal") if os.path.exists(path + s)]


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def _name(column: str) -> str:
    return '"' + column.replace('"', '""') + '"'


def _kind(t: DataType) -> str:
    return "INTEGER" if isinstance(t, (LongType, IntegerType)) else "REAL" if isinstance(t, DoubleType) else "TEXT"


@dataclass
class Rows(InputPartition):
    low: int | None
    high: int | None


class SnapshotReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.table, self.parts = options["path"], options["table"], int(options.get("parts", 1))
        self.schema, self.where, self.values = schema, [], []

    def partitions(self) -> list[Rows]:
        if self.table == CHECKS or self.parts == 1:
            return [Rows(None, None)]
        db = _open(self.path)
        try:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        finally:
            db.close()
        if low is None:
            return [Rows(None, None)]
        edges = [low + (high + 1 - low) * k // self.parts for k in range(self.parts + 1)]
        return [Rows(a, b) for a, b in zip(edges, edges[1:]) if a < b]

    def read(self, partition: Rows) -> Iterator[tuple]:
        if self.table == CHECKS:
            yield from self._checks()
            return
        if found := journals(self.path):
            raise ValueError(f"not a sealed snapshot: {found}")
        where, values = list(self.where), list(self.values)
        if partition.low is not None:
            where.append("rowid >= ? AND rowid < ?")
            values += [partition.low, partition.high]
        columns = ", ".join(f"CAST({_name(f.name)} AS {_kind(f.dataType)})" for f in self.schema)
        db = _open(self.path)
        try:
            cursor = db.execute(f"SELECT {columns} FROM {_name(self.table)}" + (f" WHERE {' AND '.join(f'({w})' for w in where)}" if where else ""), values)
            while rows := cursor.fetchmany(BATCH):
                yield from rows
        finally:
            db.close()

    def _checks(self) -> Iterator[tuple]:
        if found := journals(self.path):
            yield "unsealed", " ".join(found)
        try:
            db = _open(self.path)
            try:
                for (said,) in db.execute("PRAGMA quick_check"):
                    if said != "ok":
                        yield "unsound", said
            finally:
                db.close()
        except sqlite3.DatabaseError as e:
            yield "unsound", str(e)


class PushingReader(SnapshotReader):
    """Takes filters; a class of its own, as Spark refuses it unless its setting allows that."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            kind = _kind(self.schema[f.attribute[0]].dataType) if len(getattr(f, "attribute", ())) == 1 else None
            column = f"CAST({_name(f.attribute[0])} AS {kind})" if kind else ""
            if kind and isinstance(f, IsNotNull):
                self.where.append(f"{column} IS NOT NULL")
            elif kind and isinstance(f, In) and all(isinstance(v, (str, int)) for v in f.value):
                self.where.append(f"{column} IN ({', '.join('?' * len(f.value))})")
                self.values += f.value
            elif kind and type(f) in _SIGNS and isinstance(f.value, (str, int)) and (kind != "TEXT" or isinstance(f, EqualTo)):
                self.where.append(f"{column} {_SIGNS[type(f)]} ?")
                self.values.append(f.value)
            yield f


class SnapshotSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "snapshot"

    def schema(self) -> StructType:
        if self.options["table"] == CHECKS:
            return StructType([StructField("check", StringType()), StructField("detail", StringType())])
        db = _open(self.options["path"])
        try:
            columns = db.execute(f"PRAGMA table_info({_name(self.options['table'])})").fetchall()
        finally:
            db.close()
        kind = lambda t: LongType() if "INT" in t else DoubleType() if any(x in t for x in ("REAL", "FLOA", "DOUB")) else StringType()
        return StructType([StructField(c[1], kind((c[2] or "").upper())) for c in columns])

    def reader(self, schema: StructType) -> SnapshotReader:
        return (PushingReader if self.options.get("push") == "true" else SnapshotReader)(dict(self.options), schema)


def read(spark: SparkSession, path: str, table: str, schema: str | None = None, parts: int = 1, push: bool = False) -> DataFrame:
    spark.dataSource.register(SnapshotSource)
    if push:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("snapshot").option("path", path).option("table", table).option("parts", parts).option("push", push)
    return (reader.schema(schema) if schema else reader).load()
