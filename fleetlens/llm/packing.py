"""Best-fit packing of token pieces into sequences.

What a sequence may hold depends on lengths only, and there are at most ``capacity``
of them: the plan is made on the histogram of lengths, exactly as if every piece had
been treated on its own. Pieces above a third of the capacity pair at most twice in a
bin, the longest first with the longest partner that fits (greedy matching); shorter
ones, longest first, go to the fullest bin they still fit. Equal steps are taken at
once: a bin pattern has a multiplicity. The r-th piece of a length then takes the r-th
place for that length; ranks come from prefix sums over hash buckets, so no task holds
all pieces of one length.

Cases: a null or empty text is its end id alone; equal rows are separate documents;
an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import materialize, table
from ._vec import blocks
from .tokens import TOKEN_BLOCK, encoder, vocabulary

CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def with_end(ids: np.ndarray, first: np.ndarray, end_id: int = END_ID) -> tuple[np.ndarray, np.ndarray]:
    """Appends the end id to every document."""
    docs = len(first) - 1
    out = np.insert(ids, first[1:], np.uint32(end_id)).astype("<u4")
    return out, first + np.arange(docs + 1)


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Token pieces of documents (doc_id, text); longer ones are cut, the first piece is the short one."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path or vocabulary())
        for batch in batches:
            doc_id, text = batch.column(0), batch.column(1)
            for block in blocks(text, TOKEN_BLOCK):
                ids, first = with_end(*enc.encode(block), end_id)
                count = np.diff(first)
                parts = -(-count // capacity)
                doc = np.repeat(np.arange(len(count)), parts)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
                short = count - (parts - 1) * capacity
                start = np.where(piece == 0, 0, short[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, short[doc], capacity)
                raw = memoryview(ids.tobytes())
                at = ((first[:-1][doc] + start) * 4).tolist()
                body = [raw[a : a + 4 * n] for a, n in zip(at, length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_id.take(pa.array(doc + block.first)),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array([zlib.crc32(b) for b in body], pa.int64()),
                        pa.array([bytes(b) for b in body] if keep_ids else [None] * len(body), pa.binary()),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    out = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)
    return out if keep_ids else out.drop("ids")


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """Bins for so many pieces of each length: (lengths in order, how many such bins)."""
    left = [0] * (capacity + 1)
    for length, n in counts.items():
        left[length] += n
    done: list[tuple[tuple[int, ...], int]] = []
    open_bins: list[list[tuple[tuple[int, ...], int]]] = [[] for _ in range(capacity + 1)]  # by free room
    large = capacity // 3  # lengths above it are large

    def put(pattern: tuple[int, ...], n: int, room: int) -> None:
        if n:
            (open_bins[room] if room else done).append((pattern, n) if room else (pattern, n))

    for a in range(capacity, large, -1):
        partner = min(capacity - a, a)
        while left[a]:
            while partner > large and not (left[partner] > (1 if partner == a else 0)):
                partner -= 1
            if partner <= large:
                put((a,), left[a], capacity - a)
                left[a] = 0
            else:
                n = left[a] // 2 if partner == a else min(left[a], left[partner])
                left[a] -= n
                left[partner] -= n
                put((a, partner), n, capacity - a - partner)
    for s in range(min(large, capacity), 0, -1):
        room = s
        while left[s]:
            while room <= capacity and not open_bins[room]:
                room += 1
            if room > capacity:
                each = capacity // s
                put((s,) * each, left[s] // each, capacity - each * s)
                if left[s] % each:
                    put((s,) * (left[s] % each), 1, capacity - left[s] % each * s)
                left[s] = 0
                break
            pattern, n = open_bins[room].pop()
            used = min(n, left[s])
            put(pattern, n - used, room)
            put((*pattern, s), used, room - s)
            left[s] -= used
            room = s if room - s >= s else room
    return done + [x for bins in open_bins for x in bins]


def slots(patterns: list[tuple[tuple[int, ...], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Places by (length, rank): the key of each run's first rank, its first sequence and its offset."""
    taken = [0] * (capacity + 1)
    rows, sequence = [], 0
    for pattern, n in patterns:
        offset = 0
        for length in pattern:
            rows.append(((length << 44) + taken[length], sequence - taken[length], offset))
            taken[length] += n
            offset += length
        sequence += n
    rows.sort()
    key, shift, offset = (np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3
    return {"key": key, "shift": shift, "offset": offset}


def ranked(items: DataFrame, length: str = "length") -> DataFrame:
    """Adds __rank from 0 among rows of equal length, in an order fixed by the rows."""
    names = [c for c in items.columns if items.schema[c].dataType.typeName() != "binary"]
    keyed = items.withColumn("__bucket", F.pmod(F.xxhash64(*names), F.lit(1024)))
    sums = keyed.groupBy(F.col(length).alias("__l"), F.col("__bucket").alias("__b")).count()
    before = Window.partitionBy("__l").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("__before", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    inside = Window.partitionBy(length, "__bucket").orderBy(*names)
    placed = keyed.withColumn("__rank", F.row_number().over(inside) - 1)
    return (
        placed.join(sums, (F.col(length) == F.col("__l")) & (F.col("__bucket") == F.col("__b")))
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .drop("__bucket", "__l", "__b", "__before")
    )


def place(items: DataFrame, *, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to rows with a length of 1 to ``capacity``.

    ``items`` should be cheap to read twice. The driver gets one count per length.
    """
    spark = items.sparkSession
    counts = {r[0]: r[1] for r in items.groupBy("length").count().collect()}
    where = spark.sparkContext.broadcast(slots(plan(counts, capacity), capacity))  # bounded by capacity, not by rows
    columns = [f for f in items.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns) + ", sequence_id long, offset long"

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = where.value
        for batch in batches:
            rank = batch.column("__rank").to_numpy(zero_copy_only=False)
            length = batch.column("length").to_numpy(zero_copy_only=False)
            at = np.searchsorted(s["key"], (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in columns] + [pa.array(s["shift"][at] + rank), pa.array(s["offset"][at])],
                [f.name for f in columns] + ["sequence_id", "offset"],
            )

    return ranked(items).mapInArrow(seat, schema)


def pack(docs: DataFrame, *, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """Packed pieces of documents: their ids (unless not kept), sequence and place in it."""
    return place(materialize(pieces(docs, capacity=capacity, end_id=end_id, path=path, keep_ids=keep_ids), "packing"), capacity=capacity)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), keep_ids=False)


QUERIES = {"op8_best_fit_packing": op8_best_fit_packing}
ORACLES: dict[str, str] = {}
