"""Media columns: payloads in archives of images, read through a Python data source.

Format ``media_archive`` writes rows (doc_id, payload) as members of ZIP archives, each
member a PNG image of 8-bit grey samples, ``WIDTH`` a row, and lists the archives in a
manifest once all tasks have ended. Reading plans byte ranges over the archives: a
member belongs to the range its header starts in, found in the archive's central
directory. Members come as Arrow batches. A member that can't be read or fails its
checksum is tried again by its own offset, ``TRIES`` times, while the others go on; then
its row carries the error and no media.

Cases: null and empty payloads become ``WIDTH`` zero bytes; longer ones are padded with
zeros to whole rows and keep their length; null ids stay null; equal payloads give
equal images; an empty table gives no archives.
"""

from __future__ import annotations

import json
import posixpath
import struct
import time
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from ._spark import fresh_path, table

WIDTH = 64
SHARD_BYTES, RANGE_BYTES = 64 << 20, 8 << 20
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000
TRIES, PAUSE_S = 3, 0.2
LEVEL = 3
MANIFEST = "_archives.json"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


def _chunk(kind: bytes, body: bytes) -> bytes:
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def padded(payload: bytes) -> bytes:
    return payload + b"\0" * (-len(payload) % WIDTH if payload else WIDTH)


def to_png(payload: bytes) -> bytes:
    """Grey image of a payload whose length is a positive multiple of WIDTH."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)  # each line starts with filter 0: as it is
    lines[:, 1:] = rows
    head = struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)
    return _SIGNATURE + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(lines.tobytes(), LEVEL)) + _chunk(b"IEND", b"")


def from_png(media: bytes) -> np.ndarray:
    """Samples (rows, WIDTH) of an image as ``to_png`` makes them; a damaged one raises ValueError."""
    if media[:8] != _SIGNATURE:
        raise ValueError("not a PNG image")
    at, parts = 8, {}
    while at < len(media):
        (n,) = struct.unpack_from(">I", media, at)
        kind, body = media[at + 4 : at + 8], media[at + 8 : at + 8 + n]
        if struct.unpack_from(">I", media, at + 8 + n)[0] != zlib.crc32(kind + body):
            raise ValueError(f"damaged chunk {kind!r}")
        parts[kind] = parts.get(kind, b"") + body
        at += 12 + n
    width, height, *rest = struct.unpack(">IIBBBBB", parts[b"IHDR"])
    lines = np.frombuffer(zlib.decompress(parts[b"IDAT"]), np.uint8).reshape(height, width + 1)
    if rest != [8, 0, 0, 0, 0] or lines[:, 0].any():
        raise ValueError("not an unfiltered 8-bit grey image")
    return lines[:, 1:]


def feature(samples: np.ndarray) -> str:
    """Mean and deviation of samples and a 64-bit average hash over an 8 by 8 grid."""
    x = samples.astype(np.float64)
    edge = np.linspace(0, len(x), 9).astype(int)
    bands = np.add.reduceat(np.concatenate([x, np.zeros((1, x.shape[1]))]), np.minimum(edge[:-1], len(x)), axis=0)
    size = np.maximum(np.diff(edge), 1)[:, None] * (WIDTH // 8)
    grid = bands.reshape(8, 8, WIDTH // 8).sum(2) / size
    bits = int("".join("1" if v else "0" for v in (grid >= grid.mean()).ravel()), 2)
    return f"{x.mean():.4f}:{x.std():.4f}:{bits:016x}"


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return pafs.FileSystem.from_uri(uri)


@dataclass
class _Written(WriterCommitMessage):
    archives: list[tuple[str, int, int]]  # name, bytes, members


class _Writer(DataSourceArrowWriter):
    def __init__(self, uri: str):
        self.uri = uri

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        store, path = _store(self.uri)
        store.create_dir(path, recursive=True)
        stem = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
        done: list[tuple[str, int, int]] = []
        sink = archive = None
        members = row = 0

        def close() -> None:
            nonlocal archive
            if archive is not None:
                archive.close()
                size = sink.tell()
                sink.close()
                done.append((name, size, members))
                archive = None

        for batch in iterator:
            for doc_id, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if archive is None:
                    name, members = f"{stem}-{len(done):04d}.zip", 0
                    sink = store.open_output_stream(posixpath.join(path, name))
                    archive = zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED)
                payload = payload or b""
                info = zipfile.ZipInfo(f"{row:09d}.png")
                info.comment = json.dumps([doc_id, len(payload)]).encode()
                archive.writestr(info, to_png(padded(payload)))
                members, row = members + 1, row + 1
                if sink.tell() >= SHARD_BYTES:
                    close()
        close()
        return _Written(done)

    def commit(self, messages: list[_Written]) -> None:
        store, path = _store(self.uri)
        store.create_dir(path, recursive=True)
        listed = [a for m in messages if m is not None for a in m.archives]
        with store.open_output_stream(posixpath.join(path, MANIFEST)) as out:
            out.write(json.dumps(sorted(listed)).encode())

    def abort(self, messages: list[_Written]) -> None:
        store, path = _store(self.uri)
        for name, *_ in (a for m in messages if m is not None for a in m.archives):
            store.delete_file(posixpath.join(path, name))


@dataclass
class _Range(InputPartition):
    archive: str
    start: int
    stop: int


class _Reader(DataSourceReader):
    def __init__(self, uri: str):
        self.uri = uri

    def partitions(self) -> list[_Range]:
        store, path = _store(self.uri)
        with store.open_input_stream(posixpath.join(path, MANIFEST)) as f:
            listed = json.loads(f.read())
        return [_Range(name, at, min(size, at + RANGE_BYTES)) for name, size, _ in listed for at in range(0, size, RANGE_BYTES)] or [_Range("", 0, 0)]

    def read(self, partition: _Range) -> Iterator[pa.RecordBatch]:
        if not partition.archive:
            return
        store, path = _store(self.uri)
        place = posixpath.join(path, partition.archive)
        with store.open_input_file(place) as f, zipfile.ZipFile(f) as archive:
            listed = [x for x in archive.infolist() if partition.start <= x.header_offset < partition.stop]
        rows, held = [], 0
        handle = store.open_input_file(place)
        for x in listed:
            media, error = None, None
            for attempt in range(TRIES):
                try:
                    media, error = _member(handle, x), None
                    break
                except (OSError, ValueError, struct.error) as e:
                    error = f"{type(e).__name__}: {e}"[:200]
                    time.sleep(PAUSE_S * attempt)
                    handle = store.open_input_file(place)  # only this member is read again
            doc_id, n = json.loads(x.comment or b"[null, 0]")
            rows.append((partition.archive, x.header_offset, doc_id, n, media, error))
            held += len(media or b"")
            if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)


def _member(handle, info: zipfile.ZipInfo) -> bytes:
    handle.seek(info.header_offset)
    head = handle.read(30)
    magic, name, extra = struct.unpack_from("<I", head)[0], *struct.unpack_from("<HH", head, 26)
    if magic != 0x04034B50:
        raise ValueError(f"no member at {info.header_offset}")
    handle.seek(info.header_offset + 30 + name + extra)
    media = handle.read(info.file_size)
    if len(media) != info.file_size or zlib.crc32(media) != info.CRC:
        raise ValueError(f"damaged member at {info.header_offset}")
    return media


_SCHEMA = "archive string, offset long, doc_id long, n_bytes long, media binary, error string"
_ARROW = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary()), ("error", pa.string())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


class MediaArchive(DataSource):
    """Data source ``media_archive``; option ``path`` is a folder that all executors see."""

    @classmethod
    def name(cls) -> str:
        return "media_archive"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"])


def write(docs: DataFrame, path: str, *, doc_id: str = "doc_id", payload: str = "text") -> None:
    docs.sparkSession.dataSource.register(MediaArchive)
    docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(payload).cast("binary").alias("payload")).write.format("media_archive").mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Members of the archives: archive, offset, doc_id, n_bytes, media, error."""
    spark.dataSource.register(MediaArchive)
    return spark.read.format("media_archive").load(path)


_FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, error string"


def described(members: DataFrame) -> DataFrame:
    """Digests and features of members; rows of unreadable ones have an error and nulls."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in _FEATURES.split(", ")]
        for batch in batches:
            rows = []
            for doc_id, n, media, error in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "n_bytes", "media", "error"))):
                got = (None,) * 6
                if error is None:
                    try:
                        samples = from_png(media)
                        raw = samples.tobytes()
                        got = (len(raw), sha256(raw).hexdigest(), zlib.crc32(raw[-WIDTH:]), len(media), sha256(media).hexdigest(), feature(samples))
                    except (ValueError, KeyError, struct.error, zlib.error) as e:
                        error = f"{type(e).__name__}: {e}"[:200]
                rows.append((doc_id, n, *got, error))
            types = [pa.string() if c.endswith("string") else pa.int64() for c in _FEATURES.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * len(names), types)], names)

    return members.select("doc_id", "n_bytes", "media", "error").mapInArrow(run, _FEATURES)


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "op3-archives")
    write(table(spark, sf_dir, "documents"), path)
    return described(read(spark, path))


QUERIES = {"op3_media_columns": op3_media_columns}
ORACLES: dict[str, str] = {}
