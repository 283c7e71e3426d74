"""Content-addressed store of token ids.

A rolling hash over the last ids decides where a document's ids are cut, so equal
passages give equal chunks wherever they stand. Layout of a store folder:

``chunks``    (hash, n, body, uses): a body, zstd over little-endian ids of 16 or 32
              bits, is stored with exactly one row of its hash; ``uses`` lists
              (doc_id, row, idx). Other rows of the hash carry further uses.
``recipes``   (part, pos, doc_id, row, n_tokens, chunks, root) in ascending doc_id
              order; ``chunks`` lists hashes and lengths, ``root`` hashes them.
``manifest``  (part, first, docs, tokens, root): a Merkle tree over document roots
              with nodes of ``FANOUT`` children; ``first`` is the id position of the part.
``root``      (root): the tree goes on over the parts up to a single root.

Every way of reading verifies: bodies against their hashes, each document's root and
length against its chunks, the manifest and the single root against the recipes; a
missing body, a swapped chunk or a lost recipe makes the read fail.
A task reports one row per hash and block of texts. Only rows with a body meet by hash,
at most one per hash and task and with few uses; a chunk that a third of all documents
share is no hot group when written, and when read its uses are split by the skew join.

Cases: a null or empty text is its end id alone; rows of equal doc_id are stored in
file order; null doc_id comes first; an empty table gives an empty store; other columns
do not matter.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import fresh_path, partitions, table
from ._vec import blocks, prefix_hash, range_hash
from .packing import END_ID, with_end
from .tokens import TOKEN_BLOCK, encoder, vocabulary

WINDOW = 16
MEAN_IDS, LEAST_IDS, MOST_IDS = 512, 128, 2048
FANOUT = 1024
#: Hashes a task remembers so as to send a body once; beyond, it starts anew.
SEEN = 200_000
#: Uses that travel with a body; further ones of a block form a row of their own.
USES = 16
#: Groups among which rows without a body are dealt.
SALTS = 4096

CHUNKS = "hash binary, n int, body binary, uses array<struct<doc_id:bigint,row:bigint,idx:int>>"


def cuts(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chunk edges (start of each chunk, then the end), and each document's first chunk."""
    h = prefix_hash(ids)
    at = np.arange(len(ids))
    doc_start = np.repeat(first[:-1], np.diff(first))
    rolling = range_hash(h, np.maximum(doc_start, at - WINDOW + 1), at + 1)
    wanted = (np.flatnonzero((rolling & np.uint64(MEAN_IDS - 1)) == 0) + 1).tolist()
    edges, count, k = [], [], 0
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        before = len(edges)
        edges.append(lo)
        while k < len(wanted) and wanted[k] < hi:
            cut = wanted[k]
            while cut - edges[-1] > MOST_IDS:
                edges.append(edges[-1] + MOST_IDS)
            if cut - edges[-1] >= LEAST_IDS:
                edges.append(cut)
            k += 1
        while hi - edges[-1] > MOST_IDS:
            edges.append(edges[-1] + MOST_IDS)
        if k < len(wanted) and wanted[k] == hi:
            k += 1
        count.append(len(edges) - before)
    edges.append(len(ids))
    return np.array(edges, np.int64), np.concatenate([[0], np.cumsum(count)]).astype(np.int64)


def chunks(docs: DataFrame, *, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per chunk hash and block of texts; the body with a task's first row of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, squeeze = encoder(path or vocabulary()), zstandard.ZstdCompressor(3)
        row, seen = TaskContext.get().partitionId() << 40, set()
        for batch in batches:
            doc_id = batch.column(0)
            for block in blocks(batch.column(1), TOKEN_BLOCK):
                ids, first = with_end(*enc.encode(block), end_id)
                edges, chunk_of = cuts(ids, first)
                narrow = ids.astype("<u2") if len(ids) == 0 or int(ids.max()) < 1 << 16 else ids
                raw, width = memoryview(narrow.tobytes()), narrow.itemsize
                number: dict[bytes, int] = {}
                hashes, lengths, bodies, group = [], [], [], []
                e = edges.tolist()
                for a, b in zip(e[:-1], e[1:]):
                    body = raw[a * width : b * width]
                    key = blake2b(body, digest_size=16).digest()
                    if (k := number.setdefault(key, len(number))) == len(hashes):
                        hashes.append(key)
                        lengths.append(b - a)
                        bodies.append(None if key in seen else squeeze.compress(body))
                        seen.add(key)
                    group.append(k)
                if len(seen) > SEEN:
                    seen.clear()
                doc = np.repeat(np.arange(len(first) - 1), np.diff(chunk_of))
                order = np.argsort(np.array(group, np.int64), kind="stable")
                struct = pa.StructArray.from_arrays(
                    [
                        doc_id.take(pa.array(doc[order] + block.first)),
                        pa.array(row + block.first + doc[order]),
                        pa.array((np.arange(len(doc)) - chunk_of[:-1][doc])[order], pa.int32()),
                    ],
                    ["doc_id", "row", "idx"],
                )
                uses = np.bincount(group, minlength=len(hashes))
                # a body takes few uses along; the rest of a frequent chunk goes without it
                more = np.flatnonzero((uses > USES) & np.array([x is not None for x in bodies], bool))
                source = np.sort(np.concatenate([np.arange(len(hashes)), more]))
                second = np.append(False, source[1:] == source[:-1])
                length = uses[source]
                length[second] -= USES
                length[:-1][second[1:]] = USES
                at = source.tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hashes[k] for k in at], pa.binary()),
                        pa.array([lengths[k] for k in at], pa.int32()),
                        pa.array([None if again else bodies[k] for k, again in zip(at, second.tolist())], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), struct),
                    ],
                    ["hash", "n", "body", "uses"],
                )
            row += len(batch)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, CHUNKS)


def _root(items, of) -> F.Column:
    return F.sha2(F.array_join(F.transform(items, of), "").cast("binary"), 256)


def _manifest(recipes: DataFrame) -> DataFrame:
    leaves = recipes.groupBy("part", F.expr(f"pos div {FANOUT}").alias("node")).agg(
        F.count("*").alias("docs"),
        F.sum("n_tokens").alias("tokens"),
        _root(F.sort_array(F.collect_list(F.struct("pos", "root"))), lambda x: x["root"]).alias("root"),
    )
    parts = leaves.groupBy("part").agg(
        F.sum("docs").alias("docs"),
        F.sum("tokens").alias("tokens"),
        _root(F.sort_array(F.collect_list(F.struct("node", "root"))), lambda x: x["root"]).alias("root"),
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per part only
    return parts.withColumn("first", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _top(manifest: DataFrame) -> DataFrame:
    """The single root: nodes of FANOUT parts, then one over the nodes; each part with its place."""
    leaf = F.sha2(F.concat_ws(":", "part", "first", "docs", "tokens", "root").cast("binary"), 256)
    nodes = manifest.withColumn("leaf", leaf).groupBy(F.expr(f"part div {FANOUT}").alias("node")).agg(
        _root(F.sort_array(F.collect_list(F.struct("part", "leaf"))), lambda x: x["leaf"]).alias("root")
    )
    return nodes.agg(_root(F.sort_array(F.collect_list(F.struct("node", "root"))), lambda x: x["root"]).alias("root"))


def write(docs: DataFrame, path: str, *, end_id: int = END_ID, vocabulary_path: str | None = None) -> None:
    """Encodes documents (doc_id, text) into a store at ``path``."""
    spark = docs.sparkSession
    found = chunks(docs, end_id=end_id, path=vocabulary_path)
    first_row = F.get("uses", F.lit(0))["row"]
    salt = F.when(F.col("body").isNull(), F.pmod(F.xxhash64(first_row), F.lit(SALTS))).otherwise(-1)
    once = Window.partitionBy("hash", "__salt").orderBy("__row")
    placed = found.withColumn("__salt", salt).withColumn("__row", first_row).withColumn("__n", F.row_number().over(once))
    placed.withColumn("body", F.when(F.col("__n") == 1, F.col("body"))).drop("__n", "__row", "__salt").write.parquet(f"{path}/chunks")
    used = spark.read.parquet(f"{path}/chunks").select("hash", "n", F.explode("uses").alias("u"))
    listed = used.groupBy(F.col("u.doc_id").alias("doc_id"), F.col("u.row").alias("row")).agg(
        F.sort_array(F.collect_list(F.struct(F.col("u.idx").alias("idx"), "hash", "n"))).alias("chunks")
    )
    ordered = (
        listed.withColumn("n_tokens", _tokens(F.col("chunks")))
        .withColumn("root", _document_root(F.col("chunks")))
        .repartitionByRange(partitions(spark), "doc_id", "row")
        .sortWithinPartitions("doc_id", "row")
    )
    numbered = ordered.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    numbered.write.parquet(f"{path}/recipes")
    _manifest(spark.read.parquet(f"{path}/recipes")).write.parquet(f"{path}/manifest")
    _top(spark.read.parquet(f"{path}/manifest")).write.parquet(f"{path}/root")


def _tokens(chunks_: F.Column) -> F.Column:
    return F.aggregate(chunks_, F.lit(0).cast("long"), lambda a, x: a + x["n"])


def _document_root(chunks_: F.Column) -> F.Column:
    return _root(chunks_, lambda x: F.hex(x["hash"]))


def _verified_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(part, first) of parts that follow from their recipes and lead to the single root; fails otherwise."""
    again = _manifest(spark.read.parquet(f"{path}/recipes")).select("part", F.struct("docs", "tokens", "root", "first").alias("again"))
    saved = spark.read.parquet(f"{path}/manifest").select("part", F.struct("docs", "tokens", "root", "first").alias("saved"))
    top = spark.read.parquet(f"{path}/root").select(F.col("root").alias("top"))
    single = _top(spark.read.parquet(f"{path}/manifest")).select(F.col("root").alias("top_again"))
    tops = single.join(top, F.lit(True), "full_outer")  # one row on either side
    both = again.join(saved, "part", "full_outer").join(F.broadcast(tops), F.lit(True), "left")
    sound = F.col("again").eqNullSafe(F.col("saved")) & F.col("top").eqNullSafe(F.col("top_again"))
    return both.select("part", F.when(sound, F.col("saved.first")).otherwise(F.raise_error(F.concat(F.lit("store manifest does not match its recipes: part "), "part"))).alias("first"))


def recipes(spark: SparkSession, path: str) -> DataFrame:
    """Verified recipes with ``start``, the ids of all documents before it."""
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    sound = (F.col("root") == _document_root(F.col("chunks"))) & (F.col("n_tokens") == _tokens(F.col("chunks")))
    r = spark.read.parquet(f"{path}/recipes")
    r = r.withColumn("n_tokens", F.when(sound, F.col("n_tokens")).otherwise(F.raise_error(F.concat(F.lit("recipe does not match its root: row "), "row"))))
    r = r.withColumn("__in", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    # a part that only one side knows fails in the manifest's own check, which the full join forces
    whole = r.join(_verified_manifest(spark, path), "part", "full_outer")
    return whole.where("row is not null").withColumn("start", F.col("first") + F.col("__in")).drop("__in", "first")


def damaged(spark: SparkSession, path: str) -> DataFrame:
    """Parts whose manifest doesn't follow from their recipes; no rows for a sound store."""
    again = _manifest(spark.read.parquet(f"{path}/recipes"))
    return spark.read.parquet(f"{path}/manifest").exceptAll(again.select("part", "docs", "tokens", "root", "first")).select("part")


def _with_bodies(r: DataFrame, bodies: DataFrame, value: str) -> DataFrame:
    """Recipes with x, their chunks (idx, value, n) in order; a missing or repeated body fails."""
    parts = r.select("doc_id", "row", "start", "n_tokens", F.size("chunks").alias("chunks"), F.explode("chunks").alias("c"))
    parts = parts.select("doc_id", "row", "start", "n_tokens", "chunks", F.col("c.idx").alias("idx"), F.col("c.hash").alias("hash"), F.col("c.n").alias("n"))
    found = parts.join(bodies, "hash", "left")
    got = F.when(F.col(value).isNotNull(), F.col(value)).otherwise(F.raise_error(F.concat(F.lit("no body for chunk "), F.hex("hash"))))
    whole = found.withColumn(value, got).groupBy("doc_id", "row", "start", "n_tokens", "chunks").agg(F.sort_array(F.collect_list(F.struct("idx", value, "n"))).alias("x"))
    complete = F.when(F.size("x") == F.col("chunks"), F.col("x")).otherwise(F.raise_error(F.concat(F.lit("chunks of row "), "row", F.lit(" are not complete"))))
    return whole.withColumn("x", complete).drop("chunks")


def _body(hash_: bytes, n: int, body: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(body)
    if blake2b(raw, digest_size=16).digest() != hash_ or len(raw) not in (2 * n, 4 * n):
        raise ValueError(f"chunk {hash_.hex()} does not match its hash")
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")


def read(spark: SparkSession, path: str) -> DataFrame:
    """Documents rebuilt from a store: doc_id, row, start, n_tokens, ids (little-endian 32 bits)."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [_body(*x).tobytes() for x in zip(*(b.column(c).to_pylist() for c in ("hash", "n", "body")))]
            yield pa.RecordBatch.from_arrays([b.column("hash"), pa.array(ids, pa.binary())], ["hash", "ids"])

    bodies = spark.read.parquet(f"{path}/chunks").where("body is not null").select("hash", "n", "body").mapInArrow(unpack, "hash binary, ids binary")
    whole = _with_bodies(recipes(spark, path), bodies, "ids")
    return whole.withColumn("ids", F.expr("unhex(array_join(transform(x, y -> hex(y.ids)), ''))")).drop("x")


def _shift_table(most: int) -> np.ndarray:
    """[ids, bit] -> what a CRC-32 bit becomes after so many 4-byte zero words."""
    row = np.array([1 << b for b in range(32)], np.uint32)
    byte = np.array([zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)], np.uint32)
    out = np.zeros((most + 1, 32), np.uint32)
    out[0] = row
    for i in range(1, most + 1):
        for _ in range(4):
            row = byte[row & 0xFF] ^ (row >> np.uint32(8))
        out[i] = row
    return out


def join_crcs(crc: np.ndarray, n: np.ndarray, first: np.ndarray, most: int = MOST_IDS) -> np.ndarray:
    """CRC-32 of each document from those of its chunks (crc, n of 32-bit ids), in order."""
    table_ = _shift_table(most)
    total = np.zeros(len(first) - 1, np.uint32)
    count, step = np.diff(first), 0
    live = np.flatnonzero(count > 0)
    while len(live):
        at = first[:-1][live] + step
        now, moved = total[live], np.zeros(len(live), np.uint32)
        shift = table_[n[at]]
        for b in range(32):
            moved ^= np.where((now >> np.uint32(b)) & 1, shift[:, b], 0).astype(np.uint32)
        total[live] = moved ^ crc[at]
        step += 1
        live = live[count[live] > step]
    return total


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from the files; bodies are read and checked where they lie."""

    def crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(_body(*x).tobytes()) for x in zip(*(b.column(c).to_pylist() for c in ("hash", "n", "body")))]
            yield pa.RecordBatch.from_arrays([b.column("hash"), pa.array(crc, pa.int64())], ["hash", "crc"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column("x")
            flat, first = x.flatten(), np.concatenate([[0], np.cumsum(x.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            crc, n = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("crc", "n"))
            total = join_crcs(crc.astype(np.uint32), n, first)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(total.astype(np.int64))], ["doc_id", "start", "n_tokens", "ids_crc32"])

    sums = spark.read.parquet(f"{path}/chunks").where("body is not null").select("hash", "n", "body").mapInArrow(crcs, "hash binary, crc long")
    whole = _with_bodies(recipes(spark, path), sums, "crc")
    return whole.select("doc_id", "start", "n_tokens", "x").mapInArrow(join, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "op5-store")
    write(table(spark, sf_dir, "documents"), path)
    return digests(spark, path)


QUERIES = {"op5_token_store": op5_token_store}
ORACLES: dict[str, str] = {}
