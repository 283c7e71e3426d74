"""Embedding near-duplicates by cross-polytope hashing.

A table hashes a unit vector ``K`` times: three rounds of random signs and a fast
Hadamard transform, then the largest coordinate and its sign. The runner-up
coordinates give further probes. K grows with the logarithm of the number of vectors,
so buckets stay small. Rows meet where one's own bucket is among the other's probes,
and the cosine is computed in double precision on the vectors themselves.

A pair counts in the first table and bucket where it meets, so links add up without
pairs ever being written: a task turns a bucket into counts per vector and into links
that span the components it sees. A bucket above ``BLOCK_ROWS`` members is dealt as
pairs of blocks. Equal vectors are one node with a weight.

Vectors of every length are searched among their own: the length is part of the table's
number, and K and the tables follow from how many vectors have it.

Cases: a vector that is null, empty or zero or holds null or non-finite components links
with nothing and is its own component; ids should be unique (rows with one id share its
links); null ids never link; an empty table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from collections.abc import Iterator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import materialize, partitions, scratch, shuffled, table
from .components import components

COSINE = 0.9
TABLES, PROBES = 12, 6
#: Further tables for each K above 3, as a factor: a table then finds fewer of the pairs.
MORE_TABLES = 2.5
BLOCK_ROWS = 1500
#: Vectors per bucket that K aims at, were they spread evenly.
MEAN_BUCKET = 4
#: Places of vectors in buckets that a task compares.
TASK_PLACEMENTS = 50_000


def tables_for(k: int, tables: int = TABLES) -> int:
    return tables if k <= 3 else round(tables * MORE_TABLES ** (k - 3))


def _rotate(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Three rounds of signs and the normalised Walsh-Hadamard transform; columns a power of two."""
    n, d = x.shape
    for s in signs:
        x = (x * s).reshape(n, d)
        width = 1
        while width < d:
            y = x.reshape(n, d // (2 * width), 2, width)
            x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
            width *= 2
        x = x / np.sqrt(d)
    return x


def hashes(x: np.ndarray, k: int, tables: int = TABLES, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """(rows, tables, 1 + probes) bucket numbers; the first is a row's own."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    rng = np.random.default_rng(seed)
    out = np.zeros((n, tables, 1 + probes), np.int64)
    choices = min(d, 1 + probes)
    for t in range(tables):
        code, loss = [], []
        for _ in range(k):
            y = _rotate(padded, rng.choice([-1.0, 1.0], (3, d)))
            top = np.argpartition(-np.abs(y), choices - 1, axis=1)[:, :choices]
            size = np.take_along_axis(np.abs(y), top, 1)
            by = np.argsort(-size, axis=1, kind="stable")
            top, size = np.take_along_axis(top, by, 1), np.take_along_axis(size, by, 1)
            code.append(top * 2 + (np.take_along_axis(y, top, 1) < 0))
            loss.append((size[:, :1] - size) ** 2)
        own = np.zeros(n, np.int64)
        for c in code:
            own = own * (2 * d) + c[:, 0]
        out[:, t, 0] = own
        # single replacements, the cheapest first
        cost = np.concatenate([x[:, 1:] for x in loss], axis=1)
        scale = [(2 * d) ** (k - 1 - i) for i in range(k)]
        change = np.concatenate([(c[:, 1:] - c[:, :1]) * s for c, s in zip(code, scale)], axis=1)
        pick = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        got = np.take_along_axis(change, pick, 1)
        out[:, t, 1 : 1 + got.shape[1]] = own[:, None] + got
        out[:, t, 1 + got.shape[1] :] = own[:, None]
    return out


def _meet(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First table in which pairs meet, and the bucket: a's own if b probes it, else b's own.

    a, b: codes (pairs, tables, 1 + probes).
    """
    first = (b == a[:, :, :1]).any(2)
    second = (a == b[:, :, :1]).any(2)
    t = (first | second).argmax(1)
    row = np.arange(len(t))
    return t, np.where(first[row, t], a[row, t, 0], b[row, t, 0])


def _pairs(x: np.ndarray, codes: np.ndarray, own: np.ndarray, first: np.ndarray, second: np.ndarray, t: int, bucket: int, cosine: float):
    """Linked pairs of a bucket (or of two of its blocks) that meet here first; row numbers."""
    found_a, found_b = [], []
    for at in range(0, len(first), 512):
        f = first[at : at + 512]
        i, j = np.nonzero(x[f] @ x[second].T >= cosine)
        i, j = f[i], second[j]
        # rows are in id order; one of a pair stands in its own bucket
        use = (i < j) & (own[i] | own[j])
        i, j = i[use], j[use]
        if len(i):
            tt, bb = _meet(codes[i], codes[j])
            use = (tt == t) & (bb == bucket)
            found_a.append(i[use])
            found_b.append(j[use])
    none = np.zeros(0, np.int64)
    return (np.concatenate(found_a), np.concatenate(found_b)) if found_a else (none, none)


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest row that each of n rows reaches."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def neighbours(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding", cosine: float = COSINE,
               tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors``."""
    with scratch():
        every, named = _neighbours(vectors, vec_id, vector, cosine, tables, probes)
    void = every.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    found = every.where("sound").join(shuffled(named), "v").select("vec_id", "n_links", "component_id").unionByName(void)
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _neighbours(vectors: DataFrame, vec_id: str, vector: str, cosine: float, tables: int, probes: int) -> tuple[DataFrame, DataFrame]:
    """Rows (vec_id, v, sound), and n_links and component_id of every distinct sound vector."""
    narrow = vectors.schema[vector].dataType.elementType.typeName() == "float"
    kind = np.dtype("<f4") if narrow else np.dtype("<f8")  # floats travel as they are; cosines are in double precision
    every = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast(f"array<{'float' if narrow else 'double'}>").alias("v"))
    sound = (
        F.col("v").isNotNull() & F.col("vec_id").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
        & F.exists("v", lambda c: c != 0)
    )
    every = materialize(every.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors", lasting=True)
    nodes = every.where("sound").groupBy("v").agg(F.min("vec_id").alias("id"), F.countDistinct("vec_id").alias("copies"))
    nodes = materialize(nodes, "vector-nodes")
    # one row per length of vectors comes to the driver
    shapes = {r[0]: r[1] for r in nodes.groupBy(F.size("v")).count().collect()}
    ks = {}
    for dim, count in shapes.items():
        wide = 2 << max(1, (dim - 1).bit_length())
        ks[dim] = max(1, round(np.log(max(2, count / MEAN_BUCKET)) / np.log(wide)))
    #: bucket numbers take as few bytes as the widest needs
    widest = max((((2 << max(1, (d - 1).bit_length())) ** k) for d, k in ks.items()), default=1)
    number = np.dtype("<i2") if widest < 1 << 15 else np.dtype("<i4") if widest < 1 << 31 else np.dtype("<i8")

    def unit(x: np.ndarray) -> np.ndarray:
        x = x.astype(np.float64)
        x = x / np.abs(x).max(1, keepdims=True)
        return x / np.sqrt((x * x).sum(1, keepdims=True))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                sizes = pa.compute.list_value_length(part.column("v")).to_numpy()
                for dim in np.unique(sizes).tolist():
                    own = part.filter(pa.array(sizes == dim))
                    x = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                    c = hashes(unit(x), ks[dim], tables_for(ks[dim], tables), probes)
                    yield pa.RecordBatch.from_arrays(
                        [own.column("id"), own.column("copies"), pa.array([dim] * len(x), pa.int32()), pa.array([r.tobytes() for r in x.astype(kind)], pa.binary()),
                         pa.array([r.tobytes() for r in c.reshape(len(x), -1).astype(number)], pa.binary()),
                         pa.FixedSizeListArray.from_arrays(pa.array(c.ravel()), c[0].size).cast(pa.list_(pa.int64()))],
                        ["id", "copies", "dim", "x", "codes", "places"],
                    )

    coded = nodes.select("id", "copies", "v").mapInArrow(code, "id long, copies long, dim int, x binary, codes binary, places array<long>")
    coded = materialize(coded, "vector-codes")
    # a table's number holds the length: vectors of different lengths never meet
    placed = coded.select("id", "dim", F.posexplode("places").alias("p", "bucket")).select(
        "id", F.expr(f"cast(dim as bigint) * {1 << 20} + p div {1 + probes}").alias("t"), "bucket", (F.col("p") % (1 + probes) == 0).alias("own")
    )
    placed = placed.groupBy("id", "t", "bucket").agg(F.max("own").alias("own"))  # a probe may repeat
    sizes = placed.groupBy("t", "bucket").agg(F.count("*").alias("m"), F.max("own").alias("some")).where("m > 1 and some")
    met = placed.join(shuffled(sizes.select("t", "bucket", F.expr(f"cast(ceil(m / {BLOCK_ROWS}) as int)").alias("b"))), ["t", "bucket"])
    dealt = met.withColumn("i", F.pmod(F.xxhash64("id"), F.col("b")).cast("int")).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("b") - 1))).select(
        "id", "own", "t", "bucket", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), (F.col("i") <= F.col("j")).alias("one"), (F.col("i") >= F.col("j")).alias("two")
    )
    placements = sum(n * tables_for(ks[d], tables) * (1 + probes) for d, n in shapes.items())
    tasks = max(1, min(placements, max(partitions(vectors.sparkSession), placements // TASK_PLACEMENTS)))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("t", "bucket", "i", "j"), F.lit(tasks)).cast("int"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket and block pair; a group ends where the next begins."""

        def groups() -> Iterator[pa.Table]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                key = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("t", "bucket", "i", "j")]
                if held and any(held[0].column(c)[0].as_py() != k[0] for c, k in zip(("t", "bucket", "i", "j"), key)):
                    yield pa.Table.from_batches(held)
                    held = []
                edge = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
                for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(batch)]):
                    if a and held:
                        yield pa.Table.from_batches(held)
                        held = []
                    held.append(batch.slice(a, b - a))
            if held:
                yield pa.Table.from_batches(held)

        for g in groups():
            if len(g) < 2:
                continue
            by = pa.compute.sort_indices(g.column("id"))
            g = g.take(by)
            x = unit(np.frombuffer(b"".join(g.column("x").to_pylist()), kind).reshape(len(g), -1))
            c = np.frombuffer(b"".join(g.column("codes").to_pylist()), number).reshape(len(g), -1, 1 + probes)
            own, one, two = (g.column(n).to_numpy(zero_copy_only=False).astype(bool) for n in ("own", "one", "two"))
            first, second = np.flatnonzero(one), np.flatnonzero(two)
            t, bucket = g.column("t")[0].as_py() & ((1 << 20) - 1), g.column("bucket")[0].as_py()
            a, b = _pairs(x, c, own, first, second, t, bucket, cosine)
            if g.column("i")[0].as_py() != g.column("j")[0].as_py():  # across blocks a pair may stand either way
                other = _pairs(x, c, own, second, first, t, bucket, cosine)
                a, b = np.concatenate([a, other[0]]), np.concatenate([b, other[1]])
            if not len(a):
                continue
            copies, ids = g.column("copies").to_numpy().astype(np.float64), g.column("id").to_numpy()
            n = np.bincount(a, copies[b], len(g)) + np.bincount(b, copies[a], len(g))
            root = _spanning(a, b, len(g))
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(ids[seen]), pa.array(n[seen].astype(np.int64)), pa.array(ids[root[seen]])], ["id", "n", "root"])

    full = dealt.join(shuffled(coded.select("id", "copies", "x", "codes")), "id")
    full = full.repartition(tasks, "task").sortWithinPartitions("t", "bucket", "i", "j").drop("task")
    got = materialize(full.mapInArrow(link, "id long, n long, root long"), "vector-links")
    counts = got.groupBy("id").agg(F.sum("n").alias("n"))
    parts = components(got.select(F.col("id").alias("a"), F.col("root").alias("b"))).select(F.col("node").alias("id"), F.col("component"))
    named = nodes.join(shuffled(counts), "id", "left").join(shuffled(parts), "id", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")
    )
    return every, materialize(named, "vector-names", lasting=True)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(table(spark, sf_dir, "embeddings"))


QUERIES = {"op7_embedding_near_dedup": op7_embedding_near_dedup}
#: All pairs of vectors of equal length.
ORACLES = {
    "op7_embedding_near_dedup": f"""
WITH RECURSIVE every AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings),
sound AS (SELECT vec_id, v FROM every WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM sound a JOIN sound b ON len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= {COSINE}),
reach AS (SELECT vec_id, vec_id AS root FROM every UNION SELECT l.y, r.root FROM reach r JOIN links l ON l.x = r.vec_id),
roots AS (SELECT vec_id, min(root) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT r.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, r.vec_id = r.component_id AS kept FROM roots r LEFT JOIN counts c ON c.x = r.vec_id
"""
}
