"""MinHash near-duplicates: BagMinHash signatures of word-shingle multisets.

A shingle of weight w owns the unit levels 0..w-1. Levels lie in intervals [0,1), [1,2),
[2,4), [4,8), ...; each carries a Poisson process whose rate is its length, seeded by
shingle and interval. A point of an interval longer than one level splits it in halves:
one keeps the point, the other draws its own next one; halves above w are dropped. So
only points that can still lower a register are made, whatever the weights, and equal
levels of two bags give equal points. A register keeps its earliest point; two bags
agree in a register with the probability of their weighted Jaccard similarity.

Search: equal texts are one node. Bands of ``ROWS`` registers make buckets; every
member of a bucket is verified against the bucket's first node, then, where that leaves
a bucket in several components, against its centre. What is still apart is compared
across components inside tasks, large buckets in pairs of blocks: pairs whose registers
agree often enough are verified until the components are joined, and only links leave
the task. So links that meet in a bucket aren't lost, pairs are never written, and a
bucket of copies costs a pair or two a member. Verification compares whole multisets of
shingles.

Cases: words are runs without ASCII white space, ASCII letters folded; a text of 1 to 4
words is one shingle; null and empty texts are equal texts and no near-duplicates of
others; rows with equal or null ids are separate; null ids come last as representatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import materialize, passing, scratch, table
from ._vec import Block, blocks, folded, gram_hash, mix, prefix_hash, range_hash, words
from .components import components

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS, ROWS = 96, 4
#: Least share of equal registers for a pair of the second search; five standard errors below SIMILARITY.
AGREEMENT = 0.6
#: Members of a bucket that one task compares with as many others.
BLOCK_ROWS = 1000
#: Shingles of a matrix product over such members; three matrices of members by shingles are held at once.
OVERLAP_ELEMENTS = 1024

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def shingles(block: Block, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of a block (repeats too), and each one's document."""
    start, end, first = words(block)
    h = prefix_hash(folded(block.data))
    return gram_hash(range_hash(h, start, end), first, n)


def bags(block: Block, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each document, their documents and weights."""
    h, doc = shingles(block, n)
    tied = mix(h ^ mix(doc.astype(np.uint64) * _GOLDEN))  # a key per document and shingle
    _, at, weight = np.unique(tied, return_index=True, return_counts=True)
    return h[at], doc[at], weight


def _seed(feature: np.ndarray, low: np.ndarray, size: np.ndarray) -> np.ndarray:
    return mix(feature ^ mix(low.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + size.astype(np.uint64)))


def _draw(seed: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A standard exponential and 64 further bits for a process's point."""
    x = mix(seed + (step.astype(np.uint64) + np.uint64(1)) * _GOLDEN)
    gap = -np.log((np.right_shift(x, np.uint64(11)) + np.uint64(1)).astype(np.float64) * 2.0**-53)
    return gap, mix(x ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def signatures(feature: np.ndarray, doc: np.ndarray, weight: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """BagMinHash signatures (docs, registers) of 32-bit point identities; rows of empty bags are 0."""
    time, name = np.full(docs * registers, np.inf), np.zeros(docs * registers, np.uint32)
    levels = [0] if not len(weight) else [0, *(1 << k for k in range(int(weight.max() - 1).bit_length()))]
    part = [np.flatnonzero(weight > low) for low in levels]
    who = np.concatenate(part)
    low = np.repeat(np.array(levels, np.int64), [len(p) for p in part])
    size = np.maximum(low, 1)
    f, d, w = feature[who], doc[who], weight[who].astype(np.int64)
    seed = _seed(f, low, size)
    gap, bits = _draw(seed, np.zeros(len(f), np.int64))
    t, step = gap / (registers * size), np.ones(len(f), np.int64)

    def enter(d: np.ndarray, t: np.ndarray, bits: np.ndarray) -> None:
        at = d * registers + ((bits >> np.uint64(32)) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(time, at, t)
        won = time[at] == t
        name[at[won]] = bits[won].astype(np.uint32)

    while len(f):
        limit = time.reshape(docs, registers).max(1)
        unit = size == 1
        enter(d[unit], t[unit], bits[unit])
        limit = time.reshape(docs, registers).max(1)
        # unit intervals go on to their next points, several at once when few are left
        go = np.flatnonzero(unit & (t < limit[d]))
        many = 1 if len(go) > 50_000 else 8 if len(go) > 4_000 else 64
        if many > 1 and len(go):
            steps = step[go][:, None] + np.arange(many - 1)
            gap, more = _draw(np.repeat(seed[go], many - 1), steps.ravel())
            times = t[go][:, None] + np.cumsum(gap.reshape(steps.shape) / registers, axis=1)
            enter(np.repeat(d[go], many - 1), times.ravel(), more)
            t[go], step[go] = times[:, -1], step[go] + many - 1
            limit = time.reshape(docs, registers).max(1)
            go = go[t[go] < limit[d[go]]]
        gap, more = _draw(seed[go], step[go])
        kept = (f[go], d[go], w[go], low[go], size[go], seed[go], t[go] + gap / registers, more, step[go] + 1)
        # longer intervals whose point counts split; one half keeps the point
        cut = np.flatnonzero(~unit & (t < limit[d]))
        half = size[cut] // 2
        upper = (bits[cut] & np.uint64(1)).astype(bool)
        new = []
        for side in (False, True):
            lo = low[cut] + half * side
            s = _seed(f[cut], lo, half)
            gap, own = _draw(s, np.zeros(len(cut), np.int64))
            holds = upper == side
            # the half with the point passes it on; its own stream begins after it
            tt = np.where(holds, t[cut], t[cut] + gap / (registers * half))
            bb = np.where(holds, mix(bits[cut] ^ s), own)
            in_range = lo < w[cut]
            new.append(tuple(x[in_range] for x in (f[cut], d[cut], w[cut], lo, half, s, tt, bb, np.where(holds, 0, 1))))
        f, d, w, low, size, seed, t, bits, step = (np.concatenate(x) for x in zip(kept, *new))
        live = t < limit[d]
        f, d, w, low, size, seed, t, bits, step = (x[live] for x in (f, d, w, low, size, seed, t, bits, step))
    return name.reshape(docs, registers)


def similarity(block: Block, n: int = SHINGLE) -> np.ndarray:
    """Weighted Jaccard similarity of documents 0 and 1, 2 and 3, ... of a block."""
    h, doc = shingles(block, n)
    pair = doc >> 1
    key = (mix(h ^ mix(pair.astype(np.uint64) * _GOLDEN)) & ~np.uint64(1)) | (doc & 1).astype(np.uint64)
    u, at, count = np.unique(key, return_index=True, return_counts=True)
    both = np.flatnonzero((u[:-1] | np.uint64(1)) == u[1:])
    shared = np.bincount(pair[at[both]], np.minimum(count[both], count[both + 1]), (len(block.offsets) - 1) // 2)
    total = np.bincount(pair, minlength=(len(block.offsets) - 1) // 2)
    return shared / np.maximum(total - shared, 1)


def _interleaved(a: pa.Array, b: pa.Array) -> pa.Array:
    n = len(a)
    both = pa.concat_arrays([a.cast(pa.large_string()), b.cast(pa.large_string())])
    return both.take(pa.array(np.arange(2 * n).reshape(2, n).T.ravel()))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, node (digest of the text), n (shingles), sig (registers; null without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig, n = [], []
            for block in blocks(batch.column(2)):
                f, d, w = bags(block)
                docs_ = len(block.offsets) - 1
                total = np.bincount(d, w, docs_).astype(np.int64)
                rows = signatures(f, d, w, docs_)
                sig += [r.tobytes() if t else None for r, t in zip(rows, total)]
                n.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.concatenate(n) if n else np.zeros(0, np.int64)), pa.array(sig, pa.binary())],
                ["doc_id", "node", "n", "sig"],
            )

    return docs.select(F.col("doc_id").cast("long"), text_key(F.col("text")).alias("node"), "text").mapInArrow(run, "doc_id long, node binary, n long, sig binary")


def verified(pairs: DataFrame, texts: DataFrame, similarity_at_least: float) -> DataFrame:
    """The pairs (a, b) of nodes whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for block in blocks(_interleaved(batch.column(2), batch.column(3)), step=2):
                good.append(similarity(block) >= similarity_at_least)
            keep = pa.array(np.concatenate(good) if good else np.zeros(0, bool))
            yield batch.select(["a", "b"]).filter(keep)

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.select("a", "b").join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def _open_buckets(members: DataFrame, found: DataFrame, distinct: bool) -> DataFrame:
    """Members (bucket, band, node, n, component) of buckets that three nodes or more share and several components.

    distinct: of buckets with the same members (bands often agree) one stays.
    """
    named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    sets = named.groupBy("bucket").agg(
        F.count("*").alias("m"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.pmod(F.xxhash64("n", "node"), F.lit(1 << 40))).alias("y"),
    ).where("m > 2 and lo <> hi")
    if distinct:
        sets = sets.groupBy("m", "x", "y").agg(F.min("bucket").alias("bucket"))
    return named.join(sets.select("bucket", "m"), "bucket").select("bucket", "band", "m", "node", "n", "component")


def _centres(members: DataFrame) -> DataFrame:
    """Of every bucket the node whose registers agree most with those that its block has most often.

    Copies of one text agree with each other less than with the text; it stands out so.
    """

    def run(group: pa.Table) -> pa.Table:
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(-1, REGISTERS)
        usual = np.zeros(REGISTERS, np.uint32)
        for r in range(REGISTERS):
            value, count = np.unique(sig[:, r], return_counts=True)
            usual[r] = value[count.argmax()]
        score = (sig == usual).sum(1)
        k = int(score.argmax())
        return pa.table({"bucket": group.column("bucket")[:1], "score": pa.array([int(score[k])], pa.int32()), "node": group.column("node").take([k]), "n": group.column("n").take([k])})

    dealt = members.withColumn("i", F.pmod(F.xxhash64("node"), F.ceil(F.col("m") / BLOCK_ROWS)).cast("int"))
    best = dealt.groupBy("bucket", "i").applyInArrow(run, "bucket long, score int, node binary, n long")
    return best.groupBy("bucket").agg(F.max(F.struct("score", "node", "n")).alias("c")).select("bucket", F.col("c.node").alias("centre"), F.col("c.n").alias("centre_n"))


def _overlaps(bags_: list[tuple[np.ndarray, np.ndarray]], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Shared shingles (with repeats) of rows x and rows y of bags, all pairs, by matrix products over blocks of shingles."""
    # the k-th occurrence of a shingle is an element of its own: shared counts become set sizes
    expand = [np.repeat(h, w) ^ mix(np.concatenate([np.arange(k) for k in w] or [np.zeros(0, int)]).astype(np.uint64)) for h, w in bags_]
    flat, row = np.concatenate(expand), np.repeat(np.arange(len(bags_)), [len(e) for e in expand])
    element, number, count = np.unique(flat, return_inverse=True, return_counts=True)
    common = np.cumsum(count > 1) - 1
    kept = count[number] > 1
    row, number = row[kept], common[number[kept]]
    order = np.argsort(number, kind="stable")
    row, number = row[order], number[order]
    total = np.zeros((len(x), len(y)), np.float32)
    for at in range(0, int(common[-1]) + 1 if len(common) else 0, OVERLAP_ELEMENTS):
        lo, hi = np.searchsorted(number, [at, at + OVERLAP_ELEMENTS])
        part = np.zeros((len(bags_), OVERLAP_ELEMENTS), np.float32)
        part[row[lo:hi], number[lo:hi] - at] = 1
        total += part[x] @ part[y].T
    return total


def _within(members: DataFrame, similarity_at_least: float) -> DataFrame:
    """Links across the components of buckets, verified in place; they span what they join.

    members (bucket, band, m, node, n, sig, component, text). A pair is tried in the first
    band that it meets in, if its registers agree often enough. Members of a block's
    largest component are compared with others only.
    """
    mine = members.withColumn("k", F.ceil(F.col("m") / BLOCK_ROWS).cast("int")).withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    dealt = mine.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        "bucket", "band", F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), (F.col("i") <= F.col("j")).alias("one"), (F.col("i") >= F.col("j")).alias("two"), "node", "n", "sig", "component", "text"
    )

    def run(group: pa.Table) -> pa.Table:
        nothing = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        number: dict[bytes, int] = {}
        part = np.array([number.setdefault(c, len(number)) for c in group.column("component").to_pylist()])
        if len(number) == 1:
            return nothing
        sig = np.frombuffer(b"".join(group.column("sig").to_pylist()), np.uint32).reshape(len(group), REGISTERS)
        n = group.column("n").to_numpy().astype(np.float64)
        band = group.column("band")[0].as_py()
        one, two = (group.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("one", "two"))
        other = part != np.bincount(part).argmax()
        pairs_x, pairs_y = [], []
        for x in np.flatnonzero(other).tolist():
            y = np.flatnonzero(((one if two[x] else two) | (two if one[x] else one)) & (part != part[x]) & (np.minimum(n, n[x]) >= similarity_at_least * np.maximum(n, n[x])))
            same = sig[y] == sig[x]
            y = y[(same.sum(1) >= AGREEMENT * REGISTERS) & (same.reshape(len(y), REGISTERS // ROWS, ROWS).all(2).argmax(1) == band)]
            pairs_x.append(np.full(len(y), x))
            pairs_y.append(y)
        px, py = (np.concatenate(p) if p else np.zeros(0, np.int64) for p in (pairs_x, pairs_y))
        if not len(px):
            return nothing
        texts, used = group.column("text"), np.unique(np.concatenate([px, py]))
        bags_ = [np.unique(shingles(next(blocks(texts.slice(int(k), 1))))[0], return_counts=True) for k in used]
        ux, uy = np.unique(px), np.unique(py)
        shared = _overlaps(bags_, np.searchsorted(used, ux), np.searchsorted(used, uy))[np.searchsorted(ux, px), np.searchsorted(uy, py)]
        good = shared >= similarity_at_least * (n[px] + n[py] - shared)
        px, py = px[good], py[good]
        # one link for each pair of components
        _, at = np.unique(np.minimum(part[px], part[py]) * len(number) + np.maximum(part[px], part[py]), return_index=True)
        node = group.column("node").combine_chunks()
        return pa.table({"a": node.take(pa.array(px[at])), "b": node.take(pa.array(py[at]))})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "a binary, b binary")


def classes(docs: DataFrame, *, similarity_at_least: float = SIMILARITY) -> DataFrame:
    """doc_id, node, class_id (the smallest doc_id of the class) and kept, one row per document.

    One row of each class is kept; classes can share a class_id, as ids may be null or repeat.
    """
    with scratch():
        named = materialize(_named(docs, similarity_at_least), "minhash-named", lasting=True)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "node", "row")).alias("first")
    # classes of one need no join; the others' table is written, so a large class is split by the skew join
    several = materialize(named.groupBy("component").agg(first, F.count("*").alias("m")).where("m > 1").drop("m"), "minhash-classes", lasting=True)
    out = named.join(several, "component", "left")
    alone = F.col("first").isNull()
    return out.select(
        "doc_id", "node", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"), (alone | (F.col("row") == F.col("first.row"))).alias("kept")
    )


def _named(docs: DataFrame, similarity_at_least: float) -> DataFrame:
    """row, doc_id, node and component (a node) of every document."""
    rows = materialize(signed(docs).withColumn("row", F.monotonically_increasing_id()), "minhash-signatures")
    nodes = rows.where("sig is not null").groupBy("node").agg(F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = materialize(nodes, "minhash-nodes")
    bands = REGISTERS // ROWS
    width = 4 * ROWS
    banded = nodes.select("node", "n", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"), "sig").select(
        "node", "n", "band", F.xxhash64("band", F.expr(f"substring(sig, band * {width} + 1, {width})")).alias("bucket")
    )
    heads = banded.groupBy("bucket").agg(F.min(F.struct("node", "n")).alias("head"), F.count("*").alias("m")).where("m > 1").select("bucket", F.col("head.node").alias("head"), F.col("head.n").alias("head_n"))
    members = materialize(banded.join(heads, "bucket"), "minhash-buckets")
    tested = members.where(f"node <> head and least(n, head_n) >= {similarity_at_least} * greatest(n, head_n)")
    tested = materialize(tested.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct(), "minhash-pairs")
    wanted = members.select("node").distinct()
    # copies of a text combine before the shuffle; the join then has one row per text
    texts = docs.select(text_key(F.col("text")).alias("node"), "text").groupBy("node").agg(F.first("text").alias("text")).join(wanted, "node", "left_semi")
    texts = materialize(texts, "minhash-texts")
    links = materialize(verified(tested, texts, similarity_at_least), "minhash-links")
    # who hangs on one first node belongs together; whole components come later
    hung = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("component"))
    found, left = None, materialize(_open_buckets(members, hung, True), "minhash-open")
    if left.limit(1).count():
        signs = nodes.select("node", "sig")
        centres = materialize(_centres(left.join(signs, "node")), "minhash-centres")
        again = left.join(centres, "bucket").where(f"node <> centre and least(n, centre_n) >= {similarity_at_least} * greatest(n, centre_n)")
        more = again.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct().join(tested, ["a", "b"], "left_anti")
        links = links.unionByName(materialize(verified(more, texts, similarity_at_least), "minhash-links"))
        found = components(links)
        left = materialize(_open_buckets(members, found, False), "minhash-open")
        if left.limit(1).count():
            last = _within(left.join(signs, "node").join(texts, "node"), similarity_at_least)
            found = components(links.unionByName(materialize(last, "minhash-links")))
    if found is None:
        found = components(links)
    named = rows.select("row", "doc_id", "node").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return named


@passing("doc_id", "text")
def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """One document of each class, the one with the smallest id, with its own columns."""
    kept = classes(docs, **options).where("kept").select(F.col("node").alias("__node"), F.col("doc_id").alias("__id"))
    named = docs.withColumn("__key", text_key(F.col("text")))
    joined = named.join(kept, F.col("__key").eqNullSafe(F.col("__node")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__id")), "left_semi")
    return joined.dropDuplicates(["__key", "doc_id"]).select(*docs.columns)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")


QUERIES = {"op10_minhash_near_dedup": op10_minhash_near_dedup}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All pairs of texts that share a shingle, by whole multisets.
ORACLES = {
    "op10_minhash_near_dedup": rf"""
WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
nodes AS (SELECT min(doc_id) AS node, t, list_filter(regexp_split_to_array(translate(t, '{_UPPER}', '{_LOWER}'), '[ 	-
]+'), lambda x: x <> '') AS w FROM texts GROUP BY t),
shingles AS (SELECT node, unnest(list_transform(range(1, greatest(1, len(w) - {SHINGLE - 1}) + 1), lambda i: array_to_string(w[i : i + {SHINGLE - 1}], ' '))) AS s FROM nodes WHERE len(w) > 0),
bags AS (SELECT node, s, count(*) AS n FROM shingles GROUP BY ALL),
sizes AS (SELECT node, sum(n) AS size FROM bags GROUP BY node),
shared AS (SELECT a.node AS x, b.node AS y, sum(least(a.n, b.n)) AS m FROM bags a JOIN bags b ON a.s = b.s AND a.node < b.node GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.node = x JOIN sizes q ON q.node = y WHERE m >= {SIMILARITY} * (p.size + q.size - m)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT node, node AS root FROM nodes UNION SELECT w.y, r.root FROM reach r JOIN ways w ON w.x = r.node),
roots AS (SELECT node, min(root) AS class_id FROM reach GROUP BY node)
SELECT d.doc_id, r.class_id, d.doc_id = r.class_id AS kept FROM texts d JOIN nodes n ON n.t = d.t JOIN roots r ON r.node = n.node
"""
}
