"""Suffix-array removal of long repeats.

A byte goes when a ``LENGTH``-byte string over it also starts anywhere else. Sorting
every suffix of a corpus would move each byte many times, so only suffixes that can
have a twin are sorted:

1. Anchors. The ``GRAM``-byte strings of least hash in any ``LENGTH``-byte window are
   picked by content alone; a window and its twin have the same anchors at the same
   places. Anchors whose hash occurs once are done with.
2. Contexts. A context is all that windows over an anchor can hold: its bytes to the
   right and, read backwards, those to the left. Equal contexts are one, with a count;
   bytes are sent only of those that share their anchor with other contexts.
3. Suffix array. Contexts with one anchor hash are sorted by their right suffixes and
   by their left ones: multikey quicksort over eight-byte symbols down to a shallow
   depth, then a blind trie for each group that still shares its prefix. Common
   prefixes of neighbours tell which windows of a context have twins.
4. Windows with twins cover bytes; covers go back to the places of their contexts.

Equal texts are one node; all windows of a text that occurs twice have twins.

An anchor with more contexts than a task sorts is refined: the windows over it are split
by their left reach into ranges, and the bytes that all windows of a range hold (the
core) take the anchor's place; contexts whose windows of a range are all equal (the hull)
are one. So a group becomes several with longer anchors, again and again until each
fits a task or its range is one window, and the same sort treats them all.

Cases: null and empty texts have no bytes; texts shorter than the length lose none;
matches never cross documents; rows with equal ids are separate; other columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import forget, materialize, partitions, passing, scratch, table
from ._vec import Block, as_binary, blocks, mix, prefix_hash, range_hash
from .minhash import text_key

LENGTH = 200
GRAM = 40
#: Bytes that quicksort looks at behind the anchor before blind tries take over.
SHALLOW = 16
#: Contexts of a sorting task; an anchor with more is refined, its range of reaches split into ``WAYS``.
TASK_CONTEXTS, WAYS = 16_000, 6


def _sliding(x: np.ndarray, width: int, op: np.ufunc, fill: int) -> np.ndarray:
    """op over x[i : i + width] for each i with a whole window."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    padded = np.full(-(-len(x) // width) * width, fill, x.dtype)
    padded[: len(x)] = x
    rows = padded.reshape(-1, width)
    ahead = op.accumulate(rows, axis=1).ravel()
    behind = op.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(behind[:n], ahead[width - 1 : width - 1 + n])


def anchors(block: Block, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a block's anchors, their documents and places in them."""
    n, width = len(block.data), length - gram + 1
    nothing = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if n < length:
        return nothing
    at = np.arange(n - gram + 1)
    h = range_hash(prefix_hash(block.data), at, at + gram) | np.uint64(1)
    size = np.diff(block.offsets)
    end = np.repeat(block.offsets[1:], size)
    least = _sliding(h, width, np.minimum, np.iinfo(np.uint64).max)
    least[np.arange(len(least)) + length > end[: len(least)]] = 0
    edge = np.zeros(width - 1, np.uint64)
    best = _sliding(np.concatenate([edge, least, edge]), width, np.maximum, 0)[: len(h)]
    place = np.flatnonzero(h == best)
    doc = np.searchsorted(block.offsets, place, "right") - 1
    return h[place], doc, place - block.offsets[doc]


class _BlindTrie:
    """Sorts strings with long common prefixes: branches know one byte, leaves whole strings."""

    __slots__ = ("root", "text")

    def __init__(self, text: list[bytes]):
        self.text = text
        self.root: list | None = None  # [depth, {byte: node}] or a leaf, a list [-1, numbers]

    def insert(self, k: int) -> None:
        s = self.text[k]
        if self.root is None:
            self.root = [-1, [k]]
            return
        node = self.root
        while node[0] >= 0:  # blind descent: unseen bytes are taken on trust
            step = s[node[0]] if node[0] < len(s) else -1
            node = node[1].get(step) or next(iter(node[1].values()))
        t = self.text[node[1][0]]
        if s == t:
            node[1].append(k)
            return
        low, high = 0, min(len(s), len(t))
        while low < high:  # longest common prefix
            mid = (low + high + 1) >> 1
            if s[low:mid] == t[low:mid]:
                low = mid
            else:
                high = mid - 1
        a, b = (x[low] if low < len(x) else -1 for x in (s, t))
        parent, edge, node = None, -1, self.root
        while 0 <= node[0] < low:
            edge = s[node[0]] if node[0] < len(s) else -1
            parent, node = node, node[1][edge]
        if node[0] == low:
            node[1][a] = [-1, [k]]
            return
        branch = [low, {b: node, a: [-1, [k]]}]
        if parent is None:
            self.root = branch
        else:
            parent[1][edge] = branch

    def order(self) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            node = todo.pop()
            if node[0] < 0:
                out += node[1]
            else:
                todo += [node[1][c] for c in sorted(node[1], reverse=True)]
        return out


def deep_shallow(group: np.ndarray, rows: np.ndarray, size: np.ndarray, skip: int = 0, shallow: int = SHALLOW) -> np.ndarray:
    """Order of byte rows within groups (groups ascending). Rows of a group share ``skip`` bytes.

    Multikey quicksort with eight bytes as a symbol, the group being the first symbol;
    groups left after ``shallow`` bytes are ordered by blind tries.
    """
    n = len(group)
    symbols = [group.astype(np.uint64)]
    for at in range(skip, min(skip + shallow, rows.shape[1]), 8):
        part = np.zeros((n, 8), np.uint8)
        got = rows[:, at : at + 8]
        part[:, : got.shape[1]] = got
        symbols.append(part.view(">u8").ravel().astype(np.uint64))
    order, todo = np.arange(n), [(0, n, 0)]
    while todo:
        lo, hi, depth = todo.pop()
        while hi - lo > 1:
            part = order[lo:hi]
            if depth == len(symbols):
                text = [rows[k, skip : size[k]].tobytes() for k in part.tolist()]
                trie = _BlindTrie(text)
                for k in range(len(text)):
                    trie.insert(k)
                order[lo:hi] = part[trie.order()]
                break
            s = symbols[depth][part]
            if hi - lo <= 3 or depth == 0:  # few rows, or symbols that are numbers: sort and cut
                by = np.argsort(s, kind="stable")
                order[lo:hi] = part[by]
                s = s[by]
                edge = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist(), hi - lo]
                todo += [(lo + a, lo + b, depth + 1) for a, b in zip(edge[:-1], edge[1:]) if b - a > 1]
                break
            pivot = np.sort(s[[0, (hi - lo) // 2, hi - lo - 1]])[1]
            less, more = s < pivot, s > pivot
            a, b = int(less.sum()), int(more.sum())
            order[lo:hi] = np.concatenate([part[less], part[~less & ~more], part[more]])
            if a > 1:
                todo.append((lo, lo + a, depth))
            if b > 1:
                todo.append((hi - b, hi, depth))
            lo, hi, depth = lo + a, hi - b, depth + 1
    return order


def common_prefixes(order: np.ndarray, group: np.ndarray, rows: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes that each row in order shares with the one before it; 0 across groups."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b = order[:-1], order[1:]
        differ = rows[a] != rows[b]
        shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
        out[1:] = np.where(group[a] == group[b], np.minimum(shared, np.minimum(size[a], size[b])), 0)
    return out


def twins(group: np.ndarray, left: list[bytes], right: list[bytes], often: np.ndarray, low: np.ndarray | None = None, high: np.ndarray | None = None,
          length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest left reach of a context's windows that have twins (greatest -1: none).

    left: bytes before the anchor, backwards; right: from the anchor on; often: the
    context stands in several places; low, high: the reaches that count (all, if not
    given). Contexts with equal groups share their anchor.
    """
    n, most = len(group), length - gram
    low = np.zeros(n, np.int64) if low is None else low
    high = np.full(n, most) if high is None else high

    def matrix(parts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, parts), np.int64, n)
        return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), np.uint8).reshape(n, width), size

    l_rows, l_size = matrix(left, most)
    r_rows, r_size = matrix(right, length)
    r_order = deep_shallow(group, r_rows, r_size, gram)
    l_order = deep_shallow(group, l_rows, l_size)
    r_lcp, l_lcp = (common_prefixes(o, group, m, s) for o, m, s in ((r_order, r_rows, r_size), (l_order, l_rows, l_size)))
    least, greatest = np.full(n, most + 1), np.full(n, -1)
    new_group = np.ones(n, bool)
    new_group[1:] = group[l_order[1:]] != group[l_order[:-1]]
    r_class, l_class = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for reach in range(most + 1):
        valid = np.flatnonzero((l_size >= reach) & (r_size >= length - reach) & (low <= reach) & (reach <= high))
        if not len(valid):
            continue
        r_class[r_order] = np.cumsum(r_lcp < length - reach)
        l_class[l_order] = np.cumsum((l_lcp < reach) | new_group)
        key = r_class[valid] * (n + 1) + l_class[valid]
        by = np.argsort(key)
        same = key[by[1:]] == key[by[:-1]]
        hit = often[valid]
        hit[by[1:][same]] = True
        hit[by[:-1][same]] = True
        hit = valid[hit]
        least[hit] = np.minimum(least[hit], reach)
        greatest[hit] = reach
    return least, greatest


def short_key(text: Column) -> Column:
    """Small key that brings places back to their text; texts that share one share places, which is harmless."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _anchor_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                h, doc, at = anchors(block)
                node = batch.column(0).take(pa.array(doc + block.first))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), node, pa.array(at, pa.int32())], ["anchor", "short", "at"])

    return docs.select(short_key(F.col("text")).alias("short"), "text").mapInArrow(run, "anchor long, short long, at int")


USES = "anchor long, context binary, reach int, size int, uses array<struct<node:binary,at:int>>"


def _context(raw: bytes, a: int, b: int, at: int) -> tuple[bytes, int, bytes]:
    """Digest, left reach and bytes of the context of the anchor at ``at`` in the text raw[a:b]."""
    lo = max(a, at - (LENGTH - GRAM))
    text = raw[lo : min(b, at + LENGTH)]
    return blake2b(text, digest_size=16, salt=(at - lo).to_bytes(2, "big")).digest(), at - lo, text


def _contexts(marked: DataFrame) -> DataFrame:
    """Contexts at the marked places (node, text, places) by digest: one row per context and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_binary(batch.column(1))
            raw = data.tobytes()
            number: dict[bytes, int] = {}
            rows, group, which, where = [], [], [], []
            for i, places in enumerate(batch.column(2).to_pylist()):
                a, b = int(offsets[i]), int(offsets[i + 1])
                for p in places:
                    if a + p["at"] + GRAM > b:
                        continue  # a place of another text with this short key
                    key, reach, text = _context(raw, a, b, a + p["at"])
                    k = number.setdefault(key, len(number))
                    if k == len(rows):
                        rows.append((p["anchor"], key, reach, len(text)))
                    group.append(k)
                    which.append(i)
                    where.append(p["at"])
            order = np.argsort(np.array(group, np.int64), kind="stable")
            struct = pa.StructArray.from_arrays(
                [batch.column(0).take(pa.array(np.array(which, np.int64)[order])), pa.array(np.array(where, np.int32)[order])], ["node", "at"]
            )
            ends = np.concatenate([[0], np.cumsum(np.bincount(np.array(group, np.int64), minlength=len(rows)))])
            columns = list(zip(*rows)) or [()] * 4
            types = (pa.int64(), pa.binary(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, t) for c, t in zip(columns, types)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct)],
                ["anchor", "context", "reach", "size", "uses"],
            )

    return marked.select("node", "text", "places").mapInArrow(run, USES)


def _bytes(wanted: DataFrame) -> DataFrame:
    """Bytes of contexts from one of their places: wanted (text, places: anchor, context, at, often)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = as_binary(batch.column(0))
            raw = data.tobytes()
            rows = []
            for i, places in enumerate(batch.column(1).to_pylist()):
                for p in places:
                    _, reach, text = _context(raw, int(offsets[i]), int(offsets[i + 1]), int(offsets[i]) + p["at"])
                    rows.append((p["anchor"], p["context"], reach, text, p["often"]))
            columns = list(zip(*rows)) or [()] * 5
            types = (pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["anchor", "context", "reach", "bytes", "often"])

    return wanted.select("text", "places").mapInArrow(run, "anchor long, context binary, reach int, bytes binary, often boolean")


def _sorted_twins(contexts: DataFrame, tasks: int) -> DataFrame:
    """Reaches with twins of contexts (group, context, reach, bytes, often, low, high)."""

    def run(group: pa.Table) -> pa.Table:
        reach = group.column("reach").to_pylist()
        text = group.column("bytes").to_pylist()
        left = [t[:r][::-1] for t, r in zip(text, reach)]
        right = [t[r:] for t, r in zip(text, reach)]
        number = np.unique(group.column("group").to_numpy(), return_inverse=True)[1]
        least, greatest = twins(number, left, right, group.column("often").to_numpy(zero_copy_only=False), group.column("low").to_numpy(), group.column("high").to_numpy())
        found = pa.table({"context": group.column("context").combine_chunks(), "least": pa.array(least, pa.int32()), "greatest": pa.array(greatest, pa.int32())})
        return found.filter(pa.array(greatest >= 0))

    dealt = contexts.withColumn("task", F.pmod(F.xxhash64("group"), F.lit(tasks)).cast("int"))
    return dealt.groupBy("task").applyInArrow(run, "context binary, least int, greatest int")


def _ranges(low: int, high: int) -> list[tuple[int, int]]:
    step = max(1, -(-(high - low + 1) // WAYS))
    return [(a, min(a + step - 1, high)) for a in range(low, high + 1, step)]


def _parts(state: DataFrame) -> DataFrame:
    """The state (context, reach, bytes, low, high) by parts of its ranges, with the digests of core and hull.

    ``least`` and ``greatest`` are the reaches of a part's windows that lie in the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for context, reach, text, low, high in zip(*(batch.column(c).to_pylist() for c in ("context", "reach", "bytes", "low", "high"))):
                first, last = max(low, LENGTH - (len(text) - reach)), min(high, reach)
                for a, b in _ranges(low, high):
                    least, greatest = max(a, first), min(b, last)
                    if least <= greatest:
                        where = a.to_bytes(2, "big") + b.to_bytes(2, "big")
                        core = text[reach - a : reach + LENGTH - b] if a <= reach else b""
                        before = min(b, reach)
                        hull = text[reach - before : reach + LENGTH - a]
                        rows.append((
                            context, a, b, least, greatest, blake2b(core, digest_size=16, salt=where).digest(),
                            blake2b(hull, digest_size=16, salt=where + before.to_bytes(2, "big")).digest(),
                        ))
            columns = list(zip(*rows)) or [()] * 7
            types = (pa.binary(), *[pa.int32()] * 4, pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["context", "low", "high", "least", "greatest", "core", "hull"])

    return state.select("context", "reach", "bytes", "low", "high").mapInArrow(run, "context binary, low int, high int, least int, greatest int, core binary, hull binary")


def _refined(crowded: DataFrame, most: int) -> tuple[DataFrame | None, DataFrame | None]:
    """Contexts of crowded anchors: (twins found by equal hulls, groups of at most ``most`` to sort).

    crowded: context, reach, bytes, often. Of contexts with equal hulls one stays to be
    compared with others that share the core.
    """
    found, groups = None, None
    state = crowded.withColumn("low", F.lit(0)).withColumn("high", F.lit(LENGTH - GRAM))
    while True:
        parts = materialize(_parts(state), "suffix-parts")
        hulls = parts.groupBy("hull").agg(F.count("*").alias("k"), F.min("context").alias("one"), F.first("core").alias("core"), F.first("low").alias("low"), F.first("high").alias("high"))
        hulls = materialize(hulls, "suffix-hulls")
        equal = parts.join(hulls.where("k > 1").select("hull"), "hull", "left_semi").select("context", "least", "greatest")
        found = equal if found is None else found.unionByName(equal)
        cores = materialize(hulls.groupBy("core").agg(F.count("*").alias("m")).where("m > 1"), "suffix-cores")
        live = materialize(hulls.join(cores, "core").select(F.col("one").alias("context"), "core", "low", "high", "m"), "suffix-live")
        few = live.where(F.col("m") <= most).select("context", F.xxhash64("core", "low").alias("group"), "low", "high")
        groups = few if groups is None else groups.unionByName(few)
        more = live.where(F.col("m") > most).select("context", "low", "high")
        if not more.limit(1).count():
            return found, crowded.join(groups, "context")
        state = crowded.join(more, "context")


def repeats(docs: DataFrame) -> DataFrame:
    """node (digest of a text), copies, covers: spans (start, stop) with twins, in order, apart from each other.

    One row per distinct text of ``docs`` that occurs twice or has a cover.
    """
    spark = docs.sparkSession
    found = materialize(_anchor_rows(docs), "suffix-anchors")
    # written, so that the join can split an anchor that stands in very many places
    twice = materialize(found.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1").select("anchor"), "suffix-twice")
    places = materialize(found.join(twice, "anchor").select("short", "anchor", "at"), "suffix-places")
    forget(found)
    by_text = places.groupBy("short").agg(F.collect_set(F.struct("anchor", "at")).alias("places"))
    texts = docs.select(short_key(F.col("text")).alias("short"), text_key(F.col("text")).alias("node"), "text")
    marked = materialize(texts.join(by_text, "short").groupBy("node").agg(F.first("text").alias("text"), F.first("places").alias("places")), "suffix-texts")
    forget(places)
    held = materialize(_contexts(marked), "suffix-contexts")
    one = held.groupBy("anchor", "context", "reach", "size").agg(F.sum(F.size("uses")).alias("k"), F.min(F.element_at("uses", 1)).alias("place"))
    one = materialize(one.select("anchor", "context", "reach", "size", (F.col("k") > 1).alias("often"), "place"), "suffix-distinct")
    crowd = materialize(one.groupBy("anchor").agg(F.count("*").alias("m")), "suffix-crowds")
    # an anchor with one context: all that can be said is how often it stands
    alone = one.join(crowd.where("m = 1"), "anchor", "left_semi").where(f"often and size >= {LENGTH}")
    got = alone.select("context", F.greatest(F.lit(0), LENGTH - (F.col("size") - F.col("reach"))).alias("least"), F.least(F.lit(LENGTH - GRAM), F.col("reach")).alias("greatest"))
    mixed = one.join(crowd.where("m > 1"), "anchor", "left_semi")
    wanted = mixed.groupBy(F.col("place.node").alias("node")).agg(F.collect_list(F.struct("anchor", "context", F.col("place.at").alias("at"), "often")).alias("places"))
    pieces = materialize(_bytes(marked.select("node", "text").join(wanted, "node")), "suffix-bytes")
    forget(marked)
    total = crowd.where("m > 1").agg(F.sum("m")).first()[0] or 0
    crowded = crowd.where(F.col("m") > TASK_CONTEXTS).select("anchor")
    tasks = max(1, min(partitions(spark), -(-total // 2000)), -(-total // TASK_CONTEXTS))
    whole = pieces.select(F.col("anchor").alias("group"), "context", "reach", "bytes", "often", F.lit(0).alias("low"), F.lit(LENGTH - GRAM).alias("high"))
    if crowded.limit(1).count():
        large = pieces.join(crowded, "anchor", "left_semi")
        equal, groups = _refined(materialize(large.select("context", "reach", "bytes", "often"), "suffix-crowded"), TASK_CONTEXTS)
        # a context that stands in several places has twins for all its windows
        size = F.length("bytes") - F.col("reach")
        own = large.where(F.col("often") & (F.length("bytes") >= LENGTH)).select("context", F.greatest(F.lit(0), LENGTH - size).alias("least"), F.least(F.lit(LENGTH - GRAM), F.col("reach")).alias("greatest"))
        got = got.unionByName(equal).unionByName(own)
        whole = whole.join(crowded.select(F.col("anchor").alias("group")), "group", "left_anti").unionByName(groups.select(whole.columns))
    got = got.unionByName(_sorted_twins(whole, tasks))
    got = materialize(got.groupBy("context").agg(F.min("least").alias("least"), F.max("greatest").alias("greatest")), "suffix-twins")
    covers = held.join(got, "context").select(F.explode("uses").alias("u"), "least", "greatest").select(
        "u.node", (F.col("u.at") - F.col("greatest")).alias("start"), (F.col("u.at") - F.col("least") + LENGTH).alias("stop")
    )
    covers = covers.groupBy("node").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    copies = docs.groupBy(text_key(F.col("text")).alias("node")).agg(F.count("*").alias("copies"))
    return copies.join(covers, "node", "left").where("copies > 1 or spans is not null")


def _merged(spans: list[dict] | None, copies: int | None, size: int) -> list[tuple[int, int]]:
    if copies is not None and copies > 1 and size >= LENGTH:
        return [(0, size)]
    out: list[tuple[int, int]] = []
    for s in spans or ():
        if out and s["start"] <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], s["stop"]))
        else:
            out.append((s["start"], s["stop"]))
    return out


def cleaned(docs: DataFrame, *, as_text: bool = False) -> DataFrame:
    """All rows of ``docs`` with __kept (bytes left, or text), __removed and __spans (maximal removed runs)."""
    with scratch():
        held = materialize(repeats(docs), "suffix-repeats", lasting=True)
    keyed = docs.withColumn("__node", text_key(F.col("text")))
    joined = keyed.join(held.withColumnRenamed("node", "__node").withColumnRenamed("copies", "__copies").withColumnRenamed("spans", "__list"), "__node", "left").drop("__node")
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept: list[bytes] = []
            removed, spans = [], []
            data, offsets = as_binary(batch.column(at))
            raw = data.tobytes()
            for i, (copies, found) in enumerate(zip(batch.column("__copies").to_pylist(), batch.column("__list").to_pylist())):
                text = raw[offsets[i] : offsets[i + 1]]
                runs = _merged(found, copies, len(text))
                edge = [0, *(x for r in runs for x in r), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2])))
                removed.append(len(text) - len(kept[-1]))
                spans.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(docs_names)], pa.array([k.decode("utf-8", "ignore") for k in kept] if as_text else kept, pa.string() if as_text else pa.binary()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64())],
                [*docs_names, "__kept", "__removed", "__spans"],
            )

    docs_names = docs.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + f", __kept {'string' if as_text else 'binary'}, __removed long, __spans long"
    return joined.select(*docs_names, "__copies", "__list").mapInArrow(run, schema)


@passing("doc_id", "text", "n_chars")
def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the repeats in their texts; a text that loses all its words goes.

    Bytes left of a character that was cut are dropped; ``n_chars``, if there, is counted anew.
    """
    left = cleaned(docs, as_text=True).withColumn("text", F.when(F.col("__removed") > 0, F.col("__kept")).otherwise(F.col("text")))
    left = left.where("__removed = 0 or length(trim(BOTH '\t\n\r ' FROM text)) > 0")
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col("__removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return left.select(*docs.columns)


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = cleaned(docs)
    return out.select(
        "doc_id",
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        F.col("__removed").alias("n_removed"),
        F.col("__spans").alias("n_spans"),
        F.sha2("__kept", 256).alias("kept_sha256"),
    )


QUERIES = {"op4_suffix_array_dedup": op4_suffix_array_dedup}
ORACLES: dict[str, str] = {}
