"""How filters interact: what each removes, alone and behind others, in every order.

Five filters fail whole texts: A under 50 words; B few distinct words; C many capitals;
D signs of code or markup; E a text that a smaller id has too. A text's failures are the
bits of a mask, and whatever is asked of an order of filters is a sum over masks, so the
corpus is read once: counts by mask stand for all 120 orders.

E needs the whole table. Texts are routed by their xxhash to partitions, sorted by hash;
under a hash stands a chain of links (full text, smallest id), so that texts that share a
hash stay apart. Ids that are not the smallest are given out as failing. The same chains
run in each task before the shuffle: copies that meet a smaller id there fail at once,
and of each text only the smallest id's rows travel, so a text that a third of all rows
share crosses the network once a task. Labels are joined to masks without texts, and
``combineByKey`` adds the count vectors of each part.

Cases: null and empty texts are one text without words; a null id is larger than any
other; rows of equal id and text don't fail E by each other; several labels of an id
count as set if one of them is; a null source is the part ''; an empty table has no
parts and gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import partitions, table

FILTERS = "ABCDE"
#: Bytes of texts that a task's chains hold, and rows it holds back, before it sends them on.
HELD_BYTES, HELD_ROWS = 64 << 20, 50_000
#: Bytes of texts of a routed partition, at most on average; a task sorts it by hash.
ROUTED_BYTES = 128 << 20

_E = 1 << FILTERS.index("E")
_SIGNS = re.compile(rb"[#$%&*|]")
_MASKS = 1 << len(FILTERS)


def failures(raw: bytes) -> int:
    """Mask of the filters A to D that a text fails; bytes.split() cuts at [\\x20\\x09-\\x0D]."""
    words = raw.split()
    data = np.frombuffer(raw, np.uint8)
    points = int(np.count_nonzero((data & 0xC0) != 0x80))
    capitals = int(np.count_nonzero((data >= 65) & (data <= 90)))
    few = 100 * len(set(words)) < 65 * len(words)
    return (len(words) < 50) | few << 1 | (100 * capitals > 5 * points) << 2 | (_SIGNS.search(raw) is not None) << 3


def _smaller(a: object, b: object) -> bool:
    return a is not None and (b is None or a < b)


class Chains:
    """Links [text, mask, smallest id, rows by part] under each hash of a text."""

    def __init__(self) -> None:
        self.links: dict[int, list[list]] = {}
        self.bytes = 0

    def add(self, key: int, raw: bytes, mask: int, doc_id: object, parts: Counter) -> Iterator[tuple]:
        """Takes rows of one id and text; gives (id, part, mask, rows) of those that fail E by it."""
        chain = self.links.setdefault(key, [])
        link = next((x for x in chain if x[0] == raw), None)
        if link is None:
            chain.append([raw, mask, doc_id, parts])
            self.bytes += len(raw) + 400
        elif link[2] == doc_id:
            link[3] += parts
        else:
            if _smaller(doc_id, link[2]):
                doc_id, parts, link[2], link[3] = link[2], link[3], doc_id, parts
            for part, n in parts.items():
                yield doc_id, part, mask | _E, n

    def clear(self) -> Iterator[tuple[int, list]]:
        for key, chain in self.links.items():
            for link in chain:
                yield key, link
        self.links, self.bytes = {}, 0


def _routed(rows: Iterable[tuple]) -> Iterator[tuple[int, tuple]]:
    """Rows (id, part, text) to records by hash: undecided ones with their text, failing ones without."""
    chains, failing = Chains(), Counter()

    def travelling() -> Iterator[tuple[int, tuple]]:
        for key, (raw, mask, doc_id, parts) in chains.clear():
            yield key, (doc_id, parts, mask, raw)

    def settled() -> Iterator[tuple[int, tuple]]:
        for (doc_id, part, mask), n in failing.items():
            yield xxhash.xxh64_intdigest(f"{doc_id}\0{part}"), (doc_id, Counter({part: n}), mask, None)
        failing.clear()

    for doc_id, part, text in rows:
        raw = bytes(text)
        for *row, n in chains.add(xxhash.xxh64_intdigest(raw), raw, failures(raw), doc_id, Counter({part: 1})):
            failing[tuple(row)] += n
        if chains.bytes > HELD_BYTES:
            yield from travelling()
        if len(failing) > HELD_ROWS:
            yield from settled()
    yield from travelling()
    yield from settled()


def _decided(records: Iterable[tuple[int, tuple]]) -> Iterator[tuple]:
    """Records in hash order to (id, part, mask, rows); one hash's chain is held at a time."""
    chains, at = Chains(), None

    def smallest() -> Iterator[tuple]:
        for _, (_, mask, doc_id, parts) in chains.clear():
            for part, n in parts.items():
                yield doc_id, part, mask, n

    for key, (doc_id, parts, mask, raw) in records:
        if raw is None:
            for part, n in parts.items():
                yield doc_id, part, mask, n
            continue
        if key != at:
            yield from smallest()
            at = key
        yield from chains.add(key, raw, mask, doc_id, parts)
    yield from smallest()


def masks(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask, n: rows of each id by part and the filters they fail."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    part = F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = docs.select("doc_id", part.alias("part"), text.alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    held = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(partitions(spark), held // ROUTED_BYTES + 1)
    routed = rows.rdd.mapPartitions(_routed).repartitionAndSortWithinPartitions(n, lambda key: key)
    return spark.createDataFrame(routed.mapPartitions(_decided), f"doc_id {kind}, part string, mask int, n bigint", verifySchema=False)


def counts(masked: DataFrame, labels: DataFrame):
    """RDD of (part, vector): rows, good rows and toxic rows by mask."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")
    )
    by_id = masked.groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n"))  # one row for a hot id before the join
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).cast("int")
    rows = by_id.join(known, "doc_id", "left").select("part", "mask", "n", flag("good"), flag("toxic"))

    def start(row: tuple) -> np.ndarray:
        return more(np.zeros((3, _MASKS), np.int64), row)

    def more(vector: np.ndarray, row: tuple) -> np.ndarray:
        mask, n, good, toxic = row
        vector[:, mask] += (n, n * good, n * toxic)
        return vector

    return rows.rdd.map(lambda r: (r[0], tuple(r[1:]))).combineByKey(start, more, np.add)


def report(part: str, vector: np.ndarray) -> Iterator[tuple]:
    """Rows of all orders of the filters for one part."""
    every = np.arange(_MASKS)
    fails = {f: (every >> k & 1).astype(bool) for k, f in enumerate(FILTERS)}
    only = {f: int(vector[0, 1 << k]) for k, f in enumerate(FILTERS)}
    steps, shapley = [], Counter()
    for order in permutations(FILTERS):
        there = np.ones(_MASKS, bool)
        for step, f in enumerate(order, 1):
            gone = there & fails[f]
            removed, good, toxic = (int(x) for x in vector[:, gone].sum(axis=1))
            redundant = int(vector[0, fails[f] & ~there].sum())
            there &= ~fails[f]
            shapley[f] += removed
            steps.append((f, "".join(order), step, int(vector[0, there].sum()), removed, redundant, only[f], good, toxic))
    for f, *row in steps:
        yield (part, *row, shapley[f])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step; ``shapley`` divided by 120 is the filter's mean removal."""
    schema = "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
    return docs.sparkSession.createDataFrame(counts(masks(docs), labels).flatMap(lambda x: report(*x)), schema, verifySchema=False)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES = {
    "op12_filter_audit": r"""
WITH texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, min(doc_id) OVER (PARTITION BY t) AS least_id FROM texts),
masked AS (SELECT doc_id, part, CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
  + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INT)
  + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(least_id < doc_id, least_id IS NOT NULL) AS INT) AS mask FROM words),
known AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
vectors AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM masked LEFT JOIN known USING (doc_id) GROUP BY part, mask),
filters(f, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, s AS step, bits[s] AS bit, CAST(list_sum(bits[1:s - 1]) AS INT) AS before FROM orders, range(1, 6) r(s)),
found AS (SELECT part, filter_order, step, bit,
  coalesce(sum(n) FILTER (WHERE mask & (coalesce(before, 0) + bit) = 0), 0) AS kept,
  coalesce(sum(n) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0) AS removed,
  coalesce(sum(n) FILTER (WHERE mask & coalesce(before, 0) > 0 AND mask & bit > 0), 0) AS redundant,
  coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
  coalesce(sum(good) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0) AS good_lost,
  coalesce(sum(toxic) FILTER (WHERE mask & coalesce(before, 0) = 0 AND mask & bit > 0), 0) AS toxic_lost
  FROM vectors, steps GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM found"""
}
QUERIES = {"op12_filter_audit": op12_filter_audit}
