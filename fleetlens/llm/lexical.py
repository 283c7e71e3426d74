"""Ranked lexical search: the best documents for each item of a query set.

Scores are a sparse product: items by terms (how often an item holds a term) times terms
by documents (an integer impact of the term in the document). Documents are read once for
a block of items and leave rows (id, number of terms, term numbers, occurrences) for the
terms of the block only. Counts over all of them fix the weights. The product then runs
over blocks of documents, row by row as Gustavson has it: for an item, the postings of
its terms are merged into an array of one sum a document, in numpy and 64-bit integers.
Each block's best are merged into the task's best, and two rounds of windows, the first
salted by task, leave each item's best of all.

Items are taken in blocks of bounded number and bytes, and only such a block's terms go
to the tasks. Documents are never compared in pairs nor gathered by key.

Cases: null and empty texts hold no terms, on both sides; such documents count nowhere,
such items give no rows. Items are rows: two with one id are ranked apart. Equal scores
stand by ascending id, null ids last, equal ids in any order. An empty table of either
kind gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from math import floor, log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import fresh_path, materialize, table

TOP_K = 20
#: Items of a block, and bytes of their texts (a single longer item is a block of its own).
ITEM_BLOCK, ITEM_BYTES = 4096, 16 << 20
#: Documents whose sums are held at once, and bytes of a text that are cut into terms at once.
DOC_BLOCK, TEXT_BYTES = 8192, 1 << 20
#: Salts of the first round of windows.
SALTS = 64

#: A-Z to a-z; ASCII signs and controls to blanks; digits, letters and all other bytes stay.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(raw: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, in order, some at a time."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + TEXT_BYTES)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


class Items:
    """A block of items: their ids, and term numbers with multiplicities, row after row."""

    def __init__(self, rows: list[tuple]):
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [item_id for item_id, _ in rows]
        self.rows = []
        for _, raw in rows:
            held = Counter(t for some in terms_of(bytes(raw or b"")) for t in some)
            self.rows.append([(self.vocabulary.setdefault(t, len(self.vocabulary)), n) for t, n in held.items()])


def blocks(items: DataFrame, size: int = ITEM_BLOCK, most: int = ITEM_BYTES) -> Iterator[Items]:
    """Items (item_id, text) in blocks; the driver holds one at a time."""
    rows, held = [], 0
    for item_id, text in items.select("item_id", F.col("text").cast("binary")).toLocalIterator():
        if rows and (len(rows) >= size or held + len(text or b"") > most):
            yield Items(rows)
            rows, held = [], 0
        rows.append((item_id, text))
        held += len(text or b"")
    if rows:
        yield Items(rows)


def occurrences(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tf (numbers and occurrences of those in the vocabulary).

    ``vocabulary`` is a broadcast dictionary.
    """
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches):
        number = vocabulary.value.get
        for batch in batches:
            total, found, times, ends = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int32)], [0]
            for text in batch.column(1):
                n, hits = 0, []
                for some in terms_of(text.as_py() or b""):
                    n += len(some)
                    at = np.fromiter((number(t, -1) for t in some), np.int32, len(some))
                    hits.append(at[at >= 0])
                terms, tf = np.unique(np.concatenate([np.zeros(0, np.int32), *hits]), return_counts=True)
                total.append(n)
                found.append(terms)
                times.append(tf.astype(np.int32))
                ends.append(ends[-1] + len(terms))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(x))) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, pa.int64()), *lists], ["doc_id", "n", "terms", "tf"])

    return rows.mapInArrow(count, f"doc_id {kind}, n bigint, terms array<int>, tf array<int>")


def weights(matrix: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N, L and the weight of each of ``size`` terms, counted over all documents."""
    n, length = matrix.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for term, held in matrix.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():
        df[term] = held
    return n, length, np.array([floor(1000 * log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _block_best(rows: pa.Table, items: Items, n_docs: int, length: int, weight: np.ndarray, k: int) -> pa.Table:
    """Best ``k`` of a block of documents for each item: item, doc_id, score."""
    ids = rows["doc_id"].combine_chunks()
    n = rows["n"].to_numpy()
    term, tf = (rows[c].combine_chunks().flatten().to_numpy() for c in ("terms", "tf"))
    doc = np.repeat(np.arange(len(n)), pc.list_value_length(rows["terms"]).to_numpy())
    m = 75 + 25 * n * n_docs // max(length, 1)
    tf = tf.astype(np.int64)
    impact = weight[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[doc]))
    order = np.argsort(term, kind="stable")
    doc, impact = doc[order], impact[order]
    edge = np.searchsorted(term[order], np.arange(len(weight) + 1))
    rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy()
    item, at, score = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, row in enumerate(items.rows):
        total = np.zeros(len(n), np.int64)
        for t, times in row:
            a, b = edge[t], edge[t + 1]
            total[doc[a:b]] += times * impact[a:b]
        best = np.flatnonzero(total)
        if len(best) > k:
            best = best[total[best] >= np.partition(total[best], -k)[-k]]
        best = best[np.lexsort((rank[best], -total[best]))[:k]]
        item.append(np.full(len(best), i, np.int32))
        at.append(best)
        score.append(total[best])
    return pa.table({"item": np.concatenate(item), "doc_id": ids.take(pa.array(np.concatenate(at))), "score": np.concatenate(score)})


def _best(found: pa.Table, k: int) -> pa.Table:
    found = found.sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
    item = found["item"].to_numpy()
    first = np.searchsorted(item, item)
    return found.filter(pa.array(np.arange(len(item)) - first < k))


def search(docs: DataFrame, items: DataFrame, k: int = TOP_K) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) of each item (item_id, text)."""
    spark = docs.sparkSession
    item_kind, doc_kind = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    done = [_search_block(spark, docs, block, k, item_kind, doc_kind) for block in blocks(items)]
    return reduce(DataFrame.unionByName, done) if done else spark.createDataFrame([], f"item_id {item_kind}, rank int, doc_id {doc_kind}, score bigint")


def _search_block(spark: SparkSession, docs: DataFrame, items: Items, k: int, item_kind: str, doc_kind: str) -> DataFrame:
    context = spark.sparkContext
    matrix = materialize(occurrences(docs, context.broadcast(items.vocabulary)), "lexical")
    n_docs, length, weight = weights(matrix, len(items.vocabulary))
    shared = context.broadcast((items, weight))

    def product(batches):
        block, weigh = shared.value
        best, held, size = None, [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, DOC_BLOCK):
                held.append(batch.slice(at, DOC_BLOCK))
                size += held[-1].num_rows
                if size >= DOC_BLOCK:
                    best, held, size = merged(best, held, block, weigh), [], 0
        if held:
            best = merged(best, held, block, weigh)
        if best is not None:
            names = pa.array(block.ids).take(best["item"].combine_chunks())
            yield from best.append_column("item_id", names).combine_chunks().to_batches()

    def merged(best, held, block, weigh):
        found = _block_best(pa.Table.from_batches(held), block, n_docs, length, weigh, k)
        return _best(pa.concat_tables([best, found]) if best is not None else found, k)

    found = matrix.mapInArrow(product, f"item int, doc_id {doc_kind}, score bigint, item_id {item_kind}")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    some = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item", "salt").orderBy(*order))).where(F.col("rank") <= k)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES = {
    "op13_lexical_search": r"""
WITH cut AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
asked AS (SELECT i, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
multiplicity AS (SELECT i, item_id, term, count(*) AS q FROM asked GROUP BY ALL),
sizes AS (SELECT count(*) FILTER (WHERE len(w) > 0) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS total FROM cut),
held AS (SELECT d, doc_id, len(w) AS n, unnest(w) AS term FROM cut),
tfs AS (SELECT d, doc_id, n, term, count(*) AS tf FROM held WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
impacts AS (SELECT d, doc_id, term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
  * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // total))) AS impact FROM tfs JOIN dfs USING (term), sizes),
scores AS (SELECT i, item_id, d, doc_id, CAST(sum(q * impact) AS BIGINT) AS score FROM multiplicity JOIN impacts USING (term) GROUP BY ALL),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20"""
}
QUERIES = {"op13_lexical_search": op13_lexical_search}
