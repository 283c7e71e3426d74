"""Quality classifier: naive Bayes support vectors.

Features are indicators of word n-grams, of every word's last two and three bytes, and
of a word standing two, three or four times in a row, in ``2**BITS`` hashed places. A place's log-count ratio between the classes scales its
indicator; on the scaled, length-normalised rows dual coordinate descent fits a linear
model with hinge loss. A logistic curve through the margins of rows kept back from
that fit turns margins into probabilities.

The fit sees at most ``TRAIN_ROWS`` labelled rows: those with the smallest hashes of
their ids. Everything else covers all rows. The sample's ids are the one thing that is
broadcast, and the weights (4 * 2**BITS bytes), both bounded.

Cases: null text is empty; a text without words scores by the intercept alone; labels
other than 0 and 1 and null ids are not learned from; of several labels for one id the
lower counts; without rows of both classes every score is the share of class 1 (1 if
there are no labels at all); rows with equal ids are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._spark import passing, table
from ._vec import Block, as_binary, blocks, doc_of, mix, prefix_hash, range_hash, words

BITS = 20
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
#: Smoothing of counts, the hinge loss's bound on a row's weight, passes over the rows.
ALPHA, COST, EPOCHS = 1.0, 4.0, 12
#: The fit ends before that many passes when no step of one is larger.
TOLERANCE = 1e-3


def features(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashed places of a block's distinct n-grams, grouped by document, and group edges."""
    start, end, first = words(block)
    docs = len(first) - 1
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(docs + 1, np.int64)
    doc, h = doc_of(first), prefix_hash(block.data)
    one = range_hash(h, start, end)
    tails = [mix(range_hash(h, np.maximum(start, end - n), end) ^ np.uint64(0x7A11 + n)) for n in (2, 3)]
    same = doc[1:] == doc[:-1]
    two = mix(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[same]
    again = same & (one[1:] == one[:-1])
    runs = [again, again[1:] & again[:-1], again[2:] & again[1:-1] & again[:-2]]
    run_doc = [doc[len(doc) - len(r) :][r] for r in runs]
    run_place = [np.full(len(d), mix(np.array([i + 1], np.uint64))[0]) for i, d in enumerate(run_doc)]
    place = np.concatenate([one, two, *tails, *run_place]) >> np.uint64(64 - BITS)
    key = np.unique((np.concatenate([doc, doc[1:][same], doc, doc, *run_doc]) << BITS) | place.astype(np.int64))
    return key & ((1 << BITS) - 1), np.searchsorted(key >> BITS, np.arange(docs + 1))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[first[1:]] - total[first[:-1]]


def _counts(rows: list[np.ndarray]) -> np.ndarray:
    """How many rows hold each place, a million places or one row more at a time."""
    total, part, held = np.zeros(1 << BITS, np.int64), [], 0
    for r in rows:
        part.append(r)
        held += len(r)
        if held >= 1 << 20:
            total += np.bincount(np.concatenate(part), minlength=1 << BITS)
            part, held = [], 0
    return total + np.bincount(np.concatenate(part), minlength=1 << BITS) if part else total


def fit(rows: list[np.ndarray], label: np.ndarray) -> dict[str, np.ndarray | float]:
    """Weights from rows of feature places and their labels.

    Beside the rows it holds arrays of 2**BITS places only: scaled rows are made when they are used.
    """
    share = float(label.mean()) if len(label) else 1.0
    none = {"ratio": np.zeros(1 << BITS, np.float32), "weight": np.zeros(1 << BITS, np.float32), "bias": 0.0, "slope": 0.0, "level": float(np.log((share + 1e-6) / (1 - share + 1e-6)))}
    if len(label) < 10 or label.min() == label.max():
        return none
    counts = [_counts([r for r, y in zip(rows, label) if y == c]) + ALPHA for c in (0, 1)]
    ratio = np.log((counts[1] / (np.sum(label == 1) + 2 * ALPHA)) / (counts[0] / (np.sum(label == 0) + 2 * ALPHA)))
    ratio[(counts[0] + counts[1]) <= 2 * ALPHA + 1] = 0.0  # seen once: says nothing about other rows
    norm, diagonal = np.zeros(len(rows)), np.ones(len(rows))
    for i, r in enumerate(rows):
        x = ratio[r]
        norm[i] = max(np.sqrt(x @ x), 1e-9)
        x /= norm[i]
        diagonal[i] += x @ x
    y = np.where(label == 1, 1.0, -1.0)
    cost = COST * np.where(label == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
    kept_back = np.arange(len(rows)) % 5 == 4
    order = np.flatnonzero(~kept_back)
    w, bias, alpha, rng = np.zeros(1 << BITS), 0.0, np.zeros(len(rows)), np.random.default_rng(7)
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(order):
            r = rows[i]
            x = ratio[r] / norm[i]
            gradient = y[i] * (w[r] @ x + bias) - 1.0
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                w[r] += step * x
                bias += step
                alpha[i] = new
                moved = max(moved, abs(step))
        if moved < TOLERANCE:
            break
    margin = np.array([w[rows[i]] @ (ratio[rows[i]] / norm[i]) + bias for i in np.flatnonzero(kept_back)])
    slope, level = _logistic(margin, label[kept_back].astype(float))
    return {"ratio": ratio.astype(np.float32), "weight": (w * ratio).astype(np.float32), "bias": float(bias), "slope": slope, "level": level}


def _in_order(ids: np.ndarray, label: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Order by id, then label, then the row's bytes."""
    order = np.lexsort((label, ids))
    edge = np.flatnonzero(np.diff(ids[order], prepend=ids[order][:1] - 1, append=ids[order][-1:] + 1)) if len(order) else order
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if b - a > 1:
            order[a:b] = sorted(order[a:b], key=lambda k: (label[k], rows[k].tobytes()))
    return order


def _logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Newton's method for a logistic curve; targets drawn in as Platt does, a weak prior on the slope."""
    pos = label.sum()
    t = np.where(label == 1, (pos + 1) / (pos + 2), 1 / (len(label) - pos + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g = np.array([(p - t) @ margin + 1e-3 * a, (p - t).sum()])
        s = p * (1 - p) + 1e-9
        hess = np.array([[s @ margin**2 + 1e-3, s @ margin], [s @ margin, s.sum()]])
        move = np.linalg.solve(hess, g)
        a, b = a - move[0], b - move[1]
        if np.abs(move).max() < 1e-8:
            break
    return float(a), float(b)


def scores(block: Block, model: dict) -> np.ndarray:
    place, first = features(block)
    norm = np.sqrt(_sums(model["ratio"][place].astype(np.float64) ** 2, first))
    margin = _sums(model["weight"][place], first) / np.maximum(norm, 1e-9) + model["bias"]
    return 1 / (1 + np.exp(-np.clip(model["slope"] * margin + model["level"], -40, 40)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, *, rows: int = TRAIN_ROWS) -> dict:
    """Fits on at most ``rows`` labelled documents (doc_id, text); labels: doc_id, label.

    The features of these rows meet in one task, and its weights come to the driver.
    """
    spark = docs.sparkSession
    chosen = (
        labels.where("label in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    ).collect()
    ids = spark.sparkContext.broadcast(dict(tuple(r) for r in chosen))  # at most ``rows`` pairs

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = ids.value
        wanted = pa.array(list(known), pa.int64())
        for batch in batches:
            batch = batch.filter(pa.compute.is_in(batch.column(0), value_set=wanted))
            for block in blocks(batch.column(1)):
                place, first = features(block)
                doc = batch.column(0).slice(block.first, len(first) - 1)
                yield pa.RecordBatch.from_arrays(
                    [doc, pa.array([known[d] for d in doc.to_pylist()], pa.int32()), pa.array([place[a:b].astype("<i4").tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())],
                    ["doc_id", "label", "places"],
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, ids, label = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for b in batches:  # rows are views of the batches' bytes
            data, edges = as_binary(b.column(2))
            rows += [data[x:y].view("<i4") for x, y in zip(edges[:-1], edges[1:])]
            ids.append(b.column(0).to_numpy())
            label.append(b.column(1).to_numpy().astype(np.int64))
        order = _in_order(np.concatenate(ids), label := np.concatenate(label), rows)
        order = order[np.random.default_rng(3).permutation(len(order))]
        m = fit([rows[i] for i in order.tolist()], label[order])
        yield pa.RecordBatch.from_arrays(
            [pa.array([m["ratio"].tobytes()]), pa.array([m["weight"].tobytes()]), *(pa.array([m[k]]) for k in ("bias", "slope", "level"))],
            ["ratio", "weight", "bias", "slope", "level"],
        )

    if not chosen:
        return fit([], np.zeros(0, int))
    found = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null").mapInArrow(featurise, "doc_id long, label int, places binary")
    got = found.repartition(1).mapInArrow(learn, "ratio binary, weight binary, bias double, slope double, level double").collect()
    if not got:
        return fit([], np.zeros(0, int))
    return got[0].asDict() | {k: np.frombuffer(got[0][k], np.float32) for k in ("ratio", "weight")}


def score(docs: DataFrame, model: dict, *, text: str = "text", column: str = "score") -> DataFrame:
    """Adds the probability of class 1 to all rows; other columns pass through."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:  # only texts go to Python, and only scores come back
        got = [scores(block, sent.value) for block in blocks(texts)]
        return pa.array(np.concatenate(got) if got else np.zeros(0), pa.float64())

    return docs.withColumn(column, run(F.col(text)))


def _training(docs: DataFrame, labels: DataFrame) -> dict:
    usable = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).where(~held_out(F.col("doc_id")))
    return train(docs, usable)


@passing("doc_id", "text")
def accepted(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, with their own columns."""
    return score(docs, _training(docs, labels), column="__quality").where(F.col("__quality") >= threshold).drop("__quality")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = _training(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
ORACLES: dict[str, str] = {}
