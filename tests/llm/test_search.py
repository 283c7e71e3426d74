"""Near-duplicates, long repeats and vectors against brute force; awkward inputs."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetlens.llm import minhash, suffixes, vectors
from fleetlens.llm._vec import mix

WORDS = [f"w{i}" for i in range(2000)]


def edited(words, n, rng):
    words = words[:]
    for p in rng.sample(range(len(words)), n):
        words[p] = rng.choice(WORDS)
    return words


def bag(text):
    w = [x for x in re.split("[ \t\n\x0b\x0c\r]+", text.lower()) if x]
    return Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def roots(n, linked):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                up[b] = a
    return [find(i) for i in range(n)]


def test_near_copies_hub_chain_and_strangers(spark):
    rng = random.Random(5)
    hub = rng.choices(WORDS, k=200)
    docs = [edited(hub, rng.choice([2, 3, 4, 6]), rng) for _ in range(60)] + [hub, hub]
    chain = rng.choices(WORDS, k=200)
    for _ in range(25):
        docs.append(chain)
        chain = edited(chain, 3, rng)
    rng.shuffle(docs)
    docs += [rng.choices(WORDS, k=80) for _ in range(20)] + [[], [], ["a", "b"], ["A", "b"], ["x"] * 400]
    texts = [" ".join(d) for d in docs]
    bags = [bag(t) for t in texts]

    def linked(i, j):
        shared = sum((bags[i] & bags[j]).values())
        union = sum(bags[i].values()) + sum(bags[j].values()) - shared
        return texts[i] == texts[j] or (union and shared / union >= 0.8)

    want = roots(len(texts), linked)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in minhash.classes(df).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert sorted(r.doc_id for r in minhash.deduplicated(df).collect()) == sorted(set(want))


@pytest.mark.parametrize("seed", range(3))
def test_signatures_estimate_weighted_jaccard(seed):
    rng, errors = np.random.default_rng(seed), []
    for trial in range(20):
        a = rng.integers(0, 9, 60) ** 2
        b = np.where(rng.random(60) < 0.7, a, rng.integers(0, 9, 60))
        f = mix(np.arange(60, dtype=np.uint64) + np.uint64(1000 * trial))
        s = minhash.signatures(np.concatenate([f[a > 0], f[b > 0]]), np.repeat([0, 1], [(a > 0).sum(), (b > 0).sum()]), np.concatenate([a[a > 0], b[b > 0]]), 2, 1024)
        errors.append((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.03


def test_near_dedup_of_awkward_tables(spark):
    schema = "doc_id long, text string, node string, sig int, class_id int"
    rows = [(1, "a b c d e f", "x", 1, 1), (1, "a b c d e f", "x", 1, 1), (None, None, None, None, None), (2, "", None, 2, 2), (3, "a b c d e f", "y", 1, 1), (None, "q" * 5000, "z", 1, 1)]
    df = spark.createDataFrame(rows, schema)
    got = sorted((str(r.doc_id), str(r.class_id)) for r in minhash.classes(df).collect())
    assert got == [("1", "1"), ("1", "1"), ("2", "2"), ("3", "1"), ("None", "2"), ("None", "None")]
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == 3
    assert minhash.classes(spark.createDataFrame([], schema)).count() == 0


def test_near_dedup_chooses_a_row_per_class(spark):
    rng = random.Random(11)
    text = lambda: " ".join(rng.choices(WORDS, k=60))
    copy = text()
    rows = [(None, text()) for _ in range(20)] + [(7, text()), (7, text()), (8, copy), (8, copy), (9, copy), (None, copy), (5, None), (None, "")]
    rows += [(None, t) for t in [text()] * 3]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = Counter([(d, t) for d, t in rows[:22]] + [(8, copy), (5, None), rows[-1]])
    assert Counter((r.doc_id, r.text) for r in minhash.deduplicated(df).collect()) == want
    got = minhash.classes(df).collect()
    assert len(got) == len(rows) and Counter(r.doc_id for r in got if r.kept) == Counter(d for d, _ in want.elements())


def covered(texts, length):
    places = {}
    for i, t in enumerate(texts):
        for at in range(len(t) - length + 1):
            places.setdefault(t[at : at + length], []).append((i, at))
    marks = [np.zeros(len(t), bool) for t in texts]
    for found in places.values():
        if len(found) > 1:
            for i, at in found:
                marks[i][at : at + length] = True
    return marks


def cut(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in suffixes.cleaned(df).collect()}


@pytest.mark.parametrize("most, ways", [(16_000, 6), (3, 6), (2, 2)])
def test_repeats(spark, monkeypatch, most, ways):
    monkeypatch.setattr(suffixes, "TASK_CONTEXTS", most)
    monkeypatch.setattr(suffixes, "WAYS", ways)
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdé \n") for _ in range(n))
    shared, other = text(500), text(230)
    texts = [text(rng.randrange(0, 900)) for _ in range(30)]
    texts += [text(100) + shared + text(90), shared[:300] + text(50) + shared[100:], text(20) + shared[50:] , other + text(10), text(40) + other[:210], "a" * 700, "ab" * 300, "x" * 150, texts[0], texts[0], None, ""]
    for k in range(12):
        texts.append(text(37 + k) + shared[:260] + text(50))
    raw = [(t or "").encode() for t in texts]
    got = cut(spark, texts)
    for i, marks in enumerate(covered(raw, 200)):
        data = np.frombuffer(raw[i], np.uint8)
        spans = int((np.diff(np.concatenate([[0], marks.astype(int), [0]])) == 1).sum())
        r = got[i]
        assert (r["__removed"], r["__spans"], bytes(r["__kept"])) == (int(marks.sum()), spans, data[~marks].tobytes()), i


def test_a_hot_passage_is_split_into_groups(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "TASK_CONTEXTS", 40)
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared, ends = text(330), [text(120) for _ in range(5)]
    texts = [text(60) + rng.choice(ends)[: rng.randrange(1, 120)] + shared + rng.choice(ends)[: rng.randrange(1, 120)] + text(80) for _ in range(260)]
    sorter, largest = suffixes._sorted_twins, []

    def watched(contexts, tasks):
        largest.append(contexts.groupBy("group").count().agg({"count": "max"}).first()[0])
        return sorter(contexts, tasks)

    monkeypatch.setattr(suffixes, "_sorted_twins", watched)
    got = cut(spark, texts)
    for i, marks in enumerate(covered([t.encode() for t in texts], 200)):
        assert (got[i]["__removed"], bytes(got[i]["__kept"])) == (int(marks.sum()), np.frombuffer(texts[i].encode(), np.uint8)[~marks].tobytes()), i
    assert largest and largest[0] <= 40


def test_texts_without_repeats_stay(spark):
    a, b = "é" * 99 + "x" + "ü" * 120, "unique words here"
    df = spark.createDataFrame([(1, f"{a}tail one", 9), (2, f"other {a}", 9), (3, b, 9), (4, a, 9), (None, None, 1)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in suffixes.without_repeats(df).collect()}
    assert set(out) == {1, 2, 3, None} and out[3].text == b and out[1].text == "tail one" and out[2].text == "other " and out[1].n_chars == 8 and out[3].n_chars == 9
    assert suffixes.without_repeats(spark.createDataFrame([], df.schema)).count() == 0


def test_deep_shallow_orders_like_sorted():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 60))).encode() for _ in range(400)]
    texts += [b"a" * 50 + bytes([rng.randrange(97, 100)]) * rng.randrange(1, 9) for _ in range(100)]
    size = np.array([len(t) for t in texts])
    rows = np.frombuffer(b"".join(t.ljust(64, b"\0") for t in texts), np.uint8).reshape(-1, 64)
    group = np.array([i % 3 for i in range(len(texts))])
    order = suffixes.deep_shallow(group, rows, size, shallow=8)
    assert [(group[k], texts[k]) for k in order] == sorted((g, t) for g, t in zip(group, texts))


def test_vectors(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 32))
    x = np.concatenate([c + 0.25 * rng.normal(size=(20, 32)) for c in centre] + [rng.normal(size=(100, 32))])
    x[5] = x[3] * 2
    x[7] = x[6]
    data = [v.tolist() for v in x] + [None, [0.0] * 32, [float("nan")] + [1.0] * 31, [None] + [1.0] * 31, [1.0, 2.0]]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    want = roots(len(x), lambda i, j: near[i, j])
    df = spark.createDataFrame(list(enumerate(data)), "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in vectors.neighbours(df).collect()}
    assert len(got) == len(data) and near.sum() > 100
    found = sum(got[i].n_links for i in range(len(x)))
    assert 0.97 * near.sum() <= found <= near.sum() and all(got[i].n_links <= near[i].sum() for i in range(len(x)))
    assert np.mean([got[i].component_id == want[i] for i in range(len(x))]) > 0.97
    assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i in range(len(x), len(data)))
    assert vectors.neighbours(df.where("vec_id < 0")).count() == 0


def test_vectors_of_several_lengths(spark):
    rows = [(1, [1.0, 2.0], 5), (2, [1.0, 2.0], 5), (3, [2.0, 4.0], 5), (4, [1.0, 0.0, 0.0], 5), (5, [0.0, 1.0, 0.0], 5), (6, [5.0, 0.1, 0.0], 5), (7, [-3.0], 5), (8, [4.0], 5), (9, [2.0], 5), (None, [2.0], 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, sound int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.neighbours(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (1, 4, True), 5: (0, 5, True), 6: (1, 4, False), 7: (0, 7, True), 8: (1, 8, True), 9: (1, 8, False), None: (0, None, True)}


@pytest.mark.parametrize("k", [1, 2, 3, 4])
def test_links_at_the_threshold_are_found_at_every_k(k):
    rng = np.random.default_rng(k)
    a = rng.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=a.shape)
    b -= (b * a).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * b
    tables = vectors.tables_for(k)
    x, y = vectors.hashes(a, k, tables), vectors.hashes(b, k, tables)
    found = (x[:, :, :1] == y).any((1, 2)) | (y[:, :, :1] == x).any((1, 2))
    assert found.mean() >= 0.99


def test_vector_blocks_count_the_same(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = [(np.eye(16)[0] + 0.02 * rng.normal(size=16)).tolist() for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 25)
    assert {(r.n_links, r.component_id) for r in vectors.neighbours(df).collect()} == {(119, 0)}


def test_digest_is_plain(spark):
    df = spark.createDataFrame([("é",), (None,)], "t string")
    from pyspark.sql import functions as F

    assert [bytes(r[0]) for r in df.select(minhash.text_key(F.col("t"))).collect()] == [hashlib.md5(b).digest() for b in ("é".encode(), b"")]


def test_vectors_broadcast_no_table_that_grows(spark):
    limit = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(limit)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(40, 16))
    rows = [(i, (base[i % 40] + 0.01 * rng.normal(size=16)).tolist()) for i in range(120)]
    spark.conf.set(limit, "1b")  # any broadcast fails
    try:
        got = vectors.neighbours(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    finally:
        spark.conf.set(limit, before)
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, 2, i % 40) for i in range(120)}
