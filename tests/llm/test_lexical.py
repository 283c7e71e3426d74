"""Ranked search against brute force; awkward tables."""

import random
import re
from collections import Counter
from math import floor, log

import pytest

from fleetlens.llm import lexical


def terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, k=20):
    cut = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(t for _, c in cut for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(terms(text)), []
        for i, c in cut:
            m = 75 + 25 * sum(c.values()) * n_docs // max(length, 1)
            s = sum(q * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, q in asked.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("sizes", [(8192, 4096, 1 << 20), (16, 3, 20)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("DOC_BLOCK", "ITEM_BLOCK", "TEXT_BYTES"), sizes):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(8)
    words = ["Éa", "éa", "ÉA", "x1", "X1", "_", "don't", " ", "\x85", "日本", "a"] + [f"w{k}" for k in range(60)]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "-", "\x00", "\n"]) for _ in range(n))
    docs = [(i, text(rng.randrange(0, 60))) for i in range(300)] + [(i, "w1 w2 w3 same") for i in range(300, 360)] + [(None, "w1 w2"), (None, None), (400, ""), (401, "#?"), (402, "w5 " * 5000)]
    items = [(i, text(rng.randrange(1, 30))) for i in range(12)] + [(3, "w1 w1 w1"), (None, "w5"), (20, None), (21, ""), (22, "unheard")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS n", "2 AS terms", "3 AS item", "4 AS score").repartition(6)
    asked = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "5 AS rank").coalesce(1)
    got = sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in lexical.search(df, asked).collect()), key=str)
    assert got == brute(docs, items)


def test_empty_tables_and_string_ids(spark):
    docs = spark.createDataFrame([("b", "one two"), ("a", "one two"), ("c", "three")], "doc_id string, text string")
    items = spark.createDataFrame([("q", "One")], "item_id string, text string")
    assert [tuple(r)[:3] for r in lexical.search(docs, items).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b")]
    assert lexical.search(docs.limit(0), items).count() == 0 == lexical.search(docs, items.limit(0)).count()
    assert lexical.search(docs, items).dtypes == lexical.search(docs, items.limit(0)).dtypes
