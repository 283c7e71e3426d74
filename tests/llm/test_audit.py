"""The audit of filters against brute force; awkward tables."""

import random
from itertools import permutations

import pytest

from fleetlens.llm import filter_audit as fa


def brute(rows, labels):
    """Applies the filters one after the other, for every order."""
    import re

    texts = [(i, s or "", t or "") for i, s, t in rows]
    fails = []
    for i, _, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails.append({
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": any(u == t and j is not None and (i is None or j < i) for j, _, u in texts),
        })
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    out = []
    for part in {s for _, s, _ in texts}:
        own = [(texts[k][0], fails[k]) for k in range(len(texts)) if texts[k][1] == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, left_after = [x for x in left if x[1][f]], [x for x in left if not x[1][f]]
                redundant = sum(x[1][f] for x in own) - len(gone)
                only = sum(x[1][f] and sum(x[1].values()) == 1 for x in own)
                shapley[f] += len(gone)
                found.append((f, (part, "".join(order), step, len(left_after), len(gone), redundant, only, sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone))))
                left = left_after
        out += [(*row, shapley[f]) for f, row in found]
    return sorted(out)


@pytest.mark.parametrize("held", [(64 << 20, 50_000), (300, 3)])
def test_against_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(fa, "HELD_BYTES", held[0])
    monkeypatch.setattr(fa, "HELD_ROWS", held[1])
    rng = random.Random(2)
    words = ["alpha", "Beta", "é", "x#y", "GAMMA", "a&b", " ", "\x85", "z"]
    text = lambda: rng.choice([" ", "\x0b", "\t\n"]).join(rng.choices(words[: rng.randrange(1, 10)], k=rng.choice([3, 20, 55])) + [str(k) for k in range(rng.choice([0, 10, 90]))])
    pool = [text() for _ in range(40)] + ["", None, "A" * 3000]
    rows = [(rng.choice([None, *range(150)]), rng.choice(["s", "s", "t", "", None]), rng.choice(pool)) for _ in range(200)] + [(9, "s", "hot")] * 40 + [(None, "t", "hot")] * 30
    labels = [(rng.choice([None, *range(160)]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS part", "2 AS mask", "3 AS n", "4 AS good").repartition(7)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in fa.audit(docs, table).collect()) == brute(rows, labels)


def test_texts_under_one_hash_stay_apart():
    """The chain of a hash holds several texts."""
    from collections import Counter

    chains = fa.Chains()
    out = [r for raw, i in ((b"x", 3), (b"y", 1), (b"x", 2), (b"y", 4), (b"x", 2)) for r in chains.add(7, raw, 0, i, Counter({"s": 1}))]
    assert sorted(out) == [(3, "s", 16, 1), (4, "s", 16, 1)]
    assert sorted((raw, i, n["s"]) for _, (raw, _, i, n) in chains.clear()) == [(b"x", 2, 2), (b"y", 1, 1)]


def test_string_ids_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "s", "t"), ("a", "s", "t")], "doc_id string, source string, text string")
    labels = spark.createDataFrame([("b", 1, 0)], "doc_id string, quality int, toxic int")
    row = fa.audit(docs, labels).where("filter_order = 'EABCD' AND step = 1").first()
    assert (row.kept, row.removed, row.good_lost) == (1, 1, 1)
    assert fa.audit(docs.limit(0), labels).count() == 0
    assert fa.audit(docs, labels.limit(0)).count() == 600
