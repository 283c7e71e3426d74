"""Enumeration over companies and prefixes, against a walk through the graph."""

import random

import pytest

from fleetlens.operators import enumeration


def test_rounds_against_a_walk(spark):
    rng = random.Random(3)
    rows = [(i, f"{rng.choice(['Motor', 'House', 'Lone'])} {rng.randrange(40)}", f"P{rng.randrange(45)}") for i in range(90)] + [(90, None, "P1"), (91, "House 1", None), (92, "Motor x", None)]
    near = {}
    for _, c, p in rows:
        if c and p:
            near.setdefault(c, set()).add(p)
    depth = {c: 0 for _, c, _ in rows if c and "Motor" in c}
    edge = set(depth)
    while edge:
        asked = set().union(*(near.get(c, set()) for c in edge))
        edge = {c for c, ps in near.items() if ps & asked and c not in depth}
        depth |= dict.fromkeys(edge, max(depth.values()) + 1)
    df = spark.createDataFrame(rows, "product long, company string, prefix string")
    assert {r.company: r.round for r in enumeration.closure(df, ["Motor"]).collect()} == depth
    got = {r["product"]: (r["round"], r.missed) for r in enumeration.enumerated(df, ["Motor"]).collect()}
    assert got == {i: (depth.get(c), "Motor" not in (c or "")) for i, c, _ in rows}


def test_a_chain_longer_than_allowed_is_an_error(spark):
    df = spark.createDataFrame([(k, f"{'Motor' if k == 0 else 'C'} {k}", f"P{k + d}") for k in range(6) for d in (0, 1)], "product long, company string, prefix string")
    with pytest.raises(ValueError, match="after 3 rounds"):
        enumeration.closure(df, ["Motor"], most=3)
    assert enumeration.closure(df, ["Motor"], most=6).count() == 6
    assert enumeration.closure(df, [], most=6).count() == 0 == enumeration.closure(df.limit(0), ["Motor"]).count()


def test_coverage_by_sampled_prefix(spark):
    df = spark.createDataFrame([(1, "a", "X"), (2, "a", "X"), (2, "b", "X"), (3, "c", "Y"), (4, "d", "Z")], "product long, company string, prefix string")
    got = enumeration.sampled_coverage(df, df.where("product IN (1, 3)"), spark.createDataFrame([("X",), ("Y",), ("X",), ("Q",)], "prefix string"))
    assert sorted(tuple(r) for r in got.collect()) == [("X", 2, 1), ("Y", 1, 0)]
