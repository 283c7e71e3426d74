"""Fingerprints: sums of paragraphs, likeness and the edited texts of awkward tables."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, next string, place int"


def vectors(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "place int, text string")
    units = df.withColumn("unit", F.explode(fp.units(F.col("text"))))
    return fp.summed(units, "unit", "place")


def digests(df, column="vector"):
    return {r.place: r.d for r in df.select("place", fp.digest(F.col(column)).alias("d")).collect()}


def test_paragraphs_add_up_in_any_order(spark):
    rng = random.Random(3)
    lines = ["".join(rng.choices("abnz .,é\t", k=rng.randrange(1, 400))) for _ in range(30)]
    shuffled = rng.sample(lines, 30)
    found = digests(vectors(spark, ["\n".join(lines), "\n".join(shuffled), "\n".join(lines[:29]), "\n".join([*lines, lines[0]]), "", "\n"]))
    assert found[0] == found[1] and len(set(found.values())) == 5


def test_insertion_and_deletion_without_the_rest(spark):
    rng = random.Random(4)
    a, b = ("\n".join("".join(rng.choices("abmnz .,", k=2000)) for _ in range(5)) for _ in "ab")
    many = "\n".join(["m z. " * 9000] * 5)  # lanes pass 2^16
    v = vectors(spark, [a, b, f"{a}\n{b}", many, f"{many}\n{a}"]).groupBy().pivot("place", [0, 1, 2, 3, 4]).agg(F.first("vector"))
    sums = v.select(
        (fp.digest(fp.added(F.col("0"), F.col("1"))) == fp.digest(F.col("2"))).alias("put"), (fp.digest(fp.removed(F.col("2"), F.col("1"))) == fp.digest(F.col("0"))).alias("taken"),
        (fp.digest(fp.added(F.col("3"), F.col("0"))) == fp.digest(F.col("4"))).alias("put_many"), (fp.digest(fp.removed(F.col("4"), F.col("3"))) == fp.digest(F.col("0"))).alias("taken_many"),
    ).first()
    assert all(sums)


def bag(text):
    return Counter(p for p in re.split(fp.PIECES, text) if p)


def alike(a, b):
    a, b = bag(a), bag(b)
    shared = sum(n * b[p] for p, n in a.items())
    every = sum(n * n for n in a.values()) + sum(n * n for n in b.values()) - shared
    return shared / every if every else 1.0


@pytest.mark.parametrize("hot", [3, 10_000])
def test_edited_texts_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(fp, "HOT_ROWS", hot)
    monkeypatch.setattr(fp, "HOT_SHARE", 10)
    monkeypatch.setattr(fp, "STEP", 3)
    monkeypatch.setattr(fp, "UNFOLDED", 4)
    rng = random.Random(6)
    words = [f"{rng.choice('abmnxyz')}{i}é𝄞" for i in range(300)]
    some = lambda n: "".join(rng.choice(words) + rng.choice([" ", " ", ". ", "\n"]) for _ in range(n))
    rows = [(i, some(rng.randrange(0, 400))) for i in range(120)] + [(7, "seven"), (7, "seven"), (7, None), (-5, ""), (None, "lost"), (2**63 - 1, "top"), (-(2**63), "low")]
    rows += [(50, "many copies of one row.")] * 31 + [(None, None)] * 25
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit("clash")).withColumn("range", F.lit(1)).repartition(5)
    order = [
        (r.doc_id, r.text) for r in spark.createDataFrame([(i, t or "") for i, t in rows], "doc_id long, text string")
        .orderBy(F.col("doc_id").desc_nulls_last(), F.xxhash64("text").desc(), "text").collect()
    ]
    want = []
    for k, (i, text) in enumerate(order):
        after, cut = order[(k + 1) % len(order)][1], len(text) // 2
        edited = text[: len(text) - cut] + after[:cut]
        want.append((str(i), len(text), hashlib.sha256(edited.encode()).hexdigest(), alike(text, edited), alike(text, after)))
    got = [(str(r.doc_id), r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in fp.compare(df).collect()]
    assert sorted(r[:3] for r in got) == sorted(r[:3] for r in want)
    for a, b in zip(sorted(got), sorted(want)):
        assert abs(a[3] - b[3]) < 0.3
    assert abs(sum(r[3] for r in got) - sum(r[3] for r in want)) / len(rows) < 0.02
    assert abs(sum(r[4] for r in got) - sum(r[4] for r in want)) / len(rows) < 0.05


def test_equal_texts_and_single_rows(spark):
    one = fp.compare(spark.createDataFrame([(1, "a b c")], "doc_id long, text string")).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"a ba ").hexdigest() and one[0].near_next == 1
    two = {r.doc_id: r for r in fp.compare(spark.createDataFrame([("x", "same\ntext"), ("y", "same\ntext"), (None, "text\nsame")], "doc_id string, text string")).collect()}
    assert two["x"].fingerprint == two["y"].fingerprint == two[None].fingerprint and two["y"].near_next == 1
    assert fp.compare(spark.createDataFrame([], "doc_id long, text string")).count() == 0
