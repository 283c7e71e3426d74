"""Enumeration that heals itself: what keywords miss is found through companies and prefixes.

A batch is asked for by company keywords. Products found so lead on: their model prefixes
are asked for, what answers belongs to companies that no keyword covers, and these are
asked for by name, until a round finds no new company. Rounds are semi-naive: only what
the last one found is joined, and what is known is kept in a table written once a round,
so lineage stays short and a lost executor costs one round.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir


def covered(company: Column, keywords: Sequence[str]) -> Column:
    """Whether a keyword stands in the company's name."""
    return F.coalesce(F.exists(F.array(*map(F.lit, keywords)).cast("array<string>"), lambda k: F.contains(company, k)), F.lit(False))


def closure(products: DataFrame, keywords: Sequence[str], *, most: int = 50) -> DataFrame:
    """company, round: companies reached from those with a keyword (round 0) over shared prefixes.

    products (product, company, prefix). More than ``most`` rounds are an error, not a
    shorter result.
    """
    spark = products.sparkSession
    place = f"{shared_dir(spark)}/enumeration-{uuid.uuid4().hex}"
    pairs = products.where("company IS NOT NULL AND prefix IS NOT NULL").select("company", "prefix").distinct()
    pairs.write.parquet(f"{place}/pairs")
    pairs = spark.read.parquet(f"{place}/pairs")
    first = products.where(covered(F.col("company"), keywords)).select("company").distinct()
    for k in range(most + 1):
        first.withColumn("round", F.lit(k)).write.parquet(f"{place}/found/step={k}")
        last = spark.read.parquet(f"{place}/found/step={k}")
        if last.isEmpty():
            return _found(spark, place, k)
        known = _found(spark, place, k + 1)
        asked = pairs.join(last, "company", "left_semi").select("prefix").distinct()
        first = pairs.join(asked, "prefix", "left_semi").select("company").distinct().join(known, "company", "left_anti")
    raise ValueError(f"companies are still found after {most} rounds")


def _found(spark, place: str, steps: int) -> DataFrame:
    return spark.read.schema("company string, round int").parquet(*[f"{place}/found/step={k}" for k in range(max(steps, 1))])


def enumerated(products: DataFrame, keywords: Sequence[str], *, most: int = 50) -> DataFrame:
    """products with round (null: not reached) and missed: whether keywords alone miss the product."""
    reached = closure(products, keywords, most=most)
    return products.join(reached, "company", "left").withColumn("missed", ~covered(F.col("company"), keywords))


def sampled_coverage(products: DataFrame, found: DataFrame, prefixes: DataFrame) -> DataFrame:
    """prefix, listed, uncovered: products that answer to each sampled prefix, and those not found (product)."""
    asked = products.join(prefixes.select("prefix").distinct(), "prefix", "left_semi").select("prefix", "product").distinct()
    known = found.select("product").distinct().withColumn("known", F.lit(1))
    return asked.join(known, "product", "left").groupBy("prefix").agg(F.count("*").alias("listed"), F.count_if(F.col("known").isNull()).alias("uncovered"))
