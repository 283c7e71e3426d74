"""Connected components of a link table, by rounds of shuffles only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._spark import forget, materialize, shuffled


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it reaches.

    Alternates two star steps: every node's larger neighbours, then every node's
    smaller ones, move to the smallest node in the neighbourhood. Links never grow in
    number, and a node's neighbours meet only in combinable minima, so a node with
    many links isn't gathered in one place. Stops when every link leads to its root.
    """
    current = materialize(
        links.where("a <> b").select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "links"
    )
    while True:
        both = current.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(current.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        low = both.groupBy("n").agg(F.min("m").alias("least")).select("n", F.least("n", "least").alias("root"))
        # large star: a node's larger neighbours link to the least of it and its neighbours
        large = current.join(shuffled(low.withColumnRenamed("n", "lo")), "lo").select(F.col("root").alias("lo"), "hi").where("lo <> hi").distinct()
        large = materialize(large, "links")
        # small star: a node's smaller neighbours and itself link to the least of them
        least = large.groupBy("hi").agg(F.min("lo").alias("root"))
        small = large.join(shuffled(least), "hi")
        small = materialize(
            small.select(F.col("root").alias("lo"), F.explode(F.array("lo", "hi")).alias("hi")).where("lo <> hi").distinct(), "links"
        )
        forget(current)
        forget(large)
        current = small
        # a forest of stars: no root hangs below another and no node has two roots
        ends = current.select(F.col("hi").alias("n"), F.lit(1).alias("below"), F.lit(0).alias("root")).unionByName(
            current.select(F.col("lo").alias("n"), F.lit(0).alias("below"), F.lit(1).alias("root"))
        )
        ends = ends.groupBy("n").agg(F.sum("below").alias("below"), F.max("root").alias("root"))
        if not ends.where("below > 1 or (below = 1 and root = 1)").limit(1).count():
            break
    nodes = current.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    return nodes.unionByName(current.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
