"""Fuzzy matching of names, in ranked passes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import has_token, model_token, norm_key, norm_series


#: Longest piece of a name that names are looked up by.
PIECE = 8


def _pieces(c: Column) -> Column:
    """All distinct substrings of 1 to PIECE characters."""

    def of_length(k: Column) -> Column:
        return F.transform(F.filter(F.sequence(F.lit(1), F.length(c)), lambda i: i <= F.length(c) - k + 1), lambda i: F.substring(c, i, k))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.lit(PIECE)), of_length)))


def contained(inner: DataFrame, part: str, outer: DataFrame, whole: str) -> DataFrame:
    """Pairs of rows where column ``part``, which isn't empty, is contained in column ``whole``; each pair once.

    An equi-join: the first PIECE characters of a part are looked up among the whole's
    pieces, then the part is compared in full. Pieces grow with a name's length only.
    """
    left = inner.where(F.length(part) > 0).withColumn("__piece", F.substring(part, F.lit(1), F.lit(PIECE)))
    right = outer.where(F.length(whole) > 0).withColumn("__piece", F.explode(_pieces(F.col(whole))))
    return left.join(right, "__piece").where(F.contains(whole, part)).drop("__piece")


def match_series(wanted: DataFrame, sales: DataFrame, *, name: str = "name", series: str = "series", ordinal: str = "ordinal") -> DataFrame:
    """Sales row of each wanted name: equal names, else one containing the other, else a unique model token.

    Only names that a pass leaves open go to the next. A name without characters is
    contained in every series: it takes the first.
    """
    w = wanted.select(name).distinct().withColumn("__key", norm_series(F.col(name)))
    s = sales.withColumn("__norm", norm_series(F.col(series))).groupBy("__norm").agg(F.min(F.struct(ordinal, series)).alias("s"))
    exact = w.join(s, w["__key"] == s["__norm"]).select(name, F.lit(1).alias("pass"), F.col(f"s.{series}").alias(series))
    rest = w.join(exact.select(name), name, "left_anti").withColumn("__token", model_token(F.col(name)))
    rows = sales.withColumn("__norm", norm_series(F.col(series))).where("__norm <> ''").select(ordinal, series, "__norm")
    found = contained(rest, "__key", rows, "__norm").unionByName(contained(rows, "__norm", rest, "__key"))
    near = found.groupBy(name).agg(F.min(F.struct(ordinal, series)).alias("s"))
    first = rows.agg(F.min(F.struct(ordinal, series)).alias("s")).where("s is not null")  # one row
    near = near.unionByName(rest.where("__key = ''").select(name).crossJoin(F.broadcast(first)))
    near = near.select(name, F.lit(2).alias("pass"), F.col(f"s.{series}").alias(series))
    left = rest.where("__token <> ''").join(near.select(name), name, "left_anti")
    token = contained(left, "__token", rows, "__norm").where(has_token(F.col("__norm"), F.col("__token"))).groupBy(name).agg(F.count("*").alias("n"), F.min(series).alias(series)).where("n = 1")
    return exact.unionByName(near).unionByName(token.select(name, F.lit(3).alias("pass"), series))


def match_profiles(names: DataFrame, profiles: DataFrame, *, name: str = "name", profile: str = "profile", ordinal: str = "ordinal") -> DataFrame:
    """Profile of each name: equal key, else the longest key that contains it or that it contains, earlier profiles first."""
    n = names.select(name).distinct().withColumn("__key", norm_key(F.col(name))).where("__key <> ''")
    p = profiles.withColumn("__norm", norm_key(F.col("alias"))).where("__norm <> ''").select(ordinal, profile, "__norm")
    exact = n.join(p, n["__key"] == p["__norm"]).groupBy(name).agg(F.min(F.struct(ordinal, profile)).alias("b")).select(name, F.lit(True).alias("exact"), F.col(f"b.{profile}").alias(profile))
    rest = n.join(exact.select(name), name, "left_anti")
    near = contained(rest, "__key", p, "__norm").unionByName(contained(p, "__norm", rest, "__key"))
    best = F.min(F.struct((-F.length("__norm")).alias("l"), F.col(ordinal), F.col(profile)))
    return exact.unionByName(near.groupBy(name).agg(best.alias("b")).select(name, F.lit(False).alias("exact"), F.col(f"b.{profile}").alias(profile)))


def _score(requested: str, model: str) -> int:
    """Points for a trim: equality, containment, shared tokens; far below zero without any."""
    import re

    a, b = ("".join(x.lower().split()) for x in (requested, model))
    ta, tb = ({t for t in re.split(r"[\s\-_/]+", x.lower()) if t} for x in (requested, model))
    points = (100 if a == b else 0) + (40 if a and (a in b or b in a) else 0) + 12 * len(ta & tb)
    return points if points else -10_000


def assign_trims(requests: DataFrame, models: DataFrame, group: str) -> DataFrame:
    """Requested trims take models greedily, each model once, in request order.

    requests (group, place, request), models (group, position, model). The order of
    requests decides, so a comparison (a handful of rows) is one pandas group.
    """
    def assign(key, asked: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
        free = offered.sort_values("position")[["position", "model"]].values.tolist()
        rows = []
        for place, request in asked.sort_values("place")[["place", "request"]].values.tolist():
            scored = [(_score(request, m), -p, p, m) for p, m in free]
            best = max(scored, default=None)
            if best is None or best[0] < 0:
                rows.append((*key, place, request, None))
                continue
            free = [x for x in free if x[0] != best[2]]
            rows.append((*key, place, request, best[3]))
        return pd.DataFrame(rows, columns=[group, "place", "request", "model"])

    kind = requests.schema[group].dataType.simpleString()
    return requests.groupBy(group).cogroup(models.groupBy(group)).applyInPandas(assign, f"`{group}` {kind}, place long, request string, model string")
