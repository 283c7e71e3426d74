"""Mixing sources to target weights.

Every document gets a hash-random key; within a source documents stand in key order,
which a range of key buckets splits over tasks. Sums of the buckets give each bucket's
offset, so the prefix sums need no task that holds a whole source. A source's budget
is cut exactly: whole epochs first, then documents in key order until the rest of the
budget is used, the last one partly.

Cases: null text has size 0; a null source is a source of its own, ordered last; an
empty table gives no rows; rows with equal ids are separate documents, which stand by
their texts' digests where id and size agree, and rows without an id are spread over the
buckets by a number that is written with them. Other columns pass through untouched,
whatever their names; ``mix`` refuses a table
that has a column of the names it adds. Budgets are targets rounded to whole words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._spark import materialize, passing, table

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix-1"
#: Hex digits of the key that number a bucket.
BUCKET_DIGITS = 3


def size_of(text: Column) -> Column:
    """Number of runs without ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def key_of(doc_id: Column, seed: str = SEED, salt: Column | None = None) -> Column:
    """Hash-random key of an id; rows without one are told apart by ``salt``, a number that is written with them."""
    nameless = F.lit("") if salt is None else F.concat(F.lit("\0"), salt.cast("string"))
    return F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), nameless)))


def targets(by_source: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Targets of sources (columns source, source_size): the total shared by weight, none above its cap.

    Sources by ascending cap per weight fill up first; the level at the first source
    that stays below its cap is everyone else's words per weight.
    """
    n = len(weights)
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(ordered) - 1) % n + 1)
    w = by_source.withColumn("weight", weight.cast("double")).withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(fill), F.lit(0.0))) / F.sum("weight").over(rest)
    place = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    w = w.withColumn("level", level).withColumn("place", F.row_number().over(place))
    final = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct("place", "level"))).over(everything)["level"]
    return w.select(
        "source", "source_size", F.least(F.col("cap"), F.coalesce(final, F.lit(0.0)) * F.col("weight")).alias("target")
    )


def mix(sized: DataFrame, *, doc_id: str = "doc_id", source: str = "source", size: str = "size",
        salt: str | None = None, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """Adds source_size, target and taken (words, repeats counted) to rows with a size.

    ``sized`` should be cheap to read twice (see ``materialize``). Rows equal in
    id, source and size take the same words in whichever order they stand. ``salt`` is a
    column of written numbers that spreads rows without an id over buckets.
    """
    if clash := sorted({"source_size", "target", "taken"} & set(sized.columns)):
        raise ValueError(f"columns {clash} would be replaced")
    out = _taken(sized, doc_id, source, size, None, salt, weights, max_epochs, seed)
    return out.withColumnsRenamed({"__source_size": "source_size", "__target": "target", "__taken": "taken"})


def _taken(sized: DataFrame, doc_id: str, source: str, size: str, digest: str | None, salt: str | None, weights: Sequence[int], max_epochs: int, seed: str) -> DataFrame:
    """Adds __source_size, __target and __taken; ``digest`` orders rows of one id and size."""
    keyed = sized.withColumn("__key", key_of(F.col(doc_id), seed, F.col(salt) if salt else None)).withColumn("__bucket", F.substring("__key", 1, BUCKET_DIGITS))
    sums = keyed.groupBy(F.col(source).alias("__s"), F.col("__bucket").alias("__b")).agg(F.sum(size).alias("__sum"))
    by_source = sums.groupBy(F.col("__s").alias("source")).agg(F.sum("__sum").alias("source_size"))
    goal = targets(by_source, weights, max_epochs).withColumnsRenamed({"source": "__t", "source_size": "__source_size", "target": "__target"})
    before = Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    plan = sums.withColumn("__before", F.coalesce(F.sum("__sum").over(before), F.lit(0))).join(goal, F.col("__s").eqNullSafe(F.col("__t"))).drop("__t", "__sum")
    inside = Window.partitionBy(source, "__bucket").orderBy("__key", doc_id, size, *([digest] if digest else [])).rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("__inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = placed.join(plan, F.col(source).eqNullSafe(F.col("__s")) & (F.col("__bucket") == F.col("__b")))
    budget = F.round("__target").cast("long")
    epochs = F.when(F.col("__source_size") > 0, F.expr("cast(round(__target) as bigint) div __source_size")).otherwise(F.lit(0))
    rest = budget - epochs * F.col("__source_size")
    part = F.greatest(F.lit(0), F.least(F.col(size), rest - F.col("__before") - F.col("__inside")))
    return joined.withColumn("__taken", (epochs * F.col(size) + part).cast("long")).drop(
        "__key", "__bucket", "__s", "__b", "__before", "__inside"
    )


@passing("doc_id", "text", "source")
def sample(docs: DataFrame, *, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: a row of ``docs`` for every time it is taken.

    Whole documents only: one whose partial share is at least half of it counts fully.
    A source's words so differ from its target by less than one document.
    """
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    sized = materialize(docs.withColumn("__size", size_of(F.col("text"))).withColumn("__digest", digest).withColumn("__salt", F.monotonically_increasing_id()), "mixing")
    taken = _taken(sized, "doc_id", "source", "__size", "__digest", "__salt", weights, max_epochs, seed)
    copies = F.when(F.col("__size") > 0, F.expr("cast(floor((2 * __taken + __size) / (2 * __size)) as int)")).otherwise(F.lit(0))
    return taken.withColumn("__copies", copies).where("__copies > 0").withColumn(
        "__copy", F.explode(F.sequence(F.lit(1), F.col("__copies")))
    ).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = materialize(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("salt")), "op6-sizes")
    return mix(sized, salt="salt").select("doc_id", "size", "source_size", "target", "taken")


SQL_MIX = r"""
sized AS (SELECT doc_id, source, md5(concat('mix-1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS k, {size} AS size FROM {docs}),
by_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS weight,
  CAST(source_size * 3 AS DOUBLE) AS cap FROM by_source),
levels AS (SELECT *, (CAST(sum(source_size) OVER () AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv,
  row_number() OVER (ORDER BY cap / weight, source NULLS LAST) AS place FROM weighed),
goal AS (SELECT source, source_size, least(cap, coalesce((SELECT lv FROM levels WHERE cap >= lv * weight ORDER BY place LIMIT 1), 0.0) * weight) AS target FROM levels),
placed AS (SELECT sized.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM sized),
budget AS (SELECT p.doc_id, p.size, p.before, g.source_size, g.target, CAST(round(g.target) AS BIGINT) AS b,
  CASE WHEN g.source_size > 0 THEN CAST(round(g.target) AS BIGINT) // g.source_size ELSE 0 END AS e
  FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source)
"""

ORACLES = {
    "op6_mixing": "WITH " + SQL_MIX.format(size="len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))", docs="documents")
    + "SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(e * size + greatest(0, least(size, b - e * source_size - before)) AS BIGINT) AS taken FROM budget"
}
QUERIES = {"op6_mixing": op6_mixing}
