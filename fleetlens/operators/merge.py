"""Table merges expressed as unions and anti-joins; the result is a new table, written by one writer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .latest import latest_per_key


def replace_groups(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New groups take the place of old ones; other groups stay."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def upsert(old: DataFrame, new: DataFrame, keys: list[str], keep_old: list[str] = (), keep_if_blank: list[str] = ()) -> DataFrame:
    """Rows of ``new`` win, but ``keep_old`` columns stay and ``keep_if_blank`` ones aren't blanked."""
    o = old.select(*keys, *(F.col(c).alias(f"__{c}") for c in old.columns if c not in keys), F.lit(True).alias("__old"))
    n = new.withColumn("__new", F.lit(True))
    joined = n.join(o, keys, "full")

    def pick(c: str) -> Column:
        if c in keep_old:
            return F.when(F.col("__old"), F.col(f"__{c}")).otherwise(F.col(c))
        if c in keep_if_blank:
            return F.when(F.col("__new") & (F.coalesce(F.col(c).cast("string"), F.lit("")) != ""), F.col(c)).otherwise(F.col(f"__{c}"))
        return F.when(F.col("__new"), F.col(c)).otherwise(F.col(f"__{c}"))

    return joined.select(*keys, *(pick(c).alias(c) for c in old.columns if c not in keys))


def prefer_good(rows: DataFrame, keys: list[str], good: Column, newest: Column) -> DataFrame:
    """Of several versions the newest good one, or the newest: a failed attempt never replaces a good version."""
    return latest_per_key(rows, keys, [good.cast("int").desc(), newest.desc()])


def guarded_update(current: DataFrame, plan: DataFrame, keys: list[str], digest: str, value: str) -> DataFrame:
    """Applies planned values only if every planned row still has the digest it was planned on; else fails."""
    p = plan.select(*keys, F.col(digest).alias("__seen"), F.col(value).alias("__value"))
    joined = current.join(p, keys, "left")
    stale = p.join(current, keys, "left").where(~F.col("__seen").eqNullSafe(F.col(digest))).agg(F.count("*").alias("__stale"))
    checked = joined.join(F.broadcast(stale)).where(F.assert_true(F.col("__stale") == 0, "rows have changed since the plan").isNull())
    return checked.withColumn(value, F.when(F.col("__seen").isNotNull(), F.col("__value")).otherwise(F.col(value))).select(*current.columns)


def changed_since(now: DataFrame, before: DataFrame, key: str, digest: str) -> DataFrame:
    """Inputs that were added, removed or changed between two signatures."""
    a, b = now.select(key, F.col(digest).alias("now")), before.select(key, F.col(digest).alias("before"))
    return a.join(b, key, "full").where("not now <=> before").select(
        key, F.when(F.col("before").isNull(), "added").when(F.col("now").isNull(), "removed").otherwise("changed").alias("change")
    )


def pending(articles: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Articles to read: not in the ledger, or there with zero rows or an error."""
    done = ledger.where("status is null or status = 'ok'").select(key)
    return articles.join(done, key, "left_anti")
