"""Queries over streams of run journals and over published generations."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sinks.publication import Publication, Refused
from ..streaming import lifecycle
from .roles import OUTCOMES, catalog, table


def journal(events: DataFrame) -> DataFrame:
    """events as a run journal: a run per user; every fourth signup claims it, every fourth error ends it."""
    k = F.get_json_object("props", "$.k").cast("int")
    fourth = F.col("event_id") % 4 == 0
    action = F.when((F.col("event_type") == "signup") & fourth, "claim").when((F.col("event_type") == "error") & fourth, "end").when(F.col("event_type") == "view", "begin").otherwise("finish")
    outcome = F.element_at(F.array(*map(F.lit, OUTCOMES)), k % len(OUTCOMES) + 1)
    j = events.select(
        F.col("user_id").alias("run"), F.concat(F.lit("M"), F.col("event_id") % 5).alias("model"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("seq"), action.alias("action"),
        outcome.alias("outcome"), F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("error"),
    )
    return j.withColumn("model", F.when(F.col("action").isin("claim", "end"), F.lit(None)).otherwise(F.col("model")))


def run_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """States of models after a stream over the whole journal; as of the watermark, a day before the last row."""
    place = f"{shared_dir(spark)}/lifecycle-{uuid.uuid4().hex}"
    landed = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/event[s].parquet")
    query = lifecycle.write(lifecycle.changes(journal(landed)), f"{place}/changes", f"{place}/checkpoint")
    query.awaitTermination()
    return lifecycle.states(spark.read.schema(lifecycle.CHANGES).parquet(f"{place}/changes")).select("run", "model", "status", "error", F.col("at").cast("timestamp_ntz").alias("changed"))


def published_generations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three generations of catalogue counts by batch: all but the newest batches, all, and all without two that a rebase names.

    A publication between them that would lose batches is refused and leaves no trace.
    """
    c = catalog(spark, sf_dir).groupBy(F.col("batch").cast("bigint").alias("batch")).agg(F.count("*").alias("n"), F.round(F.sum("price"), 2).alias("total"))
    p = Publication(spark, f"{shared_dir(spark)}/publication-{uuid.uuid4().hex}")

    def put(df: DataFrame, **how) -> None:
        p.publish({"counts": df}, df, **how)

    put(c.where("batch <= 400"))
    put(c, expected=1)
    try:
        put(c.where("batch <> 300"), expected=2)
        raise AssertionError("a smaller scope was published")
    except Refused:
        pass
    gone = c.where("batch IN (180, 187)")
    named = {r.batch for r in gone.collect()}  # two batches at most
    put(c.join(gone, "batch", "left_anti"), expected=2, removed=named or None, reason="withdrawn" if named else None)
    rows = [p.table("counts", c.generation).withColumns({"generation": F.lit(c.generation), "added": F.lit(len(c.added)), "removed": F.lit(len(c.removed)), "reason": F.lit(c.reason)}) for c in p.history()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


SQL_JOURNAL = f"""journal AS (SELECT user_id AS run, 'M' || (event_id % 5) AS model, ts AS t, event_id AS seq,
  CASE WHEN event_type = 'signup' AND event_id % 4 = 0 THEN 'claim' WHEN event_type = 'error' AND event_id % 4 = 0 THEN 'end' WHEN event_type = 'view' THEN 'begin' ELSE 'finish' END AS action,
  ([{', '.join(map(repr, OUTCOMES))}])[CAST(json_extract_string(props, '$.k') AS INTEGER) % {len(OUTCOMES)} + 1] AS outcome, CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS error
  FROM events WHERE epoch_ms(ts) <= (SELECT epoch_ms(max(ts)) - 86400000 FROM events))"""

ORACLES = {
    "run_lifecycle": f"""WITH {SQL_JOURNAL}, upto AS (SELECT epoch_ms(max(ts)) - 86400000 AS w FROM events),
 models AS (SELECT j.*, min(CASE WHEN action = 'begin' THEN (t, seq) END) OVER (PARTITION BY run, model) AS first_begin FROM journal j WHERE action IN ('begin', 'finish')),
 own AS (SELECT *, row_number() OVER (PARTITION BY run, model ORDER BY t DESC, seq DESC) AS n FROM models
   WHERE action = 'begin' OR (outcome <> 'querying' AND (t, seq) > first_begin)),
 last AS (SELECT run, model, t, seq, CASE WHEN action = 'begin' THEN 'querying' ELSE outcome END AS status, CASE WHEN action = 'begin' THEN '' ELSE error END AS error FROM own WHERE n = 1),
 cut AS (SELECT l.run, l.model, min((j.t, j.seq)) AS c FROM last l JOIN journal j ON j.run = l.run AND j.action IN ('claim', 'end') AND (j.t, j.seq) > (l.t, l.seq) WHERE l.status = 'querying' GROUP BY ALL),
 cuts AS (SELECT cut.run, cut.model, j.t, CASE j.action WHEN 'claim' THEN '{lifecycle.LEFT_BEHIND}' ELSE coalesce(nullif(j.error, ''), '{lifecycle.ENDED}') END AS error FROM cut JOIN journal j ON j.run = cut.run AND (j.t, j.seq) = cut.c),
 ends AS (SELECT l.*, c.t AS cut_at, c.error AS cut_error, l.t + INTERVAL 2 DAY AS due, w FROM last l LEFT JOIN cuts c USING (run, model), upto)
 SELECT run, model, CASE WHEN status = 'querying' AND (epoch_ms(cut_at) <= epoch_ms(due) OR epoch_ms(due) <= w) THEN 'interrupted' ELSE status END AS status,
  CASE WHEN status <> 'querying' THEN error WHEN epoch_ms(cut_at) <= epoch_ms(due) THEN cut_error WHEN epoch_ms(due) <= w THEN '{lifecycle.IDLE}' ELSE '' END AS error,
  CASE WHEN status <> 'querying' THEN t WHEN epoch_ms(cut_at) <= epoch_ms(due) THEN cut_at WHEN epoch_ms(due) <= w THEN due ELSE t END AS changed FROM ends""",
    "published_generations": """WITH c AS (SELECT CAST(173 + (p_partkey * 7) % 240 AS BIGINT) AS batch, count(*) AS n, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1),
 added AS (SELECT CAST(count(*) AS INT) AS k FROM c WHERE batch > 400), gone AS (SELECT CAST(count(*) AS INT) AS k FROM c WHERE batch IN (180, 187))
 SELECT *, 1 AS generation, 0 AS added, 0 AS removed, NULL AS reason FROM c WHERE batch <= 400 UNION ALL SELECT *, 2, (SELECT k FROM added), 0, NULL FROM c
 UNION ALL SELECT *, 3, 0, (SELECT k FROM gone), CASE WHEN (SELECT k FROM gone) > 0 THEN 'withdrawn' END FROM c WHERE batch NOT IN (180, 187)""",
}
QUERIES = {name: globals()[name] for name in ORACLES}
