"""Events as a stream: registration by identity, windowed counts, run outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def event_identity(model: Column, batch: Column, kind: Column, product: Column) -> Column:
    """24 hex digits that name an event; its address is left out on purpose."""
    parts = F.to_json(F.array(F.upper(F.trim(model)), batch.cast("string"), kind, F.coalesce(product, F.lit(""))))
    return F.substring(F.sha2(parts.cast("binary"), 256), 1, 24)


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """Landed event files in the order they appear; event time as a timestamp, which watermarks need."""
    raw = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return raw.withColumn("ts", F.col("ts").cast("timestamp"))


def first_registrations(events: DataFrame, key: str = "event_id", lateness: str = "60 days") -> DataFrame:
    """Each event once, whatever is landed again within the window; older state is dropped."""
    return events.withWatermark("ts", lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, width: str = "1 day", lateness: str = "60 days") -> DataFrame:
    w = events.withWatermark("ts", lateness).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return w.select(F.col("window.start").alias("start"), "event_type", "n", "total")


def run_to(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Runs over what is there and stops; every batch overwrites one folder with the full result, so replays agree."""
    def put(df: DataFrame, _: int) -> None:
        df.write.mode("overwrite").parquet(path)

    return counts.writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(put).start()


def register_batches(incoming: DataFrame, state_path: str, checkpoint: str) -> StreamingQuery:
    """Upserts events into versions of a keyed table: first_seen stays, blank dates don't replace dates.

    Version ``b`` is written from version ``b - 1`` and batch ``b``: a batch that runs again writes the same.
    """
    def merge(batch: DataFrame, b: int) -> None:
        spark = batch.sparkSession
        new = batch.groupBy("event_id").agg(F.min("ts").alias("first_seen"), F.max("event_type").alias("event_type"), F.max("ts").alias("event_date"))
        if b:
            old = spark.read.parquet(f"{state_path}/version={b - 1}").select("event_id", *(F.col(c).alias(f"o_{c}") for c in ("first_seen", "event_type", "event_date")))
            both = old.join(new, "event_id", "full")
            new = both.select("event_id", F.coalesce("o_first_seen", "first_seen").alias("first_seen"), F.coalesce("event_type", "o_event_type").alias("event_type"), F.coalesce("event_date", "o_event_date").alias("event_date"))
        new.write.mode("overwrite").parquet(f"{state_path}/version={b}")

    return incoming.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(merge).start()
