"""The life of collection runs as a keyed stream: models are open, querying, interrupted or finished.

A journal has a row for whatever a collector does: it claims a run (again, when it
resumes), begins a model, finishes it with an outcome, ends the run. Rows come in files in
about the order of their times. The stream holds them back until the watermark has passed
them, applies them in order of (at, seq), and gives a row for each change of a model. What
it gives doesn't depend on how rows were cut into batches, so a batch that is run again
after a failure gives the same.

* claim: models still querying were left by a process that is gone: interrupted.
* begin: querying, with no error.
* finish: the outcome and error; a model that was never begun has none, an outcome
  outside the vocabulary is given out as ``rejected`` and changes nothing.
* end: models still querying are interrupted, by the reason if there is one.
* no sign of life of a querying model for longer than the limit: interrupted, by a timer.

State is kept by run and bucket of models, so a large run is spread; rows of a whole run
go to each of its buckets. Rows later than the watermark's delay are dropped by Spark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Outcomes of a model, and messages of interruptions: fixed values.
MODEL_OUTCOMES = ("query_failed", "no_match", "interrupted", "partial", "awaiting_effective", "done", "skipped")
LEFT_BEHIND = "上次进程未完成该型号"
ENDED = "本轮采集中断，未完成该型号"
IDLE = "超过时限没有进展"

JOURNAL = "run bigint, model string, at timestamp, seq bigint, action string, outcome string, error string"
CHANGES = "run bigint, model string, status string, error string, at timestamp, seq bigint"
BUCKETS = 8

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _micros(at: datetime) -> int:
    return (at.astimezone(timezone.utc) - _EPOCH) // timedelta(microseconds=1)


def _time(micros: int) -> datetime:
    return (_EPOCH + timedelta(microseconds=micros)).astimezone().replace(tzinfo=None)


class Lifecycle(StatefulProcessor):
    """Rows of one run and bucket: those that wait for the watermark, and what is known of each model."""

    def __init__(self, limit: timedelta):
        self.limit = limit // timedelta(microseconds=1)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows string")  # an element for each batch's rows: each element costs far more than a row
        self.models = handle.getMapState("models", "model string", "status string, since bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = [(_micros(r.at), r.seq, r.model, r.action, r.outcome, r.error) for r in rows]
        self.waiting.appendValue((json.dumps(new),))
        self.handle.registerTimer(min(r[0] for r in new) // 1000)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs()
        rows = sorted((r for (part,) in self.waiting.get() for r in json.loads(part)), key=lambda r: r[:2])
        due = [r for r in rows if r[0] // 1000 <= now]
        known = {k[0]: list(v) for k, v in self.models.iterator()}
        before = {m: tuple(v) for m, v in known.items()}
        for at, seq, model, action, outcome, error in due:
            yield from self._expired(key[0], known, at // 1000)
            if action in ("claim", "end"):
                for m in sorted(m for m, v in known.items() if v[0] == "querying"):
                    known[m][0] = "interrupted"
                    yield Row(run=key[0], model=m, status="interrupted", error=LEFT_BEHIND if action == "claim" else error or ENDED, at=_time(at), seq=seq)
            elif action == "begin":
                known[model] = ["querying", at]
                yield Row(run=key[0], model=model, status="querying", error="", at=_time(at), seq=seq)
            elif outcome not in MODEL_OUTCOMES:
                yield Row(run=key[0], model=model, status="rejected", error=f"{outcome}", at=_time(at), seq=seq)
            elif model in known:
                known[model] = [outcome, at]
                yield Row(run=key[0], model=model, status=outcome, error=error or "", at=_time(at), seq=seq)
        yield from self._expired(key[0], known, now + 1)
        for m, v in known.items():
            if before.get(m) != tuple(v):
                self.models.updateValue((m,), tuple(v))
        if due:
            later = rows[len(due):]
            if later:
                self.waiting.put([(json.dumps(later),)])
            else:
                self.waiting.clear()
        times = [r[0] // 1000 for r in rows[len(due):][:1]] + [(v[1] + self.limit) // 1000 for v in known.values() if v[0] == "querying"]
        if times:
            self.handle.registerTimer(max(now + 1, min(times)))

    def _expired(self, run: int, known: dict[str, list], millis: int) -> Iterator[Row]:
        """Models whose limit ends before ``millis``."""
        for m in sorted(known):
            status, since = known[m]
            if status == "querying" and (since + self.limit) // 1000 < millis:
                known[m][0] = "interrupted"
                yield Row(run=run, model=m, status="interrupted", error=IDLE, at=_time(since + self.limit), seq=None)

    def close(self) -> None:
        pass


def changes(journal: DataFrame, *, delay: str = "1 day", limit: timedelta = timedelta(days=2), buckets: int = BUCKETS) -> DataFrame:
    """Changes of models (``CHANGES``) of a streamed journal (``JOURNAL``); ``rejected`` rows tell of unknown outcomes."""
    own = F.array(F.pmod(F.xxhash64("model"), F.lit(buckets)).cast("int"))
    whole_run = F.col("action").isin("claim", "end")
    spread = journal.withWatermark("at", delay).withColumn("bucket", F.explode(F.when(whole_run, F.sequence(F.lit(0), F.lit(buckets - 1))).otherwise(own)))
    return spread.groupBy("run", "bucket").transformWithState(Lifecycle(limit), CHANGES, "Append", "EventTime")


#: Timers and several kinds of state need this store; a query takes the setting when it starts.
_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def write(found: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends changes to a folder, each batch once, over all that has landed."""
    spark, (name, store) = found.sparkSession, _STORE
    before = spark.conf.get(name)
    spark.conf.set(name, store)
    try:
        return found.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    finally:
        spark.conf.set(name, before)


def states(found: DataFrame) -> DataFrame:
    """The last change of each model: run, model, status, error, at."""
    last = Window.partitionBy("run", "model").orderBy(F.col("at").desc(), F.col("seq").desc_nulls_last())
    return found.where("status <> 'rejected'").withColumn("n", F.row_number().over(last)).where("n = 1").select("run", "model", "status", "error", "at")
