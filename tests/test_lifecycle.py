"""Run journals as a stream: every way to cut it into batches gives the same changes."""

import os
import random
from datetime import datetime, timedelta

from pyspark.sql import Row
from pyspark.sql import functions as F

from fleetlens.streaming import lifecycle as lc

START = datetime(2024, 1, 1)
DELAY, LIMIT = timedelta(days=1), timedelta(days=2)


def journal(n, seed=1):
    rng = random.Random(seed)
    rows, at = [], START
    for seq in range(n):
        at += timedelta(minutes=rng.randrange(1, 400), microseconds=rng.randrange(10**6))
        action = rng.choice(["claim", "begin", "begin", "begin", "finish", "finish", "end"])
        model = None if action in ("claim", "end") else f"M{rng.randrange(4)}"
        rows.append((rng.randrange(2), model, at, seq, action, rng.choice(["done", "no_match", "querying", None]), rng.choice(["", "E", None])))
    return rows


def replayed(rows):
    """What a single process would have written, as of the watermark."""
    until = max(r[2] for r in rows) - DELAY
    millis = lambda t: (t - START) // timedelta(milliseconds=1)
    models, out = {}, []

    def expire(now, run=None):
        for key, (status, since) in sorted(models.items()):
            if (run is None or key[0] == run) and status == "querying" and millis(since + LIMIT) < now:
                models[key] = ("interrupted", since + LIMIT)
                out.append((*key, "interrupted", lc.IDLE, since + LIMIT))

    for run, model, at, _, action, outcome, error in sorted(rows, key=lambda r: r[2:4]):
        if millis(at) > millis(until):
            break
        expire(millis(at))
        if action in ("claim", "end"):
            for key, (status, _) in sorted(models.items()):
                if key[0] == run and status == "querying":
                    models[key] = ("interrupted", at)
                    out.append((*key, "interrupted", lc.LEFT_BEHIND if action == "claim" else error or lc.ENDED, at))
        elif action == "begin":
            models[run, model] = ("querying", at)
            out.append((run, model, "querying", "", at))
        elif outcome not in lc.MODEL_OUTCOMES:
            out.append((run, model, "rejected", f"{outcome}", at))
        elif (run, model) in models:
            models[run, model] = (outcome, at)
            out.append((run, model, outcome, error or "", at))
    expire(millis(until) + 1)
    return sorted(out, key=str)


def land(spark, rows, folder, name):
    df = spark.createDataFrame(rows, lc.JOURNAL)
    df.coalesce(1).write.parquet(f"{folder}/tmp-{name}")
    part = next(f for f in os.listdir(f"{folder}/tmp-{name}") if f.endswith(".parquet"))
    os.makedirs(f"{folder}/landed", exist_ok=True)
    os.rename(f"{folder}/tmp-{name}/{part}", f"{folder}/landed/{name}.parquet")


def run(spark, folder):
    stream = spark.readStream.schema(lc.JOURNAL).option("maxFilesPerTrigger", 1).parquet(f"{folder}/landed")
    lc.write(lc.changes(stream, limit=LIMIT, buckets=3), f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    return spark.read.schema(lc.CHANGES).parquet(f"{folder}/out")


def test_a_killed_batch_runs_again_with_the_same_result(spark, tmp_path):
    rows, folder = journal(160), str(tmp_path)
    rng = random.Random(5)
    third = [sorted(rows[k : k + 54], key=lambda r: (r[2] + timedelta(hours=rng.randrange(12)))) for k in (0, 54, 108)]  # out of order within the delay
    land(spark, third[0], folder, "a")
    land(spark, third[1], folder, "b")
    run(spark, folder)
    commits = sorted((int(f) for f in os.listdir(f"{folder}/checkpoint/commits") if f.isdigit()))
    for name in (f"{commits[-1]}", f".{commits[-1]}.crc"):  # the process died before the last batch was committed
        if os.path.exists(f"{folder}/checkpoint/commits/{name}"):
            os.remove(f"{folder}/checkpoint/commits/{name}")
    land(spark, third[2], folder, "c")
    found = run(spark, folder)
    got = sorted(((r.run, r.model, r.status, r.error, r.at) for r in found.collect()), key=str)
    assert got == replayed(rows)
    last = {}
    for r in sorted(replayed(rows), key=lambda r: r[4]):
        if r[2] != "rejected":
            last[r[:2]] = r
    assert sorted(tuple(r) for r in lc.states(found).collect()) == sorted(last.values())
    assert {r.status for r in found.select("status").distinct().collect()} >= {"querying", "interrupted", "done", "rejected"}


def test_every_kind_of_interruption(spark, tmp_path):
    at = lambda h: START + timedelta(hours=h)
    rows = [
        (1, "A", at(1), 1, "begin", None, None), (1, None, at(2), 2, "claim", None, None), (2, "A", at(1), 3, "begin", None, None), (2, None, at(3), 4, "end", None, "stopped"),
        (3, "A", at(1), 5, "begin", None, None), (4, "A", at(1), 6, "finish", "done", ""), (5, "A", at(60), 7, "begin", None, None), (9, "Z", at(100), 8, "begin", None, None),
    ]
    land(spark, rows, str(tmp_path), "a")
    got = {r.run: (r.status, r.error) for r in lc.states(run(spark, str(tmp_path))).where(F.col("model") == "A").collect()}
    assert got == {1: ("interrupted", lc.LEFT_BEHIND), 2: ("interrupted", "stopped"), 3: ("interrupted", lc.IDLE), 5: ("querying", "")}


def test_rows_of_a_batch_wait_as_one_element():
    class Kept:  # list and map state of one key
        def __init__(self):
            self.items, self.known = [], {}

        def appendValue(self, value):
            self.items.append(value)

        def appendList(self, values):
            self.items += values

        def put(self, values):
            self.items = list(values)

        def get(self):
            return iter(self.items)

        def clear(self):
            self.items = []

        def iterator(self):
            return iter(list(self.known.items()))

        def updateValue(self, key, value):
            self.known[key] = value

    waiting, models = Kept(), Kept()

    class Handle:
        getListState = staticmethod(lambda *_: waiting)
        getMapState = staticmethod(lambda *_: models)
        registerTimer = staticmethod(lambda _: None)

    class At:
        def __init__(self, at):
            self.at = at

        def getCurrentWatermarkInMs(self):
            return lc._micros(self.at) // 1000

    rows = [Row(run=1, model="M\ud800'\"" if k % 2 else None, at=START + timedelta(hours=k), seq=k, action="begin" if k % 2 else "claim", outcome=None, error="") for k in range(50)]
    life = lc.Lifecycle(LIMIT)
    life.init(Handle)
    assert not list(life.handleInputRows((1, 0), iter(rows[:25]), None))
    assert not list(life.handleInputRows((1, 0), iter(rows[25:]), None))
    assert len(waiting.items) == 2  # before: 50, each of them pickled and stored by itself
    first = list(life.handleExpiredTimer((1, 0), At(rows[9].at), None))
    assert [r.seq for r in first] == list(range(1, 10)) and len(waiting.items) == 1
    rest = list(life.handleExpiredTimer((1, 0), At(rows[-1].at), None))
    assert [r.seq for r in rest] == list(range(10, 50)) and not waiting.items and {r.model for r in rest} == {rows[1].model}
