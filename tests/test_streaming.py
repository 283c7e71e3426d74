import datetime

from fleetlens.streaming import events


def test_stream_equals_batch_and_replay_is_harmless(spark, tmp_path):
    rows = [(i, datetime.datetime(2024, 1, 1 + i % 3, 5), i % 4, "abc"[i % 3], float(i), "{}") for i in range(60)]
    df = spark.createDataFrame(rows, events.EVENTS)
    for part in range(3):
        df.where(f"event_id % 3 = {part}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    for _ in range(2):
        events.run_to(events.windowed_counts(events.read_events(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "c1")).awaitTermination()
    got = sorted((r.event_type, r.n, r.total) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    want = sorted((r.event_type, r["count(1)"], r["sum(value)"]) for r in df.groupBy("event_type", "ts").agg({"*": "count", "value": "sum"}).collect())
    assert got == want
    events.register_batches(events.read_events(spark, str(tmp_path / "in")), str(tmp_path / "state"), str(tmp_path / "c2")).awaitTermination()
    last = max((tmp_path / "state").glob("version=*"), key=lambda p: int(p.name.split("=")[1]))
    assert spark.read.parquet(str(last)).count() == 60
