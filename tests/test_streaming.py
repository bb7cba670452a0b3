from datetime import datetime, timedelta

from pyspark.sql import functions as F

from provlake.operators.running import running_sum
from provlake.streaming import runs as S

START = datetime(2024, 1, 1)


def event(session, i, minutes, kind, key=None, value=None, success=None):
    return (session, i, START + timedelta(minutes=minutes), kind, key, value, success)


LOG = [
    event("good", 1, 0, S.TASK, "t1"), event("good", 2, 1, S.TASK_FAILED, "t2"), event("good", 3, 2, S.TASK_CACHED, "t3"),
    event("good", 4, 3, S.PUBLISH, "src", "old"), event("good", 5, 4, S.PUBLISH, "src", "new"), event("good", 6, 5, S.PUBLISH, None, "index"),
    event("good", 7, 6, S.OUTPUT, "name", "path"), event("good", 8, 7, S.COMPLETE, success=True), event("good", 9, 8, S.TASK, "late"),
    event("bad", 10, 0, S.TASK, "t1"), event("bad", 11, 9, S.COMPLETE, success=False), event("open", 12, 1, S.TASK, "t1"),
    event("bare", 13, 2, S.COMPLETE, success=True),
]


def test_only_good_runs_are_released(spark, tmp_path):
    log = spark.createDataFrame(LOG, S.EVENT_SCHEMA)
    # three files, so the run's events and its completion arrive in different batches
    for i, (lo, hi) in enumerate([(0, 3), (3, 6), (6, 99)]):
        minute = (F.unix_timestamp("ts") - int(START.timestamp())) / 60
        log.where((minute >= lo) & (minute < hi)).coalesce(1).write.mode("append").parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(S.EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "log"))

    def broken(tables):
        raise ValueError("no such step")

    def worse(tables):
        raise ValueError("other")
    steps = {"per_run": lambda t: t["tasks"].groupBy("session_id").count(), "broken": broken, "worse": worse}
    S.stream_runs(stream, str(tmp_path / "out"), str(tmp_path / "state"), steps=steps, lateness="1 day", longest_run="1 day", salts=3).awaitTermination()
    tables = S.read_tables(spark, str(tmp_path / "out"))
    read = lambda name: {tuple(r) for r in tables[name].collect()}
    assert {t[:2] for t in read("tasks")} == {("good", "t1"), ("good", "t3")} and {t[0] for t in read("runs")} == {"good", "bare"}
    assert read("publishes") == {("good", "src", "new"), ("good", "index", "index")}
    assert read("workflow_outputs") == {("good", "name", "path")}
    errors = spark.read.parquet(str(tmp_path / "out" / "errors"))
    assert {(r["step"], r["error"]) for r in errors.collect()} == {("broken", "no such step"), ("worse", "other")}
    assert spark.read.parquet(str(tmp_path / "out" / "per_run")).where("session_id = 'good'").agg(F.sum("count")).first()[0] == 2


def test_restart_leaves_no_duplicates(spark, tmp_path):
    spark.createDataFrame(LOG, S.EVENT_SCHEMA).write.parquet(str(tmp_path / "log"))
    for _ in range(2):
        stream = spark.readStream.schema(S.EVENT_SCHEMA).parquet(str(tmp_path / "log"))
        S.stream_runs(stream, str(tmp_path / "out"), str(tmp_path / "state"), lateness="1 day", longest_run="1 day", salts=2).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out" / "tasks")).count() == 2


def test_last_row_wins_over_batches(spark, tmp_path):
    """A repeated task and a later target that reach the stream in another batch than the first ones."""
    first = spark.createDataFrame([("s", 1, START, S.PUBLISH, "a", "old", START), ("s", 2, START, S.TASK, "t", None, START)], "session_id string, event_id bigint, ts timestamp, kind string, key string, value string, complete_ts timestamp")
    second = spark.createDataFrame([("s", 3, START, S.PUBLISH, "a", "new", START), ("s", 4, START, S.TASK_CACHED, "t", None, START)], first.schema)
    for i, released in enumerate((first, second)):
        for name, table in S.run_tables(released).items():
            table.write.parquet(str(tmp_path / name / f"batch={i}"))
    tables = S.read_tables(spark, str(tmp_path))
    assert [r["target"] for r in tables["publishes"].collect()] == ["new"] and [r["kind"] for r in tables["tasks"].collect()] == [S.TASK_CACHED]


def test_runs_beyond_the_longest_are_not_released(spark, tmp_path):
    log = [event("s", 1, 0, S.TASK, "early"), event("s", 2, 90, S.TASK, "late"), event("s", 3, 100, S.COMPLETE, success=True)]
    spark.createDataFrame(log, S.EVENT_SCHEMA).write.parquet(str(tmp_path / "log"))
    stream = spark.readStream.schema(S.EVENT_SCHEMA).parquet(str(tmp_path / "log"))
    S.stream_runs(stream, str(tmp_path / "out"), str(tmp_path / "state"), lateness="5 minutes", longest_run="1 hour").awaitTermination()
    tables = S.read_tables(spark, str(tmp_path / "out"))
    assert [r["task_hash"] for r in tables["tasks"].collect()] == ["late"] and tables["runs"].count() == 1


def test_every_event_settles(spark, tmp_path):
    batches = [[event("s", 1, 0, S.TASK, "early"), event("s", 2, 50, S.TASK, "in time"), event("t", 3, 55, S.TASK, "open"), event("u", 4, 56, S.TASK_FAILED, "t")],
               [event("s", 5, 100, S.COMPLETE, success=True), event("t", 6, 101, S.COMPLETE, success=False), event("s", 7, 102, S.TASK, "after")],
               [event("v", 8, 400, S.TASK, "waits")], [event("w", 9, 60, S.TASK, "late"), event("w", 10, 399, S.TASK, "in time too")], [event("x", 11, 401, S.TASK_FAILED, "t")]]
    log = str(tmp_path / "log")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, S.EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(log)
        stream = spark.readStream.schema(S.EVENT_SCHEMA).parquet(log)
        q = S.stream_runs(stream, str(tmp_path / "out"), str(tmp_path / "state"), lateness="5 minutes", longest_run="1 hour", salts=2)
        q.awaitTermination()
        reached = q.lastProgress["eventTime"].get("watermark") or None if q.lastProgress else reached
    got = {r["event_id"]: r["outcome"] for r in S.event_outcomes(spark.read.schema(S.EVENT_SCHEMA).parquet(log), str(tmp_path / "out"), reached, "1 hour").collect()}
    assert got == {1: "abandoned", 2: "released", 3: "abandoned", 4: "failed", 5: "released", 6: "failed", 7: "abandoned", 8: "waiting", 9: "late", 10: "waiting", 11: "failed"}
    assert {r["task_hash"] for r in S.read_tables(spark, str(tmp_path / "out"))["tasks"].collect()} == {"in time"}


def test_batch_counts(spark):
    row = S.batch_runs(spark.createDataFrame([e for e in LOG if e[4] != "late"], S.EVENT_SCHEMA)).collect()
    assert sorted(tuple(r) for r in row) == [("bare", 0, 0, 0), ("good", 2, 2, 1)]


def test_running_sum_over_one_hot_key(spark):
    rows = spark.range(5000).select(F.lit("hot").alias("k"), F.col("id").alias("i"), (F.col("id") % 3).alias("v"))
    got = running_sum(rows, ["k"], ["i"], F.col("v"), F.floor(F.col("i") / 97), "before")
    assert got.where(F.col("before") != F.floor(F.col("i") / 3) * 3 + F.when(F.col("i") % 3 == 2, 1).otherwise(0)).count() == 0
