"""Run events as a stream: a run's events are released when it completes well.

The accumulator is an outer stream-stream join of events with successful completions. Events wait
in join state until their completion arrives. What finds none (its run failed, never ended, or
had ended before) comes out as abandoned once the watermark passes the longest run, so every
event that is not later than the watermark settles in one row; ``event_outcomes`` names the rest.
Sessions are salted, so one session may hold any share of the events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.operators.running import running_sum

EVENT_SCHEMA = """session_id string, event_id bigint, ts timestamp, kind string, key string, value string, success boolean"""

# Event kinds.
TASK, TASK_FAILED, TASK_CACHED = "task", "task_failed", "task_cached"
PUBLISH, OUTPUT, COMPLETE = "publish", "output", "complete"
SALTS = 16


RELEASED, ABANDONED, FAILED, LATE, WAITING = "released", "abandoned", "failed", "late", "waiting"
_SETTLED = ["session_id", "event_id", "ts", "kind", "key", "value", "complete_ts", "outcome"]


def settled_events(events: DataFrame, lateness: str, longest_run: str, salts: int = SALTS) -> DataFrame:
    """Every event with its ``outcome``: released with its run's ``complete_ts``, abandoned, or failed.

    An event after its run's completion is abandoned. Failed tasks and unsuccessful completions
    settle as failed at once. ``lateness`` and ``longest_run`` bound the state and have no
    default: an event longer before its completion is abandoned, one later than the watermark is
    dropped by the engine, which counts it in the query's progress. An event without a time or a
    kind belongs to no run and is abandoned at once.
    """
    is_end, good = F.col("kind") == COMPLETE, F.coalesce("success", F.lit(False))
    # a test that also reads the time is not moved before the watermark, which every event then drives, not completions alone
    timed = lambda test: F.when(F.col("ts").isNotNull(), test).otherwise(False)
    work = events.withWatermark("ts", lateness).where(timed(~F.col("kind").isin(COMPLETE, TASK_FAILED))).select(
        "session_id", "event_id", "ts", "kind", "key", "value", F.pmod(F.xxhash64("event_id"), F.lit(salts)).alias("salt"))
    done = events.withWatermark("ts", lateness).where(timed(is_end & good)).select(
        F.col("session_id").alias("done_session"), F.col("ts").alias("complete_ts"), F.col("event_id").alias("complete_id"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("done_salt"))
    same = (F.col("session_id") == F.col("done_session")) & (F.col("salt") == F.col("done_salt"))
    in_run = (F.col("ts") <= F.col("complete_ts")) & (F.col("ts") >= F.col("complete_ts") - F.expr(f"interval {longest_run}"))
    before = (F.col("ts") < F.col("complete_ts")) | (F.col("event_id") < F.col("complete_id"))
    outcome = F.when(F.col("complete_ts").isNull(), ABANDONED).otherwise(RELEASED).alias("outcome")
    kept = work.join(done, same & in_run & before, "left_outer").select(*_SETTLED[:-1], outcome)
    ended = is_end & good & F.col("ts").isNotNull()
    at_once = events.where(F.coalesce(is_end | (F.col("kind") == TASK_FAILED), F.lit(True)) | F.col("ts").isNull()).select(
        *_SETTLED[:-2], F.when(ended, F.col("ts")).alias("complete_ts"), F.when(ended, RELEASED).when(is_end | (F.col("kind") == TASK_FAILED), FAILED).otherwise(ABANDONED).alias("outcome"))
    return kept.union(at_once)


def event_outcomes(events: DataFrame, out: str, watermark: str | None, longest_run: str) -> DataFrame:
    """(session_id, event_id, outcome) of every event of a log, after a stream over it wrote below ``out``.

    What the stream did not settle is late if the watermark (as the query's progress tells it)
    has passed the time it could wait for, else it waits. Events are told apart by session and id.
    """
    settled = events.sparkSession.read.schema("session_id string, event_id bigint, outcome string").parquet(f"{out}/settled")
    # an event of a run that completed twice was released twice
    once = settled.groupBy("session_id", "event_id").agg(F.max("outcome").alias("outcome"))
    passed = F.lit(False) if watermark is None else F.col("ts") < F.to_timestamp(F.lit(watermark)) - F.expr(f"interval {longest_run}")
    return events.join(once, ["session_id", "event_id"], "left").select(
        "session_id", "event_id", F.coalesce("outcome", F.when(passed, LATE).otherwise(WAITING)).alias("outcome"))


LAST = "struct(ts, event_id)"


def run_tables(released: DataFrame) -> dict[str, DataFrame]:
    """Runs, tasks (each once), publishes (last target per source), outputs (last path per name).

    Every row says by ``at`` which event it comes from, so tables of several batches merge.
    """
    at = F.expr(LAST)
    runs = released.where(F.col("kind") == COMPLETE).groupBy("session_id").agg(F.max("complete_ts").alias("complete_ts"), F.max(at).alias("at"))
    tasks = released.where(F.col("kind").isin(TASK, TASK_CACHED)).groupBy("session_id", F.col("key").alias("task_hash")).agg(
        F.max_by("kind", at).alias("kind"), F.max("complete_ts").alias("complete_ts"), F.max(at).alias("at"))
    pub = released.where(F.col("kind") == PUBLISH).groupBy("session_id", F.coalesce("key", "value").alias("source")).agg(
        F.max_by("value", at).alias("target"), F.max(at).alias("at"))
    out = released.where(F.col("kind") == OUTPUT).groupBy("session_id", F.col("key").alias("name")).agg(
        F.max_by("value", at).alias("path"), F.max(at).alias("at"))
    return {"runs": runs, "tasks": tasks, "publishes": pub, "workflow_outputs": out}


def read_tables(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    """The tables of all batches below ``out``: a key that several batches wrote keeps its last row."""
    tables = {}
    for name, key in (("runs", ["session_id"]), ("tasks", ["session_id", "task_hash"]), ("publishes", ["session_id", "source"]), ("workflow_outputs", ["session_id", "name"])):
        rows = spark.read.parquet(f"{out}/{name}").drop("batch")
        rest = [c for c in rows.columns if c not in key]
        tables[name] = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), "at").alias("r")).select(*key, *[f"r.{c}" for c in rest if c != "at"])
    return tables


def stream_runs(events: DataFrame, out: str, checkpoint: str, steps: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] | None = None,
                trigger: dict | None = None, **release):
    """Start the query that writes the tables of every completed run below ``out``, and what was not released.

    Each micro-batch writes its own folder and replaces it when replayed, so a restart leaves
    no duplicates; ``read_tables`` merges the batches. ``steps`` derive further tables from a
    batch's tables; a step that fails leaves a row in ``errors``, under its name and batch, and
    does not stop the stream. ``trigger`` is the writer's; without it all there is is read once.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        path = lambda name: f"{out}/{name}/batch={batch_id}"
        batch.write.mode("overwrite").partitionBy("outcome").parquet(path("settled"))
        released = spark.read.schema(batch.schema).parquet(path("settled")).where(F.col("outcome") == RELEASED)
        tables = run_tables(released)
        for name, table in tables.items():
            table.write.mode("overwrite").parquet(path(name))
        for name, step in (steps or {}).items():
            try:
                step(tables).write.mode("overwrite").parquet(path(name))
            except Exception as e:
                spark.createDataFrame([(str(e),)], "error string").write.mode("overwrite").parquet(f"{out}/errors/step={name}/batch={batch_id}")
    return settled_events(events, **release).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(
        **(trigger or {"availableNow": True})).start()


def numbered_runs(events: DataFrame) -> DataFrame:
    """The user event table as run events: purchases close runs, success above a value.

    The run number counts the purchases strictly before; minutes are the blocks of the running
    count, so a user with a third of all events is still many tasks' work.
    """
    closes = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    rows = running_sum(events, ["user_id"], ["ts", "event_id"], closes, F.date_trunc("minute", "ts"), "run")
    kind = F.create_map(*[F.lit(x) for pair in (("view", TASK), ("error", TASK_FAILED), ("click", PUBLISH), ("signup", OUTPUT), ("purchase", COMPLETE))
                          for x in pair])
    return rows.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("run").cast("string")).alias("session_id"), "event_id", "ts",
        F.try_element_at(kind, F.col("event_type")).alias("kind"), F.col("event_id").cast("string").alias("key"),
        F.get_json_object("props", "$.k").alias("value"), (F.col("value") > 10).alias("success"))


def batch_runs(events: DataFrame) -> DataFrame:
    """(session_id, n_tasks, n_published, n_outputs) per successful run, from a finished log."""
    done = events.where((F.col("kind") == COMPLETE) & F.col("success")).select("session_id")
    kept = events.where(~F.col("kind").isin(TASK_FAILED)).join(done, "session_id", "left_semi")
    # one row per task / source / name first: repeats combine before anything is counted
    facts = kept.where(F.col("kind") != COMPLETE).groupBy("session_id", "kind", F.coalesce("key", "value").alias("key")).agg(F.lit(1).alias("one"))
    return done.select("session_id").distinct().join(facts, "session_id", "left").groupBy("session_id").agg(
        F.count_if(F.col("kind").isin(TASK, TASK_CACHED)).alias("n_tasks"), F.count_if(F.col("kind") == PUBLISH).alias("n_published"),
        F.count_if(F.col("kind") == OUTPUT).alias("n_outputs"))
