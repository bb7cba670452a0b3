"""Queries over run events, as a finished log and as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from provlake.plans import adapter as A
from provlake.session import workspace
from provlake.streaming import runs as S

QUERIES, SQL = {}, {}


def register(name, sql=None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return wrap


NUMBERED = """numbered AS (SELECT *, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS run FROM events),
    done AS (SELECT user_id, run FROM numbered WHERE event_type = 'purchase' AND value > 10)"""
RUNS = """SELECT user_id || '-' || run AS session_id, count(*) FILTER (event_type = 'view')::BIGINT AS n_tasks, count(*) FILTER (event_type = 'click')::BIGINT AS n_published,
    count(*) FILTER (event_type = 'signup')::BIGINT AS n_outputs FROM numbered JOIN done USING (user_id, run) GROUP BY user_id, run"""


@register("runs_from_events", f"WITH {NUMBERED} {RUNS}")
def runs_from_events(spark, folder):
    return S.batch_runs(S.numbered_runs(A.Tables(spark, folder).events))


@register("run_numbers", f"WITH {NUMBERED} SELECT event_id, user_id || '-' || run AS session_id FROM numbered")
def run_numbers(spark, folder):
    return S.numbered_runs(A.Tables(spark, folder).events).select("event_id", "session_id")


@register("streamed_runs", f"WITH {NUMBERED} {RUNS}")
def streamed_runs(spark, folder):
    """The same log, read as a stream of files and released by completions."""
    home = workspace(spark, "events")
    S.numbered_runs(A.Tables(spark, folder).events).repartitionByRange(8, "ts", "event_id").write.parquet(f"{home}/log")
    events = spark.readStream.schema(S.EVENT_SCHEMA).option("maxFilesPerTrigger", 3).parquet(f"{home}/log")
    S.stream_runs(events, f"{home}/out", f"{home}/state", lateness="40 days", longest_run="40 days", salts=4).awaitTermination()
    tables = S.read_tables(spark, f"{home}/out")
    table = lambda name: tables[name].groupBy("session_id").agg(F.count("*").alias("n"))
    counts = tables["runs"].select("session_id")
    for name, column in (("tasks", "n_tasks"), ("publishes", "n_published"), ("workflow_outputs", "n_outputs")):
        one = table(name).withColumnRenamed("n", column)
        counts = counts.join(one, "session_id", "left")
    return counts.select("session_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_tasks", "n_published", "n_outputs")])


@register("streamed_outcomes", f"""WITH {NUMBERED} SELECT event_id, n.user_id || '-' || n.run AS session_id,
    CASE WHEN event_type = 'error' OR (event_type = 'purchase' AND NOT coalesce(value > 10, false)) THEN 'failed' WHEN d.run IS NULL THEN 'abandoned' ELSE 'released' END AS outcome
    FROM numbered n LEFT JOIN done d ON d.user_id = n.user_id AND d.run = n.run""")
def streamed_outcomes(spark, folder):
    """What became of every event, after a last event far ahead let the watermark expire all open runs."""
    home = workspace(spark, "events")
    log = S.numbered_runs(A.Tables(spark, folder).events)
    log.repartitionByRange(8, "ts", "event_id").write.parquet(f"{home}/log")
    end = log.agg((F.max("ts") + F.expr("interval 1000 days")).alias("ts")).select(
        F.lit("end").alias("session_id"), F.lit(-1).cast("bigint").alias("event_id"), "ts", F.lit(S.TASK_FAILED).alias("kind"), *[F.lit(None).cast("string").alias(c) for c in ("key", "value")],
        F.lit(None).cast("boolean").alias("success"))
    end.write.mode("append").parquet(f"{home}/log")
    events = spark.readStream.schema(S.EVENT_SCHEMA).option("maxFilesPerTrigger", 3).parquet(f"{home}/log")
    stream = S.stream_runs(events, f"{home}/out", f"{home}/state", lateness="40 days", longest_run="40 days", salts=4)
    stream.awaitTermination()
    reached = stream.lastProgress["eventTime"].get("watermark")
    return S.event_outcomes(log, f"{home}/out", reached, "40 days").select("event_id", "session_id", "outcome")
