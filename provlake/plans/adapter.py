"""Run-log tables derived from the order tables: one session per region.

Parts are source files, orders / customers / nations / regions are levels of tasks. Every
table is a plain select over its inputs, so it grows with them.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from provlake.model import RunLog, quote

LEVEL = 10 ** 12


class _Folder:
    """The tables of one folder; each file's footer is read once."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        setattr(self, name, frame)
        return frame


_FOLDERS: dict[tuple[str, str], _Folder] = {}


def Tables(spark: SparkSession, folder: str) -> _Folder:
    key = (spark.sparkContext.applicationId, folder)
    if key not in _FOLDERS:
        _FOLDERS[key] = _Folder(spark, folder)
    return _FOLDERS[key]


def plan_once(fn):
    """Build the plan of an adapter table once per folder."""
    made: dict = {}

    @wraps(fn)
    def get(t, *args):
        if args:
            return fn(t, *args)
        if t not in made:
            made[t] = fn(t)
        return made[t]
    return get


def text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def part_path(size="p_size", key="p_partkey") -> Column:
    kind = F.when(F.col(size) % 2 == 0, ".csv").otherwise(".tsv")
    return F.concat(F.lit("work/part/"), text(key), kind)


def path_of(level: str, key, ext: str = "csv") -> Column:
    return F.concat(F.lit(f"work/{level}/"), text(key), F.lit(f".{ext}"))


@plan_once
def customers(t: _Folder) -> DataFrame:
    nation = t.nation.select("n_nationkey", "n_regionkey")
    return t.customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_mktsegment", "n_nationkey", "n_regionkey",
        F.concat(F.lit("region-"), text("n_regionkey")).alias("session_id"))


@plan_once
def orders(t: _Folder) -> DataFrame:
    status = F.when((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "P"), "FAILED") \
        .when(F.col("o_orderstatus") == "O", "CACHED").otherwise("COMPLETED")
    return t.orders.select("o_orderkey", "o_custkey", "o_orderpriority", status.alias("status")) \
        .join(customers(t), F.col("o_custkey") == F.col("c_custkey"))


@plan_once
def nations(t: _Folder) -> DataFrame:
    return t.nation.select("n_nationkey", "n_name", "n_regionkey",
                           F.concat(F.lit("region-"), text("n_regionkey")).alias("session_id"))


@plan_once
def regions(t: _Folder) -> DataFrame:
    return t.region.select("r_regionkey", "r_name", F.concat(F.lit("region-"), text("r_regionkey")).alias("session_id"))


def _task(level: str, rank: int, key: str, process: Column, tag: Column, status: Column) -> list[Column]:
    return [
        F.col("session_id"), F.concat(F.lit(level[0]), text(key)).alias("task_hash"),
        F.concat(process, F.lit(" ("), text(key), F.lit(")")).alias("task_name"), process.alias("process"),
        F.concat(F.lit(f"#!/bin/sh\nbuild {level} --key "), text(key), F.lit("\n  publish "), text(key)).alias("script"),
        F.concat(F.lit(f"reg.example:5000/trade/{level}:"), tag).alias("container"), status.alias("status"),
        (F.lit(rank * LEVEL) + F.col(key)).cast("bigint").alias("seq")]


@plan_once
def tasks(t: _Folder) -> DataFrame:
    done = F.lit("COMPLETED")
    return orders(t).select(*_task("order", 1, "o_orderkey", F.concat(F.lit("TRADE:ORDERS:"), "o_orderpriority"),
                                   F.substring("o_orderpriority", 1, 1), F.col("status"))) \
        .unionByName(customers(t).select(*_task("customer", 2, "c_custkey", F.concat(
            F.lit("TRADE:CUSTOMERS:"), "c_mktsegment"), F.lit("1"), done))) \
        .unionByName(nations(t).select(*_task("nation", 3, "n_nationkey", F.lit("TRADE:NATIONS:ROLLUP"), F.lit("1"), done))) \
        .unionByName(regions(t).select(*_task("region", 4, "r_regionkey", F.lit("TRADE:REGIONS:ROLLUP"), F.lit("1"), done)))


def order_parts(t: _Folder, lines: DataFrame | None = None) -> DataFrame:
    """Distinct (order, part); pairs spread a hot order or part over many tasks."""
    lines = t.lineitem if lines is None else lines
    return lines.select("l_orderkey", "l_partkey").distinct()


@plan_once
def task_inputs(t: _Folder, lines: DataFrame | None = None) -> DataFrame:
    def rows(df, level, key, path):
        return df.select("session_id", F.concat(F.lit(level), text(key)).alias("task_hash"),
                         F.substring_index(path, "/", -1).alias("stage_name"), path.alias("path"))
    parts = order_parts(t, lines).join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey"))
    sess = orders(t).select("o_orderkey", "session_id")
    parts = parts.join(sess, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows(parts, "o", "o_orderkey", part_path()) \
        .unionByName(rows(orders(t), "c", "c_custkey", path_of("order", "o_orderkey", "json"))) \
        .unionByName(rows(customers(t), "n", "n_nationkey", path_of("customer", "c_custkey"))) \
        .unionByName(rows(nations(t), "r", "n_regionkey", path_of("nation", "n_nationkey"))) \
        .unionByName(rows(regions(t), "r", "r_regionkey", path_of("collated", "r_regionkey", "yml")))


@plan_once
def task_outputs(t: _Folder) -> DataFrame:
    def rows(df, level, key, path):
        return df.select("session_id", F.concat(F.lit(level), text(key)).alias("task_hash"), path.alias("path"),
                         F.lit(0).alias("ord"))
    return rows(orders(t), "o", "o_orderkey", path_of("order", "o_orderkey", "json")) \
        .unionByName(rows(customers(t), "c", "c_custkey", path_of("customer", "c_custkey"))) \
        .unionByName(rows(nations(t), "n", "n_nationkey", path_of("nation", "n_nationkey"))) \
        .unionByName(rows(regions(t), "r", "r_regionkey", path_of("region", "r_regionkey")))


@plan_once
def publishes(t: _Folder) -> DataFrame:
    def rows(df, level, rank, key, ext="csv"):
        return df.select("session_id", path_of(level, key, ext).alias("source"),
                         F.concat(F.lit(f"results/{level}/"), text(key), F.lit(f".{ext}")).alias("target"),
                         (F.lit(rank * LEVEL) + F.col(key)).cast("bigint").alias("seq"))
    return rows(customers(t), "customer", 2, "c_custkey") \
        .unionByName(rows(nations(t), "nation", 3, "n_nationkey")) \
        .unionByName(rows(regions(t), "region", 4, "r_regionkey")) \
        .unionByName(rows(regions(t), "collated", 5, "r_regionkey", "yml"))


@plan_once
def runs(t: _Folder) -> DataFrame:
    """One successful run per region, and a failed one per nation that must leave no trace."""
    def rows(df, run_name, success):
        return df.select(
            "session_id", run_name.alias("run_name"), F.lit("flows/trade.flow").alias("script_file"),
            F.lit("2024-01-01T00:00:00Z").alias("start_ts"), F.lit("2024-01-02T00:00:00Z").alias("complete_ts"),
            F.lit("engine").alias("engine_name"), F.lit("1.0").alias("engine_version"),
            F.concat(F.lit("run trade --region "), F.col("session_id")).alias("command"),
            F.lit(success).alias("success"), F.lit("Trade Desk").alias("author"), F.lit(None).cast("string").alias("license"),
            run_name.alias("description"), F.lit("2.1").alias("version"), F.lit("results").alias("crate_dir"))
    return rows(regions(t), F.concat(F.lit("Trade "), F.lower("r_name")), True) \
        .unionByName(rows(nations(t).withColumn("session_id", F.concat(F.lit("draft-"), text("n_nationkey"))),
                          F.lower("n_name"), False))


@plan_once
def workflow_outputs(t: _Folder) -> DataFrame:
    return regions(t).select("session_id", F.lit("summary").alias("name"), path_of("region", "r_regionkey").alias("path")) \
        .unionByName(regions(t).select("session_id", F.lit("label").alias("name"), F.lit(None).cast("string").alias("path")))


@plan_once
def params(t: _Folder) -> DataFrame:
    """Per customer of a region: a file path, a plain number, a list and an empty value."""
    c = customers(t)
    def rows(name, value, kind):
        return c.select("session_id", F.concat(F.lit(name), text("c_custkey")).alias("name"), value.alias("value"),
                        F.lit(kind).alias("value_kind"))
    return rows("sheet_", F.concat(F.lit("results/customer/"), text("c_custkey"), F.lit(".csv")), "string") \
        .unionByName(rows("remote_", F.concat(F.lit("s3://trade/in/"), text("c_custkey"), F.lit(".csv")), "string")) \
        .unionByName(rows("gone_", F.concat(F.lit("lost/customer/"), text("c_custkey"), F.lit(".csv")), "string")) \
        .unionByName(rows("dir_", F.concat(F.lit("results/"), F.lower("c_mktsegment")), "string")) \
        .unionByName(rows("limits_", F.concat(F.lit("["), text("c_custkey"), F.lit(","), text("n_nationkey"), F.lit("]")), "list")) \
        .unionByName(rows("empty_", F.lit(None).cast("string"), "null"))


@plan_once
def processes(t: _Folder) -> DataFrame:
    """Distinct processes with their annotations: customers' are annotated, some wrongly."""
    p = tasks(t).select("session_id", "process", F.substring_index("process", ":", -1).alias("leaf")).distinct()
    ext = F.when(F.startswith("process", F.lit("TRADE:CUSTOMERS:")), F.create_map(
        F.lit("softwareName"), F.lower("leaf"), F.lit("softwareVersion"), F.lit("8.32"),
        F.lit("ownerTeam"), F.lit("desk"))).when(F.startswith("process", F.lit("TRADE:NATIONS:")), F.create_map(
            F.lit("softwareUrl"), F.lit("https://example.org/rollup"))).otherwise(
                F.lit(None).cast("map<string,string>"))
    return p.select("session_id", "process", F.lit("flows/trade.flow").alias("script_path"),
                    F.concat(F.lit("def key = 1\n\"\"\"\nbuild "), F.lower("leaf"), F.lit("\n\"\"\"")).alias("body"),
                    ext.alias("ext"), F.lit(True).alias("ext_is_map"))


@plan_once
def files(t: _Folder) -> DataFrame:
    """Listing of work and results files: length is the key, the digest is of the path."""
    def rows(df, prefix, level, key, ext="csv"):
        p = F.concat(F.lit(f"{prefix}/{level}/"), text(key), F.lit(f".{ext}"))
        return df.select("session_id", p.alias("path"), F.col(key).cast("bigint").alias("length"),
                         F.lit(False).alias("is_dir"), F.md5(p).alias("md5"))
    # which parts a session stages, before their paths are looked up
    used = t.lineitem.select("l_orderkey", "l_partkey").join(orders(t).select("o_orderkey", "session_id"), F.col("l_orderkey") == F.col("o_orderkey")) \
        .select("session_id", "l_partkey").distinct()
    parts = used.join(t.part.select("p_partkey", "p_size"), F.col("l_partkey") == F.col("p_partkey")) \
        .select("session_id", part_path().alias("path")).distinct() \
        .select("session_id", "path", F.regexp_extract("path", r"(\d+)\.", 1).cast("bigint").alias("length"),
                F.lit(False).alias("is_dir"), F.md5("path").alias("md5"))
    made = rows(orders(t), "work", "order", "o_orderkey", "json")
    for prefix in ("work", "results"):
        made = made.unionByName(rows(customers(t), prefix, "customer", "c_custkey")) \
            .unionByName(rows(nations(t), prefix, "nation", "n_nationkey")) \
            .unionByName(rows(regions(t), prefix, "region", "r_regionkey")) \
            .unionByName(rows(regions(t), prefix, "collated", "r_regionkey", "yml"))
    return made.unionByName(parts)


@plan_once
def run_log(t: _Folder) -> RunLog:
    return RunLog(runs=runs(t), tasks=tasks(t), task_inputs=task_inputs(t), task_outputs=task_outputs(t),
                  publishes=publishes(t), workflow_outputs=workflow_outputs(t), params=params(t),
                  processes=processes(t), files=files(t))


@plan_once
def inspect_log(t: _Folder) -> DataFrame:
    """Image inspect records, one per distinct image of a session; some unusable."""
    images = tasks(t).select(F.col("container").alias("image")).distinct()
    repo = F.regexp_replace("image", ":[^:/]*$", "")
    digest = F.concat(repo, F.lit("@sha256:"), F.sha2("image", 256))
    other = F.concat(F.lit("mirror.example/"), F.substring_index(repo, "/", -1), F.lit("@sha256:"), F.sha2("image", 256))
    body = F.concat(F.lit('{"Id":'), quote(F.concat(F.lit("sha256:"), F.sha2(repo, 256))), F.lit(',"RepoDigests":['),
                    quote(other), F.lit(","), quote(digest), F.lit("]}"))
    nothing = F.concat(F.lit('{"Id":'), quote(F.sha2("image", 256)), F.lit('}'))
    return images.select("image", F.when(F.contains("image", F.lit("/nation:")), F.lit("no such image"))
                         .when(F.contains("image", F.lit("/region:")), nothing)
                         .when(F.contains("image", F.lit("/customer:")), F.concat(F.lit("["), body, F.lit("]")))
                         .otherwise(body).alias("json"))
