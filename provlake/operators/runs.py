"""Run-log operators: which tasks count, who produced a file, what a run read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.operators.running import running_sum
from provlake.operators.skew import join_facts

# Task states that leave provenance, annotation keys, protected root keys.
KEPT_STATES = ["COMPLETED", "CACHED"]
ANNOTATION_KEYS = ["softwareName", "softwareVersion", "softwareAuthor", "softwareDescription",
                   "softwareUrl", "softwareFormat", "softwareKeywords"]
PROTECTED_ROOT_KEYS = ["@id", "@type", "conformsTo", "hasPart"]
NAME_BLOCK = 4096
#: Parameters of a run in one list, about.
PARAM_CHUNK = 20_000
DEFAULT_LICENSE = "https://spdx.org/licenses/Apache-2.0"


def successful_runs(df: DataFrame, runs: DataFrame, spread: str) -> DataFrame:
    """Rows of runs that ended well; a failed run leaves nothing. ``spread``: a column that
    differs among the rows of a run."""
    return join_facts(df, runs.where("success").select("session_id"), ["session_id"], spread)


def kept_tasks(tasks: DataFrame, runs: DataFrame) -> DataFrame:
    return successful_runs(tasks.where(F.col("status").isin(KEPT_STATES)), runs, "task_hash")


def latest_publishes(publishes: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    """Last target per source; a target without a source stands for itself."""
    rows = publishes.where(X.matches_globs("target", patterns or [], anywhere=True))
    return rows.withColumn("key", F.coalesce("source", "target")).groupBy("session_id", "key").agg(
        F.max_by("target", "seq").alias("target"), F.max("seq").alias("seq"))


def aliases(publishes: DataFrame) -> DataFrame:
    """(session_id, path, key): a published target stands for the file it came from."""
    return publishes.groupBy("session_id", F.col("target").alias("path")).agg(F.max_by("key", "seq").alias("key"))


def dataset_ark(path, naan: str = X.DEFAULT_NAAN) -> Column:
    return X.mint_ark("dataset", X.basename(path), path, naan)


def with_dataset_ark(df: DataFrame, alias: DataFrame, naan: str = X.DEFAULT_NAAN) -> DataFrame:
    """Add the identifier of the file behind ``path``."""
    key = F.coalesce(F.col("key"), F.col("path"))
    return df.join(alias, ["session_id", "path"], "left").withColumn("ark", dataset_ark(key, naan)).drop("key")


def producers(tasks: DataFrame, outputs: DataFrame) -> DataFrame:
    """(session_id, path, task_hash): the last task that wrote a path."""
    return outputs.join(tasks.select("session_id", "task_hash", "seq"), ["session_id", "task_hash"]) \
        .groupBy("session_id", "path").agg(F.max_by("task_hash", F.struct("seq", "ord", "task_hash")).alias("task_hash"))


def of_tasks(rows: DataFrame, tasks: DataFrame) -> DataFrame:
    return rows.join(tasks.select("session_id", "task_hash"), ["session_id", "task_hash"], "left_semi")


def run_inputs(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Distinct staged paths that no task of the run wrote."""
    return inputs.select("session_id", "path").distinct().join(
        outputs.select("session_id", "path"), ["session_id", "path"], "left_anti")


def staged_name_clashes(inputs: DataFrame) -> DataFrame:
    """Stage names used by more than one path of one task: an error row each."""
    return inputs.groupBy("session_id", "task_hash", "stage_name").agg(
        F.countDistinct("path").alias("n_paths")).where("n_paths > 1")


def flat_outputs(tasks: DataFrame, column: str = "outputs") -> DataFrame:
    """Nested output parameters (array of arrays) as one row per path, in order."""
    return tasks.select("session_id", "task_hash", F.posexplode(F.flatten(column)).alias("ord", "path"))


def staged_inputs(tasks: DataFrame, column: str = "inputs") -> DataFrame:
    """Input maps (stage name to path) as one row per staged file."""
    return tasks.select("session_id", "task_hash", F.explode(column).alias("stage_name", "path"))


def param_files(params: DataFrame, files: DataFrame) -> DataFrame:
    """Parameter values that name a file: remote ones as they are, local ones if listed."""
    rows = params.where((F.col("value_kind") == "string") & F.contains("value", F.lit("/")) & X.file_shaped("value"))
    remote = F.col("value").rlike(X.URI_SCHEME) & ~F.startswith("value", F.lit("file://"))
    path = F.regexp_replace("value", r"\Afile://", "")
    local = rows.where(~remote).select("session_id", "name", path.alias("path"))
    listed = files.where(~F.col("is_dir")).select("session_id", "path")
    return rows.where(remote).select("session_id", "name", F.col("value").alias("path")).unionByName(
        local.join(listed, ["session_id", "path"], "left_semi"))


def folded_params(params: DataFrame) -> DataFrame:
    """(session_id, name, parameter): 'name: value' texts, one row each."""
    return params.select("session_id", "name", F.concat(
        "name", F.lit(": "), X.param_value_text("value", "value_kind")).alias("parameter"))


def self_use_removed(used: DataFrame, generated: DataFrame) -> DataFrame:
    """(session_id, comp, ark) uses without what the same computation generated."""
    return used.join(generated.select("session_id", "comp", "ark"), ["session_id", "comp", "ark"], "left_anti")


def process_images(tasks: DataFrame) -> DataFrame:
    """(session_id, process, container) where all tasks of a process agree on the image."""
    named = tasks.where(F.col("container") != "")
    # min = max says "one image" without a distinct set per process
    return named.groupBy("session_id", "process").agg(
        F.min("container").alias("container"), F.max("container").alias("_last")) \
        .where(F.col("container") == F.col("_last")).drop("_last")


def annotation(ext, key: str) -> Column:
    return F.try_element_at(X.col(ext), F.lit(key))


def annotation_warnings(processes: DataFrame) -> DataFrame:
    """(session_id, process, problem, keys) for annotations that will be ignored."""
    unknown = F.array_sort(F.array_except(F.map_keys("ext"), F.array(*[F.lit(k) for k in ANNOTATION_KEYS])))
    return processes.where(F.col("ext").isNotNull() | ~F.col("ext_is_map")).select(
        "session_id", "process", F.when(~F.col("ext_is_map"), "not a map").when(
            F.size(unknown) > 0, "unrecognized keys").alias("problem"),
        F.when(F.col("ext_is_map"), F.array_join(unknown, ", ")).otherwise("").alias("keys")).where("problem is not null")


def param_lists(params: DataFrame) -> DataFrame:
    """(session_id, part, parameter): the parameters of a run as JSON lists, in order of their names.

    Up to ``PARAM_CHUNK`` of them are one list, part 0. More are dealt over lists of about that many by
    the hash of the parameter, so a run with any number of parameters never becomes one row.
    """
    rows = folded_params(params)
    parts = rows.groupBy("session_id").agg(F.ceil(F.count("*") / PARAM_CHUNK).alias("parts"))
    dealt = join_facts(rows, parts, ["session_id"], "name").withColumn("part", F.pmod(F.xxhash64("name", "parameter"), F.col("parts")).cast("int"))
    # dealt before they are gathered: gathering first would hold all parameters of a task in its memory
    return dealt.repartition("session_id", "part").groupBy("session_id", "part").agg(F.to_json(F.transform(F.array_sort(F.collect_list(
        F.struct("name", "parameter"))), lambda p: p["parameter"])).alias("parameter"))


def overlay_root(crates: DataFrame, metadata: DataFrame) -> DataFrame:
    """User metadata over root properties: user keys win, nulls and protected keys do not."""
    usable = F.map_filter(F.coalesce("metadata", F.create_map().cast("map<string,string>")),
                          lambda k, v: v.isNotNull() & ~k.isin(PROTECTED_ROOT_KEYS))
    joined = crates.join(metadata, "crate_id", "left")
    kept = F.map_filter("root_props", lambda k, v: ~F.map_contains_key(usable, k))
    return joined.withColumn("root_props", F.map_concat(kept, usable)).drop("metadata")


def refused_root_keys(metadata: DataFrame) -> DataFrame:
    return metadata.select("crate_id", F.explode(F.map_keys("metadata")).alias("key")).where(
        F.col("key").isin(PROTECTED_ROOT_KEYS))


def first_given(*choices) -> Column:
    """First choice that is neither null nor empty."""
    return F.coalesce(*[X.blank_to_null(c) for c in choices])


def copied_names(sources: DataFrame) -> DataFrame:
    """(session_id, path, seq) -> name inside the crate; equal basenames get '-2', '-3', ...

    A first round numbers equal basenames in order. A generated name that is itself taken
    by another source's basename moves on past every taken number of that stem.
    """
    name = X.basename("path")
    dot = F.length(F.regexp_extract(name, r"\A(.+)\.[^.]*\z", 1))
    stem = F.when(dot > 0, F.substr(name, F.lit(1), dot)).otherwise(name)
    rows = sources.select("session_id", "path", "seq", name.alias("name"), stem.alias("stem"),
                          F.substr(name, F.length(stem) + 1).alias("ext"))
    rows = running_sum(rows, ["session_id", "name"], ["seq", "path"], F.lit(1), F.floor(F.col("seq") / NAME_BLOCK), "before")
    rows = rows.withColumn("nth", F.col("before") + 1).drop("before")
    # numbers already spelled out in real basenames of the same stem and extension
    key = ["session_id", "stem", "ext"]
    number = F.regexp_extract("name", r"-([2-9]|[1-9][0-9]+)(\.[^.]*)?\z", 1)
    taken = rows.where((F.col("nth") == 1) & (number != "")).select(
        "session_id", F.expr("substr(stem, 1, length(stem) - length(regexp_extract(stem, '-[0-9]+$', 0)))").alias("stem"),
        "ext", number.try_cast("bigint").alias("number")).where("number is not null").distinct()
    taken = running_sum(taken, key, ["number"], F.lit(1), F.floor(F.col("number") / NAME_BLOCK), "smaller")
    # The j-th repeat takes the j-th free number. In one order, a taken number stands before the
    # first repeat it moves on: the one after as many as there are free numbers below it.
    none = lambda kind: F.lit(None).cast(kind)
    marks = taken.select(*key, (F.col("number") - 1 - F.col("smaller")).alias("place"), F.lit(1).alias("is_taken"), "number",
                         none("string").alias("path"), none("bigint").alias("seq"), none("bigint").alias("nth"))
    repeats = rows.where("nth > 1").select(*key, (F.col("nth") - 1).alias("place"), F.lit(0).alias("is_taken"), F.lit(0).cast("bigint").alias("number"),
                                           "path", F.col("seq").cast("bigint").alias("seq"), "nth")
    merged = running_sum(marks.unionByName(repeats), key, [F.col("place"), F.col("is_taken").desc(), F.col("number")],
                         F.col("is_taken"), F.floor(F.col("place") / NAME_BLOCK), "skip").where("is_taken = 0")
    moved = merged.select("session_id", "path", "seq", F.concat("stem", F.lit("-"), (F.col("nth") + F.col("skip")).cast("string"), "ext").alias("copied_as"))
    return rows.where("nth = 1").select("session_id", "path", F.col("seq").cast("bigint").alias("seq"), F.col("name").alias("copied_as")).unionByName(moved)
