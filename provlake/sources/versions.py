"""Tool versions from two-level text files: 'process:' lines and indented 'tool: version' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.operators.running import running_sum
from provlake.session import cut

# Name of a process's own file, pattern of collated files.
BLOCK_LINES = 10_000
OWN_NAME = "versions.yml"
COLLATED = r"(?is)\A.*versions.*\.ya?ml\z"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, line) of the text files below a folder; lines end at LF, CR or both.

    Files split over tasks at LF. Within a split rows keep their order, splits are ordered by
    where they begin, and a line's number is the lines of all rows before it, summed inside
    splits and over splits, so neither a file nor its lines are ever one task's work.
    """
    rows = spark.read.text(path, lineSep="\n", recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq"),
        F.split(F.regexp_replace("value", r"\r\z", ""), r"\r", -1).alias("lines"))
    rows = cut(rows, "lines")  # written, so that the numbers stay
    counted = running_sum(rows, ["file"], ["seq"], F.size("lines"), F.col("block"), "before")
    return counted.select("file", "before", F.posexplode("lines").alias("at", "line")).select("file", (F.col("before") + F.col("at")).alias("line_no"), "line")


def version_pairs(lines: DataFrame) -> DataFrame:
    """(file, process, tool, version, first_line, last_line); a repeated tool keeps its last version.

    The line that opens a process is carried to the lines after it inside blocks of lines and
    from block to block, so a file of any length is many tasks' work.
    """
    body = X.trim_ws("line")
    rows = lines.where((body != "") & ~F.startswith(body, F.lit("#")) & F.contains("line", F.lit(":")))
    key = X.unquote(F.substring_index("line", ":", 1))
    value = X.unquote(F.substr(F.col("line"), F.instr("line", ":") + 1))
    opens = ~F.col("line").rlike(r"\A\s")
    rows = rows.select("file", "line_no", key.alias("key"), value.alias("value"), opens.alias("opens"))
    rows = rows.withColumn("block", F.floor(F.col("line_no") / BLOCK_LINES))
    inside = Window.partitionBy("file", "block").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.when(F.col("opens"), F.col("key"))
    blocks = rows.groupBy("file", "block").agg(F.max_by(opened, F.when(F.col("opens"), F.col("line_no"))).alias("last"))
    blocks = blocks.select("file", "block", F.last("last", ignorenulls=True).over(earlier).alias("before"))
    rows = rows.withColumn("process", F.last(opened, ignorenulls=True).over(inside)).join(blocks, ["file", "block"])
    rows = rows.withColumn("process", F.coalesce("process", "before"))
    pairs = rows.where(~F.col("opens") & F.col("process").isNotNull() & (F.col("key") != "") & (F.col("value") != ""))
    return pairs.groupBy("file", "process", F.col("key").alias("tool")).agg(
        F.max_by("value", "line_no").alias("version"), F.min("line_no").alias("first_line"), F.max("line_no").alias("last_line"))


def collated_files(paths: DataFrame) -> DataFrame:
    """(.., path) rows whose name says it collates versions of several processes."""
    name = X.basename("path")
    return paths.where(name.rlike(COLLATED) & (name != OWN_NAME))


def merged_versions(pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """process -> tool -> version over several files; the later file wins (``file_seq``)."""
    keys = keys or []
    return pairs.groupBy(*keys, "process", "tool").agg(
        F.max_by("version", F.struct("file_seq", "last_line")).alias("version"),
        F.min(F.struct("file_seq", "first_line")).alias("first_at"))


def version_texts(pairs: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One text per key: a lone tool's version, or 'tool version' for several.

    The tools one process reports come from one small file, so the list is short.
    """
    items = F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), "tool", "version")))
    return pairs.groupBy(*keys).agg(X.format_versions(F.transform(items, lambda s: F.struct(
        s["tool"].alias("tool"), s["version"].alias("version")))).alias("version"))


def process_versions(processes: DataFrame, own: DataFrame, collated: DataFrame) -> DataFrame:
    """(session_id, process, version): the process's own report, else the collated one by bare
    name, else by qualified name. ``own`` and ``collated``: session_id, process, version."""
    p = processes.select("session_id", "process").distinct().withColumn("bare", X.bare_name("process"))
    mine = own.select("session_id", "process", F.col("version").alias("v1"))
    bare = collated.select("session_id", F.col("process").alias("bare"), F.col("version").alias("v2"))
    full = collated.select("session_id", "process", F.col("version").alias("v3"))
    return p.join(mine, ["session_id", "process"], "left").join(bare, ["session_id", "bare"], "left").join(
        full, ["session_id", "process"], "left").select("session_id", "process", F.coalesce("v1", "v2", "v3").alias("version"))
