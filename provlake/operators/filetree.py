"""Files and folders: containment, expansion, tree sizes, locators, formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from provlake.functions import text as X
from provlake.operators.skew import first_k

# Media types by extension.
MEDIA_TYPES = {
    "bz2": "application/x-bzip2", "css": "text/css", "csv": "text/csv", "gif": "image/gif",
    "gz": "application/gzip", "htm": "text/html", "html": "text/html", "jpeg": "image/jpeg",
    "jpg": "image/jpeg", "js": "text/javascript", "json": "application/json", "md": "text/markdown",
    "pdf": "application/pdf", "png": "image/png", "py": "text/x-python", "sh": "application/x-sh",
    "svg": "image/svg+xml", "tar": "application/x-tar", "tsv": "text/tab-separated-values",
    "txt": "text/plain", "xml": "application/xml", "yaml": "application/yaml", "yml": "application/yaml",
    "zip": "application/zip",
}


def media_type(path, table: dict[str, str] | None = None) -> Column:
    table = MEDIA_TYPES if table is None else table
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    if not pairs:
        return F.lit(None).cast("string")
    return F.try_element_at(F.create_map(*pairs), F.lower(X.extension(path)))


def file_format(path, table: dict[str, str] | None = None) -> Column:
    """Media type, else the extension, else 'unknown'. An empty table keeps extensions."""
    return F.coalesce(media_type(path, table), F.nullif(X.extension(path), F.lit("")), F.lit("unknown"))


def is_tabular(path) -> Column:
    return F.lower(X.extension(path)).isin("csv", "tsv")


def in_folders(files: DataFrame, folders: DataFrame) -> DataFrame:
    """(session_id, path, dir): files under a folder, by equi-join on their ancestors."""
    return files.withColumn("dir", F.explode(X.ancestors("path"))).join(
        folders.select("session_id", "dir").distinct(), ["session_id", "dir"])


def tree_sizes(files: DataFrame, folders: DataFrame | None = None) -> DataFrame:
    """(session_id, dir, n_files, size): regular files under each folder, at any depth."""
    plain = files.where(~F.col("is_dir")).select("session_id", "path", "length")
    rows = plain.withColumn("dir", F.explode(X.ancestors("path"))) if folders is None else in_folders(plain, folders)
    return rows.groupBy("session_id", "dir").agg(F.count("*").alias("n_files"), F.sum("length").alias("size"))


def expand_folders(files: DataFrame, folders: DataFrame, patterns: list[str] | None = None,
                   max_files: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The files of each published folder, and how many were left out.

    All files unless ``max_files`` asks for the first so many of each folder by path.
    """
    inside = in_folders(files.where(~F.col("is_dir") & X.matches_globs("path", patterns or [])), folders)
    inside = inside.select("session_id", "dir", "path")
    totals = inside.groupBy("session_id", "dir").agg(F.count("*").alias("n_files"))
    kept = inside if max_files is None else first_k(inside, ["session_id", "dir"], "path", max_files)
    over = F.lit(0) if max_files is None else F.greatest(F.col("n_files") - max_files, F.lit(0))
    return kept, totals.select("session_id", "dir", "n_files", over.cast("bigint").alias("n_dropped"))


def leftover_outputs(files: DataFrame, staged: DataFrame) -> DataFrame:
    """Files a task left in its folder (session_id, task_hash, path, is_link): no control
    files, nothing in hidden folders, no links, nothing that was staged in by name."""
    name = X.basename("path")
    own = files.where(~F.startswith(name, F.lit(".command")) & (name != ".exitcode") & ~F.col("is_link")
                      & ~F.col("path").rlike(r"(\A|/)\.[^/]*/")).withColumn("name", name)
    staged_names = staged.select("session_id", "task_hash", X.basename("path").alias("name")).distinct()
    return own.join(staged_names, ["session_id", "task_hash", "name"], "left_anti").drop("name")
