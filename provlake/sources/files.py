"""Listings, sizes, digests and launch scripts of files."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The staging function of a launch script and the launch line of its image.
STAGE_FUNCTION = "nxf_stage"
LAUNCH_IMAGE = r"(?:docker|podman) run .*?\s(\S+)\s+/bin/(?:bash|sh)"
#: The largest content a row can hold; larger files are read in pieces.
ROW_BYTES = (1 << 31) - 1024


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of every file below a folder; the content column is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")


def checksums(spark: SparkSession, path: str, row_bytes: int = ROW_BYTES) -> DataFrame:
    """(path, md5) of every file: inside the JVM where a file fits a row, else read as a stream."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    small = files.where(F.col("length") <= row_bytes).select("path", F.md5("content").alias("md5"))
    return small.unionByName(stream_checksums(files.where(F.col("length") > row_bytes).select("path")))


def stream_checksums(paths: DataFrame, column: str = "path") -> DataFrame:
    """(path, md5) by reading each file once in pieces, through pyarrow's file systems; null when
    a file cannot be read."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                try:
                    store, own = fs.FileSystem.from_uri(re.sub(r"\Afile:/*", "file:///", path))
                    found = hashlib.md5()
                    with store.open_input_stream(own, compression=None) as f:
                        while piece := f.read(1 << 20):
                            found.update(piece)
                    out.append(found.hexdigest())
                except OSError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["path", "md5"])
    return paths.select(F.col(column).alias("path")).distinct().mapInArrow(digest, "path string, md5 string")


def read_traces(spark: SparkSession, path: str) -> DataFrame:
    """Rows of the newest execution trace (tab-separated with header) of each folder."""
    rows = spark.read.csv(path, sep="\t", header=True, recursiveFileLookup=True).withColumn("file", F.col("_metadata.file_path"))
    rows = rows.withColumn("folder", F.regexp_replace("file", "/[^/]*$", ""))
    newest = rows.groupBy("folder").agg(F.max("file").alias("file"))
    return rows.join(newest, ["folder", "file"], "left_semi").drop("file")


def read_scripts(spark: SparkSession, path: str) -> DataFrame:
    """(path, body) of launch scripts."""
    return spark.read.text(path, wholetext=True, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def shell_words(clause) -> Column:
    """Words of a shell clause with its quoting resolved; empty when a quote stays open.

    A word is a run of plain characters, escapes and quoted parts; inside double quotes a
    backslash escapes only a quote or a backslash.
    """
    c = F.col(clause) if isinstance(clause, str) else clause
    part = r"""(?:[^\s'"\\]|\\(?s:.)|'[^']*+'|"(?:[^"\\]|\\(?s:.))*+")"""
    found = F.regexp_extract_all(c, F.lit(f"({part}++)"), F.lit(1))
    first = lambda p: F.substring(p, 1, 1)
    inner = lambda p: F.substr(p, F.lit(2), F.length(p) - 2)
    plain = lambda p: F.when(first(p) == "'", inner(p)).when(first(p) == '"', F.regexp_replace(inner(p), r'\\(["\\])', "$1")) \
        .when(first(p) == "\\", F.substr(p, F.lit(2), F.length(p))).otherwise(p)
    words = F.transform(found, lambda w: F.array_join(F.transform(F.regexp_extract_all(w, F.lit(f"({part})"), F.lit(1)), plain), ""))
    return F.when(c.rlike(rf"\A(?:\s|{part})*+\z"), words).otherwise(F.array().cast("array<string>"))


def staged_sources(scripts: DataFrame, function: str = STAGE_FUNCTION) -> DataFrame:
    """(path, source): absolute files a launch script links or copies into its task folder.
    """
    block = F.regexp_extract("body", rf"(?ms)^{function}\(\) \{{\n(.*?)^\}}", 1)
    lines = scripts.select("path", F.explode(F.split(block, "\n")).alias("line"))
    clauses = lines.select("path", F.explode(F.split("line", "&&")).alias("clause")).withColumn(
        "clause", F.trim("clause")).where(F.col("clause").rlike(r"\A(ln|cp)\s"))
    w = clauses.select("path", shell_words("clause").alias("w"))
    source = F.when((F.get("w", F.lit(0)) == "ln") & (F.size("w") >= 4) & (F.get("w", F.lit(1)) == "-s"), F.get("w", F.lit(2))) \
        .when((F.get("w", F.lit(0)) == "cp") & (F.size("w") >= 3), F.try_element_at("w", F.lit(-2)))
    return w.select("path", source.alias("source")).where(F.startswith("source", F.lit("/")))


def launched_image(body):
    c = F.col(body) if isinstance(body, str) else body
    return F.nullif(F.regexp_extract(c, LAUNCH_IMAGE, 1), F.lit(""))
