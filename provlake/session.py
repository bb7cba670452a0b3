"""Session helpers: where cut lineage is written, and how."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Of the graph tables that are written and read back: identifiers are long texts.
COMPRESSION = "zstd"
_LOCAL_ROOTS: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a cluster a
    missing setting is an error, because a machine-local folder is gone with its machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="provlake-")
    return _LOCAL_ROOTS[app]


def workspace(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared one, for the rounds of one loop."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, **options: str) -> DataFrame:
    """Write a table and read it back: lineage ends here and survives lost executors.

    Unlike an eager reliable checkpoint this computes the input once, and the copy stays
    columnar, so later joins read only the columns they need.
    """
    with shuffles_dropped(df.sparkSession):
        df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut(df: DataFrame, label: str) -> DataFrame:
    return save(df, workspace(df.sparkSession, label))


def cut_packed(df: DataFrame, label: str) -> DataFrame:
    """``cut`` for tables of long identifiers."""
    return save(df, workspace(df.sparkSession, label), compression=COMPRESSION)


@contextmanager
def _set(spark: SparkSession, key: str, value: str, unset: str) -> Iterator[None]:
    before = spark.conf.get(key, unset)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shuffles_dropped(spark: SparkSession):
    """Jobs inside drop their shuffle files at their end, not when the driver next collects garbage.

    Only for what is written and read back: nothing asks for those shuffles again.
    """
    return _set(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true", "false")


def shuffled_in(spark: SparkSession, n: int):
    """Jobs inside shuffle into ``n`` partitions, as many as the bucketed tables they join have."""
    return _set(spark, "spark.sql.shuffle.partitions", str(n), "200")


def short_methods(spark: SparkSession):
    """Plan the jobs inside with generated methods the JVM is willing to compile.

    The JVM never compiles a method above 8000 bytes of bytecode; a projection of many
    pattern tests is larger as one stage and three times faster when it is not fused.
    """
    return _set(spark, "spark.sql.codegen.hugeMethodLimit", "8000", "65535")
