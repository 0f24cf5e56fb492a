"""Folders for what a job writes and reads again: in the shared folder that the cluster names, never on one machine."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark, name: str) -> str:
    """A new path in the shared folder of the cluster; a local session without one gets its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cairn-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/stream-{name}-{uuid.uuid4().hex}"


@contextmanager
def _shuffles_end(spark: SparkSession) -> Iterator[None]:
    """What runs within gives its shuffle files back when it ends; else they stay until the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """df, written and read again: what follows starts from files, which survive the loss of any executor."""
    spark = df.sparkSession
    path = folder(spark, name)
    with _shuffles_end(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes the files of tables that `saved` returned and nothing reads any more; other tables, and selections from saved ones, stay."""
    for df in tables:
        path = vars(df).get("_saved_at")
        if path is not None:
            folder_ = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            folder_.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder_, True)
