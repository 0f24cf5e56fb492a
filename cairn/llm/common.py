"""What the corpus operators share: input columns, folds, scratch tables, Arrow batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, which parts words everywhere in this package.
WHITE = "\x20\x09-\x0d"


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text, a null text as the empty one; every other column is left behind."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def fold(n: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n; a null id counts as fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % n, F.lit(0))


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that the cluster names in spark.checkpoint.dir. Where it is unset, a
    local session gets a folder of its own; on a cluster it is an error, for executors share no local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cairn-checkpoints-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/cairn-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to the shared folder and read again: later stages start from files, not from lineage.

    The files survive the loss of any executor. They belong to the run; `forget` removes them.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes the files behind stored tables, or selections from them, that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if "/cairn-" in path:
                folder = spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's values as UTF-8 bytes, without decoding them to Python strings."""
    return batch.column(column).cast(pa.binary()).to_pylist()


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def trim() -> None:
    """Gives memory that a Python worker has freed back to the system; workers live longer than tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return
