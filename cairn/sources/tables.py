"""Reading the base tables and JSON states, and publishing versions."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The time at which queries decide what is due: an argument, never the wall clock.
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_json(spark: SparkSession, path: str, schema: T.StructType | str, required: bool = False) -> DataFrame:
    """A whole JSON file by a fixed schema (S1, S2). A missing file is an empty table unless required; a
    file that does not parse fails."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop):
        if required:
            raise FileNotFoundError(path)
        return spark.createDataFrame([], schema)
    df = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    if required and df.isEmpty():
        raise ValueError(f"{path} holds no records")
    return df


def keyed_state(df: DataFrame, column: str, key: str) -> DataFrame:
    """The entries of a map column as rows: a state file's sections become tables (S3)."""
    return df.select(F.explode(F.map_entries(column)).alias("e")).select(F.col("e.key").alias(key), "e.value.*")


class Conflict(RuntimeError):
    """Another writer has committed since the version that a commit was based on."""


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration())


def last_commit(spark: SparkSession, root: str) -> int:
    """The number of the newest commit below root, 0 before the first."""
    log, files = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_log"), _files(spark, root)
    names = [f.getPath().getName() for f in files.listStatus(log)] if files.exists(log) else []
    return max((int(n) for n in names if n.isdigit()), default=0)


def commit(tables: dict[str, DataFrame], root: str, based_on: int | None = None, counters: dict[str, Column] | None = None) -> tuple[int, dict[str, int]]:
    """Publishes several tables at once (K1, K2, I4): (commit's number, counters of what was written).

    Each table goes to a folder of its own; then one file of the log, whose name is the commit's number, names them all. It is
    written aside and renamed, which fails if the number is taken: so readers see all tables of a commit or none, of two writers
    who start from the same commit one meets Conflict, and one that dies at any time before leaves only folders that nothing
    names. Tables that a commit does not name stay as they were. counters (name: aggregate) are observed in the writing of the
    first table itself, without another pass (A6, K6).
    """
    spark = next(iter(tables.values())).sparkSession
    base = last_commit(spark, root) if based_on is None else based_on
    named, seen = _named(spark, root, base), Observation()
    for k, (name, df) in enumerate(tables.items()):
        path = f"{name or 'table'}-{uuid.uuid4().hex}"
        if counters and k == 0:
            df = df.observe(seen, *(c.alias(n) for n, c in counters.items()))
        df.write.parquet(f"{root}/{path}")
        named[name] = path
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    draft, entry = fs_path(f"{root}/_log/.{uuid.uuid4().hex}"), fs_path(f"{root}/_log/{base + 1:012d}")
    out = _files(spark, root).create(draft, True)
    out.write(bytearray(json.dumps(named, sort_keys=True).encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs_path(root).toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(draft, entry, spark._sc._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        _files(spark, root).delete(draft, False)
        if last_commit(spark, root) > base:
            raise Conflict(f"commit {base + 1} of {root} is another writer's") from e
        raise
    return base + 1, dict(seen.get) if counters else {}


def _named(spark: SparkSession, root: str, number: int) -> dict[str, str]:
    return json.loads(spark.read.text(f"{root}/_log/{number:012d}", wholetext=True).first()[0]) if number else {}


def snapshot(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """All tables as one commit names them, the newest unless a number is given; empty before the first."""
    named = _named(spark, root, last_commit(spark, root) if number is None else number)
    return {name: spark.read.parquet(f"{root}/{path}") for name, path in named.items()}


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes the folders below root that none of the last `keep` commits names, and returns their number. Not while others
    write: their folders are not named yet."""
    last = last_commit(spark, root)
    used = {path for k in range(max(1, last - keep + 1), last + 1) for path in _named(spark, root, k).values()}
    files, gone = _files(spark, root), 0
    for f in files.listStatus(spark._jvm.org.apache.hadoop.fs.Path(root)):
        name = f.getPath().getName()
        if name != "_log" and name not in used:
            gone += files.delete(f.getPath(), True)
    return gone


def publish(df: DataFrame, root: str) -> int:
    """Commits a single table on top of whatever is newest (K1): of two writers the later wins, and both versions stay readable."""
    while True:
        try:
            return commit({"": df}, root)[0]
        except Conflict:
            continue


def current(spark: SparkSession, root: str) -> DataFrame | None:
    """The published table, or None before the first commit."""
    return snapshot(spark, root).get("")


def publish_if_changed(df: DataFrame, root: str, flag: str = "changed") -> int | None:
    """Publishes without the flag column if it is true for some row; otherwise writes nothing (K3)."""
    return publish(df.drop(flag), root) if not df.where(flag).isEmpty() else None


CURSOR = "letter string, page int, pass int"


def read_cursor(spark: SparkSession, path: str) -> DataFrame:
    """The one-row cursor of a JSON file, or the start of the first pass."""
    found = read_json(spark, path, CURSOR)
    start = spark.range(1).select(F.lit("a").alias("letter"), F.lit(1).alias("page"), F.lit(1).alias("pass"))
    return start if found.isEmpty() else found.select(F.coalesce("letter", F.lit("a")).alias("letter"), F.coalesce("page", F.lit(1)).alias("page"), F.coalesce("pass", F.lit(1)).alias("pass"))


def write_cursor(cursor: DataFrame, root: str) -> int:
    """Publishes a one-row cursor (K0)."""
    return publish(cursor.coalesce(1), root)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """pos, path, label of a JSON list whose entries are paths or objects with a path and a label."""
    raw = spark.read.text(path, wholetext=True).select(F.posexplode(F.from_json("value", "array<string>")).alias("pos", "e"))
    is_object = F.col("e").startswith("{")
    return raw.select("pos", F.when(is_object, F.get_json_object("e", "$.path")).otherwise(F.col("e")).alias("path"), F.when(is_object, F.get_json_object("e", "$.label")).alias("label")).where("path IS NOT NULL")


def save_all(records: DataFrame, index: DataFrame, state: DataFrame, root: str, counters: dict[str, Column] | None = None) -> tuple[int, dict[str, int]]:
    """Publishes the catalogue, its index and the state in one commit (K2), with counters of the records written (K6)."""
    return commit({"records": records, "index": index, "state": state}, root, counters=counters)


def publish_merged(tables: dict[str, DataFrame], root: str, based_on: int, merge: Callable[[dict[str, DataFrame], dict[str, DataFrame]], dict[str, DataFrame]], tries: int = 3) -> int:
    """Commits tables made from commit `based_on`; if another writer has committed since, merges with what is newest and tries
    again (K4). A writer that dies blocks nobody, for nothing is claimed before the commit itself."""
    spark = next(iter(tables.values())).sparkSession
    for _ in range(tries):
        try:
            return commit(tables, root, based_on)[0]
        except Conflict:
            based_on = last_commit(spark, root)
            tables = merge(tables, snapshot(spark, root, based_on))
    raise Conflict(f"{tries} tries met other writers")
