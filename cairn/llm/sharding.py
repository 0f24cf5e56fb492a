"""Sharding by a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime size; shards take turns,
each claiming the first free slot of its order, until the table is full. A row goes to the shard that owns
slot hash(key) mod size. The table is of constant size, whatever the data, so it is broadcast; placement
is one map-side join without a shuffle, and adding or removing a shard moves few keys.
"""

from __future__ import annotations

import hashlib
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Slots of the table that the query uses: prime, and about 256 a shard.
TABLE_SIZE, SHARDS = 4093, 16


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:12], 16)


def preferences(shard: str, size: int):
    """The shard's order over all slots: offset, offset + skip, ... modulo a prime size visits each once."""
    offset, skip = _number(f"offset/{shard}") % size, _number(f"skip/{shard}") % (size - 1) + 1
    return ((offset + i * skip) % size for i in count())


def lookup_table(shards: list[str], size: int = TABLE_SIZE) -> list[int]:
    """Slot -> index in shards. size must be prime; empty or repeated shards are refused."""
    if not shards or len(set(shards)) != len(shards) or len(shards) > size:
        raise ValueError("shards must be distinct, at least one, and no more than there are slots")
    if size < 2 or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table's size must be prime")
    table, orders, free = [-1] * size, [preferences(s, size) for s in shards], size
    while free:
        for k, order in enumerate(orders):
            table[slot := next(s for s in order if table[s] < 0)] = k
            free -= 1
            if not free:
                break
    return table


def slot_of(key: Column, size: int) -> Column:
    """48 bits of the key's MD5 modulo the size; a null key counts as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 12), 16, 10).cast("long") % size


def place(df: DataFrame, shards: list[str], key: str = "doc_id", size: int = TABLE_SIZE, shard_col: str = "shard") -> DataFrame:
    """df with the name of each row's shard. Rows are neither dropped nor moved; equal keys, repeated rows
    included, share a shard; a column called like shard_col is replaced; an empty df stays empty."""
    spark = df.sparkSession
    slot = "__slot"
    while slot in df.columns:
        slot += "_"
    table = spark.createDataFrame([(i, shards[k]) for i, k in enumerate(lookup_table(shards, size))], T.StructType([T.StructField(slot, T.LongType()), T.StructField(shard_col, T.StringType())]))
    rest = df.drop(shard_col) if shard_col in df.columns and shard_col != key else df
    return rest.withColumn(slot, slot_of(rest[key], size)).join(F.broadcast(table), slot, "left").drop(slot)


def write_sharded(placed: DataFrame, path: str, shard_col: str = "shard", writers: int = 8) -> None:
    """One folder a shard, each written by up to `writers` tasks, so that no shard depends on one task. Rows are
    dealt by a hash of their columns: a task that is run again writes the same rows."""
    part = F.pmod(F.xxhash64(*placed.columns), F.lit(writers)).alias("__w")
    placed.repartition(F.col(shard_col), part).write.partitionBy(shard_col).parquet(path)


def names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:03d}" for i in range(n)]


def op8_sharding(spark, sf_dir: str) -> DataFrame:
    """doc_id, its slot's shard and the text's length for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"))
    return place(docs, names()).select("doc_id", "shard", "n_chars")


def sql() -> str:
    table = ", ".join(map(str, lookup_table(names())))
    return f"""WITH t AS (SELECT [{table}] AS owner)
SELECT doc_id, printf('shard-%03d', owner[1 + CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 12)) AS BIGINT) % {TABLE_SIZE}]) AS shard,
       CAST(coalesce(length(text), 0) AS BIGINT) AS n_chars
FROM documents, t"""
