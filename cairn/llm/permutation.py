"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots: where directions are alike, orders are alike. Vectors are dealt into
bands of like length, for among these the nearest by angle have the largest products, and bands into blocks, each with an inverted file a pivot that lists at which place of its order every vector has the pivot. A
query reads the files of its own nearest pivots only; the places' distances to its own places add up to the footrule distance,
by which the block's vectors are ranked. The best of them are reranked by their true inner products. Equal vectors are one entry.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import common

#: Neighbours a query, pivots (a sample of so many vectors) and how many of them a query's order is compared on.
NEAREST, PIVOTS, COMPARED = 20, 256, 96
#: Of a band of n vectors, RERANKED * sqrt(n) with the least footrule distance are reranked, in each block its share and at
#: least LEAST. Lengths in a band differ by BAND at most.
RERANKED, LEAST, BAND = 10, 64, 1.1
#: Vectors in a block: as many as keep all cores busy, within these bounds; and queries that meet a block in one task.
BLOCK, QUERIES = (4096, 32768), 16384
#: Vectors whose places are looked at together.
_SLAB = 4096


def usable(vector: Column) -> Column:
    """Whether a vector takes part: neither null nor zero, and all components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def entries(vectors: DataFrame, k: int) -> DataFrame:
    """v, ids, band: every distinct vector once, with its k least ids; no more can be among k neighbours. Each task sends at
    most k rows of a vector."""
    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    few = vectors.select("v", "vec_id").distinct().withColumn("__place", place).where(F.col("__place") <= k)
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    band = F.when(length == 0, F.lit(-(10**6))).when(length == float("inf"), F.lit(10**6)).otherwise(F.round(F.log(length) / math.log(BAND)).cast("int"))
    return few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("band", band)


def layout(sizes: dict[int, int], cores: int, reranked: float) -> list[tuple[int, int, int, float]]:
    """(band, its first block, its blocks, the share of a block that is reranked), from the bands' sizes."""
    out, first = [], 0
    for band, n in sorted(sizes.items()):
        parts = max(1, min(cores, -(-n // BLOCK[0])), -(-n // BLOCK[1]))
        out.append((band, first, parts, min(1.0, reranked / math.sqrt(n))))
        first += parts
    return out


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = column.flatten().to_numpy()
    return out


def orders(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Each vector's pivots, the nearest by angle first; ties to the earlier pivot."""
    return np.argsort(-(v @ pivots.T), axis=1, kind="stable").astype(np.int16)


def inverted(order: np.ndarray) -> np.ndarray:
    """Pivot by pivot, the place at which each vector's order has it."""
    files = np.empty(order.shape[::-1], np.int16)
    np.put_along_axis(files, order.T, np.arange(order.shape[1], dtype=np.int16)[:, None], 0)
    return files


def footrule(files: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The footrule distance of all vectors of the files to a query, over the pivots in its order."""
    out, own = np.empty(files.shape[1], np.int32), np.arange(len(order), dtype=np.int16)[:, None]
    for a in range(0, files.shape[1], _SLAB):
        apart = files[order, a : a + _SLAB] - own
        out[a : a + _SLAB] = np.abs(apart, out=apart).sum(0, dtype=np.int32)
    return out


def best(score: np.ndarray, ids: list[list[int]], k: int) -> list[tuple[float, int]]:
    """The first k (score, id), the highest score first and ties to the smaller id; ids are lists in ascending order."""
    first = np.array([x[0] for x in ids], np.int64)
    top = np.lexsort((first, -score))[:k]  # the k-th vector's ids are behind those of the vectors before it
    return sorted(((float(score[t]), i) for t in top.tolist() for i in ids[t]), key=lambda x: (-x[0], x[1]))[:k]


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEAREST, pivots: int = PIVOTS, reranked: float = RERANKED) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows of `vectors` found nearest to each row of `queries`, by inner product in double
    precision, nearest first and ties to the smaller vec_id; all of them, if there are fewer.

    Both have vec_id and embedding (a list of numbers). A row with the query's own vec_id is never its neighbour. Vectors that
    are null, zero or hold null or non-finite components take no part, nor do rows without an id; rows that repeat id and
    vector count once. Shorter vectors are filled up with zeros. Without vectors or queries there are no rows; other columns
    are left behind. Every vector is indexed; the sample of `pivots` vectors only fixes the index's axes.
    """
    spark = vectors.sparkSession
    usable_rows = lambda df: df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows, asking = usable_rows(vectors), usable_rows(queries).distinct()
    found = common.stored(entries(rows, k + 1), "vectors")
    asked = common.stored(asking.groupBy("v").agg(F.min("vec_id").alias("q")), "queries")
    width = max(t.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0] for t in (found, asked))
    plan = layout(dict(found.groupBy("band").count().collect()), int(spark.conf.get("spark.sql.shuffle.partitions")), reranked)
    blocks, crowds = sum(parts for _, _, parts, _ in plan), max(1, -(-asked.count() // QUERIES))
    sample = found.orderBy(F.xxhash64(F.col("ids")[0]), F.col("ids")[0]).limit(pivots).select("v").toArrow()
    axes = matrix(sample.column("v"), width)
    axes /= np.maximum(np.sqrt((axes * axes).sum(1)), 1e-300)[:, None]
    bands = F.broadcast(spark.createDataFrame(plan, "band int, first int, parts int, share double"))  # a row for each band of lengths
    dealt = found.join(bands, "band").select((F.col("first") + F.pmod(F.xxhash64(F.col("ids")[0]), F.col("parts"))).cast("int").alias("block"), "share", "v", "ids")
    held = dealt.select("block", F.explode(F.sequence(F.lit(0), F.lit(crowds - 1))).alias("crowd"), "share", "v", "ids")
    crowd = F.pmod(F.xxhash64("q"), F.lit(crowds)).cast("int").alias("crowd")
    sent = asked.select(F.explode(F.sequence(F.lit(0), F.lit(max(blocks, 1) - 1))).alias("block"), crowd, "q", "v")
    schema = pa.schema([("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            v, ids = matrix(left.column("v"), width), left.column("ids").to_pylist()
            files, q = inverted(orders(v, axes)), matrix(right.column("v"), width)
            own, few = orders(q, axes)[:, :COMPARED], min(len(v), max(LEAST, math.ceil(left.column("share")[0].as_py() * len(v))))
            for name, x, order in zip(right.column("q").to_pylist(), q, own):
                far = footrule(files, order)
                near = np.flatnonzero(far <= np.partition(far, few - 1)[few - 1])  # ties at the end are all reranked
                out += [(name, i, s) for s, i in best((v[near] * x).sum(1), [ids[t] for t in near.tolist()], k + 1)]
            common.trim()
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, schema)], schema=schema)

    hits = sent.groupBy("block", "crowd").cogroup(held.groupBy("block", "crowd")).applyInArrow(lambda a, b: search(b, a), "q bigint, vec_id bigint, score double")
    order = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    top = hits.withColumn("place", order).where(F.col("place") <= k + 1).groupBy("q").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("hits"))
    answers = asked.join(top, "q").select("v", "hits")
    mine = asking.select(F.col("vec_id").alias("query_id"), "v").join(answers, "v")
    others = F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    return mine.select("query_id", F.posexplode(others).alias("place", "hit")).select("query_id", (F.col("place") + 1).cast("int").alias("rank"), "hit.vec_id", "hit.score")


def op12_neighbours(spark, sf_dir: str) -> DataFrame:
    """query_id, rank, vec_id, score: the 20 nearest found among all embeddings for every one whose vec_id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
