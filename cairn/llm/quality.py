"""Quality classifier: a sparse ensemble of rules over text statistics.

Shallow trees are grown on labelled rows and every path from a root becomes a rule, a conjunction of
comparisons; a lasso logistic regression over the rules keeps few of them. The kept rules are compiled into
one Spark column expression over the statistics, so scoring is generated code without Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

#: Labelled rows that are learned from, at most; those with the smallest hash of their id are taken.
MAX_TRAIN = 20_000
TREES, DEPTH, LASSO, THRESHOLD = 12, 3, 0.002, 0.3

STATISTICS = ("n_bytes", "n_words", "n_lines", "word_length", "upper", "digits", "symbols", "stops", "bars", "spaces", "high", "distinct_words", "distinct_lines", "ended_lines", "common_word", "odd_tails", "one_letter")
_CLASS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "symbols": b"#$%&*<>@^_~{}[]\\=+!?/", "stops": b".,;:", "bars": b"|", "spaces": b" \t\n\r\x0b\x0c", "high": bytes(range(128, 256)),
}
_MASK = np.array([[ch in chars for ch in range(256)] for chars in _CLASS.values()], np.float64)


def statistics(raw: bytes) -> list[float]:
    """The values of STATISTICS for one whole text; an empty text has zeros throughout."""
    if not raw:
        return [0.0] * len(STATISTICS)
    shares = _MASK @ np.bincount(np.frombuffer(raw, np.uint8), minlength=256) / len(raw)
    words, lines = raw.split(), raw.split(b"\n")
    n, distinct = max(1, len(words)), set(words)
    sample = len(distinct) / n
    most = max((words.count(w) for w in (b"the", b"de", b"der", b"la", b"of", b"und", b"que", b"le")), default=0) / n
    tails = sum(not w[-1:].isalnum() and w[-1] < 128 and w[-1:] not in b".,;:" for w in words) / n
    return [float(len(raw)), float(len(words)), float(len(lines)), (len(raw) - len(words)) / n, *shares, sample, len(set(lines)) / len(lines), sum(x.endswith(b".") for x in lines) / len(lines), most, tails, sum(len(w) == 1 for w in words) / n]


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text, in one pass and without a shuffle."""
    schema = pa.schema([("doc_id", pa.int64()), *((s, pa.float64()) for s in STATISTICS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in common.texts(b)], np.float64).reshape(-1, len(STATISTICS))
            yield common.batch_of(schema, b.column("doc_id"), *(pa.array(c) for c in x.T))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, " + ", ".join(f"{s} double" for s in STATISTICS))


#: A rule: comparisons (statistic, is it at most, threshold), all of which must hold.
Rule = tuple[tuple[str, bool, float], ...]


def paths(tree) -> set[Rule]:
    """The rules of one fitted tree: the conjunction on the way to every node but the root."""
    found: set[Rule] = set()

    def walk(node, way):
        if way:
            found.add(tuple(sorted(way)))
        if node.numDescendants() > 0:
            s = node.split()
            name, at = STATISTICS[s.featureIndex()], float(s.threshold())
            walk(node.leftChild(), [*way, (name, True, at)])
            walk(node.rightChild(), [*way, (name, False, at)])

    walk(tree._call_java("rootNode"), [])
    return found


def holds(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(s) <= t if most else F.col(s) > t for s, most, t in rule])


def compiled(rules: list[tuple[Rule, float]], intercept: float) -> Column:
    """The probability of label 1 as one column expression over the statistics."""
    z = reduce(lambda a, b: a + b, [F.when(holds(r), F.lit(w)).otherwise(F.lit(0.0)) for r, w in rules], F.lit(intercept))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(stats: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, held: int = 0, limit: int = MAX_TRAIN) -> tuple[list[tuple[Rule, float]], float]:
    """Rules with their weights, and the intercept, from labelled rows outside the held-out fold.

    Without labelled rows the score is 0.5 everywhere; with one class it is that class's smoothed share.
    Null labels are left out; of rows of one id the one with the least statistics counts, so that a run gives what the last gave.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).where(F.col("y").isin(0.0, 1.0) & (common.fold(folds) != held))
    y = y.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    train = stats.join(F.broadcast(y), "doc_id").groupBy("doc_id").agg(F.min(F.struct("y", *STATISTICS)).alias("r"))
    rows = train.select("r.*").collect()
    n, ones = len(rows), sum(r["y"] for r in rows)
    if not 0 < ones < n:
        return [], float(np.log((ones + 0.5) / (n - ones + 0.5)))
    spark = stats.sparkSession
    few = spark.createDataFrame(sorted(map(tuple, rows)), "y double, " + ", ".join(f"{s} double" for s in STATISTICS)).coalesce(1)
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="x").transform(few).select("y", "x").persist()
    forest = RandomForestClassifier(featuresCol="x", labelCol="y", numTrees=TREES, maxDepth=DEPTH, seed=11, featureSubsetStrategy="0.5", minInstancesPerNode=max(2, n // 1000)).fit(vectors)
    vectors.unpersist()
    rules = sorted(set().union(*(paths(t) for t in forest.trees)), key=lambda r: (len(r), r))
    flags = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="x").transform(few.select("y", *(holds(r).cast("double").alias(f"r{i}") for i, r in enumerate(rules)))).select("y", "x").persist()
    lasso = LogisticRegression(featuresCol="x", labelCol="y", elasticNetParam=1.0, regParam=LASSO, standardization=False, maxIter=60).fit(flags)
    flags.unpersist()
    w = lasso.coefficients.toArray()
    return [(r, float(v)) for r, v in zip(rules, w) if abs(v) > 1e-6], float(lasso.intercept)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of the whole table, repeated ones too. A null text counts as empty and is
    scored like any other; a null id is held out, since its fold is 0, and is never learned from. Without labels the score is 0.5;
    missing and null labels are left out; other columns are left behind; an empty table gives no rows."""
    stats = common.stored(measured(common.read_documents(spark, sf_dir)), "statistics")
    rules, intercept = fit(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return stats.select("doc_id", (common.fold(5) == 0).alias("held_out"), compiled(rules, intercept).alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
