"""The corpus pipeline: five stages over whole tables, each on what the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, common, decontaminate, neardup, substrings, toxicity

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _crc(text: str = "text"):
    return F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold. Null and empty texts count as clean; null ids,
    repeated rows and null fields stay as they are; an empty table stays empty."""
    lexicon = toxicity.fitted(spark, sf_dir, common.documents(docs))
    return toxicity.reject(docs.select(*COLUMNS), lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, five-word shingles at a similarity of 0.8: the one with the
    least id. Documents without words are in no group and stay; of rows with equal id and text one stays; null ids
    are kept only in groups of null ids alone."""
    kept = neardup.grouped(common.documents(docs)).where("kept").select(F.col("doc_id").alias("__id"), F.col("crc").alias("__crc"))
    rows = docs.select(*COLUMNS, _crc().alias("__of"))
    near = rows.join(kept, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__of") == F.col("__crc")), "left_semi")
    return near.dropDuplicates(["doc_id", "__of"]).select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the passages of 50 words or more that stand elsewhere too, in the same document
    included; n_chars counts what is left. A null text becomes an empty one; documents that lose all stay, empty."""
    cut = substrings.deduplicated(common.documents(docs), {"word": substrings.WORDS}).select("doc_id", "crc", F.col("word_kept").cast("string").alias("text"))
    rest = docs.select(F.col("doc_id").alias("__id"), _crc().alias("__crc"), "lang", "source").dropDuplicates(["__id", "__crc"])
    out = cut.join(rest, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("crc") == F.col("__crc")))
    return out.select("doc_id", "text", "lang", "source", F.length("text").cast("long").alias("n_chars"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts hold none and stay, as do repeated rows;
    items without text are none."""
    return decontaminate.clean(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to, one row a document; a null or empty text
    has no ids."""
    return bpe.round_trip(common.documents(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeats),
    ("decontamination", drop_contaminated),
    ("byte-level BPE", tokenize),
]

#: SQL has neither the fitted lexicon nor the token merges; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
