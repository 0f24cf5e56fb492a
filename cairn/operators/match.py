"""Identity: upsert matching, twins, unique matches, evidence and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, key: str, pos: str, value: str) -> DataFrame:
    """key, value of the row that stands first."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, pos).alias(value))


def upsert_match(items: DataFrame, stored: DataFrame, id_: str, path: str, pos: str) -> DataFrame:
    """items with `record`, the stored id that an item updates, by id and else by path, and `matched_by`."""
    by_id = stored.select(F.col(id_).alias("__id")).distinct().withColumn("__hit", F.lit(True))
    by_path = first_by(stored, path, pos, id_).select(F.col(path).alias("__path"), F.col(id_).alias("__by_path"))
    out = items.join(by_id, items[id_] == F.col("__id"), "left").join(by_path, items[path] == F.col("__path"), "left")
    record = F.when(F.col("__hit"), F.col("__id")).otherwise(F.col("__by_path"))
    how = F.when(F.col("__hit"), "id").when(F.col("__by_path").isNotNull(), "path").otherwise("new")
    return out.withColumn("record", record).withColumn("matched_by", how).drop("__id", "__hit", "__path", "__by_path")


def twins(episodes: DataFrame, record: str, base: str, season: str, episode: str, least: int = 3) -> DataFrame:
    """Records of one base title that share at least `least` episodes (J4): each with its best twin, the
    earliest at a tie, and how many they share. An equi-join on the episode, not a search of pairs. Episodes are
    dealt by the join's keys before they are made distinct: a task that reads a large file holds none of them."""
    e = episodes.select(record, base, season, episode).repartition(base, season, episode).distinct()
    a, b = (e.select(base, season, episode, F.col(record).alias(f"{record}_{s}")) for s in "ab")
    shared = a.join(b, [base, season, episode]).where(F.col(f"{record}_a") < F.col(f"{record}_b")).groupBy(f"{record}_a", f"{record}_b").agg(F.count("*").alias("shared")).where(F.col("shared") >= least)
    sides = F.explode(F.array(*(F.struct(F.col(f"{record}_{x}").alias(f"{record}_a"), F.col(f"{record}_{y}").alias(f"{record}_b")) for x, y in ("ab", "ba"))))
    shared = shared.select(sides.alias("side"), "shared").select("side.*", "shared")
    best = shared.groupBy(f"{record}_a").agg(F.max_by(F.struct(f"{record}_b", "shared"), F.struct("shared", -F.col(f"{record}_b"))).alias("t"))
    return best.select(F.col(f"{record}_a").alias(record), F.col(f"t.{record}_b").alias("twin"), F.col("t.shared").alias("shared"))


def title_guard(wanted: Column, found: Column) -> Column:
    """Whether the first three words of over three letters all stand in the other title."""
    words = F.slice(F.filter(F.split(wanted, " "), lambda w: F.length(w) > 3), 1, 3)
    return F.forall(words, lambda w: F.contains(found, w))


def override_fault(id_: Column, kind: Column, title: Column, reason: Column, urls: Column) -> Column:
    """Why a reviewed override is refused, null if it is fine."""
    return (
        F.when(F.coalesce(id_, F.lit(0)) < 1, "id")
        .when(~F.coalesce(kind, F.lit("")).isin("movie", "tv"), "type")
        .when(F.coalesce(title, F.lit("")) == "", "title")
        .when(F.coalesce(reason, F.lit("")) == "", "reason")
        .when((F.coalesce(F.size(urls), F.lit(0)) < 1) | F.exists(urls, lambda u: ~u.startswith("https:")), "urls")
    )
