"""Merging two writers' generations: keyed states, catalogue records and nested arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(df: DataFrame, key: str, *order: str | Column) -> DataFrame:
    """One row a key, the greatest by `order`: an aggregate with a map-side part, not a window."""
    rest = [c for c in df.columns if c != key]
    o = [F.col(x) if isinstance(x, str) else x for x in order]
    best = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*o)).alias("__best"))
    return best.select(key, *(F.col(f"__best.{c}").alias(c) for c in rest))


def merge_latest(ours: DataFrame, theirs: DataFrame, key: str, at: str) -> DataFrame:
    """Union of two keyed states; the newer entry wins, ours at a tie."""
    both = ours.withColumn("__ours", F.lit(1)).unionByName(theirs.withColumn("__ours", F.lit(0)))
    return latest(both, key, at, "__ours").drop("__ours")


def merge_earliest(ours: DataFrame, theirs: DataFrame, key: str, at: str) -> DataFrame:
    """Union of two logs of misses; the earliest time stays."""
    return ours.select(key, at).unionByName(theirs.select(key, at)).groupBy(key).agg(F.min(at).alias(at))


def merge_letters(ours: DataFrame, theirs: DataFrame, key: str, letters: str) -> DataFrame:
    """Union of two writers' map columns a key, ours where both have an entry (J6); null maps are empty."""
    o, t = (df.select(key, F.col(letters).alias(name)) for df, name in ((ours, "__o"), (theirs, "__t")))
    kind = ours.schema[letters].dataType
    whole = lambda c: F.coalesce(c, F.create_map().cast(kind))
    return o.join(t, key, "full_outer").select(key, F.map_zip_with(whole("__o"), whole("__t"), lambda _, mine, other: F.coalesce(mine, other)).alias(letters))


def merge_attempts(ours: DataFrame, theirs: DataFrame, key: str, at: str, status: str) -> DataFrame:
    """The later check wins; at a tie ours, but only if it is matched."""
    rank = lambda df, k: df.withColumn("__rank", k)
    both = rank(ours, F.when(F.col(status) == "matched", 2).otherwise(0)).unionByName(rank(theirs, F.lit(1)))
    return latest(both, key, at, "__rank").drop("__rank")


def ordered_union(base: DataFrame, fresh: DataFrame, keys: list[str], item: str, pos: str) -> DataFrame:
    """Rows (keys, item, pos) of two ordered lists a key as one: the base's first, an item once, where it
    stood first; null items go (U1). pos starts at 1 again."""
    both = base.select(*keys, item, pos).withColumn("__src", F.lit(0)).unionByName(fresh.select(*keys, item, pos).withColumn("__src", F.lit(1)))
    first = both.where(F.col(item).isNotNull()).groupBy(*keys, item).agg(F.min(F.struct("__src", pos)).alias("__at"))
    lists = first.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("__at", item))).alias("__l"))
    return lists.select(*keys, F.posexplode("__l").alias("__p", "__e")).select(*keys, F.col(f"__e.{item}").alias(item), (F.col("__p") + 1).alias(pos))


def falsy(c: Column) -> Column:
    """Whether a value counts as missing: null, false, an empty text, or the number zero; the text "0" is none."""
    text = c.cast("string")
    return c.isNull() | (text == "") | ((F.typeof(c) != "string") & text.rlike(r"^(?:false|-?0(?:\.0+)?)\z"))


def filled(mine: Column, other: Column) -> Column:
    """mine, or other where mine is missing."""
    return F.when(falsy(mine), other).otherwise(mine)


def merge_cursors(ours: DataFrame, theirs: DataFrame, key: str) -> DataFrame:
    """Two writers' cursors a key (U7): the farther by pass, letter and page wins, ours at a tie; the later end of a
    pass stays, and so does a finish that only the other has. Missing parts of a cursor count as its start."""
    at = F.struct(F.coalesce("pass", F.lit(1)).alias("pass"), F.coalesce("letter", F.lit("a")).alias("letter"), F.coalesce("page", F.lit(1)).alias("page"))
    side = lambda df, k: df.select(key, F.struct(at.alias("at"), F.lit(k).alias("ours")).alias("__c"), "last_pass_at", "finished_at")
    both = side(ours, 1).unionByName(side(theirs, 0))
    best = both.groupBy(key).agg(F.max("__c").alias("__c"), F.max("last_pass_at").alias("last_pass_at"), F.max_by("finished_at", "__c").alias("__mine"), F.min_by("finished_at", "__c").alias("__other"))
    return best.select(key, "__c.at.*", "last_pass_at", F.coalesce("__mine", "__other").alias("finished_at"))


def category(language: Column, series: Column) -> Column:
    """The category by original language and shape; none without a language (M7)."""
    shape = F.when(series, "series").otherwise("movie")
    return F.when(F.coalesce(language, F.lit("")) == "", None).when(language == "ta", F.concat(F.lit("tamil-"), shape)).otherwise(F.concat(F.lit("tamil-dubbed-"), shape))


def site_category(current: Column, source: Column, site: Column) -> Column:
    """The site's category, unless a better source has set one (M6)."""
    return F.when((source == "tmdb") & current.isNotNull(), current).otherwise(F.coalesce(site, current))
