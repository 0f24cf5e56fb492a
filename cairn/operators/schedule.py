"""What is due: verdicts, retry delays, eligibility and weighted lanes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import make_id, path_key
from cairn.sources.scratch import saved

# Hours until the next try by status and number of attempts, the last for all later ones.
RETRY_HOURS = {"matched": (720,), "unavailable": (1, 6, 24), "review": (168, 720), "unresolved": (6, 24, 72, 168)}
# The lanes' weights; a cycle takes as many of each.
LANES = (3, 3, 1)


def failure_hours(failures: Column) -> Column:
    """Hours until an item that failed is walked again: 1.5 doubled for each failure, at most 24."""
    return F.when(failures > 0, F.least(F.lit(24.0), 1.5 * F.pow(F.lit(2.0), F.least(failures, F.lit(4))))).otherwise(F.lit(0.0))


def attempt_hours(status: Column, attempts: Column) -> Column:
    """Hours until the next attempt (M8)."""
    out = F.when(F.lit(False), 0)
    for name, hours in RETRY_HOURS.items():
        ladder = F.array(*map(F.lit, hours))
        out = out.when(status == name, F.element_at(ladder, F.greatest(F.least(attempts, F.lit(len(hours))), F.lit(1)).cast("int")))
    return out


def due(current: Column, next_at: Column, checked_at: Column, as_of: Column, stale_days: int = 0, force: Column | None = None) -> Column:
    """Whether a record is to be asked for again (F8): forced, of another version, stale, or its time is up."""
    out = ~F.coalesce(current, F.lit(False)) | F.coalesce(next_at <= as_of, F.lit(True))
    if stale_days:
        out = out | F.coalesce(checked_at <= as_of - F.expr(f"INTERVAL {stale_days} DAYS"), F.lit(True))
    return out if force is None else force | out


class Rules(NamedTuple):
    """What a run walks: windows in hours, days after which a stored movie is walked again (0: never), the version
    of the walker, and whether it is a sweep of pages found empty, or of nothing else."""

    empty_hours: float = 24
    refresh_hours: float = 24
    refresh_days: int = 0
    version: int = 2
    sweep_empty: bool = False
    only_empty: bool = False


# The presets of the four kinds of run.
PRESETS = {"releases": Rules(24, 24), "az": Rules(168, 168), "dubbed": Rules(24, 24), "enrich": Rules(0, 0)}


def verdicts(items: DataFrame, records: DataFrame, state: DataFrame, as_of: Column, rules: Rules = Rules()) -> DataFrame:
    """items with `walk` and `why` (V1, R3, R6, R9), by two joins and one ordered rule.

    items: url, path, title, year. records: pos, id, kind, page_url, embeds; of one path the last counts (J1), and
    an id may tell the kind of what was stored under another path (J15). state: url, at, embeds, kind, empty, v,
    failures, retry_after (J2). A page that could not be read is tried again soon; one read and empty, later; a
    verdict of an older walker at once. A stored series is walked again when its window has passed.
    """
    stored = records.groupBy(path_key(F.col("page_url")).alias("path")).agg(F.max_by(F.struct((F.size("embeds") > 0).alias("has"), F.coalesce("kind", F.lit("movie")).alias("kind")), "pos").alias("s"))
    by_id = records.groupBy(F.col("id").alias("own_id")).agg(F.min_by(F.coalesce("kind", F.lit("movie")), "pos").alias("id_kind"))
    df = items.withColumn("own_id", make_id(F.col("title"), F.col("year"))).join(stored, "path", "left").join(by_id, "own_id", "left")
    df = df.join(state.select("url", F.struct("at", "embeds", "kind", "empty", "v", "failures", "retry_after").alias("e")), "url", "left")
    hours = lambda h: F.expr(f"INTERVAL {round(h * 3600)} SECONDS")
    has, walked = F.coalesce("s.has", F.lit(False)), F.coalesce("e.embeds", F.lit(0)) > 0
    empty, failures = F.coalesce("e.empty", F.lit(False)), F.coalesce("e.failures", F.lit(0))
    old = F.coalesce("e.v", F.lit(0)) < rules.version
    kind = F.coalesce("e.kind", "id_kind")
    series_due = F.col("e.at").isNull() | (as_of >= F.col("e.at") + hours(rules.refresh_hours))
    window = F.when(failures > 0, F.make_dt_interval(mins=(failure_hours(failures) * 60).cast("int"))).otherwise(F.make_dt_interval(mins=F.lit(round(rules.empty_hours * 60))))
    waits = as_of < F.greatest(F.coalesce("e.at", F.timestamp_micros(F.lit(0))) + window, F.coalesce("e.retry_after", F.timestamp_micros(F.lit(0))))
    walk, skip = (lambda why: F.struct(F.lit(True).alias("walk"), F.lit(why).alias("why"))), (lambda why: F.struct(F.lit(False).alias("walk"), F.lit(why).alias("why")))
    if rules.sweep_empty:
        rule = F.when(has, skip("stored")).when(walked & ~kind.eqNullSafe("series"), skip("stored (another path)")).when(walked, walk("series refresh")).when(empty & old, walk("empty from the old walker")).when(empty, walk("empty-page sweep")).otherwise(skip("not a tracked-empty page"))
    else:
        rule = F.when(F.lit(rules.only_empty) & ~empty, skip("not a tracked-empty page"))
        series = has & (F.col("s.kind") == "series") & F.lit(rules.refresh_hours > 0)
        rule = rule.when(series & series_due, walk("series refresh")).when(series, skip("series fresh"))
        if rules.refresh_days:
            rule = rule.when(has & (F.col("e.at").isNull() | (as_of > F.col("e.at") + F.expr(f"INTERVAL {rules.refresh_days} DAYS"))), walk("movie refresh"))
        rule = rule.when(has, skip("stored")).when(walked & ~kind.eqNullSafe("series"), skip("stored (another path)"))
        rule = rule.when(walked & (F.lit(not rules.refresh_hours) | series_due), walk("series refresh")).when(walked, skip("series fresh"))
        rule = rule.when(empty & old, walk("newer walker")).when(empty & waits & (failures > 0), skip("failed")).when(empty & waits, skip("empty")).otherwise(walk("new or due"))
    return df.withColumn("__v", rule).select(*items.columns, "__v.walk", "__v.why")


def after_walk(previous: str, embeds: Column, kind: Column, read: Column, as_of: Column, version: int) -> Column:
    """The state entry after a walk (R2): links and kind; or empty, how often in a row a page could not be read, and
    when it may be tried again: 90 minutes doubled for each failure, at most a day."""
    failures = F.when(read, 0).otherwise(F.coalesce(F.col(f"{previous}.failures"), F.lit(0)) + 1).cast("int")
    retries = F.when(embeds > 0, 0).otherwise(F.coalesce(F.col(f"{previous}.retries"), F.lit(0)) + 1).cast("int")
    minutes = F.least(F.lit(1440.0), 90 * F.pow(F.lit(2.0), F.least(failures - 1, F.lit(4))))
    again = F.when(failures > 0, as_of + F.make_dt_interval(mins=minutes.cast("int")))
    return F.struct(as_of.alias("at"), embeds.cast("int").alias("embeds"), kind.alias("kind"), (embeds == 0).alias("empty"), retries.alias("retries"), failures.alias("failures"), again.alias("retry_after"), F.lit(version).alias("v"))


def lanes(df: DataFrame, lane: str, order: list[Column], limit: int = 0, weights: tuple[int, ...] = LANES) -> DataFrame:
    """df interleaved by lanes, `weights` of each a cycle, with `place` from 1; an empty lane costs nothing.

    The place of a row needs no loop: the cycle of a lane's k-th row is (k - 1) div weight. With a limit, each lane
    is first cut to its `limit` best rows by a distributed top-k, so no task sorts a lane; without one, rows are
    ordered by range partitions and numbered from the partitions' sizes (0 means no limit, O6).
    """
    w = F.element_at(F.array(*map(F.lit, weights)), F.col(lane).cast("int") + 1)
    if limit:
        best = [df.where(F.col(lane) == k).orderBy(*order).limit(limit) for k in range(len(weights))]
        cut = best[0]
        for part in best[1:]:
            cut = cut.unionByName(part)
        n = F.row_number().over(Window.partitionBy(lane).orderBy(*order))
        out = cut.withColumn("__n", n).withColumn("__c", F.floor((F.col("__n") - 1) / w)).orderBy("__c", lane, "__n").limit(limit)
        return out.withColumn("place", F.row_number().over(Window.orderBy("__c", lane, "__n"))).drop("__n", "__c")
    numbered = ranked(df, [F.col(lane), *order], "__all")
    first = numbered.groupBy(lane).agg((F.min("__all") - 1).alias("__first"))
    numbered = numbered.join(F.broadcast(first), lane).withColumn("__n", F.col("__all") - F.col("__first")).withColumn("__c", F.floor((F.col("__n") - 1) / w))
    return ranked(numbered, [F.col("__c"), F.col(lane), F.col("__n")], "place").drop("__n", "__c", "__all", "__first")


def prefix_sum(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """df with running sums in a total order (name: column of whole numbers without nulls), without gathering it: range partitions
    are written once, each is summed apart, and the sums of those before are added, one row a partition."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    parts = saved(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), "ranges")
    sizes = parts.groupBy("__part").agg(*(F.sum(c).alias(f"__{k}") for k, c in sums.items()))
    earlier = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("__part", *(F.coalesce(F.sum(f"__{k}").over(earlier), F.lit(0)).alias(f"__{k}") for k in sums))
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = parts.join(F.broadcast(before), "__part")
    return out.select(*df.columns, *((F.sum(c).over(inside) + F.col(f"__{k}")).alias(k) for k, c in sums.items()))


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with each row's place from 1 in a total order, without gathering it."""
    one = "__one"
    return prefix_sum(df.withColumn(one, F.lit(1)), order, {name: one}).drop(one)
