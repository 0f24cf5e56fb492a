"""The metadata worker's run: a queue of lookups within a budget of time and requests, saved as it goes."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import records
from cairn.operators.schedule import prefix_sum
from cairn.sources import tables
from cairn.sources.scratch import saved


class Limits(NamedTuple):
    """A run's budget, a lookup's time and requests at most, lookups at once, and the time after which a run is saved."""

    budget_ms: int = 300_000
    timeout_ms: int = 45_000
    requests: int = 120
    parallel: int = 4
    save_ms: int = 15_000


def planned(queue: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """What a run reaches of a queue (E6, R7): queue (place from 1 without gaps, id, cost_ms, requests, outage, status, reason)
    with batch, start_ms, save (the number of the save that covers it), and status and reason as the run sees them.

    `parallel` lookups start together and the next ones when all of them are done; a batch starts if there is time left and no
    batch before it met an outage of all keys. A lookup ends at its own limit or the run's, whichever is first, and is then
    unavailable, as is one that needs too many requests. Starts are a prefix sum over the batches' lengths, which no task gathers.
    Null costs and requests count as 0; an empty queue gives an empty run.
    """
    cost, asked = F.coalesce(F.col("cost_ms"), F.lit(0)), F.coalesce(F.col("requests"), F.lit(0))
    q = queue.withColumn("batch", F.floor((F.col("place") - 1) / limits.parallel).cast("long"))
    length = F.max(F.least(cost, F.lit(limits.timeout_ms))).cast("long")
    batches = q.groupBy("batch").agg(length.alias("length"), F.max(F.coalesce("outage", F.lit(False)).cast("int")).cast("long").alias("down"))
    b = prefix_sum(batches, [F.col("batch")], {"ended": "length", "downs": "down"})
    b = b.select("batch", (F.col("ended") - F.col("length")).alias("start_ms"), (F.col("downs") - F.col("down")).alias("__down"))
    b = b.where((F.col("start_ms") < limits.budget_ms) & (F.col("__down") == 0)).drop("__down")
    late = cost > F.least(F.lit(limits.timeout_ms), F.lit(limits.budget_ms) - F.col("start_ms"))
    many = asked > limits.requests
    run = q.join(b, "batch").withColumn("save", F.floor(F.col("start_ms") / limits.save_ms).cast("long"))
    return run.withColumn("reason", F.when(late, "lookup-timeout").when(many, "request-cap").otherwise(F.col("reason"))).withColumn("status", F.when(late | many, "unavailable").otherwise(F.col("status")))


def run_worker(catalogue: DataFrame, attempts: DataFrame, queue: DataFrame, lookup: Callable[[DataFrame], DataFrame], root: str, as_of: Column, limits: Limits = Limits()) -> dict[str, int]:
    """Runs a queue against a catalogue and commits records and attempts together after each save (E6, E7, K2): counters of the run.

    lookup gives, for rows (id, ...) of the planned run, id, replace and meta (see `records.enrich_batch`). A run that was stopped
    goes on: saves that the log holds already are not made again, since each names its number in the table `saves`.
    """
    spark = catalogue.sparkSession
    plan = saved(planned(queue, limits), "plan")
    now = tables.snapshot(spark, root)
    done = {r["save"] for r in now["saves"].collect()} if "saves" in now else set()  # one row a save: budget over save_ms
    if not done:
        now = {"records": catalogue, "attempts": attempts}
    total: dict[str, int] = {"checked": 0, "changed": 0, "matched": 0}
    for k in sorted(r["save"] for r in plan.select("save").distinct().collect()):
        if k in done:
            continue
        part = plan.where(F.col("save") == k)
        found = lookup(part)
        meta = F.when(F.col("status") == "matched", F.col("meta"))
        outcomes = part.select("id", "status", "reason").join(found, "id", "left").select("id", "status", "reason", F.coalesce("replace", F.lit(False)).alias("replace"), meta.alias("meta"))
        applied, entries = records.enrich_batch(now["records"], outcomes, now["attempts"], as_of)
        entries = saved(entries, "entries")
        kept = now["attempts"].join(entries.select("id"), "id", "left_anti").unionByName(entries.drop("changed"), allowMissingColumns=True)
        done.add(k)
        saves = spark.createDataFrame([(s,) for s in sorted(done)], "save bigint")
        tables.commit({"records": applied.drop("changed"), "attempts": kept, "saves": saves}, root)
        now = tables.snapshot(spark, root)
        for r in entries.groupBy("status").agg(F.count("*").alias("n"), F.count_if(F.col("changed")).alias("changed")).collect():  # a row a status
            total["checked"] += r["n"]
            total["changed"] += r["changed"]
            total["matched"] += r["n"] if r["status"] == "matched" else 0
    return total | {"reached": plan.count(), "stopped": int(plan.count() < queue.count())}

