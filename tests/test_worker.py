"""The worker's run against the loop in order, and runs that are stopped and go on."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import records, worker
from cairn.sources import tables

QUEUE = "place bigint, id string, cost_ms bigint, requests int, outage boolean, status string, reason string"


def loop(rows, limits):
    """The loop, batch by batch."""
    out, now, down = [], 0, False
    for i in range(0, len(rows), limits.parallel):
        if now >= limits.budget_ms or down:
            break
        took = 0
        for r in rows[i : i + limits.parallel]:
            left = min(limits.timeout_ms, limits.budget_ms - now)
            cost = r[2] or 0
            status, reason = (r[5], r[6]) if cost <= left and (r[3] or 0) <= limits.requests else ("unavailable", "lookup-timeout" if cost > left else "request-cap")
            out.append((r[0], r[1], i // limits.parallel, now, status, reason))
            took = max(took, min(cost, limits.timeout_ms))
            down = down or bool(r[4])
        now += took
    return out


@pytest.mark.parametrize("seed", range(4))
def test_plan_equals_the_loop(spark, seed):
    r = random.Random(seed)
    limits = worker.Limits(budget_ms=r.choice([0, 40_000, 400_000, 10**9]), parallel=r.choice([1, 3, 4]))
    rows = [(k + 1, f"r{k}", r.choice([None, 0, r.randrange(9000), 50_000]), r.choice([None, 3, 121]), r.random() < (0.01 if seed % 2 else 0), r.choice(["matched", "review"]), "x") for k in range(r.choice([0, 5, 300]))]
    got = worker.planned(spark.createDataFrame(rows, QUEUE).repartition(4), limits)
    assert sorted(tuple(x) for x in got.select("place", "id", "batch", "start_ms", "status", "reason").collect()) == loop(rows, limits)


def test_a_stopped_run_goes_on(spark, tmp_path, monkeypatch):
    base = {"title": "T", "year": 2020, "embeds": [{"quality": "HD", "url": "u"}], "page_url": "", "poster": "", "rating": 0.0, "tmdb_id": 0, "imdb_id": "", "added_at": "1"}
    ddl = f"id string, title string, year int, kind string, category string, language string, category_source string, page_url string, embeds {records.EMBEDS}, poster string, rating double, tmdb_id bigint, imdb_id string, added_at string, seasons {records.SEASONS}, updated_at string"
    names = [f.split()[0] for f in ddl.replace(records.EMBEDS, "x").replace(records.SEASONS, "x").split(", ")]
    catalogue = spark.createDataFrame([tuple({**base, "id": f"r{k}"}.get(n) for n in names) for k in range(12)], ddl).withColumn("identity", F.col("id"))
    attempts = spark.createDataFrame([("r3", 2, "r3", "unresolved", 1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), "old")], "id string, version int, identity string, status string, attempts int, checked_at timestamp, next_at timestamp, reason string")
    queue = spark.createDataFrame([(k + 1, f"r{k}", 1000 if k != 5 else 60_000, 1, False, "matched" if k % 3 else "review", "exact") for k in range(10)], QUEUE)
    limits = worker.Limits(budget_ms=8000, timeout_ms=3000, parallel=2, save_ms=2000)
    meta = F.struct(F.lit(7).cast("bigint").alias("tmdb_id"), F.lit("movie").alias("tmdb_type"), F.lit("tt").alias("imdb_id"), F.lit("p").alias("poster"), F.lit(5.0).alias("rating"), F.lit("ta").alias("language"), F.lit(False).alias("cross_type"))
    lookup = lambda rows: rows.select("id", F.lit(False).alias("replace"), meta.alias("meta"))
    now = F.lit("2024-02-01").cast("timestamp")
    whole = worker.run_worker(catalogue, attempts, queue, lookup, f"{tmp_path}/a", now, limits)
    commit, calls = tables.commit, []

    def die(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise OSError("killed")
        return commit(*args, **more)

    monkeypatch.setattr(tables, "commit", die)
    with pytest.raises(OSError, match="killed"):
        worker.run_worker(catalogue, attempts, queue, lookup, f"{tmp_path}/b", now, limits)
    monkeypatch.undo()
    again = worker.run_worker(catalogue, attempts, queue, lookup, f"{tmp_path}/b", now, limits)
    rows = lambda root, name: sorted(map(str, tables.snapshot(spark, f"{tmp_path}/{root}")[name].collect()))
    for name in ("records", "attempts", "saves"):
        assert rows("a", name) == rows("b", name)
    assert whole["checked"] > again["checked"] > 0 and whole["reached"] == 10 and not whole["stopped"]
    got = {r["id"]: r for r in tables.snapshot(spark, f"{tmp_path}/a")["attempts"].collect()}
    assert (got["r3"]["status"], got["r3"]["attempts"], got["r5"]["reason"], got["r1"]["status"]) == ("review", 2, "lookup-timeout", "matched")
    kept = {r["id"]: r["tmdb_id"] for r in tables.snapshot(spark, f"{tmp_path}/a")["records"].collect()}
    assert kept["r1"] == 7 and kept["r3"] == 0 and kept["r5"] == 0 and kept["r11"] == 0
