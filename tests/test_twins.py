"""Twins of one base title against all pairs, and where their episodes are held."""

import random

from cairn.operators import match


def test_twins_against_all_pairs(spark):
    r = random.Random(3)
    rows = [(n, r.choice([1, 2, None]), r.randint(0, 1), r.randint(0, 5)) for n in range(30) for _ in range(r.randint(2, 14))]
    rows += rows[:40]
    df = spark.createDataFrame(rows, "record bigint, base bigint, season int, episode int").repartition(3)
    twins = match.twins(df, "record", "base", "season", "episode")
    has = {n: {x[1:] for x in rows if x[0] == n and x[1] is not None} for n in range(30)}
    want = {}
    for a in has:
        found = [(-len(has[a] & has[b]), b) for b in has if a != b and len(has[a] & has[b]) >= 3]
        if found:
            want[a] = min(found)[1], -min(found)[0]
    assert {x["record"]: (x["twin"], x["shared"]) for x in twins.collect()} == want and len(want) > 5


def test_a_task_that_reads_episodes_holds_none(spark):
    """They are dealt by the keys of the join, once; nothing is gathered before."""
    df = spark.createDataFrame([(1, 1, 1, 1)], "record bigint, base bigint, season int, episode int")
    plan = match.twins(df, "record", "base", "season", "episode")._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    reads = [k for k, x in enumerate(lines) if "Scan" in x]
    for k in reads:
        above = []
        for x in reversed(lines[:k]):
            if depth(x) < depth(lines[k]) and "Exchange" in x:
                break
            above.append(x)
        assert reads and not any("Aggregate" in x for x in above), plan
