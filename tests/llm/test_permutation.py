"""The permutation index against a search of all vectors."""

import numpy as np
import pytest

import __spark_entry__
from cairn.llm import permutation


def plain(rows, k=20, every=20):
    """{query: [(id, score)]} over distinct (id, vector) rows that take part."""
    ok = lambda v: v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
    rows = sorted({(i, tuple(map(float, v))) for i, v in rows if i is not None and ok(v)})
    width = max((len(v) for _, v in rows), default=0)
    ids, x = np.array([i for i, _ in rows], np.int64), np.array([[*v, *[0.0] * (width - len(v))] for _, v in rows])
    out = {}
    for i, v in zip(ids.tolist(), x):
        if i % every == 0:
            s = (x * v).sum(1)
            out[i] = [(int(ids[t]), s[t]) for t in np.lexsort((ids, -s)) if ids[t] != i][:k]
    return out


def answers(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        got = out.setdefault(r["query_id"], [])
        got.append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got)
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in hits}) / len(hits) for q, hits in want.items()])


@pytest.mark.parametrize("name", ["sf0.01", "sf0.1", "check_s"])
def test_recall_on_the_whole_table(spark, name):
    d = f"/root/testdata/{name}"
    want = plain([(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()])
    got = answers(__spark_entry__.queries()["op12_neighbours"](spark, d))
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.93
    scores = {(q, i): s for q, hits in want.items() for i, s in hits}
    for q, hits in got.items():
        assert all(scores.get((q, i), s) == pytest.approx(s, abs=1e-12) for i, s in hits)
        assert [(-s, i) for i, s in hits] == sorted((-s, i) for i, s in hits)


def test_lengths_that_differ_widely(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(9000, 24)) * np.exp(r.normal(size=(9000, 1)) * 1.5)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert recall(answers(permutation.nearest(df, df.where("vec_id % 20 = 0"))), plain(rows)) >= 0.93


def test_copies_ties_nulls_and_clashing_names(spark):
    r = np.random.default_rng(5)
    base = r.integers(-3, 4, (60, 5)).astype(float)
    rows = [(i, base[i % 60].tolist()) for i in range(400)] + [(1000 + i, base[7].tolist()) for i in range(500)]
    rows += [(20, base[20].tolist())] * 5 + [(2000, None), (2020, [0.0] * 5), (2040, [1.0, None, 0.0, 0.0, 0.0]), (2060, [float("nan")] * 5), (2080, [float("inf")] + [1.0] * 4), (2100, []), (None, [1.0] * 5), (2120, [2.0, 1.0]), (-20, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 0.5) for i, v in rows], "vec_id bigint, embedding array<double>, block string, score double")
    assert answers(permutation.nearest(df, df.where("vec_id % 20 = 0"))) == plain(rows)


def test_fewer_than_asked_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 2.0]), (20, [3.0, 1.0])], "vec_id bigint, embedding array<float>")
    assert answers(permutation.nearest(df, df.where("vec_id % 20 = 0"))) == {0: [(20, 3.0), (1, 0.0)], 20: [(0, 3.0), (1, 2.0)]}
    none = df.limit(0)
    assert permutation.nearest(none, none).collect() == [] and permutation.nearest(df, none).collect() == [] and permutation.nearest(none, df).collect() == []
