"""Every catalogue query holds the rows that DuckDB computes from its SQL on the smallest tables."""

import decimal
import math
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

from cairn.plans import catalogue, state, titles
from cairn.streaming import replay

SMALL = Path("/root/testdata/sf0.001")
QUERIES = state.QUERIES | catalogue.QUERIES | titles.QUERIES | replay.QUERIES
SQL = state.SQL | catalogue.SQL | titles.SQL | replay.SQL


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return tuple((k, plain(x)) for k, x in v.items()) if isinstance(v, dict) else v


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for p in SMALL.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_duckdb(spark, duck, name):
    df = QUERIES[name](spark, str(SMALL))
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(repr([plain(dict(zip(columns, r))[c]) for c in sorted(columns)]) for r in found.fetchall())
    got = sorted(repr([plain(r[c]) for c in sorted(columns)]) for r in (x.asDict(recursive=True) for x in df.collect()))
    assert got == want


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0


def test_entry_module_works_without_the_corpus_operators():
    code = "import sys; sys.modules['cairn.llm'] = None; import __spark_entry__ as e; assert len(e.queries()) == len(e.oracle_sql()) >= 75; assert 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).parent.parent, timeout=120)


@pytest.mark.parametrize("name", ["merge_states", "merge_generations", "nest_regroup", "title_similarity", "page_anchors"])
def test_empty_tables_give_no_rows(spark, tmp_path, name):
    for p in SMALL.glob("*.parquet"):
        spark.read.parquet(str(p)).limit(0).write.parquet(f"{tmp_path}/{p.name}")
    assert QUERIES[name](spark, str(tmp_path)).count() == 0


def test_lines_are_dealt_once(spark):
    df = catalogue._nested(catalogue._lines(spark, str(SMALL), 0))
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    dealt = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
    assert df.count() > 0 and dealt and all("l_orderkey" in x for x in dealt)
    assert plan.count("Exchange hashpartitioning") + plan.count("ReusedExchange") == 2
