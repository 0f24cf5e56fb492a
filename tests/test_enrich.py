"""Enrichment reads its inputs dealt out over tasks and holds names against people once."""

from cairn.operators import resolve
from cairn.plans import titles

SMALL = "/root/testdata/sf0.001"


def test_steps_of_enrichment_share_tables_that_are_dealt_out(spark, monkeypatch):
    asked, credits, titles_of = [], resolve.credits, resolve.year_of
    monkeypatch.setattr(resolve, "credits", lambda named, people: asked.append("credits") or credits(named, people))
    monkeypatch.setattr(resolve, "year_of", lambda date: asked.append("titles") or titles_of(date))
    out = titles.composed_enrichment(spark, SMALL)
    assert asked.count("credits") == 1 and asked.count("titles") == 2  # a film's date and a show's, in one pass
    assert not [f for f in out.inputFiles() if f.endswith("/part.parquet")]


def test_an_index_serves_both_types(spark):
    c = spark.createDataFrame([(1, "movie", "One", "2001-01-01"), (2, "tv", "One", "2001-01-01"), (3, "movie", "Two", ""), (4, "movie", "Two", "1999-01-01")], "id bigint, type string, title string, date string")
    c = c.selectExpr("id", "type", "title", "title AS original_title", "CAST(NULL AS STRING) AS name", "CAST(NULL AS STRING) AS original_name", "date AS release_date", "date AS first_air_date")
    r = spark.createDataFrame([("a", "movie", "ONE", 2001), ("a", "tv", "ONE", 2001), ("b", "movie", "Two", 0), ("c", "movie", "two", 1999), ("d", "tv", "one", None), ("e", "tv", "two", 1999)], "record string, type string, title string, year int")
    got = {tuple(x) for x in resolve.picked(r, resolve.title_index(c)).select("record", "type", "candidate").collect()}
    assert got == {("a", "movie", 1), ("a", "tv", 2), ("c", "movie", 4), ("d", "tv", 2)}
