"""Null ids, repeated rows and columns with the operators' own names, in every query."""

import pytest

import corpus_pipeline
from cairn.llm import queries

CLASHING = ("block", "bucket", "run", "anchor", "value", "name", "vertex", "crc", "kept", "pos", "digest", "__slot", "__id", "label", "y")
TEXTS = [(None, "a text without an id " * 30), (None, "a text without an id " * 30), (None, None), (None, ""), (1, "one text with some words in it"), (1, "one text with some words in it"), (2, None), (3, " \t\n"), (4, "ümläut 🙂 " * 50), (-5, "negative id and some more words to read here")]


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    fields = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASHING)
    spark.createDataFrame([(i, t, None, None, None, *["x"] * len(CLASHING)) for i, t in TEXTS], fields).repartition(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(None, None, None, "x"), (1, 1, 0, "x"), (1, 1, 0, "x"), (4, 0, 1, None), (99, 1, 1, "x")], "doc_id bigint, quality int, toxic int, block string").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(None, "one text with some words in it", "x"), (7, None, "x"), (7, "", None), (8, "one text with some words in it", "x")], "item_id bigint, text string, block string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op12_neighbours", "op13_collocations"}))
def test_odd_rows(spark, odd_dir, name):
    got = [r.asDict() for r in queries.QUERIES[name](spark, odd_dir).collect()]
    if name == "op6_decontaminate":
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(1, None), (1, 8)}
        return
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in TEXTS)
    if name == "op5_tokenfiles":
        at = 0
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at
            at += r["n_tokens"]
        assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])][:4] == [None] * 4
    if name == "op10_neardup":
        assert all(r["component_id"] is None for r in got if r["doc_id"] is None)


def test_odd_rows_have_no_phrases(spark, odd_dir):
    """Vectors are in tests of their own; nothing here occurs a hundred times."""
    assert queries.QUERIES["op13_collocations"](spark, odd_dir).collect() == []


def test_odd_rows_through_the_pipeline(spark, odd_dir):
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, odd_dir).collect()}
    assert got == {None, 2, 3, 4, -5}
