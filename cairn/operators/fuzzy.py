"""Titles that are nearly the same, found through an index instead of by comparing all pairs.

Two texts within k edits share one of k + 1 pieces of either, moved by k places at most. Every title is cut into as many pieces
as its longest partner may need; others look up what they hold at the places where such a piece can stand. Titles whose numbers
differ are never alike, so numbers are part of the key, which also parts the longest lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.functions.text import normalise_v2, numeral

#: Characters that a title has at least for a match that is not exact, and the least similarity.
SHORT, LEAST = 8, 0.84


def _edits(length: Column, least: float) -> Column:
    """Edits that leave two titles alike, the longer of which has this length."""
    return F.floor((1 - least) * length + F.lit(1e-9)).cast("int")


def _pieces(length: Column, least: float) -> Column:
    """Pieces of a title of this length: one more than the edits to its longest partner."""
    return _edits(F.floor(length / least + 1e-9), least) + 1


def _begin(length: Column, pieces: Column, i: Column) -> Column:
    """Where the i-th piece (from 0) of equal pieces begins, from 0."""
    return F.floor(i * length / pieces).cast("int")


def _keyed(titles: DataFrame, column: str) -> DataFrame:
    t = numeral(normalise_v2(F.col(column)))
    digits = F.regexp_replace(F.regexp_replace(t, "[^0-9]+", " "), "^ | $", "")
    return titles.select(F.col(column).alias("title"), t.alias("t"), digits.alias("digits"), F.length(t).alias("n")).where("t <> ''").distinct()


def similar_titles(left: DataFrame, right: DataFrame, column: str = "title", least: float = LEAST) -> DataFrame:
    """(a, b, similarity) of the titles a of left and b of right whose similarity (`text.title_similarity`) is at least `least`.

    Titles count once each. Those that are equal once normalised meet by equality, however many are; others by the pieces they
    share, and each candidate is confirmed by its edit distance. Empty and null titles are like nothing.
    """
    a, b = _keyed(left, column), _keyed(right, column)
    equal = a.select(F.col("title").alias("a"), "t").join(b.select(F.col("title").alias("b"), "t"), "t").select("a", "b", F.lit(1.0).alias("similarity"))
    forms = lambda df: df.where(F.col("n") >= SHORT).select("t", "digits", "n").distinct()
    n = F.col("n")
    pieces = _pieces(n, least)
    index = forms(b).select("t", "digits", "n", F.posexplode(F.transform(F.sequence(F.lit(0), pieces - 1), lambda i: F.substr("t", _begin(n, pieces, i) + 1, _begin(n, pieces, i + 1) - _begin(n, pieces, i)))).alias("i", "piece"))
    index = index.select(F.col("t").alias("u"), "digits", F.col("n").alias("m"), "i", "piece")
    probe = forms(a).select("t", "digits", "n", F.explode(F.sequence(F.greatest(F.ceil(n * least - 1e-9).cast("int"), F.lit(SHORT)), F.floor(n / least + 1e-9).cast("int"))).alias("m"))
    m, count = F.col("m"), _pieces(F.col("m"), least)
    probe = probe.select("t", "digits", "n", "m", F.explode(F.sequence(F.lit(0), count - 1)).alias("i"), _edits(F.greatest("n", "m"), least).alias("k"), count.alias("count"))
    at, size = _begin(m, F.col("count"), F.col("i")), _begin(m, F.col("count"), F.col("i") + 1) - _begin(m, F.col("count"), F.col("i"))
    low, high = F.greatest(at - F.col("k"), F.lit(0)), F.least(at + F.col("k"), F.col("n") - size)
    probe = probe.withColumn("size", size).withColumn("low", low).withColumn("high", high).where("high >= low")
    probe = probe.select("t", "digits", "m", "i", F.explode(F.array_distinct(F.transform(F.sequence("low", "high"), lambda s: F.substr("t", s + 1, F.col("size"))))).alias("piece"))
    met = probe.join(index, ["digits", "m", "i", "piece"]).where("t <> u").select("t", "u").distinct()
    longer = F.greatest(F.length("t"), F.length("u"))
    near = met.withColumn("similarity", 1 - F.levenshtein("t", "u") / longer).where(F.col("similarity") >= least - 1e-12)
    names = lambda df, form, name: df.select(F.col("t").alias(form), F.col("title").alias(name))
    found = near.join(names(a, "t", "a"), "t").join(names(b, "u", "b"), "u").select("a", "b", "similarity")
    return equal.unionByName(found)
