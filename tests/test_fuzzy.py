"""Similar titles through the index against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import fuzzy


@pytest.mark.parametrize("least", [0.7, 0.84, 0.95])
def test_same_pairs_as_all_pairs(spark, least):
    r = random.Random(7)
    words = ["aayiram", "porkaasukal", "rocky", "chapter", "ii", "two", "3", "vi", "the", "ferry", "of", "amber", "&", "größe", "x"]

    def near(t):
        t = list(t)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(t) + 1)
            t[k : k + r.randrange(2)] = r.choice(["", "a", "z", "é"])
        return "".join(t)

    base = [" ".join(r.choices(words, k=r.randint(1, 5))) for _ in range(40)]
    left, right = base + [near(t) for t in base] + [None, "", "!!"], [near(t) for t in base for _ in range(2)] + [None, ""]
    a, b = (spark.createDataFrame([(t,) for t in x], "title string") for x in (left, right))
    every = a.distinct().select(F.col("title").alias("a")).crossJoin(b.distinct().select(F.col("title").alias("b")))
    every = every.where("a IS NOT NULL AND b IS NOT NULL").where((text.normalise_v2(F.col("a")) != "") & (text.normalise_v2(F.col("b")) != ""))
    want = {(x["a"], x["b"], round(x["s"], 9)) for x in every.withColumn("s", text.title_similarity(F.col("a"), F.col("b"))).where(F.col("s") >= least - 1e-12).collect()}
    got = [(x["a"], x["b"], round(x["similarity"], 9)) for x in fuzzy.similar_titles(a, b, "title", least).collect()]
    assert set(got) == want and len(got) == len(want) > 20


def test_no_all_pairs_join(spark):
    df = spark.createDataFrame([("a title",)], "title string")
    plan = fuzzy.similar_titles(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
