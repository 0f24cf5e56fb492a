"""Words on bytes, digit-wise selection and resampling, against plain evaluation."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

import __spark_entry__
from cairn.llm import importance, spans

PLAIN = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def small(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_features(text):
    w = PLAIN.findall(small(text))
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


@pytest.mark.parametrize("slab", [8, 40, 1 << 20])
def test_words_are_the_same_however_texts_are_cut(slab, monkeypatch, rows):
    r = random.Random(slab)
    texts = [t or "" for _, t in rows] + ["".join(r.choice("aB9é ._\n\x00") for _ in range(r.randint(0, 90))) for _ in range(200)] + ["a" + " " * 100 + "b", "x" * 300 + " " + "y" * 301 + " z", ""]
    monkeypatch.setattr(spans, "SLAB", slab)
    got = [Counter() for _ in texts]
    for row, bucket, _ in importance.features(pa.array(texts), 1 << 30):
        for i, b in zip(row.tolist(), bucket.tolist()):
            got[i][b] += 1
    assert got == [Counter(zlib.crc32(f.encode()) % (1 << 30) for f in plain_features(t)) for t in texts]


def plain(rows, target, share=25, least=20, seed=7):
    feats = [plain_features(t) for _, t in rows]
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    s, t = Counter(bucket(f) for fs in feats for f in fs), Counter(bucket(f) for x in target for f in plain_features(x))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for (i, text), fs in zip(rows, feats):
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(PLAIN.findall(small(text))), len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    return out, able[: share * len(able) // 100]


def test_resampling_equals_plain_evaluation(spark, sf_dir, rows):
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    out, drawn = plain(rows, target)
    got = importance.op11_resample(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["n_features"], r["weight"], r["score"]) for r in got) == sorted((i, n, w, s) for i, _, n, w, s in out)
    picked = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"] is not None)
    assert picked == [(k + 1, x[0], x[4]) for k, x in enumerate(drawn)]


def test_repeated_rows_null_ids_and_clashing_names(spark):
    r = random.Random(2)
    text = lambda: " ".join(r.choice("alpha beta gamma delta épée x9".split()) for _ in range(25))
    same = text()
    rows = [(k, text()) for k in range(40)] + [(None, text()), (None, same)] + [(7, same)] * 30 + [(90, None), (91, "")]
    docs = spark.createDataFrame([(i, t, 1, "x", 3) for i, t in rows], "doc_id bigint, text string, weight int, score string, rank int")
    out, drawn = plain(rows, ["alpha beta"])
    got = importance.resampled(docs, spark.createDataFrame([("alpha beta",), (None,)], "text string")).collect()
    assert Counter((x["doc_id"], x["n_features"], x["weight"], x["score"]) for x in got) == Counter((i, n, w, s) for i, _, n, w, s in out)
    picked = sorted((x["rank"], x["score"], x["doc_id"]) for x in got if x["rank"] is not None)
    assert picked == [(k + 1, x[4], x[0]) for k, x in enumerate(drawn)]


def test_empty_tables(spark, sf_dir, empty_dir):
    assert importance.op11_resample(spark, empty_dir).collect() == []
    docs, none = (spark.read.parquet(f"{d}/{t}.parquet") for d, t in ((sf_dir, "documents"), (empty_dir, "benchmark")))
    assert importance.resampled(docs, none).where("rank is not null").count() == importance.resampled(docs, none).where("n_words >= 20").count() // 4


@pytest.mark.parametrize("span", [3, 1000, 1 << 62])
def test_kth_key_is_exact(spark, span):
    r = random.Random(span)
    keys = sorted((r.randint(-span, span), r.choice([-(1 << 63), (1 << 63) - 1, r.randint(-9, 9)]), k) for k in range(300))
    df = spark.createDataFrame(keys, "a bigint, b bigint, c bigint")
    for k in (1, 2, 77, 299, 300):
        limit = importance.kth_key(df, ["a", "b", "c"], k)
        assert df.where(importance._at_most(["a", "b", "c"], limit)).count() == k
    assert importance.kth_key(df, ["a", "b", "c"], 0) is None
    got = importance.ranked(df, ["a", "b", "c"]).orderBy("rank").select("a", "b", "c").collect()
    assert [tuple(x) for x in got] == keys


def test_oracle(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()["op11_resample"])
    names = want.columns
    got = __spark_entry__.queries()["op11_resample"](spark, d).select(*names).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)
