"""Automata by their definition, and collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

import __spark_entry__
from cairn.llm import collocations, spans


def runs_of(words, joins, depth):
    for end in range(len(words)):
        for d in range(1, depth + 1):
            if d > 1 and not joins[end - d + 2]:
                break
            yield end, tuple(words[end - d + 1 : end + 1])


@pytest.mark.parametrize("seed", range(12))
def test_automaton_states_are_the_classes_of_equal_ends(seed):
    r = random.Random(seed)
    n = r.choice([0, 1, 7, 60, 400])
    codes, joins = np.array([r.randrange(1 + seed % 4) for _ in range(n)], np.int64), np.array([k > 0 and r.random() < 0.9 for k in range(n)], bool)
    again = np.array([r.random() < 0.1 for _ in range(n)], bool)
    starts = np.maximum.accumulate(np.where(joins, 0, np.arange(n))) if n else np.zeros(0, int)
    a = collocations.Automaton(codes, np.arange(n) - starts + 1, again, 5)
    ends, counts = defaultdict(set), Counter()
    for end, run in runs_of(codes.tolist(), joins.tolist(), 5):
        ends[run].add(end)
        counts[run] += not again[end]
    text = lambda node: tuple(codes[a.end[node] - a.length[node] + 1 : a.end[node] + 1].tolist())
    nodes = {text(k): k for k in range(len(a.length))}
    assert set(nodes) == set(ends) and len(nodes) == len(a.length)
    for run, k in nodes.items():
        assert a.count[k] == counts[run]
        assert (a.link[k] == -1) if len(run) == 1 else text(a.link[k]) == run[1:]
        if not again.any():
            assert a.state[k] == (not any(len(x) == len(run) + 1 and x[1:] == run and ends[x] == ends[run] for x in ends))
    got = Counter()
    for end, count, d in a.states():
        for e, c in zip(end.tolist(), count.tolist()):
            got[tuple(codes[e - d + 1 : e + 1].tolist())] += c
    assert got == Counter({run: c for run, c in counts.items() if c})
    assert sum(len(e) for e, _, _ in a.states()) == len(got)


def plain(rows, least, percent, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in ((t, "und" if g is None else g) for t, g in rows):
        small = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", small):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        often = {p: c for p, c in counts.items() if c >= least and len(p) > 1}
        covered = {p[i:j] for p, c in often.items() for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p) and 100 * c >= percent * counts[p[i:j]]}
        scored = []
        for p, a in often.items():
            if p not in covered:
                score, k = min((1000 * a * n[lang] // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out |= {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top])}
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: r.choice("The the of  ferry\t amber é größe x1 　 \x1c copper OF".split(" "))
    make = lambda n: "".join(word() + r.choice([" ", " ", " ", " ", "\t ", ", ", ".", "\n", "!?"]) for _ in range(n))
    rows = [(make(r.randint(0, 80)), r.choice(["en", "de", None, "und", ""])) for _ in range(150)]
    return rows + [("amber ferry of the copper guild " * 30, "en")] * 3 + [(None, "en"), ("", None), (make(9000), "de"), ("x" * 9000 + " y", "en")]


@pytest.mark.parametrize("slab", [64, 8 << 20])
@pytest.mark.parametrize("percent", [100, 60])
def test_collocations_equal_plain_counting(spark, slab, percent, monkeypatch):
    rows = corpus(slab % 7)
    monkeypatch.setattr(collocations, "SHARD", slab)
    docs = spark.createDataFrame([(t, g, 1, "clash") for t, g in rows], "text string, lang string, n int, phrase string").repartition(3)
    got = collocations.collocations(docs, 20, percent, 50).collect()
    assert {tuple(r) for r in got} == plain(rows, 20, percent, 50) and len(got) == len({tuple(r) for r in got})


def test_long_text_is_counted_whole_across_cuts():
    import pyarrow as pa

    r = random.Random(1)
    text = "".join(r.choice("ab") * r.choice([1, 1, 2, 70]) + r.choice([" ", "  ", ". ", " " * 150]) for _ in range(400))
    want = [len(p.split()) for p in re.split("[.]", text)]
    words = [w for w in spans.slabs(pa.array([text]), collocations._CLASSES, 64, 4)]
    assert sum(int((~w.again).sum()) for w in words) == sum(want)


def test_empty_table_and_no_frequent_phrase(spark, sf_dir, empty_dir):
    assert collocations.op13_collocations(spark, empty_dir).collect() == []
    assert collocations.collocations(spark.createDataFrame([("a b", "en")], "text string, lang string")).collect() == []


def test_exact_beyond_64_bits(spark):
    big = 9 * 10**12
    found = spark.createDataFrame([("en", 2, "a b", big)], "lang string, k int, phrase string, n bigint")
    parts = spark.createDataFrame([("en", "a", big), ("en", "b", big + 7)], "lang string, phrase string, n bigint")
    totals = spark.createDataFrame([("en", 10 * big + 1)], "lang string, n bigint")
    assert collocations.cut(found, parts, totals).first()["score"] == 1000 * big * (10 * big + 1) // (big * (big + 7))


def test_oracle(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    want = con.sql(__spark_entry__.oracle_sql()["op13_collocations"])
    got = __spark_entry__.queries()["op13_collocations"](spark, d).select(*want.columns).collect()
    assert len(got) > 20 and sorted(map(tuple, got)) == sorted(want.fetchall())
