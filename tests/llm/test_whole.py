"""Operators do the whole job, where small inputs would not show that something is left out."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from cairn.llm import common, lm, media


def test_ppm_drops_no_context_of_a_large_trie(spark):
    r = random.Random(3)
    texts = [(i, "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=40_000))) for i in range(16)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    ask = next(i for i in range(100, 200) if held(i))
    passage = texts[0][1][:300] + "".join(r.choices("abcdefghijklmnopqrstuvwxyz ", k=300))
    spelled = lambda t: lm.END * lm.ORDER + lm.spelled(t.encode().split())
    s = spelled(passage)
    wanted = {s[p - o : p] for p in range(lm.ORDER, len(s)) for o in range(lm.ORDER + 1)}
    trie, entries = defaultdict(Counter), set()
    for i, t in texts:
        if not held(i):
            x = spelled(t)
            for p in range(lm.ORDER, len(x)):
                for o in range(lm.ORDER + 1):
                    entries.add(x[p - o : p + 1])
                    if x[p - o : p] in wanted:
                        trie[x[p - o : p]][x[p]] += 1
    assert len(entries) > 1_500_000 and not held(0)

    def log_p(p):
        out, gone = 0.0, set()
        for o in range(lm.ORDER, -1, -1):
            here = trie.get(s[p - o : p])
            if not here:
                continue
            n = sum(c for b, c in here.items() if b not in gone)
            if s[p] in here:
                return out + math.log10((2 * here[s[p]] - 1) / (2 * n))
            q = sum(b not in gone for b in here)
            out += math.log10(q / (2 * n)) if q else -300.0 if n else 0.0
            gone = set(here)
        return out - math.log10(max(1, 256 - len(trie[b""])))

    docs = common.documents(spark.createDataFrame([*texts, (ask, passage)], "doc_id bigint, text string"))
    got = {x["doc_id"]: x["score"] for x in lm.scored(docs).collect()}
    assert got[ask] == pytest.approx(sum(log_p(p) for p in range(lm.ORDER, len(s))), rel=1e-4)


def test_sequences_hold_the_whole_text(spark):
    texts = {1: "word " * 100 + "<b>tail</b> &amp; & end", 2: " " * 300 + "late", 3: "plain\n\ntext", 4: ""}
    docs = common.documents(spark.createDataFrame([*texts.items(), (5, None)], "doc_id bigint, text string"))
    got = {r["doc_id"]: r["sequence"] for r in media.sequences(media.pages_of(docs), key="doc_id").collect()}
    assert set(got) == {1, 2, 3, 4, 5}
    for i, t in texts.items():
        assert " ".join(x["text"] for x in got[i] if x["kind"] == "text").split() == t.split()
        assert [x["pos"] for x in got[i]] == list(range(len(got[i]))) and sum(x["kind"] == "media" for x in got[i]) == 1
    assert [x["pos"] for x in got[2] if x["kind"] == "media"] == [1]
