"""Runs of crowded anchors are cut finely only where they stay crowded, and anchors are compared many in a batch."""

import random

from cairn.llm import common, substrings


def brute(texts, n):
    seen = {}
    for _, t in texts:
        for i in range(len(t) - n + 1):
            seen[t[i : i + n]] = seen.get(t[i : i + n], 0) + 1
    return {i: "".join(c for k, c in enumerate(t) if not any(seen[t[a : a + n]] > 1 for a in range(max(0, k - n + 1), min(k, len(t) - n) + 1))) for i, t in texts}


def test_crowded_runs_make_few_parts(spark, monkeypatch):
    monkeypatch.setattr(substrings, "GROUP", 8)
    r, n = random.Random(8), substrings.LENGTH[substrings.BYTES]
    some = lambda k: "".join(r.choices("abcdefgh ", k=k))
    line = some(n + 40)
    texts = [(i, some(n + r.randint(0, 50)) + line + some(n)) for i in range(24)]
    made, stored = [], common.stored

    def count(df, name):
        out = stored(df, name)
        if name == "parts":
            made.append(out.count())
        return out

    monkeypatch.setattr(common, "stored", count)
    docs = common.documents(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2))
    got = {x["doc_id"]: bytes(x["byte_kept"]).decode() for x in substrings.deduplicated(docs, {"byte": substrings.BYTES}).collect()}
    assert got == brute(texts, n)
    assert 0 < sum(made) <= 24 * 2 * 25, made


def test_covers_of_two_runs():
    r = random.Random(1)
    some = lambda k: bytes(r.choices(b"ab", k=k))
    for _ in range(300):
        mid, at, n = some(r.randint(4, 20)), 2, r.randint(3, 12)
        sides = [(some(r.randint(0, 4)) + mid[:at], mid[at:] + some(r.randint(0, 4))) for _ in range(2)]
        got = substrings.covers([a for a, _ in sides], [b for _, b in sides], n)
        left = next((k for k in range(min(len(a) for a, _ in sides)) if sides[0][0][-1 - k] != sides[1][0][-1 - k]), min(len(a) for a, _ in sides))
        right = next((k for k in range(min(len(b) for _, b in sides)) if sides[0][1][k] != sides[1][1][k]), min(len(b) for _, b in sides))
        assert got == [(left, right) if left + right >= n else None] * 2
