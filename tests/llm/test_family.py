"""Large families of sets made of common values: all links are found, and what is sent grows as the family."""

import random
from collections import Counter

import numpy as np
import pytest

from cairn.llm import neardup


def family(kind, n, r):
    """n sets of common values: copies of one set with changes, sets with much of their own, or sets put together from parts."""
    base = r.sample(range(1, 1 << 40), 120)
    parts = [r.sample(range(1 << 50, 1 << 51), 15) for _ in range(24)]
    out = []
    for _ in range(n):
        if kind == "copies":
            x = [*r.sample(base, 114), *r.sample(range(1 << 40, 1 << 50), r.choice([0, 4, 9]))]
        elif kind == "own":
            x = [*base[:80], *r.sample(range(1 << 40, 1 << 50), 40)]
        else:
            x = [v for p in r.sample(parts, 8) for v in p]
        out.append(np.unique(np.array(x, np.uint64)))
    return out + ([out[0][:-2], out[0][1:]] if n else [])


def components(n, pairs):
    label = list(range(n))
    for a, b in pairs:
        x, y = label[a], label[b]
        label = [x if v == y else v for v in label]
    return {frozenset(k for k in range(n) if label[k] == v) for v in label}


@pytest.mark.parametrize("kind", ["copies", "own", "parts"])
def test_families_are_joined_whole_at_linear_cost(spark, kind, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 30_000)
    sent = []
    met = neardup._met
    monkeypatch.setattr(neardup, "_met", lambda groups, *rest: sent.append(groups.count()) or met(groups, *rest))
    cost = {}
    for n in (150, 300, 600):
        sets = list({x.tobytes(): x for x in family(kind, n, random.Random(n))}.values())
        names = [k.to_bytes(16, "big") for k in range(len(sets))]
        full = neardup.common.stored(spark.createDataFrame([(v, len(x), bytearray(x.tobytes())) for v, x in zip(names, sets)], "vertex binary, n bigint, whole binary"), "test-full")
        count = Counter(v for x in sets for v in x.tolist())
        lists = spark.createDataFrame([(int(v), w) for w, x in zip(names, sets) for v in x.tolist() if count[v] > neardup.LIST], "value bigint, vertex binary")
        sent.clear()
        got = [(int.from_bytes(r["a"], "big"), int.from_bytes(r["b"], "big")) for r in neardup.core_links(lists, full, 85).collect()]
        want = [(i, j) for i in range(len(sets)) for j in range(i) if neardup.linked(sets[i], sets[j], 85)]
        assert all(neardup.linked(sets[i], sets[j], 85) for i, j in got)
        assert components(len(sets), got) == components(len(sets), want)
        cost[n] = sum(sent)
    if kind != "parts":
        assert cost[600] <= 4.4 * cost[150] and cost[600] <= 5 * 602


def test_sets_are_told_apart_by_128_bits(spark, docs):
    known = neardup.sets(neardup.common.documents(docs), 3, 5)
    assert {len(r["vertex"]) for r in known.where("n > 0").collect()} == {16}
