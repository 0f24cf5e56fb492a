"""Filing items whole against a plain fold in order, on random batches."""

import copy
import random
import re

import pytest
from pyspark.sql import functions as F

from cairn.operators import records, upsert

RANK = {"1080p": 0, "720p": 1, "480p": 2, "360p": 3}
FIELDS = "id string, title string, year int, kind string, category string, language string, category_source string, page_url string, embeds " + records.EMBEDS + ", poster string, rating double, tmdb_id bigint, imdb_id string, added_at string, seasons " + records.SEASONS + ", updated_at string, pos bigint"


def slug(title, year):
    return re.sub("[^a-z0-9]+", "-", title.lower()).strip("-") + (f"-{year}" if year else "")


def base_of(title):
    t = re.sub(r"\b(season|part|vol|volume)\s*\d+\b", " ", title.lower())
    return re.sub("[^a-z0-9]+", " ", re.sub(r"\b(19|20)\d{2}\b", " ", t)).strip()


def union(have, fresh):
    seen, out = {e["url"] for e in have}, list(have)
    for e in fresh:
        if e["url"] and e["url"] not in seen:
            seen.add(e["url"])
            out.append(e)
    return out


def merge(have, fresh):
    table = {s["season"]: {e["episode"]: list(e["embeds"]) for e in s["episodes"]} for s in have}
    for s in fresh:
        eps = table.setdefault(s["season"], {})
        for e in s["episodes"]:
            eps[e["episode"]] = sorted(union(eps[e["episode"]], e["embeds"]), key=lambda x: RANK.get(x["quality"], 4)) if e["episode"] in eps else list(e["embeds"])
    return [{"season": s, "episodes": [{"episode": e, "embeds": x} for e, x in sorted(eps.items())]} for s, eps in sorted(table.items())]


def flat(seasons):
    return [x for s in seasons for e in s["episodes"] for x in e["embeds"]]


def numbers(r):
    return {(s["season"], e["episode"]) for s in r["seasons"] or () for e in s["episodes"]}


def fold(stored, items, now):
    """The rules in order, item by item."""
    vault, log = copy.deepcopy(stored), []
    path = lambda url: re.sub("/+$", "", re.sub("^https?://[^/]*", "", url)) + "/"
    shape = lambda r: "series" if r["kind"] == "series" else "movie"
    for it in sorted(items, key=lambda x: x["pos"]):
        series = it["kind"] == "series"
        embeds = flat(it["seasons"] or []) if series else it["embeds"] or []
        if not embeds:
            log.append((it["pos"], None, "unchanged", "", 0))
            continue
        title, note, name = it["title"], "", slug(it["title"], it["year"])
        hit = next((m for m in vault if m["id"] == name), None) or next((m for m in vault if path(m["page_url"]) == path(it["url"])), None)
        if hit is None and series and base_of(title) and len(numbers(it)) >= 3:
            shared = [(len(numbers(it) & numbers(m)), -k) for k, m in enumerate(vault) if m["kind"] == "series" and base_of(m["title"]) == base_of(title)]
            if shared and max(shared)[0] >= 3:
                hit = vault[-max(shared)[1]]
        if hit is not None and shape(hit) != shape(it):
            title = f"{title} Season {it['seasons'][0]['season'] or 1}" if series else f"{title} Movie"
            name = slug(title, it["year"])
            other, hit = shape(hit), next((m for m in vault if m["id"] == name), None)
            note = "" if hit else f'kept the stored {other} · filed as "{title}"'
        if hit is None:
            vault.append({**dict.fromkeys(records.COLUMNS), "id": name, "title": title, "year": it["year"] or 0, "kind": "series" if series else None, "page_url": it["url"], "embeds": list(embeds), "poster": it["poster"] or "", "rating": 0.0, "tmdb_id": 0, "imdb_id": "", "added_at": now, "seasons": copy.deepcopy(it["seasons"]) if series else None})
            log.append((it["pos"], name, "added", note, len([1 for s in it["seasons"] or () for _ in s["episodes"]])))
            continue
        before, had = copy.deepcopy((hit["embeds"], hit["seasons"] or None, hit["poster"])), len([1 for s in hit["seasons"] or () for _ in s["episodes"]])
        hit["embeds"] = union(hit["embeds"], embeds)
        if series:
            hit["kind"], hit["seasons"] = "series", merge(hit["seasons"] or [], it["seasons"])
            hit["embeds"] = flat(hit["seasons"])
        hit["poster"] = hit["poster"] or it["poster"] or ""
        hit["year"] = hit["year"] or it["year"] or 0
        changed = before != (hit["embeds"], hit["seasons"] or None, hit["poster"])
        if changed:
            hit["updated_at"] = now
        log.append((it["pos"], hit["id"], "merged" if changed else "unchanged", "", len([1 for s in hit["seasons"] or () for _ in s["episodes"]]) - had))
    return vault, log


def random_batch(seed):
    r = random.Random(seed)
    names = ["Alpha", "Beta Season 1", "beta season 2", "Beta 2021", "Gamma", "Gamma Movie", "Delta Season 1", "Delta", "Delta Season 1 Season 1"]

    def embeds(n=4):
        return [{"quality": r.choice(["1080p", "720p", "HD", "360p"]), "url": r.choice(["", *(f"u{k}" for k in range(12))]) if n == 9 else f"u{r.randrange(12)}"} for _ in range(r.randrange(n))]

    def seasons():
        return [{"season": s, "episodes": [{"episode": e, "embeds": embeds()} for e in sorted(r.sample(range(6), r.randrange(1, 6)))]} for s in sorted(r.sample(range(3), r.randrange(1, 3)))]

    stored, taken = [], set()
    for k in range(r.randrange(0, 8)):
        title, year, series = r.choice(names), r.choice([0, 2020, 2021]), r.random() < 0.6
        if slug(title, year) in taken:
            continue
        taken.add(slug(title, year))
        ss = seasons() if series else None
        links = flat(ss) if series and r.random() < 0.8 else embeds()
        stored.append({**dict.fromkeys(records.COLUMNS), "id": slug(title, year), "title": title, "year": r.choice([year, 0]), "kind": "series" if series else None, "page_url": f"https://h/{r.choice('abcdefgh')}{k % 3}/", "embeds": links, "poster": r.choice(["", "p"]), "rating": 1.0, "tmdb_id": 5, "imdb_id": "t", "added_at": "1", "seasons": ss, "pos": k})
    items = []
    for k in range(r.randrange(1, 14)):
        series = r.random() < 0.6
        items.append({"pos": k * 3, "url": f"http://x/{r.choice('abcdefgh')}{r.randrange(3)}", "title": r.choice(names), "year": r.choice([0, 2020, 2021]), "kind": "series" if series else r.choice([None, "movie"]), "embeds": None if series else embeds(9), "seasons": seasons() if series else None, "poster": r.choice(["", None, "q"])})
    return stored, items


def run(spark, stored, items):
    s = spark.createDataFrame([tuple(x.get(c) for c in (*records.COLUMNS, "pos")) for x in stored], FIELDS)
    it = spark.createDataFrame([tuple(x[c] for c in ("pos", "url", "title", "year", "kind", "embeds", "seasons", "poster")) for x in items], "pos bigint, url string, title string, year int, kind string, embeds " + records.EMBEDS + ", seasons " + records.SEASONS + ", poster string")
    catalogue, log = upsert.upsert(s, it, F.lit("2"))
    return [x.asDict(True) for x in catalogue.orderBy("place").collect()], log.orderBy("pos").collect()


def test_batches_equal_a_fold_in_order(spark):
    """Many batches at once, told apart by their titles, paths and order."""
    stored, items, want_vault, want_log = [], [], [], []
    for seed in range(150):
        s, it = random_batch(seed)
        mark = lambda d, f: {**d, "title": f"n{seed} {d['title']}", f: d[f].replace("/h/", f"/h/{seed}-").replace("/x/", f"/x/{seed}-"), "pos": d["pos"] + 100 * seed}  # noqa: E731, B023
        s, it = [{**mark(x, "page_url")} for x in s], [mark(x, "url") for x in it]
        s = [{**x, "id": f"n{seed}-{x['id']}"} for x in s]
        vault, log = fold(s, it, "2")
        want_vault += [(seed, k, v) for k, v in enumerate(vault)]
        want_log += log
        stored, items = stored + s, items + it
    got, log = run(spark, stored, items)
    assert [(x["pos"], x["id"], x["action"], x["note"], x["new_episodes"]) for x in log] == sorted(want_log)
    norm = lambda v: tuple(v[c] if c not in ("seasons", "updated_at") else v[c] or None for c in records.COLUMNS)
    by = {v["id"]: norm(v) for v in got}
    assert len(by) == len(got) == len(want_vault)
    for _, _, v in want_vault:
        assert by[v["id"]] == norm(v), v["id"]
    assert [x["id"] for x in got] == [v["id"] for _, _, v in sorted(want_vault, key=lambda x: ("added_at" in x[2] and x[2]["added_at"] == "2", x[0], x[1]))]


@pytest.mark.parametrize("stored, items", [([], []), (random_batch(3)[0], []), ([], random_batch(3)[1])])
def test_empty_sides(spark, stored, items):
    got, log = run(spark, stored, items)
    vault, want = fold(stored, items, "2")
    assert len(got) == len(vault) and [x["action"] for x in log] == [x[2] for x in want]


def test_links_are_shuffled_once(spark):
    rows = spark.range(20).selectExpr("id", "0L AS src", "IF(id % 2 = 0, 'series', 'movie') AS kind", f"CAST(array(named_struct('quality', 'HD', 'url', 'u')) AS {records.EMBEDS}) AS embeds", f"CAST(array(named_struct('season', 1, 'episodes', array(named_struct('episode', 1, 'embeds', array(named_struct('quality', 'HD', 'url', 'u')))))) AS {records.SEASONS}) AS seasons")
    content, _ = records.merged_links(records.link_rows(rows, ["id"], F.col("src")), ["id"])
    assert content.count() == 20 and content._jdf.queryExecution().sparkPlan().toString().count("Window") >= 2
    assert content._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1].count("Exchange hashpartitioning") == 1


def test_only_shared_keys_spread_groups(spark):
    items = spark.range(50).selectExpr("true AS item", "id AS pos", "concat('i', id) AS id", "concat('/', id, '/') AS path", "concat('f', id) AS fork_id", "IF(id < 2, 'same', concat('b', id)) AS base", "concat('fb', id) AS fork_base")
    sizes = []

    def save(df):
        sizes.append(df.count())
        return df

    groups = {r["pos"]: r["group"] for r in upsert.grouped(items, save).collect()}
    assert len(groups) == 50 and len(set(groups.values())) == 49 and groups[0] == groups[1]
    assert max(sizes) <= 2
