"""Record operators against values written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators import merge, records, schedule, upsert

EMPTY = dict(title="", year=0, kind=None, category=None, language=None, category_source=None, page_url="", embeds=[], poster="", rating=0.0, tmdb_id=0, imdb_id="", added_at="2024-01-01T00:00:00Z", seasons=None, updated_at=None)
SCHEMA = f"id string, title string, year int, kind string, category string, language string, category_source string, page_url string, embeds {records.EMBEDS}, poster string, rating double, tmdb_id bigint, imdb_id string, added_at string, seasons {records.SEASONS}, updated_at string, pos bigint"
NAMES = [f.split()[0] for f in ("id", *EMPTY, "pos")]
NOW = dt.datetime(2024, 1, 31)


def embed(url, quality="HD"):
    return {"quality": quality, "url": url}


def episode(n, *urls):
    return {"episode": n, "embeds": [embed(*u) if isinstance(u, tuple) else embed(u) for u in urls]}


def season(n, *episodes):
    return {"season": n, "episodes": list(episodes)}


def table(spark, *rows):
    full = [{**EMPTY, "pos": k, **r} for k, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in NAMES) for r in full], SCHEMA)


def urls(embeds):
    return [e["url"] for e in embeds]


def shape(seasons):
    return [(s["season"], [(e["episode"], urls(e["embeds"])) for e in s["episodes"]]) for s in seasons]


def test_falsy_follows_the_type(spark):
    df = spark.sql("SELECT '0' a, '' b, CAST(NULL AS STRING) c, 0 d, 0.0D e, -0.0D f, 1 g, false h, 'x' i")
    assert list(df.select(*(merge.falsy(F.col(c)).alias(c) for c in df.columns)).first()) == [False, True, True, True, True, True, False, True, False]
    assert df.select(merge.filled(F.col("a"), F.col("i"))).first()[0] == "0"


def test_nested_merges(spark):
    have = [season(2, episode(1, ("a", "480p"), ("b", "720p"))), season(1, episode(2, "c"))]
    fresh = [season(2, episode(1, ("b", "720p"), ("d", "1080p")), episode(3, ("y", "360p"), ("x", "1080p")))]
    df = table(spark, {"id": "r", "seasons": have}).withColumn("fresh", F.lit(None).cast(records.SEASONS))
    other = table(spark, {"id": "r", "seasons": fresh}).select(F.col("seasons").alias("fresh"))
    row = df.drop("fresh").crossJoin(other).select(records.merge_seasons(F.col("seasons"), F.col("fresh")).alias("m"), records.merge_seasons(F.col("seasons"), F.lit(None).cast(records.SEASONS)).alias("n")).first()
    assert shape(row["m"]) == [(1, [(2, ["c"])]), (2, [(1, ["d", "b", "a"]), (3, ["y", "x"])])]
    assert shape(row["n"]) == [(1, [(2, ["c"])]), (2, [(1, ["a", "b"])])]


def test_generations_are_united(spark):
    ours = table(spark, {"id": "new", "title": "N"}, {"id": "a", "title": "Mine", "poster": "p1", "rating": 5.0, "updated_at": "2024-02-01", "embeds": [embed("u1"), embed("u2")]}, {"id": "s", "kind": "series", "seasons": [season(1, episode(32, "e32"))]})
    theirs = table(spark, {"id": "a", "title": "Theirs", "poster": "p0", "tmdb_id": 7, "updated_at": "2024-01-15", "embeds": [embed("u0"), embed("u1")]}, {"id": "s", "kind": "series", "seasons": [season(1, episode(1, "e1"))], "embeds": [embed("old")]}, {"id": "only"})
    got = {r["id"]: r for r in records.merge_generations(ours, theirs).orderBy("place").collect()}
    assert list(got) == ["a", "s", "only", "new"]
    a, s = got["a"], got["s"]
    assert (a["title"], a["poster"], a["rating"], a["tmdb_id"], urls(a["embeds"]), a["updated_at"]) == ("Theirs", "p1", 5.0, 7, ["u0", "u1", "u2"], "2024-02-01")
    assert shape(s["seasons"]) == [(1, [(1, ["e1"]), (32, ["e32"])])] and urls(s["embeds"]) == ["e1", "e32"]
    older = {r["id"]: r for r in records.merge_generations(theirs, ours).collect()}
    assert older["a"]["poster"] == "p1" and older["a"]["tmdb_id"] == 7 and older["a"]["updated_at"] == "2024-02-01"


def items(spark, *rows):
    base = dict(url="", title="", year=0, kind="movie", embeds=[], seasons=None, poster="")
    full = [{**base, **r, "pos": k} for k, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[c] for c in (*base, "pos")) for r in full], f"url string, title string, year int, kind string, embeds {records.EMBEDS}, seasons {records.SEASONS}, poster string, pos bigint")


def test_upsert(spark):
    show = [season(10, episode(1, "e1"), episode(2, "e2"), episode(3, "e3"))]
    stored = table(
        spark,
        {"id": "keep-id", "title": "Show Season 10", "year": 2026, "kind": "series", "page_url": "https://h/show/", "seasons": show, "embeds": [embed("e1")]},
        {"id": "film-2024", "title": "Film", "year": 2024, "page_url": "https://h/film/", "embeds": [embed("f1")]},
        {"id": "quiet", "title": "Quiet", "page_url": "https://h/quiet/", "embeds": [embed("q1")]},
    )
    catalogue, log = upsert.upsert(stored, items(
        spark,
        {"url": "https://h/show/", "title": "Show Season 10", "year": 2026, "kind": "series", "seasons": [season(10, episode(32, "e32"))]},
        {"url": "https://h/again/", "title": "Show (2027)", "year": 2027, "kind": "series", "seasons": [season(10, episode(1, "e1"), episode(2, "e2"), episode(3, "e3b"))]},
        {"url": "https://h/film-series/", "title": "Film", "year": 2024, "kind": "series", "seasons": [season(3, episode(1, "s1"))]},
        {"url": "https://h/new/", "title": "New", "year": 2020, "embeds": [embed("n1")], "poster": "np"},
        {"url": "https://h/new-2/", "title": "New", "year": 2020, "embeds": [embed("n2"), embed("n1")]},
        {"url": "https://h/quiet/", "title": "Quiet", "embeds": [embed("q1")]},
        {"url": "https://h/none/", "title": "None"},
    ), F.lit("2024-02-01"))
    by, got = {r["url"]: r for r in log.collect()}, {r["id"]: r for r in catalogue.collect()}
    assert {u: (r["id"], r["action"]) for u, r in by.items()} == {
        "https://h/show/": ("keep-id", "merged"), "https://h/again/": ("keep-id", "merged"), "https://h/film-series/": ("film-season-3-2024", "added"), "https://h/new/": ("new-2020", "added"),
        "https://h/new-2/": ("new-2020", "merged"), "https://h/quiet/": ("quiet", "unchanged"), "https://h/none/": (None, "unchanged"),
    }
    assert list(got) and set(got) == {"keep-id", "film-2024", "quiet", "film-season-3-2024", "new-2020"}
    show = got["keep-id"]
    assert [e["episode"] for e in show["seasons"][0]["episodes"]] == [1, 2, 3, 32] and urls(show["embeds"]) == ["e1", "e2", "e3", "e3b", "e32"]
    assert by["https://h/show/"]["new_episodes"] == 1 and by["https://h/again/"]["new_episodes"] == 0
    assert by["https://h/film-series/"]["note"] == 'kept the stored movie · filed as "Film Season 3"' and got["film-season-3-2024"]["title"] == "Film Season 3"
    assert urls(got["new-2020"]["embeds"]) == ["n1", "n2"] and got["new-2020"]["poster"] == "np"
    assert {i: (r["added_at"], r["updated_at"]) for i, r in got.items()} == {
        "keep-id": (EMPTY["added_at"], "2024-02-01"), "film-2024": (EMPTY["added_at"], None), "quiet": (EMPTY["added_at"], None), "film-season-3-2024": ("2024-02-01", None), "new-2020": ("2024-02-01", "2024-02-01"),
    }


def meta(**m):
    base = dict(tmdb_id=0, tmdb_type="movie", imdb_id="", poster="", rating=0.0, language="", cross_type=False)
    return {**base, **m}


META = "struct<tmdb_id:bigint,tmdb_type:string,imdb_id:string,poster:string,rating:double,language:string,cross_type:boolean>"


def applied(spark, record, m, **how):
    df = table(spark, {"id": "r", **record}).crossJoin(spark.createDataFrame([(tuple(m.values()) if m else None,)], f"meta {META}"))
    return records.apply_metadata(df, "meta", **how).first()


def test_metadata_fills_and_replaces(spark):
    r = applied(spark, {"poster": "mine", "tmdb_id": 5}, meta(tmdb_id=9, poster="theirs", rating=7.5, language="te", tmdb_type="tv"))
    assert (r["poster"], r["tmdb_id"], r["rating"], r["language"], r["category"], r["category_source"], r["changed"]) == ("mine", 5, 7.5, "te", "tamil-dubbed-series", "tmdb", True)
    r = applied(spark, {"poster": "mine", "tmdb_id": 5, "language": "en"}, meta(tmdb_id=9, poster="theirs", language="ta"), replace_id=True)
    assert (r["poster"], r["tmdb_id"], r["language"], r["category"]) == ("theirs", 9, "ta", "tamil-movie")
    r = applied(spark, {"poster": "mine", "tmdb_id": 5}, meta(tmdb_id=9, poster="theirs", cross_type=True))
    assert (r["poster"], r["tmdb_id"], r["category"]) == ("theirs", 9, None)
    assert not applied(spark, {"poster": "p"}, None)["changed"] and not applied(spark, {"poster": "p"}, meta(poster="p"))["changed"]
    r = applied(spark, {"tmdb_id": 1, "language": "en", "category": "tamil-dubbed-movie", "category_source": "tmdb"}, meta(tmdb_id=1, language="ta"), v2=True)
    assert (r["language"], r["category"]) == ("ta", "tamil-movie")


def test_dead_links_go_with_their_episodes(spark):
    df = table(spark, {"id": "s", "kind": "series", "seasons": [season(1, episode(1, "a"), episode(2, "b", "c")), season(2, episode(1, "d"))], "embeds": [embed(x) for x in "abcd"]}, {"id": "m", "embeds": [embed("a"), embed("z")]})
    dead = spark.createDataFrame([("s", "a"), ("s", "b"), ("s", "d"), ("m", None)], "id string, url string")
    got = {r["id"]: r for r in records.remove_dead(df, dead).collect()}
    assert shape(got["s"]["seasons"]) == [(1, [(2, ["c"])])] and urls(got["s"]["embeds"]) == ["c"] and got["s"]["removed"] == 3
    assert urls(got["m"]["embeds"]) == ["a", "z"] and got["m"]["removed"] == 0


def queue_rows(spark, *rows):
    df = table(spark, *({"embeds": [embed("x")], "title": r["id"], **r} for r in rows))
    return df.withColumn("identity", F.col("id")).withColumn("added_at", F.to_timestamp("added_at"))


ATTEMPTS = "id string, version int, identity string, status string, reason string, attempts int, checked_at timestamp, next_at timestamp"
COMPLETE = dict(tmdb_id=10, language="ta", category="tamil-movie", category_source="tmdb", poster="p", imdb_id="tt1", rating=0.0)


def test_queue_gives_slots_to_new_and_old(spark):
    rows = queue_rows(spark, *({"id": f"old{k}"} for k in range(10)), *({"id": f"new{k}", "added_at": "2024-01-30T00:00:00Z"} for k in range(10)), {"id": "votes", **COMPLETE}, {"id": "none", "embeds": []}, {"id": "full", **COMPLETE, "rating": 1.0})
    attempts = spark.createDataFrame([("old0", 2, "old0", "unresolved", "r", 1, NOW - dt.timedelta(hours=7), NOW - dt.timedelta(hours=1)), ("old1", 2, "old1", "unresolved", "r", 1, NOW, NOW + dt.timedelta(hours=6)), ("old2", 1, "old2", "matched", "r", 1, NOW, NOW + dt.timedelta(days=30))], ATTEMPTS)
    none = spark.createDataFrame([], "id string")
    q = [r["id"] for r in records.metadata_queue(rows, attempts, none, F.lit(NOW), 6).orderBy("place").collect()]
    assert [x[:3] for x in q] == ["new"] * 3 + ["old"] * 3 and "old1" not in q
    whole = [r["id"] for r in records.metadata_queue(rows, attempts, none, F.lit(NOW)).orderBy("place").collect()]
    assert whole[:6] == q and len(whole) == 20 and whole[6] == "votes" and not {"none", "full", "old1"} & set(whole)
    assert [x for x in whole if x.startswith("old")][-1] == "old0" and whole[-1] == "new9"
    assert {r["id"] for r in records.metadata_queue(rows, attempts, none, F.lit(NOW), only="OLD1", retry_misses=True).collect()} == {"old1"}


def test_attempts_start_again_with_the_identity(spark):
    df = spark.createDataFrame([("a", 2, "i", 3), ("b", 2, "other", 3), ("c", 1, "i", 3)], "id string, version int, identity string, attempts int").select("id", F.struct("version", "identity", "attempts").alias("p"))
    df = df.unionByName(spark.range(1).select(F.lit("d").alias("id"), F.lit(None).cast("struct<version:int,identity:string,attempts:int>").alias("p")))
    got = {r["id"]: r["e"] for r in df.select("id", records.remember("p", F.lit("i"), F.lit("unresolved"), F.lit(NOW)).alias("e")).collect()}
    assert {k: e["attempts"] for k, e in got.items()} == {"a": 4, "b": 1, "c": 1, "d": 1}
    assert got["a"]["next_at"] - NOW == dt.timedelta(days=7) and got["d"]["next_at"] - NOW == dt.timedelta(hours=6)


def test_a_batch_of_outcomes(spark):
    rows = queue_rows(spark, *({"id": f"r{k}"} for k in range(4)))
    none = tuple(meta().values())
    out = spark.createDataFrame([("r0", "unavailable", "source-unavailable", False, None), ("r1", "matched", "title", False, (6, "movie", "", "new", 0.0, "te", False)), ("r2", "matched", "title", False, (6, "movie", "", "new", 0.0, "", False))], f"id string, status string, reason string, replace boolean, meta {META}")
    assert none
    done, entries = records.enrich_batch(rows, out, spark.createDataFrame([], ATTEMPTS), F.lit(NOW))
    got = {r["id"]: r for r in done.collect()}
    assert len(got) == 4 and got["r1"]["category"] == "tamil-dubbed-movie" and got["r1"]["changed"] and not got["r0"]["changed"] and not got["r3"]["changed"]
    assert {r["id"]: (r["status"], r["reason"]) for r in entries.collect()} == {"r0": ("unavailable", "source-unavailable"), "r1": ("matched", "title"), "r2": ("unresolved", "original-language-missing")}


def test_reports_and_stale_misses(spark):
    rows = queue_rows(spark, {"id": "tried"}, {"id": "waits"}, {"id": "old"}, {"id": "full", **COMPLETE})
    attempts = spark.createDataFrame([("waits", 2, "waits", "review", "conflict", 1, NOW, NOW), ("old", 1, "old", "matched", "x", 1, NOW, NOW)], ATTEMPTS)
    tried = spark.createDataFrame([("tried", "matched", "title")], "id string, status string, reason string")
    assert {tuple(r) for r in records.attempt_report(rows, attempts, tried).collect()} == {("tried", "matched", "title"), ("waits", "review", "conflict"), ("old", "pending", "not-attempted-this-version")}
    theirs = spark.createDataFrame([("x", 2, "x", "unresolved", "r", 1, NOW - dt.timedelta(days=1), NOW)], ATTEMPTS)
    ours = spark.createDataFrame([("x", 2, "x", "matched", "r", 1, NOW, NOW)], ATTEMPTS)
    merged, misses = records.merge_attempt_states(ours, theirs, spark.createDataFrame([("x",), ("y",)], "id string"))
    assert merged.first()["status"] == "matched" and [r["id"] for r in misses.collect()] == ["y"]


def test_fingerprints_ignore_links(spark):
    src = F.lit(None).cast("struct<title:string,year:int,people_cast:array<string>,directors:array<string>>")
    over = F.lit(None).cast("struct<tmdb_id:int>")
    df = table(spark, {"id": "a", "title": "T"}, {"id": "b", "title": "T", "embeds": [embed("x")]}, {"id": "c", "title": "T", "kind": "movie"}, {"id": "d", "title": "U"}).withColumn("tmdb_type", F.lit(""))
    got = {r["id"]: r["f"] for r in df.select("id", records.fingerprint(src, over).alias("f")).collect()}
    assert got["a"] == got["b"] == got["c"] != got["d"] and len(got["a"]) == 20


def test_signatures_ignore_title_and_year(spark):
    df = table(spark, {"id": "a", "title": "T"}, {"id": "b", "title": "U", "year": 2020}, {"id": "c", "poster": "p"}, {"id": "d", "embeds": [embed("x")]}, {"id": "e", "language": "ta"})
    got = {r["id"]: r["s"] for r in df.select("id", records.signature().alias("s")).collect()}
    assert got["a"] == got["b"] and len({got[k] for k in "acde"}) == 4


def test_order_and_json(spark):
    df = table(spark, {"id": "a", "title": "T"}).withColumn("extra", F.lit("kept")).select("extra", "title", "id", "year")
    assert records.ordered(df).columns == ["id", "title", "year", "extra"]
    assert records.as_json(df).first()["json"] == '{"id":"a","title":"T","year":0,"extra":"kept"}'


@pytest.mark.parametrize("rules,want", [
    (schedule.Rules(), {"new": "new or due", "stored": "-stored", "series-new": "-series fresh", "series-old": "series refresh", "other": "-stored (another path)", "other-series": "series refresh", "old-walker": "newer walker", "failed": "-failed", "failed-long": "new or due", "empty": "-empty", "empty-long": "new or due", "held": "-empty"}),
    (schedule.Rules(sweep_empty=True), {"new": "-not a tracked-empty page", "stored": "-stored", "series-new": "-stored", "series-old": "-stored", "other": "-stored (another path)", "other-series": "series refresh", "old-walker": "empty from the old walker", "failed": "empty-page sweep", "failed-long": "empty-page sweep", "empty": "empty-page sweep", "empty-long": "empty-page sweep", "held": "empty-page sweep"}),
    (schedule.Rules(only_empty=True, refresh_days=30), {"new": "-not a tracked-empty page", "stored": "-not a tracked-empty page", "series-new": "-not a tracked-empty page", "series-old": "-not a tracked-empty page", "other": "-not a tracked-empty page", "other-series": "-not a tracked-empty page", "old-walker": "newer walker", "failed": "-failed", "failed-long": "new or due", "empty": "-empty", "empty-long": "new or due", "held": "-empty"}),
])
def test_verdicts(spark, rules, want):
    h = lambda n: NOW - dt.timedelta(hours=n)
    stored = table(spark, {"id": "dup", "page_url": "https://h/stored/"}, {"id": "st", "page_url": "https://h/stored/", "embeds": [embed("x")]}, *({"id": u, "kind": "series", "page_url": f"https://h/{u}/", "embeds": [embed("x")]} for u in ("series-new", "series-old")), {"id": "known-2020", "kind": "series", "page_url": "https://h/elsewhere/", "embeds": [embed("x")]})
    state = [("stored", h(900), 1, None, False, 2, 0, None), ("series-new", h(3), 1, None, False, 2, 0, None), ("series-old", h(25), 1, None, False, 2, 0, None), ("other", h(900), 2, None, False, 2, 0, None), ("other-series", h(25), 2, None, False, 2, 0, None), ("old-walker", h(1), 0, None, True, 1, 0, None),
             ("failed", h(2), 0, None, True, 2, 1, None), ("failed-long", h(4), 0, None, True, 2, 1, None), ("empty", h(23), 0, None, True, 2, 0, None), ("empty-long", h(25), 0, None, True, 2, 0, None), ("held", h(90), 0, None, True, 2, 0, NOW + dt.timedelta(hours=1))]
    st = spark.createDataFrame([(f"https://h/{u}/", *rest) for u, *rest in state], "url string, at timestamp, embeds int, kind string, empty boolean, v int, failures int, retry_after timestamp")
    its = spark.createDataFrame([(f"https://h/{u}/", f"/{u}/", "known" if u == "other-series" else u, 2020) for u in want], "url string, path string, title string, year int")
    got = {r["path"].strip("/"): ("" if r["walk"] else "-") + r["why"] for r in schedule.verdicts(its, stored, st, F.lit(NOW), rules).collect()}
    assert got == want


def test_state_after_walks(spark):
    df = spark.sql("SELECT named_struct('failures', 2, 'retries', 5) AS p")
    walk = lambda n, ok: df.select(schedule.after_walk("p", F.lit(n), F.lit("movie"), F.lit(ok), F.lit(NOW), 2).alias("e")).first()["e"]
    failed, empty, full = walk(0, False), walk(0, True), walk(3, True)
    assert (failed["failures"], failed["retries"], failed["retry_after"] - NOW) == (3, 6, dt.timedelta(hours=6)) and failed["empty"]
    assert (empty["failures"], empty["retry_after"], empty["retries"]) == (0, None, 6) and (full["empty"], full["retries"]) == (False, 0)
