"""Lookups, credits, notes and walks against values written by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cairn.operators import pages, resolve

CANDIDATE = "id bigint, type string, title string, original_title string, name string, original_name string, alternatives array<string>, release_date string, first_air_date string, language string, seasons array<struct<season_number:int,air_date:string,poster_path:string>>, poster_path string, vote_average double, imdb_id string"


def candidates(spark, *rows):
    names = [f.split()[0] for f in CANDIDATE.replace("season_number:int,air_date:string,", "").split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], CANDIDATE)


def movie(i, title, year=2023, **more):
    return {"id": i, "type": "movie", "title": title, "original_title": title, "release_date": f"{year}-01-01", "language": "ta", **more}


def show(i, name, year, **more):
    return {"id": i, "type": "tv", "name": name, "first_air_date": f"{year}-01-01", **more}


def asked(spark, *rows):
    return spark.createDataFrame(list(rows), "record string, title string, year int")


def pairs(df):
    return {tuple(r)[:2] for r in df.collect()}


def test_exact_matches_are_unique(spark):
    c = candidates(spark, movie(1, "Sample"), movie(2, "Twice"), movie(3, "Twice"), movie(4, "Canonical", alternatives=["Official Alias"]), movie(5, "Businessman", 2012), movie(6, "Other", original_title="Sample Two"))
    r = asked(spark, ("a", "SAMPLE!", 2023), ("b", "Sample", 2022), ("c", "Twice", 2023), ("d", "Official Alias", 2023), ("e", "Business Man", 2012), ("f", "Sample Two", 0), ("g", None, 2023))
    assert pairs(resolve.pick(r, c, "movie")) == {("a", 1), ("f", 6)}
    assert pairs(resolve.pick(r, c, "movie", alternatives=True)) == {("a", 1), ("f", 6), ("d", 4)}
    assert pairs(resolve.pick(r, c, "movie", compact=True)) == {("a", 1), ("f", 6), ("e", 5)}
    assert not pairs(resolve.pick(r, c, "tv"))


def test_seasons_match_by_the_year_they_were_aired(spark):
    c = candidates(spark, show(1, "Show", 2016, poster_path="/generic.jpg", seasons=[(3, "2019-01-01", "/season3.jpg"), (4, "2020-01-01", "")]))
    r = spark.createDataFrame([("a", "Show Season 3", 2019, 0), ("b", "Show", 2019, 2), ("c", "Show", 2020, 4), ("d", "Show", 2019, 0)], "record string, title string, year int, season int")
    assert {tuple(x) for x in resolve.season_pick(r, c).collect()} == {("a", 1, "/season3.jpg"), ("c", 1, "/generic.jpg")}


def test_the_chain_of_lookups(spark):
    c = candidates(spark, movie(1, "Own"), show(2, "Cross", 2023), movie(3, "Unrelated"), movie(4, "Found"), show(5, "Filed As Film", 2023), movie(6, "Film Of Series"), movie(7, "Found Again"))
    r = spark.createDataFrame([("own", "Different", 2023, "movie", 1), ("cross", "Cross", 2023, "movie", 2), ("wrong", "Nothing", 2023, "movie", 2), ("search", "Found", 2023, "movie", 0), ("tv", "Filed as film", 2023, "movie", 0), ("series", "Film of series", 2023, "series", 0), ("suspect", "Found Again", 2023, "movie", 3), ("kept", "Missing", 2023, "movie", 3)], "record string, title string, year int, kind string, tmdb_id bigint")
    plain = {x["record"]: (x["candidate"], x["type"], x["how"]) for x in resolve.resolve(r, c).collect()}
    assert plain == {"own": (1, "movie", "id"), "cross": (2, "tv", "cross"), "wrong": (None, None, "none"), "search": (4, "movie", "search"), "tv": (5, "tv", "search-tv"), "series": (None, None, "none"), "suspect": (3, "movie", "id"), "kept": (3, "movie", "id")}
    strict = {x["record"]: (x["candidate"], x["how"]) for x in resolve.resolve(r, c, verify_ids=True).collect()}
    assert (strict["own"], strict["suspect"], strict["kept"]) == ((1, "kept"), (7, "search"), (3, "kept"))


def test_credits_count_people_once(spark):
    people = spark.createDataFrame([(1, 10, "Actor One", False), (1, 11, "Actor Two", False), (1, 20, "Director One", True), (2, 1, "Sammo Hung", False), (2, 1, "Sammo Kam-Bo Hung", False), (2, 1, "Sammo Hung", True)], "candidate int, person int, name string, director boolean")
    given = [("two", 1, "Actor One", False), ("two", 1, "actor two", False), ("one", 1, "Actor One", False), ("both", 1, "Actor One", False), ("both", 1, "Director One", True), ("none", 1, "Other One", False), ("none", 1, "Other Two", False), ("directors", 1, "Director One", True), ("alias", 2, "Sammo Hung", False), ("alias", 2, "Sammo Kam-Bo Hung", False), ("self", 2, "Sammo Hung", False), ("self", 2, "Sammo Hung", True)]
    got = {r["record"]: (r["strong"], r["contradiction"]) for r in resolve.credits(spark.createDataFrame(given, "record string, candidate int, name string, director boolean"), people).collect()}
    assert got == {"two": (True, False), "one": (False, False), "both": (True, False), "none": (False, True), "directors": (False, False), "alias": (False, False), "self": (False, False)}


def test_subtitles_need_credits_and_no_rival(spark):
    c = candidates(spark, show(1, "Scam 2003: The Telgi Story", 2023), show(2, "Rival: One", 2023), show(3, "Rival: Two", 2023))
    r = asked(spark, ("a", "Scam 2003", 2023), ("b", "Rival", 2023))
    strong = spark.createDataFrame([("a", 1), ("b", 2)], "record string, candidate bigint")
    assert pairs(resolve.subtitle_pick(r, c, strong)) == {("a", 1)} and not pairs(resolve.subtitle_pick(r, c, strong.limit(0)))


def test_overrides_are_checked(spark):
    c = candidates(spark, show(1, "Fall", 2022))
    o = spark.createDataFrame([("good", 1, "tv", "Fall"), ("bad", 1, "tv", "Unrelated"), ("gone", 9, "tv", "Fall")], "id string, tmdb_id bigint, tmdb_type string, expected_title string")
    got = {r["record"]: (r["candidate"], r["status"], r["reason"]) for r in resolve.override_outcome(asked(spark, *((k, k, 2022) for k in ("good", "bad", "gone", "other"))), o, c).collect()}
    assert got == {"good": (1, "matched", "reviewed-override"), "bad": (None, "review", "override-conflict"), "gone": (None, "unresolved", "no-safe-match")}


def test_notes_and_statuses(spark):
    notes = spark.createDataFrame([("a", k, "media-type-conflict" if k == 2 else f"n{k}") for k in range(40)] + [("b", 1, "tmdb-network")], "record string, seq int, reason string")
    got = {r["record"]: r for r in resolve.noted(notes).collect()}
    assert got["a"]["notes"] == [f"n{k}" for k in range(18, 30)] and got["a"]["reason"] == "n39" and got["a"]["review"] and not got["b"]["review"]
    case = lambda *a: tuple(spark.range(1).select(resolve.outcome(*(F.lit(x) for x in a)).alias("o")).first()["o"])
    assert case(False, False, None, None, False, "tmdb-network", False) == ("unavailable", "tmdb-network") and case(False, False, None, None, False, None, True) == ("unavailable", "lookup-timeout")
    assert case(True, True, "ta", "exact", False, None, False) == ("matched", "exact") and case(True, True, "", None, False, None, False) == ("matched", "original-language-missing")
    assert case(True, False, None, None, True, "x", False) == ("review", "x") and case(True, False, None, None, False, None, False) == ("unresolved", "no-safe-match")
    status = lambda *a: spark.range(1).select(resolve.search_status(*(F.lit(x) for x in a))).first()[0]
    assert (status(True, True, 1), status(False, True, 1), status(True, False, 1), status(True, True, 6)) == ("matched", "unresolved", "unavailable", "unavailable")
    guess = lambda *a: spark.range(1).select(resolve.regional_ambiguous(*(F.lit(x) for x in a))).first()[0]
    assert guess(True, "", "te", True) and guess(True, "ta", "te", True) and not guess(True, "te", "te", True) and not guess(False, "", "te", False)


@pytest.mark.parametrize("changed,want", [
    ({}, "accept"), ({"override": True, "found": False}, "unresolved"), ({"trouble": True}, "unavailable"), ({"available": False}, "unavailable"), ({"trusted": True, "available": False}, "accept"), ({"contradiction": True}, "review"),
    ({"source_year": 2022}, "unresolved"), ({"source_year": 2022, "strong": True}, "accept"), ({"scoped": True}, "unavailable"), ({"scoped": True, "fallback_scoped": True}, "review"), ({"found": False, "fallback": True}, "accept"), ({"found": False}, "unresolved"),
])
def test_evidence(spark, changed, want):
    base = dict(override=False, trusted=False, found=True, trouble=False, available=True, named=True, contradiction=False, strong=False, source_year=2023, year=2023, scoped=False, fallback=False, fallback_scoped=False)
    assert spark.range(1).select(resolve.evidence_outcome(**{k: F.lit(v) for k, v in {**base, **changed}.items()})).first()[0] == want


def test_cached_evidence(spark):
    now = dt.datetime(2024, 1, 31)
    e = spark.createDataFrame([("https://a/x/", now - dt.timedelta(days=6), True, "T"), ("https://a/y/", now - dt.timedelta(days=8), True, "U"), ("https://a/z/", now, False, "V")], "source_url string, fetched_at timestamp, available boolean, title string")
    r = spark.createDataFrame([("x", "https://b/x"), ("y", "https://b/y"), ("z", "https://b/z")], "id string, page_url string")
    assert {x["id"]: x["evidence"] and x["evidence"]["title"] for x in resolve.cached_evidence(r, e, F.lit(now)).collect()} == {"x": "T", "y": None, "z": None}


def test_listings(spark):
    html = """<a href="/leo-2023-tamil-movie/">Leo <b>2023</b></a><a class=x href='/show-web-series/'>Show</a><a href=/leo-2023-tamil-movie/?again>Again</a><a href="#">top</a><a href="mailto:x">m</a><a href="/tamil-2027-movies/">nav</a><a href="x-movie/">Rel Season 2</a>"""
    p = spark.createDataFrame([(1, "https://h/list/", html), (2, "https://h/none/", None)], "page_id int, url string, html string")
    got = [tuple(r) for r in pages.listing(p).orderBy("pos").select("path", "label", "kind").collect()]
    assert got == [("/leo-2023-tamil-movie/", "Leo 2023", "movie"), ("/show-web-series/", "Show", "series"), ("/list/x-movie/", "Rel Season 2", "series")]
    with pytest.raises(Exception, match="blocked document at https://h/b/"):
        pages.listing(spark.createDataFrame([(1, "https://h/b/", "<a href='/x-movie/'>Just a moment</a>")], "page_id int, url string, html string")).collect()


def test_links_of_pages(spark):
    rows = [(0, "/x-720p-hd/", "720p HD"), (1, "/x-720p-hd/", "again"), (2, "https://t.me/x", "Telegram"), (3, "/2024-movies/", "nav"), (4, "/season-2/", "Season 2"), (5, "/a/b/c", "deep"), (6, "/download/show-season-1-epi-3/", "E3"), (7, "/download/file/9", "file"), (8, "#", "x"), (9, "/contact", "Contact"), (10, "/s", "Sample"), (11, "/", "home")]
    links = spark.createDataFrame([(1, "https://h/p/", *r) for r in rows], "page_id int, base string, pos int, href string, label string")
    assert [(r["url"], r["quality"]) for r in pages.folder_links(links).orderBy("pos").collect()] == [("https://h/x-720p-hd/", "720p"), ("https://h/season-2/", "HD"), ("https://h/contact", "HD"), ("https://h/s", "HD")]
    assert [(r["url"], r["season"], r["episode"]) for r in pages.slug_links(links).collect()] == [("https://h/download/show-season-1-epi-3/", 1, 3)]
    assert [r["href"] for r in pages.labelled_links(links).orderBy("pos").collect()] == ["/x-720p-hd/", "/2024-movies/", "/season-2/", "/a/b/c", "/download/show-season-1-epi-3/", "/download/file/9", "/"]


def test_sources_in_order(spark):
    df = lambda *rows: spark.createDataFrame(list(rows), "path string, pos int, label string")
    got = {r["path"]: (r["source"], r["label"]) for r in pages.discovered([df(("a", 0, "first"), ("b", 1, "x")), df(("a", 0, "second"), ("c", 1, "y"))]).collect()}
    assert got == {"a": (0, "first"), "b": (0, "x"), "c": (1, "y")}
    index, items = spark.createDataFrame([(0, "u"), (1, "v")], "pos int, url string"), spark.createDataFrame([("v", 0, "p"), ("u", 1, "p"), ("u", 0, "q")], "url string, pos int, path string")
    assert {r["path"]: r["pos"] for r in pages.children(index, items).collect()} == {"p": 0, "q": 0}


def test_anchors_are_read_by_a_parser(spark):
    html = """<p><a data-x="a>b" href="/x">one &eacute;&#8217;s <b>bold</b></a> <A HREF='/y?a=1&amp;b=2'>two
    &nbsp; lines</A><a name="n">none</a><a href=/z>out <a href="/in">in</a> side</a><!-- <a href="/no">no</a> --><a href="">empty</a><a href="/open">never closed"""
    df = spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<a href>bare</a>")], "page_id int, html string")
    got = [tuple(r) for r in pages.anchors(df).orderBy("page_id", "pos").collect()]
    assert got == [(1, 0, "/x", "one é’s bold"), (1, 1, "/y?a=1&b=2", "two lines"), (1, 2, "/z", "out in side"), (1, 3, "/in", "in"), (1, 4, "", "empty"), (1, 5, "/open", "never closed")]


def test_descent_ends_at_finds(spark):
    ddl = "page string, pos int, target string, file string, quality string, episode int"
    rows = [
        ("r", 0, "plain", None, "", 0), ("r", 1, "low", None, "480p", 0), ("r", 2, "high", None, "1080p", 0),  # a named quality shuts the others out
        ("high", 0, None, "1", "", 0), ("high", 1, None, "2", "720p", 4), ("high", 2, "below", None, "", 0),  # nothing below a find is opened
        ("below", 0, None, "9", "", 0), ("low", 0, "e1", None, "", 1), ("low", 1, "e2", None, "", 2), ("low", 2, "e3", None, "", 3), ("low", 3, "e4", None, "", 4),  # three children a page
        ("e1", 0, None, "1", "", 0), ("e2", 0, None, "5", "", 0), ("e3", 0, "d3", None, "", 0), ("d3", 0, None, "6", "", 0), ("e4", 0, None, "7", "", 0), ("plain", 0, None, "8", "", 0),
        ("loop", 0, "loop", None, "", 0), ("deep", 0, "low", None, "", 0),
    ]
    got = {tuple(r) for r in pages.descend(spark.createDataFrame(rows, ddl), spark.createDataFrame([("r",), ("loop",), ("deep",), ("none",)], "node string")).collect()}
    assert got == {("r", "1", "1080p", 0), ("r", "2", "720p", 4), ("r", "5", "480p", 2), ("r", "6", "480p", 3), ("deep", "1", "720p", 1), ("deep", "5", "720p", 2), ("deep", "6", "720p", 3)}


def test_walks(spark):
    links = [("/show-web-series/", 0, "/show-season-2/", "Season 2", "/show-season-2/"), ("/show-season-2/", 0, "/show-season-2-720p/", "720p", "/show-season-2-720p/"), ("/show-season-2/", 1, "/d/epi-3/", "Episode 3", "/d/epi-3/"), ("/show-season-2-720p/", 0, "/d/epi-1/", "E1", "/d/epi-1/"), ("/show-season-2-720p/", 1, "/d/x-1080p-epi-1/", "E1", "/d/x-1080p-epi-1/"), ("/show-season-2/", 2, "/show-web-series/", "back", "/show-web-series/")]
    df = spark.createDataFrame(links, "page string, pos int, target string, label string, href string")
    got = {tuple(r) for r in pages.series_walk(df, spark.createDataFrame([("/show-web-series/",)], "node string")).collect()}
    assert got == {("/show-web-series/", 2, 1, "1080p", "/d/x-1080p-epi-1/"), ("/show-web-series/", 2, 1, "720p", "/d/epi-1/"), ("/show-web-series/", 2, 3, "HD", "/d/epi-3/")}
    edges = spark.createDataFrame([("r", "a", 1), ("r", "b", 2), ("r", "c", 3), ("a", "x", 1), ("b", "y", 1), ("x", "z", 1)], "src string, dst string, rank int")
    assert {tuple(r) for r in pages.hops(edges, spark.createDataFrame([("r",)], "node string"), (2, 1), [F.col("rank")]).collect()} == {("r", "x", 2), ("r", "y", 2)}
    assert {tuple(r) for r in pages.hops(edges, spark.createDataFrame([("r",)], "node string"), (2, 1, 1), [F.col("rank")]).collect()} == {("r", "z", 3), ("r", "y", 2)}
    eps = spark.createDataFrame([("r", 1, k) for k in range(5)] + [("r", 2, 1)], "root string, season int, episode int")
    assert {tuple(r) for r in pages.newest_episodes(eps, 3).collect()} == {("r", 2, 1), ("r", 1, 4), ("r", 1, 3)}
    plan = lambda *a: spark.range(1).select(pages.plan_walk(*(F.lit(x) for x in a))).first()[0]
    assert (plan("/x-web-series/", False, False), plan("/x-movie/", True, False), plan("/x-movie/", False, True), plan("/x-movie/", False, False)) == ("series", "series", "series", "movie")
    shape = lambda *a: spark.range(1).select(pages.walked_shape(*(F.lit(x) for x in a))).first()[0]
    assert (shape(3, 2, 1), shape(0, 2, 1), shape(0, 0, 1), shape(0, 0, 0)) == ("episodes", "seasons", "movie", "empty")


def _most_rows(df):
    """The most rows that a join of df's plan has made, after df was collected."""
    def walk(p):
        name, metrics = p.nodeName(), p.metrics()
        own = [metrics.apply("numOutputRows").value()] if "Join" in name and metrics.contains("numOutputRows") else []
        inner = [p.finalPhysicalPlan()] if name.startswith("AdaptiveSparkPlan") else [p.plan()] if "QueryStage" in name else [p.children().apply(i) for i in range(p.children().size())]
        return own + [n for x in inner for n in walk(x)]

    return max(walk(df._jdf.queryExecution().executedPlan()))


def test_records_and_candidates_of_one_title_do_not_meet_in_pairs(spark):
    candidates = spark.range(400).selectExpr("id", "'tv' AS type", "CAST(NULL AS STRING) AS title", "CAST(NULL AS STRING) AS original_title", "'Saga' AS name", "CAST(NULL AS STRING) AS original_name", "CAST(NULL AS ARRAY<STRING>) AS alternatives", "'' AS release_date", "IF(id = 7, '1990-01-01', '2001-01-01') AS first_air_date", "'/g' AS poster_path", "array(named_struct('season_number', 2, 'air_date', IF(id = 7, '1991-01-01', '2002-01-01'), 'poster_path', IF(id = 7, '/s', ''))) AS seasons")
    records = spark.range(300).selectExpr("id AS record", "'SAGA' AS title", "CASE id % 3 WHEN 0 THEN 1990 WHEN 1 THEN 2001 ELSE 0 END AS year")
    df = resolve.pick(records, candidates, "tv")
    assert {tuple(r) for r in df.collect()} == {(n, 7) for n in range(0, 300, 3)} and _most_rows(df) <= 300
    seasons = records.selectExpr("record", "'Saga season 2' AS title", "IF(year = 0, 0, year + 1) AS year", "0 AS season")
    df = resolve.season_pick(seasons, candidates)
    assert {tuple(r) for r in df.select("record", "candidate", "poster").collect()} == {(n, 7, "/s") for n in range(0, 300, 3)} and _most_rows(df) <= 400
    undated = records.where("record < 2").selectExpr("record", "title", "CAST(NULL AS INT) AS year")
    assert [tuple(r) for r in resolve.pick(undated, candidates.where("id = 7"), "tv").orderBy("record").collect()] == [(0, 7), (1, 7)]
