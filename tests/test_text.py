"""Text functions against values written by hand."""

import pytest
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import pages


@pytest.fixture(scope="module")
def one(spark):
    row = spark.range(1)

    def value(*columns):
        got = row.select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first()
        return [x.asDict(recursive=True) if hasattr(x, "asDict") else x for x in got]

    return value


def each(one, f, cases):
    """f over all inputs at once; a tuple is several arguments."""
    lit = lambda x: F.lit(x).cast("string") if x is None else F.lit(x)
    inputs = [c if isinstance(c, tuple) else (c,) for c, _ in cases]
    assert one(*(f(*map(lit, c)) for c in inputs)) == [want for _, want in cases]


def titled(title, year, **more):
    return {"title": title, "year": year, **more}


def test_slugs_and_titles(one):
    each(one, text.slugify, [("A(2020)B", "a-b"), ("Hello, World!", "hello-world"), ("(x) y", "y"), ("", ""), (None, "")])
    each(one, text.title_case, [("éclair du jour", "éclair Du Jour"), ("big iPhone 2b", "Big IPhone 2b")])
    each(one, text.make_id, [(("Leo", 2023), "leo-2023"), (("Leo", 0), "leo")])
    each(one, text.normalise_v1, [("Mr. & Mrs. Été", "mr mrs t")])
    each(one, text.normalise_v2, [("Tom Clancy’s Jack Ryan", "tom clancys jack ryan"), ("Mr. & Mrs. Smith", "mr and mrs smith"), ("2.0", "2.0"), ("தமிழ்", "தமிழ்")])
    each(one, text.twin_base, [("Show Season 2 (2020)", "show"), ("Show Vol 3", "show"), (None, "")])
    each(one, text.display_name, [(("Leo", 2023), "Leo (2023)"), (("Leo", 0), "Leo")])


def test_paths(one):
    each(one, text.path_key, [("http://h/a//", "/a/"), ("movie/x", "/movie/x/"), ("https://h", "/"), ("/a?b#c", "/a/"), ("//h/p", "/p/"), (None, "/"), ("", "/")])
    base = "https://h/a/b?c=1"
    each(one, text.absolute_url, [(("https://x/y", base), "https://x/y"), (("//x/y", base), "https://x/y"), (("/y", base), "https://h/y"), (("y", base), "https://h/a/y"), (("y", "https://h"), "https://h/y"), (("?page=2", base), "https://h/a/b?page=2")])
    each(one, lambda c: text.title_from_path(c), [
        ("/blade-runner-2049-2017-tamil-dubbed-movie/", titled("Blade Runner 2049", 2017)), ("/1971-raanuva-2023-tamil-movie/", titled("1971 Raanuva", 2023)), ("/show-tamil-season-2/", titled("Show", 0)),
        ("/name-hd-1080p/", titled("Name", 0)), ("/x2012y/", titled("X Y", 2012)), ("/leo-2023-movie-1/", titled("Leo", 2023)), ("", titled("", 0)),
    ])
    each(one, lambda c: text.title_from_path(c, "oursite"), [("/leo-2023-tamil-movie-oursite/", titled("Leo", 2023)), ("/leo-oursite-page/", titled("Leo", 0))])


def test_labels(one):
    each(one, text.clean_title, [
        (("Vikram (2022) Tamil HD", ""), titled("Vikram", 2022)), (("Leo 2023 Movie", ""), titled("Leo", 2023)), (("Jailer (Original HD)", ""), titled("Jailer", 0)), (("Some  Name - ", ""), titled("Some Name", 0)),
        ((None, "/x-2020-movie/"), titled("X", 2020)), (("HD 720p", "/y-2021-movie/"), titled("Y", 2021)), (("Alpha (Director) Tamil Dubbed", ""), titled("Alpha (Director)", 0)),
    ])
    each(one, text.title_for, [
        (("Download Now", "/leo-2023-tamil-movie/"), titled("Leo", 2023)), (("Leo", "/leo-2023-tamil-movie/"), titled("Leo", 2023)), (("Leo: Bloody Sweet", "/leo-2023-tamil-movie/"), titled("Leo: Bloody Sweet", 2023)),
        (("(odd)", "/leo-2023-tamil-movie/"), titled("Leo", 2023)), (("---", "/"), None), (("Leo (2022)", "/other-2023-tamil-movie/"), titled("Leo", 2022)),
    ])
    each(one, text.parse_label, [
        (("Hokum (2026) Tamil Dubbed Movie (Original HD) [360p HD + 720p HD]", "/movie/hokum-2026-tamil-dubbed-movie/"), titled("Hokum", 2026, is_series=False, season=0)),
        (("Pokemon (1997) Season 18 (Epi 99 Name)", "/movie/p/"), titled("Pokemon", 1997, is_series=True, season=18)),
        (("", "/movie/pokemon-1997-season-18-tamil-dubbed-movie/"), titled("Pokemon", 1997, is_series=True, season=18)),
        (("Game Tamil Web Series", "/movie/game-2019-tamil-dubbed/"), titled("Game Tamil Web Series", 2019, is_series=True, season=0)),
    ])
    each(one, text.season_of, [("Season 07", 7), ("x-season-2/", 2), ("none", 0)])
    each(one, text.episode_of, [("show-epi-07/", 7), ("Episode 5", 5), ("ep12", 12), ("", 0)])
    each(one, text.sized_quality, [(("Mp4 HD (640x360)", ""), "360p"), (("(1280x544)", ""), "480p"), (("", "x-720P"), "720p"), (("320x240", ""), "240p"), (("none", ""), "")])
    each(one, text.quality_of, [(("1080P HD", ""), "1080p"), (("x", "y"), "HD")])
    each(one, text.until, [(0.4, "<1h"), (5.2, "5h"), (50.0, "2d")])
    each(one, text.clock, [(900, "900ms"), (1500, "1.5s"), (120_000, "2m")])
    each(one, text.family, [("series · refresh in 5h", "series"), ("stored", "stored")])


def test_numerals_are_read_word_by_word(one):
    each(one, lambda c: text.numeral(text.normalise_v2(c)), [
        (("Rocky VI",), "rocky 6"), (("Rocky Chapter VII",), "rocky chapter 7"), (("II II",), "2 2"), (("Part C",), "part 100"), (("Super Bowl XLIV",), "super bowl xliv"), (("Volume XLIV",), "volume 44"), (("Part I",), "part 1"),
        (("I am Mix",), "i am mix"), (("Chapter MCMXCIX",), "chapter 1999"), (("Ocean's Thirteen",), "oceans 13"), (("Vita Civic",), "vita civic"), (("iiii",), "iiii"), (("Malcolm X",), "malcolm x"), (("",), ""),
    ])
    each(one, text.title_similarity, [(("Rocky Chapter VI", "Rocky Chapter VII"), 0.0), (("Rocky Chapter VI", "Rocky Chapter Six"), 1.0), (("Rocky Story II II", "Rocky Story Two II"), 1.0)])


def test_paths_are_resolved(one):
    each(one, text.path_key, [
        (("/a/../b",), "/b/"), (("/a/./b/.",), "/a/b/"), (("/a/b/..",), "/a/"), (("/../../a",), "/a/"), (("https://h/x/%2E%2e/y/",), "/y/"), (("/a b/ü",), "/a%20b/%C3%BC/"), (("/...",), "/.../"), (("/a//b",), "/a//b/"), (("/a%20b",), "/a%20b/"),
    ])


def test_similarity(one):
    each(one, text.title_similarity, [(("Winners and Sinners", "Winners & Sinners"), 1.0), (("Movie Chapter II", "Movie Chapter Two"), 1.0), (("Movie Chapter II", "Movie Chapter III"), 0.0), (("Dhoom 2", "Dhoom 3"), 0.0), (("Rats", "Cats"), 0.0)])
    assert one(text.title_similarity(F.lit("Aayiram Porkaasukal"), F.lit("Aayiram Porkaasugal")))[0] > 0.84


def test_pages_and_paths(one):
    each(one, pages.blocked, [("<h1>Just a moment</h1>", True), ("Verify you are human", True), ("cf-error", True), ("Error 1020", True), ("captcha, enable javascript", False), ("x" * 4000 + "access denied", False), (None, False)])
    each(one, pages.item_path, [("/leo-tamil-movie/", True), ("/x-web-series/", True), ("/x-season-3", True), ("/tamil-2027-movies/", False), ("/page/2-movie/", False)])
    each(one, lambda c: pages.item_path(c, True), [("/movie/hokum/", True), ("/movie/123/", False), ("/movie/tamil-x/", False), ("/movie/x-collections/", False)])
    each(one, lambda c: pages.poster(c, "https://p"), [('<img alt="" src="https://h/uploads/posters/a.jpg?x=1">', "https://p/uploads/posters/a.jpg"), ("x /uploads/posters/b.webp y", "https://p/uploads/posters/b.webp"), ("none", "")])
    html = "<h1>No</h1><ul><li><strong>Movie:</strong> <span>Sample (2026)</span></li><li><strong>Director</strong><span>A and B, N/A</span></li><li><strong>Starring:</strong><span>C, D , C,unknown</span></li></ul>"
    each(one, pages.source_metadata, [
        (html, {"available": True, "title": "Sample (2026)", "year": 2026, "directors": ["A", "B"], "people_cast": ["C", "D"]}),
        ("<title>T &amp; U</title>", {"available": True, "title": "T & U", "year": 0, "directors": [], "people_cast": []}),
        ("<p>x</p>", {"available": False, "title": "", "year": 0, "directors": [], "people_cast": []}),
    ])
    each(one, pages.file_ids, [("/download/file/12 /download/file/7 /download/file/12", ["12", "7"])])
