"""Pages of HTML as tables: anchors, headings, shapes, and where a listing ends."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.functions import text

# Words of a guard's page; links that lead nowhere useful; names of sections and of kinds of page.
BLOCKED = r"(?i)just a moment|verify you are human|checking your browser|access denied|attention required|cf-error|error 10[0-9][0-9]"
SOCIAL = r"(?i)telegram|t\.me|whatsapp|instagram"
FOOTER = r"(?i)telegram|whatsapp|facebook|twitter|favicon|style\.min|/contact|/dmca"
PREFERRED = ("1080p", "720p")
QUALITY_WORDS = r"(?i)[0-9]+p|hd|predvd|dvd|blu"
ITEM = r"-(?:tamil-)?movie/$|-(?:tamil-)?web-series/$|-(?:tamil-)?season-[0-9]+/?$|-(?:tamil-)?movie-[0-9]+/$"
NAVIGATION = r"^/tamil-movies/[a-z]?/?$|^/tamil-[0-9]{4}-movies|^/tamil-atoz|^/tamil-web-series-download|^/tamil-hd-movies|^/tamil-dubbed-movies|^/tamil-movies-collection|^/tamil-latest|^/feed|^/page/"
SERIES = r"-web-series/$|-season-[0-9]+/?$"
OTHER_ITEM, OTHER_SKIP = r"^/movie/(?![0-9]+/?$)[^/]+/$", r"-collections?/$|^/movie/(?:tamil|hollywood|genres|yearly)"

def plain(html: Column) -> Column:
    """Text of a piece of HTML: no tags, the usual entities, single blanks."""
    t = F.regexp_replace(html, "<[^>]*>", "")
    for entity, sign in (("&nbsp;|&#160;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;|&#34;", '"'), ("&#0?39;|&apos;", "'"), ("&amp;|&#38;", "&")):
        t = F.regexp_replace(t, entity, sign)
    return text.squeeze(t)


class _Anchors(HTMLParser):
    """The anchors of a page in order, as [href, text]; text inside several anchors belongs to each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[list[str]] = []
        self.open: list[int] = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self.open.append(len(self.found))
            self.found.append([next((v for k, v in attrs if k == "href"), None), ""])

    def handle_endtag(self, tag):
        if tag == "a" and self.open:
            self.open.pop()

    def handle_data(self, data):
        for k in self.open:
            self.found[k][1] += data


def parsed_anchors(html: str) -> list[tuple[str, str]]:
    """(href, text) of the anchors with a link, in page order."""
    parser = _Anchors()
    parser.feed(html)
    parser.close()
    return [(href, text_) for href, text_ in parser.found if href is not None]


def anchors(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """key, pos (from 0, in page order), href, label of every anchor with a link (X1), as a parser reads the page: attributes may
    hold ">", entities are resolved, anchors may be nested or unclosed. Anchors of null and empty pages are none."""
    kind = pages.schema[key].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(i, k, href, label) for i, page in enumerate(b.column(1).to_pylist()) if page for k, (href, label) in enumerate(parsed_anchors(page))]
            at, pos, href, label = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(pos, pa.int32()), pa.array(href, pa.string()), pa.array(label, pa.string())], names=[key, "pos", "href", "label"])

    out = pages.select(F.col(key).alias("key"), F.col(html).alias("html")).mapInArrow(run, T.StructType([T.StructField(key, kind), T.StructField("pos", T.IntegerType()), T.StructField("href", T.StringType()), T.StructField("label", T.StringType())]))
    return out.withColumn("label", text.squeeze(F.col("label")))


def useful(href: Column) -> Column:
    """Whether a link leads anywhere."""
    return (href != "") & ~href.startswith("#") & ~href.startswith("mailto:")


def item_path(path: Column, other: bool = False) -> Column:
    """Whether a path is an item's and not navigation (F1), on the other kind of site by its own rule (F2)."""
    return path.rlike(OTHER_ITEM) & ~path.rlike(OTHER_SKIP) if other else path.rlike(ITEM) & ~path.rlike(NAVIGATION)


def first_each(df: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """The first row by pos of each key (U4)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), pos).alias("__r")).select(*keys, *(F.col(f"__r.{c}").alias(c) for c in rest))


def listing(pages: DataFrame, other: bool = False) -> DataFrame:
    """page_id, pos, path, label, kind of the items that listing pages show, each path once a page, in page order
    (S7, X1, D5). pages: page_id, url, html; a guard's page fails (F3). The kind is a hint."""
    checked = pages.withColumn("html", F.when(blocked(F.col("html")), F.raise_error(F.concat(F.lit("blocked document at "), F.col("url")))).otherwise(F.col("html")))
    a = anchors(checked).where(useful(F.col("href"))).join(pages.select("page_id", "url"), "page_id")
    a = a.withColumn("path", text.path_key(text.absolute_url(F.col("href"), F.col("url")))).where(item_path(F.col("path"), other))
    hint = F.concat("label", "path").rlike(r"(?i)web series|season [0-9]|\bepi\b") | F.col("path").contains("-web-series/")
    hint = hint if other else hint | F.col("path").rlike(SERIES)
    return first_each(a.select("page_id", "pos", "path", "label", F.when(hint, "series").otherwise("movie").alias("kind")), ["page_id", "path"], "pos")


def discovered(sources: list[DataFrame], key: str = "path") -> DataFrame:
    """Items of several sources in their order, each path where it came first (S9, U2). Sources have pos."""
    out = None
    for k, df in enumerate(sources):
        df = df.withColumn("source", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    rest = [c for c in out.columns if c != key]
    return out.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("source", "pos")).alias("__r")).select(key, *(F.col(f"__r.{c}").alias(c) for c in rest))


def children(index: DataFrame, items: DataFrame) -> DataFrame:
    """Items of the collections that an index lists, each path once (J14). index: pos, url; items: url, pos, path."""
    j = index.select(F.col("pos").alias("__outer"), "url").join(items, "url")
    return first_each(j.withColumn("pos", F.struct("__outer", "pos")).drop("__outer", "url"), ["path"], "pos").withColumn("pos", F.col("pos.__outer"))


def folder_links(links: DataFrame) -> DataFrame:
    """Links to folders and qualities, each URL once (X2): no navigation, collections or social sites; either a
    quality is named or the path has one part. links: page_id, base, pos, href, label."""
    href, label = F.col("href"), F.col("label")
    ok = useful(href) & (href != "/") & ~F.concat(label, href).rlike(SOCIAL) & ~href.contains("-movies/") & ~href.contains("collection")
    single = F.size(F.filter(F.split(href, "/"), lambda p: p != "")) == 1
    named = label.rlike(QUALITY_WORDS) | href.rlike(r"(?i)[0-9]+p|hd-|predvd|dvd|blu")
    out = links.where(ok & (named | single)).withColumn("url", text.absolute_url(href, F.col("base"))).withColumn("quality", text.quality_of(label, href))
    return first_each(out.select("page_id", "pos", "url", "href", "label", "quality"), ["page_id", "url"], "pos")


def slug_links(links: DataFrame) -> DataFrame:
    """Links to download pages, not to files, each URL once, with the episode that they name."""
    href = F.col("href")
    out = links.where(href.contains("/download/") & ~href.contains("/download/file/") & ~href.contains("/download/page/"))
    out = out.withColumn("url", text.absolute_url(href, F.col("base"))).withColumn("episode", text.episode_of(href)).withColumn("season", text.season_of(href))
    return first_each(out.select("page_id", "pos", "url", "href", "label", "season", "episode"), ["page_id", "url"], "pos")


def labelled_links(links: DataFrame) -> DataFrame:
    """Links with a label, each URL once, without footers and samples."""
    out = links.where(useful(F.col("href")) & (F.col("label") != "")).withColumn("url", text.absolute_url(F.col("href"), F.col("base")))
    out = first_each(out.select("page_id", "pos", "url", "href", "label"), ["page_id", "url"], "pos")
    return out.where(~F.concat("href", "label").rlike(FOOTER) & ~F.col("label").rlike("(?i)sample"))


def file_ids(html: Column) -> Column:
    """Distinct numbers of files that a page links, in order."""
    return F.array_distinct(F.regexp_extract_all(html, F.lit("/download/file/([0-9]+)"), F.lit(1)))


def poster(html: Column, host: str) -> Column:
    """The page's own poster: the first picture below /uploads/posters/, else a stray mention of one, else empty."""
    img = F.regexp_extract(html, r"""(?i)<img[^>]+src=["']([^"']*/uploads/posters/[^"']+)["']""", 1)
    stray = F.regexp_extract(html, r"""(?i)/uploads/posters/([^"'\s)]+\.(?:jpe?g|png|webp))""", 1)
    path = F.regexp_extract(text.canonical_url(img), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/]*)?(.*)$", 1)
    return F.when(img != "", F.concat(F.lit(host), F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))).when(stray != "", F.concat(F.lit(f"{host}/uploads/posters/"), stray)).otherwise("")


def source_metadata(html: Column) -> Column:
    """What a page says of its work (X4): struct of available, title, year, directors, people_cast (at most eight),
    from rows "key: value" of a list and, for the title, else the first heading or the page's title."""
    pairs = F.regexp_extract_all(html, F.lit(r"(?is)<li\b[^>]*>\s*<strong\b[^>]*>.*?</li>"), F.lit(0))
    key = lambda li: F.lower(F.trim(F.regexp_replace(plain(F.regexp_extract(li, r"(?is)<strong\b[^>]*>(.*?)</strong>", 1)), r":\s*$", "")))
    value = lambda li: plain(F.regexp_extract(li, r"(?is)<span\b[^>]*>(.*?)</span>", 1))
    rows = F.filter(F.transform(pairs, lambda li: F.struct(key(li).alias("key"), value(li).alias("value"))), lambda r: (r["key"] != "") & (r["value"] != ""))

    def named(f: Column) -> Column:
        of = lambda *names: F.coalesce(*(_last(f["rows"], n) for n in names))
        title = F.trim(F.coalesce(of("movie"), f["heading"], F.lit("")))
        return F.struct((title != "").alias("available"), title.alias("title"), text.number(F.regexp_extract(title, r"\(((?:19|20)[0-9]{2})\)", 1)).alias("year"), text.split_credits(of("director"), 1 << 30).alias("directors"), text.split_credits(of("starring", "actors", "stars")).alias("people_cast"))

    return text.let(F.struct(rows.alias("rows"), heading(html).alias("heading")), named)


def _last(rows: Column, name: str) -> Column:
    """The value of the last row of a name, null without one."""
    hits = F.filter(rows, lambda r: r["key"] == name)
    return F.get(hits, F.size(hits) - 1)["value"]


def heading(html: Column) -> Column:
    """Text of the first h1, of the title without one, else null."""
    text_of = lambda tag: F.nullif(plain(F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)), F.lit(""))
    return F.coalesce(text_of("h1"), text_of("title"))


def blocked(html: Column) -> Column:
    """Whether the first 4,000 characters look like a guard's page."""
    return F.coalesce(F.substring(html, 1, 4000), F.lit("")).rlike(BLOCKED)


def plan_walk(path: Column, has_episodes: Column, has_season_folders: Column) -> Column:
    """Which walk a page needs (G5): its links tell, the path is a hint."""
    return F.when(path.rlike("-web-series(?:/|-)|-season-[0-9]+/?$") | has_episodes | has_season_folders, "series").otherwise("movie")


def hops(edges: DataFrame, roots: DataFrame, caps: tuple[int, ...], rank: list[Column]) -> DataFrame:
    """(root, leaf, depth): a walk of as many hops as there are caps, each following a page's best links, no more
    than the hop's cap of them (G1); a page that ends early is a leaf. edges: src, dst and what ranks them."""
    n = F.row_number().over(Window.partitionBy("src").orderBy(*rank))
    best = edges.withColumn("__n", n).where(F.col("__n") <= max(caps)).select("src", "dst", "__n")
    at = roots.select(F.col("node").alias("root"), F.col("node").alias("leaf")).withColumn("depth", F.lit(0))
    done = None
    for k, cap in enumerate(caps, 1):
        step = at.join(best.where(F.col("__n") <= cap), at["leaf"] == best["src"], "left")
        ended = step.where("src IS NULL").select("root", "leaf", "depth")
        done = ended if done is None else done.unionByName(ended)
        at = step.where("src IS NOT NULL").select("root", F.col("dst").alias("leaf")).distinct().withColumn("depth", F.lit(k))
    return done.unionByName(at).groupBy("root", "leaf").agg(F.min("depth").alias("depth"))


def series_walk(links: DataFrame, roots: DataFrame, depth: int = 3) -> DataFrame:
    """(root, season, episode, quality, url) of the episodes that links lead to (G2): pages hand their season and quality down,
    a link's own come first, and better folders are opened first. An episode has one link a quality, the last one found; of a
    link that is found twice the first counts. Where there are 1080p or 720p, other qualities go.

    links: page, pos, target, label, href. Every hop is a join and their number is fixed; `path` is the order of the walk.
    """
    season, episode, quality = text.season_of(F.concat_ws(" ", "label", "href")), text.episode_of(F.col("href")), text.quality_of(F.col("label"), F.col("href"), "")
    rank = F.when(episode > 0, 0).otherwise(text.quality_rank(quality))
    e = links.select("page", F.struct(rank.alias("rank"), F.col("pos").cast("long").alias("pos")).alias("at"), "target", season.alias("l_season"), episode.alias("l_episode"), quality.alias("l_quality"))
    at = roots.select(F.col("node").alias("root"), F.col("node").alias("page"), text.season_of(F.col("node")).alias("season"), F.lit("").alias("quality"), F.array().cast("array<struct<rank:int,pos:bigint>>").alias("path"))
    found = None
    for _ in range(depth):
        step = at.join(e, "page").select("root", "target", F.when(F.col("l_season") > 0, F.col("l_season")).otherwise(F.col("season")).alias("season"), "l_episode", F.when(F.col("l_quality") != "", F.col("l_quality")).otherwise(F.col("quality")).alias("quality"), F.concat("path", F.array("at")).alias("path"))
        leaf = step.where("l_episode > 0").select("root", F.greatest("season", F.lit(1)).alias("season"), F.col("l_episode").alias("episode"), F.col("target").alias("url"), F.when(F.col("quality") == "", "HD").otherwise(F.col("quality")).alias("quality"), "path")
        found = leaf if found is None else found.unionByName(leaf)
        at = first_each(step.where("l_episode = 0").select("root", F.col("target").alias("page"), "season", "quality", "path"), ["root", "page", "season", "quality"], "path")
    once = first_each(found, ["root", "season", "episode", "url"], "path")
    best = once.groupBy("root", "season", "episode", "quality").agg(F.max_by("url", "path").alias("url"))
    good = F.col("quality").isin(*PREFERRED)
    any_good = F.max(good).over(Window.partitionBy("root", "season", "episode"))
    return best.withColumn("__any", any_good).where(good | ~F.col("__any")).select("root", "season", "episode", "quality", "url")


def descend(links: DataFrame, roots: DataFrame, depth: int = 3, fan: int = 3) -> DataFrame:
    """(root, file, quality, episode) of the files behind each root (G3): a page that links files ends its branch; else its
    children are opened, those with a quality if there are any, better ones first, at most `fan` a page and `depth` hops.

    links: page, pos, target (a child page) or file, quality and episode (empty and 0 where a link names none, and then the
    page's own count, which it has from what led to it). Of a file that is reached again the first way counts, branches in
    order. Children are ranked once for all hops; a page with files has none, so nothing below a find is opened.
    """
    files = links.where(F.col("file").isNotNull()).select("page", F.col("pos").cast("long").alias("pos"), "file", F.col("quality").alias("own_quality"), F.col("episode").alias("own_episode"))
    kids = links.where(F.col("file").isNull()).join(files.select("page").distinct(), "page", "left_anti")
    named = F.col("quality") != ""
    kids = kids.withColumn("__any", F.max(named).over(Window.partitionBy("page"))).where(named | ~F.col("__any"))
    n = F.row_number().over(Window.partitionBy("page").orderBy(text.quality_rank(F.col("quality")), "pos"))
    kids = kids.withColumn("n", n.cast("long")).where(F.col("n") <= fan).select("page", "n", "target", F.col("quality").alias("own_quality"), F.col("episode").alias("own_episode"))
    taken = [F.when(F.col("own_quality") != "", F.col("own_quality")).otherwise(F.col("quality")).alias("quality"), F.when(F.col("own_episode") > 0, F.col("own_episode")).otherwise(F.col("episode")).alias("episode")]
    at = roots.select(F.col("node").alias("root"), F.col("node").alias("page"), F.lit("720p").alias("quality"), F.lit(0).alias("episode"), F.array().cast("array<bigint>").alias("path"))
    found = None
    for k in range(depth + 1):
        here = at.join(files, "page").select("root", "file", *taken, F.concat("path", F.array("pos")).alias("path"))
        found = here if found is None else found.unionByName(here)
        if k < depth:
            at = at.join(kids, "page").select("root", F.col("target").alias("page"), *taken, F.concat("path", F.array("n")).alias("path"))
    return first_each(found, ["root", "file"], "path").drop("path")


def newest_episodes(episodes: DataFrame, most: int = 200) -> DataFrame:
    """Each root's latest episodes, at most so many."""
    n = F.row_number().over(Window.partitionBy("root").orderBy(F.desc("season"), F.desc("episode")))
    return episodes.withColumn("__n", n).where(F.col("__n") <= most).drop("__n")


def walked_shape(n_episodes: Column, n_seasons: Column, n_files: Column) -> Column:
    """What a page of the other kind of site holds (G4): episodes, folders of seasons, a movie, or nothing."""
    return F.when(n_episodes > 0, "episodes").when(n_seasons > 0, "seasons").when(n_files > 0, "movie").otherwise("empty")


def shape(n_items: Column, n_folders: Column) -> Column:
    """What a page is to a walker (G5): folders first, then a list of items, else a leaf."""
    return F.when(n_folders > 0, "folders").when(n_items > 1, "list").otherwise("leaf")


def listing_cut(items: DataFrame, listing: str, page: str, path: str) -> DataFrame:
    """listing, pages read, items found, of scans that stop at the first page without a new item."""
    first = items.groupBy(listing, path).agg(F.min(page).alias("first"))
    fresh = first.groupBy(listing, F.col("first").alias(page)).agg(F.count("*").alias("fresh"))
    pages = items.select(listing, page).distinct().join(fresh, [listing, page], "left")
    order = Window.partitionBy(listing).orderBy(page)
    pages = pages.withColumn("n", F.row_number().over(order)).withColumn("stop", F.max(F.col("fresh").isNull().cast("int")).over(order))
    return pages.where("stop = 0").groupBy(listing).agg(F.count("*").alias("pages"), F.sum("fresh").alias("items"))


def barren_cut(pages: DataFrame, listing: str, page: str, fresh: str, streak: int = 3) -> DataFrame:
    """The pages that a scan reads which ends with the `streak`-th page in a row without anything new, that
    page included (W7)."""
    order = Window.partitionBy(listing).orderBy(page)
    island = F.sum((F.col(fresh) > 0).cast("int")).over(order)
    run = pages.withColumn("__i", island)
    run = run.withColumn("__run", F.sum((F.col(fresh) == 0).cast("int")).over(Window.partitionBy(listing, "__i").orderBy(page)))
    done = F.max((F.col("__run") >= streak).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return run.withColumn("__d", F.coalesce(done, F.lit(0))).where("__d = 0").drop("__i", "__run", "__d")


def reachable(edges: DataFrame, roots: DataFrame, src: str, dst: str, depth: int = 3, fan: int = 3, rank: list[Column] | None = None) -> DataFrame:
    """node, depth: nodes within `depth` hops of the roots, following each node's `fan` best edges.

    Edges are ranked once; each hop is a join, and the number of hops is fixed, so nothing recurs.
    """
    order = Window.partitionBy(src).orderBy(*(rank or [F.col(dst)]))
    best = edges.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= fan).select(F.col(src).alias("node"), F.col(dst).alias("next"))
    level = roots.select(F.col(roots.columns[0]).alias("node")).distinct()
    out = level.withColumn("depth", F.lit(0))
    for k in range(1, depth + 1):
        level = level.join(best, "node").select(F.col("next").alias("node")).distinct()
        out = out.unionByName(level.withColumn("depth", F.lit(k)))
    return out.groupBy("node").agg(F.min("depth").alias("depth"))
