"""Queries over names, URLs, pages and links: text functions, matching, extraction, expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import enrich, fuzzy, match, pages, resolve
from cairn.sources.scratch import saved
from cairn.sources.tables import AS_OF, table


def labels_(spark, d):
    """Labels such as a listing has: a name, a year in brackets, noise."""
    p = table(spark, d, "part")
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    label = F.concat(F.col("p_name"), F.lit(" ("), year, F.lit(") Season "), (F.col("p_partkey") % 9).cast("string"), F.lit(" HD"))
    return p.select("p_partkey", "p_name", "p_size", "p_brand", label.alias("label"))


LABELS = "(SELECT p_partkey, p_name, p_size, p_brand, p_name || ' (' || (1950 + p_size) || ') Season ' || (p_partkey % 9) || ' HD' AS label FROM part)"


def normalise_v1(spark, d):
    """N1."""
    return table(spark, d, "documents").select("doc_id", text.normalise_v1(F.col("text")).alias("title"))


def normalise_v2(spark, d):
    """T1, over labels with signs, dots and apostrophes."""
    raw = F.concat(F.col("label"), F.lit(" & Co.'s v2.0..."))
    return labels_(spark, d).select("p_partkey", text.normalise_v2(raw).alias("title"))


def slugify(spark, d):
    """N2."""
    return labels_(spark, d).select("p_partkey", text.slugify(F.col("label")).alias("slug"))


def make_id(spark, d):
    """N3."""
    return labels_(spark, d).select("p_partkey", text.make_id(F.col("p_name"), F.col("p_size") % 4 * 500).alias("id"))


def title_case(spark, d):
    """N4."""
    return labels_(spark, d).select("p_partkey", text.title_case(F.col("p_name")).alias("title"))


def _variant(*values):
    """One of some values by part, in turns."""
    return F.element_at(F.array(*(v if hasattr(v, "alias") else F.lit(v) for v in values)), (F.col("p_partkey") % len(values) + 1).cast("int"))


def _listed(spark, d):
    """Parts as listed items: a label and a path in several spellings of the same title and year."""
    p = table(spark, d, "part").withColumn("year", (F.lit(1950) + F.col("p_size")).cast("string"))
    slug = F.regexp_replace("p_name", " ", "-")
    path = F.concat(F.lit("/"), slug, _variant(F.concat(F.lit("-"), F.col("year"), F.lit("-tamil-movie/")), "-tamil-dubbed-movie/", F.concat(F.lit("-"), F.col("year"), F.lit("-hd-1080p-movie/")), "-web-series/", F.concat(F.lit("-"), F.col("year"), F.lit("-movie-2//?page=1"))))
    label = _variant(F.concat("p_name", F.lit(" ("), "year", F.lit(") Tamil HD")), F.concat("p_name", F.lit(" "), "year", F.lit(" HD 720p")), F.concat("p_name", F.lit(" (Original HD)")), F.concat(F.lit("  "), "p_name", F.lit(" - ")), "Download Now", F.concat(F.lit("The "), "p_name", F.lit(": Part")))
    return p.select("p_partkey", "p_name", "p_size", label.alias("label"), path.alias("path"))


def title_from_path(spark, d):
    """N5, over paths in five spellings."""
    return _listed(spark, d).select("p_partkey", text.title_from_path(F.col("path")).alias("t")).select("p_partkey", "t.title", "t.year")


def clean_title(spark, d):
    """N6, over labels in six spellings."""
    return _listed(spark, d).select("p_partkey", text.clean_title(F.col("label"), F.col("path")).alias("t")).select("p_partkey", "t.title", "t.year")


def title_for(spark, d):
    """Label against path, all pairs of the spellings."""
    return _listed(spark, d).select("p_partkey", text.title_for(F.col("label"), F.col("path")).alias("t")).select("p_partkey", "t.title", "t.year")


def parse_label(spark, d):
    """Title, year, season and whether it is a series."""
    year = (F.lit(1950) + F.col("p_size")).cast("string")
    slug = F.concat(F.lit("/movie/"), F.regexp_replace("p_name", " ", "-"), F.lit("-"), year, F.lit("-season-4-tamil-dubbed-movie/"))
    label = _variant(F.concat("p_name", F.lit(" ("), year, F.lit(") Tamil Dubbed Movie (Original HD)")), F.concat("p_name", F.lit(" ("), year, F.lit(") Season 07 (Epi 9 x)")), "", F.concat("p_name", F.lit(" Season 3 Episode 2 ["), year, F.lit("]")))
    return table(spark, d, "part").select("p_partkey", text.parse_label(label, slug).alias("t")).select("p_partkey", "t.*")


def twin_base(spark, d):
    """What twins have in common."""
    t = _variant(F.concat("p_name", F.lit(" Season "), F.col("p_size").cast("string")), F.concat("p_name", F.lit(" (2020) Vol 2")), F.concat("p_name", F.lit(" part 1!")))
    return table(spark, d, "part").select("p_partkey", text.twin_base(t).alias("base"))


def log_texts(spark, d):
    """Names, durations and reasons as a log says them."""
    e = table(spark, d, "events")
    return e.select("event_id", text.display_name(F.col("event_type"), F.col("user_id") % 3).alias("name"), text.until(F.col("event_id") % 90 * 1.0).alias("until"), text.clock(F.col("event_id") * 500).alias("clock"), text.family(F.concat("event_type", F.lit(" · refresh in 5h"))).alias("family"))


def quality_bucket(spark, d):
    """N9, O1."""
    q = text.quality_bucket(F.col("p_size") * 25)
    return table(spark, d, "part").select("p_partkey", q.alias("quality"), text.quality_rank(q).cast("int").alias("rank"))


def path_key(spark, d):
    """The host-agnostic key of a page."""
    return table(spark, d, "pages").select("page_id", text.path_key(F.col("url")).alias("path"), text.canonical_url(F.col("url")).alias("canonical"))


def identity_fingerprint(spark, d):
    """P6."""
    return table(spark, d, "part").select("p_partkey", text.fingerprint(F.col("p_name"), F.col("p_brand"), F.col("p_type"), F.col("p_size")).alias("fingerprint"))


def split_credits(spark, d):
    """Names of a credit line."""
    line = F.concat_ws(", ", F.split("p_name", " ")[0], F.lit("n/a"), F.split("p_name", " ")[1], F.col("p_type"), F.split("p_name", " ")[0])
    return table(spark, d, "part").select("p_partkey", F.array_join(text.split_credits(line), "|").alias("names"))


def page_anchors(spark, d):
    """Links and labels in page order."""
    return pages.anchors(table(spark, d, "pages"))


def page_heading(spark, d):
    """The heading of a page."""
    return table(spark, d, "pages").select("page_id", pages.heading(F.col("html")).alias("heading"))


def blocked_pages(spark, d):
    """F3."""
    return table(spark, d, "pages").select("page_id", pages.blocked(F.col("html")).alias("blocked"))


def item_path_filter(spark, d):
    """paths that are an item's and no navigation, by either site's rule."""
    slug = F.regexp_replace("p_name", " ", "-")
    path = _variant(F.concat(F.lit("/"), slug, F.lit("-tamil-movie/")), F.concat(F.lit("/"), slug, F.lit("-season-3")), F.concat(F.lit("/movie/"), slug, F.lit("/")), "/tamil-2024-movies/", F.concat(F.lit("/"), slug, F.lit("/")), "/movie/123/", F.concat(F.lit("/movie/"), slug, F.lit("-collection/")))
    return table(spark, d, "part").select("p_partkey", pages.item_path(path).alias("item"), pages.item_path(path, other=True).alias("other_item"))


def listing(spark, d):
    """The items of every page, each path once, where any link in the wiki counts as an item's."""
    a = pages.anchors(table(spark, d, "pages")).where(pages.useful(F.col("href"))).join(table(spark, d, "pages").select("page_id", "url"), "page_id")
    a = a.withColumn("path", text.path_key(text.absolute_url(F.col("href"), F.col("url"))))
    return pages.first_each(a.select("page_id", "path", "pos", "label"), ["page_id", "path"], "pos")


def item_listing(spark, d):
    """Items of listing pages of parts, some links twice, to navigation, to social sites or to nowhere."""
    p = table(spark, d, "part").select("p_partkey", "p_name", F.floor(F.col("p_partkey") / 20).alias("page_id"), F.regexp_replace("p_name", " ", "-").alias("slug"))
    k = F.col("p_partkey")
    end = F.element_at(F.array(*map(F.lit, ("-tamil-movie/", "-web-series/", "-movie", "-tamil-season-2/", "/about/"))), (k % 5 + 1).cast("int"))
    href = F.when(k % 13 == 0, "/tamil-movies/a/").when(k % 17 == 0, "#top").otherwise(F.concat(F.when(k % 3 == 0, "https://h/").otherwise("/"), "slug", F.lit("-"), F.floor(k / 2).cast("string"), end))
    link = F.concat(F.lit('<li><a title="a>b" href="'), href, F.lit('">'), F.initcap("p_name"), F.when(k % 4 == 0, " Season 3").otherwise(" &amp; more"), F.lit("</a></li>"))
    html = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), link.alias("a")))), lambda x: x["a"]), "\n")
    made = p.groupBy("page_id").agg(html.alias("html")).withColumn("url", F.concat(F.lit("https://h/list/"), F.col("page_id").cast("string")))
    return pages.listing(made)


def walk_plan(spark, d):
    """Which walk each page needs by its path and links, and what a walk of the other kind of site finds there."""
    a = pages.anchors(table(spark, d, "pages")).groupBy("page_id").agg(F.count_if(F.col("href").rlike("^/[A-M]")).alias("episodes"), F.count_if(F.col("href").rlike("^/[N-Z]")).alias("seasons"), F.count("*").alias("files"))
    p = table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 7 == 0, "/x-web-series/").when(F.col("page_id") % 7 == 1, "/x-season-2").otherwise("/x-movie/").alias("path"))
    j = p.join(a, "page_id", "left").na.fill(0)
    few = lambda c: F.col(c) > 3
    return j.select("page_id", pages.plan_walk(F.col("path"), few("episodes"), few("seasons")).alias("plan"), pages.walked_shape(F.when(few("episodes"), F.col("episodes")).otherwise(0), F.when(few("seasons"), F.col("seasons")).otherwise(0), F.col("files")).alias("shape"))


def discovered(spark, d):
    """Three sources in order, each path where it came first."""
    p = table(spark, d, "part").select(F.col("p_name").alias("path"), F.col("p_partkey").cast("int").alias("pos"), "p_brand")
    return pages.discovered([p.where(f"p_brand LIKE '%{k}'") for k in (3, 1, 2)]).select("path", "source", "pos", "p_brand")


def page_posters(spark, d):
    """Pictures and files that pages name."""
    shown = F.concat("html", F.when(F.col("page_id") % 3 == 0, F.concat(F.lit('<img alt="" src="https://h/uploads/posters/'), F.col("page_id").cast("string"), F.lit('.jpg?x">'))).when(F.col("page_id") % 3 == 1, F.concat(F.lit(" /uploads/posters/"), F.col("page_id").cast("string"), F.lit(".webp "))).otherwise(""))
    return table(spark, d, "pages").select("page_id", pages.poster(shown, "https://p").alias("poster"))


def source_metadata(spark, d):
    """What a page's rows say of its work."""
    li = lambda k, v: F.concat(F.lit(f"<li><strong>{k}:</strong><span>"), v, F.lit("</span></li>"))
    html = F.concat(F.lit("<ul>"), li("Movie", F.concat("p_name", F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")"))), li("Director", F.col("p_brand")), li("Starring", F.concat("p_type", F.lit(", N/A, "), "p_brand", F.lit(" and "), "p_type")), F.lit("</ul>"))
    m = table(spark, d, "part").select("p_partkey", pages.source_metadata(html).alias("m"))
    return m.select("p_partkey", "m.available", "m.title", "m.year", F.array_join("m.directors", "|").alias("directors"), F.array_join("m.people_cast", "|").alias("people_cast"))


def episode_walk(spark, d):
    """Episodes of a supplier's parts in folders of a season and a quality, which they hand down."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("s"), F.col("l_linenumber").alias("season"), (F.col("l_partkey") % 9).cast("int").alias("episode"), F.element_at(F.array(*map(F.lit, ("1080p", "720p", "480p"))), (F.col("l_partkey") % 3 + 1).cast("int")).alias("quality"), "l_quantity").distinct()
    page = lambda *parts: F.concat_ws("/", *parts)
    row = lambda src, pos, target, label, href: li.select(src.alias("page"), pos.cast("int").alias("pos"), target.alias("target"), label.alias("label"), href.alias("href")).distinct()
    top = row(F.col("s"), F.col("season"), page("s", "season"), F.concat(F.lit("Season "), "season"), F.lit(""))
    folder_ = row(page("s", "season"), F.length("quality"), page("s", "season", "quality"), F.col("quality"), F.lit(""))
    leaf = row(page("s", "season", "quality"), F.col("l_quantity"), page("s", "season", "quality", "episode", F.col("l_quantity").cast("int")), F.lit("Play"), F.concat(F.lit("epi-"), F.col("episode").cast("string")))
    return pages.series_walk(top.unionByName(folder_).unionByName(leaf), table(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("node")), 3)


def file_walk(spark, d):
    """Files behind every order: its lines name files, or suppliers with or without a quality, and these their nation."""
    li = table(spark, d, "lineitem").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("page"), (F.col("l_linenumber") * 10_000_000 + F.col("l_suppkey")).alias("pos"), "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey").distinct()
    direct = F.col("l_orderkey") % 4 == 0
    quality = F.element_at(F.array(*map(F.lit, ("720p", "1080p", ""))), (F.col("l_linenumber") % 3 + 1).cast("int"))
    lines = li.select("page", "pos", F.when(~direct, F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("target"), F.when(direct, F.concat(F.lit("f"), F.col("l_partkey").cast("string"))).alias("file"), F.when(direct, "").otherwise(quality).alias("quality"), F.col("l_linenumber").cast("int").alias("episode")).distinct()
    s, finds = table(spark, d, "supplier"), F.col("s_suppkey") % 3 == 0
    of = lambda kind, key: F.concat(F.lit(kind), F.col(key).cast("string"))
    suppliers = s.select(of("s", "s_suppkey").alias("page"), F.lit(0).cast("long").alias("pos"), F.when(~finds, of("n", "s_nationkey")).alias("target"), F.when(finds, of("g", "s_suppkey")).alias("file"), F.when(finds, "480p").otherwise("").alias("quality"), F.lit(0).alias("episode"))
    ends = s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first")).select(of("n", "s_nationkey").alias("page"), F.lit(0).cast("long").alias("pos"), F.when(F.col("s_nationkey") % 5 > 0, of("s", "first")).alias("target"), F.when(F.col("s_nationkey") % 5 == 0, of("h", "s_nationkey")).alias("file"), F.lit("").alias("quality"), F.lit(9).alias("episode"))
    links = lines.unionByName(suppliers).unionByName(ends)
    return pages.descend(links, table(spark, d, "orders").select(of("o", "o_orderkey").alias("node")))


FILES_SQL = """WITH RECURSIVE l AS (
  SELECT DISTINCT 'o' || l_orderkey AS page, l_linenumber * 10000000 + l_suppkey AS pos, CASE WHEN l_orderkey % 4 > 0 THEN 's' || l_suppkey END AS target, CASE WHEN l_orderkey % 4 = 0 THEN 'f' || l_partkey END AS file, CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE ['720p', '1080p', ''][1 + l_linenumber % 3] END AS quality, CAST(l_linenumber AS INT) AS episode FROM lineitem
  UNION ALL SELECT 's' || s_suppkey, 0, CASE WHEN s_suppkey % 3 > 0 THEN 'n' || s_nationkey END, CASE WHEN s_suppkey % 3 = 0 THEN 'g' || s_suppkey END, CASE WHEN s_suppkey % 3 = 0 THEN '480p' ELSE '' END, 0 FROM supplier
  UNION ALL SELECT 'n' || s_nationkey, 0, CASE WHEN s_nationkey % 5 > 0 THEN 's' || min(s_suppkey) END, CASE WHEN s_nationkey % 5 = 0 THEN 'h' || s_nationkey END, '', 9 FROM supplier GROUP BY s_nationkey),
k AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY CASE quality WHEN '1080p' THEN 0 WHEN '720p' THEN 1 ELSE 9 END, pos) AS n FROM l a WHERE file IS NULL AND NOT EXISTS (FROM l b WHERE b.page = a.page AND b.file IS NOT NULL) AND (quality <> '' OR NOT EXISTS (FROM l b WHERE b.page = a.page AND b.file IS NULL AND b.quality <> ''))),
w AS (SELECT 'o' || o_orderkey AS root, 'o' || o_orderkey AS page, '720p' AS quality, 0 AS episode, CAST([] AS BIGINT[]) AS path FROM orders
  UNION ALL SELECT w.root, k.target, coalesce(nullif(k.quality, ''), w.quality), CASE WHEN k.episode > 0 THEN k.episode ELSE w.episode END, list_append(w.path, k.n) FROM w JOIN k ON k.page = w.page AND k.n <= 3 AND len(w.path) < 3)
SELECT w.root, l.file, coalesce(nullif(l.quality, ''), w.quality) AS quality, CAST(CASE WHEN l.episode > 0 THEN l.episode ELSE w.episode END AS INT) AS episode FROM w JOIN l ON l.page = w.page AND l.file IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY w.root, l.file ORDER BY list_append(w.path, CAST(l.pos AS BIGINT))) = 1"""


def shape_classifier(spark, d):
    """A page's shape by its links."""
    a = pages.anchors(table(spark, d, "pages")).groupBy("page_id").agg(F.count_if(F.col("href").rlike("^/[A-Z]")).alias("folders"), F.count("*").alias("items"))
    return a.select("page_id", pages.shape(F.col("items"), F.col("folders")).alias("shape"))


def bounded_expansion(spark, d):
    """Parts within three hops of part 0, three best edges each."""
    li = table(spark, d, "lineitem").select(F.col("l_suppkey").alias("src"), (F.col("l_partkey") % 100).alias("dst")).distinct()
    roots = table(spark, d, "supplier").where("s_suppkey = 0").select("s_suppkey")
    return pages.reachable(li, roots, "src", "dst")


def http_retry_class(spark, d):
    """Whether a status is worth another try."""
    status = F.element_at(F.array(*map(F.lit, (200, 301, 404, 408, 429, 500, 503))), (F.col("event_id") % 7 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", text.retryable(status).alias("class"))


def pagination_cut(spark, d):
    """Pages read until the first without anything new. A user's days are pages, types are items."""
    e = table(spark, d, "events").select(F.col("user_id").alias("listing"), F.dayofmonth("ts").alias("page"), (F.get_json_object("props", "$.k").cast("int") % 9).alias("path"))
    return pages.listing_cut(e, "listing", "page", "path")


def barren_streak(spark, d):
    """Days read until the third in a row without a purchase, that day included."""
    e = table(spark, d, "events").groupBy(F.col("user_id").alias("listing"), F.dayofmonth("ts").alias("page")).agg(F.count_if(F.col("event_type") == "purchase").alias("fresh"))
    return pages.barren_cut(e, "listing", "page", "fresh").groupBy("listing").agg(F.count("*").alias("pages"), F.sum("fresh").alias("fresh"))


def _candidates(spark, d):
    """Parts of odd keys as entities of two types, with a second title."""
    none = F.lit(None).cast("string")
    c = table(spark, d, "part").where("p_partkey % 2 = 1")
    kind = F.when(F.col("p_partkey") % 6 == 1, "tv").otherwise("movie")
    date = F.concat((F.lit(1950) + F.col("p_size")).cast("string"), F.lit("-06-01"))
    return c.select(F.col("p_partkey").alias("id"), kind.alias("type"), F.when(kind == "movie", F.col("p_name")).alias("title"), F.concat_ws(" ", "p_brand", "p_name").alias("original_title"), F.when(kind == "tv", F.col("p_name")).alias("name"), none.alias("original_name"), F.array(F.concat("p_name", F.lit(" II"))).alias("alternatives"), date.alias("release_date"), date.alias("first_air_date"), F.array(F.struct(F.lit(2).alias("season_number"), F.concat((F.lit(1951) + F.col("p_size")).cast("string"), F.lit("-01-01")).alias("air_date"), F.lit("/s").alias("poster_path"))).alias("seasons"), F.lit("/g").alias("poster_path"))


def _records(spark, d):
    """Parts of even keys as records that look for their entity."""
    p = table(spark, d, "part").where("p_partkey % 2 = 0")
    return p.select(F.col("p_partkey").alias("record"), "p_name", F.upper("p_name").alias("title"), (F.lit(1950) + F.col("p_size")).alias("year"), F.when(F.col("p_partkey") % 4 == 0, "series").otherwise("movie").alias("kind"), F.when(F.col("p_partkey") % 10 == 0, F.col("p_partkey") + 1).when(F.col("p_partkey") % 10 == 2, F.col("p_partkey") + 100_001).otherwise(0).alias("tmdb_id"))


def unique_exact_match(spark, d):
    """Records with just one movie of their title, under any of its titles, and year."""
    return resolve.pick(_records(spark, d), _candidates(spark, d), "movie").withColumnRenamed("record", "p_partkey")


def alternative_match(spark, d):
    """T4, T5: the same by an official alternative, and without blanks."""
    r = _records(spark, d)
    alias = resolve.pick(r.withColumn("title", F.concat("p_name", F.lit(" ii"))), _candidates(spark, d), "movie", alternatives=True).withColumn("how", F.lit("alternative"))
    return alias.unionByName(resolve.pick(r.withColumn("title", F.regexp_replace("p_name", " ", "")), _candidates(spark, d), "movie", compact=True).withColumn("how", F.lit("compact")))


def season_year_match(spark, d):
    """The show whose second season was aired in the record's year, with the season's poster."""
    r = _records(spark, d).select("record", F.concat("p_name", F.lit(" Season 2")).alias("title"), "year", F.lit(0).alias("season"))
    return resolve.season_pick(r, _candidates(spark, d))


def resolution_chain(spark, d):
    """The stored id, the id in the other type, the unique match of the own type, of a show, or what the record had."""
    out = resolve.resolve(_records(spark, d), _candidates(spark, d), verify_ids=True)
    return out.select(F.col("record").alias("p_partkey"), F.col("candidate").alias("match"), "type", "how")


def composed_enrichment(spark, d):
    """E1, E2, E7, S13, T3, J11, J12, M4, M8 as one plan: parts that look for their entity, with evidence of their pages.
    Both sides are dealt out first: parts lie dense in one file, which few tasks would read for every step."""
    r = saved(_records(spark, d).repartition("record"), "records")
    n = F.col("record")
    texts = {c: F.lit("") for c in ("category", "language", "category_source", "poster", "imdb_id", "added_at")}
    catalogue = r.select(n.alias("id"), "title", "year", "kind", *(c.alias(k) for k, c in texts.items()), F.concat(F.lit("https://h/"), n.cast("string"), F.lit("/")).alias("page_url"), F.lit(0.0).alias("rating"), "tmdb_id", F.lit("i").alias("identity"), (n % 46 == 0).alias("trouble"))
    name = lambda kind, k: F.concat(F.lit(f"{kind} "), (k % 5).cast("string"))
    source = r.where("record % 14 <> 4").select(F.concat(F.lit("http://other/"), n.cast("string"), F.lit("?x")).alias("source_url"), (F.lit(AS_OF).cast("timestamp") - F.make_dt_interval(days=(n % 9).cast("int"))).alias("fetched_at"), (n % 22 != 0).alias("available"), F.col("p_name").alias("title"), (F.col("year") - F.when(n % 6 == 0, 1).otherwise(0)).alias("year"), F.array().cast("array<string>").alias("directors"), F.when(n % 26 == 0, F.array().cast("array<string>")).otherwise(F.array(name("anna", F.floor(n / 2)), name("bert", F.floor(n / 2)))).alias("people_cast"))
    c = saved(_candidates(spark, d).repartition("id"), "candidates").withColumn("language", F.when(F.col("id") % 10 < 5, "ta").otherwise("en")).withColumn("vote_average", F.lit(5.0)).withColumn("imdb_id", F.concat(F.lit("tt"), F.col("id").cast("string"))).withColumn("poster_path", F.lit("/p"))
    person = lambda kind, k: c.select(F.col("id").alias("candidate"), F.lit(k).alias("person"), name(kind, F.floor(F.col("id") / 2)).alias("name"), F.lit(False).alias("director"))
    people = person("Anna", 1).unionByName(person("Bert", 2))
    o = c.where("id % 34 = 1").select((F.col("id") - 1).alias("id"), F.col("id").alias("tmdb_id"), F.col("type").alias("tmdb_type"), F.when(F.col("id") % 4 == 1, "Other").otherwise(F.coalesce("title", "name")).alias("expected_title"))
    attempts = r.where("record % 8 = 0").select(n.alias("id"), F.lit(2).alias("version"), F.lit("i").alias("identity"), (n % 3).cast("int").alias("attempts"))
    done, entries = enrich.enriched(catalogue, c, source, people, o, attempts, F.lit(AS_OF).cast("timestamp"))
    e = entries.select("id", "status", "reason", "attempts", F.timestamp_diff("HOUR", "checked_at", "next_at").alias("hours"))
    return done.select("id", "tmdb_id", "imdb_id", "poster", "language", "category", "changed").join(e, "id", "left")


ENRICHED_SQL = """, s AS (SELECT r.record, c.type, min(c.id) AS id FROM r JOIN c ON r.year = c.year AND r.t IN (c.t, regexp_replace(c.o, '[^a-z0-9]+', ' ', 'g')) GROUP BY 1, 2 HAVING count(DISTINCT c.id) = 1),
j AS (SELECT r.*, k.id AS k_id, k.type AS k_type, k.t AS k_t, a.id AS a_id, b.id AS b_id FROM r LEFT JOIN c k ON k.id = r.tmdb LEFT JOIN s a ON a.record = r.record AND a.type = r.own LEFT JOIN s b ON b.record = r.record AND b.type = 'tv' AND r.own = 'movie'),
h AS (SELECT *, CASE WHEN k_id IS NOT NULL AND k_type = own THEN 'id' WHEN k_id IS NOT NULL AND k_t = t THEN 'cross' WHEN a_id IS NOT NULL THEN 'search' WHEN b_id IS NOT NULL THEN 'search-tv' ELSE 'none' END AS how FROM j),
l AS (SELECT *, CASE WHEN how IN ('id', 'cross') THEN k_id WHEN how = 'search' THEN a_id WHEN how = 'search-tv' THEN b_id END AS cand, CASE WHEN how IN ('id', 'search') THEN own WHEN how = 'cross' THEN k_type WHEN how = 'search-tv' THEN 'tv' END AS type,
  tmdb > 0 AS trusted, record % 46 = 0 AS trouble, record % 14 <> 4 AND record % 22 <> 0 AND record % 9 < 7 AS known, record % 26 <> 0 AS named, record % 6 = 0 AS other_year FROM h),
f AS (SELECT l.record, min(c.id) AS told FROM l JOIN c ON known AND c.type = l.own AND l.year - CASE WHEN other_year THEN 1 ELSE 0 END = c.year AND l.t IN (c.t, regexp_replace(c.o, '[^a-z0-9]+', ' ', 'g')) GROUP BY 1 HAVING count(DISTINCT c.id) = 1),
v AS (SELECT l.*, cand IS NOT NULL AS found, known AND named AND cand IS NOT NULL AND (cand // 2) % 5 = (record // 2) % 5 AS strong, known AND named AND cand IS NOT NULL AND (cand // 2) % 5 <> (record // 2) % 5 AS against, CASE WHEN named AND (told // 2) % 5 = (record // 2) % 5 THEN told END AS told FROM l LEFT JOIN f USING (record)),
w AS (SELECT *, found AND (trusted OR NOT (known AND named AND (against OR (other_year AND NOT strong)))) AS stands FROM v),
d AS (SELECT w.*, CASE WHEN trusted THEN CASE WHEN found THEN 'accept' ELSE 'unresolved' END WHEN (trouble AND NOT found) OR NOT known THEN 'unavailable' WHEN stands OR told IS NOT NULL THEN 'accept' WHEN found AND named AND against THEN 'review' ELSE 'unresolved' END AS verdict, o.id AS o_id, o.type AS o_type FROM w LEFT JOIN c o ON o.id = w.record + 1 AND o.id % 34 = 1),
x AS (SELECT *, CASE WHEN o_id IS NOT NULL THEN CASE WHEN o_id % 4 = 1 THEN 'review' ELSE 'matched' END WHEN verdict = 'accept' THEN 'matched' ELSE verdict END AS status0,
  CASE WHEN o_id IS NOT NULL THEN CASE WHEN o_id % 4 = 1 THEN 'override-conflict' ELSE 'reviewed-override' END WHEN verdict = 'accept' THEN CASE WHEN NOT stands THEN 'source-evidence' WHEN NOT trusted AND strong THEN 'source-credits' ELSE how END WHEN verdict = 'review' THEN 'source-credits-conflict' WHEN verdict = 'unavailable' THEN CASE WHEN trouble THEN 'lookup-failed' ELSE 'source-unavailable' END ELSE 'no-safe-match' END AS reason,
  CASE WHEN o_id IS NOT NULL THEN CASE WHEN o_id % 4 <> 1 AND o_type = own THEN o_id END WHEN verdict = 'accept' THEN CASE WHEN stands THEN cand ELSE told END END AS m_id FROM d),
y AS (SELECT x.*, c.type AS m_type, CASE WHEN m_id % 10 < 5 THEN 'ta' ELSE 'en' END AS m_lang, m_id IS NOT NULL AND (tmdb = 0 OR (o_id IS NOT NULL AND tmdb <> m_id) OR (o_id IS NULL AND how = 'cross' AND tmdb <> m_id)) AS takes FROM x LEFT JOIN c ON c.id = m_id),
z AS (SELECT *, CASE WHEN takes THEN m_id ELSE tmdb END AS tmdb_id, coalesce(m_lang, '') AS language FROM (SELECT * REPLACE (CASE WHEN m_id IS NOT NULL THEN m_lang END AS m_lang) FROM y))
SELECT record AS id, tmdb_id, CASE WHEN m_id IS NOT NULL THEN 'tt' || m_id ELSE '' END AS imdb_id, CASE WHEN m_id IS NOT NULL THEN '/p' ELSE '' END AS poster, language, CASE WHEN m_id IS NOT NULL THEN CASE WHEN m_lang = 'ta' THEN 'tamil-' ELSE 'tamil-dubbed-' END || CASE WHEN m_type = 'tv' THEN 'series' ELSE 'movie' END ELSE '' END AS category, m_id IS NOT NULL AS changed,
  status0 AS status, reason, CAST(CASE WHEN record % 8 = 0 THEN record % 3 + 1 ELSE 1 END AS INT) AS attempts, CAST(CASE status0 WHEN 'matched' THEN 720 WHEN 'unavailable' THEN [1, 6, 24][CASE WHEN record % 8 = 0 THEN record % 3 + 1 ELSE 1 END] WHEN 'review' THEN [168, 720][least(2, CASE WHEN record % 8 = 0 THEN record % 3 + 1 ELSE 1 END)] ELSE [6, 24, 72, 168][CASE WHEN record % 8 = 0 THEN record % 3 + 1 ELSE 1 END] END AS BIGINT) AS hours FROM z"""


def similar_titles(spark, d):
    """Different titles of parts that are nearly the same, against all of them misspelled, by an index."""
    t = table(spark, d, "part").select(F.concat_ws(" ", "p_name", F.lit("of"), "p_type", F.element_at(F.array(*map(F.lit, ROMANS)), (F.col("p_size") % 4 + 2).cast("int"))).alias("title"), (F.col("p_size") % 4 + 2).alias("k")).distinct()
    other = t.select(F.concat(F.regexp_replace(F.substring_index("title", " ", 4), "[lo]", "e"), F.lit(" "), F.col("k").cast("string")).alias("title"))
    out = fuzzy.similar_titles(t.select("title"), other, "title", 0.8)
    return out.select("a", "b", F.round("similarity", 6).alias("similarity"))


def rival_titles(spark, d):
    """Titles that a candidate's begins with, if its credits are strong and no rival begins alike."""
    p = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") - F.when(F.col("p_size") % 3 == 0, F.col("p_partkey") % 2).otherwise(0)).alias("k"), "p_type", "p_size")
    head = F.concat(F.lit("Saga "), F.col("k").cast("string"))
    c = p.select(F.col("p_partkey").alias("id"), F.concat(head, F.lit(": "), "p_type").alias("title"), F.lit(None).cast("string").alias("name"))
    r = p.select(F.col("p_partkey").alias("record"), F.concat(F.lit("SAGA "), F.col("p_partkey").cast("string")).alias("title"))
    strong = p.where("p_size > 10").select(F.col("k").alias("record"), F.col("p_partkey").alias("candidate"))
    return resolve.subtitle_pick(r, c, strong)


def override_outcome(spark, d):
    """Reviewed mappings, some with a wrong title, some to nothing."""
    c = _candidates(spark, d)
    o = c.select((F.col("id") - 1).alias("id"), F.when(F.col("id") % 5 == 0, F.col("id") + 1).otherwise(F.col("id")).alias("tmdb_id"), F.col("type").alias("tmdb_type"), F.when(F.col("id") % 7 == 0, "Other").otherwise(F.coalesce("title", "name")).alias("expected_title"))
    return resolve.override_outcome(_records(spark, d), o, c)


def lookup_notes(spark, d):
    """The first thirty notes of a lookup, of them the last twelve, the last reason, and whether to review."""
    e = table(spark, d, "events").select(F.col("user_id").alias("record"), F.col("event_id").alias("seq"), F.when(F.col("event_type") == "signup", "media-type-conflict").otherwise(F.col("event_type")).alias("reason"))
    return resolve.noted(e).select("record", F.array_join("notes", ",").alias("notes"), "reason", "review")


def search_outcome(spark, d):
    """Failed and truncated searches are no misses; regional shows are not guessed."""
    e = table(spark, d, "events")
    status = resolve.search_status(F.col("event_type") == "purchase", F.col("event_type") != "error", F.col("event_id") % 8)
    language = F.when(F.col("event_id") % 3 == 0, "ta").when(F.col("event_id") % 3 == 1, "te").otherwise("")
    return e.select("event_id", status.alias("status"), resolve.regional_ambiguous(F.col("event_id") % 2 == 0, language, F.lit("te"), F.col("user_id") % 5 > 0).alias("ambiguous"))


def credit_evidence(spark, d):
    """Suppliers of an order as people: names found in the cast or as director count people once."""
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("record"), F.lit(0).alias("candidate"), (F.col("l_suppkey") % 50).cast("string").alias("name"), (F.col("l_linenumber") == 1).alias("director"))
    people = table(spark, d, "supplier").select((F.col("s_suppkey") % 50).alias("n"), F.col("s_nationkey").alias("person")).where("n < 25").groupBy("n").agg(F.min("person").alias("person"))
    people = people.select(F.lit(0).alias("candidate"), "person", F.col("n").cast("string").alias("name"), F.explode(F.array(F.lit(True), F.lit(False))).alias("director"))
    out = resolve.credits(li, people)
    return out.select("record", F.when(F.col("strong"), "strong").when(F.col("contradiction"), "contradiction").otherwise("weak").alias("verdict"))


CREDIT_SQL = """WITH p AS (SELECT s_suppkey % 50 AS name, min(s_nationkey) AS person FROM supplier WHERE s_suppkey % 50 < 25 GROUP BY 1),
h AS (SELECT l_orderkey AS record, l_linenumber = 1 AS director, person FROM lineitem LEFT JOIN p ON p.name = l_suppkey % 50),
g AS (SELECT record, count(DISTINCT person) FILTER (NOT director) AS actors, count(DISTINCT person) AS people, count(DISTINCT person) FILTER (director) AS directors FROM h GROUP BY ALL)
SELECT record, CASE WHEN actors >= 2 OR (actors >= 1 AND directors >= 1 AND people >= 2) THEN 'strong' WHEN people = 0 THEN 'contradiction' ELSE 'weak' END AS verdict FROM g"""


def title_similarity(spark, d):
    """Similarity of neighbouring parts' titles, whose sequels are counted in digits, in Roman numerals or in words."""
    n = F.col("p_size") % 3 + F.when(F.col("p_partkey") % 10 < 7, 2).otherwise(5)
    named = lambda forms: F.element_at(F.array(*(F.lit(x) for x in forms)), n.cast("int"))
    number = F.when(F.col("p_partkey") % 3 == 0, n.cast("string")).when(F.col("p_partkey") % 3 == 1, named(ROMANS)).otherwise(named(SPELLED))
    p = table(spark, d, "part").select("p_partkey", F.concat(F.element_at(F.split("p_name", " "), 1), F.lit(" saga "), number).alias("title"))
    q = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("title").alias("other"))
    return p.join(q, "p_partkey").select("p_partkey", F.round(text.title_similarity(F.col("title"), F.col("other")), 6).alias("similarity"))


ROMANS, SPELLED = ("I", "II", "III", "IV", "V", "VI", "VII"), ("One", "Two", "Three", "Four", "Five", "Six", "Seven")


def evidence_decision(spark, d):
    """E1 over the credit verdicts."""
    c = credit_evidence(spark, d)
    on = lambda n, k=0: F.col("record") % n == k
    v = resolve.evidence_outcome(on(29), on(31), ~on(3), on(7), ~on(11), on(2), F.col("verdict") == "contradiction", F.col("verdict") == "strong", F.when(on(4), 2020).otherwise(2023), F.lit(2023), on(13), on(5), on(17))
    return c.select("record", v.alias("decision"))


def outcome_status(spark, d):
    """The status and the reason of each lookup."""
    e = table(spark, d, "events")
    o = resolve.outcome(F.col("event_type") != "error", F.col("event_type") == "purchase", F.when(F.col("event_id") % 4 > 0, "ta"), F.when(F.col("event_id") % 3 > 0, "exact"), F.col("event_type") == "signup", F.when(F.col("event_id") % 5 > 0, "noted"), F.col("event_id") % 6 == 0)
    return e.select("event_id", o.alias("o")).select("event_id", "o.status", "o.reason")


def title_guard(spark, d):
    """documents whose first words stand in the neighbour's text."""
    t = table(spark, d, "documents").select("doc_id", F.lower("text").alias("t"), F.lower("text").alias("w"))
    other = t.select((F.col("doc_id") - 1).alias("doc_id"), F.col("t").alias("o"))
    return t.join(other, "doc_id").select("doc_id", match.title_guard(F.col("w"), F.col("o")).alias("same"))


def override_validation(spark, d):
    """Why reviewed overrides are refused."""
    p = table(spark, d, "part")
    urls = F.when(F.col("p_size") % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.when(F.col("p_size") % 5 == 1, "http").otherwise("https"), F.lit("://x/"), F.col("p_partkey").cast("string"))))
    kind = F.when(F.col("p_size") % 3 == 0, "movie").when(F.col("p_size") % 3 == 1, "tv").otherwise("other")
    fault = match.override_fault(F.col("p_partkey"), kind, F.col("p_name"), F.when(F.col("p_size") % 7 > 0, F.col("p_brand")), urls)
    return p.select("p_partkey", fault.alias("fault"))


QUERIES = {f.__name__: f for f in (normalise_v1, normalise_v2, slugify, make_id, title_case, title_from_path, clean_title, title_for, parse_label, twin_base, log_texts, quality_bucket, path_key, identity_fingerprint, split_credits, page_anchors, page_heading, blocked_pages, item_path_filter, listing, item_listing, walk_plan, discovered, page_posters, source_metadata, episode_walk, file_walk, shape_classifier, bounded_expansion, http_retry_class, pagination_cut, barren_streak, unique_exact_match, alternative_match, season_year_match, resolution_chain, composed_enrichment, similar_titles, rival_titles, override_outcome, lookup_notes, search_outcome, credit_evidence, title_similarity, evidence_decision, outcome_status, title_guard, override_validation)}

_CASE = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(w[1]) || w[2:]), ' ')"
_PATH = "regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1)"
_ENCODED = "url_encode({})"
for _ch in "/,!'():;=@&+$*":
    _ENCODED = "replace(" + _ENCODED + f", '%{ord(_ch):02X}', '" + _ch.replace("'", "''") + "')"
_KEY = f"regexp_replace({_PATH}, '/+$', '') || '/'"
_SLUG = "regexp_replace(regexp_replace(regexp_replace(lower({}), '\\([^)]*\\)', ' ', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"
_V1 = "trim(regexp_replace(lower({}), '[^a-z0-9]+', ' ', 'g'))"
_PAIR = "WITH a AS (SELECT * FROM part WHERE p_partkey % 2 = 0), b AS (SELECT * FROM part WHERE p_partkey % 2 = 1)"
_A = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))[^>]*>(.*?)</a>"""
_ANCHORS = f"(SELECT page_id, url, unnest(regexp_extract_all(html, '{_A}', 0)) AS a, generate_subscripts(regexp_extract_all(html, '{_A}', 0), 1) - 1 AS pos FROM pages)"
_HREF = f"regexp_extract(a, '{_A}', 1) || regexp_extract(a, '{_A}', 2) || regexp_extract(a, '{_A}', 3)"
_PLAIN = "trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace({}, '<[^>]*>', '', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&'), '\\s+', ' ', 'g'))"
_LISTED = """(SELECT p_partkey, p_name, p_partkey % 5 AS v, p_partkey % 6 AS w, 1950 + p_size AS y, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS cased FROM part)"""
_OWN = "CASE w WHEN 4 THEN NULL WHEN 5 THEN 'The ' || p_name || ': Part' ELSE p_name END"
_OWN_YEAR = "CASE WHEN w <= 1 THEN y ELSE 0 END"
_PATH_YEAR = "CASE WHEN v IN (1, 3) THEN 0 ELSE y END"
_TEXT = "nullif(" + _PLAIN.format("regexp_extract(html, '(?is)<{0}\\b[^>]*>(.*?)</{0}>', 1)") + ", '')"

_RC = """WITH c AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 6 = 1 THEN 'tv' ELSE 'movie' END AS type, lower(p_name) AS t, lower(p_brand || ' ' || p_name) AS o, 1950 + p_size AS year FROM part WHERE p_partkey % 2 = 1), r AS (SELECT p_partkey AS record, lower(p_name) AS t, 1950 + p_size AS year, CASE WHEN p_partkey % 4 = 0 THEN 'tv' ELSE 'movie' END AS own, CASE p_partkey % 10 WHEN 0 THEN p_partkey + 1 WHEN 2 THEN p_partkey + 100001 ELSE 0 END AS tmdb FROM part WHERE p_partkey % 2 = 0)"""

SQL = {
    "normalise_v1": f"SELECT doc_id, {_V1.format('text')} AS title FROM documents",
    "normalise_v2": f"SELECT p_partkey, trim(regexp_replace(lower(p_name || ' ' || (1950 + p_size) || ' Season ' || (p_partkey % 9) || ' HD and Co s v2.0'), '[^a-z0-9.]+', ' ', 'g')) AS title FROM {LABELS}",
    "slugify": f"SELECT p_partkey, {_SLUG.format('label')} AS slug FROM {LABELS}",
    "make_id": f"SELECT p_partkey, {_SLUG.format('p_name')} || CASE WHEN p_size % 4 > 0 THEN '-' || (p_size % 4 * 500) ELSE '' END AS id FROM part",
    "title_case": f"SELECT p_partkey, {_CASE.format('p_name')} AS title FROM part",
    "title_from_path": f"SELECT p_partkey, cased AS title, CAST({_PATH_YEAR} AS INT) AS year FROM {_LISTED}",
    "clean_title": f"SELECT p_partkey, coalesce(CASE w WHEN 4 THEN 'Download Now' END, {_OWN}) AS title, CAST({_OWN_YEAR} AS INT) AS year FROM {_LISTED}",
    "parse_label": "SELECT p_partkey, CASE p_partkey % 4 WHEN 2 THEN array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') ELSE p_name END AS title, CAST(1950 + p_size AS INT) AS year, p_partkey % 4 > 0 AS is_series, CAST([0, 7, 4, 3][p_partkey % 4 + 1] AS INT) AS season FROM part",
    "quality_bucket": "SELECT p_partkey, CASE WHEN h >= 1000 THEN '1080p' WHEN h >= 700 THEN '720p' WHEN h >= 460 THEN '480p' WHEN h >= 340 THEN '360p' ELSE 'other' END AS quality, CAST(CASE WHEN h >= 1000 THEN 0 WHEN h >= 700 THEN 1 WHEN h >= 460 THEN 2 WHEN h >= 340 THEN 3 ELSE 4 END AS INT) AS rank FROM (SELECT p_partkey, p_size * 25 AS h FROM part)",
    "path_key": f"SELECT page_id, {_KEY} AS path, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages",
    "identity_fingerprint": "SELECT p_partkey, substr(sha256(p_name || '|' || p_brand || '|' || p_type || '|' || p_size), 1, 20) AS fingerprint FROM part",
    "split_credits": "SELECT p_partkey, a || CASE WHEN b = a THEN '' ELSE '|' || b END || CASE WHEN p_type IN (a, b) THEN '' ELSE '|' || p_type END AS names FROM (SELECT p_partkey, p_type, string_split(p_name, ' ')[1] AS a, string_split(p_name, ' ')[2] AS b FROM part)",
    "page_anchors": f"SELECT page_id, CAST(pos AS INT) AS pos, {_HREF} AS href, " + _PLAIN.format(f"regexp_extract(a, '{_A}', 4)") + f" AS label FROM {_ANCHORS}",
    "page_heading": f"SELECT page_id, coalesce({_TEXT.format('h1')}, {_TEXT.format('title')}) AS heading FROM pages",
    "blocked_pages": "SELECT page_id, regexp_matches(html[1:4000], '(?i)just a moment|verify you are human|checking your browser|access denied|attention required|cf-error|error 10[0-9][0-9]') AS blocked FROM pages",
    "item_path_filter": "SELECT p_partkey, p_partkey % 7 <= 1 AS item, p_partkey % 7 = 2 AS other_item FROM part",
    "shape_classifier": f"""SELECT page_id, CASE WHEN count(*) FILTER (regexp_matches(regexp_extract(a, 'href="([^"]*)"', 1), '^/[A-Z]')) > 0 THEN 'folders' WHEN count(*) > 1 THEN 'list' ELSE 'leaf' END AS shape FROM {_ANCHORS} GROUP BY page_id""",
    "bounded_expansion": """WITH RECURSIVE e AS (SELECT DISTINCT l_suppkey AS src, l_partkey % 100 AS dst FROM lineitem), b AS (SELECT src, dst FROM e QUALIFY row_number() OVER (PARTITION BY src ORDER BY dst) <= 3),
r AS (SELECT s_suppkey AS node, CAST(0 AS INT) AS depth FROM supplier WHERE s_suppkey = 0 UNION SELECT dst, depth + 1 FROM r JOIN b ON src = node WHERE depth < 3)
SELECT node, min(depth) AS depth FROM r GROUP BY node""",
    "http_retry_class": "SELECT event_id, CASE WHEN s BETWEEN 200 AND 399 THEN 'ok' WHEN s IN (408, 429) OR s NOT BETWEEN 400 AND 499 THEN 'retry' ELSE 'fail' END AS class FROM (SELECT event_id, [200, 301, 404, 408, 429, 500, 503][event_id % 7 + 1] AS s FROM events)",
    "pagination_cut": """WITH e AS (SELECT user_id AS listing, day(ts) AS page, CAST(props->>'$.k' AS INT) % 9 AS path FROM events), f AS (SELECT listing, path, min(page) AS page FROM e GROUP BY ALL),
p AS (SELECT listing, page, (SELECT count(*) FROM f WHERE f.listing = q.listing AND f.page = q.page) AS fresh FROM (SELECT DISTINCT listing, page FROM e) q),
s AS (SELECT listing, min(page) FILTER (fresh = 0) AS cut FROM p GROUP BY listing)
SELECT listing, count(*) AS pages, CAST(sum(fresh) AS BIGINT) AS items FROM p JOIN s USING (listing) WHERE cut IS NULL OR page < cut GROUP BY listing""",
    "barren_streak": """WITH p AS (SELECT user_id AS listing, day(ts) AS page, count(*) FILTER (event_type = 'purchase') AS fresh FROM events GROUP BY ALL),
t AS (SELECT *, fresh = 0 AND lag(fresh) OVER w = 0 AND lag(fresh, 2) OVER w = 0 AS third FROM p WINDOW w AS (PARTITION BY listing ORDER BY page)),
c AS (SELECT listing, min(page) FILTER (third) AS cut FROM t GROUP BY listing)
SELECT listing, count(*) AS pages, CAST(sum(fresh) AS BIGINT) AS fresh FROM p JOIN c USING (listing) WHERE cut IS NULL OR page <= cut GROUP BY listing""",
    "unique_exact_match": f"{_RC} SELECT r.record AS p_partkey, min(c.id) AS candidate FROM r JOIN c ON c.type = 'movie' AND r.year = c.year AND (r.t = c.t OR r.t = regexp_replace(c.o, '[^a-z0-9]+', ' ', 'g')) GROUP BY 1 HAVING count(DISTINCT c.id) = 1",
    "season_year_match": f"{_RC} SELECT r.record, min(c.id) AS candidate, '/s' AS poster FROM r JOIN c ON c.type = 'tv' AND r.year = c.year + 1 AND r.t = c.t GROUP BY 1 HAVING count(DISTINCT c.id) = 1",
    "resolution_chain": f"""{_RC}, s AS (SELECT r.record, c.type, min(c.id) AS id FROM r JOIN c ON r.year = c.year AND r.t IN (c.t, regexp_replace(c.o, '[^a-z0-9]+', ' ', 'g')) GROUP BY 1, 2 HAVING count(DISTINCT c.id) = 1),
j AS (SELECT r.*, k.id AS k_id, k.type AS k_type, k.t AS k_t, a.id AS a_id, b.id AS b_id FROM r LEFT JOIN c k ON k.id = r.tmdb LEFT JOIN s a ON a.record = r.record AND a.type = r.own LEFT JOIN s b ON b.record = r.record AND b.type = 'tv' AND r.own = 'movie'),
h AS (SELECT *, CASE WHEN k_id IS NOT NULL AND k_type = own AND k_t = t THEN 'id' WHEN k_id IS NOT NULL AND k_type <> own AND k_t = t THEN 'cross' WHEN a_id IS NOT NULL THEN 'search' WHEN b_id IS NOT NULL THEN 'search-tv' WHEN k_id IS NOT NULL AND k_type = own THEN 'kept' ELSE 'none' END AS how FROM j)
SELECT record AS p_partkey, CASE WHEN how IN ('id', 'cross', 'kept') THEN k_id WHEN how = 'search' THEN a_id WHEN how = 'search-tv' THEN b_id END AS match, CASE WHEN how IN ('id', 'search', 'kept') THEN own WHEN how = 'cross' THEN k_type WHEN how = 'search-tv' THEN 'tv' END AS type, how FROM h""",
    "composed_enrichment": _RC + ENRICHED_SQL,
    "similar_titles": """WITH t AS (SELECT DISTINCT p_name || ' of ' || p_type AS n, p_size % 4 + 2 AS k FROM part), a AS (SELECT n || ' ' || ['II', 'III', 'IV', 'V'][k - 1] AS title, lower(n) || ' ' || k AS t, k FROM t), b AS (SELECT DISTINCT regexp_replace(n, '[lo]', 'e', 'g') || ' ' || k AS title, k FROM t)
SELECT a.title AS a, b.title AS b, round(1 - levenshtein(a.t, lower(b.title)) / CAST(greatest(length(a.t), length(b.title)) AS DOUBLE), 6) AS similarity FROM a JOIN b USING (k) WHERE 1 - levenshtein(a.t, lower(b.title)) / CAST(greatest(length(a.t), length(b.title)) AS DOUBLE) >= 0.8 - 1e-12""",
    "rival_titles": """WITH p AS (SELECT p_partkey AS id, p_partkey - CASE WHEN p_size % 3 = 0 THEN p_partkey % 2 ELSE 0 END AS k, p_size FROM part), o AS (SELECT k, min(id) AS id FROM p GROUP BY k HAVING count(*) = 1)
SELECT r.p_partkey AS record, o.id AS candidate FROM part r JOIN o ON o.k = r.p_partkey JOIN p ON p.id = o.id WHERE p.p_size > 10""",
    "credit_evidence": CREDIT_SQL,
    "title_similarity": """WITH t AS (SELECT p_partkey, p_size % 3 + CASE WHEN p_partkey % 10 < 7 THEN 2 ELSE 5 END AS k, string_split(p_name, ' ')[1] || ' saga ' || (p_size % 3 + CASE WHEN p_partkey % 10 < 7 THEN 2 ELSE 5 END) AS title FROM part)
SELECT a.p_partkey, round(CASE WHEN a.title = b.title THEN 1.0 WHEN a.k <> b.k OR least(length(a.title), length(b.title)) < 8 THEN 0.0 ELSE 1 - levenshtein(a.title, b.title) / CAST(greatest(length(a.title), length(b.title)) AS DOUBLE) END, 6) AS similarity FROM t a JOIN t b ON b.p_partkey = a.p_partkey + 1""",
    "evidence_decision": f"""WITH v AS ({CREDIT_SQL}), x AS (SELECT *, record % 3 <> 0 AS found, record % 2 = 0 AND verdict = 'contradiction' AS against, record % 13 = 0 AS scoped, record % 2 = 0 AND record % 4 = 0 AND verdict <> 'strong' AS other_year FROM v)
SELECT record, CASE WHEN record % 29 = 0 OR record % 31 = 0 THEN CASE WHEN found THEN 'accept' ELSE 'unresolved' END WHEN record % 7 = 0 OR record % 11 = 0 THEN 'unavailable' WHEN found AND NOT against AND NOT other_year AND NOT scoped THEN 'accept'
WHEN record % 17 = 0 THEN 'review' WHEN record % 5 = 0 THEN 'accept' WHEN found AND against THEN 'review' WHEN scoped THEN 'unavailable' ELSE 'unresolved' END AS decision FROM x""",
    "outcome_status": """WITH s AS (SELECT *, CASE event_type WHEN 'error' THEN 'unavailable' WHEN 'purchase' THEN 'matched' WHEN 'signup' THEN 'review' ELSE 'unresolved' END AS status FROM events)
SELECT event_id, status, CASE WHEN event_id % 6 = 0 AND status = 'unavailable' THEN 'lookup-timeout' WHEN status = 'matched' THEN CASE WHEN event_id % 4 = 0 THEN 'original-language-missing' WHEN event_id % 3 > 0 THEN 'exact' ELSE 'matched' END WHEN event_id % 5 > 0 THEN 'noted' WHEN status = 'unavailable' THEN 'lookup-incomplete' ELSE 'no-safe-match' END AS reason FROM s""",
    "title_guard": "SELECT a.doc_id, len(list_filter(list_filter(string_split(lower(a.text), ' '), lambda w: length(w) > 3)[1:3], lambda w: NOT contains(lower(b.text), w))) = 0 AS same FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1",
    "override_validation": "SELECT p_partkey, CASE WHEN p_partkey < 1 THEN 'id' WHEN p_size % 3 = 2 THEN 'type' WHEN p_name = '' THEN 'title' WHEN p_size % 7 = 0 THEN 'reason' WHEN p_size % 5 <= 1 THEN 'urls' END AS fault FROM part",
    "title_for": f"SELECT p_partkey, CASE WHEN w = 4 THEN cased WHEN w <= 1 OR w = 5 OR v IN (1, 3) THEN {_OWN} ELSE cased END AS title, CAST(CASE WHEN w <= 1 THEN y ELSE {_PATH_YEAR} END AS INT) AS year FROM {_LISTED}",
    "twin_base": "SELECT p_partkey, lower(p_name) AS base FROM part",
    "log_texts": "SELECT event_id, event_type || CASE WHEN user_id % 3 > 0 THEN ' (' || (user_id % 3) || ')' ELSE '' END AS name, CASE WHEN h < 1 THEN '<1h' WHEN h < 48 THEN h || 'h' ELSE CAST(floor(h / 24.0 + 0.5) AS INT) || 'd' END AS until, CASE WHEN ms < 1000 THEN ms || 'ms' WHEN ms < 60000 THEN (ms // 1000) || '.' || (ms % 1000 // 100) || 's' ELSE CAST(floor(ms / 60000.0 + 0.5) AS BIGINT) || 'm' END AS clock, event_type AS family FROM (SELECT *, event_id % 90 AS h, event_id * 500 AS ms FROM events)",
    "listing": "WITH a AS (SELECT page_id, pos, " + _HREF + " AS href, " + _PLAIN.format(f"regexp_extract(a, '{_A}', 4)") + " AS label FROM " + _ANCHORS + "), u AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:', ''), '^//[^/?#]*', ''), '[?#].*$', '') AS p FROM a WHERE href <> '' AND href NOT LIKE '#%' AND href NOT LIKE 'mailto:%') SELECT page_id, " + _ENCODED.format("regexp_replace(p, '/+$', '')") + " || '/' AS path, CAST(min(pos) AS INT) AS pos, arg_min(label, pos) AS label FROM u GROUP BY 1, 2",
    "item_listing": """WITH a AS (SELECT p_partkey // 20 AS page_id, p_partkey AS k, row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS pos, replace(p_name, ' ', '-') || '-' || (p_partkey // 2) AS s, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') || CASE WHEN p_partkey % 4 = 0 THEN ' Season 3' ELSE ' & more' END AS label FROM part WHERE true),
i AS (SELECT page_id, pos, '/' || s || ['-tamil-movie/', '-web-series/', '-movie/', '-tamil-season-2/'][1 + k % 5] AS path, label FROM a WHERE k % 13 > 0 AND k % 17 > 0 AND k % 5 < 4)
SELECT page_id, path, CAST(pos AS INT) AS pos, label, CASE WHEN path LIKE '%-web-series/' OR path LIKE '%-season-2/' OR label LIKE '%Season 3' THEN 'series' ELSE 'movie' END AS kind FROM i QUALIFY row_number() OVER (PARTITION BY page_id, path ORDER BY pos) = 1""",
    "walk_plan": "WITH a AS (SELECT page_id, count(*) FILTER (regexp_matches(href, '^/[A-M]')) AS e, count(*) FILTER (regexp_matches(href, '^/[N-Z]')) AS s, count(*) AS n FROM (SELECT page_id, " + _HREF + " AS href FROM " + _ANCHORS + ") GROUP BY page_id) SELECT page_id, CASE WHEN page_id % 7 < 2 OR coalesce(e, 0) > 3 OR coalesce(s, 0) > 3 THEN 'series' ELSE 'movie' END AS plan, CASE WHEN e > 3 THEN 'episodes' WHEN s > 3 THEN 'seasons' WHEN n > 0 THEN 'movie' ELSE 'empty' END AS shape FROM pages LEFT JOIN a USING (page_id)",
    "discovered": "SELECT p_name AS path, CAST(s AS INT) AS source, CAST(p_partkey AS INT) AS pos, p_brand FROM (SELECT *, CASE p_brand[-1] WHEN '3' THEN 0 WHEN '1' THEN 1 WHEN '2' THEN 2 END AS s FROM part) WHERE s IS NOT NULL QUALIFY row_number() OVER (PARTITION BY p_name ORDER BY s, p_partkey) = 1",
    "page_posters": "SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'https://p/uploads/posters/' || page_id || '.jpg' WHEN 1 THEN 'https://p/uploads/posters/' || page_id || '.webp' ELSE '' END AS poster FROM pages",
    "source_metadata": "SELECT p_partkey, true AS available, p_name || ' (' || (1950 + p_size) || ')' AS title, CAST(1950 + p_size AS INT) AS year, p_brand AS directors, p_type || '|' || p_brand AS people_cast FROM part",
    "episode_walk": """WITH e AS (SELECT DISTINCT l_suppkey AS s, l_linenumber AS season, l_partkey % 9 AS episode, ['1080p', '720p', '480p'][1 + l_partkey % 3] AS quality, max(l_quantity) OVER (PARTITION BY l_suppkey, l_linenumber, l_partkey % 9, l_partkey % 3) AS q FROM lineitem WHERE l_partkey % 9 > 0)
SELECT CAST(s AS VARCHAR) AS root, CAST(season AS INT) AS season, CAST(episode AS INT) AS episode, quality, s || '/' || season || '/' || quality || '/' || episode || '/' || CAST(q AS INT) AS url FROM e QUALIFY quality <> '480p' OR NOT bool_or(quality <> '480p') OVER (PARTITION BY s, season, episode)""",
    "file_walk": FILES_SQL,
    "alternative_match": f"{_RC} SELECT r.record, min(c.id) AS candidate, 'alternative' AS how FROM r JOIN c ON c.type = 'movie' AND r.year = c.year AND r.t = c.t GROUP BY 1 HAVING count(DISTINCT c.id) = 1 UNION ALL SELECT r.record, min(c.id), 'compact' FROM r JOIN c ON c.type = 'movie' AND r.year = c.year AND replace(r.t, ' ', '') IN (replace(c.t, ' ', ''), regexp_replace(c.o, '[^a-z0-9]+', '', 'g')) GROUP BY 1 HAVING count(DISTINCT c.id) = 1",
    "override_outcome": f"{_RC} SELECT record, CASE WHEN status = 'matched' THEN record + 1 END AS candidate, status, CASE status WHEN 'matched' THEN 'reviewed-override' WHEN 'review' THEN 'override-conflict' ELSE 'no-safe-match' END AS reason FROM (SELECT r.record, CASE WHEN c.id % 5 = 0 THEN 'unresolved' WHEN c.id % 7 = 0 THEN 'review' ELSE 'matched' END AS status FROM r JOIN c ON c.id = r.record + 1)",
    "lookup_notes": """WITH e AS (SELECT user_id AS record, event_id AS seq, CASE WHEN event_type = 'signup' THEN 'media-type-conflict' ELSE event_type END AS reason, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
g AS (SELECT record, list(reason ORDER BY seq) FILTER (n <= 30) AS l, arg_max(reason, seq) AS reason FROM e GROUP BY record)
SELECT record, array_to_string(l[greatest(len(l) - 11, 1):], ',') AS notes, reason, list_contains(l, 'media-type-conflict') AS review FROM g""",
    "search_outcome": "SELECT event_id, CASE WHEN event_type = 'error' OR event_id % 8 > 5 THEN 'unavailable' WHEN event_type = 'purchase' THEN 'matched' ELSE 'unresolved' END AS status, event_id % 2 = 0 AND (event_id % 3 <> 1 OR user_id % 5 = 0) AS ambiguous FROM events",
}
