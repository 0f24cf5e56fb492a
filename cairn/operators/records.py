"""Catalogue records as rows with nested seasons: nested merges, metadata, attempts, signatures.

A record has id, title, year, kind, category, language, category_source, page_url, embeds, poster, rating, tmdb_id,
imdb_id, added_at, seasons, updated_at. Nested merges are expressions within a row, so one join moves each record
once whatever it holds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions.text import let, path_key, quality_rank
from cairn.operators import schedule
from cairn.operators.merge import category, falsy, filled, merge_attempts

#: Canonical order of a record's columns.
COLUMNS = ("id", "title", "year", "kind", "category", "language", "category_source", "page_url", "embeds", "poster", "rating", "tmdb_id", "imdb_id", "added_at", "seasons", "updated_at")
EMBEDS = "array<struct<quality:string,url:string>>"
SEASONS = f"array<struct<season:int,episodes:array<struct<episode:int,embeds:{EMBEDS}>>>>"
_FLAT = {"season": "int", "episode": "int", "at": "int", "i": "int", "quality": "string", "url": "string"}
#: Version of the rules by which attempts are judged; an attempt under another one does not count.
VERSION = 2


def ordered(df: DataFrame) -> DataFrame:
    """Columns in canonical order, unknown ones behind them."""
    return df.select(*(c for c in COLUMNS if c in df.columns), *(c for c in df.columns if c not in COLUMNS))


def as_json(df: DataFrame) -> DataFrame:
    """One JSON text a record: canonical order, and what is unknown is left out."""
    return ordered(df).select("id", F.to_json(F.struct("*"), {"ignoreNullFields": "true"}).alias("json"))


def union_embeds(have: Column, fresh: Column) -> Column:
    """have, then the fresh ones with a URL that is not there yet, each once."""
    add = lambda out, e: F.when(falsy(e["url"]) | F.exists(out, lambda x: x["url"] == e["url"]), out).otherwise(F.concat(out, F.array(e)))
    return F.aggregate(F.coalesce(fresh, F.array().cast(EMBEDS)), F.coalesce(have, F.array().cast(EMBEDS)), add)


def by_quality(embeds: Column) -> Column:
    """Better qualities first, equal ones as they stood (O1)."""
    keyed = F.transform(embeds, lambda e, i: F.struct(quality_rank(e["quality"]).alias("rank"), i.alias("i"), e.alias("e")))
    return F.transform(F.array_sort(keyed), lambda x: x["e"])


def _numbers(a: Column, b: Column, name: str) -> Column:
    return F.array_sort(F.array_distinct(F.concat(F.transform(a, lambda x: x[name]), F.transform(b, lambda x: x[name]))))


def merge_seasons(have: Column, fresh: Column) -> Column:
    """Union of seasons, episodes and links in order of their numbers; links of an episode that both sides have
    are sorted by quality, others stay as given (M1)."""
    empty = F.array().cast(SEASONS)

    def episode(n: Column, x: Column, y: Column) -> Column:
        of = lambda side: F.filter(side, lambda e: e["episode"] == n)
        links = lambda side: F.coalesce(F.get(of(side), F.lit(0))["embeds"], F.array().cast(EMBEDS))
        both = (F.size(of(x)) > 0) & (F.size(of(y)) > 0)
        return F.struct(n.alias("episode"), F.when(both, by_quality(union_embeds(links(x), links(y)))).when(F.size(of(x)) > 0, links(x)).otherwise(links(y)).alias("embeds"))

    def season(n: Column, x: Column, y: Column) -> Column:
        of = lambda side: F.flatten(F.transform(F.filter(side, lambda s: s["season"] == n), lambda s: s["episodes"]))
        merged = let(F.struct(of(x).alias("x"), of(y).alias("y")), lambda e: F.transform(_numbers(e["x"], e["y"], "episode"), lambda m: episode(m, e["x"], e["y"])))
        return F.struct(n.alias("season"), merged.alias("episodes"))

    whole = F.struct(F.coalesce(have, empty).alias("x"), F.coalesce(fresh, empty).alias("y"))
    return let(whole, lambda v: F.transform(_numbers(v["x"], v["y"], "season"), lambda n: season(n, v["x"], v["y"])))


def links(seasons: Column) -> Column:
    """The flat links of a series, which are always derived from its seasons."""
    each = lambda s: F.flatten(F.transform(s["episodes"], lambda e: e["embeds"]))
    return F.flatten(F.transform(F.coalesce(seasons, F.array().cast(SEASONS)), each))


def flat_links() -> Column:
    """All links of a row (kind, embeds, seasons) as a text of arrays side by side, an entry a link: rows move with about half the
    bytes that nested structs take. Seasons without episodes and episodes without links have an entry without i."""
    none = F.lit(None)
    entry = lambda *parts: F.struct(*(c.cast(t).alias(n) for c, (n, t) in zip(parts, _FLAT.items())))
    some = lambda c: F.size(F.coalesce(c, F.array())) > 0
    episode = lambda season, n, at, embeds: F.when(some(embeds), F.transform(embeds, lambda x, i: entry(season, n, at, i, x["quality"], x["url"]))).otherwise(F.array(entry(season, n, at, none, none, none)))
    season = lambda s: F.when(some(s["episodes"]), F.flatten(F.transform(s["episodes"], lambda e, at: episode(s["season"], e["episode"], at, e["embeds"])))).otherwise(F.array(entry(s["season"], none, none, none, none, none)))
    movie = episode(F.lit(0), F.lit(0), F.lit(0), F.col("embeds").cast(EMBEDS))
    series = F.flatten(F.transform(F.coalesce(F.col("seasons").cast(SEASONS), F.array().cast(SEASONS)), season))
    return let(F.when(F.col("kind") != "series", movie).otherwise(series), lambda v: F.to_json(F.struct(*(v[c].alias(c) for c in _FLAT))))


def unfolded(flat: Column) -> Column:
    """The arrays in a text of `flat_links`; one that is not whole fails."""
    return F.from_json(flat, ",".join(f"{c} array<{t}>" for c, t in _FLAT.items()), {"mode": "FAILFAST"})


def link_rows(df: DataFrame, key: list[str], src: Column) -> DataFrame:
    """(key, src, movie, season, episode, ord, quality, url): a row a link of each record or item. Seasons without episodes and
    episodes without links have a row with a null ord, and season and episode are 0 for what is no series. df has `flat`
    (see `flat_links`), or what it is made from."""
    flat = F.col("flat") if "flat" in df.columns else flat_links()
    # records move once, their links as a text, and by their key, which serves all windows and groups of `merged_links`
    r = df.where("kind IS NOT NULL").select(*key, src.alias("src"), (F.col("kind") != "series").alias("movie"), flat.alias("flat")).repartition(*key)
    r = r.select(*key, "src", "movie", unfolded(F.col("flat")).alias("flat"))
    r = r.select(*key, "src", "movie", F.explode(F.arrays_zip(*(F.col(f"flat.{c}").alias(c) for c in _FLAT))).alias("x"))
    return r.select(*key, "src", "movie", "x.season", "x.episode", F.when(F.col("x.i").isNotNull(), F.struct("x.at", "x.i")).alias("ord"), "x.quality", "x.url")


def _judged(rows: DataFrame, key: list[str]) -> DataFrame:
    """Rows of links with the first and the second source of their episode, whether they are kept, and the rank they are sorted by."""
    episode = Window.partitionBy(*key, "movie", "season", "episode")
    url = Window.partitionBy(*key, "movie", "season", "episode", "url")
    r = rows.withColumn("once", F.min(F.struct("src", "ord")).over(url)).withColumn("first", F.min("src").over(episode))
    r = r.withColumn("second", F.min(F.when(F.col("src") > F.col("first"), F.col("src"))).over(episode))
    r = r.withColumn("kept", F.col("ord").isNotNull() & ((F.col("src") == F.col("first")) | (~falsy(F.col("url")) & (F.struct("src", "ord") == F.col("once")))))
    return r.withColumn("rank", F.when(F.col("movie"), 0).otherwise(quality_rank(F.col("quality"))))


def link_news(rows: DataFrame, key: list[str]) -> DataFrame:
    """The news of `merged_links` alone: rows are compared in order, and no links are gathered."""
    r = _judged(rows, key).select(*key, "src", "movie", "season", "episode", "ord", "first", "second", "kept", "rank")
    episode, season = Window.partitionBy(*key, "movie", "season", "episode").orderBy("src", "ord"), Window.partitionBy(*key, "movie", "season")
    r = r.withColumn("at", F.row_number().over(episode)).withColumn("before", F.lag(F.when(F.col("ord").isNotNull(), F.col("rank"))).over(episode))
    r = r.withColumn("named", F.count("episode").over(season)).withColumn("least", F.min("src").over(season))
    new = lambda when, src, n: F.when(when, F.struct(src.alias("src"), F.lit(n).cast("int").alias("n") if isinstance(n, int) else n.cast("int").alias("n")))
    is_first = F.col("src") == F.col("first")
    each = F.array(
        new((F.col("at") == 1) & F.col("episode").isNotNull(), F.col("first"), ~F.col("movie")), new(F.col("kept") & ~is_first, F.col("src"), 0),
        new(is_first & F.col("second").isNotNull() & (F.col("before") > F.col("rank")) & F.col("ord").isNotNull(), F.col("second"), 0), new((F.col("named") == 0) & (F.col("at") == 1), F.col("least"), 0),
    )
    return r.select(*key, F.explode(F.array_compact(each)).alias("x")).groupBy(*key, F.col("x.src").alias("src")).agg(F.sum("x.n").cast("int").alias("episodes"))


def merged_links(rows: DataFrame, key: list[str], save: Callable[[DataFrame], DataFrame] = lambda df: df) -> tuple[DataFrame, DataFrame]:
    """Sources of links in order of src, as one a key (M1, U1, O1): (key, movie, embeds, seasons), and (key, src, episodes) of each
    source that added or moved something, with the number of episodes that it brought.

    The first source of an episode stays as it is; a further one adds links whose URL is not there yet, after which better
    qualities come first and equal ones stay in order. A movie's links are never sorted. save keeps what both results are read from.
    """
    r, rank = _judged(rows, key), F.col("rank")
    link = F.struct(F.when(F.col("second").isNotNull(), rank).otherwise(0).alias("rank"), "src", "ord", "quality", "url")
    before = F.when(F.col("kept") & (F.col("src") == F.col("first")), F.struct("ord", rank.alias("rank")))
    adding = F.when(F.col("kept") & (F.col("src") > F.col("first")), F.col("src"))
    e = r.groupBy(*key, "movie", "season", "episode").agg(
        F.array_sort(F.collect_list(F.when(F.col("kept"), link))).alias("links"), F.transform(F.array_sort(F.collect_list(before)), lambda x: x["rank"]).alias("ranks"),
        F.min("first").alias("first"), F.min("second").alias("second"), F.collect_set(adding).alias("adding"),
    )
    moved = F.when(F.col("second").isNotNull() & (F.col("ranks") != F.array_sort("ranks")), F.array("second")).otherwise(F.array().cast("array<bigint>"))
    e = e.select(*key, "movie", "season", "episode", "first", F.array_union("adding", moved).alias("adding"), F.transform("links", lambda x: F.struct(x["quality"].alias("quality"), x["url"].alias("url"))).cast(EMBEDS).alias("embeds"))
    s = e.groupBy(*key, "movie", "season").agg(
        F.array_sort(F.collect_list(F.when(F.col("episode").isNotNull(), F.struct("episode", "embeds")))).alias("episodes"), F.min("first").alias("first"),
        F.collect_list(F.when(F.col("episode").isNotNull(), F.struct("first", "adding"))).alias("news"),
    )
    out = save(s.groupBy(*key, "movie").agg(F.array_sort(F.collect_list(F.struct("season", "episodes"))).cast(SEASONS).alias("seasons"), F.flatten(F.collect_list("news")).alias("news"), F.collect_list(F.when(F.size("episodes") == 0, F.col("first"))).alias("empty")))
    firsts = F.transform("news", lambda n: F.struct(n["first"].alias("src"), (~F.col("movie")).cast("int").alias("n")))
    added = F.transform(F.flatten(F.transform("news", lambda n: n["adding"])), lambda x: F.struct(x.alias("src"), F.lit(0).alias("n")))
    bare = F.transform("empty", lambda x: F.struct(x.alias("src"), F.lit(0).alias("n")))
    news = out.select(*key, F.explode(F.concat(firsts, added, bare)).alias("x")).groupBy(*key, F.col("x.src").alias("src")).agg(F.sum("x.n").cast("int").alias("episodes"))
    return out.select(*key, "movie", F.when(F.col("movie"), F.flatten(F.flatten(F.transform("seasons", lambda s_: F.transform(s_["episodes"], lambda e_: e_["embeds"]))))).otherwise(links(F.col("seasons"))).alias("embeds"), F.when(~F.col("movie"), F.col("seasons")).alias("seasons")), news


def without(seasons: Column, dead: Column) -> Column:
    """seasons without the links proven dead; episodes and seasons that lose all go too."""
    kept = lambda embeds: F.filter(embeds, lambda x: ~F.coalesce(F.array_contains(dead, x["url"]), F.lit(False)))
    episodes = lambda s: F.filter(F.transform(s["episodes"], lambda e: F.struct(e["episode"].alias("episode"), kept(e["embeds"]).alias("embeds"))), lambda e: F.size(e["embeds"]) > 0)
    return F.filter(F.transform(seasons, lambda s: F.struct(s["season"].alias("season"), episodes(s).alias("episodes"))), lambda s: F.size(s["episodes"]) > 0)


def remove_dead(records: DataFrame, dead: DataFrame) -> DataFrame:
    """records without the links in `dead` (id, url), seasons rebuilt, and `removed`, their number (U3). Null
    URLs remove nothing."""
    gone = dead.where("url IS NOT NULL").groupBy("id").agg(F.collect_set("url").alias("__dead"))
    gone_ = F.coalesce("__dead", F.array().cast("array<string>"))
    series = F.size(F.coalesce("seasons", F.array().cast(SEASONS))) > 0
    rest = F.filter("embeds", lambda x: ~F.coalesce(F.array_contains(gone_, x["url"]), F.lit(False)))
    out = records.join(gone, "id", "left").withColumn("__n", F.size("embeds")).withColumn("seasons", F.when(series, without(F.col("seasons"), gone_)).otherwise(F.col("seasons")))
    out = out.withColumn("embeds", F.when(series, links(F.col("seasons"))).otherwise(rest))
    return out.withColumn("removed", F.col("__n") - F.size("embeds")).drop("__dead", "__n")


def signature(of: Callable[[str], Column] = F.col) -> Column:
    """What a change is judged by (P5): the year and the title are no part of it."""
    return F.sha2(F.to_json(F.struct(*(of(c).alias(c) for c in ("embeds", "seasons", "poster", "rating", "tmdb_id", "imdb_id", "category", "language"))), {"ignoreNullFields": "false"}), 256)


def fingerprint(source: Column, override: Column, of: Callable[[str], Column] = F.col) -> Column:
    """The identity of a record for attempts (P6): 20 digits of a hash over 12 fields; links are none of them.
    source: struct of title, year, people_cast, directors; override: a struct; either may be null."""
    text = lambda c: F.coalesce(c, F.lit(""))
    whole = lambda c: F.coalesce(c, F.lit(0))
    names = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    kind = F.when(falsy(of("kind")), "movie").otherwise(of("kind"))
    fields = [text(of("title")), whole(of("year")), kind, text(of("tmdb_type")), whole(of("tmdb_id")), text(of("language")), text(of("category")), text(source["title"]), whole(source["year"]), names(source["people_cast"]), names(source["directors"]), F.to_json(override)]
    return F.substring(F.sha2(F.to_json(F.struct(*(c.alias(f"f{k}") for k, c in enumerate(fields)))), 256), 1, 20)


def merge_generations(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """Two generations of the catalogue as one (J5, M5), theirs in their order, then ours that are new.

    Links and seasons are unions. A field that one side lacks is filled; where both have one, ours wins if it is
    at least as new. Title and year are only filled. Both tables have `pos`, their order.
    """
    fields = ("poster", "rating", "tmdb_id", "imdb_id", "category", "language", "category_source")
    sides = [df.select("id", F.lit(k).cast("long").alias("src"), F.coalesce("embeds", F.array().cast(EMBEDS)).alias("embeds"), F.coalesce("seasons", F.array().cast(SEASONS)).alias("seasons")) for k, df in enumerate((theirs, ours))]
    shapes = sides[0].join(sides[1].select("id", F.col("seasons").alias("__s")), "id").select("id", F.when((F.size("seasons") > 0) | (F.size("__s") > 0), "series").otherwise("movie").alias("kind"))
    united = merged_links(link_rows(sides[0].unionByName(sides[1]).join(shapes, "id"), ["id"], F.col("src")), ["id"])[0].select(F.col("id").alias("m_id"), F.col("embeds").alias("m_embeds"), F.col("seasons").alias("m_seasons"))
    o, t = (df.select([F.col(c).alias(f"{s}_{c}") for c in (*COLUMNS, "pos")]) for s, df in (("o", ours), ("t", theirs)))
    both = o.join(t, F.col("o_id") == F.col("t_id"), "full_outer").join(united, F.coalesce("t_id", "o_id") == F.col("m_id"), "left")
    mine, other = (lambda c: F.col(f"o_{c}")), (lambda c: F.col(f"t_{c}"))
    when_ = lambda of: F.coalesce(F.when(~falsy(of("updated_at")), of("updated_at").cast("string")), of("added_at").cast("string"), F.lit(""))
    newer = when_(mine) >= when_(other)
    met = mine("id").isNotNull() & other("id").isNotNull()
    series = (F.size(F.coalesce(mine("seasons"), F.array().cast(SEASONS))) > 0) | (F.size(F.coalesce(other("seasons"), F.array().cast(SEASONS))) > 0)
    value = lambda c: F.when(met, F.when(falsy(other(c)) | (~falsy(mine(c)) & newer), F.when(falsy(mine(c)), other(c)).otherwise(mine(c))).otherwise(other(c))).otherwise(F.coalesce(mine(c), other(c)))
    out = {c: F.coalesce(other(c), mine(c)) for c in COLUMNS} | {c: value(c) for c in fields}
    out |= {c: F.when(met, filled(other(c), mine(c))).otherwise(F.coalesce(other(c), mine(c))) for c in ("title", "year")}
    out["seasons"] = F.when(met & series, F.coalesce("m_seasons", F.array().cast(SEASONS))).otherwise(F.coalesce(other("seasons"), mine("seasons")))
    out["kind"] = F.when(met & series, "series").otherwise(F.coalesce(other("kind"), mine("kind")))
    out["embeds"] = F.when(met, F.coalesce("m_embeds", F.array().cast(EMBEDS))).otherwise(F.coalesce(other("embeds"), mine("embeds")))
    out["updated_at"] = F.when(met & newer & ~falsy(mine("updated_at")), mine("updated_at")).otherwise(F.coalesce(other("updated_at"), F.when(~met, mine("updated_at"))))
    place = F.struct(other("pos").isNull().cast("int").alias("new"), F.coalesce(other("pos"), mine("pos")).alias("pos"))
    return both.select(*(c.alias(name) for name, c in out.items()), place.alias("place"))


def meta_of(details: Callable[[str], Column], kind: Column, images: str = "https://images.example/w500") -> Column:
    """The metadata that a catalogue's answer holds (P3): missing numbers as 0, missing texts as empty."""
    text = lambda c: F.coalesce(c, F.lit(""))
    title = F.coalesce(F.nullif(details("title"), F.lit("")), details("name"), F.lit(""))
    poster = F.when(falsy(details("poster_path")), "").otherwise(F.concat(F.lit(images), details("poster_path")))
    return F.struct(details("id").alias("tmdb_id"), kind.alias("tmdb_type"), title.alias("tmdb_title"), text(details("imdb_id")).alias("imdb_id"), poster.alias("poster"), F.coalesce(details("vote_average").try_cast("double"), F.lit(0.0)).alias("rating"), text(details("original_language")).alias("language"))


def apply_metadata(df: DataFrame, meta: str, prefer_poster: bool = False, replace_id: bool = False, v2: bool = False) -> DataFrame:
    """df with the metadata in the struct column `meta` (null: none) applied, and `changed`.

    Empty fields are filled; a wrong id (crossType, or another one with replace_id) lets all be replaced. The
    category follows the metadata's language and media type. With v2, a known language that differs is corrected
    too, so that language and category agree (T14).
    """
    m = lambda c: F.col(f"{meta}.{c}")
    wrong = F.coalesce(m("cross_type"), F.lit(False)) | (F.lit(replace_id) & ~falsy(m("tmdb_id")) & ~falsy(F.col("tmdb_id")) & (m("tmdb_id") != F.col("tmdb_id")))

    def taken(c: str, also: bool = False) -> Column:
        return ~falsy(m(c)) & (F.lit(also) | falsy(F.col(c)) | wrong) & ~m(c).eqNullSafe(F.col(c))

    take = {"poster": taken("poster", prefer_poster), **{c: taken(c) for c in ("tmdb_id", "imdb_id", "rating")}, "language": taken("language", v2)}
    series = F.when(m("tmdb_type") == "tv", True).when(m("tmdb_type") == "movie", False).otherwise(F.coalesce(F.col("kind") == "series", F.lit(False)))
    wanted = F.when(~falsy(m("language")), category(m("language"), series))
    recategorised = wanted.isNotNull() & ~(wanted.eqNullSafe(F.col("category")) & F.col("category_source").eqNullSafe(F.lit("tmdb")))
    changed = F.coalesce(recategorised, F.lit(False))
    for c in take.values():
        changed = changed | F.coalesce(c, F.lit(False))
    new = {c: F.when(F.coalesce(cond, F.lit(False)), m(c)).otherwise(F.col(c)) for c, cond in take.items()}
    new |= {"category": F.when(recategorised, wanted).otherwise(F.col("category")), "category_source": F.when(recategorised, "tmdb").otherwise(F.col("category_source"))}
    return df.select(*(new[c].alias(c) if c in new else F.col(c) for c in df.columns), changed.alias("changed"))


def needs_metadata(v2: bool = False) -> Column:
    """Whether a record lacks its identity (F6): an id or a poster; with v2, an id or a language."""
    return falsy(F.col("tmdb_id")) | falsy(F.col("language" if v2 else "poster"))


def needs_category() -> Column:
    return falsy(F.col("category"))


def missing_optional() -> Column:
    """Whether artwork, the second id or votes are missing."""
    return falsy(F.col("poster")) | falsy(F.col("imdb_id")) | falsy(F.col("rating"))


def requires_identity(v2: bool = True) -> Column:
    """F7."""
    return needs_metadata(v2) | F.coalesce(F.col("category_source") == "site", F.lit(False))


def has_work(v2: bool = True) -> Column:
    """F7."""
    return requires_identity(v2) | missing_optional()


def current_attempt(entry: str, identity: Column) -> Column:
    """Whether an attempt was made under these rules for this identity."""
    return F.coalesce((F.col(f"{entry}.version") == VERSION) & (F.col(f"{entry}.identity") == identity), F.lit(False))


def metadata_queue(records: DataFrame, attempts: DataFrame, overrides: DataFrame, as_of: Column, limit: int = 0, only: str = "", retry_misses: bool = False, stale_days: int = 0, verify_ids: bool = False) -> DataFrame:
    """The queue of records to look up (E5): those with links and work (F7, F10), due again (F8), in three lanes
    (new identities, backlog, optional), interleaved (W1), newest or longest untried first (O3).

    records has `identity`; attempts are id, version, identity, status, checked_at, next_at; overrides have id.
    Adds lane and place.
    """
    entry = attempts.select("id", F.struct("version", "identity", "status", "checked_at", "next_at").alias("entry"))
    r = records.join(entry, "id", "left").join(overrides.select("id").distinct().withColumn("override", F.lit(True)), "id", "left")
    current, override = current_attempt("entry", F.col("identity")), F.coalesce("override", F.lit(False))
    changed = F.col("entry").isNotNull() & ~current
    r = r.where(F.size("embeds") > 0).where(F.lit(verify_ids) | has_work() | changed | (override & ~current))
    if only:
        r = r.where(F.contains(F.lower(F.concat_ws(" ", "id", "title", "page_url")), F.lit(only.lower())))
    force = F.lit(verify_ids) | (F.lit(retry_misses) & (requires_identity() | ~F.col("entry.status").eqNullSafe("matched")))
    r = r.where(schedule.due(current, F.col("entry.next_at"), F.col("entry.checked_at"), as_of, stale_days, force))
    recent = F.coalesce(F.col("added_at") > as_of - F.expr("INTERVAL 7 DAYS"), F.lit(False))
    important = requires_identity() | F.lit(verify_ids) | override | changed
    lane = F.when(~important, 2).when(~current & recent, 0).otherwise(1)
    tried = F.when(current, F.col("entry.checked_at"))
    order = [F.when(F.col("lane") == 0, F.col("added_at")).desc_nulls_last(), F.when(F.col("lane") > 0, tried).asc_nulls_first(), F.collate("id", "UNICODE")]
    return schedule.lanes(r.withColumn("lane", lane), "lane", order, limit)


def remember(previous: str, identity: Column, status: Column, as_of: Column) -> Column:
    """The attempt entry after an outcome (M8): attempts start again when identity or rules have changed."""
    attempts = F.when(current_attempt(previous, identity), F.coalesce(F.col(f"{previous}.attempts"), F.lit(0)) + 1).otherwise(1).cast("int")
    hours = schedule.attempt_hours(status, attempts)
    return F.struct(F.lit(VERSION).alias("version"), identity.alias("identity"), status.alias("status"), attempts.alias("attempts"), as_of.alias("checked_at"), (as_of + F.make_dt_interval(hours=hours)).alias("next_at"))


def merge_attempt_states(ours: DataFrame, theirs: DataFrame, misses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Attempts of two writers as one (J8), and the misses that no later match has made stale."""
    attempts = merge_attempts(ours, theirs, "id", "checked_at", "status")
    return attempts, misses.join(attempts.where("status = 'matched'"), "id", "left_anti")


def attempt_report(records: DataFrame, attempts: DataFrame, tried: DataFrame) -> DataFrame:
    """What was tried in this run, and the records that need an identity and were not, with the status of their
    current attempt or as pending (K5). records has `identity`; tried: id, status, reason."""
    rest = records.where(requires_identity()).join(tried.select("id"), "id", "left_anti")
    entry = attempts.select("id", F.struct("version", "identity", "status", "reason").alias("entry"))
    rest = rest.join(entry, "id", "left")
    current = current_attempt("entry", F.col("identity"))
    return tried.select("id", "status", "reason").unionByName(rest.select("id", F.when(current, F.col("entry.status")).otherwise("pending").alias("status"), F.when(current, F.col("entry.reason")).otherwise("not-attempted-this-version").alias("reason")))


def enrich_batch(records: DataFrame, outcomes: DataFrame, attempts: DataFrame, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """One set-based batch of the metadata worker (E6, E7): (records with metadata applied, their new attempts).

    outcomes: id, status, reason, replace (whether a differing id may be replaced), meta. A record that still
    lacks its identity afterwards is unresolved, whatever the lookup said. Records without outcome stay.
    """
    r = records.join(outcomes, "id", "left")
    kept = [c for c in records.columns]
    applied = None
    for replace in (False, True):
        part = apply_metadata(r.where(F.coalesce("replace", F.lit(False)) == replace), "meta", prefer_poster=True, replace_id=replace)
        applied = part if applied is None else applied.unionByName(part)
    unresolved = F.col("meta").isNotNull() & needs_metadata(v2=True)
    status = F.when(unresolved, "unresolved").otherwise(F.col("status"))
    reason = F.when(unresolved, "original-language-missing").otherwise(F.coalesce("reason", "status"))
    done = applied.where("status IS NOT NULL").join(attempts.select("id", F.struct("version", "identity", "attempts").alias("previous")), "id", "left")
    entry = done.select("id", "changed", reason.alias("reason"), remember("previous", F.col("identity"), status, as_of).alias("e")).select("id", "e.*", "reason", "changed")
    return applied.select(*kept, "changed"), entry


def touched_without_metadata(records: DataFrame, touched: DataFrame, limit: int) -> DataFrame:
    """Records of this run that lack metadata, at most `limit` if it is positive."""
    out = records.where(needs_metadata()).join(touched.select("id"), "id", "left_semi").orderBy("id")
    return out.limit(limit) if limit else out


def last_by_path(records: DataFrame) -> DataFrame:
    """path, and the record that stands last among those of one path."""
    rest = [c for c in records.columns if c != "pos"]
    best = records.groupBy(path_key(F.col("page_url")).alias("path")).agg(F.max_by(F.struct(*rest), "pos").alias("stored"))
    return best

