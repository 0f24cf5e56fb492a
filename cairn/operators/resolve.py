"""Resolving records to entities of a candidate table: exact matches, credits, overrides, notes and statuses.

Candidates: id, type (movie or tv), title, original_title, name, original_name, alternatives (array of texts),
release_date, first_air_date, language, seasons (array of season_number, air_date, poster_path), poster_path,
vote_average, imdb_id. Nothing is asked over a network: lookups are joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators.merge import falsy

#: Reasons of notes that call for a review, and those that mean that a lookup could not be made.
REVIEW = ("source-credits-conflict", "media-type-conflict", "override-conflict", "scoped-match-needs-review")
NOTES, KEPT_NOTES = 30, 12


def year_of(date: Column) -> Column:
    """The year of a date text, 0 without one."""
    return F.coalesce(F.substring(F.coalesce(date, F.lit("")), 1, 4).try_cast("int"), F.lit(0))


def _titles(candidates: DataFrame, alternatives: bool = False, compact: bool = False, v2: bool = False) -> DataFrame:
    """titles_of, where a title may stand more than once."""
    normal = text.normalise_v2 if v2 else text.normalise_v1
    names = F.array("title", "original_title", "name", "original_name")
    names = F.concat(names, F.coalesce("alternatives", F.array().cast("array<string>"))) if alternatives else names
    year = F.when(F.col("type") == "tv", year_of(F.col("first_air_date"))).otherwise(year_of(F.col("release_date")))
    out = candidates.select("id", "type", year.alias("year"), F.explode(names).alias("t")).select("id", "type", "year", normal(F.col("t")).alias("key")).where("key <> ''")
    return out.select("id", "type", "year", F.regexp_replace("key", " ", "").alias("key") if compact else F.col("key"))


def titles_of(candidates: DataFrame, alternatives: bool = False, compact: bool = False, v2: bool = False) -> DataFrame:
    """id, type, year, key: every title a candidate goes by, normalised, each once (J7), with official
    alternatives (T4) and without blanks (T5) if asked."""
    return _titles(candidates, alternatives, compact, v2).distinct()


def title_index(candidates: DataFrame, alternatives: bool = False, compact: bool = False, v2: bool = False) -> DataFrame:
    """type, key, year, low, high: the least and the greatest id of the candidates of a type that share a title and a
    year: one row, however many they are; year 0 stands for any. It may be written once for several lookups."""
    return _lowest(_titles(candidates, alternatives, compact, v2), "type")


def _lowest(titles: DataFrame, *by: str) -> DataFrame:
    dated = titles.groupBy(*by, "key", "year").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    undated = dated.groupBy(*by, "key").agg(F.min("low").alias("low"), F.max("high").alias("high")).select(*by, "key", F.lit(0).alias("year"), "low", "high")
    return dated.where("year <> 0").unionByName(undated)


def pick(records: DataFrame, candidates: DataFrame, kind: str, alternatives: bool = False, compact: bool = False, v2: bool = False) -> DataFrame:
    """(record, candidate) where just one candidate of the kind has the record's title, and its year if that is
    known (J7): two are ambiguous and match nothing. records: record, title, year."""
    names = titles_of(candidates.where(F.col("type") == kind), alternatives, compact, v2)
    return _picked(records, _lowest(names), compact, v2)


def picked(records: DataFrame, index: DataFrame, compact: bool = False, v2: bool = False) -> DataFrame:
    """(record, type, candidate): `pick` by an index made the same way. records: record, type, title, year."""
    return _picked(records, index, compact, v2, "type")


def _picked(records: DataFrame, index: DataFrame, compact: bool, v2: bool, *by: str) -> DataFrame:
    normal = text.normalise_v2 if v2 else text.normalise_v1
    key = normal(F.col("title"))
    r = records.select("record", *by, F.coalesce("year", F.lit(0)).alias("year"), (F.regexp_replace(key, " ", "") if compact else key).alias("key"))
    hits = r.join(index, [*by, "key", "year"]).groupBy("record", *by).agg(F.min("low").alias("candidate"), F.max("high").alias("high"))
    return hits.where("candidate = high").drop("high")


def _single(hits: DataFrame, *more: Column) -> DataFrame:
    """(record, candidate) of the records whose hits, from low to high, are one candidate."""
    return hits.groupBy("record").agg(F.min("low").alias("candidate"), F.max("high").alias("__high"), *more).where("candidate = __high").drop("__high")


def _only(hits: DataFrame) -> DataFrame:
    return hits.groupBy("record").agg(F.min("id").alias("candidate"), F.countDistinct("id").alias("n")).where("n = 1").drop("n")


def season_pick(records: DataFrame, candidates: DataFrame) -> DataFrame:
    """(record, candidate, poster) by exact base title and the year in which the record's season was aired (T6),
    with the season's poster before the show's (T13). records: record, title, year, season (0: in the title)."""
    season = F.when(F.col("season") > 0, F.col("season")).otherwise(text.season_of(F.col("title")))
    base = F.trim(F.regexp_replace(text.normalise_v1(F.col("title")), r" season [0-9]+\z", ""))
    r = records.select("record", F.col("year").alias("want"), season.alias("want_season"), base.alias("key"))
    aired = candidates.where("type = 'tv'").select("id", F.col("poster_path").alias("generic"), F.explode("seasons").alias("s"))
    aired = aired.select("id", F.col("s.season_number").alias("want_season"), year_of(F.col("s.air_date")).alias("want"), F.coalesce(F.nullif("s.poster_path", F.lit("")), "generic").alias("poster"))
    keys = titles_of(candidates.where("type = 'tv'")).select("id", "key").distinct()
    shows = keys.join(aired, "id").groupBy("key", "want_season", "want").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min("poster").alias("poster"))
    hits = r.where("want_season > 0").join(shows, ["key", "want_season", "want"])
    return _single(hits, F.min("poster").alias("poster"))


def regional_ambiguous(generic: Column, language: Column, candidate_language: Column, host_known: Column) -> Column:
    """Whether a show that has regional versions may not be guessed (T7): without a language of the record, with
    another one, or without evidence of its host."""
    return generic & (falsy(language) | ~language.eqNullSafe(candidate_language) | ~host_known)


def search_status(matched: Column, ok: Column, pages: Column, most: int = 5) -> Column:
    """matched, unresolved, or unavailable: a failed or truncated search is never a miss."""
    return F.when(~ok | (pages > most), "unavailable").when(matched, "matched").otherwise("unresolved")


def credits(named: DataFrame, people: DataFrame) -> DataFrame:
    """(record, candidate, strong, contradiction) of the names that a source gives for a candidate.

    named: record, candidate, name, director; people: candidate, person, name, director, one row for each name a
    person goes by. Strong: two people of the cast, or a director and another person of the cast; a person under two
    names, or both as director and in the cast, is one. Contradiction: names, and none found.
    """
    key = lambda c: text.normalise_v2(F.col(c))
    p = people.select("candidate", "person", key("name").alias("key"), "director").distinct()
    hit = named.select("record", "candidate", key("name").alias("key"), "director").where("key <> ''").join(p, ["candidate", "key", "director"], "left")
    g = hit.groupBy("record", "candidate").agg(F.collect_set(F.when(~F.col("director"), F.col("person"))).alias("cast"), F.collect_set(F.when(F.col("director"), F.col("person"))).alias("directors"))
    other = F.exists("directors", lambda d: F.size(F.array_except("cast", F.array(d))) > 0)
    return g.select("record", "candidate", ((F.size("cast") >= 2) | other).alias("strong"), ((F.size("cast") == 0) & (F.size("directors") == 0)).alias("contradiction"))


def subtitle_pick(records: DataFrame, candidates: DataFrame, strong: DataFrame) -> DataFrame:
    """(record, candidate) where a candidate's title is the record's with a subtitle, credits are strong (record,
    candidate), and no other candidate's title begins alike (T9)."""
    head = F.regexp_extract(F.coalesce(F.col("title"), F.col("name")), r"^([^:\-–]+)[:\-–]", 1)
    c = candidates.select("id", text.normalise_v1(head).alias("key")).where("key <> ''")
    hits = records.select("record", text.normalise_v1(F.col("title")).alias("key")).join(c, "key")
    return _only(hits).join(strong, ["record", "candidate"], "left_semi")


def override_outcome(records: DataFrame, overrides: DataFrame, candidates: DataFrame) -> DataFrame:
    """(record, candidate, status, reason) of reviewed mappings (J11, J13, T10): the mapped entity's title must be
    the expected one, else the mapping itself is reviewed; an unknown id is unresolved. Overrides are a reviewed,
    hand-written table; the join is left to the optimiser."""
    o = overrides.select(F.col("id").alias("record"), F.col("tmdb_id").alias("candidate"), F.col("tmdb_type").alias("type"), "expected_title")
    c = candidates.select(F.col("id").alias("candidate"), "type", F.coalesce(F.nullif("title", F.lit("")), "name").alias("found"))
    j = records.select("record").join(o, "record").join(c, ["candidate", "type"], "left")
    same = text.normalise_v1(F.col("found")) == text.normalise_v1(F.col("expected_title"))
    status = F.when(F.col("found").isNull(), "unresolved").when(same, "matched").otherwise("review")
    reason = F.when(F.col("found").isNull(), "no-safe-match").when(same, "reviewed-override").otherwise("override-conflict")
    return j.select("record", F.when(same, F.col("candidate")).alias("candidate"), status.alias("status"), reason.alias("reason"))


def resolve(records: DataFrame, candidates: DataFrame, verify_ids: bool = False, index: DataFrame | None = None) -> DataFrame:
    """(record, candidate, type, how) by the chain of lookups.

    The stored id in its own type; with verify_ids, only if the title agrees. Else the id in the other type, if the
    title agrees (cross). Else the one exact match of the own type, then, for a movie, of a show (search-tv; a
    series is never matched to a film). Else what the record had, if it is suspect (kept), or none.
    records: record, title, year, kind, tmdb_id; index: the candidates' title_index, if it is there already.
    """
    first = F.when(F.col("kind") == "series", "tv").otherwise("movie")
    r = records.select("record", "title", "year", "kind", "tmdb_id", first.alias("own"), F.when(F.col("kind") == "series", "movie").otherwise("tv").alias("alt"))
    c = candidates.select("id", "type", F.coalesce(F.nullif("title", F.lit("")), "name").alias("found"))
    known = r.where(~falsy(F.col("tmdb_id")))
    own = known.join(c, (F.col("tmdb_id") == F.col("id")) & (F.col("own") == F.col("type"))).select("record", F.col("found").alias("own_title"))
    alt = known.join(c, (F.col("tmdb_id") == F.col("id")) & (F.col("alt") == F.col("type"))).select("record", F.col("found").alias("alt_title"))
    # a movie is looked for among movies and, failing that, among shows; a series among shows only
    wanted = r.select("record", "title", "year", F.explode(F.when(F.col("own") == "tv", F.array("own")).otherwise(F.array("own", "alt"))).alias("type"))
    hits = picked(wanted, title_index(candidates) if index is None else index).groupBy("record")
    hits = hits.agg(*(F.max(F.when(F.col("type") == t, F.col("candidate"))).alias(f"{t}_hit") for t in ("movie", "tv")))
    j = r.join(own, "record", "left").join(alt, "record", "left").join(hits, "record", "left")
    j = j.withColumn("own_hit", F.when(F.col("own") == "movie", F.col("movie_hit")).otherwise(F.col("tv_hit")))
    same = lambda t: F.coalesce(text.normalise_v1(F.col(t)) == text.normalise_v1(F.col("title")), F.lit(False))
    trusted = F.col("own_title").isNotNull() & (same("own_title") | F.lit(not verify_ids))
    cross = F.col("own_title").isNull() & same("alt_title")
    how = F.when(trusted, "id").when(cross, "cross").when(F.col("own_hit").isNotNull(), "search").when((F.col("own") == "movie") & F.col("tv_hit").isNotNull(), "search-tv").when(F.col("own_title").isNotNull(), "kept").otherwise("none")
    candidate = F.when(how.isin("id", "cross", "kept"), F.col("tmdb_id")).otherwise(F.coalesce("own_hit", "tv_hit"))
    kind = F.when(how.isin("id", "search", "kept"), F.col("own")).when(how == "cross", F.col("alt")).when(how == "search-tv", "tv")
    return j.select("record", candidate.alias("candidate"), kind.alias("type"), how.alias("how"))


def noted(notes: DataFrame) -> DataFrame:
    """(record, notes, reason, review) of lookups' notes (E3, O7): the first thirty are kept, of them the last
    twelve are shown, the last reason of all wins, and some reasons call for a review. notes: record, seq, reason."""
    first = F.slice(F.array_sort(F.collect_list(F.struct("seq", "reason"))), 1, NOTES)
    top = notes.withColumn("__n", F.row_number().over(Window.partitionBy("record").orderBy("seq"))).where(F.col("__n") <= NOTES)
    kept = top.groupBy("record").agg(F.transform(first, lambda x: x["reason"]).alias("l"))
    last = notes.groupBy("record").agg(F.max_by("reason", "seq").alias("reason"))
    shown = F.slice("l", F.greatest(F.size("l") - KEPT_NOTES + 1, F.lit(1)), KEPT_NOTES)
    return kept.join(last, "record").select("record", shown.alias("notes"), "reason", F.arrays_overlap("l", F.array(*map(F.lit, REVIEW))).alias("review"))


def outcome(asked: Column, found: Column, language: Column, how: Column, review: Column, last_reason: Column, aborted: Column) -> Column:
    """(status, reason) of a lookup (E2): "could not ask" is unavailable and never a miss; the reason is the last
    note's unless the lookup was cut off or matched."""
    status = F.when(~asked, "unavailable").when(found, "matched").when(F.coalesce(review, F.lit(False)), "review").otherwise("unresolved")
    matched = F.when(falsy(language), "original-language-missing").otherwise(F.coalesce(how, F.lit("matched")))
    reason = F.when(aborted & ~asked, "lookup-timeout").when(asked & found, matched).otherwise(F.coalesce(last_reason, F.when(status == "unavailable", "lookup-incomplete").otherwise("no-safe-match")))
    return F.struct(status.alias("status"), reason.alias("reason"))


def evidence_outcome(override: Column, trusted: Column, found: Column, trouble: Column, available: Column, named: Column, contradiction: Column, strong: Column, source_year: Column, year: Column, scoped: Column, fallback: Column, fallback_scoped: Column) -> Column:
    """What evidence makes of a lookup (E1): accept, unavailable, review or unresolved.

    An override or a trusted id needs none. Trouble while asking, or evidence that could not be read, is
    unavailable. Credits that contradict, or a scoped match that only suggests, are reviewed; another year needs
    strong credits; what is left falls back on the match by evidence."""
    other_year = (source_year > 0) & (source_year != year) & ~strong
    stands = found & ~(named & contradiction) & ~(named & other_year) & ~scoped
    return (
        F.when(override | trusted, F.when(found, "accept").otherwise("unresolved"))
        .when(trouble | ~available, "unavailable")
        .when(stands, "accept")
        .when(fallback_scoped, "review")
        .when(fallback, "accept")
        .when(found & named & contradiction, "review")
        .when(scoped, "unavailable")
        .otherwise("unresolved")
    )


def cached_evidence(records: DataFrame, evidence: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """records with the evidence read from the same page in the last days, null columns without.
    evidence: source_url, fetched_at, available, and what it found."""
    e = evidence.where(F.col("available") & (F.col("fetched_at") > as_of - F.expr(f"INTERVAL {days} DAYS")))
    rest = [c for c in e.columns if c != "source_url"]
    e = e.groupBy(text.path_key(F.col("source_url")).alias("__path")).agg(F.max_by(F.struct(*rest), "fetched_at").alias("evidence"))
    return records.withColumn("__path", text.path_key(F.col("page_url"))).join(e, "__path", "left").drop("__path")
