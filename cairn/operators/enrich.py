"""Enrichment as one plan (E1, E2, E7): cached evidence, lookup, credits, decision, metadata and the attempt that is remembered."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.operators import records, resolve
from cairn.operators.merge import falsy
from cairn.sources.scratch import saved


def named(looked: DataFrame) -> DataFrame:
    """record, candidate, name, director: the names that a record's evidence gives, to hold against a candidate."""
    pairs = lambda c, director: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda n: F.struct(n.alias("name"), F.lit(director).alias("director")))
    rows = F.explode(F.concat(pairs("evidence.people_cast", False), pairs("evidence.directors", True)))
    return looked.where("candidate IS NOT NULL").select("record", "candidate", rows.alias("x")).select("record", "candidate", "x.name", "x.director")


def decided(catalogue: DataFrame, candidates: DataFrame, evidence: DataFrame, people: DataFrame, overrides: DataFrame, as_of: Column, verify_ids: bool = False) -> DataFrame:
    """record, candidate, type, how, status, reason for every record.

    A reviewed override decides alone. Else the chain of lookups finds a candidate; a stored id is trusted unless ids are verified.
    Otherwise the evidence cached for the record's page must be there; credits that contradict it drop the candidate, another
    year needs strong credits, and what is left without one may be the one work that the evidence itself names, if its credits
    are strong. Evidence that could not be read is unavailable and never a miss. catalogue: records' columns; `trouble`, if
    there, marks lookups that failed.
    """
    r = catalogue.withColumn("record", F.col("id"))
    trouble = F.coalesce(F.col("trouble"), F.lit(False)) if "trouble" in catalogue.columns else F.lit(False)
    seen = saved(resolve.cached_evidence(r.select("record", "title", "year", "kind", "tmdb_id", "page_url", trouble.alias("trouble")), evidence, as_of), "seen")
    index = saved(resolve.title_index(candidates), "titles")
    looked = seen.join(resolve.resolve(seen, candidates, verify_ids, index), "record", "left")
    told = seen.where("evidence IS NOT NULL").select("record", F.col("evidence.title").alias("title"), F.col("evidence.year").alias("year"), F.when(F.col("kind") == "series", "tv").otherwise("movie").alias("type"))
    looked = saved(looked.join(resolve.picked(told, index).select("record", F.col("candidate").alias("again")), "record", "left"), "lookups")
    # the names of a record are held once against all candidates that it may be, found by either way
    either = looked.select("record", "evidence", F.explode(F.array_distinct(F.array("candidate", "again"))).alias("candidate"))
    verdicts = saved(resolve.credits(named(either), people), "verdicts")
    strong = verdicts.where("strong").select("record", F.col("candidate").alias("again"), F.col("candidate").alias("told"))
    looked = looked.join(verdicts, ["record", "candidate"], "left").join(strong, ["record", "again"], "left")
    mapped = resolve.override_outcome(seen, overrides, candidates).select("record", F.col("candidate").alias("o_candidate"), F.col("status").alias("o_status"), F.col("reason").alias("o_reason"))
    looked = looked.join(mapped, "record", "left")
    e = F.col("evidence")
    names = F.size(F.coalesce(e["people_cast"], F.array().cast("array<string>"))) > 0
    is_strong, against = F.coalesce("strong", F.lit(False)), F.coalesce("contradiction", F.lit(False))
    trusted, found = ~falsy(F.col("tmdb_id")) & F.lit(not verify_ids), F.col("candidate").isNotNull() & (F.col("how") != "none")
    source_year = F.coalesce(e["year"], F.lit(0))
    verdict = resolve.evidence_outcome(F.lit(False), trusted, found, F.col("trouble") & ~found, e.isNotNull(), names, against, is_strong, source_year, F.col("year"), F.lit(False), F.col("told").isNotNull(), F.lit(False))
    looked = looked.withColumn("verdict", verdict)
    stands = found & (trusted | ~((names & against) | (names & (source_year > 0) & (source_year != F.col("year")) & ~is_strong)))
    accepted = F.when(stands, F.col("candidate")).otherwise(F.col("told"))
    own = F.when(F.col("kind") == "series", "tv").otherwise("movie")
    override = F.col("o_status").isNotNull()
    status = F.when(override, F.col("o_status")).when(F.col("verdict") == "accept", "matched").otherwise(F.col("verdict"))
    reason = F.when(override, F.col("o_reason")).when(F.col("verdict") == "accept", F.when(~stands, "source-evidence").when(~trusted & is_strong, "source-credits").otherwise(F.col("how")))
    reason = reason.when(F.col("verdict") == "review", "source-credits-conflict").when(F.col("verdict") == "unavailable", F.when(F.col("trouble"), "lookup-failed").otherwise("source-unavailable")).otherwise("no-safe-match")
    candidate = F.when(override, F.col("o_candidate")).when(F.col("verdict") == "accept", accepted)
    return looked.select("record", candidate.alias("candidate"), F.when(override | ~stands, own).otherwise(F.col("type")).alias("type"), "how", status.alias("status"), reason.alias("reason"), override.alias("reviewed"))


def enriched(catalogue: DataFrame, candidates: DataFrame, evidence: DataFrame, people: DataFrame, overrides: DataFrame, attempts: DataFrame, as_of: Column, verify_ids: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records with what was decided applied, their attempts) of a catalogue with `identity` (E7, M4, M8); see `decided`."""
    out = saved(decided(catalogue, candidates, evidence, people, overrides, as_of, verify_ids), "decided")
    c = candidates.select(F.col("id").alias("candidate"), F.col("type").alias("c_type"), F.struct(F.col("id").alias("tmdb_id"), F.col("type").alias("tmdb_type"), F.coalesce("imdb_id", F.lit("")).alias("imdb_id"), F.coalesce("poster_path", F.lit("")).alias("poster"), F.coalesce(F.col("vote_average").try_cast("double"), F.lit(0.0)).alias("rating"), F.coalesce("language", F.lit("")).alias("language")).alias("m"))
    none = F.col("candidate").isNull() | F.col("type").isNull()  # these would all meet in one task
    some = out.where(~none)
    found = some.join(c, (some["candidate"] == c["candidate"]) & (some["type"] == c["c_type"]), "left").select(some["*"], "m")
    found = found.unionByName(out.where(none), allowMissingColumns=True)
    cross = F.coalesce(F.col("how") == "cross", F.lit(False)) & ~F.col("reviewed")
    meta = F.when(F.col("m").isNotNull(), F.struct("m.*", cross.alias("cross_type")))
    outcomes = found.select(F.col("record").alias("id"), "status", "reason", (F.lit(verify_ids) | F.col("reviewed")).alias("replace"), meta.alias("meta"))
    return records.enrich_batch(catalogue.drop("trouble"), saved(outcomes, "outcomes"), attempts, as_of)
