"""Queries over the event log as a state log: merges, delays, verdicts, replays."""

from __future__ import annotations

from pyspark.sql import functions as F

from cairn.functions import text
from cairn.operators import merge, records, resolve, schedule, worker
from cairn.sources import tables
from cairn.sources.scratch import folder
from cairn.sources.tables import AS_OF, table

US = "CAST(epoch_us(ts) AS BIGINT)"


def events(spark, d):
    """The event log with its time in microseconds, `at`."""
    return table(spark, d, "events").withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))


def as_of():
    return F.unix_micros(F.lit(AS_OF).cast("timestamp"))


def writers(spark, d):
    e = events(spark, d).select("user_id", "event_id", "event_type", "at")
    one = lambda k: merge.latest(e.where(F.col("event_id") % 2 == k), "user_id", "at", "event_id")
    return one(0), one(1)


def merge_states(spark, d):
    """Two writers' latest entries a key; the newer wins."""
    return merge.merge_latest(*writers(spark, d), "user_id", "at")


def merge_miss_earliest(spark, d):
    """The earliest miss stays."""
    e = events(spark, d).where("event_type = 'error'")
    return merge.merge_earliest(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "at")


def merge_attempts(spark, d):
    """The later check wins, at a tie a matched one of ours. Times are cut to days to make ties."""
    e = events(spark, d).select("user_id", "event_id", F.floor(F.col("at") / 86_400_000_000).alias("day"), F.when(F.col("event_type") == "purchase", "matched").otherwise("unresolved").alias("status"))
    ours, theirs = (merge.latest(e.where(F.col("event_id") % 2 == k), "user_id", "day", "event_id") for k in (0, 1))
    return merge.merge_attempts(ours, theirs, "user_id", "day", "status").select("user_id", "event_id", "day", "status")


def merge_cursor(spark, d):
    """The farther cursor (pass, letter, page) of two writers a day, with the later end of a pass, and the
    other's finish if the winner has none."""
    e = events(spark, d).select("event_id", F.floor(F.col("at") / 86_400_000_000).alias("day"), (F.col("event_id") % 3).alias("pass"), F.char(97 + F.col("user_id") % 26).alias("letter"), F.get_json_object("props", "$.k").cast("bigint").alias("page"), F.when(F.col("event_type") == "signup", F.col("at")).alias("last_pass_at"), F.when(F.col("event_type") == "error", F.col("at")).alias("finished_at"))
    ours, theirs = (merge.latest(e.where(F.col("event_id") % 2 == k), "day", "event_id").drop("event_id") for k in (0, 1))
    return merge.merge_cursors(ours, theirs, "day")


def merge_letters(spark, d):
    """Two writers' letters of a user, ours where both have one."""
    e = events(spark, d).groupBy("user_id", (F.col("event_id") % 2).alias("w"), "event_type").agg(F.max("event_id").alias("page"))
    ours, theirs = (e.where(F.col("w") == k).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "page"))).alias("letters")) for k in (0, 1))
    m = merge.merge_letters(ours, theirs, "user_id", "letters")
    return m.select("user_id", F.array_join(F.array_sort(F.transform(F.map_entries("letters"), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))), ",").alias("letters"))


def run_counters(spark, d):
    """What a run's own commit of catalogue, index and state counted while writing them."""
    known = merge.latest(events(spark, d).select("user_id", "event_id", "event_type", "at"), "user_id", "at", "event_id")
    counters = {"records": F.count("*"), "failed": F.count_if(F.col("event_type") == "error"), "stored": F.count_if(F.col("event_type") == "purchase"), "newest": F.max("at")}
    number, seen = tables.save_all(known, known.select("user_id"), known.select("user_id", "at"), folder(spark, "run"), counters)
    return spark.createDataFrame([(number, *(seen[c] for c in counters))], "commit bigint, records bigint, failed bigint, stored bigint, newest bigint")


def worker_run(spark, d):
    """What a run reaches of a queue of all events in order: lookups of four at once, within an hour's budget, until the
    keys are down, with those that take too long or too many requests."""
    e = events(spark, d).withColumn("place", F.col("event_id") - F.lit(table(spark, d, "events").agg(F.min("event_id")).first()[0]) + 1)
    cost = F.floor(F.col("value") * 997).cast("long") % 60_000
    q = e.select("place", F.col("event_id").cast("string").alias("id"), cost.alias("cost_ms"), (F.col("user_id") % 130).cast("int").alias("requests"), F.lit(False).alias("outage"), F.lit("matched").alias("status"), F.col("event_type").alias("reason"))
    return worker.planned(q, worker.Limits(budget_ms=3_600_000)).select("id", "batch", "start_ms", "status", "reason", "save")


def per_user(spark, d):
    e = events(spark, d)
    last = F.max("at").alias("last_at")
    return e.groupBy("user_id").agg(last, F.count_if(F.col("event_type") == "error").alias("failures"), F.count_if(F.col("event_type") == "purchase").alias("stored"), F.count_if(F.col("event_type") == "signup").alias("signups"), F.count("*").alias("n"))


def _walks(spark, d):
    """Users as listed items, as records of which some are missing or empty, and as state entries."""
    u, n = per_user(spark, d), F.col("user_id")
    text_ = lambda *parts: F.concat(*(F.lit(x) if isinstance(x, str) else x.cast("string") for x in parts))
    items = u.select("user_id", text_("https://h/", n, "/").alias("url"), text_("/", n, "/").alias("path"), text_("user ", n).alias("title"), F.lit(2024).alias("year"))
    link = F.array(F.struct(F.lit("HD").alias("quality"), F.lit("u").alias("url")))
    rows = u.where("user_id % 5 <> 0").select(F.when(n % 3 == 0, text_("user-", n, "-2024")).otherwise(text_("x-", n)).alias("id"), F.when(n % 2 == 0, "series").alias("kind"), text_("https://other/", n, "//?q").alias("page_url"), F.when(F.col("stored") >= 12, link).otherwise(F.slice(link, 1, 0)).alias("embeds"), n.alias("pos"))
    last = F.timestamp_micros("last_at")
    again = F.when(F.col("n") % 3 == 0, last + F.make_dt_interval(hours=(F.col("n") % 4 * 12).cast("int")))
    state = u.where("user_id % 7 <> 0").select(text_("https://h/", n, "/").alias("url"), last.alias("at"), F.when(n % 5 == 0, F.col("stored") % 3).otherwise(0).cast("int").alias("embeds"), F.when(n % 4 == 0, "series").alias("kind"), (F.col("failures") > 8).alias("empty"), (F.col("signups") % 3).cast("int").alias("v"), F.greatest(F.col("failures") - 9, F.lit(0)).cast("int").alias("failures"), again.alias("retry_after"))
    return items, rows, state


def walk_verdict(spark, d):
    """What to do with each item."""
    return schedule.verdicts(*_walks(spark, d), F.lit(AS_OF).cast("timestamp")).select("user_id", "walk", "why")


def sweep_summary(spark, d):
    """What a sweep of the pages found empty would walk, by reason."""
    v = schedule.verdicts(*_walks(spark, d), F.lit(AS_OF).cast("timestamp"), schedule.Rules(sweep_empty=True))
    return v.groupBy("walk", "why").agg(F.count("*").alias("n"))


_WALKS = """WITH u AS (SELECT user_id, max(ts) AS last_at, count(*) FILTER (event_type = 'error') AS f, count(*) FILTER (event_type = 'purchase') AS s, count(*) FILTER (event_type = 'signup') AS g, count(*) AS n FROM events GROUP BY user_id),
x AS (SELECT user_id, TIMESTAMP '2024-01-31 00:00:00' AS now, user_id % 5 <> 0 AND s >= 12 AS has, user_id % 2 = 0 AS series, user_id % 7 <> 0 AS known, user_id % 7 <> 0 AND user_id % 5 = 0 AND s % 3 > 0 AS walked, user_id % 4 = 0 OR (user_id % 5 <> 0 AND user_id % 3 = 0 AND user_id % 2 = 0) AS known_series, user_id % 7 <> 0 AND f > 8 AS empty, g % 3 < 2 AS old, greatest(f - 9, 0) AS fails, last_at,
greatest(last_at + to_minutes(CAST(CASE WHEN f > 9 THEN least(24.0, 1.5 * pow(2, least(f - 9, 4))) * 60 ELSE 1440 END AS INT)), CASE WHEN n % 3 = 0 THEN last_at + to_hours(CAST(n % 4 * 12 AS INT)) ELSE TIMESTAMP '1970-01-01' END) AS until FROM u)"""

VERDICT_SQL = _WALKS + """, y AS (SELECT user_id, CASE WHEN has AND series AND (NOT known OR now >= last_at + INTERVAL 24 HOURS) THEN '+series refresh' WHEN has AND series THEN 'series fresh' WHEN has THEN 'stored' WHEN walked AND NOT known_series THEN 'stored (another path)' WHEN walked AND now >= last_at + INTERVAL 24 HOURS THEN '+series refresh' WHEN walked THEN 'series fresh'
WHEN empty AND old THEN '+newer walker' WHEN empty AND now < until AND fails > 0 THEN 'failed' WHEN empty AND now < until THEN 'empty' ELSE '+new or due' END AS w FROM x) SELECT user_id, w LIKE '+%' AS walk, ltrim(w, '+') AS why FROM y"""


def skip_reasons(spark, d):
    """A3: how often each family of skip reasons comes, the most frequent first."""
    reasons = walk_verdict(spark, d).where("NOT walk").select(F.concat("why", F.when(F.col("user_id") % 2 == 0, " · refresh in 5h").otherwise(" · retry in 2d")).alias("why"))
    return reasons.groupBy(text.family(F.col("why")).alias("family")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "family")


def failure_backoff(spark, d):
    """V1's delays by number of failures."""
    f = F.least(F.col("failures"), F.lit(12)).cast("int")
    return per_user(spark, d).select("user_id", f.alias("failures"), schedule.failure_hours(f).cast("double").alias("hours"))


def attempt_backoff(spark, d):
    """M8: the next delay by status and attempts."""
    e = events(spark, d)
    status = F.when(F.col("event_type") == "purchase", "matched").when(F.col("event_type") == "error", "unavailable").when(F.col("event_type") == "signup", "review").otherwise("unresolved")
    n = e.groupBy("user_id", status.alias("status")).agg(F.count("*").alias("attempts"))
    n = n.withColumn("attempts", F.col("attempts") % 6)
    return n.select("user_id", "status", "attempts", schedule.attempt_hours(F.col("status"), F.col("attempts")).cast("bigint").alias("hours"))


def due_filter(spark, d):
    """F8: whether keys are due at the given time: as they are, when old ones are stale, and when forced."""
    u = per_user(spark, d)
    last = F.timestamp_micros("last_at")
    next_at, now = last + F.make_dt_interval(hours=(F.col("failures") % 4 * 12).cast("int")), F.lit(AS_OF).cast("timestamp")
    is_due = lambda **how: schedule.due(F.col("n") % 5 != 0, next_at, last, now, **how)
    return u.select("user_id", is_due().alias("due"), is_due(stale_days=1).alias("due_stale"), is_due(force=F.col("n") % 2 == 0).alias("due_forced"))


def attempt_reset(spark, d):
    """The attempts after one more outcome; a changed identity or version starts again."""
    u = per_user(spark, d)
    u = u.withColumn("p", F.when(F.col("user_id") % 6 > 0, F.struct(F.when(F.col("user_id") % 5 > 0, 2).otherwise(1).alias("version"), F.when(F.col("user_id") % 4 > 0, "i").otherwise("j").alias("identity"), (F.col("failures") % 5).cast("int").alias("attempts"))))
    status = F.when(F.col("n") % 3 == 0, "unresolved").when(F.col("n") % 3 == 1, "review").otherwise("unavailable")
    e = records.remember("p", F.lit("i"), status, F.timestamp_micros("last_at"))
    return u.select("user_id", e.alias("e")).select("user_id", "e.status", "e.attempts", F.timestamp_diff("HOUR", "e.checked_at", "e.next_at").alias("hours"))


def walk_states(spark, d):
    """R2: the state entry of a key after one more walk."""
    u = per_user(spark, d).withColumn("p", F.struct((F.col("failures") % 6).cast("int").alias("failures"), (F.col("signups") % 4).cast("int").alias("retries")))
    e = schedule.after_walk("p", F.when(F.col("n") % 3 == 0, 2).otherwise(0), F.lit("movie"), F.col("n") % 2 == 0, F.timestamp_micros("last_at"), 2)
    return u.select("user_id", e.alias("e")).select("user_id", "e.embeds", "e.empty", "e.retries", "e.failures", F.timestamp_diff("MINUTE", "e.at", "e.retry_after").alias("minutes"))


def merge_attempt_states(spark, d):
    """Misses that a later match has made stale go."""
    e = events(spark, d).select(F.col("user_id").alias("id"), "event_id", "at", F.when(F.col("event_type") == "purchase", "matched").otherwise("unresolved").alias("status"))
    ours, theirs = (merge.latest(e.where(F.col("event_id") % 2 == k), "id", "at", "event_id").select("id", F.col("at").alias("checked_at"), "status") for k in (0, 1))
    misses = e.where("status = 'unresolved'").select("id").distinct()
    return records.merge_attempt_states(ours, theirs, misses)[1]


def cached_evidence(spark, d):
    """Evidence read from the same page in the last week."""
    e = events(spark, d).select(F.concat(F.lit("https://a/"), F.col("user_id").cast("string")).alias("source_url"), F.timestamp_micros("at").alias("fetched_at"), (F.col("event_type") != "error").alias("available"), "event_id")
    r = per_user(spark, d).select("user_id", F.concat(F.lit("https://b/"), F.col("user_id").cast("string"), F.lit("/")).alias("page_url"))
    return resolve.cached_evidence(r, e, F.lit("2024-01-20").cast("timestamp") + F.expr("INTERVAL 11 DAYS")).select("user_id", F.col("evidence.event_id").alias("event_id"))


def worst_verdict(spark, d):
    """A key's worst verdict of a day: dead before unknown before alive."""
    rank = F.when(F.col("event_type") == "error", 2).when(F.col("event_type") == "view", 1).otherwise(0)
    w = events(spark, d).groupBy("user_id", F.floor(F.col("at") / 86_400_000_000).alias("day")).agg(F.max(rank).alias("severity"))
    return w.select("user_id", "day", F.element_at(F.array(*map(F.lit, ("alive", "unknown", "dead"))), F.col("severity") + 1).alias("verdict"))


def probe_verdict(spark, d):
    """The verdict on a probe from its status, length and marker."""
    k = F.get_json_object("props", "$.k").cast("int")
    status = F.when(k % 7 == 0, 404).when(k % 7 == 1, 503).when(k % 7 == 2, 410).otherwise(200)
    e = events(spark, d).select("event_id", status.alias("status"), (F.col("value") * 40).cast("bigint").alias("length"), (F.col("event_type") != "view").alias("marker"))
    v = F.when(F.col("status").isin(404, 410), "dead").when(F.col("status") != 200, "unknown").when((F.col("length") >= 400) & F.col("marker"), "alive").otherwise("dead")
    return e.select("event_id", "status", v.alias("verdict"))


def probe_targets(spark, d):
    """Keys not checked within twelve hours and not touched in this run, the earliest event as target."""
    e = events(spark, d)
    touched = e.where("event_id % 97 = 0").select("user_id").distinct()
    old = e.groupBy("user_id").agg(F.max("at").alias("last_at"), F.min("event_id").alias("target")).where(F.col("last_at") < as_of() - F.lit(43_200_000_000))
    return old.join(touched, "user_id", "left_anti").select("user_id", "target")


def cursor_replay(spark, d):
    """Pages completed in each pass of the log, and where it resumes."""
    e = events(spark, d).select((F.floor(F.col("event_id") / 500)).alias("pass"), (F.floor(F.col("event_id") / 25) % 20).alias("page"), (F.col("event_type") == "error").cast("int").alias("bad"))
    p = e.groupBy("pass", "page").agg(F.sum("bad").alias("errors"))
    return p.groupBy("pass").agg(F.count_if(F.col("errors") < 8).alias("completed"), F.min(F.when(F.col("errors") >= 8, F.col("page"))).alias("resume_at"))


def run_health(spark, d):
    """The run's exit rule: red if at least ten were walked and none stored, or errors and nothing walked."""
    day = events(spark, d).groupBy(F.floor(F.col("at") / 86_400_000_000).alias("day")).agg(F.count_if(F.col("event_type") == "view").alias("walked"), F.count_if((F.col("event_type") == "purchase") & (F.col("value") > 40)).alias("stored"), F.count_if(F.col("event_type") == "error").alias("errors"))
    red = ((F.col("walked") >= 10) & (F.col("stored") == 0)) | ((F.col("errors") > 0) & (F.col("walked") == 0))
    return day.select("day", "walked", "stored", "errors", F.when(red, "red").otherwise("green").alias("health"))


QUERIES = {f.__name__: f for f in (merge_states, merge_miss_earliest, merge_attempts, merge_cursor, merge_letters, run_counters, worker_run, walk_verdict, skip_reasons, failure_backoff, attempt_backoff, due_filter, attempt_reset, walk_states, merge_attempt_states, cached_evidence, worst_verdict, probe_verdict, probe_targets, sweep_summary, cursor_replay, run_health)}

SQL = {
    "merge_states": f"SELECT user_id, arg_max(event_id, (epoch_us(ts), event_id)) AS event_id, arg_max(event_type, (epoch_us(ts), event_id)) AS event_type, max({US}) AS at FROM events GROUP BY user_id",
    "merge_miss_earliest": f"SELECT user_id, min({US}) AS at FROM events WHERE event_type = 'error' GROUP BY user_id",
    "merge_attempts": """WITH e AS (SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) AS day, CASE WHEN event_type = 'purchase' THEN 'matched' ELSE 'unresolved' END AS status, event_id % 2 AS w FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY user_id, w ORDER BY day DESC, event_id DESC) = 1)
SELECT user_id, event_id, day, status FROM l QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, CASE WHEN w = 1 THEN 1 WHEN status = 'matched' THEN 2 ELSE 0 END DESC) = 1""",
    "merge_cursor": """WITH e AS (SELECT event_id, event_id % 2 AS w, CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) AS day, event_id % 3 AS pass, chr(CAST(97 + user_id % 26 AS INT)) AS letter, CAST(props->>'$.k' AS BIGINT) AS page, CASE WHEN event_type = 'signup' THEN CAST(epoch_us(ts) AS BIGINT) END AS last_pass_at, CASE WHEN event_type = 'error' THEN CAST(epoch_us(ts) AS BIGINT) END AS finished_at FROM events),
l AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY day, w ORDER BY event_id DESC) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY pass DESC, letter DESC, page DESC, w) AS n, max(last_pass_at) OVER (PARTITION BY day) AS latest, max(finished_at) OVER (PARTITION BY day ORDER BY pass DESC, letter DESC, page DESC, w ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS other FROM l)
SELECT day, pass, letter, page, latest AS last_pass_at, coalesce(finished_at, other) AS finished_at FROM r WHERE n = 1""",
    "merge_letters": "WITH e AS (SELECT user_id, event_type, coalesce(max(event_id) FILTER (event_id % 2 = 0), max(event_id)) AS page FROM events GROUP BY ALL) SELECT user_id, string_agg(event_type || '=' || page, ',' ORDER BY event_type) AS letters FROM e GROUP BY user_id",
    "run_counters": f"WITH l AS (SELECT user_id, arg_max(event_type, (epoch_us(ts), event_id)) AS t, max({US}) AS last FROM events GROUP BY user_id) SELECT 1::BIGINT AS commit, count(*) AS records, count(*) FILTER (t = 'error') AS failed, count(*) FILTER (t = 'purchase') AS stored, max(last) AS newest FROM l",
    "worker_run": """WITH q AS (SELECT event_id, CAST(floor(value * 997) AS BIGINT) % 60000 AS cost, user_id % 130 AS asked, event_type, (event_id - (SELECT min(event_id) FROM events)) // 4 AS batch FROM events),
b AS (SELECT batch, max(least(cost, 45000)) AS length FROM q GROUP BY batch), s AS (SELECT batch, CAST(sum(length) OVER (ORDER BY batch) - length AS BIGINT) AS start_ms FROM b)
SELECT CAST(event_id AS VARCHAR) AS id, batch, start_ms, CASE WHEN cost > least(45000, 3600000 - start_ms) OR asked > 120 THEN 'unavailable' ELSE 'matched' END AS status,
  CASE WHEN cost > least(45000, 3600000 - start_ms) THEN 'lookup-timeout' WHEN asked > 120 THEN 'request-cap' ELSE event_type END AS reason, start_ms // 15000 AS save FROM q JOIN s USING (batch) WHERE start_ms < 3600000""",
    "walk_verdict": VERDICT_SQL,
    "skip_reasons": f"SELECT why AS family, count(*) AS n FROM ({VERDICT_SQL}) WHERE NOT walk GROUP BY 1",
    "failure_backoff": "SELECT user_id, CAST(f AS INT) AS failures, CAST(CASE WHEN f > 0 THEN least(24.0, 1.5 * pow(2, least(f, 4))) ELSE 0 END AS DOUBLE) AS hours FROM (SELECT user_id, least(count(*) FILTER (event_type = 'error'), 12) AS f FROM events GROUP BY user_id)",
    "attempt_backoff": """WITH n AS (SELECT user_id, CASE event_type WHEN 'purchase' THEN 'matched' WHEN 'error' THEN 'unavailable' WHEN 'signup' THEN 'review' ELSE 'unresolved' END AS status, count(*) % 6 AS attempts FROM events GROUP BY ALL)
SELECT user_id, status, attempts, CAST(CASE status WHEN 'matched' THEN 720 WHEN 'unavailable' THEN [1, 6, 24][greatest(least(attempts, 3), 1)] WHEN 'review' THEN [168, 720][greatest(least(attempts, 2), 1)] ELSE [6, 24, 72, 168][greatest(least(attempts, 4), 1)] END AS BIGINT) AS hours FROM n""",
    "due_filter": f"WITH u AS (SELECT user_id, max(ts) AS l, count(*) AS n, count(*) FILTER (event_type = 'error') AS f, TIMESTAMP '{AS_OF}' AS now FROM events GROUP BY user_id), p AS (SELECT *, n % 5 = 0 OR l + to_hours(CAST(f % 4 * 12 AS INT)) <= now AS due FROM u) SELECT user_id, due, due OR l <= now - INTERVAL 1 DAY AS due_stale, due OR n % 2 = 0 AS due_forced FROM p",
    "worst_verdict": "SELECT user_id, CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) AS day, ['alive', 'unknown', 'dead'][1 + max(CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 1 ELSE 0 END)] AS verdict FROM events GROUP BY 1, 2",
    "probe_verdict": """WITH e AS (SELECT event_id, CAST(CASE CAST(props->>'$.k' AS INT) % 7 WHEN 0 THEN 404 WHEN 1 THEN 503 WHEN 2 THEN 410 ELSE 200 END AS INT) AS status, CAST(trunc(value * 40) AS BIGINT) AS length, event_type <> 'view' AS marker FROM events)
SELECT event_id, status, CASE WHEN status IN (404, 410) THEN 'dead' WHEN status <> 200 THEN 'unknown' WHEN length >= 400 AND marker THEN 'alive' ELSE 'dead' END AS verdict FROM e""",
    "probe_targets": f"SELECT user_id, min(event_id) AS target FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '{AS_OF}' - INTERVAL 12 HOURS AND NOT bool_or(event_id % 97 = 0)",
    "sweep_summary": _WALKS + """, y AS (SELECT CASE WHEN has THEN 'stored' WHEN walked AND NOT known_series THEN 'stored (another path)' WHEN walked THEN '+series refresh' WHEN empty AND old THEN '+empty from the old walker' WHEN empty THEN '+empty-page sweep' ELSE 'not a tracked-empty page' END AS w FROM x) SELECT w LIKE '+%' AS walk, ltrim(w, '+') AS why, count(*) AS n FROM y GROUP BY ALL""",
    "cursor_replay": "SELECT pass, count(*) FILTER (errors < 8) AS completed, min(page) FILTER (errors >= 8) AS resume_at FROM (SELECT event_id // 500 AS pass, (event_id // 25) % 20 AS page, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL) GROUP BY pass",
    "run_health": "SELECT *, CASE WHEN walked >= 10 AND stored = 0 OR errors > 0 AND walked = 0 THEN 'red' ELSE 'green' END AS health FROM (SELECT CAST(floor(epoch_us(ts) / 86400000000.0) AS BIGINT) AS day, count(*) FILTER (event_type = 'view') AS walked, count(*) FILTER (event_type = 'purchase' AND value > 40) AS stored, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1)",
    "attempt_reset": """WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS f FROM events GROUP BY user_id),
a AS (SELECT user_id, CASE n % 3 WHEN 0 THEN 'unresolved' WHEN 1 THEN 'review' ELSE 'unavailable' END AS status, CAST(CASE WHEN user_id % 6 > 0 AND user_id % 5 > 0 AND user_id % 4 > 0 THEN f % 5 + 1 ELSE 1 END AS INT) AS attempts FROM u)
SELECT *, CAST(CASE status WHEN 'unresolved' THEN [6, 24, 72, 168][least(attempts, 4)] WHEN 'review' THEN [168, 720][least(attempts, 2)] ELSE [1, 6, 24][least(attempts, 3)] END AS BIGINT) AS hours FROM a""",
    "walk_states": """WITH u AS (SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS f, count(*) FILTER (event_type = 'signup') AS g FROM events GROUP BY user_id), a AS (SELECT *, CASE WHEN n % 2 = 0 THEN 0 ELSE f % 6 + 1 END AS failures FROM u)
SELECT user_id, CAST(CASE WHEN n % 3 = 0 THEN 2 ELSE 0 END AS INT) AS embeds, n % 3 <> 0 AS empty, CAST(CASE WHEN n % 3 = 0 THEN 0 ELSE g % 4 + 1 END AS INT) AS retries, CAST(failures AS INT) AS failures, CAST(CASE WHEN failures > 0 THEN least(1440, 90 * pow(2, least(failures - 1, 4))) END AS BIGINT) AS minutes FROM a""",
    "merge_attempt_states": """WITH l AS (SELECT user_id, event_id % 2 AS w, arg_max(event_type, (ts, event_id)) AS t, max(ts) AS last_at FROM events GROUP BY ALL), m AS (SELECT user_id, t FROM l QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY last_at DESC, CASE WHEN w = 1 THEN 1 WHEN t = 'purchase' THEN 2 ELSE 0 END DESC) = 1)
SELECT DISTINCT user_id AS id FROM events WHERE event_type <> 'purchase' AND user_id NOT IN (SELECT user_id FROM m WHERE t = 'purchase')""",
    "cached_evidence": "SELECT u.user_id, e.event_id FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN (SELECT user_id, arg_max(event_id, ts) AS event_id FROM events WHERE event_type <> 'error' AND ts > TIMESTAMP '2024-01-24' GROUP BY 1) e ON e.user_id = u.user_id",
}
