"""The same merges over a stream: replays that read what is there and stop."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators import merge
from cairn.operators.schedule import failure_hours
from cairn.sources.scratch import folder
from cairn.sources import crawl
from cairn.sources.tables import current, publish, table
from cairn.streaming import retries


def event_stream(spark, sf_dir: str) -> DataFrame:
    """The event log as a stream; its time becomes a timestamp, which watermarks need."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def replay(stream: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """Latest entry of each key, merged batch by batch into the state published below root: newer wins.

    Each batch starts from the published version, and the checkpoint remembers what was read, so a stopped replay
    goes on where it was (R1); a batch that is run again merges to the same state.
    """

    def fold(batch: DataFrame, number: int) -> None:
        fresh = merge.latest(batch.select("user_id", "event_id", "event_type", F.unix_micros("ts").alias("at")), "user_id", "at", "event_id")
        known = current(batch.sparkSession, root)
        publish(fresh if known is None else merge.merge_latest(fresh, known, "user_id", "at"), root)

    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return current(stream.sparkSession, root)


def deduplicated(spark, sf_dir: str) -> DataFrame:
    """Each (key, type) once a run, with state that a watermark bounds."""
    out, check = folder(spark, "seen"), folder(spark, "checkpoint")
    s = event_stream(spark, sf_dir).withWatermark("ts", "60 days").dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type")
    s.writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(s.schema).parquet(out)


def stream_merge_states(spark, d):
    """The replay ends with what one batch gives."""
    return replay(event_stream(spark, d), folder(spark, "state"), folder(spark, "checkpoint"))


def stream_dedupe(spark, d):
    """R4."""
    return deduplicated(spark, d)


def stream_failures(spark, d):
    """R2: failures in a row of each key, and the hours until its next try."""
    out = folder(spark, "streaks")
    retries.run(event_stream(spark, d), out, folder(spark, "checkpoint"))
    seen = spark.read.schema(retries.OUT).parquet(out).where("reason = 'seen'")
    last = merge.latest(seen, "user_id", "at", "event_id")
    return last.select("user_id", "event_id", "failures", failure_hours(F.col("failures")).alias("hours"))


def stream_due(spark, d):
    """Keys whose timer has fired: failures are due again after their delay, others when their refresh window ends."""
    out = folder(spark, "due")
    retries.run(event_stream(spark, d), out, folder(spark, "checkpoint"))
    return spark.read.schema(retries.OUT).parquet(out).where("reason <> 'seen'").select("user_id", "reason", "failures", F.unix_millis("at").alias("due"))


def crawl_pages(spark, d):
    """Listing pages of parts, read letter by letter until one fails."""
    part, root = table(spark, d, "part"), folder(spark, "site")
    key = F.col("p_partkey")
    rows = part.select(F.char(97 + key % 26).alias("letter"), (F.floor(key / (26 * 40)) + 1).alias("page"), F.lit(1).alias("attempt"), F.when((key % 26 == 16) & (key < 26 * 40), 503).otherwise(200).alias("status"), key.alias("pos"), F.concat(F.lit("/part-"), key.cast("string"), F.lit("/")).alias("path"), F.col("p_name").alias("label"))
    rows.repartition("letter", "page").write.partitionBy("letter", "page").json(root)
    return crawl.crawl(spark, root, folder(spark, "crawled"), folder(spark, "checkpoint")).select("pass", "letter", "page", "path", "label")


QUERIES = {"crawl_pages": crawl_pages, "stream_merge_states": stream_merge_states, "stream_dedupe": stream_dedupe, "stream_failures": stream_failures, "stream_due": stream_due}

_STREAKS = """g AS (SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max((ts, event_id)) FILTER (event_type <> 'error') AS good, max(ts) AS last FROM events GROUP BY user_id),
f AS (SELECT g.user_id, g.event_id, last, (good)[1] AS good, (SELECT count(*) FROM events e WHERE e.user_id = g.user_id AND e.event_type = 'error' AND (g.good IS NULL OR (e.ts, e.event_id) > g.good)) AS failures FROM g),
s AS (SELECT *, CASE WHEN failures > 0 THEN least(24.0, 1.5 * pow(2, least(failures, 4))) ELSE 0.0 END AS hours FROM f)"""

SQL = {
    "crawl_pages": "SELECT 1 AS pass, chr(CAST(97 + p_partkey % 26 AS INT)) AS letter, CAST(p_partkey // 1040 + 1 AS INT) AS page, '/part-' || p_partkey || '/' AS path, p_name AS label FROM part WHERE p_partkey % 26 < 16",
    "stream_merge_states": "SELECT user_id, arg_max(event_id, (epoch_us(ts), event_id)) AS event_id, arg_max(event_type, (epoch_us(ts), event_id)) AS event_type, CAST(max(epoch_us(ts)) AS BIGINT) AS at FROM events GROUP BY user_id",
    "stream_dedupe": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_failures": f"WITH {_STREAKS} SELECT user_id, event_id, failures, hours FROM s",
    "stream_due": f"WITH {_STREAKS}, w AS (SELECT epoch_us(max(ts)) // 1000 - 3600000 AS w FROM events), x AS (SELECT user_id, CASE WHEN failures > 0 THEN 'retry' ELSE 'refresh' END AS reason, failures, epoch_us(CASE WHEN failures > 0 THEN last ELSE good END) // 1000 + CAST(CASE WHEN failures > 0 THEN hours ELSE 24 END * 3600000 AS BIGINT) AS due FROM s) SELECT x.* FROM x, w WHERE due <= w",
}
