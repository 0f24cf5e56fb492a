"""Importance resampling towards a target: documents whose words and word pairs the target prefers are drawn more often.

Words and pairs of neighbours fall into buckets by crc32. A bucket's gain is the logarithm of how much more frequent it is in
the target than in the documents; gains are an array of fixed size, so a document is scored by looking its features up. Adding
Gumbel noise to the score makes the highest scores a draw without replacement. The exact k-th key is found digit by digit:
each pass counts the next digit of the composite key (score, id, row) among the rows that agree so far; only the drawn rows
are then sorted by ranges and numbered.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm import common, spans

#: The contract's parameters: buckets, hundredths of the documents that are drawn, least number of words, seed of the noise.
BUCKETS, SHARE, LEAST, SEED = 10_000, 25, 20, 7
#: Bits of a key's digit: a pass returns at most 2**DIGIT counts.
DIGIT = 12
#: Letters, digits and everything beyond ASCII make words.
_CLASSES = spans.classes(word=bytes([*range(48, 58), *range(97, 123), *range(128, 256)]))
#: Longer words are hashed one by one.
_TABLED = 256


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """What crc32 makes of one byte, and of a value (by its four bytes) that 0 to _TABLED zero bytes follow."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, one >> 1 ^ np.uint32(0xEDB88320), one >> 1)
    after = np.empty((_TABLED + 1, 4, 256), np.uint32)
    after[0] = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32)[:, None])
    for n in range(_TABLED):
        after[n + 1] = one[after[n] & 255] ^ (after[n] >> 8)
    return one, after


_ONE, _AFTER = _crc_tables()


def crcs(w: spans.Words) -> np.ndarray:
    """crc32 of every word."""
    out = np.zeros(len(w.size), np.uint32)
    order = np.argsort(-np.minimum(w.size, _TABLED + 1), kind="stable")
    long = np.searchsorted(-w.size[order], -_TABLED, "left")
    for k in order[:long]:
        out[k] = zlib.crc32(w.raw[w.start[k] : w.start[k] + w.size[k]].tobytes())
    rest = order[long:]
    size, start = w.size[rest], w.start[rest]
    state = np.full(len(rest), 0xFFFFFFFF, np.uint32)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, "left"))
        state[:n] = _ONE[(state[:n] ^ w.raw[start[:n] + k]) & 255] ^ (state[:n] >> 8)
    out[rest] = ~state
    return out


def pair_crcs(w: spans.Words, crc: np.ndarray, second: np.ndarray) -> np.ndarray:
    """crc32 of "a b" for the words b at the places `second`, a being the word before."""
    state = ~crc[second - 1]
    spaced = ~(_ONE[(state ^ 32) & 255] ^ (state >> 8))
    size = np.minimum(w.size[second], _TABLED)
    out = crc[second].copy()
    for k in range(4):
        out ^= _AFTER[size, k, (spaced >> np.uint32(8 * k)) & 255]
    for k in np.flatnonzero(w.size[second] > _TABLED):
        j = second[k]
        out[k] = zlib.crc32(w.raw[w.start[j] : w.start[j] + w.size[j]].tobytes(), int(spaced[k]))
    return out


def features(texts: pa.Array, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For slabs of texts: row and bucket of each word, then of each pair of neighbours, and which of them are words."""
    for w in spans.slabs(texts, _CLASSES):
        crc, second = crcs(w), np.flatnonzero(w.follows)
        new = ~w.again
        row, value = np.r_[w.row[new], w.row[second]], np.r_[crc[new], pair_crcs(w, crc, second)]
        yield row, (value % np.uint32(buckets)).astype(np.int64), np.arange(len(row)) < new.sum()


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (a column text without nulls) each bucket holds; a task sends its sums only."""
    schema = pa.schema([("bucket", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            for _, bucket, _ in features(b.column("text"), buckets):
                total += np.bincount(bucket, minlength=buckets)
        there = np.flatnonzero(total)
        yield common.batch_of(schema, pa.array(there, pa.int32()), pa.array(total[there]))

    out = np.zeros(buckets, np.int64)
    for r in texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln) of each bucket's smoothed share in the target over that in the source."""
    buckets, s, t = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + buckets) / ((a + 1.0) * (t + buckets)))) for a, b in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean of the features' gains, 0 without features."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words, n, total = (np.zeros(b.num_rows, np.int64) for _ in range(3))
            for row, bucket, word in features(b.column("text"), len(gain)):
                words += np.bincount(row[word], minlength=b.num_rows)
                n += np.bincount(row, minlength=b.num_rows)
                total += np.rint(np.bincount(row, gain[bucket], b.num_rows)).astype(np.int64)
            yield common.batch_of(schema, b.column("doc_id"), pa.array(words), pa.array(n), pa.array(np.where(n > 0, total // np.maximum(n, 1), 0)))

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(seed: int = SEED) -> Column:
    """floor(1000 * Gumbel noise) that the id decides."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _at_most(columns: list[str], limit: list[int]) -> Column:
    """(columns) <= (limit), the first column counting most."""
    out = F.lit(True)
    for c, v in zip(reversed(columns), reversed(limit)):
        out = (F.col(c) < v) | ((F.col(c) == v) & out)
    return out


def kth_key(rows: DataFrame, columns: list[str], k: int) -> list[int] | None:
    """A key that exactly k rows do not exceed, by the columns (long, no nulls, unique together) in ascending order;
    None for k = 0. Each pass counts one digit of DIGIT bits among the rows that agree in all digits before."""
    if k <= 0:
        return None
    ends = rows.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in columns for f in (F.min, F.max))).first()
    sign, found, left, same = 1 << 63, [], k, F.lit(True)
    for at, c in enumerate(columns):
        lo, hi = ends[f"min_{c}"] + sign, ends[f"max_{c}"] + sign
        bits = (lo ^ hi).bit_length()
        value, unsigned = lo >> bits << bits, F.col(c).bitwiseXOR(F.lit(-sign))
        while bits:
            low = max(0, bits - DIGIT)
            digit = F.shiftrightunsigned(unsigned, low).bitwiseAND(F.lit((1 << (bits - low)) - 1))
            counts = dict(rows.where(same).groupBy(digit.alias("digit")).count().collect())
            for d in sorted(counts):
                if counts[d] >= left:
                    break
                left -= counts[d]
            value |= d << low
            if counts[d] == left:  # all that agree so far are among the k
                rest = [ends[f"max_{x}"] for x in columns[at + 1 :]]
                return [*found, (value | ((1 << low) - 1)) - sign, *rest]
            same, bits = same & (F.shiftrightunsigned(unsigned, low) == F.lit(_signed(value >> low))), low
        found.append(value - sign)
        same = same & (F.col(c) == found[-1])
    return found


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def ranked(rows: DataFrame, columns: list[str], name: str = "rank") -> DataFrame:
    """rows with their place in the order of the columns, from 1. Rows are dealt by ranges and written with their range, so that
    counting and numbering see the same ranges; only the ranges' counts reach the driver."""
    from pyspark.sql import Window

    spark = rows.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = common.stored(rows.repartitionByRange(n, *columns).withColumn("__part", F.spark_partition_id()), "ranges")
    counts, before, starts = dict(dealt.groupBy("__part").count().collect()), 0, []
    for part in sorted(counts):
        starts.append((part, before))
        before += counts[part]
    offsets = F.broadcast(spark.createDataFrame(starts, "__part int, __before long"))  # a row a range
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*columns))
    return dealt.join(offsets, "__part").select(*rows.columns, (F.col("__before") + place).alias(name))


def resampled(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, share: int = SHARE, least: int = LEAST, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank for every row of docs (doc_id, text); rank is null where a row is not
    drawn. Of the N rows with at least `least` words, floor(share * N / 100) are drawn by score, ties to the smaller id.

    Null texts count as empty ones and have no features; null ids come after all others among ties; rows of equal score and id,
    repeated rows included, are each drawn on their own, in any order among them. An empty target makes gains of rarity alone; empty docs give no rows.
    Other columns are left behind.
    """
    docs = common.documents(docs)
    target = target.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    last = (1 << 63) - 1
    scored = weighed(docs, gain).withColumn("score", F.col("weight") + noise(seed))
    scored = scored.select("*", (-F.col("score")).alias("__down"), F.coalesce("doc_id", F.lit(last)).alias("__id"), F.monotonically_increasing_id().alias("__row"))
    scored = common.stored(scored, "scored")
    keys = ["__down", "__id", "__row"]
    able = F.col("n_words") >= least
    limit = kth_key(scored.where(able), keys, share * scored.where(able).count() // 100)
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    if limit is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    drawn = able & _at_most(keys, limit)
    rest = scored.where(~drawn).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(scored.where(drawn), keys).select(*columns, F.col("rank").cast("long")).unionByName(rest)


def op11_resample(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank for every document of the whole table, resampled towards the benchmark's texts."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return resampled(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def sql() -> str:
    """The same in DuckDB, with crc32 computed over the distinct features' bytes from a table that the query builds itself."""
    step = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
    rounds = "".join(f", r{k + 1} AS (SELECT i, {step.format('c')} AS c FROM r{k})" for k in range(8))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = rf"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    gram = "list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""WITH r0 AS (SELECT CAST(range AS BIGINT) AS i, CAST(range AS BIGINT) AS c FROM range(256)){rounds},
t AS (SELECT list(c ORDER BY i) AS tab FROM r8),
d0 AS (SELECT doc_id, {words} AS w FROM documents),
d AS (SELECT doc_id, len(w) AS n_words, {gram} AS f FROM d0),
b0 AS (SELECT {words} AS w FROM benchmark),
df AS (SELECT doc_id, unnest(f) AS f FROM d),
bf AS (SELECT unnest({gram}) AS f FROM b0),
dn AS (SELECT f, count(*) AS s FROM df GROUP BY f),
bn AS (SELECT f, count(*) AS t FROM bf GROUP BY f),
hexed AS (SELECT f, hex(encode(f)) AS h, coalesce(s, 0) AS s, coalesce(t, 0) AS t FROM dn FULL JOIN bn USING (f)),
crc AS (SELECT f, s, t, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, len(h) + 1, 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT))),
        lambda a, x: xor(tab[1 + (xor(a, x) & 255)], a >> 8))) % {BUCKETS} AS bucket FROM hexed, t),
per AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM crc GROUP BY bucket),
total AS (SELECT sum(s) AS s, sum(t) AS t FROM crc),
gain AS (SELECT bucket, CAST(floor(1000 * ln((CAST(per.t AS DOUBLE) + 1) * (total.s + {BUCKETS}) / ((CAST(per.s AS DOUBLE) + 1) * (total.t + {BUCKETS})))) AS BIGINT) AS g FROM per, total),
weighed AS (SELECT doc_id, count(*) AS n, sum(g) AS g FROM df JOIN crc USING (f) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT d.doc_id, n_words, coalesce(n, 0) AS n_features, CAST(coalesce(floor(CAST(g AS DOUBLE) / n), 0) AS BIGINT) AS weight,
        CAST(floor(-1000 * ln(-ln((CAST('0x' || sha256('{SEED}:' || CAST(d.doc_id AS VARCHAR))[1:8] AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS noise
    FROM d LEFT JOIN weighed USING (doc_id)),
placed AS (SELECT *, weight + noise AS score, CASE WHEN n_words >= {LEAST} THEN row_number() OVER (PARTITION BY n_words >= {LEAST} ORDER BY weight + noise DESC, doc_id) END AS place FROM scored),
drawn AS (SELECT {SHARE} * count(*) // 100 AS k FROM scored WHERE n_words >= {LEAST})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, weight, CAST(score AS BIGINT) AS score, CAST(CASE WHEN place <= k THEN place END AS BIGINT) AS rank
FROM placed, drawn"""
