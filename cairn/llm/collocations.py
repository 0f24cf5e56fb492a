"""Collocations: phrases of several words that occur more often together than their parts suggest.

Each shard of texts becomes a generalised suffix automaton over words, bounded in depth: its states are the sets of places where
runs of words end, with their sizes as counts, and its suffix links lead from a run to the longest run that ends at more places.
Counting the states' runs over all shards gives every phrase's frequency. A phrase can only be frequent if
all phrases in it are, so passes go from words to pairs, triples and longer ones, and what a pass finds to be frequent is marked
in a bitmap of fixed size: unmarked phrases part a text for the next pass, and one that is marked by chance costs only time. Links of one word, at the front and at the end, then find the phrases that a longer one stands for.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import common, spans

#: The contract's parameters: words of a phrase, least frequency, hundredths of a phrase's frequency at which a longer one
#: stands for it, phrases a language.
DEPTH, LEAST, PERCENT, TOP = 5, 100, 100, 2000
#: Bits of a bitmap: 4 MB, however large the corpus is.
BITS = 25
#: Bytes of text in a shard's automaton, and parts into which a language's phrases are dealt before the last ranking.
SHARD, PARTS = 4 << 20, 64
_CLASSES = spans.classes(white=b" \t", border=b".,;:!?\n\x0b\x0c\r")
#: Phrases whose texts are made at once.
_BATCH = 1 << 16
#: Lengths of the phrases that a pass counts; what it finds to be frequent is marked for the next one.
STEPS = ((2, 2), (3, 3), (4, DEPTH))
#: The language of texts whose language is null.
UNKNOWN = "und"


class Shard(NamedTuple):
    """Texts of one language: the distinct words, each occurrence's word, whether it continues the piece of the one before,
    and whether it was counted in another shard."""

    lang: str
    words: pa.Array
    codes: np.ndarray
    follows: np.ndarray
    again: np.ndarray


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for b in batches:
        text, lang = b.column("text"), b.column("lang").dictionary_encode()
        for k, name in enumerate(lang.dictionary.to_pylist()):
            for w in spans.slabs(text.filter(pc.equal(lang.indices, k)), _CLASSES, SHARD, DEPTH - 1):
                if len(w.start):
                    coded = w.array().dictionary_encode()
                    yield Shard(name, coded.dictionary, coded.indices.to_numpy(), w.follows, w.again)


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase, n: how often each word occurs; a task sends each word of a shard once."""
    schema = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            n = np.bincount(s.codes[~s.again], minlength=len(s.words))
            yield common.batch_of(schema, pa.repeat(pa.scalar(s.lang), len(n)), s.words.cast(pa.string()), pa.array(n)).filter(pa.array(n > 0))
        common.trim()

    return docs.mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def word_hash(lang: Column, word: Column) -> Column:
    """The number that `word_hashes` gives a word."""
    return F.crc32(F.concat(lang, F.lit("\0"), word).cast("binary"))


def word_hashes(s: Shard) -> np.ndarray:
    seed = zlib.crc32(s.lang.encode() + b"\0")
    return np.fromiter((zlib.crc32(w, seed) for w in s.words.to_pylist()), np.uint64, len(s.words))


def bitmap(marks: DataFrame) -> np.ndarray:
    """A bitmap of 2**BITS bits from rows (bit): what reaches the driver is the bitmap's own size, at most."""
    packed = marks.groupBy(F.bitmap_bucket_number(F.col("bit") + 1).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("bit") + 1)).alias("bits"))
    out = np.zeros((1 << BITS) // 8, np.uint8)
    for r in packed.toLocalIterator():
        out[(r["at"] - 1) * 4096 :][: len(r["bits"])] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def marked(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def phrase_bits(words: list[np.ndarray]) -> np.ndarray:
    """The bit of each phrase, from the hashes of its words, the first ones first."""
    if len(words) == 1:
        return words[0] & np.uint64((1 << BITS) - 1)
    x = words[0]
    for w in words[1:]:
        x = (x * np.uint64(0x9E3779B97F4A7C15) + w) * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(31)
    return x * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - BITS)


def reach(s: Shard, marks: dict[int, np.ndarray], depth: int) -> np.ndarray:
    """For each word, how many words (0 to depth) the longest run has that ends there, lies in one piece and all of whose
    phrases of the marked lengths are marked."""
    h, out = word_hashes(s)[s.codes], np.zeros(len(s.codes), np.int8)
    good = np.ones(len(s.codes), bool)
    for d in range(1, depth + 1):
        if d > 1:
            good = s.follows & good & np.r_[False, good[:-1]]
        if d in marks:
            at = np.flatnonzero(good)
            good[at] = marked(marks[d], phrase_bits([h[at - d + 1 + k] for k in range(d)]))
        out += good
    return out


def _texts(dictionary: pa.Array, codes: np.ndarray, end: np.ndarray, d: int) -> pa.Array:
    """The phrases of d words that end at some places."""
    return pc.binary_join_element_wise(*(dictionary.take(pa.array(codes[end - d + 1 + k])) for k in range(d)), " ")


_COUNTED = pa.schema([("lang", pa.string()), ("k", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])


def _rows(lang: str, k: int, texts: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    return common.batch_of(_COUNTED, pa.repeat(pa.scalar(lang), len(n)), pa.array(np.full(len(n), k, np.int32)), texts, pa.array(n))


def phrase_marks(found: DataFrame) -> DataFrame:
    """(bit) of each phrase (lang, phrase) of two words or more."""
    schema = pa.schema([("bit", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = [[zlib.crc32(w, zlib.crc32(g.encode() + b"\0")) for w in p.encode().split(b" ")] for g, p in zip(b.column("lang").to_pylist(), b.column("phrase").to_pylist())]
            if h:
                yield common.batch_of(schema, pa.array(phrase_bits(list(np.array(h, np.uint64).T)).astype(np.int64)))

    return found.select("lang", "phrase").mapInArrow(run, "bit bigint")


class Automaton:
    """A generalised suffix automaton of bounded depth over runs of word codes.

    Nodes are the distinct runs of up to `depth` words: `length`, `count` (places where the run ends), `end` (one of them) and
    `link`, the node of the run without its first word (-1 for single words). reach[i] is the longest run that may end at word i, at
    least 1 and at most one more than at the word before. Runs of which one is the other's suffix and which
    end at the same places make one state; `state` marks each state's longest run, and a suffix link leads from a state's
    shortest run to the next state. Places marked `again` are not counted.
    """

    def __init__(self, codes: np.ndarray, reach: np.ndarray, again: np.ndarray, depth: int):
        code = codes.astype(np.int64)
        at, node = np.arange(len(codes)), code
        width, first = int(code.max()) + 1 if len(code) else 1, 0
        parts: list[tuple[np.ndarray, ...]] = []
        for d in range(1, depth + 1):
            if d > 1:
                longer = reach[at] >= d
                at, above = at[longer], node[longer]
                key = above * width + code[at - d + 1]
            else:
                key, above = code, np.full(len(code), -1)
            _, some, node = np.unique(key, return_index=True, return_inverse=True)
            links = above[some] + (first if d > 1 else 0)
            first = sum(len(p[0]) for p in parts)
            parts.append((np.full(len(some), d), np.bincount(node[~again[at]], minlength=len(some)), at[some], links))
        self.length, self.count, self.end, self.link = (np.concatenate([p[k] for p in parts]) for k in range(4))
        same = (self.link >= 0) & (self.count[self.link] == self.count)
        self.state = np.ones(len(self.link), bool)
        self.state[self.link[same]] = False
        self._same = same

    def states(self) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """(places, counts, length) of all runs: those of a state, from its longest to its shortest, have its count."""
        node = np.flatnonzero(self.state & (self.count > 0))
        count = self.count[node]
        for d in range(int(self.length.max(initial=0)), 0, -1):
            here = self.length[node] == d
            yield self.end[node[here]], count[here], d
            # within a state the next shorter run is the link's; what the link leaves behind ends there
            on = ~here | self._same[node]
            node, count, here = node[on], count[on], here[on]
            node = np.where(here, self.link[node], node)
            _, once = np.unique(node, return_index=True)
            node, count = node[once], count[once]


def phrases(docs: DataFrame, marks: dict[int, np.ndarray], low: int, high: int) -> DataFrame:
    """lang, k, phrase, n: how often each phrase of low to high words occurs, of those all of whose phrases of the marked lengths
    are marked. A task sends each phrase of a shard once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in shards(batches):
            far = reach(s, marks, high)
            kept = far >= low  # and the words before: those that end no phrase but belong to one
            for _ in range(low - 1):
                kept |= np.r_[kept[1:], False]
            codes, dictionary = s.codes[kept], s.words.cast(pa.string())
            for end, n, d in Automaton(codes, far[kept], s.again[kept], high).states():
                for i in range(0, len(end) if d >= low else 0, _BATCH):
                    yield _rows(s.lang, d, _texts(dictionary, codes, end[i : i + _BATCH], d), n[i : i + _BATCH])
            del far, kept, codes, dictionary
            common.trim()

    return docs.mapInArrow(run, "lang string, k int, phrase string, n bigint").groupBy("lang", "k", "phrase").agg(F.sum("n").alias("n"))


def _part(first: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def without_subsumed(found: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The phrases (lang, k, phrase, n) that no longer one stands for. A phrase occurs at least as often as any that holds it, so
    if any longer one has the frequency asked, one that is longer by a word, in front or at the end, has it too."""
    shorter = found.where("k > 2").select("lang", F.explode(F.array(_part(F.lit(2), F.col("k") - 1), _part(F.lit(1), F.col("k") - 1))).alias("phrase"), "n")
    most = shorter.groupBy("lang", "phrase").agg(F.max("n").alias("most"))
    return found.join(most, ["lang", "phrase"], "left").where(F.col("most").isNull() | (100 * F.col("most") < percent * F.col("n"))).drop("most")


def cut(found: DataFrame, parts: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score of each phrase at its lowest-scoring cut, ties to the first. Products are decimals of up to
    38 digits, which suffice for 10**13 words."""
    at = found.select("lang", "phrase", "k", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    at = at.withColumn("left", _part(F.lit(1), F.col("cut"))).withColumn("right", _part(F.col("cut") + 1, F.col("k") - F.col("cut")))
    for side, name in (("left", "l"), ("right", "r")):
        at = at.join(parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    at = at.join(totals, "lang")
    score = F.expr("(CAST(a AS DECIMAL(19, 0)) * CAST(1000 * n AS DECIMAL(19, 0))) DIV (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    least = at.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r", "a", "n")).alias("x"))
    return least.select("lang", "phrase", "x.a", "x.l", "x.r", "x.n", "x.score")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first `top` phrases by score, then frequency, then the phrase's bytes.

    docs has text and lang; other columns are left behind. A null text counts as empty, a null language as `und`; repeated rows
    count each time; a text of any length is counted whole. Ties cannot remain, for a phrase is one row a language. An empty
    table, or one without frequent phrases, gives no rows.
    """
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))
    words = common.stored(word_counts(docs), "words")
    totals = common.stored(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = words.where(F.col("n") >= least)
    marks = {1: bitmap(often.select((word_hash(F.col("lang"), F.col("phrase")) % (1 << BITS)).alias("bit")))}
    found = None
    for low, high in STEPS:
        more = common.stored(phrases(docs, marks, low, high).where(F.col("n") >= least), "phrases")
        found = more if found is None else found.unionByName(more)
        if high < DEPTH:
            marks[high] = bitmap(phrase_marks(more))
    scored = cut(without_subsumed(found, percent), often.unionByName(found.drop("k")), totals)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language may hold a third of all phrases: each part's first ones, then the first of these, at most PARTS * top rows
    dealt = scored.withColumn("__part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    few = dealt.withColumn("__place", F.row_number().over(Window.partitionBy("lang", "__part").orderBy(*order))).where(F.col("__place") <= top)
    last = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return last.select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark, sf_dir: str) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score over the whole texts of all documents."""
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
runs AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase FROM w, (SELECT unnest(range(1, {DEPTH + 1})) AS k)),
f AS (SELECT lang, k, phrase, count(*) AS n FROM runs GROUP BY ALL HAVING count(*) >= {LEAST}),
c AS (SELECT *, string_split(phrase, ' ') AS p FROM f WHERE k > 1),
longer AS (SELECT lang, unnest([array_to_string(p[2:], ' '), array_to_string(p[:k - 1], ' ')]) AS phrase, n AS most FROM c),
kept AS (SELECT * FROM c WHERE NOT EXISTS (FROM longer WHERE longer.lang = c.lang AND longer.phrase = c.phrase AND 100 * most >= {PERCENT} * c.n)),
cuts AS (SELECT lang, phrase, n AS a, p, k, unnest(range(1, k)) AS cut FROM kept),
scored AS (SELECT cuts.lang, cuts.phrase, a, cut, l.n AS l, r.n AS r, total.n AS n, (1000::HUGEINT * a * total.n) // (l.n::HUGEINT * r.n) AS score
    FROM cuts JOIN f AS l ON l.lang = cuts.lang AND l.phrase = array_to_string(p[:cut], ' ') JOIN f AS r ON r.lang = cuts.lang AND r.phrase = array_to_string(p[cut + 1:], ' ') JOIN total ON total.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {TOP}"""
