"""Toxicity from a weighted lexicon, matched by an Aho-Corasick automaton on folded text.

Folding maps look-alike letters of other scripts and digits or signs that stand for letters onto plain
letters, so one entry covers its disguises. Entries are words, and stems that several different words of a
text begin with, with the log-odds of a toxic label as weight, learned from labelled texts of which copies
count once. Phrases around a match that only clean texts have are exceptions. The sum of weights is
normalised by length and mapped to 0..1.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

#: Labelled rows that are learned from, at most; those with the smallest hash of their id are taken.
MAX_TRAIN = 20_000
#: Toxic texts that a word must be in, and the share of an entry's texts that must be toxic. There is no other bound
#: on the entries: MAX_TRAIN bounds the texts that they come from.
MIN_TEXTS, MIN_PRECISION = 5, 0.9
#: Characters of a stem; different words that begin with it in a text, the fewer for stems that the more have shown, with the
#: share of such texts that must be toxic; and toxic texts that must have the more, at least and as a share of all toxic ones.
STEM, NEED, FEW_PRECISION, STEM_TEXTS, STEM_SHARE = (5, 8), (2, 3), 0.8, 2, 0.01
#: The score from which a text is toxic, and the most that a text may score in which nothing matches, however
#: frequent toxic texts are among the labelled ones.
THRESHOLD, NOTHING = 0.3, 0.2

# Letters of other scripts that look like Latin ones, and the digits and signs used for letters.
HOMOGLYPHS = dict(zip("аеорсухкмтвніјѕԁɡαεορτυνικχ", "aeopcyxkmtbhijsdgaeoptuvikx"))
SUBSTITUTES = dict(zip("0134578@$!|", "oieastbasil"))

_PLAIN = str.maketrans(HOMOGLYPHS | {ch: None for ch in "­​‌‍⁠﻿"})
_INSIDE = re.compile(r"(?<=[^\W_])[0-9@$!|](?=[^\W_])|(?<![^\W_])[0-9@$!|](?=[^\W\d_]{2})|(?<=[^\W\d_]{2})[0-9](?![^\W_])")
_WORD = re.compile(r"[^\W_]+")
#: Words of letters with digits or signs anywhere, and numbers with a unit, which are none.
_MIXED = re.compile(r"(?<![\w@$!|])(?:[^\W\d_]++[0-9@$|!]|[0-9@$|!]++[^\W\d_])[\w@$!|]*")
_UNIT = re.compile(r"[0-9]+[^\W\d_]{1,3}$")
_ALL = str.maketrans(SUBSTITUTES)


def fold(text: str) -> str:
    """Lower case, compatibility forms and look-alikes as plain letters, digits and signs inside words as the
    letters they stand for, no invisible characters.

    At the ends of a word a digit or sign may be just that; where reading it as a letter makes another word, that
    word is added after the text. Numbers with a unit, and exclamation marks at the end, are never letters.
    """
    text = text.lower()
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_PLAIN)
    out = _INSIDE.sub(lambda m: SUBSTITUTES.get(m[0], m[0]), text)
    more = []
    for m in _MIXED.finditer(text):
        token = m[0].rstrip("!|")
        if not _UNIT.match(token) and (whole := token.translate(_ALL)) != _INSIDE.sub(lambda x: SUBSTITUTES.get(x[0], x[0]), token):
            more.append(whole)
    return f"{out}\n{' '.join(more)}" if more else out


def terms(folded: str) -> set[str]:
    """Candidate entries: the distinct words of a folded text, but for those of one or two characters."""
    return {w for w in _WORD.findall(folded) if len(w) >= 3}


def stems(folded: str) -> dict[str, int]:
    """Beginnings of words, and how many different words begin with each, from the fewer of NEED on."""
    out: Counter[str] = Counter()
    for w in set(_WORD.findall(folded)):
        out.update(w[:k] for k in range(STEM[0], min(len(w), STEM[1]) + 1))
    return {s: n for s, n in out.items() if n >= NEED[0]}


def evidence(folded: str) -> set[str]:
    """What a text may tell: its terms, and its stems with how many words show them (at most the more of NEED)."""
    return terms(folded) | {f"{s}*{k}" for s, n in stems(folded).items() for k in NEED if n >= k}


def word_before(folded: str, start: int) -> str:
    """The last word that ends before a place, empty without one."""
    end = start
    while end and not folded[end - 1].isalnum():
        end -= 1
    begin = end
    while begin and folded[begin - 1].isalnum():
        begin -= 1
    return folded[begin:end]


def signatures(text: str) -> tuple[int, int]:
    """The least of two hashes over the text's runs of five words; near copies mostly share one of the two."""
    w = text.split()
    runs = [" ".join(w[i : i + 5]).encode() for i in range(max(1, len(w) - 4))]
    return min(zlib.crc32(r) for r in runs), min(zlib.adler32(r) ^ (zlib.crc32(r[::-1]) << 1) for r in runs)


@dataclass
class Lexicon:
    """weights: word -> weight; exceptions: words, and pairs with the word before, whose matches don't count; slope and offset of
    the logistic map; stems: stem -> weights by how many different words begin with it, at least."""

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: set[str] = field(default_factory=set)
    slope: float = 4.0
    offset: float = -4.0
    stems: dict[str, dict[int, float]] = field(default_factory=dict)

    def automaton(self):
        a = ahocorasick.Automaton()
        for entry in self.weights.keys() | self.stems.keys():
            a.add_word(entry, entry)
        if len(a):
            a.make_automaton()
        return a

    def found(self, folded: str, automaton) -> tuple[list[tuple[str, str, float]], dict[str, set[str]]]:
        """(word, word before, weight) of each place where an entry stands as a word of its own, and the words that begin with
        each stem."""
        out, begun = [], {}
        if len(automaton):
            for end, entry in automaton.iter(folded):
                start, after = end - len(entry) + 1, end + 1
                if start and folded[start - 1].isalnum():
                    continue
                while entry in self.stems and after < len(folded) and folded[after].isalnum():
                    after += 1
                if entry in self.stems:
                    begun.setdefault(entry, set()).add(folded[start:after])
                if entry in self.weights and (end + 1 == len(folded) or not folded[end + 1].isalnum()):
                    out.append((entry, word_before(folded, start), self.weights[entry]))
        return out, begun

    def matches(self, folded: str, automaton) -> list[tuple[str, str, float]]:
        return self.found(folded, automaton)[0]

    def strength(self, folded: str, automaton) -> float:
        """Weights of the matches that no exception covers, and of the stems that enough words begin with, over one plus the
        logarithm of the word count."""
        words, begun = self.found(folded, automaton)
        got = [w for word, before, w in words if word not in self.exceptions and f"{before} {word}" not in self.exceptions]
        got += [max((w for need, w in self.stems[s].items() if len(of) >= need), default=0.0) for s, of in begun.items()]
        return sum(got) / (1 + math.log10(1 + folded.count(" "))) if got else 0.0

    def score(self, folded: str, automaton) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * self.strength(folded, automaton) + self.offset))))


def training(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, limit: int = MAX_TRAIN) -> DataFrame:
    """doc_id, text, y of at most `limit` labelled documents outside the held-out fold. The ids, whose
    number is bounded, are broadcast, so the texts are not shuffled. Null labels are left out."""
    chosen = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where(F.col("y").isin(0, 1) & F.col("doc_id").isNotNull() & (common.fold(folds) != held))
    chosen = chosen.groupBy("doc_id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return docs.join(F.broadcast(chosen), "doc_id")


def learn(train: DataFrame) -> Lexicon:
    """Fits a lexicon to rows (text, y); without toxic rows it is empty.

    Copies and near copies count once, the one of least id, else every word of a copied toxic text would look toxic. What
    toxic texts tell is counted first, and only what two of them tell is counted in clean texts; the training rows
    (doc_id, y, text) are bounded by MAX_TRAIN, and with them what reaches the driver.
    """
    signed = pa.schema([("doc_id", pa.int64()), ("y", pa.int32()), ("text", pa.string()), ("s1", pa.int64()), ("s2", pa.int64())])
    counted = pa.schema([("term", pa.string())])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = [signatures(t) for t in b.column("text").to_pylist()]
            yield common.batch_of(signed, b.column("doc_id"), b.column("y"), b.column("text"), [x for x, _ in s], [x for _, x in s])

    def words(only: set[str] | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield common.batch_of(counted, [w for t in b.column("text").to_pylist() for w in (evidence(fold(t)) if only is None else evidence(fold(t)) & only)])

        return run

    least = lambda df, key: df.groupBy("y", key).agg(F.min(F.struct("doc_id", "text", *({"s1", "s2"} - {key}))).alias("r")).select("y", "r.*", key)
    once = least(least(train.select("doc_id", "y", "text").mapInArrow(sign, "doc_id bigint, y int, text string, s1 bigint, s2 bigint"), "s1"), "s2")
    texts = common.stored(once.select("y", "text"), "toxicity-train")
    n = {r["y"]: r["n"] for r in texts.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic:
        return Lexicon()
    count = lambda y, only: {r["term"]: r["n"] for r in texts.where(F.col("y") == y).select("text").mapInArrow(words(only), "term string").groupBy("term").agg(F.count("*").alias("n")).where(F.lit(only is not None) | (F.col("n") >= 2)).collect()}
    a = count(1, None)
    b = count(0, set(a))
    weight = lambda w: math.log((a[w] + 0.5) / (toxic + 1)) - math.log((b.get(w, 0) + 0.5) / (clean + 1))
    precise = lambda w, share: a.get(w, 0) >= share * (a.get(w, 0) + b.get(w, 0)) > 0
    weights = {w: weight(w) for w in sorted(a) if "*" not in w and a[w] >= MIN_TEXTS and precise(w, MIN_PRECISION)}
    few, many = NEED
    shown = max(STEM_TEXTS, math.ceil(STEM_SHARE * toxic))
    proven = {w[:-2] for w in a if w.endswith(f"*{many}") and a[w] >= shown and precise(w, MIN_PRECISION)}
    # of stems that the same texts show, the longest stands for all
    same = lambda s, t: all(a.get(f"{s}*{k}") == a.get(f"{t}*{k}") and b.get(f"{s}*{k}") == b.get(f"{t}*{k}") for k in NEED)
    proven -= {s for s in proven if any(t.startswith(s) and t != s and same(s, t) for t in proven)}
    begun = {s: {many: weight(f"{s}*{many}")} | ({few: weight(f"{s}*{few}")} if precise(f"{s}*{few}", FEW_PRECISION) else {}) for s in sorted(proven)}
    return _finish(Lexicon(weights, stems=begun), texts)


def _finish(lex: Lexicon, texts: DataFrame) -> Lexicon:
    """Adds the exceptions, then fits the logistic map to the training strengths."""
    schema = pa.schema([("phrase", pa.string()), ("y", pa.int32())])

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lex.automaton()
        for b in batches:
            rows = [(p, y) for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()) for p in {f"{before} {w}" for w, before, _ in lex.matches(fold(t), a)}]
            yield common.batch_of(schema, *(map(list, zip(*rows)) if rows else [[], []]))

    phrases = texts.select("y", "text").mapInArrow(around, "phrase string, y int").groupBy("phrase").agg(F.sum("y").alias("a"), F.count("*").alias("n")).where("n >= 2 and a = 0")
    lex.exceptions = {r["phrase"] for r in phrases.collect()}
    strengths = pa.schema([("x", pa.float64()), ("y", pa.int32())])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lex.automaton()
        for b in batches:
            yield common.batch_of(strengths, [lex.strength(fold(t), a) for t in b.column("text").to_pylist()], b.column("y"))

    xy = [(r["x"], r["y"]) for r in texts.select("y", "text").mapInArrow(measure, "x double, y int").collect()]
    lex.slope, offset = logistic(xy)
    lex.offset = min(offset, math.log(NOTHING / (1 - NOTHING)))
    return lex


def logistic(xy: list[tuple[float, int]], ridge: float = 0.01) -> tuple[float, float]:
    """Slope and offset of a one-variable logistic regression by Newton's method."""
    a, b = 1.0, -1.0
    for _ in range(40):
        g0 = g1 = 0.0
        h00 = h01 = h11 = 1e-9
        for (x, y), n in Counter(xy).items():
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a * x + b))))
            g0, g1, w = g0 + n * (p - y), g1 + n * (p - y) * x, n * p * (1 - p)
            h00, h01, h11 = h00 + w, h01 + w * x, h11 + w * x * x
        g0, g1, h00, h11 = g0 + ridge * b, g1 + ridge * a, h00 + ridge, h11 + ridge
        d = h00 * h11 - h01 * h01
        da, db = (h00 * g1 - h01 * g0) / d, (h11 * g0 - h01 * g1) / d
        step = min(1.0, 5 / max(abs(da), abs(db), 1e-12))
        a, b = a - step * da, b - step * db
        if max(abs(da), abs(db)) < 1e-8:
            break
    return max(a, 0.0), b


def scored(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """doc_id, score: one row a document, in any number of repeats; empty and null texts score like clean ones."""
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lex.automaton()
        for b in batches:
            yield common.batch_of(schema, b.column("doc_id"), [lex.score(fold(t), a) for t in b.column("text").to_pylist()])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")


def fitted(spark, sf_dir: str, docs: DataFrame) -> Lexicon:
    return learn(training(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), "toxic", 4, 2))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table: doc_id, held_out, score, predicted. Null texts count as empty ones,
    which score like clean texts; a null id is never held out; repeated rows all come back. Without labels, or
    without toxic ones, the lexicon is empty and every text is clean."""
    docs = common.read_documents(spark, sf_dir)
    return scored(docs, fitted(spark, sf_dir, docs)).select("doc_id", (common.fold(4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, lex: Lexicon, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a = lex.automaton()
        for b in batches:
            yield b.filter(pa.array([lex.score(fold(t or ""), a) < threshold for t in b.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)
