"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into blocks of STRIDE words; two neighbouring blocks are a passage. Blocks become TF-IDF
vectors over the benchmark's words, their Gram matrix is applied to random vectors in one distributed pass
(a randomised singular value decomposition with Nystroem's completion), and benchmark passages search all
corpus passages by cosine in the latent space. A candidate is a leak if the longest common subsequence with
the words around it covers the item, or covers most of it and the item's end, where its answer stands, too.

The benchmark is a stated query set of checked size, held against all rows; a large one is searched in
blocks of items. Everything that grows with the corpus stays distributed: counts and products are summed by
Spark, and candidates are checked in the task that finds them, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

#: Words in a block, dimensions of the latent space beyond one for each item, and the cosine from which a
#: passage is a candidate.
STRIDE, EXTRA, COSINE = 32, 32, 0.35
#: Share of an item's words that must be found in order; with the answer found, a smaller one is enough. Meant for
#: paraphrases of which up to a fifth of the words are others.
COVERED, COVERED_WITH_ANSWER, ANSWER = 0.7, 0.6, 0.9
#: Words in more than this share of all blocks have no weight, but for each item's rarest ones.
TOO_COMMON, RAREST = 0.01, 3
#: Items that are searched at once, and bytes of text that a task has as words and vectors at once.
ITEMS, CHUNK = 256, 1 << 19
_PLAIN = bytes.maketrans(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~", b" " * 32)


def tokens(raw: bytes) -> list[bytes]:
    """Lower-cased words without ASCII punctuation."""
    low = raw.lower() if raw.isascii() else raw.decode().lower().encode()
    return low.translate(_PLAIN).split()


class Item(NamedTuple):
    item_id: int
    words: list[bytes]


class Index(NamedTuple):
    """vocabulary: word -> place; weight: inverse document frequencies; latent: dimensions by words, weighted;
    items: the benchmark's passages; queries: their unit vectors."""

    vocabulary: dict[bytes, int]
    weight: np.ndarray
    latent: np.ndarray
    items: list[Item]
    queries: np.ndarray


def item_passages(rows) -> list[Item]:
    """Items, those over two blocks cut into passages that overlap by one; items without words are none."""
    out = []
    for item_id, text in rows:
        w = tokens((text or "").encode())
        cuts = range(0, max(1, len(w) - STRIDE), STRIDE) if len(w) > 2 * STRIDE else [0]
        out += [Item(item_id, w[i : i + 2 * STRIDE]) for i in cuts if w]
    return out


class Texts(NamedTuple):
    """Known words of some texts: place in the vocabulary and block; blocks of each text, and their number."""

    place: np.ndarray
    block: np.ndarray
    first: np.ndarray
    n: int
    words: list[list[bytes]]


def located(texts: list[bytes], vocabulary: dict[bytes, int]) -> Texts:
    get = vocabulary.get
    split = [tokens(t) for t in texts]
    sizes = np.array([len(w) for w in split], np.int64)
    place = np.array([get(w, -1) for ws in split for w in ws], np.int64)
    blocks = np.maximum(1, -(-sizes // STRIDE))
    first = np.cumsum(blocks) - blocks
    start = np.cumsum(sizes) - sizes
    block = (np.arange(len(place)) - np.repeat(start, sizes)) // STRIDE + np.repeat(first, sizes)
    known = place >= 0
    return Texts(place[known], block[known], first, int(blocks.sum()), split)


def live(t: Texts, weight: np.ndarray) -> Texts:
    """Only the words that have a weight, each once a block: a word said over and over must not outweigh an item."""
    ok = weight[t.place] > 0
    once = np.unique(t.block[ok] * len(weight) + t.place[ok])
    return t._replace(place=once % len(weight), block=once // len(weight))


def block_sums(t: Texts, matrix: np.ndarray) -> np.ndarray:
    """dimensions by blocks: sums of the matrix (dimensions by words) over the known words of each block."""
    out = np.empty((len(matrix), t.n), np.float32)
    for k, row in enumerate(matrix):
        out[k] = np.bincount(t.block, row[t.place], t.n)
    return out


def _chunks(batches: Iterator[pa.RecordBatch]):
    """(batch row numbers, texts) of batches, at most CHUNK bytes of text or one text at a time. A worker outlives the
    task and gives back what it took."""
    for b in batches:
        text = b.column("text").cast(pa.binary())
        ends = np.cumsum(np.r_[0, pc.binary_length(text).to_numpy(zero_copy_only=False).astype(np.int64)])
        i = 0
        while i < len(text):
            j = max(i + 1, int(np.searchsorted(ends, ends[i] + CHUNK, "right")) - 1)
            yield b, range(i, j), text.slice(i, j - i).to_pylist()
            i = j
        del text
    common.trim()


def document_frequencies(docs: DataFrame, vocabulary: dict[bytes, int]) -> tuple[np.ndarray, int]:
    """In how many blocks of the corpus each word of the vocabulary is, and the number of blocks."""
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])
    size = len(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for _, _, texts in _chunks(batches):
            t = located(texts, vocabulary)
            for low in range(0, t.n, 1024):
                lo, hi = np.searchsorted(t.block, (low, low + 1024))
                there = np.zeros((min(1024, t.n - low), size), bool)
                there[t.block[lo:hi] - low, t.place[lo:hi]] = True
                total[:size] += there.sum(0)
            total[size] += t.n
        at = np.flatnonzero(total)
        yield common.batch_of(schema, pa.array(at.astype(np.int32)), pa.array(total[at]))

    out = np.zeros(size + 1, np.int64)
    for r in docs.select("text").mapInArrow(count, "place int, n bigint").groupBy("place").agg(F.sum("n").alias("n")).collect():
        out[r["place"]] = r["n"]
    return out[:size], int(out[size])


def latent_space(docs: DataFrame, vocabulary: dict[bytes, int], weight: np.ndarray, items: list[Item]) -> np.ndarray:
    """Leading right singular vectors of the blocks of corpus and benchmark: words by dimensions.

    One pass computes Y = A'A W for random W, A being blocks by words; rows of Y are summed by Spark. With
    W'Y = LL', the singular vectors of Y L'^-1 are those of A in the space that Y spans. The benchmark's
    passages are repeated until they weigh as much as the corpus, else an item that the corpus hardly has
    would get no dimension.
    """
    size, rank = len(vocabulary), min(len(items) + EXTRA, len(vocabulary))
    random = np.random.default_rng(6).standard_normal((size, rank)).astype(np.float32)
    weighted = random * weight[:, None].astype(np.float32)
    across = np.ascontiguousarray(weighted.T)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        y = np.zeros((rank, size))
        for _, _, texts in _chunks(batches):
            t = live(located(texts, vocabulary), weight)
            for k, row in enumerate(block_sums(t, across)):
                y[k] += np.bincount(t.place, row[t.block], size)
        at = np.flatnonzero(y.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *(pa.array(c[at].astype(np.float32)) for c in y)], names=["place", *(f"c{k}" for k in range(rank))])

    columns = [f"c{k}" for k in range(rank)]
    rows = docs.select("text").mapInArrow(multiply, "place int, " + ", ".join(f"{c} float" for c in columns)).groupBy("place").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    y = np.zeros((size, rank))
    y[rows.column("place").to_numpy()] = np.stack([rows.column(c).to_numpy() for c in columns], 1)
    own = np.zeros((size, rank))
    for item in items:
        at = [vocabulary[w] for w in {*item.words}]
        np.add.at(own, at, weighted[at].sum(0).astype(float))
    y = weight[:, None] * (y + own * (max(1.0, float(np.abs(y).sum())) / max(1e-9, float(np.abs(own).sum()))))
    core = random.T.astype(float) @ y
    core = (core + core.T) / 2
    value, vector = np.linalg.eigh(core + np.eye(rank) * (1e-6 * max(1e-12, float(np.trace(core))) / rank))
    good = value > 1e-9 * max(value.max(), 1e-300)
    u, s, _ = np.linalg.svd(y @ vector[:, good] / np.sqrt(value[good]), full_matrices=False)
    return u[:, s > 1e-6 * max(s.max(initial=0), 1e-300)]


def index(docs: DataFrame, rows) -> Index | None:
    """The index of the items (item_id, text); None without words to search for. Its size is that of the
    items' vocabulary times the latent space's dimensions."""
    items = item_passages(rows)
    vocabulary = {w: k for k, w in enumerate(sorted({w for i in items for w in i.words}))}
    if not vocabulary:
        return None
    df, n = document_frequencies(docs, vocabulary)
    rare = df <= max(TOO_COMMON * n, 20)
    for i in items:
        places = sorted({vocabulary[w] for w in i.words}, key=lambda k: (df[k], k))
        rare[places[:RAREST]] = True
    weight = np.where(rare, np.log((n + 1) / (df + 1)) + 0.01, 0.0)
    space = latent_space(docs, vocabulary, weight, items)
    latent = (space * weight[:, None]).astype(np.float32)
    queries = np.stack([latent[[vocabulary[w] for w in {*i.words}]].sum(0) for i in items])
    return Index(vocabulary, weight, np.ascontiguousarray(latent.T), items, unit(queries))


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)


def common_subsequence(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence, a row of the table as the bits of one number."""
    masks: dict[bytes, int] = {}
    for i, w in enumerate(a):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if m := masks.get(w, 0):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def checked(item: Item, around: list[bytes]) -> tuple[float, bool]:
    """Share of the item's words found in order in any stretch of words not much longer than the item, and
    whether its last fifth, the answer, is."""
    n = len(item.words)
    if common_subsequence(item.words, around) < COVERED_WITH_ANSWER * n:
        return 0.0, False
    width, best, answer = n + max(4, n // 4), 0, item.words[-max(1, n // 5) :]
    at = 0
    step = max(1, n // 8)
    for i in range(0, max(1, len(around) - n + step), step):
        k = common_subsequence(item.words, around[i : i + width])
        if k > best:
            best, at = k, i
    return best / n, common_subsequence(answer, around[at : at + width]) >= ANSWER * len(answer)


def leaks_in(texts: list[bytes], ix: Index) -> Iterator[tuple[int, int, float, bool]]:
    """(text's number, item_id, share covered, answer found) of every leak in some texts."""
    t = located(texts, ix.vocabulary)
    sums = block_sums(live(t, ix.weight), ix.latent).T
    passage = sums.copy()
    passage[:-1] += sums[1:]
    ends = np.r_[t.first[1:], t.n] - 1
    passage[ends] = sums[ends]
    filled = np.flatnonzero((passage != 0).any(1))
    for part in np.array_split(filled, max(1, len(filled) * len(ix.items) // 4_000_000)):
        row, q = np.nonzero(unit(passage[part]) @ ix.queries.T >= COSINE)
        for block, k in zip(part[row].tolist(), q.tolist()):
            doc = int(np.searchsorted(t.first, block, "right")) - 1
            item = ix.items[k]
            begin = (block - int(t.first[doc])) * STRIDE
            around = t.words[doc][max(0, begin - len(item.words)) : begin + 2 * STRIDE + len(item.words)]
            share, answer = checked(item, around)
            if share >= COVERED or share >= COVERED_WITH_ANSWER and answer:
                yield doc, item.item_id, share, answer


def item_blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The benchmark's items with text, repeated rows once, in blocks of at most ITEMS."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    n = -(-items.count() // ITEMS)
    return [[(r["item_id"], r["text"]) for r in items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()] for k in range(n)]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, covered, answer: one row for each document and item that it holds; none for clean,
    empty or null texts. Repeated rows count once."""
    spark = docs.sparkSession
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("covered", pa.float64()), ("answer", pa.bool_())])
    ddl = "doc_id bigint, item_id bigint, covered double, answer boolean"
    found = spark.createDataFrame([], ddl)
    for items in item_blocks(benchmark):
        if (ix := index(docs, items)) is None:
            continue
        shared = spark.sparkContext.broadcast(ix)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b, rows, texts in _chunks(batches):
                ids = b.column("doc_id").to_pylist()
                out = [(ids[rows[d]], i, s, a) for d, i, s, a in leaks_in(texts, shared.value)]
                yield common.batch_of(schema, *(map(list, zip(*out)) if out else [[]] * 4))

        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(search, ddl))
    return found.groupBy("doc_id", "item_id").agg(F.max("covered").alias("covered"), F.max("answer").alias("answer"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, whose text holds no item."""
    spark, kept = docs.sparkSession, docs
    plain = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    for items in item_blocks(benchmark):
        if (ix := index(plain, items)) is None:
            continue
        shared = spark.sparkContext.broadcast(ix)

        def keep(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ok = np.ones(b.num_rows, bool)
                for _, rows, texts in _chunks([b.set_column(b.schema.get_field_index("text"), "text", b.column("text").fill_null(""))]):
                    for d, *_ in leaks_in(texts, shared.value):
                        ok[rows[d]] = False
                yield b.filter(pa.array(ok))

        kept = kept.mapInArrow(keep, docs.schema)
    return kept


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """The leaks of the whole benchmark in all documents: doc_id, item_id, covered, answer, one row a document and
    item. Null and empty texts hold none; repeated rows count once; a null doc_id is a document like others."""
    return leaks(common.read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
