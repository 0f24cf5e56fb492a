"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ORDER bytes, counted over the training documents. A symbol is
predicted from the longest context of the trie that ends the history; if it never followed there, the model
escapes to the next shorter context, where the symbols of the longer one are excluded from the counts. A
text is its lower-cased words, one space before each, and an end symbol; contexts cross words.

With n the count of a symbol in a context, T that context's total and q its distinct symbols, all without the
excluded ones, the symbol's probability is (2n - 1) / 2T and that of the escape q / 2T.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import common, words

#: Longest context in bytes; with its symbol and a tag for its length it fits 64 bits.
ORDER = 6
#: Contexts of up to LOW bytes, at most 256 ** LOW of them whatever the corpus, are known to every task;
#: longer ones lie in the bucket of their last LOW + 1 bytes, which holds all their suffixes of that length on.
LOW = 2
END, FOLDS, HELD = b"\0", 7, 2
_U = np.uint64
_TAG = 56


def is_held(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD


def spelled(tokens: list[bytes]) -> bytes:
    return b"".join([b" " + w for w in tokens]) + END


def grams(texts: list[bytes]) -> np.ndarray:
    """For every position the ORDER + 1 bytes that end there as one number, its own byte lowest; before a
    text's first byte there are END bytes."""
    if not texts:
        return np.zeros(0, _U)
    x = np.frombuffer(b"".join([END * ORDER + t for t in texts]), np.uint8).astype(_U)
    key = x.copy()
    for k in range(1, ORDER + 1):
        key[k:] |= x[:-k] << _U(8 * k)
    keep = np.ones(len(x), bool)
    starts = np.cumsum([0, *(len(t) + ORDER for t in texts[:-1])])
    keep[(starts[:, None] + np.arange(ORDER)).ravel()] = False
    return key[keep]


def summed(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of n, or how often each occurs."""
    if n is None:
        return np.unique(keys, return_counts=True)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, int)
    return keys[cut], np.add.reduceat(n[order], cut) if len(cut) else n


def last(keys: np.ndarray, order: int) -> np.ndarray:
    return keys & _U((1 << 8 * (order + 1)) - 1)


def context(keys: np.ndarray) -> np.ndarray:
    """The tagged context of tagged entries."""
    return (keys & _U((1 << _TAG) - 1)) >> _U(8) | keys >> _U(_TAG) << _U(_TAG)


def mixed(keys: np.ndarray) -> np.ndarray:
    h = keys * _U(0x9E3779B97F4A7C15)
    return (h ^ (h >> _U(29))) * _U(0xBF58476D1CE4E5B9)


def _blob(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _sorted_blob(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte plane by byte plane, which compresses well."""
    return _blob(np.ascontiguousarray(np.diff(keys, prepend=_U(0)).view(np.uint8).reshape(-1, 8).T))


def _sorted_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view(_U).ravel(), dtype=_U)


class Folded:
    """Distinct keys with sums of counts, folded as they pile up."""

    def __init__(self):
        self.keys, self.n, self.size = [np.zeros(0, _U)], [np.zeros(0, np.int64)], 0

    def add(self, keys: np.ndarray, n: np.ndarray) -> None:
        self.keys.append(keys)
        self.n.append(n)
        self.size += len(keys)
        if self.size > 4_000_000 and self.size > 2 * len(self.keys[0]):
            keys, n = self.result()
            self.keys, self.n, self.size = [keys], [n], len(keys)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        return summed(np.concatenate(self.keys), np.concatenate(self.n))


def pieces(texts: list[bytes], most: int = 1_000_000) -> Iterator[list[bytes]]:
    """The texts in runs of about `most` bytes."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size > most:
            yield held
            held, size = [], 0
    if held:
        yield held


def levels(keys: np.ndarray, n: np.ndarray, longest: int, shortest: int) -> tuple[np.ndarray, np.ndarray]:
    """Tagged entries, sorted, of contexts from `longest` down to `shortest` bytes, given the longest ones."""
    out = []
    for order in range(longest, shortest - 1, -1):
        keys, n = summed(last(keys, order), n)
        out.append((keys | _U(order + 1) << _U(_TAG), n))
    return np.concatenate([k for k, _ in out[::-1]]), np.concatenate([c for _, c in out[::-1]])


def low_entries(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Tagged entries, with counts, of the contexts of up to LOW bytes in training texts."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Folded()
        for b in batches:
            for part in pieces([spelled(t.lower().split()) for d, t in zip(b.column("doc_id").to_pylist(), common.texts(b)) if not is_held(d)]):
                k, n = summed(last(grams(part), LOW).astype(np.uint32))
                mine.add(k.astype(_U), n)
        keys, n = mine.result()
        yield common.batch_of(schema, pa.array(keys.view(np.int64)), pa.array(n))
        common.trim()

    table = docs.mapInArrow(count, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")).toArrow()
    return levels(*summed(table.column("key").to_numpy().view(_U), table.column("n").to_numpy()), LOW, 0)


def gram_buckets(keys: np.ndarray, n: int) -> np.ndarray:
    """The bucket of each gram, by the LOW + 1 bytes before its own."""
    return (mixed(keys >> _U(8) & _U((1 << 8 * (LOW + 1)) - 1)) >> _U(33)).astype(np.int64) % n


def gram_scores(whole: DataFrame, n: int, low) -> DataFrame:
    """(block, keys, scores): for each block its distinct grams with the logarithms of their probabilities.

    A block sends its distinct grams with their counts in training texts. A bucket adds them up, which gives
    all entries of its contexts in the corpus, however many there are, and scores each gram once.
    """
    sent = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("keys", pa.binary()), ("n", pa.binary())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Folded] = {}
        for b in batches:
            for block, blob in zip(b.column("block").to_pylist(), b.column("docs").to_pylist()):
                mine, texts = seen.setdefault(block, Folded()), ([], [])
                for doc_id, text in zip(*words.unpacked(blob)):
                    texts[is_held(doc_id)].append(spelled(text.lower().split()))
                for held in (False, True):
                    for part in pieces(texts[held]):
                        k, c = summed(grams(part))
                        mine.add(k, c * 0 if held else c)
        while seen:
            block, mine = seen.popitem()
            keys, c = mine.result()
            del mine
            bucket = gram_buckets(keys, n)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            parts = np.split(order, cuts) if len(order) else []
            yield common.batch_of(sent, [int(bucket[x[0]]) for x in parts], [block] * len(parts), [_sorted_blob(keys[x]) for x in parts], [_blob(c[x].astype("<i8")) for x in parts])
        common.trim()

    answers = pa.schema([("block", pa.int32()), ("keys", pa.binary()), ("scores", pa.binary())])

    def answer(table: pa.Table) -> pa.Table:
        lists = [_sorted_keys(x) for x in table.column("keys").to_pylist()]
        keys, c = summed(np.concatenate(lists), np.concatenate([np.frombuffer(zlib.decompress(x), "<i8") for x in table.column("n").to_pylist()]))
        k, e = levels(keys[c > 0], c[c > 0], ORDER, LOW + 1)
        model = Model(np.concatenate([low.value[0], k]), np.concatenate([low.value[1], e]))
        score = np.concatenate([model.positions(keys[i : i + 1_000_000]) for i in range(0, len(keys), 1_000_000)]).astype("<f4")
        out = pa.table([table.column("block"), table.column("keys"), pa.array([_blob(score[np.searchsorted(keys, x)]) for x in lists], pa.binary())], schema=answers)
        del lists, keys, c, k, e, model, score
        common.trim()
        return out

    return whole.mapInArrow(collect, "bucket int, block int, keys binary, n binary").groupBy("bucket").applyInArrow(answer, "block int, keys binary, scores binary")


def _totals(keys: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, their totals and distinct symbols, and each entry's place among the contexts."""
    nodes, where = np.unique(context(keys), return_inverse=True)
    return nodes, np.bincount(where, weights=c, minlength=len(nodes)), np.bincount(where, minlength=len(nodes)), where


class Table:
    """A hash table from 64-bit keys to places, looked up many at a time. Key 0 stands for an empty slot."""

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys, self.place = np.zeros(1 << self.bits, _U), np.zeros(1 << self.bits, np.int32)
        rest, slot = np.arange(len(keys)), self.slots(keys)
        while len(rest):
            _, first = np.unique(slot, return_index=True)
            first = first[self.keys[slot[first]] == 0]
            self.keys[slot[first]], self.place[slot[first]] = keys[rest[first]], rest[first]
            gone = np.ones(len(rest), bool)
            gone[first] = False
            rest, slot = rest[gone], (slot[gone] + 1) & ((1 << self.bits) - 1)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys) >> _U(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        slot = self.slots(keys)
        there = self.keys[slot]
        out = np.where(there == keys, self.place[slot], -1)
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            at, want = self.keys[slot[open_]], keys[open_]
            hit = at == want
            out[open_[hit]] = self.place[slot[open_[hit]]]
            open_ = open_[~hit & (at != 0)]
        return out


class Model:
    """The entries of some contexts and of all their suffixes, with the logarithms that scoring adds up."""

    def __init__(self, keys: np.ndarray, n: np.ndarray):
        nodes, total, distinct, where = _totals(keys, n)
        order = (keys >> _U(_TAG)).astype(np.int64) - 1
        tag = lambda x, k: x | _U(k) << _U(_TAG)
        # What is left of the suffix's counts and symbols once the symbols of a context are excluded.
        shorter = np.zeros(len(keys), np.int64)
        shorter_node = np.full(len(nodes), -1)
        node_order = (nodes >> _U(_TAG)).astype(np.int64) - 1
        for o in range(1, ORDER + 1):
            e, c = np.flatnonzero(order == o), np.flatnonzero(node_order == o)
            shorter[e] = np.searchsorted(keys, tag(last(keys[e], o - 1), o))
            shorter_node[c] = np.searchsorted(nodes, tag(nodes[c] & _U((1 << 8 * (o - 1)) - 1), o))
        above = np.bincount(where, weights=np.where(order > 0, n[np.minimum(shorter, len(n) - 1)] if len(n) else 0, 0), minlength=len(nodes))
        left = np.where(node_order > 0, total[shorter_node] - above, 0)
        new = np.where(node_order > 0, distinct[shorter_node] - distinct, 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            self.hit = np.log10((2 * n - 1) / (2 * total[where]))
            self.weight = np.log10(2.0 * n - 1)
            self.escape = np.log10(distinct / (2 * total))
            self.rest = np.where(left > 0, np.log10(2 * left), 0)
            self.escape_rest = np.where(left > 0, np.log10(new / (2 * left)), 0)
        self.escape_rest[~np.isfinite(self.escape_rest)] = -300.0
        for name in ("hit", "weight", "escape", "rest", "escape_rest"):
            setattr(self, name, getattr(self, name).astype(np.float32))
        self.last_resort = -np.log10(max(1, 256 - int(distinct[node_order == 0].sum()))) if len(nodes) else -np.log10(256)
        self.entries, self.nodes = Table(keys), Table(nodes)

    def positions(self, key: np.ndarray) -> np.ndarray:
        """log10 of each position's probability, given its gram."""
        score, todo, came = np.zeros(len(key)), np.arange(len(key)), np.full(len(key), -1)
        for o in range(ORDER, -1, -1):
            k = last(key[todo], o) | _U(o + 1) << _U(_TAG)
            e, before = self.entries.find(k), came[todo]
            hit = e >= 0
            at, b = e[hit], before[hit]
            score[todo[hit]] += np.where(b < 0, self.hit[at], self.weight[at] - self.rest[b])
            todo, k, before = todo[~hit], k[~hit], before[~hit]
            if not len(todo):
                return score
            c = self.nodes.find(context(k))
            there = c >= 0
            score[todo] += np.where(there, np.where(before < 0, self.escape[c], self.escape_rest[before]), 0)
            came[todo[there]] = c[there]
        score[todo] += self.last_resort
        return score


def word_counts(whole: DataFrame, n: int) -> DataFrame:
    """(block, words, counts, distinct, total): for each block its distinct words with their counts in all
    training texts. distinct and total are of the bucket, on one of its rows, and 0 on the others."""
    sent = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("words", pa.binary()), ("n", pa.binary())])

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, Counter] = {}
        for b in batches:
            for block, blob in zip(b.column("block").to_pylist(), b.column("docs").to_pylist()):
                mine = seen.setdefault(block, Counter())
                for doc_id, text in zip(*words.unpacked(blob)):
                    tokens = text.lower().split()
                    mine.update(dict.fromkeys(tokens, 0) if is_held(doc_id) else tokens)
        for block, mine in seen.items():
            buckets: dict[int, list[bytes]] = {}
            for w in sorted(mine):
                buckets.setdefault(zlib.crc32(w) % n, []).append(w)
            yield common.batch_of(sent, list(buckets), [block] * len(buckets), list(map(words.joined, buckets.values())), [_blob(np.array([mine[w] for w in ws], "<i8")) for ws in buckets.values()])

    answers = pa.schema([("block", pa.int32()), ("words", pa.binary()), ("counts", pa.binary()), ("distinct", pa.int64()), ("total", pa.int64())])

    def add(table: pa.Table) -> pa.Table:
        total: Counter = Counter()
        lists = [words.parted(w) for w in table.column("words").to_pylist()]
        for ws, c in zip(lists, table.column("n").to_pylist()):
            for w, k in zip(ws, np.frombuffer(zlib.decompress(c), "<i8").tolist()):
                total[w] += k
        first = lambda x: [x] + [0] * (len(lists) - 1)
        return pa.table([table.column("block"), table.column("words"), pa.array([_blob(np.array([total[w] for w in ws], "<i8")) for ws in lists], pa.binary()), pa.array(first(sum(c > 0 for c in total.values())), pa.int64()), pa.array(first(sum(total.values())), pa.int64())], schema=answers)

    return whole.mapInArrow(collect, "bucket int, block int, words binary, n binary").groupBy("bucket").applyInArrow(add, "block int, words binary, counts binary, distinct bigint, total bigint")


def scored(docs: DataFrame) -> DataFrame:
    """One row a document, repeated rows and empty texts (an end token alone) included. A null id is never
    held out. Without training texts every known count is 0 and the model is uniform over bytes."""
    spark, n = docs.sparkSession, words.blocks_for(docs)
    low = spark.sparkContext.broadcast(low_entries(docs))
    whole = words.packed(docs, words.hashed_block(n)).repartition(n, "block")
    known = common.stored(word_counts(whole, n), "word-counts")
    ends = docs.where(common.fold(FOLDS) != HELD).count()
    v, total = known.agg(F.coalesce(F.sum("distinct"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    v, total = v + (ends > 0), total + ends
    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    none = lambda *names: [F.lit(None).cast("binary").alias(c) for c in names]
    told = known.select("block", "words", "counts", *none("keys", "scores")).unionAll(gram_scores(whole, n, low).select("block", *none("words", "counts"), "keys", "scores"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        count: dict[bytes, int] = {}
        keys, logs = [np.zeros(0, _U)], [np.zeros(0, "<f4")]
        for ws, c, k, s in zip(*(right.column(x).to_pylist() for x in ("words", "counts", "keys", "scores"))):
            if ws is not None:
                count.update(zip(words.parted(ws), np.frombuffer(zlib.decompress(c), "<i8").tolist()))
            else:
                keys.append(_sorted_keys(k))
                logs.append(np.frombuffer(zlib.decompress(s), "<f4"))
        table, logs = Table(np.concatenate(keys) | _U(1) << _U(_TAG)), np.concatenate(logs)
        del keys

        def summed_up(texts: list[bytes]) -> list[float]:
            each = logs[table.find(grams(texts) | _U(1) << _U(_TAG))].astype(np.float64)
            return np.add.reduceat(each, np.cumsum([0, *map(len, texts[:-1])])).tolist() if texts else []

        rows, texts, size = [], [], 0
        scores: list[float] = []
        for blob in left.column("docs").to_pylist():
            for doc_id, text in zip(*words.unpacked(blob)):
                tokens = text.lower().split()
                c = np.array([*(count[w] for w in tokens), ends], np.int64)
                rows.append((doc_id, is_held(doc_id), len(c), int((c > 0).sum()), total, float((np.log10(c + 1.0) - np.log10(total + v + 1.0)).sum())))
                texts.append(spelled(tokens))
                size += len(texts[-1])
                if size > 1_000_000:
                    scores += summed_up(texts)
                    texts, size = [], 0
        scores += summed_up(texts)
        count.clear()
        del table, logs
        common.trim()
        return pa.table([pa.array(c, f.type) for c, f in zip([*(zip(*rows) if rows else [[]] * 6), scores], out)], schema=out)

    return whole.groupby("block").cogroup(told.groupby("block")).applyInArrow(score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")


def op1_ppm(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    A null or empty text is the end token alone; a null id is never held out; repeated rows all come back and each
    counts in training; other columns are left behind; an empty table gives an empty one."""
    return scored(common.read_documents(spark, sf_dir))
