"""A global shuffle of distinct words: each is encoded once, wherever and however often it occurs.

Documents are dealt into blocks. A block's distinct words go, by hash, to buckets; a bucket drops what
several blocks sent alike, encodes each word once, and answers every block; the answers are joined back to
the block, which reassembles its documents by position. What moves is each text once, packed, and each
word once a block, however frequent; no row stands for an occurrence.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

#: Ids are packed as little-endian unsigned 16-bit numbers where they travel; a vocabulary must fit.
ID = np.dtype("<u2")
#: Bytes of text in a block: what one task holds at once.
BLOCK = 32 << 20
#: Bytes of text that are split together, and words whose ids are looked up together: a block's own arrays are small
#: beside what splitting and looking up need for a moment.
SLAB, LOOKED_UP = 4 << 20, 1 << 18
_DOCS = pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])


def blocks_for(df: DataFrame, column: str = "text") -> int:
    """Blocks of at most about BLOCK bytes of text, and no fewer than shuffle partitions."""
    size = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK))


def hashed_block(n: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")


def packed(docs: DataFrame, block: Column) -> DataFrame:
    """(block, docs): the documents of a task that belong to one block, as a compressed Arrow stream."""
    schema = pa.schema([("block", pa.int32()), ("docs", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for b in batches:
            if not b.num_rows:
                continue
            of = b.column("block").to_numpy()
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order])) + 1
            ids, raw, out = b.column("doc_id"), b.column("text").cast(pa.binary()), ([], [])
            for part in np.split(order, cuts):
                sink, at = pa.BufferOutputStream(), pa.array(part)
                with pa.ipc.new_stream(sink, _DOCS, options=options) as w:
                    w.write_batch(pa.RecordBatch.from_arrays([ids.take(at), raw.take(at)], schema=_DOCS))
                out[0].append(int(of[part[0]]))
                out[1].append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int32()), pa.array(out[1], pa.binary())], schema=schema)

    return docs.select("doc_id", "text", block.alias("block")).mapInArrow(run, "block int, docs binary")


def unpacked(blob: bytes) -> tuple[list[int | None], list[bytes]]:
    t = pa.ipc.open_stream(blob).read_all()
    return t.column("doc_id").to_pylist(), t.column("text").to_pylist()


class Split(NamedTuple):
    """Some texts as words: the distinct ones, which may repeat, each word's place among them in order, and
    words a text."""

    distinct: list[bytes]
    places: np.ndarray
    sizes: np.ndarray


Splitter = Callable[[pa.Array], Split]


def by_text(split: Callable[[bytes], list[bytes]]) -> Splitter:
    """A splitter from a function that gives one text's words."""

    def run(texts: pa.Array) -> Split:
        known: dict[bytes, int] = {}
        parts = [[known.setdefault(w, len(known)) for w in split(t)] for t in texts.to_pylist()]
        places = np.fromiter((k for p in parts for k in p), np.int32, sum(map(len, parts)))
        return Split(list(known), places, np.array([len(p) for p in parts], np.int64))

    return run


def listed(texts: pa.ListArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words of lists, empty ones left out, one after another by a dictionary, and words a list."""
    flat, of = texts.flatten(), np.repeat(np.arange(len(texts)), pc.list_value_length(texts).to_numpy())
    there = pc.greater(pc.binary_length(flat), 0)
    if not pc.all(there).as_py():
        flat, of = flat.filter(there), of[there.to_numpy(zero_copy_only=False)]
    return flat.dictionary_encode(), np.bincount(of, minlength=len(texts))


def coded(texts: pa.ListArray) -> Split:
    """A splitter's result from lists of words, empty ones left out."""
    words, sizes = listed(texts)
    return Split(words.dictionary.cast(pa.binary()).to_pylist(), words.indices.to_numpy(), sizes)


def slabs(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in parts of SLAB bytes, or of one text."""
    ends = np.cumsum(np.r_[0, pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)])
    i = 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + SLAB, "right")) - 1)
        yield texts.slice(i, j - i)
        i = j


def by_slab(split: Splitter, texts: pa.Array) -> Split:
    """What split gives for all texts, SLAB bytes at a time; distinct words do not repeat."""
    known: dict[bytes, int] = {}
    places, sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
    for slab in slabs(texts):
        s = split(slab)
        at = np.fromiter((known.setdefault(w, len(known)) for w in s.distinct), np.int32, len(s.distinct))
        places.append(at[s.places])
        sizes.append(s.sizes)
    return Split(list(known), np.concatenate(places), np.concatenate(sizes))


class Codes(NamedTuple):
    """Packed ids of distinct words: those of word k are flat[first[k]:][:size[k]]."""

    flat: np.ndarray
    first: np.ndarray
    size: np.ndarray

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at these places, one after another, and where each word's begin, their number last."""
        wide = self.size[places]
        ends = np.r_[0, np.cumsum(wide, dtype=np.int64)]
        return self.flat[np.repeat(self.first[places] - ends[:-1], wide) + np.arange(ends[-1])], ends


def by_places(places: np.ndarray, sizes: np.ndarray, codes: Codes) -> list[bytes]:
    """The packed ids of each text, given its words' places and their number; about LOOKED_UP words at a time."""
    stop, out, i = np.r_[0, np.cumsum(sizes)], [], 0
    while i < len(sizes):
        j = max(i + 1, int(np.searchsorted(stop, stop[i] + LOOKED_UP, "right")) - 1)
        ids, ends = codes.of(places[stop[i] : stop[j]])
        cuts = ends[stop[i : j + 1] - stop[i]].tolist()
        out += [ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]
        i = j
    return out


def looked_up(s: Split, codes: list[bytes]) -> list[bytes]:
    """The packed ids of each text, given those of the distinct words."""
    size = np.array([len(c) for c in codes], np.int32) // ID.itemsize
    return by_places(s.places, s.sizes, Codes(np.frombuffer(b"".join(codes), ID), np.cumsum(size, dtype=np.int64) - size, size))


def joined(items: list[bytes]) -> bytes:
    """Lengths, then the items' bytes, compressed: how lists of words and of codes travel."""
    return zlib.compress(len(items).to_bytes(4, "little") + np.array([len(x) for x in items], "<u4").tobytes() + b"".join(items), 1)


def parted(blob: bytes) -> list[bytes]:
    raw = zlib.decompress(blob)
    n = int.from_bytes(raw[:4], "little")
    ends = (np.cumsum(np.frombuffer(raw, "<u4", n, 4)) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends)]


def bucketed(distinct: Iterable[bytes], n: int) -> dict[int, list[bytes]]:
    """The words of each bucket, in order: a block and its buckets agree on it without saying so. A word meets
    its forms with a stop or comma, which an encoder may build from it."""
    out: dict[int, list[bytes]] = {}
    for w in sorted(distinct):
        out.setdefault(zlib.crc32(w.rstrip(b".,")) % n, []).append(w)
    return out


def encoded(
    docs: DataFrame, block: Column, n: int, split: Splitter, encoder: Callable[[], Callable[[list[bytes]], list[bytes]]],
    finish: Callable[[int, Iterator[tuple[int | None, bytes, bytes]]], pa.Table], result: str,
) -> DataFrame:
    """finish(block, documents) for each block, where a document is (doc_id, text, packed ids).

    split gives texts' words in order; encoder() makes, once a task, the function that turns distinct words
    into packed ids. Blocks hold 1/n of the documents, buckets 1/n of the distinct words.
    """
    whole = packed(docs, block).repartition(n, "block")
    sent = pa.schema([("bucket", pa.int32()), ("block", pa.int32()), ("words", pa.binary())])
    texts = lambda blob: pa.ipc.open_stream(blob).read_all().column("text").combine_chunks()

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, set[bytes]] = {}
        for b in batches:
            for block, blob in zip(b.column("block").to_pylist(), b.column("docs").to_pylist()):
                mine = seen.setdefault(block, set())
                for slab in slabs(texts(blob)):
                    mine.update(split(slab).distinct)
        while seen:
            block, mine = seen.popitem()
            buckets = bucketed(mine, n)
            yield pa.RecordBatch.from_arrays([pa.array(list(buckets), pa.int32()), pa.array([block] * len(buckets), pa.int32()), pa.array(map(joined, buckets.values()), pa.binary())], schema=sent)
        common.trim()

    answers = pa.schema([("block", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary())])

    def encode(table: pa.Table) -> pa.Table:
        distinct = list(dict.fromkeys(w for blob in table.column("words").to_pylist() for w in parted(blob)))
        code = dict(zip(distinct, encoder()(distinct)))
        codes = [joined([code[w] for w in parted(blob)]) for blob in table.column("words").to_pylist()]
        del distinct, code
        common.trim()
        return pa.table([table.column("block"), table.column("bucket"), pa.array(codes, pa.binary())], schema=answers)

    codes = whole.mapInArrow(collect, "bucket int, block int, words binary").groupBy("bucket").applyInArrow(encode, "block int, bucket int, codes binary")

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        docs_ = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in left.column("docs").to_pylist()] or [_DOCS.empty_table()])
        text = docs_.column("text").combine_chunks()
        s = by_slab(split, text)
        buckets = bucketed(s.distinct, n)
        code: dict[bytes, bytes] = {}
        for bucket, cs in zip(right.column("bucket").to_pylist(), right.column("codes").to_pylist()):
            code.update(zip(buckets.pop(bucket), parted(cs)))
        ids = looked_up(s, [code[w] for w in s.distinct])
        del s, code, buckets
        out = finish(left.column("block")[0].as_py() if left.num_rows else -1, zip(docs_.column("doc_id").to_pylist(), (t.as_py() for t in text), ids))
        del docs_, text, ids
        common.trim()
        return out

    return whole.groupby("block").cogroup(codes.groupby("block")).applyInArrow(reassemble, result)
