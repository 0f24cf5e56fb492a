"""Token-id files: shards of documents in ascending id order, compressed by Re-Pair grammars.

In a shard, frequent pairs of neighbouring ids are replaced by new symbols, again and again, the most
frequent first (pairs whose counts lie within a factor of two in one round) until no pair occurs often
enough to pay for its rule; pairs never cross documents. A shard stores its rules, the length to which each rule
expands, the remaining symbols and where each document starts among them, so that any document, or any
range of a document's ids, is decoded without the rest.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import common, words

TOKENIZER, END, BASE = public_tokenizers.path("word_bpe_49k.json"), 2, 49_408
#: Ids in a shard before it is closed, and least count of a pair: a rule is two symbols and a length, so with
#: fewer uses it would cost more than it saves.
SHARD_IDS, LEAST = 1 << 19, 4
#: Ids of a rule that readers keep expanded.
READY = 64
SHARD = "block int, shard int, doc_ids array<bigint>, starts binary, symbols binary, rules binary, lengths binary"


class Grammar(NamedTuple):
    """rules[k] = the two symbols of symbol BASE + k; lengths[k] = how many ids it expands to; starts = where
    each document begins among the symbols, and their number."""

    symbols: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    starts: np.ndarray


def repair(ids: np.ndarray, starts: np.ndarray, base: int = BASE, least: int = LEAST) -> Grammar:
    """The grammar of ids, whose documents start at `starts` (the total length last).

    Every round halves the count that a pair must have; pairs at least that frequent are replaced together,
    left to right without overlap, and a rule that then has fewer than two uses is not made. Counts by hash
    bound those of the pairs from above, so no frequent pair is missed; exact counts decide.
    """
    seq, starts = ids.astype(np.uint64), starts.astype(np.int64)
    rules: list[np.ndarray] = []
    bits, need, n_rules, low = 17, 0, 0, np.uint64(32)
    while len(seq) > 1:
        key = (seq[:-1] << low) | seq[1:]
        slot = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)
        last = starts[(starts > 0) & (starts < len(seq))] - 1
        slot[last] = 1 << bits
        counts = np.bincount(slot, minlength=(1 << bits) + 1)
        counts[-1] = 0
        highest = int(counts.max())
        if highest < least:
            break
        need = max(least, min(need or highest, 1 << (highest.bit_length() - 1)))
        at = np.flatnonzero((counts >= need)[slot])
        order = np.argsort(key[at])
        sorted_ = key[at][order]
        new = np.r_[True, sorted_[1:] != sorted_[:-1]]
        n = np.diff(np.r_[np.flatnonzero(new), len(at)])
        keep = n >= need
        pairs = sorted_[new][keep]
        which = np.empty(len(at), np.int64)
        which[order] = np.repeat(np.where(keep, np.cumsum(keep) - 1, -1), n)
        at, which = at[which >= 0], which[which >= 0]
        if len(at):
            run = np.r_[True, np.diff(at) != 1]
            run_start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
            chosen = (np.arange(len(at)) - run_start) % 2 == 0
            at, which = at[chosen], which[chosen]
            uses = np.bincount(which, minlength=len(pairs))
            ok = uses[which] >= 2
            at, which = at[ok], which[ok]
        if len(at):
            made = np.flatnonzero(uses >= 2)
            symbol = np.zeros(len(pairs), np.uint64)
            symbol[made] = np.arange(base + n_rules, base + n_rules + len(made), dtype=np.uint64)
            rules.append(np.stack([pairs[made] >> low, pairs[made] & np.uint64(0xFFFFFFFF)], 1).astype(np.int64))
            n_rules += len(made)
            seq[at] = symbol[which]
            stay = np.ones(len(seq), bool)
            stay[at + 1] = False
            seq, starts = seq[stay], starts - np.searchsorted(at + 1, starts)
        if need == least:
            break
        need = max(least, need // 2)
    seq = seq.astype(np.int64)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.int64)
    lengths = np.zeros(0, np.int64)
    for part in rules:  # a round's rules use symbols of earlier rounds only
        known = np.r_[lengths, 0][np.maximum(part - base, -1)]
        lengths = np.r_[lengths, np.where(part < base, 1, known).sum(1)]
    return Grammar(seq, table, lengths, starts)


def expand(symbols: np.ndarray, rules: np.ndarray, base: int = BASE, left: np.ndarray | None = None) -> np.ndarray:
    """The ids that symbols stand for: all rules are applied once a round until none is left, but those that `left` marks."""
    while len(at := np.flatnonzero(symbols >= base)):
        if left is not None and not len(at := at[~left[symbols[at] - base]]):
            break
        wide = np.ones(len(symbols), np.int64)
        wide[at] = 2
        end = np.cumsum(wide)
        out = np.repeat(symbols, wide)
        pair = rules[symbols[at] - base]
        out[end[at] - 2], out[end[at] - 1] = pair[:, 0], pair[:, 1]
        symbols = out
    return symbols


def document(g: Grammar, i: int, begin: int = 0, end: int | None = None, base: int = BASE) -> np.ndarray:
    """Ids begin..end of the shard's i-th document: expansion lengths tell which symbols cover them."""
    part = g.symbols[g.starts[i] : g.starts[i + 1]]
    long = np.where(part < base, 1, g.lengths[np.maximum(part - base, 0)] if len(g.lengths) else 1)
    ends = np.cumsum(long)
    total = int(ends[-1]) if len(ends) else 0
    end = total if end is None else min(end, total)
    if begin >= end:
        return np.zeros(0, np.int64)
    lo, hi = np.searchsorted(ends, begin, "right"), np.searchsorted(ends, end, "left") + 1
    ids, skipped = expand(part[lo:hi], g.rules, base), int(ends[lo - 1]) if lo else 0
    return ids[begin - skipped : end - skipped]


def documents(g: Grammar, base: int = BASE) -> list[np.ndarray]:
    """The ids of all documents of a shard, expanded at once and parted by the expansion lengths. Rules of at most
    READY ids are expanded once and then copied."""
    ready = g.lengths <= READY
    short = np.flatnonzero(ready)
    size = np.r_[np.ones(base, np.int64), g.lengths]
    first = np.arange(base + len(g.lengths))
    first[base + short] = base + np.cumsum(g.lengths[short]) - g.lengths[short]
    ends = np.r_[0, np.cumsum(size[g.symbols])][g.starts]
    codes = words.Codes(np.r_[np.arange(base), expand(base + short, g.rules, base)], first, size)
    return np.split(codes.of(expand(g.symbols, g.rules, base, ready))[0], ends[1:-1])


def to_row(block: int, shard: int, doc_ids: list, g: Grammar) -> tuple:
    return block, shard, doc_ids, g.starts.astype("<u4").tobytes(), g.symbols.astype("<u4").tobytes(), g.rules.astype("<u4").tobytes(), g.lengths.astype("<u4").tobytes()


def from_row(starts: bytes, symbols: bytes, rules: bytes, lengths: bytes) -> Grammar:
    whole = lambda raw, kind: np.frombuffer(raw, kind).astype(np.int64)
    return Grammar(whole(symbols, "<u4"), whole(rules, "<u4").reshape(-1, 2), whole(lengths, "<u4"), whole(starts, "<u4"))


def lowered(texts: pa.Array) -> pa.ListArray:
    """Texts as lists of words. The tokenizer lowers them anyway, but for its special tokens, which hold "<|"."""
    raw = texts.cast(pa.string())
    if pc.any(pc.match_substring(raw, "<|")).as_py():
        raw = pc.if_else(pc.match_substring(raw, "<|"), raw, pc.ascii_lower(raw))
    else:
        raw = pc.ascii_lower(raw)
    return pc.ascii_split_whitespace(raw)


def split(texts: pa.Array) -> words.Split:
    """Texts' words."""
    return words.coded(lowered(texts))


def placed(texts: pa.Array) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
    """What `split` gives for all texts, SLAB bytes at a time, with the distinct words left in Arrow: none repeats."""
    parts, sizes = [pa.array([], pa.string()).dictionary_encode()], [np.zeros(0, np.int64)]
    for slab in words.slabs(texts):
        part, n = words.listed(lowered(slab))
        parts.append(part)
        sizes.append(n)
    whole = pa.chunked_array(parts).unify_dictionaries()
    return whole.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in whole.chunks]), np.concatenate(sizes)


#: The characters that a byte-level tokenizer shows for bytes without a printable one: those from 256 on, in order.
_SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174))}
#: Words of these characters, if they have no capitals, are what normalisation leaves alone; an apostrophe may part
#: a word otherwise than by kinds of characters, and "<|" may begin a special token.
_EASY, _HARD, _KNOWN = r"^[!-~\x{a1}-\x{24f}]+$", r"'|<\|", 0x250
_KIND = np.array([{"L": 1, "N": 2}.get(unicodedata.category(chr(c))[0], 3) for c in range(_KNOWN)], np.uint8)
#: Pieces in one string for the library, and strings or words in one call: what it says of each token besides its
#: id is far larger than the id.
_JOINED, _CALL = 256, 32


def pieces(easy: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """Easy words cut as the tokenizer cuts them, into runs of letters, single digits and runs of others; and
    where each word's pieces begin, their number last."""
    cuts, raw = np.frombuffer(easy.buffers()[1], np.int32, len(easy) + 1), np.frombuffer(easy.buffers()[2], np.uint8)
    raw = raw[: cuts[-1]]
    at = np.flatnonzero((raw & 0xC0) != 0x80)
    char = raw[at].astype(np.int32)
    wide = np.flatnonzero(char >= 0xC0)  # of two bytes, as no easy character has more
    char[wide] = (char[wide] & 0x1F) << 6 | (raw[at[wide] + 1] & 0x3F)
    kind, begins = _KIND[char], np.zeros(len(raw) + 1, bool)
    begins[cuts] = True
    new = np.r_[True, (kind[1:] != kind[:-1]) | (kind[1:] == 2)] | begins[at]
    starts = np.r_[at[new], len(raw)].astype(np.int32)
    return pa.StringArray.from_buffers(len(starts) - 1, pa.py_buffer(starts), easy.buffers()[2]), np.searchsorted(starts, cuts)


def shown(texts: pa.StringArray) -> pa.StringArray:
    """Each byte of the texts as the character that stands for it."""
    cuts, raw = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1), np.frombuffer(texts.buffers()[2], np.uint8)
    high = (raw := raw[: cuts[-1]]) >= 0x80
    ends = np.cumsum(np.r_[0, 1 + high], dtype=np.int32)
    char = np.array([_SHOWN.get(b, b) for b in range(256)], np.int32)[raw]
    out = np.zeros(ends[-1], np.uint8)
    out[ends[:-1]] = np.where(high, 0xC0 | char >> 6, char)
    out[ends[1:][high] - 1] = 0x80 | (char[high] & 0x3F)
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(np.ascontiguousarray(ends[cuts])), pa.py_buffer(out))


class Library(NamedTuple):
    """The tokenizer; its model alone, for pieces that are already cut and shown; which ids end a piece."""

    whole: object
    model: object
    ends: np.ndarray


_LOADED: dict[int, Library] = {}


def library(model: str) -> Library:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, pre_tokenizers

    if hash(model) not in _LOADED:
        whole = Tokenizer.from_str(model)
        bare, ends = Tokenizer(whole.model), np.zeros(1 << 16, bool)
        bare.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        ends[[i for token, i in bare.get_vocab().items() if token.endswith(whole.model.end_of_word_suffix)]] = True
        _LOADED[hash(model)] = Library(whole, bare, ends)
    return _LOADED[hash(model)]


def called(tokenizer, texts: pa.StringArray, many: int) -> tuple[np.ndarray, list[int]]:
    """The ids of texts, one after another, and how many each has; `many` texts at a time."""
    flat, sizes = [np.zeros(0, words.ID)], []
    for i in range(0, len(texts), many):
        for e in tokenizer.encode_batch_fast(texts.slice(i, many).to_pylist(), add_special_tokens=False):
            flat.append(np.array(e.ids, words.ID))
            sizes.append(len(flat[-1]))
    return np.concatenate(flat), sizes


def encode(distinct: pa.StringArray, lib: Library) -> words.Codes:
    """Distinct words to ids by the tokenizers library, which keeps no state between words.

    Easy words are cut into pieces here, all at once, and the library's model gets each distinct piece, many in a
    call; the last id of a piece tells its end. Other words go through the whole library.
    """
    easy = pc.and_(pc.match_substring_regex(distinct, _EASY), pc.invert(pc.match_substring_regex(distinct, _HARD)))
    easy = pc.and_(easy, pc.equal(distinct, pc.utf8_lower(distinct)))
    is_easy = easy.to_numpy(zero_copy_only=False)
    first, sizes = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), np.int32)
    flat, sizes[~is_easy] = called(lib.whole, distinct.filter(pc.invert(easy)), _CALL * _JOINED)
    first[~is_easy] = np.cumsum(sizes[~is_easy], dtype=np.int64) - sizes[~is_easy]
    if is_easy.any():
        cut, begin = pieces(distinct.filter(easy))
        cut = cut.dictionary_encode()
        lists = np.r_[np.arange(0, len(cut.dictionary), _JOINED), len(cut.dictionary)].astype(np.int32)
        ids, _ = called(lib.model, pc.binary_join(pa.ListArray.from_arrays(pa.array(lists), shown(cut.dictionary)), " "), _CALL)
        ends = np.flatnonzero(lib.ends[ids]) + 1
        if len(ends) != len(cut.dictionary) or ends[-1] != len(ids):
            raise ValueError("ids must tell where a piece ends")
        size = np.diff(np.r_[0, ends]).astype(np.int32)
        more, at = words.Codes(ids, ends - size, size).of(cut.indices.to_numpy())
        first[is_easy], sizes[is_easy] = len(flat) + at[begin[:-1]], np.diff(at[begin])
        flat = np.concatenate([flat, more])
    return words.Codes(flat, first, sizes)


def ordered_blocks(docs: DataFrame, n: int) -> list[int]:
    """At most n - 1 ids that part the documents into about equal blocks in id order."""
    ids = docs.where(F.col("doc_id").isNotNull())
    return sorted(set(map(int, ids.approxQuantile("doc_id", [i / n for i in range(1, n)], 1 / (20 * n))))) if n > 1 else []


def write_shards(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Writes the shards of all documents below path and returns them as read from there.

    Blocks are ranges of doc_id, a null id first; in a block, documents are ordered by id, then by text.
    The tokenizer cuts at white space and never looks across it, so a block's distinct words are encoded once
    and its documents put together by their places.
    """
    with open(tokenizer, encoding="utf-8") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())
    n = words.blocks_for(docs)
    bounds = ordered_blocks(docs, n)
    block = F.coalesce(F.size(F.filter(F.array(*map(F.lit, bounds)), lambda x: x <= F.col("doc_id"))), F.lit(0)) if bounds else F.lit(0)
    fields = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("doc_ids", pa.list_(pa.int64())), *((c, pa.binary()) for c in ("starts", "symbols", "rules", "lengths"))])
    end = np.array([END], words.ID).tobytes()

    def shard(table: pa.Table) -> pa.Table:
        block, whole = table.column("block")[0].as_py(), pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in table.column("docs").to_pylist()])
        ids, order = whole.column("doc_id").to_pylist(), pc.sort_indices(whole, [("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start").to_pylist()
        distinct, places, sizes = placed(whole.column("text").combine_chunks())
        del whole
        coded = words.by_places(places, sizes, encode(distinct, library(model.value)))
        del distinct, places
        out, doc_ids, parts, size = [], [], [], 0

        def close():
            starts = np.r_[0, np.cumsum([len(x) // 2 for x in parts])].astype(np.int64)
            out.append(to_row(block, len(out), doc_ids, repair(np.frombuffer(b"".join(parts), words.ID), starts)))

        for k in order:
            doc_ids.append(ids[k])
            parts.append(coded[k] + end)
            size += len(parts[-1]) // 2
            if size >= shard_ids:
                close()
                doc_ids, parts, size = [], [], 0
        if doc_ids:
            close()
        del coded, parts
        common.trim()
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=fields)

    shards = words.packed(docs, block.cast("int")).repartition(n, "block").groupBy("block").applyInArrow(shard, SHARD)
    shards.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(shards.schema).parquet(path)


def read_documents(shards: DataFrame, each=lambda ids: ids.astype(words.ID).tobytes(), column: pa.Field = pa.field("ids", pa.binary()), ddl: str = "ids binary") -> DataFrame:
    """block, shard, pos, doc_id, before, n_tokens, ids: every document with its ids, decoded by itself from
    the shard; before counts the shard's ids that precede it. `each` may turn the ids into another column."""
    schema = pa.schema([("block", pa.int32()), ("shard", pa.int32()), ("pos", pa.int32()), ("doc_id", pa.int64()), ("before", pa.int64()), ("n_tokens", pa.int64()), column])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                g = from_row(row["starts"], row["symbols"], row["rules"], row["lengths"])
                ids = documents(g)
                n = np.array([len(x) for x in ids], np.int64)
                k = len(ids)
                yield common.batch_of(schema, [row["block"]] * k, [row["shard"]] * k, list(range(k)), row["doc_ids"], pa.array(np.cumsum(n) - n), pa.array(n), list(map(each, ids)))

    return shards.mapInArrow(run, "block int, shard int, pos int, doc_id bigint, before bigint, n_tokens bigint, " + ddl)


def with_starts(read: DataFrame) -> DataFrame:
    """read with `start`, the ids of all documents before. Blocks, as many as shuffle partitions at most,
    are added up on the driver; shards within their block."""
    spark = read.sparkSession
    shards = read.groupBy("block", "shard").agg(F.sum("n_tokens").alias("n"))
    shards = common.stored(shards.withColumn("earlier", F.sum("n").over(Window.partitionBy("block").orderBy("shard")) - F.col("n")), "shard-sizes")
    total, blocks = 0, []
    for r in shards.groupBy("block").agg(F.sum("n").alias("n")).orderBy("block").collect():
        blocks.append((r["block"], total))
        total += r["n"]
    base = F.broadcast(spark.createDataFrame(blocks, "block int, base bigint"))
    place = shards.join(base, "block").select("block", "shard", (F.col("base") + F.col("earlier")).alias("base"))
    return read.join(place, ["block", "shard"]).withColumn("start", F.col("base") + F.col("before"))


def op5_tokenfiles(spark, sf_dir: str) -> DataFrame:
    """One row a document, as read back from the files; an empty or null text is the end id alone."""
    docs = common.read_documents(spark, sf_dir)
    shards = write_shards(docs, common.scratch_dir(spark, "shards"))
    read = read_documents(shards, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.field("ids_crc32", pa.int64()), "ids_crc32 bigint")
    return with_starts(common.stored(read, "token-facts")).select("doc_id", "start", "n_tokens", "ids_crc32")
