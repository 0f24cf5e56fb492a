"""Removal of long repeated substrings, found through common-prefix interval trees.

Texts are sequences of bytes, or of words (case of A-Z aside) given by 64-bit hashes; matches never cross
documents. Every window of `length` units has an anchor: the place in it whose first few units hash least. Equal windows have their anchors at the same offset, so a window
that occurs twice is found among the places that share an anchor's bytes. The starts of the windows with one
anchor are consecutive; the text that they cover is the anchor's run.

1. Runs are counted by anchor and content. A run that occurs twice is repeated throughout.
2. Where an anchor is shared but the run is unique, it is compared with the distinct runs of the anchor: the
   contexts to the right of the anchor are sorted into a suffix array with common-prefix lengths, a stack
   scan builds the tree of common-prefix intervals, and in every interval the left contexts, kept sorted,
   tell how far occurrences agree to the left before they differ. An interval's depth and a left extension
   that reach the length together are a maximal repeat; all its occurrences are covered, not just neighbours.
3. An anchor with more than GROUP distinct runs is not gathered in a task: its runs are cut into parts of
   STEPS windows, whose common bytes are longer anchors, and parts of those that are still crowded into a
   quarter, down to single windows, which are counted. So a run is cut finely only where its neighbourhood
   stays crowded. All ways give the same bytes.

Each row is a document of its own: two equal rows are copies, and lose what equal texts under two ids lose.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cairn.llm import common, words
from cairn.llm.neardup import word_hashes, word_starts

#: Bytes of a unit: texts as bytes, or as words.
BYTES, WORDS = 1, 8
#: Least length of a repeat in units, and units that an anchor hashes.
LENGTH, SEED = {BYTES: 400, WORDS: 50}, {BYTES: 64, WORDS: 8}
#: Distinct runs that one task compares, and windows in a part of the runs of a crowded anchor at first.
GROUP, STEPS = 256, {BYTES: 64, WORDS: 16}
#: Parts into which the runs of one anchor are dealt where they are joined with what is known of the anchor.
SALTS = 16
#: Units that are hashed together, to stay in a processor's cache; longer texts are cut with overlap.
_CHUNK = 500_000
_U = np.uint64
_BYTES = np.random.default_rng(400).integers(1, 1 << 63, 256, _U) * _U(2) + _U(1)
_PLACE = _U((1 << 24) - 1)


def sequence(raw: bytes, unit: int) -> bytes:
    """A text's units, one after the other."""
    return raw if unit == BYTES else word_hashes(raw).tobytes()


def hashes(seq: bytes, unit: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the first SEED and of the `length` units from every place on, built by doubling."""
    h = _BYTES[np.frombuffer(seq, np.uint8)] if unit == BYTES else np.frombuffer(seq, _U)
    n = len(h) - length + 1
    width, base, at = 1, _U(0x9E3779B97F4A7C15), 0
    seeds = whole = None
    while width <= length:
        if width == 16:
            h = h ^ h >> _U(31)
            h *= _U(0x7FB5D329728EA185)
            h ^= h >> _U(33)
        if width == SEED[unit]:
            seeds = h
        if length & width:
            part = h[at : at + n]
            whole, at = part.copy() if whole is None else whole * base + part, at + width
        if 2 * width <= length:
            h = h[:-width] * base + h[width:]
        base, width = _U(int(base) ** 2 % (1 << 64)), 2 * width
    return seeds, whole ^ whole >> _U(32)


def anchors(seeds: np.ndarray, width: int) -> np.ndarray:
    """For every window its anchor's place, one of `width`: minima of blocks from both sides, the leftmost of
    equal ones."""
    h = seeds * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(32)
    h *= _U(0x81DADEF4BC2DD44D)
    key = (h & ~_PLACE) | np.arange(len(h), dtype=_U)
    n = len(key) - width + 1
    whole = np.concatenate([key, np.full(-len(key) % width, ~_U(0))]).reshape(-1, width)
    forth = np.minimum.accumulate(whole, 1).ravel()
    back = np.minimum.accumulate(whole[:, ::-1], 1)[:, ::-1].ravel()
    return (np.minimum(back[:n], forth[width - 1 : width - 1 + n]) & _PLACE).astype(np.int64)


def runs(texts: list[bytes], unit: int, length: int) -> tuple[np.ndarray, ...]:
    """(document, start, windows, offset of the anchor, anchor's hash, run's hash) of all runs of some texts."""
    pieces: list[tuple[int, int, bytes]] = []
    for k, t in enumerate(texts):
        if len(t) >= length * unit:
            pieces += [(k, i, t[i * unit : (i + _CHUNK + length - 1) * unit]) for i in range(0, len(t) // unit - length + 1, _CHUNK)]
    out: list[tuple[np.ndarray, ...]] = []
    i = 0
    while i < len(pieces):
        j, size = i, 0
        while j < len(pieces) and size < _CHUNK:
            size += len(pieces[j][2]) // unit
            j += 1
        part, i = pieces[i:j], j
        seeds, whole = hashes(b"".join(p[2] for p in part), unit, length)
        seeds = seeds[: size - SEED[unit] + 1]
        at = anchors(seeds, length - SEED[unit] + 1)
        sizes = np.array([len(p[2]) // unit for p in part])
        ends = np.cumsum(sizes)
        owner = np.repeat(np.arange(len(part)), sizes)[: len(at)]
        p = np.flatnonzero(np.arange(len(at)) + length <= ends[owner])
        cut = np.flatnonzero(np.r_[True, (np.diff(at[p]) != 0) | (np.diff(owner[p]) != 0) | (np.diff(p) != 1)])
        a, b = p[cut], p[np.r_[cut[1:], len(p)] - 1]
        m, o = at[a], owner[a]
        run = (whole[a] * _U(0x9E3779B97F4A7C15) + whole[b]) ^ _U(0x94D049BB133111EB) * ((b - a) * 512 + m - a).astype(_U)
        run *= _U(0x7FB5D329728EA185)
        base = np.array([q[1] for q in part]) - (ends - sizes)
        out.append((np.array([q[0] for q in part])[o], a + base[o], b - a + 1, m - a, seeds[m], run ^ run >> _U(32)))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 4 + (np.zeros(0, _U),) * 2


def prefix(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def covers(lefts: list[bytes], rights: list[bytes], length: int, unit: int = BYTES) -> list[tuple[int, int] | None]:
    """For each occurrence (units before the anchor, units from it on) how far to the left and to the right
    of the anchor it is covered by strings of `length` units around the anchor that another one has too.

    Suffixes are sorted and a stack scan makes the intervals of common prefixes, deepest first. Of every
    interval the left contexts' ranks are kept in order; merging two intervals, the smaller into the larger,
    only neighbours in that order can agree further to the left than before.
    """
    n = len(rights)
    if n == 2:
        depth = prefix(rights[0], rights[1]) // unit
        if depth + min(map(len, lefts)) // unit < length:
            return [None, None]
        common_left = prefix(lefts[0][::-1], lefts[1][::-1]) // unit
        return [(common_left, depth) if common_left + depth >= length else None] * 2
    back = [x[::-1] for x in lefts]
    by_left = sorted(range(n), key=back.__getitem__)
    rank = [0] * n
    for r, i in enumerate(by_left):
        rank[i] = r
    near, far_left, far_right = [0] * n, [-1] * n, [-1] * n

    def merge(a: list[int], b: list[int], depth: int) -> list[int]:
        if len(a) < len(b):
            a, b = b, a
        for r in b:
            at = bisect_left(a, r)
            i = by_left[r]
            for q in a[max(0, at - 1) : at + 1]:
                j = by_left[q]
                common_left = prefix(back[i], back[j]) // unit
                for z in (i, j):
                    near[z] = max(near[z], common_left)
                    if common_left + depth >= length:
                        far_left[z] = max(far_left[z], common_left)
                        far_right[z] = max(far_right[z], depth)
            a.insert(at, r)
        return a

    order = sorted(range(n), key=rights.__getitem__)
    stack: list[tuple[int, list[int]]] = []
    for k, i in enumerate(order):
        here = [rank[i]]
        depth = prefix(rights[i], rights[order[k + 1]]) // unit if k + 1 < n else -1
        while stack and stack[-1][0] >= depth:
            d, members = stack.pop()
            here = merge(members, here, d)
        stack.append((depth, here))
    return [(far_left[i], far_right[i]) if far_left[i] >= 0 else None for i in range(n)]


_RUN = "anchor bigint, run bigint, doc_id bigint, crc bigint, block int, start bigint, windows int, offset int"
_SPAN = "doc_id bigint, crc bigint, block int, start bigint, stop bigint"
_CONTEXT = "anchor bigint, k bigint, n bigint, doc_id bigint, crc bigint, block int, start bigint, windows int, offset int, bytes binary"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


def run_table(docs: DataFrame, n: int, unit: int, length: int) -> DataFrame:
    schema = _schema(_RUN)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = common.texts(b)
            of, start, windows, offset, anchor, run = runs([sequence(t, unit) for t in texts], unit, length)
            crc = np.array([zlib.crc32(t) for t in texts], np.int64)
            of_ = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(run.view(np.int64)), b.column("doc_id").take(of_), pa.array(crc[of] if len(of) else of), b.column("block").take(of_), pa.array(start), pa.array(windows.astype(np.int32)), pa.array(offset.astype(np.int32))],
                schema=schema,
            )
        common.trim()

    return docs.select("doc_id", "text", words.hashed_block(n).alias("block")).mapInArrow(find, _RUN)


def contexts(packed_docs: DataFrame, wanted: DataFrame, unit: int, length: int) -> DataFrame:
    """wanted with the units of each run, cut from the block's documents."""
    schema = _schema(_CONTEXT)

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        by_doc, rows = defaultdict(list), right.to_pylist()
        for k, r in enumerate(rows):
            by_doc[r["doc_id"], r["crc"]].append(k)
        found: list[bytes | None] = [None] * len(rows)
        for blob in left.column("docs").to_pylist():
            for doc_id, text in zip(*words.unpacked(blob)):
                if wants := by_doc.get((doc_id, zlib.crc32(text))) if by_doc else None:
                    seq = sequence(text, unit)
                    for k in wants:
                        found[k] = seq[rows[k]["start"] * unit : (rows[k]["start"] + rows[k]["windows"] + length - 1) * unit]
        return pa.table([right.column(f.name) for f in [*schema][:-1]] + [pa.array(found, pa.binary())], schema=schema)

    return packed_docs.groupby("block").cogroup(wanted.groupby("block")).applyInArrow(cut, _CONTEXT)


def compared(cold: DataFrame, unit: int, length: int) -> DataFrame:
    """Spans of the unique runs that share a repeat with another run of their anchor. A task reads its anchors in
    order, many in a batch, and holds the runs of one."""
    schema = _schema(_SPAN)
    fields = ("anchor", "n", "doc_id", "crc", "block", "start", "offset", "bytes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            rows = pa.Table.from_batches([b])
            held = rows if held is None else pa.concat_tables([held, rows])
            anchor = held.column("anchor").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(anchor)) + 1).tolist()]
            yield of_anchors(held, cuts)
            held = held.slice(cuts[-1])
        if held is not None:
            yield of_anchors(held, [0, held.num_rows])
        common.trim()

    def of_anchors(table: pa.Table, cuts: list[int]) -> pa.RecordBatch:
        """The spans of rows cuts[0] to cuts[-1], where each cut begins an anchor."""
        n, start, offset = (table.column(c).to_numpy() for c in ("n", "start", "offset"))
        raw, at = table.column("bytes").slice(0, cuts[-1]).to_pylist(), offset.tolist()
        of, left, right = [], [], []
        for a, b in zip(cuts, cuts[1:]):
            found = covers([raw[k][: at[k] * unit] for k in range(a, b)], [raw[k][at[k] * unit :] for k in range(a, b)], length, unit)
            for k, c in enumerate(found, a):
                if c:
                    of.append(k)
                    left.append(c[0])
                    right.append(c[1])
        k = np.array(of, np.int64)
        single = n[k] == 1
        k, left, right = k[single], np.array(left, np.int64)[single], np.array(right, np.int64)[single]
        place = start[k] + offset[k]
        whole = table.select(["doc_id", "crc", "block"]).take(pa.array(k)).combine_chunks()
        return common.batch_of(schema, *(_flat(c) for c in whole.columns), pa.array(place - left), pa.array(place + right))

    return cold.select(*fields).repartition("anchor").sortWithinPartitions("anchor").mapInArrow(compare, _SPAN)


def _flat(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)


def of_shared(rows: DataFrame, shared: DataFrame) -> DataFrame:
    """rows (anchor, run, ...) of the anchors in `shared`, with its columns; an anchor's rows are dealt into parts."""
    dealt = shared.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64("run"), F.lit(SALTS)).cast("int")).join(dealt, ["anchor", "salt"]).drop("salt")


def refined(hot: DataFrame, step: int, unit: int, length: int) -> DataFrame:
    """Spans of the unique runs of crowded anchors. Each run is cut into parts of at most `step` windows at
    equal distances from the anchor; the units that all windows of a part have in common become its anchor,
    and parts are treated like runs, with a quarter of the step. With a step of one a part is a window, and
    counting decides."""
    ddl = _CONTEXT.replace("k bigint", "run bigint")
    schema = _schema(ddl)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                w, far = r["windows"], r["offset"]
                core, whole = hashes(r["bytes"], unit, length - step + 1)[1], hashes(r["bytes"], unit, length)[1]
                for j in range((far - w + 1) // step, far // step + 1):
                    lo, hi = max(0, far - step * j - step + 1), min(w - 1, far - step * j)
                    at = far - step * j - lo
                    key = _pair(_pair(r["anchor"], j), int(core[lo + at]))
                    out.append((key, _pair(_pair(int(whole[lo]), int(whole[hi])), hi - lo), r["n"], r["doc_id"], r["crc"], r["block"], r["start"] + lo, hi - lo + 1, at, r["bytes"][lo * unit : (hi + length) * unit]))
            yield common.batch_of(schema, *(map(list, zip(*out)) if out else [[]] * len(schema)))

    rows = common.stored(hot.select("anchor", F.col("k").alias("run"), *[c.split()[0] for c in _CONTEXT.split(", ")[2:]]).mapInArrow(cut, ddl), "parts")
    times = rows.groupBy("anchor", "run").agg(F.sum("n").alias("times"))
    shared = times.groupBy("anchor").agg(F.count("*").alias("k"), F.min("times").alias("least")).where("k >= 2 and least = 1").select("anchor", "k")
    whole = rows.where("n = 1").join(times.where("times >= 2").select("anchor", "run"), ["anchor", "run"])
    found = whole.select("doc_id", "crc", "block", "start", (F.col("start") + F.col("windows") + length - 1).alias("stop"))
    if step == 1:
        return found
    fields = [c.split()[0] for c in _CONTEXT.split(", ")[3:]]
    distinct = rows.groupBy("anchor", "run").agg(F.sum("n").alias("n"), *(F.first(c).alias(c) for c in fields))
    near = common.stored(of_shared(distinct, shared).select("anchor", "k", "n", *fields), "part-contexts")
    return found.unionByName(compared_or_refined(near, step // 4, unit, length))


def compared_or_refined(near: DataFrame, step: int, unit: int, length: int) -> DataFrame:
    """Spans of unique runs (anchor, k, ...): those of crowded anchors, if there are any, are cut first."""
    found, hot = compared(near.where(F.col("k") <= GROUP), unit, length), near.where(F.col("k") > GROUP)
    return found if hot.isEmpty() else found.unionByName(refined(hot, step, unit, length))


def _pair(a: int, b: int) -> int:
    """A signed 64-bit hash of two numbers."""
    h = ((a ^ (a >> 31)) * 0x9E3779B97F4A7C15 + b * 0xD6E8FEB86659FD93 + 0x2545F4914F6CDD1D) % (1 << 64)
    h = (h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
    return (h ^ (h >> 32)) - (1 << 63)


def spans(docs: DataFrame, n: int, unit: int, length: int) -> DataFrame:
    """doc_id, crc (of the text), block, start, stop: ranges of units covered by repeats; they may overlap."""
    found = common.stored(run_table(docs, n, unit, length), "runs")
    first = [F.first(c).alias(c) for c in ("doc_id", "crc", "block", "start", "windows", "offset")]
    distinct = common.stored(found.groupBy("anchor", "run").agg(F.count("*").alias("n"), *first), "distinct-runs")
    shared = distinct.groupBy("anchor").agg(F.count("*").alias("k"), F.min("n").alias("least")).where("k >= 2 and least = 1").select("anchor", "k")
    wanted = of_shared(distinct, shared).select("anchor", "k", "n", "doc_id", "crc", "block", "start", "windows", "offset")
    near = common.stored(contexts(words.packed(docs, words.hashed_block(n)), wanted, unit, length), "contexts")
    whole = found.join(distinct.where("n >= 2").select("anchor", "run"), ["anchor", "run"]).select("doc_id", "crc", "block", "start", (F.col("start") + F.col("windows") + length - 1).alias("stop"))
    out = common.stored(whole.unionByName(compared_or_refined(near, STEPS[unit], unit, length)), "spans")
    common.forget(found, distinct, near)
    return out


def merged(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of ranges, as maximal ranges in order; touching ranges are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(pairs):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def whole_characters(raw: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The ranges of a UTF-8 text, each narrowed to whole characters."""
    out = []
    for a, b in ranges:
        while a < b and raw[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def removal(text: bytes, ranges: list[tuple[int, int]], unit: int, characters: bool) -> tuple[list[dict], bytes]:
    """The maximal removed ranges of bytes, and the remaining bytes. Words go with the white space after them."""
    gone = merged(ranges)
    if gone and unit == WORDS:
        at = [*word_starts(text).tolist(), len(text)]
        gone = [(at[a], at[b]) for a, b in gone]
    gone = whole_characters(text, gone) if characters else gone
    edges = [0, *(x for r in gone for x in r), len(text)]
    return [dict(start=a, stop=b) for a, b in gone], b"".join(text[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))


def cleaned(docs: DataFrame, found: dict[str, tuple[int, DataFrame]], n: int, characters: bool = False) -> DataFrame:
    """doc_id, crc, n_bytes of every document and, for each name in `found` (unit, spans), name_removed (ranges
    of bytes) and name_kept (remaining bytes); with `characters`, a character that is removed in part stays."""
    removed = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("crc", pa.int64()), ("n_bytes", pa.int64()), *((c, t) for name in found for c, t in ((f"{name}_removed", removed), (f"{name}_kept", pa.binary())))])
    units = {name: unit for name, (unit, _) in found.items()}

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        of = defaultdict(list)
        for name, d, c, a, b in zip(*(right.column(x).to_pylist() for x in ("name", "doc_id", "crc", "start", "stop"))):
            of[name, d, c].append((a, b))
        out = []
        for blob in left.column("docs").to_pylist():
            for doc_id, text in zip(*words.unpacked(blob)):
                crc = zlib.crc32(text)
                out.append((doc_id, crc, len(text), *(x for name, unit in units.items() for x in removal(text, of.get((name, doc_id, crc), []), unit, characters))))
        table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(schema), schema)], schema=schema)
        del out, left
        common.trim()
        return table

    spans_ = None
    for name, (_, df) in found.items():
        df = df.withColumn("name", F.lit(name))
        spans_ = df if spans_ is None else spans_.unionByName(df)
    ddl = "doc_id bigint, crc bigint, n_bytes bigint, " + ", ".join(f"{name}_removed array<struct<start:bigint,stop:bigint>>, {name}_kept binary" for name in found)
    return words.packed(docs, words.hashed_block(n)).groupby("block").cogroup(spans_.groupby("block")).applyInArrow(cut, ddl)


def deduplicated(docs: DataFrame, units: dict[str, int] = {"byte": BYTES}, length: dict[int, int] = LENGTH, characters: bool = False) -> DataFrame:
    """doc_id, crc, n_bytes and, for each name and unit, name_removed and name_kept: each row of docs (doc_id,
    text) without what is covered by a string of so many units that also starts elsewhere. Texts below the
    length, empty ones among them, stay whole; repeated rows are copies of each other and lose all that
    repeats; other columns are left behind; an empty table gives an empty one."""
    n = words.blocks_for(docs)
    return cleaned(docs, {name: (unit, spans(docs, n, unit, length[unit])) for name, unit in units.items()}, n, characters)


def op4_substrings(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table, by repeats of 400 bytes: doc_id, n_bytes, n_removed, n_spans,
    kept_sha256. A further column, text, is the document without repeated passages of 50 words or more, most of
    which are shorter than 400 bytes: the form that the corpus pipeline hands on."""
    out = deduplicated(common.read_documents(spark, sf_dir), {"byte": BYTES, "word": WORDS})
    lost = F.aggregate("byte_removed", F.lit(0).cast(T.LongType()), lambda s, r: s + r["stop"] - r["start"])
    return out.select("doc_id", "n_bytes", lost.alias("n_removed"), F.size("byte_removed").cast("long").alias("n_spans"), F.sha2("byte_kept", 256).alias("kept_sha256"), F.col("word_kept").cast("string").alias("text"))
