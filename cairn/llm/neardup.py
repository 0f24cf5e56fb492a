"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the hashes of its word shingles; its sketch is the SKETCH least of them. Equal sets are
one vertex. With J the similarity asked, each value of the bottom-k sketch of two linked sets' union is in both
with a probability of J at least, so all but `unshared` of them are (the chance of more is below CHANCE).

1. Inverted lists of retained values give overlaps: lists of up to LIST vertices are expanded into pairs, and
   equal pairs are counted. A pair is dropped when its count and what longer lists could add are too few.
2. The estimate from the bottom-k sketch of the union rejects most pairs, a parity sketch of the whole sets
   (whose distance never exceeds the number of unshared values) most of the rest; full sets decide.
3. A longer list is not expanded. Its vertices are safe, whatever they are linked with, if more than `unshared`
   values of their sketch are in short lists: one of those is then shared. The others, whose sketch is nearly
   all crowded, are the core: members of large groups of copies. Long lists link them to families; blocks of a family
   are compared by parity sketches and full sets in a task each, which returns a spanning forest of the links it
   found, never all pairs. Blocks are dealt anew, and only what is in no large component then meets more than one.
4. Components of all links, by labels that spread along links in rounds.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cairn.llm import common, words

#: Words in a shingle and least similarity in hundredths, as the pipeline uses them.
WORDS, SIMILARITY = 5, 80
#: Values of a sketch, and the probability with which a link may have fewer of them in common than is asked.
SKETCH, CHANCE = 48, 1e-10
#: Vertices of an inverted list that is expanded into pairs, and bytes of sets in a block of a family.
LIST, BLOCK = 32, 16 << 20
#: How often the blocks of a family that has several are dealt anew to find links; and sets listed at once.
DEALS, _SETS = 3, 256
_U = np.uint64
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Bytes hashed at once, longer texts being cut at white space, and bytes of a word before the table repeats.
_CHUNK, _DEPTH = 1 << 20, 64


def _byte_table() -> np.ndarray:
    """A random number for each place in a word and byte there; capitals as small letters, white space 0."""
    table = np.random.default_rng(10).integers(0, 1 << 64, (_DEPTH, 256), _U, endpoint=False)
    table[:, 65:91] = table[:, 97:123]
    table[:, [9, 10, 11, 12, 13, 32]] = 0
    return table.ravel()


_BYTES = _byte_table()
_WORD = _BYTES[:256] != 0


def _located_words(raw: bytes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(offset, bytes, starts of words) of a text's pieces; no word is cut."""
    i = 0
    while i < len(raw):
        j = len(raw)
        if j - i > _CHUNK:
            white = _SPACE.search(raw, i + _CHUNK)
            j = white.start() if white else j
        x = np.frombuffer(raw, np.uint8, j - i, i)
        word = _WORD[x]
        first = word.copy()
        first[1:] &= ~word[:-1]
        starts = np.flatnonzero(first)
        if len(starts):
            yield i, x, starts
        i = j


def word_starts(raw: bytes) -> np.ndarray:
    """Where each word of a text begins."""
    return np.concatenate([np.zeros(0, np.int64), *(starts + i for i, _, starts in _located_words(raw))])


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash of each word, in order: the sum over its bytes of their numbers in the table, each times
    a number that depends on how often the table has been gone through before."""
    out = [np.zeros(0, _U)]
    for _, x, starts in _located_words(raw):
        place = np.arange(len(x)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(x)]))
        value = _BYTES[(place % _DEPTH) * 256 + x]
        if place.max() >= _DEPTH:
            turn = place // _DEPTH
            value *= np.where(turn > 0, _mix(turn.astype(_U) * _U(0x9E3779B97F4A7C15)) | _U(1), _U(1))
        out.append(np.add.reduceat(value, starts))
    return np.concatenate(out)


class Shingler:
    """Texts to sorted arrays of distinct 64-bit shingle hashes."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, raw: bytes) -> np.ndarray:
        h = word_hashes(raw)
        if not len(h):
            return h
        n = max(1, len(h) - self.size + 1)
        x = np.full(n, _U(min(len(h), self.size)))
        for k in range(min(len(h), self.size)):
            x = _mix(x * _U(0x9E3779B97F4A7C15) + h[k : k + n])
        return np.unique(x)


def unshared(similarity: int, k: int = SKETCH) -> int:
    """How many of the union's k least values two linked sets may leave unshared: with fewer than CHANCE, more."""
    j, tail = similarity / 100, 0.0
    for u in range(k, 0, -1):
        tail += math.comb(k, u) * (1 - j) ** u * j ** (k - u)
        if tail > CHANCE:
            return u
    return 0


def parity(x: np.ndarray) -> np.ndarray:
    """The parity sketch of a set, as 64-bit words: each value flips one bit, of two to four bits a value. Two
    sets' sketches, the longer folded onto the shorter, differ in no more bits than the sets in values."""
    bits = max(128, 1 << (2 * max(1, len(x)) - 1).bit_length())
    at = (_mix(x) >> _U(1)) & _U(bits - 1)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").view(_U)


def folded(p: np.ndarray, words_: int) -> np.ndarray:
    """Parity sketches (last axis) folded to fewer words."""
    while p.shape[-1] > words_:
        half = p.shape[-1] // 2
        p = p[..., :half] ^ p[..., half:]
    return p


def differing(n_a, n_b, similarity: int):
    """How many values two linked sets of these sizes may have that the other lacks."""
    return n_a + n_b - 2 * -(-similarity * (n_a + n_b) // (100 + similarity))


def linked(x: np.ndarray, y: np.ndarray, similarity: int) -> bool:
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * shared >= similarity * (len(x) + len(y) - shared)


_PAIR = pa.schema([("a", pa.binary()), ("b", pa.binary())])
_SET = "doc_id bigint, crc bigint, block int, vertex binary, n bigint, sketch binary, parity binary"


def sets(docs: DataFrame, n_blocks: int, size: int) -> DataFrame:
    """For each document the vertex of its set (null if empty), the set's size, its sketch and parity sketch."""
    schema = pa.schema([("doc_id", pa.int64()), ("crc", pa.int64()), ("block", pa.int32()), ("vertex", pa.binary()), ("n", pa.int64()), ("sketch", pa.binary()), ("parity", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(size)
        for b in batches:
            out = []
            for t in common.texts(b):
                x = shingles(t)
                vertex = hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None
                out.append((zlib.crc32(t), vertex, len(x), x[:SKETCH].tobytes(), parity(x).tobytes()))
            crc, vertex, n, sketch, bits = map(list, zip(*out)) if out else [[]] * 5
            yield common.batch_of(schema, b.column("doc_id"), crc, b.column("block"), vertex, n, sketch, bits)
        common.trim()

    return docs.select("doc_id", "text", words.hashed_block(n_blocks).alias("block")).mapInArrow(run, _SET)


def values(vertices: DataFrame, column: str = "sketch") -> DataFrame:
    """(value, vertex, n): the inverted lists' rows, of sketches or of whole sets."""
    schema = pa.schema([("value", pa.int64()), ("vertex", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, _SETS):  # a few sets at a time: whole ones may be long
                part = b.slice(i, _SETS)
                x = [np.frombuffer(f, np.int64) for f in part.column(column).to_pylist()]
                of = pa.array(np.repeat(np.arange(len(x)), [len(v) for v in x]))
                yield common.batch_of(schema, pa.array(np.concatenate(x)), *(part.column(c).take(of) for c in ("vertex", "n")))

    return vertices.select("vertex", "n", column).mapInArrow(run, "value bigint, vertex binary, n bigint")


def _with_both(pairs: DataFrame, table: DataFrame, *columns: str, how: str = "inner") -> DataFrame:
    """pairs (a, b, ...) with the columns of table (vertex, ...) for either side."""
    for side in "ab":
        pairs = pairs.join(table.select(F.col("vertex").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns)), side, how)
    return pairs


def _sizes_fit(similarity: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")


def overlaps(lists: DataFrame, crowded: DataFrame, similarity: int) -> DataFrame:
    """Pairs (a, b) from the short lists that share enough of their sketches there, with what they can share
    in long lists (crowded: vertex, long)."""
    short = lists.where(F.col("k") <= LIST)
    a, b = (short.select("value", *(F.col(c).alias(f"{c}_{s}") for c in ("vertex", "n"))) for s in "ab")
    met = a.join(b, "value").where((F.col("vertex_a") < F.col("vertex_b")) & _sizes_fit(similarity))
    met = met.groupBy(F.col("vertex_a").alias("a"), F.col("vertex_b").alias("b")).agg(F.count("*").alias("m"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b"))
    whole = F.ceil(similarity * (F.col("n_a") + F.col("n_b")) / F.lit(100 + similarity) - F.lit(1e-9))
    needed = F.when(F.greatest("n_a", "n_b") >= SKETCH, F.lit(SKETCH - unshared(similarity))).otherwise(whole)
    most = F.col("m") + F.least(F.coalesce("long_a", F.lit(0)), F.coalesce("long_b", F.lit(0)))
    return _with_both(met, crowded, "long", how="left").where(most >= needed).select("a", "b", "n_a", "n_b")


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity estimated from two bottom-k sketches: the share of the values of their union's
    bottom-k sketch that both have."""
    both = np.union1d(a, b)[:SKETCH]
    return len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True)) / len(both) if len(both) else 0.0


def likely(pairs: DataFrame, sketches: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose union sketch and parity sketches allow a link."""
    schema, least = _PAIR, min(similarity / 100, (SKETCH - unshared(similarity)) / SKETCH) - 1e-9

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = []
            for n, m, x, y, p, q in zip(*(t.column(c).to_pylist() for c in ("n_a", "n_b", "sketch_a", "sketch_b", "parity_a", "parity_b"))):
                if good := estimate(np.frombuffer(x, _U), np.frombuffer(y, _U)) >= least:
                    width = min(len(p), len(q)) // 8
                    good = int(np.bitwise_count(folded(np.frombuffer(p, _U), width) ^ folded(np.frombuffer(q, _U), width)).sum()) <= differing(n, m, similarity)
                ok.append(good)
            mask = pa.array(ok, pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column("a").filter(mask), t.column("b").filter(mask)], schema=schema)
        common.trim()

    return _with_both(pairs, sketches, "sketch", "parity").mapInArrow(run, "a binary, b binary")


def full_sets(packed_docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """vertex, n, whole: the sorted values of each wanted vertex, from one of its documents."""
    schema = pa.schema([("vertex", pa.binary()), ("n", pa.int64()), ("whole", pa.binary())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        want = {(d, c): v for d, c, v in zip(*(right.column(x).to_pylist() for x in ("doc_id", "crc", "vertex")))}
        shingles, out = Shingler(size), []
        for blob in left.column("docs").to_pylist() if want else ():
            for doc_id, text in zip(*words.unpacked(blob)):
                vertex = want.pop((doc_id, zlib.crc32(text)), None) if want else None
                if vertex is not None:
                    x = shingles(text)
                    out.append((vertex, len(x), x.tobytes()))
        table = pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * 3, schema)], schema=schema)
        del out, left
        common.trim()
        return table

    return packed_docs.groupby("block").cogroup(wanted.groupby("block")).applyInArrow(run, "vertex binary, n bigint, whole binary")


def links(pairs: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) whose full sets are as similar as asked."""
    schema = _PAIR

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            ok = pa.array([linked(np.frombuffer(x, _U), np.frombuffer(y, _U), similarity) for x, y in zip(t.column("whole_a").to_pylist(), t.column("whole_b").to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([t.column("a").filter(ok), t.column("b").filter(ok)], schema=schema)
        common.trim()

    return _with_both(pairs.select("a", "b"), full, "whole").select("a", "b", "whole_a", "whole_b").mapInArrow(run, "a binary, b binary")


class Forest:
    """Groups that grow: each place's label, and the links that joined two groups."""

    def __init__(self, label: np.ndarray):
        self.label, self.made = label.copy(), []

    def join(self, i: int, j: int) -> None:
        self.label[self.label == self.label[j]] = self.label[i]
        self.made.append((i, j))


def compare(sets_: list[np.ndarray], left: np.ndarray, right: np.ndarray, similarity: int, label: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A forest of links between sets of which one is `left` and the other `right`, which joins all that such links join.
    Sets of one label (numbers) are joined already."""
    n, found = np.array([len(x) for x in sets_]), Forest(np.arange(len(sets_)) if label is None else label)
    bits = [parity(x) for x in sets_]
    width = np.array([len(p) for p in bits])
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        others = np.flatnonzero((width >= w) & (similarity * n <= 100 * n[rows].max()))
        table = np.stack([folded(bits[k], w) for k in others])
        for i in rows.tolist():
            may = (left[i] & right[others]) | (right[i] & left[others])
            at = np.flatnonzero(may & ((width[others] > w) | (others > i)) & (100 * np.minimum(n[others], n[i]) >= similarity * np.maximum(n[others], n[i])) & (found.label[others] != found.label[i]))
            if not len(at):
                continue
            apart = np.bitwise_count(table[at] ^ folded(bits[i], w)).sum(1, dtype=np.int64)
            ok = apart <= differing(n[others[at]], n[i], similarity)
            near = others[at[ok]][np.argsort(apart[ok], kind="stable")]
            while len(near):
                if linked(sets_[i], sets_[near[0]], similarity):
                    found.join(i, int(near[0]))
                    near = near[found.label[near] != found.label[i]]
                else:
                    near = near[1:]
    return found.made


def _met(groups: DataFrame, keys: list[str], full: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) found in each group (keys, vertex, label, new): between a vertex that is `new` and any other, where
    their labels differ. The sets of a group are in one task."""

    def run(table: pa.Table) -> pa.Table:
        vertex = table.column("vertex").combine_chunks()
        label = table.column("label").combine_chunks().dictionary_encode()
        label = (label.combine_chunks() if isinstance(label, pa.ChunkedArray) else label).indices.to_numpy().astype(np.int64)
        new, every = table.column("new").to_numpy(), np.ones(table.num_rows, bool)
        made = np.array(compare([np.frombuffer(x, _U) for x in table.column("whole").to_pylist()], new, every, similarity, label), np.int64).reshape(-1, 2)
        common.trim()
        return pa.table([vertex.take(pa.array(made[:, 0])), vertex.take(pa.array(made[:, 1]))], schema=_PAIR)

    return groups.join(full.select("vertex", "whole"), "vertex").groupBy(*keys).applyInArrow(run, "a binary, b binary")


def labelled(members: DataFrame, edges: DataFrame) -> DataFrame:
    """members (vertex, ...) with the label of their component by the edges (a, b); without an edge, their own."""
    known = components(edges).select("vertex", F.col("root").alias("label"))
    return members.join(known, "vertex", "left").withColumn("label", F.coalesce("label", "vertex"))


def by_rare_values(members: DataFrame, asking: DataFrame, full: DataFrame, similarity: int) -> tuple[DataFrame, DataFrame]:
    """(links, rest): the links of those of `asking` that are found by rare values, and the vertices for which these do not suffice.

    A value is rare if at most LIST members have it. A set that is linked can lack only so many of another's values; if one
    more of its values than that are rare, any linked set shares one of these. Rows are in proportion to the sets' sizes.
    """
    rows = values(full.join(members.select("vertex"), "vertex", "left_semi"), "whole")
    rare = rows.groupBy("value").agg(F.count("*").alias("k")).where(F.col("k") <= LIST).select("value")
    rows = common.stored(rows.join(rare, "value"), "rare-values")
    lacking = F.floor(F.col("n") * (100 - similarity) / F.lit(similarity) + F.lit(1e-9)).cast("int")
    place = F.row_number().over(Window.partitionBy("vertex").orderBy("value"))
    mine = rows.join(asking.select("vertex"), "vertex", "left_semi").withColumn("place", place).where(F.col("place") <= lacking + 1)
    enough = mine.where(F.col("place") == lacking + 1).select("vertex")
    asked = mine.join(enough, "vertex", "left_semi").select("value", F.col("vertex").alias("a"), F.col("n").alias("n_a"))
    met = asked.join(rows.select("value", F.col("vertex").alias("b"), F.col("n").alias("n_b")), "value").where((F.col("a") != F.col("b")) & _sizes_fit(similarity))
    pairs = common.stored(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "rare-pairs")
    return links(pairs, full, similarity), asking.join(enough, "vertex", "left_anti")


def core_links(core_lists: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """Links (a, b) between vertices of the core (value, vertex rows of long lists), which join all those that
    links join. A family is what long lists connect.

    A family of BLOCK bytes is compared in one task. A larger one is dealt into blocks, and dealt anew a few times: so most
    of what belongs together is joined, at the cost of the family's bytes each time. Within the largest component nothing is
    left to find. What lies outside it meets the family by its rare values; only sets that are made of common values and
    still belong to no large component meet all blocks, as many of them at once as a block holds.
    """
    lead = core_lists.groupBy("value").agg(F.min("vertex").alias("leader"))
    star = core_lists.join(lead, "value").where("vertex <> leader").select(F.col("vertex").alias("a"), F.col("leader").alias("b")).distinct()
    sized = components(star).join(full.select("vertex", (F.col("n") * 8).alias("size")), "vertex")
    parts = sized.groupBy("root").agg(F.ceil(F.sum("size") / F.lit(BLOCK)).cast("int").alias("parts"))
    family = common.stored(sized.join(parts, "root"), "family")
    deal = lambda df, salt: df.withColumn("part", F.pmod(F.xxhash64("vertex", F.lit(salt)), F.col("parts")).cast("int")).withColumn("new", F.lit(True))
    found = common.stored(_met(deal(family.withColumn("label", F.col("vertex")), 0), ["root", "part"], full, similarity), "core-links")
    large = family.where("parts > 1")
    if large.isEmpty():
        return found
    for salt in range(1, DEALS):
        more = _met(deal(labelled(large, found), salt), ["root", "part"], full, similarity)
        found = common.stored(found.unionByName(more), "core-links")
    known = common.stored(labelled(large, found), "core-labels")
    by_label = known.groupBy("root", "label").agg(F.sum("size").alias("size"))
    most = by_label.groupBy("root").agg(F.max_by("label", F.struct("size", "label")).alias("label"))
    outside = common.stored(known.join(most, ["root", "label"], "left_anti"), "core-outside")
    rare, rest = by_rare_values(known, outside, full, similarity)
    found = found.unionByName(common.stored(rare, "core-rare-links"))
    return found.unionByName(_met(meetings(known, common.stored(rest, "core-rest")), ["root", "part", "crowd"], full, similarity))


def meetings(known: DataFrame, rest: DataFrame) -> DataFrame:
    """(root, part, crowd, vertex, label, new): each crowd of the rest, as many as a block holds, with each block of its family."""
    crowds = rest.groupBy("root").agg(F.ceil(F.sum("size") / F.lit(BLOCK)).cast("int").alias("crowds"))
    part = F.pmod(F.xxhash64("vertex", F.lit(0)), F.col("parts")).cast("int")
    crowd = F.pmod(F.xxhash64("vertex", F.lit(DEALS)), F.col("crowds")).cast("int")
    all_ = known.join(crowds, "root").select("root", part.alias("part"), F.explode(F.sequence(F.lit(0), F.col("crowds") - 1)).alias("crowd"), "vertex", "label")
    some = rest.join(crowds, "root").select("root", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), crowd.alias("crowd"), "vertex", "label")
    both = all_.withColumn("new", F.lit(0)).unionByName(some.withColumn("new", F.lit(1)))
    return both.groupBy("root", "part", "crowd", "vertex", "label").agg((F.max("new") == 1).alias("new"))


def components(edges: DataFrame) -> DataFrame:
    """(vertex, root): the least vertex of each component, for every vertex with an edge. Labels spread along
    edges and jump to their label's label; the number of rounds grows with the logarithm of a component's
    width. Each round is written, so none is computed again."""
    both = common.stored(edges.select(F.col("a").alias("vertex"), F.col("b").alias("other")).union(edges.select("b", "a")).distinct(), "edges")
    label = common.stored(both.groupBy("vertex").agg(F.least(F.col("vertex"), F.min("other")).alias("root")), "labels")
    while True:
        heard = both.join(label.select(F.col("vertex").alias("other"), "root"), "other").groupBy("vertex").agg(F.min("root").alias("heard"))
        jump = label.select(F.col("vertex").alias("root"), F.col("root").alias("far"))
        new = label.join(heard, "vertex").join(jump, "root", "left").select("vertex", F.least("root", "heard", "far").alias("root"), F.col("root").alias("old"))
        new = common.stored(new, "labels")
        common.forget(label)
        label = new.select("vertex", "root")
        if not new.where(F.col("root") != F.col("old")).limit(1).count():
            common.forget(both)
            return label


def grouped(docs: DataFrame, size: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """doc_id, crc, n_shingles, component_id, kept for every row of docs (doc_id, text).

    component_id is the least doc_id of the documents that links lead to; a document without words (null, empty
    or blank) is alone. Repeated rows are the same document and all come back. A null id is never the least if
    there is another. Other columns of docs are left behind; an empty table gives an empty one.
    """
    n = words.blocks_for(docs)
    known = common.stored(sets(docs, n, size), "sets")
    one = [F.first(c).alias(c) for c in ("doc_id", "crc", "block", "n", "sketch", "parity")]
    vertices = common.stored(known.where("n > 0").groupBy("vertex").agg(F.min("doc_id").alias("least"), *one), "vertices")
    rows = values(vertices)
    shared = rows.groupBy("value").agg(F.count("*").alias("k")).where("k > 1")
    lists = common.stored(rows.join(shared, "value").select("value", "vertex", "n", "k"), "lists")
    long = lists.where(F.col("k") > LIST)
    crowded = common.stored(long.groupBy("vertex", "n").agg(F.count("*").alias("long")), "crowded")
    pairs = common.stored(overlaps(lists, crowded, similarity), "overlaps")
    near = common.stored(likely(pairs, vertices, similarity), "likely-pairs")
    safe = F.when(F.col("n") >= SKETCH, F.lit(unshared(similarity))).otherwise(F.floor(F.col("n") * (100 - similarity) / F.lit(similarity)))
    core = crowded.where(F.least("n", F.lit(SKETCH)) - F.col("long") <= safe).select("vertex")
    core_lists = common.stored(long.join(core, "vertex", "left_semi").select("value", "vertex"), "core-lists")
    asked = near.select(F.col("a").alias("vertex")).union(near.select("b")).union(core_lists.select("vertex")).distinct()
    wanted = vertices.join(asked, "vertex", "left_semi").select("vertex", "doc_id", "crc", "block")
    full = common.stored(full_sets(words.packed(docs, words.hashed_block(n)), wanted, size), "full-sets")
    edges = common.stored(links(near, full, similarity).unionByName(core_links(core_lists, full, similarity)), "links")
    root = components(edges)
    lowest = root.join(vertices.select("vertex", "least"), "vertex").groupBy("root").agg(F.min("least").alias("component_id"))
    place = common.stored(vertices.select("vertex", "least").join(root.join(lowest, "root").select("vertex", "component_id"), "vertex", "left").select("vertex", F.coalesce("component_id", "least").alias("component_id")), "components")
    common.forget(vertices, lists, crowded, pairs, near, core_lists, full, edges, root)
    out = known.select("doc_id", "crc", "vertex", "n").join(place, "vertex", "left")
    out = out.select("doc_id", "crc", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_neardup(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table: doc_id, n_shingles, component_id, kept, by shingles of three words
    and a similarity of 0.85. Documents without words have no shingles and are linked with nothing."""
    return grouped(common.read_documents(spark, sf_dir), 3, 85).select("doc_id", "n_shingles", "component_id", "kept")
