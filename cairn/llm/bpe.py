"""Byte-level BPE: encoding by merge ranks over a global distinct-word shuffle, decoding by the token-byte table.

Texts explode into words with positions, which stay an array in the text's block: a row for each of a corpus's
words would move several times the corpus. Each distinct word is encoded once, its ids are joined back to the
blocks that sent it, and positions put them together. Decoding joins ids to the token-byte table on the map side:
that table is as large as the vocabulary, at most 65,536 entries, and so it is broadcast.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from cairn.llm import common, words

VOCABULARY, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

#: No match of PATTERN goes on over a space that other text follows, so a text may be cut before each.
_CUT = re.compile(r"(?= \S)")
#: A space before white space, before a character that begins like white space, or at the end; or the mark
#: that splits texts without such a space.
_ODD = r" (?:[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}-\x{16bf}\x{2000}-\x{3fff}]|\z)|\x{1}"


def split_one(raw: bytes) -> list[bytes]:
    """The text cut before every space that something other than white space follows."""
    return [w.encode() for w in _CUT.split(raw.decode()) if w]


def split(texts: pa.Array) -> words.Split:
    """Texts as words, each with the space before it. Texts with no odd space are cut at spaces all at once."""
    raw = texts.cast(pa.string())
    odd = pc.match_substring_regex(raw, _ODD)
    if not pc.any(odd).as_py():
        return words.coded(pc.split_pattern(pc.replace_substring(raw, " ", "\x01 "), "\x01"))
    slow = words.by_text(split_one)(texts.filter(odd))
    fast = split(texts.filter(pc.invert(odd)))
    at = odd.to_numpy(zero_copy_only=False)
    sizes = np.zeros(len(at), np.int64)
    sizes[at], sizes[~at] = slow.sizes, fast.sizes
    from_slow, places = np.repeat(at, sizes), np.zeros(sizes.sum(), np.int64)
    places[from_slow], places[~from_slow] = slow.places + len(fast.distinct), fast.places
    return words.Split(fast.distinct + slow.distinct, places, sizes)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: the pair of neighbours with the least rank, leftmost first, is merged until no
    pair has a rank. A heap over a linked list keeps long pieces at n log n."""
    if piece in ranks:
        return [ranks[piece]]
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    get = ranks.get
    if len(parts) < 48:
        while len(parts) > 1:
            pairs = [get(a + b, 1 << 30) for a, b in zip(parts, parts[1:])]
            least = min(pairs)
            if least == 1 << 30:
                break
            i = pairs.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [ranks[p] for p in parts]
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, parts[i] + parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] + parts[i + 1])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, both = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= n or parts[i] + parts[j] != both:
            continue
        parts[i], parts[j], after[i] = both, None, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (r := get(parts[k] + parts[after[k]])) is not None:
                heapq.heappush(heap, (r, k, parts[k] + parts[after[k]]))
    return [ranks[p] for p in parts if p is not None]


def encoder(ranks: dict[bytes, int], pattern: str = PATTERN) -> Callable[[list[bytes]], list[bytes]]:
    """Distinct words to packed ids, each match of the pattern by itself; pieces that words share are kept."""
    find, known = regex.compile(pattern).findall, {}

    def ids(piece: str) -> bytes:
        if piece not in known:
            known[piece] = np.array(merged(piece.encode(), ranks), words.ID).tobytes()
        return known[piece]

    return lambda distinct: [b"".join(map(ids, find(w.decode()))) for w in distinct]


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """The token-byte table: id -> bytes. Its size is that of the vocabulary, so it is broadcast."""
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def encode(docs: DataFrame, path: str = VOCABULARY, each: Callable = lambda ids: (ids,), schema: pa.Schema = pa.schema([("ids", pa.binary())]), ddl: str = "ids binary") -> DataFrame:
    """doc_id, ids: one row a document with its ids, packed; null and empty texts have none, repeated rows
    stay. The ranks, at most 65,536, are broadcast. `each` may turn a document's ids into other columns."""
    ranks = read_ranks(path)
    if max(ranks.values()) >= 1 << 16:
        raise ValueError("ids must fit 16 bits")
    shared, n = docs.sparkSession.sparkContext.broadcast(ranks), words.blocks_for(docs)
    full = pa.schema([("doc_id", pa.int64()), *schema])

    def finish(_, rows) -> pa.Table:
        out = [(d, *each(ids)) for d, _, ids in rows]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(full), full)], schema=full)

    return words.encoded(docs, words.hashed_block(n), n, split, lambda: encoder(shared.value), finish, f"doc_id bigint, {ddl}")


def decoded(ids: bytes, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in np.frombuffer(ids, words.ID).tolist()])


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """encoded with a column `decoded`, the bytes of its ids, by a map-side join with the token-byte table."""
    table = encoded.sparkSession.sparkContext.broadcast(token_bytes(read_ranks(path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        for b in batches:
            out = [decoded(x, t) for x in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*b.schema.names, "decoded"])

    return encoded.mapInArrow(run, T.StructType([*encoded.schema, T.StructField("decoded", T.BinaryType())]))


def round_trip(docs: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 over 32-bit ids, decoded_sha256 over the bytes that the ids decode to."""
    table = docs.sparkSession.sparkContext.broadcast(token_bytes(read_ranks(VOCABULARY)))

    def digests(ids: bytes) -> tuple[int, str, str]:
        wide = np.frombuffer(ids, words.ID).astype("<u4")
        return len(wide), hashlib.sha256(wide.tobytes()).hexdigest(), hashlib.sha256(decoded(ids, table.value)).hexdigest()

    schema = pa.schema([("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
    return encode(docs, each=digests, schema=schema, ddl="n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table: doc_id, n_tokens, ids_sha256, decoded_sha256. A null or empty text has
    no ids; null ids and repeated rows all come back; other columns are left behind."""
    return round_trip(common.read_documents(spark, sf_dir))
