"""Words of many texts at once, found on the bytes of a batch.

Texts are taken in slabs of bounded size. A text that is longer than a slab is cut between words, so the
memory of a task does not grow with its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text that are looked at together.
SLAB = 4 << 20
#: What a byte is: between words, in a word, or a border that words must not be joined across.
WHITE, WORD, BORDER = 0, 1, 2


def classes(white: bytes = b"", border: bytes = b"", word: bytes | None = None) -> np.ndarray:
    """The class of each byte: those named, and the others as words (or as white, if the words' bytes are named)."""
    table = np.full(256, WORD if word is None else WHITE, np.uint8)
    for which, kind in ((word or b"", WORD), (white, WHITE), (border, BORDER)):
        table[list(which)] = kind
    return table


class Words(NamedTuple):
    """Words in order: each one's row and place in `raw` (bytes, A-Z as small letters), its length, and whether it
    follows its forerunner without a border, within the same text. `again` marks words that were in the slab
    before, where a long text was cut: they stand here only for what follows them."""

    row: np.ndarray
    start: np.ndarray
    size: np.ndarray
    follows: np.ndarray
    again: np.ndarray
    raw: np.ndarray

    def array(self) -> pa.Array:
        """The words as an Arrow array of bytes."""
        edge = np.zeros(len(self.raw) + 1, np.int8)
        edge[self.start] += 1
        edge[self.start + self.size] -= 1
        offsets, data = np.r_[0, np.cumsum(self.size)].astype(np.int64), self.raw[np.cumsum(edge[:-1], dtype=np.int8).view(bool)]
        return pa.Array.from_buffers(pa.large_binary(), len(self.size), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _located(raw: np.ndarray, rows: np.ndarray, ends: np.ndarray, table: np.ndarray) -> Words:
    """Words of the texts that end at `ends` in raw, where the texts' rows are `rows`."""
    raw = raw + ((raw >= 65) & (raw <= 90)) * np.uint8(32)
    kind = table[raw]
    inside = np.r_[False, kind == WORD, False]
    cut = np.zeros(len(raw) + 1, bool)
    cut[ends[:-1]] = True
    begin = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    of = np.searchsorted(ends, begin, "right")
    borders = np.cumsum(kind == BORDER)
    follows = np.r_[False, (of[1:] == of[:-1]) & (borders[begin[1:]] == borders[end[:-1] - 1])] if len(begin) else np.zeros(0, bool)
    return Words(rows[of], begin, end - begin, follows, np.zeros(len(begin), bool), raw)


def slabs(texts: pa.Array, table: np.ndarray, slab: int | None = None, overlap: int = 1) -> Iterator[Words]:
    """The words of all texts (no nulls), about `slab` bytes at a time. Where a long text is cut, the next slab repeats the last
    `overlap` words, so every run of overlap + 1 words ends at some word that is not marked `again`."""
    slab, column = slab or SLAB, texts.cast(pa.large_binary())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + slab, "right")) - 1)
        if offsets[j] - offsets[i] <= slab:
            yield _located(data[offsets[i] : offsets[j]], np.arange(i, j), offsets[i + 1 : j + 1] - offsets[i], table)
        else:
            yield from _long(data[offsets[i] : offsets[j]], i, table, slab, overlap)
        i = j


def _long(raw: np.ndarray, row: int, table: np.ndarray, slab: int, overlap: int) -> Iterator[Words]:
    """The words of one long text, each slab beginning with the last words of the one before."""
    at, repeated, more = 0, 0, slab
    while at < len(raw):
        end = min(len(raw), at + more)
        while end < len(raw) and table[_small(raw[end])] == WORD:
            end += 1
        w = _located(raw[at:end], np.array([row]), np.array([end - at]), table)
        if len(w.start) <= repeated and end < len(raw):
            more *= 2  # nothing but a long gap yet
            continue
        if len(w.start):
            w.again[:repeated] = True
            yield w
        if end == len(raw):
            return
        repeated = min(overlap, len(w.start))
        back = int(w.start[-repeated])
        at, more = at + back, slab + end - at - back


def _small(byte: np.uint8) -> int:
    return int(byte) + 32 * (65 <= byte <= 90)
