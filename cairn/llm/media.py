"""Interleaved document sequences with media columns.

A page's HTML becomes an ordered array of text runs and media references. A reference carries the digest of
its payload, its alternative text and the caption of its figure; payloads live once in a media table keyed
by digest and are resolved by a join, so positions and captions stay aligned whatever is shared.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.llm import common

#: Samples in a row of the stored picture; payloads are padded to a multiple of it.
WIDTH = 64
ITEM = "pos:int,kind:string,text:string,ref:string,alt:string,caption:string"
SEQUENCE = f"doc_id:bigint,sequence:array<struct<{ITEM}>>"
_SKIP, _VOID_MEDIA = {"script", "style", "template", "noscript"}, {"img", "video", "audio", "source"}
_BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "td", "th", "pre", "blockquote", "article", "section", "figure", "br", "title", "nav", "ul", "ol", "table", "tr"}


class _Sequence(HTMLParser):
    """Collects runs of text and media references in the order of the page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.items, self.run, self.hidden, self.caption, self.figure = [], [], 0, None, []

    def flush(self):
        if text := " ".join("".join(self.run).split(" ")).strip():
            self.items.append(dict(kind="text", text=text, ref=None, alt=None, caption=None))
        self.run = []

    def handle_starttag(self, tag, attrs):
        if tag in _SKIP:
            self.hidden += 1
        elif tag == "figcaption":
            self.flush()
            self.caption = []
        elif tag in _VOID_MEDIA:
            a = dict(attrs)
            if a.get("src"):
                self.flush()
                self.items.append(dict(kind="media", text=None, ref=a["src"], alt=a.get("alt"), caption=None))
                self.figure.append(self.items[-1])
        elif tag in _BLOCK:
            self.flush()
            if tag == "figure":
                self.figure = []

    def handle_endtag(self, tag):
        if tag in _SKIP:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "figcaption" and self.caption is not None:
            text, self.caption = " ".join("".join(self.caption).split()), None
            for item in self.figure:
                item["caption"] = text
        elif tag in _BLOCK:
            self.flush()
            if tag == "figure":
                self.figure = []

    def handle_data(self, data):
        if not self.hidden:
            (self.run if self.caption is None else self.caption).append(data)


def sequence_of(html: str | None) -> list[dict]:
    """Ordered items of one page; null and empty pages give none. Unclosed tags end with the page."""
    if not html:
        return []
    p = _Sequence()
    p.feed(html)
    p.close()
    if p.caption is not None:
        p.handle_endtag("figcaption")
    p.flush()
    return [dict(pos=i, **x) for i, x in enumerate(p.items)]


def sequences(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """doc_id (the key) and sequence, an array of (pos, kind, text, ref, alt, caption), one row a page."""
    item = pa.struct([("pos", pa.int32()), ("kind", pa.string()), ("text", pa.string()), ("ref", pa.string()), ("alt", pa.string()), ("caption", pa.string())])
    schema = pa.schema([("doc_id", pa.int64()), ("sequence", pa.list_(item))])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield common.batch_of(schema, b.column(0), [sequence_of(h) for h in b.column(1).to_pylist()])

    return pages.select(F.col(key).cast("long").alias("doc_id"), F.col(html).alias("html")).mapInArrow(parse, SEQUENCE)


def png(payload: bytes) -> bytes:
    """A grey 8-bit picture, WIDTH samples a row, whose samples are the payload: a lossless form."""
    rows = np.frombuffer(payload, np.uint8).reshape(-1, WIDTH)
    lines = np.zeros((len(rows), WIDTH + 1), np.uint8)
    lines[:, 1:] = rows
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, len(rows), 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines.tobytes(), 6)) + chunk(b"IEND", b"")


def samples(stored: bytes) -> np.ndarray:
    """The samples of such a picture, row by row; chunk checksums are verified."""
    at, data, width = 8, [], 0
    while at < len(stored):
        (n,), kind = struct.unpack_from(">I", stored, at), stored[at + 4 : at + 8]
        body = stored[at + 8 : at + 8 + n]
        if zlib.crc32(kind + body) != struct.unpack_from(">I", stored, at + 8 + n)[0]:
            raise ValueError("a stored picture is damaged")
        if kind == b"IHDR":
            width = struct.unpack_from(">I", body)[0]
        elif kind == b"IDAT":
            data.append(body)
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(-1, width + 1)
    return lines[:, 1:].reshape(-1)


def padded(raw: bytes) -> bytes:
    return raw + bytes(-len(raw) % WIDTH or (0 if raw else WIDTH))


def feature(x: np.ndarray) -> str:
    """Rows, mean, deviation, entropy in bits and most frequent sample of a picture."""
    n = np.bincount(x, minlength=256)
    p = n[n > 0] / len(x)
    return f"{len(x) // WIDTH}x{WIDTH};mean={x.mean():.4f};std={x.std():.4f};entropy={-(p * np.log2(p)).sum():.4f};mode={n.argmax()}"


def media_table(docs: DataFrame) -> DataFrame:
    """digest, media: each document's text as a stored picture, once in every task that meets the text."""
    schema = pa.schema([("digest", pa.string()), ("n_bytes", pa.int64()), ("media", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = {}
            for raw in common.texts(b):
                new.setdefault(hashlib.sha256(raw).hexdigest(), raw)
            yield common.batch_of(schema, list(new), [len(x) for x in new.values()], [png(padded(x)) for x in new.values()])

    return docs.select("text").mapInArrow(encode, "digest string, n_bytes bigint, media binary")


def described(media: DataFrame) -> DataFrame:
    """One row a digest with what is computed from the stored bytes as they are read back."""
    schema = pa.schema([("digest", pa.string()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stored, out = b.column("media").to_pylist(), []
            for m in stored:
                x = samples(m)
                payload = x.tobytes()
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(m), hashlib.sha256(m).hexdigest(), feature(x)))
            yield common.batch_of(schema, b.column("digest"), b.column("n_bytes"), *(map(list, zip(*out)) if out else [[]] * 6))

    ddl = "digest string, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return media.mapInArrow(read, ddl).dropDuplicates(["digest"])


def resolve(seqs: DataFrame, media: DataFrame) -> DataFrame:
    """A row for each media reference, in place: doc_id, pos, digest, alt, caption and the media's columns.

    References without a digest, or with one the table lacks, stay with null columns. media holds one row
    a digest; a digest shared by many documents is a skewed key that adaptive execution splits.
    """
    refs = seqs.select("doc_id", F.explode("sequence").alias("i")).where("i.kind = 'media'")
    refs = refs.select("doc_id", F.col("i.pos").alias("pos"), F.regexp_extract("i.ref", "^sha256:([0-9a-f]{64})$", 1).alias("digest"), F.col("i.alt").alias("alt"), F.col("i.caption").alias("caption"))
    return refs.join(media, "digest", "left")


def pages_of(docs: DataFrame) -> DataFrame:
    """Each document as a page: its whole text, then a captioned figure that refers to the text's picture. Equal
    texts give equal pages."""
    escaped = F.replace(F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return docs.select("doc_id", F.concat(F.lit("<article><p>"), escaped, F.lit('</p><figure><img src="sha256:'), digest, F.lit('" alt="text"><figcaption>picture of '), F.substring(digest, 1, 12), F.lit("</figcaption></figure></article>")).alias("html"))


def op9_media(spark, sf_dir: str) -> DataFrame:
    """One row a document of the whole table, repeated rows included; equal texts have equal values in all columns
    but the id. A null or empty text is one row of 64 zero samples. Besides the contract's columns: pos and caption
    of the picture in the document's sequence."""
    docs = common.read_documents(spark, sf_dir)
    media = common.stored(media_table(docs), "media")
    facts = common.stored(described(media), "media-facts")
    seqs = sequences(pages_of(docs), key="doc_id")
    return resolve(seqs, facts).select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "pos", "caption")
