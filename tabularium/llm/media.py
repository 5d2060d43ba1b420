"""Media columns: interleaved document sequences with media resolved by digest.

HTML is parsed into an ordered array of text and media-reference structs; a reference names its payload by digest
and carries its caption. Payloads are kept in a media store (a written table of PNG images, 8-bit samples, one row
of 576 samples per 576 bytes) and joined to references by digest, so a payload is read back and described once per
stored form, and descriptions, not payloads, are shuffled.

Defined results: null html or text is empty; an empty document is one padded block; equal texts share digests and
all values; repeated rows are returned each; a reference without a stored payload resolves to nulls; other columns
are ignored.
"""

from __future__ import annotations

import binascii
import hashlib
import html as markup
import struct
import zlib
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, map_rows, materialise, texts

BLOCK = 576
SHOWN = "position int, kind string, n_chars int, digest string, caption string"  # of a document's parts, its text not repeated
PART = "position int, kind string, text string, src string, digest string, caption string"
_MAGIC = b"\x89PNG\r\n\x1a\n"
_MEDIA = {"img": "src", "video": "src", "audio": "src", "source": "src", "embed": "src"}
_QUIET = {"script", "style", "noscript", "template"}
_BREAKS = {"p", "div", "br", "li", "ul", "ol", "h1", "h2", "h3", "h4", "h5", "h6", "tr", "table", "article", "section", "figure", "blockquote", "nav", "header", "footer", "pre"}


class Sequencer(HTMLParser):
    """Ordered parts of a page: ['text', text] and ['media', src, caption]."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts: list[list[str]] = []
        self.quiet = self.caption = self.kept = 0
        self.open: list[str] = []
        self.figure: list[int] = []
        self.said: list[str] = []

    def _flush(self) -> None:
        text = "".join(self.open)
        self.open = []
        if text if self.kept else text.strip():
            self.parts.append(["text", text if self.kept else " ".join(text.split())])

    def handle_starttag(self, tag, attrs):
        if tag in _QUIET:
            self.quiet += 1
        elif tag == "figcaption":
            self.caption, self.said = self.caption + 1, []
        elif tag in _MEDIA:
            named = dict(attrs)
            self._flush()
            self.parts.append(["media", named.get(_MEDIA[tag]) or "", named.get("alt") or ""])
        elif tag in _BREAKS:
            self._flush()
            if tag == "figure":
                self.figure.append(len(self.parts))
            self.kept += tag == "pre"

    def handle_endtag(self, tag):
        if tag in _QUIET:
            self.quiet = max(0, self.quiet - 1)
        elif tag == "figcaption" and self.caption:
            self.caption -= 1
            text = " ".join("".join(self.said).split())
            for part in self.parts[self.figure[-1] if self.figure else len(self.parts) :]:
                if part[0] == "media":
                    part[2] = text
        elif tag in _BREAKS:
            self._flush()
            if tag == "figure" and self.figure:
                self.figure.pop()
            if tag == "pre":
                self.kept = max(0, self.kept - 1)

    def handle_data(self, data):
        if not self.quiet:
            (self.said if self.caption else self.open).append(data)


def parts_of(html: str) -> list[dict]:
    """The page's parts in order; a src of the form media:sha256:<hex> gives the digest."""
    walk = Sequencer()
    walk.feed(html)
    walk.close()
    walk._flush()
    out = []
    for i, part in enumerate(walk.parts):
        media = part[0] == "media"
        digest = part[1].removeprefix("media:sha256:") if media and part[1].startswith("media:sha256:") else None
        out.append({"position": i, "kind": part[0], "text": None if media else part[1], "src": part[1] if media else None, "digest": digest, "caption": part[2] if media else None})
    return out


def _listed(fields: str) -> str:
    return f"array<struct<{fields.replace(', ', ',').replace(' ', ':')}>>"


def interleave(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """(key, parts): the sequence of each page's html."""
    rows = pages.select(F.col(key).cast("long").alias(key), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    make = lambda: lambda batch: {key: batch.column(0), "parts": [parts_of(h) for h in batch.column(1).to_pylist()]}
    return map_rows(rows, f"{key} long, parts {_listed(PART)}", make)


def resolve(sequences: DataFrame, store: DataFrame, key: str = "page_id") -> DataFrame:
    """Every part of every sequence, with the store's columns (unique digest, ...) beside the media references."""
    rows = materialise(sequences.select(key, F.explode("parts").alias("p")).select(key, "p.*"), "parts")
    refs = rows.where("digest is not null")
    found = lookup(refs, store, "digest", refs.count())
    return found.unionByName(rows.where("digest is null"), allowMissingColumns=True)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", binascii.crc32(kind + data))


def padded(raw: bytes, block: int = BLOCK) -> bytes:
    return raw + b"\xff" * ((-len(raw)) % block or (0 if raw else block))


def encode_png(payload: bytes, width: int = BLOCK) -> bytes:
    """A greyscale image whose samples are the payload's bytes, row by row."""
    rows = np.zeros((len(payload) // width, width + 1), np.uint8)
    rows[:, 1:] = np.frombuffer(payload, np.uint8).reshape(-1, width)
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return _MAGIC + _chunk(b"IHDR", head) + _chunk(b"IDAT", zlib.compress(rows.tobytes(), 4)) + _chunk(b"IEND", b"")


def decode_png(image: bytes) -> bytes:
    """The samples of an image made by ``encode_png``."""
    if image[:8] != _MAGIC:
        raise ValueError("not a PNG image")
    at, data, width = 8, b"", 0
    while at < len(image):
        n, kind = struct.unpack(">I4s", image[at : at + 8])
        body = image[at + 8 : at + 8 + n]
        if binascii.crc32(kind + body) != struct.unpack(">I", image[at + 8 + n : at + 12 + n])[0]:
            raise ValueError("damaged PNG chunk")
        if kind == b"IHDR":
            width = struct.unpack(">I", body[:4])[0]
        elif kind == b"IDAT":
            data += body
        at += 12 + n
    return np.frombuffer(zlib.decompress(data), np.uint8).reshape(-1, width + 1)[:, 1:].tobytes()


def describe(payload: bytes) -> str:
    """Samples' mean, spread, entropy and the share of each eighth of their range."""
    x = np.frombuffer(payload, np.uint8)
    count = np.bincount(x, minlength=256)
    p = count[count > 0] / len(x)
    at = np.arange(256)
    mean = float((count * at).sum()) / len(x)
    spread = (max(float((count * at * at).sum()) / len(x) - mean * mean, 0.0)) ** 0.5
    bins = ",".join(str(int(v)) for v in count.reshape(8, 32).sum(axis=1))
    return f"rows={len(x) // BLOCK};mean={mean:.4f};std={spread:.4f};entropy={-(p * np.log2(p)).sum():.4f};bins={bins}"


def page_of(text: str, digest: str) -> str:
    """A document as an interleaved page: its text, then its payload as a figure with a caption."""
    words = markup.escape(" ".join(text.split(None, 8)[:8]))
    return f'<article><pre>{markup.escape(text)}</pre><figure><img src="media:sha256:{digest}" alt=""><figcaption>{words}</figcaption></figure></article>'


def _stored(docs: DataFrame) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            names = ("doc_id", "n_bytes", "digest", "media", "parts")
            for at in range(0, batch.num_rows, 200):
                out: dict[str, list] = {k: [] for k in names}
                some = batch.slice(at, 200)
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    raw = text.encode("utf-8", "surrogatepass")
                    payload = padded(raw)
                    parts = parts_of(page_of(text, hashlib.sha256(payload).hexdigest()))
                    ref = next(p for p in parts if p["kind"] == "media")
                    shown = [{"position": p["position"], "kind": p["kind"], "n_chars": None if p is ref else len(p["text"]), "digest": p["digest"], "caption": p["caption"]} for p in parts]
                    for k, v in zip(names, (doc, len(raw), ref["digest"], encode_png(payload), shown), strict=True):
                        out[k].append(v)
                yield out

        return step

    return map_rows(docs, f"doc_id long, n_bytes long, digest string, media binary, parts {_listed(SHOWN)}", make)


def _read_back(store: DataFrame) -> DataFrame:
    def make():
        def step(batch: pa.RecordBatch):
            out: dict[str, list] = {k: [] for k in ("digest", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature")}
            for digest, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                payload = decode_png(media)
                row = (digest, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest(), describe(payload))
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
            return out

        return step

    return map_rows(store.select("digest", "media"), "digest string, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string", make)


def document_media(docs: DataFrame) -> DataFrame:
    """Each document's sequence, its payload stored, read back, described, and joined to its reference by digest.

    ``parts`` are the parsed page's parts in order, text by its length, media by digest and caption (the text's first
    eight words, however long they are).
    """
    docs = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    stored = materialise(_stored(docs), "media")
    known = materialise(_read_back(stored).dropDuplicates(["digest"]), "described")
    refs = stored.select("doc_id", "n_bytes", "digest", "parts")
    rows = lookup(refs, known, "digest", refs.count())
    return rows.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", F.size("parts").alias("n_parts"), (F.size("parts") - 1).alias("media_position"), F.element_at("parts", -1)["caption"].alias("caption"), "parts")
