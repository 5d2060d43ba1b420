"""WARC archives with revisit records and an external index merge.

Payload digests are computed and compared first (a narrow table), so that of equal payloads only the page with the
smallest id is stored and the others refer to it. Every task writes its captures sorted by URL key and timestamp
into archives of gzip members, one per record, and reads them back by their bytes. Each archive's index is a sorted
run. Runs are dealt to ranges of (URL key, timestamp, page id), and in each range the k run slices are merged by a
loser tree, which gives the capture histories in global order (history_part, then history_place).

Archives are rows of a written table (name, content), as executors share no folder but the cluster's.

Defined results: null html is an empty payload; a null url has an empty key; white space in a URL is left out, as a
header can't hold it, and its key is that of the stored form; pages without a timestamp column get
one by id; every row with the group's smallest page_id is a response; a null page_id is a response; repeated rows
are records each; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import datetime
import hashlib
import math
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup, map_rows, materialise

ARCHIVE = 8_000_000  # bytes of records, before compression, that an archive holds about
RANGE = 100_000  # index rows that a merge task gets, about


def stored_url(url: str) -> str:
    """A URL as a header holds it, without white space."""
    return "".join(url.split())


def url_key(url: str) -> str:
    """Of a stored URL: host parts reversed, without scheme, 'www.' and port; path and sorted query in lower case."""
    try:
        parts = urlsplit(url)
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        return url.lower()
    query = "&".join(sorted(parts.query.lower().split("&"))) if parts.query else ""
    return f"{','.join(reversed(host.split('.')))}){(parts.path or '/').lower()}{'?' + query if query else ''}"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str, stamp: str, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record: a response with the payload, or a revisit that names the response's record."""
    revisit = refers_to is not None
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {stamp}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {len(payload)}", "Content-Type: text/html",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if revisit else payload
    return "\r\n".join([*lines, f"Content-Length: {len(body)}", "", ""]).encode("utf-8", "surrogatepass") + body + b"\r\n\r\n"


def members(content: bytes) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, bytes) of each gzip member."""
    at, view = 0, memoryview(content)
    while at < len(content):
        unpack, out, to = zlib.decompressobj(31), [], at
        while not unpack.eof:
            if to >= len(content):
                raise ValueError("truncated archive")
            fed = view[to : to + 16384]
            out.append(unpack.decompress(fed))
            to += len(fed)
        to -= len(unpack.unused_data)
        yield at, to - at, b"".join(out)
        at = to


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    size = int(named["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    return named, rest[:size]


class LoserTree:
    """Merges k sorted iterators: inner nodes keep the loser of each match, so a step costs one path to the root."""

    def __init__(self, runs: list[Iterator]):
        self.runs, self.k = runs, max(1, len(runs))
        self.heads = [next(r, None) for r in runs] or [None]
        self.tree = [-1] * self.k
        for i in range(self.k):
            self._play(i)

    def _before(self, a: int, b: int) -> bool:
        x, y = self.heads[a], self.heads[b]
        return y is None or x is not None and (x, a) <= (y, b)

    def _play(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node:
            if self.tree[node] < 0:
                self.tree[node] = winner
                return
            if self._before(self.tree[node], winner):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner

    def __iter__(self) -> Iterator:
        while (head := self.heads[self.tree[0]]) is not None:
            yield head
            run = self.tree[0]
            self.heads[run] = next(self.runs[run], None)
            self._replay(run)

    def _replay(self, i: int) -> None:
        winner, node = i, (i + self.k) // 2
        while node:
            if self._before(self.tree[node], winner):
                winner, self.tree[node] = self.tree[node], winner
            node //= 2
        self.tree[0] = winner


def _stamped(pages: DataFrame, timestamp: str) -> DataFrame:
    ids = F.col("page_id").cast("long")
    base = int(datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC).timestamp())
    when = F.col(timestamp).cast("timestamp").cast("long") if timestamp in pages.columns else F.lit(base) + F.coalesce(ids, F.lit(0))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return pages.select(ids.alias("page_id"), text("url").alias("url"), text("html").alias("html"), F.coalesce(when, F.lit(base)).alias("seconds"))


def revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """(page_id, refers_to) of the pages whose payload an earlier page has."""
    raw = F.col("html").cast("binary")
    narrow = materialise(pages.where("page_id is not null").select("page_id", F.sha1(raw).alias("digest"), F.octet_length(raw).alias("n")), "payloads")
    narrow = narrow.where(F.col("n") >= least)
    groups = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.max("page_id").alias("last")).where("first <> last").select("digest", "first")
    groups = materialise(groups, "groups")
    found = lookup(narrow.select("page_id", "digest"), groups, "digest", narrow.count())
    return found.where("page_id <> first").select("page_id", F.col("first").alias("refers_to")).distinct()


def write(pages: DataFrame, refers: DataFrame) -> DataFrame:
    """(archive, content): archives of records sorted by URL key, timestamp and id within each."""

    def make():
        held: list = []
        size = [0, 0]
        part = TaskContext.get().partitionId()

        def cut():
            held.sort(key=lambda x: (x[0], x[1], x[2] is not None, x[2] or 0))
            out = []
            for _, _, _, raw in held:
                pack = zlib.compressobj(4, zlib.DEFLATED, 31)
                out.append(pack.compress(raw) + pack.flush())
            yield {"archive": [f"part-{part:05d}-{size[1]:05d}.warc.gz"], "content": [b"".join(out)]}
            held.clear()
            size[0], size[1] = 0, size[1] + 1

        def step(batch: pa.RecordBatch):
            for page, url, html, seconds, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = html.encode("utf-8", "surrogatepass")
                url = stored_url(url)
                stamp = f"{datetime.datetime.fromtimestamp(seconds, datetime.UTC):%Y-%m-%dT%H:%M:%SZ}"
                raw = record(page, url, stamp, payload, sha1_base32(payload), refers_to)
                held.append((url_key(url), stamp, page, raw))
                size[0] += len(raw)
                if size[0] >= ARCHIVE:
                    yield from cut()

        step.last = lambda: cut() if held else ()
        return step

    # By shuffle at every size, as revisits grow with the pages; a null id refers to nothing and isn't shuffled.
    alone = pages.where("page_id is null").withColumn("refers_to", F.lit(None).cast("long"))
    joined = pages.where("page_id is not null").join(refers.hint("merge"), "page_id", "left").unionByName(alone)
    return map_rows(joined.select("page_id", "url", "html", "seconds", "refers_to"), "archive string, content binary", make)


INDEX = "url_key string, stamp string, page_id long, archive string, seq int, offset long, length long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read(archives: DataFrame) -> DataFrame:
    """The index of archives, from their bytes: one row per record; each archive is a run sorted by its seq."""
    names = [x.split()[0] for x in INDEX.split(", ")]
    number = lambda x: int(x.removeprefix("<urn:page:").rstrip(">")) if x and x != "<urn:page:>" else None

    def make():
        def step(batch: pa.RecordBatch):
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                out: dict[str, list] = {k: [] for k in names}
                for seq, (offset, length, raw) in enumerate(members(content)):
                    head, block = parse(raw)
                    kind, named = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
                    if kind == "response" and sha1_base32(block) != named:
                        raise ValueError(f"digest mismatch in {archive} at {offset}")
                    row = (url_key(head["WARC-Target-URI"]), head["WARC-Date"], number(head["WARC-Record-ID"]), archive, seq, offset, length,
                           len(block) if kind == "response" else int(head["X-Payload-Length"]), named, kind, number(head.get("WARC-Refers-To")))
                    for k, v in zip(names, row, strict=True):
                        out[k].append(v)
                yield out

        return step

    return map_rows(archives, INDEX, make)


def merge(index: DataFrame, rows: int) -> DataFrame:
    """Sorted runs to global order: ranges by key, and a loser-tree merge of the run slices in each."""
    names = [x.split()[0] for x in INDEX.split(", ")]

    def make():
        runs: dict[str, list[tuple]] = {}
        part = TaskContext.get().partitionId()

        def step(batch: pa.RecordBatch):
            cols = [c.to_pylist() for c in batch.columns]
            for row in zip(*cols, strict=True):
                runs.setdefault(row[3], []).append(row)
            return ()

        def end():
            key = lambda row: ((row[0], row[1], row[2] is not None, row[2] or 0), row[4], row)
            merged = [x[2] for x in LoserTree([iter([key(r) for r in runs[a]]) for a in sorted(runs)])]
            if merged:
                yield dict(zip(names, map(list, zip(*merged, strict=True)), strict=True)) | {"history_part": [part] * len(merged), "history_place": list(range(len(merged)))}

        step.last = end
        return step

    dealt = index.repartitionByRange(max(1, math.ceil(rows / RANGE)), "url_key", "stamp", "page_id").sortWithinPartitions("archive", "seq")
    return map_rows(dealt, INDEX + ", history_part int, history_place long", make)


def capture_histories(pages: DataFrame, least: int = 0, timestamp: str = "timestamp") -> DataFrame:
    """``pages`` (page_id, url, html) written as archives, read back, and indexed in global order."""
    pages = _stamped(pages, timestamp)
    refers = materialise(revisits(pages, least), "revisits")
    archives = materialise(write(pages, refers), "archives")
    index = materialise(read(archives), "index")
    merged = merge(index, index.count())
    return merged.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url_key", "stamp", "archive", "offset", "length", "history_part", "history_place")


def ranked(histories: DataFrame) -> DataFrame:
    """``histories`` with history_rank, from 0 over all captures, in place of history_part and history_place.

    Parts are ``RANGE`` rows each, so their counts are a table of that much fewer rows.
    """
    rows = materialise(histories, "histories")
    counts = rows.groupBy("history_part").count()
    before = F.sum("count").over(Window.orderBy("history_part").rowsBetween(Window.unboundedPreceding, -1))
    begins = counts.select("history_part", F.coalesce(before, F.lit(0)).alias("_begin"))
    rank = F.col("_begin") + F.col("history_place")
    return rows.join(F.broadcast(begins), "history_part").withColumn("history_rank", rank).drop("history_part", "history_place", "_begin")
