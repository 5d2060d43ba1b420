"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Only piece *lengths* matter to the packing, and there are at most ``size`` of them, so the plan is made on the
driver from the histogram of lengths (at most ``size`` rows, however many documents there are): a bin is filled
greedily, longest piece first; then its smallest piece gives way to two unpacked ones if they fill the widened gap
more tightly. Each pattern is repeated as often as its lengths last, so every pattern uses up at least one length.
Pieces then find their place by (length, rank among equal lengths); ranks come from per-task counters and offsets.

Defined results: null or empty text is the end id alone; repeated rows are packed once each; a null doc_id is kept;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_rows, materialise, texts, worker_keeps

END = 1
CACHE = 96_000_000  # bytes of chunks kept per Python worker, about, in two generations: this bounds memory only
_EACH = 200  # bytes that an entry of a dict takes besides its texts
_MARKS = b".,;:!?&$%#*|"


def _byte_letters() -> dict[int, int]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the rest from 256 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: b if b in shown else 256 + sum(x not in shown for x in range(b)) for b in range(256)}


_BYTE_LETTERS = _byte_letters()


class ChunkEncoder:
    """Token ids of whole texts, exactly as the tokenizer gives them, by way of a cache of white-space-free chunks.

    No token of this vocabulary spans white space and its normaliser works within chunks, so a text's ids are its
    chunks' ids in order.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}  # the generation before: what is met again moves on, the rest goes with it
        self.tails: dict[bytes, bytes] = {}
        self.held = 0  # bytes in known

    def _plain(self, chunk: str) -> list[int] | None:
        """Ids of a run of letters that normalising leaves as it is, by the model alone; None for anything else."""
        if not chunk.isalpha() or not chunk.isascii() and (chunk != chunk.lower() or not unicodedata.is_normalized("NFC", chunk)):
            return None
        spelt = chunk if chunk.isascii() else chunk.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return [t.id for t in self.tok.model.tokenize(spelt)]

    def _learn(self, new: list[bytes]) -> None:
        if self.held > CACHE // 2:
            self.older, self.known, self.held = self.known, {}, 0
        rest = []
        known, older, before = self.known, self.older, len(self.known)
        for raw in new:
            if (ids := older.get(raw)) is not None:
                known[raw] = ids
                continue
            word = raw.rstrip(_MARKS)  # a run of marks after a letter is a token of its own
            tail = raw[len(word) :]
            if tail and (not word or word[-1] > 127):
                rest.append(raw)
                continue
            ids = known.get(word)
            if ids is None and (ids := older.get(word)) is not None:
                known[word] = ids
            if ids is None:
                if (made := self._plain(word.decode("utf-8", "surrogatepass"))) is None:
                    rest.append(raw)
                    continue
                ids = known[word] = array("I", made).tobytes()
            if tail:
                if tail not in self.tails:
                    self.tails[tail] = array("I", self.tok.encode(tail.decode(), add_special_tokens=False).ids).tobytes()
                known[raw] = ids + self.tails[tail]
        for at in range(0, len(rest), 500):
            part = rest[at : at + 500]
            for raw, got in zip(part, self.tok.encode_batch([x.decode("utf-8", "surrogatepass") for x in part], add_special_tokens=False), strict=True):
                known[raw] = array("I", got.ids).tobytes()
        self.held += _EACH * (len(known) - before) + sum(len(raw) + len(known[raw]) for raw in new)

    def __call__(self, texts: list[str]) -> list[bytes]:
        split = []
        for text in texts:
            raw = text.encode("utf-8", "surrogatepass")
            split.append((raw if b"<|" in raw else raw.lower()).split())
        found = [list(map(self.known.get, chunks)) for chunks in split]
        new = {w for chunks, parts in zip(split, found, strict=True) if None in parts for w, part in zip(chunks, parts, strict=True) if part is None}
        if new:
            self._learn(list(new))
            for chunks, parts in zip(split, found, strict=True):
                if None in parts:
                    parts[:] = [self.known[w] if part is None else part for w, part in zip(chunks, parts, strict=True)]
        return [b"".join(parts) for parts in found]


def shared_encoder(path: str) -> ChunkEncoder:
    """One encoder, with its cache, for the packing tasks that a Python worker runs one after the other."""
    return worker_keeps(f"encoder {path}", lambda: ChunkEncoder(path))


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, pieces per sequence, first sequence, offset) that place every piece of the histogram.

    A pattern has at most some 90 distinct lengths and leaves one of them too scarce for another copy, so the runs
    are bounded by ``size``, not by the documents.
    """
    left = [0] * (size + 1)
    mask = 0
    for length, n in counts.items():
        left[length] = n
        mask |= (n > 0) << length
    rank, runs, sequence = [0] * (size + 1), [], 0

    def take(length: int) -> None:
        nonlocal mask
        left[length] -= 1
        if not left[length]:
            mask ^= 1 << length

    def give(length: int) -> None:
        nonlocal mask
        left[length] += 1
        mask |= 1 << length

    def longest(room: int) -> int:
        return max((mask & ((1 << (room + 1)) - 1)).bit_length() - 1, 0) if room > 0 else 0

    while mask:
        bin_, gap = [], size
        while length := longest(gap):
            take(length)
            bin_.append(length)
            gap -= length
        smallest = bin_[-1]
        room = gap + smallest
        best = (smallest, 0, 0)
        if gap and len(bin_) > 1:
            x = longest(room - 1)
            while x and 2 * x > best[0]:
                take(x)
                y = longest(min(x, room - x))
                give(x)
                if y and x + y > best[0]:
                    best = (x + y, x, y)
                    if x + y == room:
                        break
                x = longest(x - 1)
        if best[1]:
            give(smallest)
            bin_.pop()
            for length in best[1:]:
                take(length)
                bin_.append(length)
        use: dict[int, int] = {}
        for length in bin_:
            use[length] = use.get(length, 0) + 1
        copies = 1 + min(left[length] // n for length, n in use.items())
        for length, n in use.items():
            left[length] -= n * (copies - 1)
            if not left[length]:
                mask &= ~(1 << length)
        offset = 0
        for length, n in use.items():
            runs.append((length, rank[length], n, sequence, offset))
            rank[length] += copies * n
            offset += length * n
        sequence += copies
    return runs


def pieces_of(docs: DataFrame, path: str, size: int) -> DataFrame:
    """A row per piece: doc_id, piece, start, length, ids_crc32, and its task's number and rank within the task."""

    def make():
        encode, seen = shared_encoder(path), np.zeros(size + 1, np.int64)
        part, end = TaskContext.get().partitionId(), np.array([END], "<u4").tobytes()

        def step(batch: pa.RecordBatch):
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "local")}
                for doc, raw in zip(some.column(0).to_pylist(), encode(some.column(1).to_pylist()), strict=True):
                    raw += end
                    for k, start in enumerate(range(0, len(raw), 4 * size)):
                        ids = raw[start : start + 4 * size]
                        n = len(ids) // 4
                        for name, v in zip(out, (doc, k, start // 4, n, zlib.crc32(ids), int(seen[n])), strict=True):
                            out[name].append(v)
                        seen[n] += 1
                yield out | {"part": [part] * len(out["doc_id"])}

        return step

    return map_rows(docs, "doc_id long, piece int, start long, length long, ids_crc32 long, local long, part int", make, f"encoder {path}")


def pack(docs: DataFrame, tokenizer_path: str, size: int = 4096) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece of ``docs`` (doc_id, text)."""
    docs = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    pieces = materialise(pieces_of(docs, tokenizer_path, size), "pieces")
    per_task = materialise(pieces.groupBy("part", "length").count(), "lengths")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = sorted(best_two_fit(counts, size))
    table = np.array(runs, np.int64).reshape(-1, 5)
    before = F.sum("count").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    ranked = pieces.join(per_task.withColumn("before", F.coalesce(before, F.lit(0))), ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("local") + F.col("before")).alias("rank"))

    def make():
        keys = (table[:, 0] << 44) | table[:, 1]

        def step(batch: pa.RecordBatch) -> dict:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            run = np.searchsorted(keys, (length << 44) | rank, side="right") - 1
            out = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            nth = rank - table[run, 1]
            return out | {"sequence_id": table[run, 3] + nth // table[run, 2], "offset": table[run, 4] + nth % table[run, 2] * length}

        return step

    return map_rows(ranked, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long", make)
