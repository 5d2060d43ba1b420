"""Exact top-k search over binary codes by incremental multi-index hashing.

A code is cut into 16-bit segments, and each segment has an index from value to codes. For a query, the radius of
one segment after the other grows by one; what the probes find is verified by its full Hamming distance. After
segments 0..j were searched to radius r and the rest to r - 1, every code not seen yet differs in at least
r * m + j + 1 bits, so the search ends as soon as the kth distance is below that: ties at the kth distance are all
seen, and the result is exact.

Rows are dealt once, to index blocks of about ``ROWS`` by hash of their id, and every query goes to every block. A task
reads a block's rows, indexes them once and then answers the block's queries as they stream by. Equal codes share one
index entry, so a very common vector costs one probe.

Defined results: rows with a null id, or a null, empty or differently sized vector are neither indexed nor asked;
a row is never its own neighbour; ties go to the smaller id; repeated rows with one id count once; fewer than k
rows give fewer neighbours.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import map_rows, materialise

SEGMENT = 16
ROWS = 131_072  # of an index block, about


def _masks() -> list[np.ndarray]:
    """All 16-bit values, by the number of bits set."""
    every = np.arange(1 << SEGMENT, dtype=np.uint32)
    weight = np.bitwise_count(every)
    return [every[weight == r] for r in range(SEGMENT + 1)]


class MultiIndex:
    """Codes as (n, m) uint16 with their ids; equal codes are kept once with their ids in order."""

    def __init__(self, codes: np.ndarray, ids: np.ndarray):
        ids, first = np.unique(ids, return_index=True)
        codes = codes[first]
        self.codes, where = np.unique(codes, axis=0, return_inverse=True)
        where = where.reshape(-1)
        self.ids = ids[np.argsort(where, kind="stable")]
        self.begin = np.append(0, np.cumsum(np.bincount(where, minlength=len(self.codes))))
        self.m = codes.shape[1]
        self.order = [np.argsort(self.codes[:, j], kind="stable") for j in range(self.m)]
        self.starts = [np.append(0, np.cumsum(np.bincount(self.codes[:, j], minlength=1 << SEGMENT))) for j in range(self.m)]
        self.masks = _masks()

    def search(self, code: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k nearest (distance, id) but ``own``, ties by id."""
        seen = np.zeros(len(self.codes), bool)
        at = np.zeros(self.m * SEGMENT + 1, np.int64)  # ids by distance so far
        found, dist = [], []
        for r in range(SEGMENT + 1):
            for j in range(self.m):
                values = self.masks[r] ^ code[j]
                lo, hi = self.starts[j][values], self.starts[j][values + 1]
                some = hi > lo
                if some.any():
                    lo, n = lo[some], (hi - lo)[some]
                    flat = np.repeat(lo - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
                    new = self.order[j][flat]
                    new = new[~seen[new]]
                    if len(new):
                        seen[new] = True
                        d = np.bitwise_count(self.codes[new] ^ code).sum(axis=1)
                        found.append(new)
                        dist.append(d)
                        np.add.at(at, d, self.begin[new + 1] - self.begin[new])
                # One more than k, as the query itself may be among them.
                if at[: r * self.m + j + 1].sum() >= k + 1 or len(found) and sum(map(len, found)) == len(self.codes):
                    return self._best(np.concatenate(found), np.concatenate(dist), own, k)
        return self._best(np.concatenate(found), np.concatenate(dist), own, k) if found else []

    def _best(self, found: np.ndarray, dist: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        out: list[tuple[int, int]] = []
        for d in np.unique(dist):
            level: list[int] = []
            for c in found[dist == d]:  # k + 1 ids of a code are enough, as they're in order
                level += self.ids[self.begin[c] : min(self.begin[c + 1], self.begin[c] + k + 1)].tolist()
            out += [(int(d), i) for i in sorted(level) if i != own][: k - len(out)]
            if len(out) >= k:
                break
        return out


def sign_codes(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, code): one bit per dimension, set where it is positive, as hexadecimal digits padded to whole segments."""
    bits = F.array_join(F.transform(vector, lambda x: F.when(x > 0, F.lit("1")).otherwise(F.lit("0"))), "")
    rows = vectors.select(F.col(key).cast("long").alias("id"), F.size(vector).alias("n"), bits.alias("bits")).where("id is not null and n > 0")
    wide = F.rpad("bits", F.ceil(F.col("n") / SEGMENT).cast("int") * SEGMENT, F.lit("0"))
    parts = F.transform(F.sequence(F.lit(0), (F.length(wide) / SEGMENT).cast("int") - 1), lambda i: F.lpad(F.conv(F.substr(wide, i * SEGMENT + 1, F.lit(SEGMENT)), 2, 16), 4, "0"))
    return rows.select("id", "n", F.array_join(parts, "").alias("code"))


def _array(codes: list[str]) -> np.ndarray:
    raw = bytes.fromhex("".join(codes))
    return np.frombuffer(raw, ">u2").astype(np.uint16).reshape(len(codes), -1)


def top_k(vectors: DataFrame, every: int = 50, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, neighbour_id, distance for each id divisible by ``every``, against all rows."""
    rows = materialise(sign_codes(vectors, key, vector), "codes")
    sizes = rows.groupBy("n").count().orderBy(F.desc("count"), "n").first()
    rows = rows.where(F.col("n") == F.lit(sizes["n"] if sizes else 0))
    total = sizes["count"] if sizes else 0
    blocks = max(8, math.ceil(total / ROWS))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    index = rows.select("id", "code", block, F.lit(False).alias("asks"))
    queries = rows.where(F.col("id") % every == 0).dropDuplicates(["id"])
    queries = queries.select("id", "code", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"))

    def make():
        at, ids, codes, built = [None], [], [], [None]  # the block that is open; its rows, then their index

        def step(batch: pa.RecordBatch) -> dict:
            out: list = []
            for own, code, block, asks in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if block != at[0]:
                    at[0], built[0] = block, None
                    ids.clear()
                    codes.clear()
                if not asks:
                    ids.append(own)
                    codes.append(code)
                    continue
                if built[0] is None and ids:
                    built[0] = MultiIndex(_array(codes), np.array(ids, np.int64))
                if built[0] is not None:
                    out += [(own, i, d) for d, i in built[0].search(_array([code])[0], own, k)]
            asked, found, dist = zip(*out, strict=True) if out else ((), (), ())
            return {"query_id": asked, "neighbour_id": found, "distance": dist}

        return step

    # Numbers of blocks are partitions, so each block is a task of its own; its rows come before its queries.
    dealt = index.unionByName(queries).repartitionById(blocks, "block").sortWithinPartitions("block", "asks", "id", "code")
    near = map_rows(dealt.select("id", "code", "block", "asks"), "query_id long, neighbour_id long, distance int", make)
    best = W.partitionBy("query_id").orderBy("distance", "neighbour_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "neighbour_id", "distance")
