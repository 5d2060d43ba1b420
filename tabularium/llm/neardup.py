"""MinHash near-dedup by chosen-path set similarity join.

A document is the set of its distinct w-word shingles. Equal sets are collapsed to one representative (exact).
Representatives then walk independent recursion trees: a node is a path, and the path itself picks, by hash, which
minwise coordinate its members branch on next: one always and a second one with probability 1/threshold - 1, so that
two sets at the threshold are expected to share one child per level. The number of trees follows from ``recall``, the
chance that a pair at the threshold still shares a node of some tree at the last level. Nodes of at most ``leaf``
members are compared exhaustively on 128 four-bit minhash sketches; larger ones are branched deeper (``DEPTHS``).

Large nodes in which half of the members could, by their sketches, link with the node's first member aren't branched
deeper, as that wouldn't part them: they, and nodes that are still large after the last level, are dense groups. Their
members are first compared with their node's first member and their neighbour. Members that are then still in different
components are joined exactly: shingles
that at most ``RARE`` members have are looked up by an inverted index, which finds every pair that shares one; a pair
that shares none can only overlap in common shingles, so it is bounded by how many of them its members have, and blocks
of members are compared on full sets only where that bound can reach the threshold. Texts that share a page frame and
little else are told apart by their rare shingles, in time that is linear in the group.

Every surviving pair is confirmed on full shingle sets; components are contracted by repeated min-label rounds. Nodes
with over a thousandth of all rows go on without being gathered in a task, and hub ids are split by the
joins. No step collects links on the driver, none emits all pairs of a large group, and the plan is the same
at every size.

Defined results: null text is empty; documents without words have 0 shingles and are alone; repeated rows with one
doc_id are one vertex (each row is returned); a null doc_id is alone, with a null component and kept = true; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import HOT_KEYS, lookup, map_rows, materialise, mix64, texts

COORDS = 128
DEPTHS = (3, 7, 12)  # levels at which nodes are looked at; only large nodes go on to the next
BLOCK = 256  # members of a dense group that are compared at a time with as many others
RARE = 64  # members of a dense group that may have a shingle for it to be looked up by
CELL = 8_000_000  # bytes of shingle sets that are held to confirm a cell's pairs, about
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def trees_for(recall: float, threshold: float, depth: int = DEPTHS[-1]) -> int:
    """Trees in one of which two sets at the threshold share a node ``depth`` levels deep with this probability."""
    share, lost = 1 / threshold - 1, 0.0
    for _ in range(depth):  # the chance that a branching process with these children dies out
        child = 1 - threshold + threshold * lost
        lost = child * (1 - share + share * child)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the w-word shingles; fewer words make one shingle; none make an empty set."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(tokens)
    if not n:
        return np.empty(0, np.uint64)
    each = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, tokens)), np.uint64)
    width = min(words, n)
    m = n - width + 1
    acc = np.full(m, width, np.uint64)
    for j in range(width):
        acc = mix64(acc * _GOLD + each[j : j + m])
    acc.sort()
    return acc[np.append(True, acc[1:] != acc[:-1])]


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    base = mix64(np.arange(1, 2 * COORDS + 1, dtype=np.uint64) * _GOLD)
    odd = (base >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    return odd[:COORDS, None], odd[COORDS:, None]


def signature(members: np.ndarray, mul: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The minimum of 128 hash functions over the set; the last mixing step is a bijection and done on the minima alone."""
    x = (members ^ (members >> np.uint64(32))).astype(np.uint32)
    out = np.full(COORDS, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 1024):
        h = x[None, at : at + 1024] * mul[0]
        h ^= h >> np.uint32(15)
        h *= mul[1]
        np.minimum(out, h.min(axis=1), out=out)
    return out ^ (out >> np.uint32(13))


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """Set sizes, digests and signatures; of a minimum its low 16 bits, which differ where minima do but once in 65,536."""

    def make():
        mul = _multipliers()

        def step(batch: pa.RecordBatch) -> dict:
            ids, size, digest, sig = batch.column(0), [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, words)
                size.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                sig.append(signature(s, mul).astype(np.uint16).tobytes() if len(s) else None)
            return {"doc_id": ids, "n_shingles": size, "digest": digest, "sig": sig}

        return step

    return map_rows(docs, "doc_id long, n_shingles long, digest binary, sig binary", make)


def _branch(paths: np.ndarray, rows: np.ndarray, sig: np.ndarray, levels: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Extend paths by ``levels``; rows index into sig. A path picks its coordinates by its own hash."""
    for _ in range(levels):
        picks = mix64(paths + _GOLD)
        first = (picks & np.uint64(COORDS - 1)).astype(np.int64)
        second = ((picks >> np.uint64(8)) & np.uint64(COORDS - 1)).astype(np.int64)
        more = ((picks >> np.uint64(16)) & np.uint64(0xFFFFFF)).astype(np.float64) < share * 2**24
        more &= first != second

        def child(p, i, r):
            return mix64((p ^ (i.astype(np.uint64) << np.uint64(40))) * _GOLD + sig[r, i].astype(np.uint64))

        paths, rows = np.concatenate([child(paths, first, rows), child(paths[more], second[more], rows[more])]), np.concatenate([rows, rows[more]])
    return paths, rows


def _sketches(sig: np.ndarray) -> np.ndarray:
    low = (sig & np.uint16(15)).astype(np.uint8)
    return low[:, 0::2] | (low[:, 1::2] << np.uint8(4))


def _apart(x: np.ndarray) -> np.ndarray:
    """In how many of the 128 nibbles two sketches differ, from their exclusive or."""
    x |= x >> np.uint64(2)
    x |= x >> np.uint64(1)
    return np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1)


def _nodes(rows: DataFrame, levels: int, trees: int, share: float, columns: str, tell: Callable) -> DataFrame:
    """(doc, sig[, node]) to what ``tell`` makes of docs, signatures, paths ``levels`` deeper and the paths' rows; without a node, from the roots."""
    deeper = "node" in rows.columns

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[dict]:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                doc = part.column(0).to_numpy(zero_copy_only=False)
                sig = np.frombuffer(b"".join(part.column(1).to_pylist()), np.uint16).reshape(-1, COORDS)
                if deeper:
                    paths, at_row = part.column(2).to_numpy(zero_copy_only=False).view(np.uint64), np.arange(len(doc))
                else:
                    roots = mix64(np.arange(1, trees + 1, dtype=np.uint64) * _GOLD)
                    paths, at_row = np.tile(roots, len(doc)), np.repeat(np.arange(len(doc)), trees)
                paths, at_row = _branch(paths, at_row, sig, levels, share)
                yield tell(doc, sig, paths.view(np.int64), at_row)

        return step

    return map_rows(rows.select("doc", "sig", *["node"] * deeper), columns, make)


def _counted(doc: np.ndarray, sig: np.ndarray, node: np.ndarray, at_row: np.ndarray) -> dict:
    return {"node": node, "doc": doc[at_row]}


def _cold(hot: np.ndarray) -> Callable:
    """What _nodes tells of all nodes but ``hot``: node, doc, sketch."""

    def tell(doc: np.ndarray, sig: np.ndarray, node: np.ndarray, at_row: np.ndarray) -> dict:
        cold = ~np.isin(node, hot)
        node, at_row = node[cold], at_row[cold]
        flat = pa.py_buffer(np.ascontiguousarray(_sketches(sig)[at_row]).tobytes())
        offsets = pa.py_buffer((np.arange(len(at_row) + 1, dtype=np.int32) * (COORDS // 2)).tobytes())
        return {"node": node, "doc": doc[at_row], "sketch": pa.Array.from_buffers(pa.binary(), len(at_row), [None, offsets, flat])}

    return tell


def _hot(hot: np.ndarray, firsts: np.ndarray, sigs: np.ndarray) -> Callable:
    """What _nodes tells of the nodes ``hot`` (in order) alone: doc, first, node, and how far the sketch is from their first member's."""

    def tell(doc: np.ndarray, sig: np.ndarray, node: np.ndarray, at_row: np.ndarray) -> dict:
        keep = np.isin(node, hot)
        node, at_row = node[keep], at_row[keep]
        at = np.searchsorted(hot, node)
        return {"doc": doc[at_row], "first": firsts[at], "node": node, "off": _apart(_sketches(sig)[at_row].view(np.uint64) ^ _sketches(sigs)[at].view(np.uint64)).astype(np.int32)}

    return tell


def _leaf_pairs(doc: np.ndarray, sketch: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a small node whose sketches differ in at most ``most`` of the 128 nibbles."""
    a, b = np.triu_indices(len(doc), 1)
    off = _apart(sketch[a] ^ sketch[b])
    good = (off <= most) & (doc[a] != doc[b])
    return doc[a[good]], doc[b[good]], off[good]


def _compare(nodes: DataFrame, leaf: int, most: int) -> DataFrame:
    """Nodes (all rows of one in a row) to pairs (kind 0: a, b, node, off) and members of large nodes (kind 1: a, the node's
    first member b, node, how far their sketches are apart)."""

    def make():
        held: list = [None, [], []]  # node, docs, sketches of the node that is open
        big = [None, None, None]  # the large node that is open: node, first member, its sketch

        def small(out):
            if held[0] is not None and len(held[1]) > 1:
                doc = np.array(held[1], np.int64)
                a, b, off = _leaf_pairs(doc, np.frombuffer(b"".join(held[2]), np.uint64).reshape(len(doc), -1), most)
                out.append((np.zeros(len(a), np.int8), np.minimum(a, b), np.maximum(a, b), np.full(len(a), held[0]), off))
            held[0], held[1], held[2] = None, [], []

        def large(docs, sketches, node, out):
            docs, sketches = np.array(docs, np.int64), np.frombuffer(b"".join(sketches), np.uint64).reshape(len(docs), -1)
            if big[0] != node:
                big[:] = [node, docs[0], sketches[0]]
            out.append((np.ones(len(docs), np.int8), docs, np.full(len(docs), big[1]), np.full(len(docs), node), _apart(sketches ^ big[2])))

        def told(out):
            if out:
                kind, a, b, node, off = map(np.concatenate, zip(*out, strict=True))
                yield {"kind": kind, "a": a, "b": b, "node": node, "off": off.astype(np.int32)}

        def step(batch: pa.RecordBatch):
            out: list = []
            node, doc, sketch = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            edges = [0, *(np.flatnonzero(np.diff(node)) + 1).tolist(), len(node)]
            for lo, hi in zip(edges, edges[1:], strict=False):
                at = int(node[lo])
                if at != held[0]:
                    small(out)
                    held[0] = at
                if big[0] == at or len(held[1]) + hi - lo > leaf:
                    large(held[1] + doc[lo:hi], held[2] + sketch[lo:hi], at, out)
                    held[1], held[2] = [], []
                else:
                    held[1] += doc[lo:hi]
                    held[2] += sketch[lo:hi]
            yield from told(out)

        def end():
            out: list = []
            small(out)
            yield from told(out)

        step.last = end
        return step

    ordered = nodes.repartition("node").sortWithinPartitions("node", "doc")
    return map_rows(ordered, "kind byte, a long, b long, node long, off int", make)


def _first_pairs(dense: DataFrame) -> DataFrame:
    """Pairs of dense nodes' members (node, doc, first, n) with their node's first and with a neighbour, in chunks."""
    chunk = F.xxhash64("node", F.pmod(F.xxhash64("doc"), F.ceil(F.col("n") / 256)))
    rows = dense.withColumn("chunk", chunk).withColumn("next", F.lag("doc").over(W.partitionBy("chunk").orderBy("doc")))
    pairs = rows.select("doc", "chunk", F.explode(F.array("first", "next")).alias("mate")).where("mate <> doc")
    return pairs.select(F.least("doc", "mate").alias("a"), F.greatest("doc", "mate").alias("b"), F.col("chunk").alias("node"), F.lit(0).alias("off"))


def _candidates(signed: DataFrame, reps: DataFrame, threshold: float, trees: int, leaf: int) -> tuple[DataFrame, DataFrame | None]:
    """Distinct pairs (a, b, off, node) that the trees bring together and the sketches don't rule out; (doc, first) of dense nodes."""
    share = 1 / threshold - 1
    agree = threshold + (1 - threshold) / 16
    most = math.ceil(COORDS * (1 - agree) + 4 * math.sqrt(COORDS * agree * (1 - agree)))
    rows = signed.join(reps.select("digest", F.col("rep").alias("doc_id")), ["digest", "doc_id"], "left_semi").select(F.col("doc_id").alias("doc"), "sig")
    rows = materialise(rows, "rows")  # read twice
    found, done, dense = [], 0, None
    expected = reps.count() * trees
    for depth in DEPTHS:
        last = depth == DEPTHS[-1]
        expected *= (1 + share) ** (depth - done)
        walk = (rows, depth - done, trees, share)
        # A node with over a thousandth of all rows isn't gathered in a task: its members go on from where they are.
        sizes = _nodes(*walk, "node long, doc long", _counted).groupBy("node").agg(F.count("*").alias("n"), F.min("doc").alias("first"))
        large = materialise(sizes.where(F.col("n") > max(leaf, expected / HOT_KEYS)), "large")
        # Fewer than HOT_KEYS nodes, however large the table is.
        hot = sorted(rows.select("doc", "sig").join(F.broadcast(large.select(F.col("node").alias("at"), "first")), F.col("doc") == F.col("first")).dropDuplicates(["at"]).select("at", "first", "sig").collect())
        ids, firsts = (np.array([r[c] for r in hot], np.int64) for c in ("at", "first"))
        out = materialise(_compare(_nodes(*walk, "node long, doc long, sketch binary", _cold(ids)), leaf, most), f"nodes{depth}")
        found.append(out.where("kind = 0").select("a", "b", "node", "off"))
        big = out.where("kind = 1").select(F.col("a").alias("doc"), F.col("b").alias("first"), "node", "off")
        if hot:
            sigs = np.frombuffer(b"".join(r["sig"] for r in hot), np.uint16).reshape(-1, COORDS)
            big = big.unionByName(_nodes(*walk, "doc long, first long, node long, off int", _hot(ids, firsts, sigs)))
        big = materialise(big, f"big{depth}")
        if not (count := big.count()):
            break
        # Where half of the members could link with the first one, more levels won't part them.
        close = F.lit(True) if last else 2 * F.count_if(F.col("off") <= most) >= F.count("*")
        shape = materialise(big.groupBy("node").agg(F.count("*").alias("n"), close.alias("dense")), "shape")
        big = materialise(lookup(big.select("doc", "first", "node"), shape, "node", count), f"told{depth}")
        found.append(_first_pairs(big.where("dense")))
        more = big.where("dense").select("doc", "first")
        dense = more if dense is None else dense.unionByName(more)
        deep = big.where("not dense").select("doc", "node")
        if last or not (count := deep.count()):
            break
        sig = signed.where("sig is not null").select(F.col("doc_id").alias("doc"), "sig")
        rows, done, expected = materialise(deep.join(sig, "doc"), f"rows{depth}"), depth, count
    dense = None if dense is None or dense.isEmpty() else dense.distinct()
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.groupBy("a", "b").agg(F.min("off").alias("off"), F.min("node").alias("node")), dense


def _confirmed(docs: DataFrame, pairs: DataFrame, words: int, threshold: float, mean: float) -> DataFrame:
    """Links (v, r), r < v, that span every component of confirmed pairs within a cell; ``mean`` shingles a set.

    ``docs`` has texts, or x, the shingles themselves; ``pairs`` is a written table.
    """
    cells = max(1, pairs.count() // max(1, min(500, int(CELL / (16 * max(mean, 1))))))
    pairs = pairs.withColumn("cell", F.pmod("node", F.lit(cells)))
    of = materialise(pairs.select(F.col("cell").alias("at"), F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "of")
    # By shuffle at every size: the list of ids grows with the input.
    sets = docs.join(of.hint("merge"), "doc_id").select("at", "doc_id", "x" if "x" in docs.columns else "text")
    per_cent = round(100 * threshold)

    def confirm(pair: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        have: dict[int, list[np.ndarray]] = {}
        sets = held["x"] if "x" in held else (shingle_set(t, words).view(np.int64) for t in held["text"])
        for doc, s in zip(held["doc_id"].tolist(), sets, strict=True):
            have.setdefault(doc, []).append(s)
        top: dict[int, int] = {}

        def root(v: int) -> int:
            while (up := top.get(v, v)) != v:
                top[v] = top.get(up, up)
                v = up
            return v

        pair = pair.sort_values(["off", "a", "b"], kind="stable")
        for a, b in zip(pair["a"].tolist(), pair["b"].tolist(), strict=True):
            x, y = root(a), root(b)
            if x == y:
                continue
            for s in have.get(a, []):
                for t in have.get(b, []):
                    if min(len(s), len(t)) * 100 < per_cent * max(len(s), len(t)) or not len(s):
                        continue
                    both = np.concatenate([s, t])
                    both.sort(kind="stable")
                    shared = int((both[1:] == both[:-1]).sum())
                    if 100 * shared >= per_cent * (len(both) - shared):
                        top[max(x, y)] = min(x, y)
        links = [(v, root(v)) for v in list(top)]
        return pd.DataFrame([x for x in links if x[0] != x[1]], columns=["v", "r"], dtype="int64")

    return pairs.groupBy("cell").cogroup(sets.groupBy("at")).applyInPandas(confirm, "v long, r long")


def _blocks(members: DataFrame) -> DataFrame:
    """``members`` (group, root, rid, ...) with block: a group's members in order of root, at most ``BLOCK`` in each."""

    def make():
        part, last = TaskContext.get().partitionId(), [None, 0]  # group, rows of it so far

        def step(batch: pa.RecordBatch) -> dict:
            nth = []
            for group in batch.column(0).to_pylist():
                last[:] = [group, last[1] + 1 if group == last[0] else 0]
                nth.append(last[1])
            return {"group": batch.column(0), "root": batch.column(1), "rid": batch.column(2), "s": batch.column(3), "part": [part] * len(nth), "nth": nth}

        return step

    ordered = members.select("group", "root", "rid", "s").repartitionByRange("group", "root", "rid").sortWithinPartitions("group", "root", "rid")
    dealt = materialise(map_rows(ordered, "group long, root long, rid long, s long, part int, nth long", make), "dealt")
    # Ranges are in order, so a row's place in its group is that in its range after the counts of the ranges before.
    before = F.coalesce(F.sum("n").over(W.partitionBy("group").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = dealt.groupBy("group", "part").agg(F.count("*").alias("n")).select("group", "part", before.alias("before"))
    block = F.xxhash64("group", F.floor((F.col("before") + F.col("nth")) / BLOCK))
    return materialise(dealt.join(counts, ["group", "part"]).select("group", "root", "rid", "s", block.alias("block")), "blocks")


def _dense_sets(docs: DataFrame, dense: DataFrame, roots: DataFrame, words: int) -> DataFrame:
    """(group, root, doc_id, rid, n, x): a row per set in groups that are not one component yet; x are its shingles."""
    group = components(dense.where("doc <> first").select(F.col("doc").alias("v"), F.col("first").alias("r")))
    ids = dense.select(F.col("doc").alias("v")).distinct()
    ids = ids.join(group.select("v", F.col("root").alias("group")), "v", "left").join(roots, "v", "left")
    members = materialise(ids.select(F.coalesce("group", "v").alias("group"), F.coalesce("root", "v").alias("root"), F.col("v").alias("doc_id")), "members")
    mixed = members.groupBy("group").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("group", F.lit(True).alias("mixed"))
    members = lookup(members, materialise(mixed, "mixed"), "group", members.count()).where("mixed")
    held = docs.join(members.hint("merge"), "doc_id").select("group", "root", "doc_id", "text")

    def make():
        part, seen = TaskContext.get().partitionId() << 40, [0]

        def step(batch: pa.RecordBatch) -> dict:
            sets = [shingle_set(t, words).view(np.int64) for t in batch.column(3).to_pylist()]
            seen[0] += len(sets)
            offsets = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
            return {
                "group": batch.column(0), "root": batch.column(1), "doc_id": batch.column(2), "rid": part + seen[0] + np.arange(-len(sets), 0),
                "n": np.diff(offsets), "x": pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets))),
            }

        return step

    return materialise(map_rows(held, "group long, root long, doc_id long, rid long, n long, x array<long>", make), "dense")


def _dense_links(docs: DataFrame, dense: DataFrame, roots: DataFrame, words: int, threshold: float) -> DataFrame:
    """Links (v, r), r < v, that join the components of each dense group's similar members; exact."""
    whole = sets = _dense_sets(docs, dense, roots, words)
    per_cent = round(100 * threshold)
    size = sets.agg(F.sum("n").alias("n"), F.count("*").alias("k")).first()
    if not size["k"]:
        return roots.select("v", F.col("root").alias("r")).where("false")
    # A group's shingle is told by one hash; two that clash count as one, which can only add candidates.
    each = sets.select("rid", "root", F.explode("x").alias("x"), "group").select("rid", "root", F.xxhash64("group", "x").alias("x"))
    times = materialise(each.groupBy("x").agg(F.count("*").alias("times")).where("times > 1"), "times")
    found = materialise(lookup(each, times, "x", size["n"]).where("times is not null"), "shared")
    common = found.where(F.col("times") > RARE).groupBy("rid").agg(F.count("*").alias("k"))
    sets = sets.join(common, "rid", "left").withColumn("k", F.coalesce("k", F.lit(0)))
    # An overlap o is enough if o * (100 + per_cent) >= per_cent * (n1 + n2).
    info = materialise(sets.select("group", "root", "doc_id", "rid", "n", "k", ((100 + per_cent) * F.col("k") - 2 * per_cent * F.col("n")).alias("s")), "info")

    # Pairs that share a rare shingle: what they share of them, with all that their common ones could add.
    lists = found.where(F.col("times") <= RARE).groupBy("x").agg(F.array_sort(F.collect_list(F.struct("rid", "root"))).alias("at"))
    mates = F.expr("flatten(transform(at, p -> transform(filter(at, q -> q.rid > p.rid and q.root <> p.root), q -> struct(p.rid as a, q.rid as b))))")
    pairs = lists.select(F.explode(mates).alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("m"))
    side = lambda c: info.select(F.col("rid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("doc_id", "n", "k")])
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(f"{100 + per_cent} * (m + least(k_a, k_b)) >= {per_cent} * (n_a + n_b)")
    pairs = pairs.select(F.least("doc_id_a", "doc_id_b").alias("a"), F.greatest("doc_id_a", "doc_id_b").alias("b"), F.lit(0).alias("off"), F.xxhash64("doc_id_a").alias("node")).where("a <> b")
    links = _confirmed(whole.select("doc_id", "x"), materialise(pairs, "pairs"), words, threshold, size["n"] / size["k"])

    # Pairs that share none overlap in min(k1, k2) <= (k1 + k2) / 2 shingles at most, so s1 + s2 >= 0 is needed.
    best = info.groupBy("group").agg(F.max("s").alias("best"))
    able = lookup(info, best, "group", size["k"]).where("s + best >= 0")
    members = _blocks(able)
    blocks = members.groupBy("group", "block").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("s").alias("s"))
    left, right = (blocks.select("group", *[F.col(c).alias(f"{c}{i}") for c in ("block", "lo", "hi", "s")]) for i in "12")
    left = left.withColumn("salt", F.pmod("block1", F.lit(64)))
    right = right.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    cells = left.join(right, ["group", "salt"]).where("block1 <= block2 and least(lo1, lo2) < greatest(hi1, hi2) and s1 + s2 >= 0").select("block1", "block2")
    cells = materialise(cells, "cells")
    at = cells.select("block1", "block2", F.explode(F.array_distinct(F.array("block1", "block2"))).alias("block"))
    tasks = max(1, min(4096, cells.count()))
    held = members.select("rid", "block").join(sets.select("rid", "root", "x"), "rid").join(at, "block").select("block1", "block2", "block", "root", "x").repartition(tasks, "block1", "block2")

    def compare(held: pd.DataFrame) -> pd.DataFrame:
        root, block = held["root"].to_numpy(), held["block"].to_numpy()
        parts = held["x"].tolist()
        size = np.array([len(s) for s in parts])
        owner, (_, col, times) = np.repeat(np.arange(len(parts)), size), np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        more = times > 1  # shingles of one member alone are in no intersection
        owner, col, wide = owner[more[col]], (np.cumsum(more) - 1)[col[more[col]]], int(more.sum())
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        shared = np.zeros((len(parts), len(parts)), np.float32)
        for lo in range(0, wide, 4096):
            some = slice(*np.searchsorted(col, [lo, lo + 4096]))
            has = np.zeros((len(parts), min(4096, wide - lo)), np.float32)
            has[owner[some], col[some] - lo] = 1
            shared += has @ has.T
        shared = shared.astype(np.int64)
        good = (shared > 0) & (100 * shared >= per_cent * (size[:, None] + size[None, :] - shared)) & (root[:, None] > root[None, :])
        if held["block1"].iat[0] != held["block2"].iat[0]:
            good &= block[:, None] != block[None, :]
        v, r = np.nonzero(good)
        return pd.DataFrame(np.unique(np.stack([root[v], root[r]], axis=1), axis=0), columns=["v", "r"], dtype="int64")

    return links.unionByName(held.groupBy("block1", "block2").applyInPandas(compare, "v long, r long"))


def components(links: DataFrame) -> DataFrame:
    """(v, r) links with r < v to (v, root) for every v that isn't its component's smallest id.

    Each round keeps, for each v, its smallest neighbour and that neighbour's own, and links the others to it.
    The number of rounds follows the logarithm of a component's depth; states are written tables. Both joins are sort
    merge joins whose results are written as they come, so that a hub id's rows are split over tasks (AQE). Equal links
    are left in: a round makes at most as many links as it is given.
    """
    links = materialise(links, "links")
    while True:
        low = materialise(links.groupBy("v").agg(F.min("r").alias("m"), F.max("r").alias("x")), "low")
        up = low.select(F.col("v").alias("m"), F.col("m").alias("above"))
        star = low.join(up.hint("merge"), "m", "left").select("v", F.coalesce("above", "m").alias("r"), (F.col("above").isNotNull() | (F.col("x") != F.col("m"))).alias("moved"))
        star = materialise(star, "star")
        if star.where("moved").isEmpty():
            return star.select("v", F.col("r").alias("root"))
        rest = links.join(low.select("v", "m").hint("merge"), "v").where("r <> m").select(F.greatest("r", "m").alias("v"), F.least("r", "m").alias("r"))
        links = materialise(star.select("v", "r").unionByName(rest), "links")


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8, recall: float = 0.99, leaf: int = 48) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text)."""
    docs = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    signed = materialise(_signed(docs, words), "signed")
    whole = signed.where("sig is not null and doc_id is not null")
    reps = materialise(whole.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n"), F.max("doc_id").alias("far")), "reps")
    # Rows that share a doc_id but not a set are one vertex.
    same = whole.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi")
    twice = same.select("doc_id").join(whole.select("doc_id", "digest"), "doc_id").join(reps.select("digest", "rep"), "digest").where("rep <> doc_id")
    pairs, dense = _candidates(whole, reps, threshold, trees_for(recall, threshold), leaf)
    # Whole texts are moved once: to the ids that are in a pair or a dense group, which come from two written tables.
    pairs = materialise(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))
    ids = materialise((ids if dense is None else ids.unionByName(dense.select(F.col("doc").alias("doc_id")))).distinct(), "ids")
    docs = materialise(docs.where("doc_id is not null").join(ids.hint("merge"), "doc_id", "left_semi"), "texts")
    links = _confirmed(docs, pairs, words, threshold, whole.agg(F.avg("n_shingles").alias("n")).first()["n"] or 0)
    links = links.unionByName(twice.select(F.col("doc_id").alias("v"), F.col("rep").alias("r")))
    roots = components(links)
    if dense is not None:
        more = _dense_links(docs, dense, roots, words, threshold)
        roots = components(roots.select("v", F.col("root").alias("r")).unionByName(more))
    known = reps.select("digest", F.col("rep").alias("v")).join(roots, "v", "left").select("digest", F.coalesce("root", "v").alias("component_id"))
    known = materialise(known, "known")
    rows = whole.select("doc_id", "n_shingles", "digest")
    placed = lookup(rows, known, "digest", rows.count()).select("doc_id", "n_shingles", "component_id")
    alone = signed.where("sig is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, words: int = 5, threshold: float = 0.8) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates; all columns stay.

    Rows with one doc_id leave the one whose columns, as JSON, come first; rows with a null doc_id stay.
    """
    drop = materialise(near_duplicates(docs, words, threshold).where("not kept").select(F.col("doc_id").alias("_drop")).distinct(), "drop")
    ids = F.col("doc_id").cast("long")
    known = docs.where(ids.isNotNull())
    left = known.join(drop.hint("merge"), ids == F.col("_drop"), "left_anti").unionByName(docs.where(ids.isNull()))
    again = materialise(known.groupBy(ids.alias("_again")).count().where("count > 1").select("_again"), "again")
    if again.isEmpty():
        return left
    once = left.join(again, ids == F.col("_again"), "left_anti")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    first = left.join(again, ids == F.col("_again"), "left_semi").groupBy(ids.alias("_id")).agg(F.min_by(row, F.to_json(row)).alias("_row"))
    return once.unionByName(first.select("_row.*"))
