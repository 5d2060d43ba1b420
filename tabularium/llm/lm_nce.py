"""LM scoring with a log-bilinear model trained by noise-contrastive estimation in numpy.

Counts of all training tokens are gathered over the whole corpus. The model predicts a token's *symbol* from the
symbols of the four tokens before it: the ``HEAD`` most frequent words (and the end) are symbols of their own, all
other words share one of ``SPELT`` symbols by their last three bytes; within such a symbol a word has the add-one
share of its count. p(word | context) = p(symbol | context) * p(word | symbol), normalised exactly over all symbols
by batched matrix products.

Training: texts, as symbols, are dealt to shares of about ``SHARE`` tokens by hash of id, symbols and copy number (equal
rows are counted before they are shuffled). A share is one epoch of minibatch NCE over all its tokens in a fixed order
from the same start (unigram bias, so it starts at the unigram level), and parameters are averaged, weighted by tokens,
by a Spark aggregation. So scores depend on the rows alone, not on how they are dealt to tasks, but for the rounding of sums.
Counts of the ``LEXICON`` most frequent words (a fixed bound) travel with the scoring tasks; all others are looked
up by a shuffled join, per document, so nothing that grows with the corpus is broadcast.

Defined results: null text is empty and scores its end alone; with no training rows every base probability is 1;
repeated rows are scored each; a null doc_id folds as the empty text; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, map_rows, materialise, texts

HEAD, SPELT, LEXICON = 160, 224, 200_000
CONTEXT, DIM, NOISE, BATCH = 4, 24, 48, 1024
SHARE = 4_000_000  # tokens that one model is trained on before models are averaged, about
COPIES = 4096  # copies of a row that are told apart at a time
SCORED = 512  # tokens scored at a time: their logits stay in the cache
FLUSH = 300_000  # distinct words a task holds before it hands on partial counts
SYMBOLS = HEAD + SPELT + 1  # the last is the padding before a text; it is never predicted


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def spelt(word: bytes) -> int:
    return HEAD + zlib.crc32(word[-3:]) % SPELT


def count_tokens(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts; the end of a text is the empty word."""

    def make():
        counts: Counter = Counter()

        def told():
            yield {"word": list(counts), "c": list(counts.values())}
            counts.clear()

        def step(batch: pa.RecordBatch):
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
                counts[b""] += 1
                if len(counts) > FLUSH:
                    yield from told()

        step.last = lambda: told() if counts else ()
        return step

    return map_rows(docs.select("text"), "word binary, c long", make).groupBy("word").agg(F.sum("c").alias("c"))


class Lexicon:
    """Frequent words' symbols and counts, and each symbol's totals, as arrays."""

    def __init__(self, head: list[tuple[bytes, int]], totals: dict[int, tuple[int, int]], n: int, v: int):
        self.n, self.v = n, v
        head = sorted(head, key=lambda x: (x[0] != b"", -x[1], x[0]))
        self.words = [w for w, _ in head]
        self.counts = np.array([c for _, c in head], np.int64)
        self.own = min(HEAD, len(head))
        self.symbol = np.array([i if i < self.own else spelt(w) for i, w in enumerate(self.words)], np.int64)
        self.spelt_n, self.spelt_v = np.zeros(SPELT, np.int64), np.zeros(SPELT, np.int64)
        for s, (c, k) in totals.items():
            self.spelt_n[s - HEAD], self.spelt_v[s - HEAD] = c, k
        for w, c in head[: self.own]:  # totals hold all words by spelling; those with symbols of their own are taken out
            self.spelt_n[spelt(w) - HEAD] -= c
            self.spelt_v[spelt(w) - HEAD] -= 1
        self.base = np.log10((self.counts + 1) / (n + v + 1))
        share = np.log10((self.counts + 1) / (self.spelt_n + self.spelt_v + 1)[np.maximum(self.symbol - HEAD, 0)])
        self.within = np.where(self.symbol < HEAD, 0.0, share)
        unigram = np.zeros(SYMBOLS)
        unigram[: self.own] = self.counts[: self.own] + 1
        unigram[HEAD : HEAD + SPELT] = self.spelt_n + 1
        self.unigram = unigram / max(unigram.sum(), 1)

    def task(self) -> tuple[dict[bytes, int], np.ndarray]:
        """Word to code, and code to symbol; codes from the lexicon's size on are unlisted words by spelling."""
        return {w: i for i, w in enumerate(self.words)}, np.concatenate([self.symbol, np.arange(HEAD, HEAD + SPELT)])


def _codes(text: str, known: dict[bytes, int], size: int) -> tuple[list[int], list[bytes]]:
    tokens = words_of(text)
    codes = list(map(known.get, tokens))
    rare = []
    if None in codes:
        for i, code in enumerate(codes):
            if code is None:
                codes[i] = size + spelt(tokens[i]) - HEAD
                rare.append(tokens[i])
    codes.append(known.get(b"", size))
    return codes, rare


def start(unigram: np.ndarray) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(7)
    return {
        "r": rng.normal(0, 0.3, (SYMBOLS, DIM)).astype(np.float32),
        "c": np.full((CONTEXT, DIM), 1 / CONTEXT, np.float32),
        "q": rng.normal(0, 0.05, (SYMBOLS, DIM)).astype(np.float32),
        "b": np.log(np.maximum(unigram, 1e-12)).astype(np.float32),
    }


def contexts(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """(CONTEXT, n) symbols before each token; padding before a text's first."""
    at = np.arange(len(symbols)) - np.repeat(begins, np.diff(np.append(begins, len(symbols))))
    out = np.full((CONTEXT, len(symbols)), SYMBOLS - 1, np.int64)
    for j in range(CONTEXT):
        ok = at > j
        out[j, ok] = symbols[np.flatnonzero(ok) - j - 1]
    return out


class Nce:
    """Minibatch AdaGrad on the NCE objective; noise words come from the unigram and are shared by a batch."""

    def __init__(self, p: dict[str, np.ndarray], unigram: np.ndarray, seed: int, rate: float = 0.15):
        self.p, self.rate, self.seen = {k: v.copy() for k, v in p.items()}, rate, 0
        self.g2 = {k: np.full_like(v, 1e-2) for k, v in self.p.items()}
        self.wide = np.empty((DIM, CONTEXT * BATCH))  # kept, as fresh pages cost more than the arithmetic
        self.rng, self.cum = np.random.default_rng(seed), np.cumsum(unigram)
        self.log_kp = np.log(np.maximum(unigram, 1e-12) * NOISE).astype(np.float32)

    def _step(self, k: str, g: np.ndarray) -> None:
        self.g2[k] += g * g
        self.p[k] -= self.rate * g / np.sqrt(self.g2[k])

    def batch(self, ctx: np.ndarray, target: np.ndarray) -> None:
        p, n = self.p, len(target)
        noise = np.minimum(np.searchsorted(self.cum, self.rng.random(NOISE) * self.cum[-1]), SYMBOLS - 2)
        # Columns first: every operation below runs along contiguous memory.
        rows = [p["r"].T[:, c] for c in ctx]
        hidden = sum(row * p["c"][j][:, None] for j, row in enumerate(rows))
        q_data = p["q"].T[:, target]
        s_data = (hidden * q_data).sum(axis=0) + (p["b"] - self.log_kp)[target]
        s_noise = p["q"][noise] @ hidden + (p["b"] - self.log_kp)[noise][:, None]
        e_data = -1 / (1 + np.exp(np.minimum(s_data, 30)))
        e_noise = 1 / (1 + np.exp(-np.maximum(s_noise, -30)))
        g_hidden = e_data * q_data + p["q"][noise].T @ e_noise
        given = (e_data * hidden).astype(np.float64)
        wide = self.wide[:, : CONTEXT * n]
        for j in range(CONTEXT):
            np.multiply(g_hidden, p["c"][j][:, None], out=wide[:, j * n : (j + 1) * n])
        every = np.concatenate(list(ctx))
        g = {k: np.zeros_like(v) for k, v in p.items()}
        for j, row in enumerate(rows):
            g["c"][j] = (g_hidden * row).sum(axis=1)
        g["r"] = np.array([np.bincount(every, x, SYMBOLS) for x in wide]).T.astype(np.float32)
        g["q"] = np.array([np.bincount(target, x, SYMBOLS) for x in given]).T.astype(np.float32)
        np.add.at(g["q"], noise, e_noise @ hidden.T)
        g["b"] = np.bincount(target, e_data, SYMBOLS).astype(np.float32)
        np.add.at(g["b"], noise, e_noise.sum(axis=1))
        for k, v in g.items():
            self._step(k, v / n)
        self.seen += n


def _shares(docs: DataFrame, lex: Lexicon) -> DataFrame:
    """(share, sym) for every row, share by share, in an order that doesn't depend on how the rows came."""

    def make():
        known, symbol = lex.task()
        size = len(lex.words)

        def step(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch.column(0), "sym": [symbol[_codes(t, known, size)[0]].astype(np.int16).tobytes() for t in batch.column(1).to_pylist()]}

        return step

    equal = map_rows(docs.select("doc_id", "text"), "doc_id long, sym binary", make).groupBy("doc_id", "sym").agg(F.count("*").alias("n"))
    rows = equal.select("doc_id", "sym", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / COPIES))).alias("many"))
    rows = rows.select("doc_id", "sym", "many", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES), F.col("n") - F.col("many") * COPIES))).alias("one"))
    rows = rows.select("doc_id", "sym", (F.col("many") * COPIES + F.col("one")).alias("copy"))
    shares = max(1, math.ceil(lex.n / SHARE))
    dealt = rows.withColumn("share", F.pmod(F.xxhash64("doc_id", "sym", "copy"), F.lit(shares)).cast("int"))
    return dealt.repartitionById(shares, "share").sortWithinPartitions("share", "doc_id", "sym").select("share", "sym")


def fit(docs: DataFrame, lex: Lexicon) -> dict[str, np.ndarray]:
    """One epoch of NCE over every share of ``docs`` (doc_id, text), averaged by tokens."""
    first = start(lex.unigram)
    shapes = {k: v.shape for k, v in first.items()}

    def make():
        total, model, held, at_share = np.zeros(sum(v.size for v in first.values()) + 1), [None], [[], [], 0], [None]

        def learn():
            if held[2]:
                sym, begins = np.concatenate(held[0]), np.array(held[1])
                ctx, order = contexts(sym, begins), model[0].rng.permutation(len(sym))
                for at in range(0, len(sym), BATCH):
                    some = order[at : at + BATCH]
                    model[0].batch(ctx[:, some], sym[some])
            held[:] = [[], [], 0]

        def close():
            learn()
            if model[0]:
                flat = np.concatenate([model[0].p[k].ravel() for k in shapes]).astype(np.float64)
                total[:] += np.append(flat, 1.0) * model[0].seen

        def step(batch: pa.RecordBatch):
            for share, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if share != at_share[0]:
                    close()
                    at_share[0], model[0] = share, Nce(first, lex.unigram, 1 + share)
                held[0].append(np.frombuffer(raw, np.int16).astype(np.int64))
                held[1].append(held[2])
                held[2] += len(held[0][-1])
                if held[2] >= 64 * BATCH:
                    learn()
            return ()

        def end():
            close()
            yield {"i": np.arange(len(total)), "x": total}

        step.last = end
        return step

    rows = map_rows(_shares(docs, lex), "i int, x double", make).groupBy("i").agg(F.sum("x").alias("x")).collect()
    flat = np.zeros(sum(v.size for v in first.values()) + 1)
    for r in rows:
        flat[r["i"]] = r["x"]
    if not flat[-1]:
        return first
    out, at = {}, 0
    for k, shape in shapes.items():
        n = math.prod(shape)
        out[k], at = (flat[at : at + n] / flat[-1]).reshape(shape).astype(np.float32), at + n
    return out


def symbol_log10(p: dict[str, np.ndarray], sym: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Normalised log10 probability of each token's symbol."""
    n = SYMBOLS - 1
    # The bias rides along as one more dimension, which is 1 in every context.
    tables = [np.hstack([p["r"] * p["c"][j], np.full((SYMBOLS, 1), 0 if j else 1, np.float32)]) for j in range(CONTEXT)]
    q = np.ascontiguousarray(np.hstack([p["q"][:-1], p["b"][:-1, None]]).T)
    ctx, out, ones = contexts(sym, begins), np.empty(len(sym)), np.ones(n, np.float32)
    room = np.empty((SCORED, n), np.float32)
    for at in range(0, len(sym), SCORED):
        part = slice(at, at + SCORED)
        hidden = tables[0].take(ctx[0, part], axis=0)
        for j in range(1, CONTEXT):
            hidden += tables[j].take(ctx[j, part], axis=0)
        logits = np.matmul(hidden, q, out=room[: len(hidden)])
        chosen = logits[np.arange(len(logits)), sym[part]]
        if logits.max() > 80:  # scores this large don't come out of training, but must not overflow
            chosen = np.minimum(chosen, 80)
            np.minimum(logits, 80, out=logits)
        np.exp(logits, out=logits)
        out[part] = (chosen - np.log(logits @ ones)) / math.log(10)
    return out


def _scored(docs: DataFrame, lex: Lexicon, params: dict[str, np.ndarray]) -> DataFrame:
    def make():
        known, symbol = lex.task()
        size, pad = len(lex.words), np.zeros(SPELT)
        base, within, counts = np.append(lex.base, pad), np.append(lex.within, pad), np.append(lex.counts, pad)
        part, at_row = TaskContext.get().partitionId() << 40, [0]

        def step(batch: pa.RecordBatch):
            for lo in range(0, batch.num_rows, 200):
                some = batch.slice(lo, 200)
                ids, folds, held, begins, total, rare, many, ends = some.column(0), some.column(1), [], [], 0, [], [], [0]
                for text in some.column(2).to_pylist():
                    codes, tail = _codes(text, known, size)
                    held.append(np.array(codes, np.int64))
                    begins.append(total)
                    total += len(codes)
                    per = Counter(tail)
                    rare.extend(per)
                    many.extend(per.values())
                    ends.append(len(rare))
                codes, first = np.concatenate(held), np.array(begins)
                logs = symbol_log10(params, symbol[codes], first) + within[codes]
                offsets = pa.array(ends, pa.int32())
                yield {
                    "rid": part + at_row[0] + np.arange(some.num_rows), "doc_id": ids, "held_out": folds,
                    "n_tokens": np.diff(np.append(first, total)), "n_known": np.add.reduceat((counts[codes] > 0).astype(np.int64), first),
                    "base_score": np.add.reduceat(base[codes], first), "score": np.add.reduceat(logs, first),
                    "w": pa.ListArray.from_arrays(offsets, pa.array(rare, pa.binary())), "k": pa.ListArray.from_arrays(offsets, pa.array(many, pa.int64())),
                }
                at_row[0] += some.num_rows

        return step

    return map_rows(docs, "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double, w array<binary>, k array<long>", make)


def score_documents(docs: DataFrame, folds: int = 7, held_out_fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text)."""
    docs = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), (fold_of(F.col("doc_id"), folds) == held_out_fold).alias("held_out"))
    train = docs.where("not held_out")
    counts = materialise(count_tokens(train), "counts")
    # The share of the most frequent words that is listed: words above a count, at most LEXICON of them.
    step = F.floor(4 * F.log2("c"))
    ladder = sorted(((r["s"], r["k"]) for r in counts.groupBy(step.alias("s")).agg(F.count("*").alias("k")).collect()), reverse=True)
    least, listed = float("inf"), 0
    for s, k in ladder:
        if listed + k > LEXICON:
            break
        least, listed = s, listed + k
    head = [(bytes(r["word"]), r["c"]) for r in counts.where(step >= F.lit(least)).collect()]
    spell = F.lit(HEAD) + F.crc32(F.substring("word", -3, 3)) % SPELT
    totals = {r["s"]: (r["n"], r["v"]) for r in counts.groupBy(spell.alias("s")).agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()}
    n, v = sum(x[0] for x in totals.values()), sum(x[1] for x in totals.values())
    lex = Lexicon(head, totals, n, v)
    params = fit(train, lex)
    rows = materialise(_scored(docs.select("doc_id", "held_out", "text"), lex, params), "scored")
    rare = rows.select("rid", F.explode(F.arrays_zip("w", "k")).alias("t")).select("rid", F.col("t.w").alias("word"), F.col("t.k").alias("k"))
    rare = rare.join(counts, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    room = F.element_at(F.array(*[F.lit(int(x)) for x in lex.spelt_n + lex.spelt_v + 1]), (F.crc32(F.substring("word", -3, 3)) % SPELT + 1).cast("int"))
    sums = rare.groupBy("rid").agg(
        F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("known"),
        F.sum(F.col("k") * F.log10((F.col("c") + 1) / F.lit(n + v + 1))).alias("base"),
        F.sum(F.col("k") * F.log10((F.col("c") + 1) / room)).alias("rest"),
    )
    plus = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return rows.drop("w", "k").join(sums, "rid", "left").select("doc_id", "held_out", "n_tokens", plus("n_known", "known"), F.lit(n).cast("long").alias("train_tokens"), plus("base_score", "base"), plus("score", "rest"))
