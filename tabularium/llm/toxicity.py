"""Toxicity with noisy-channel deobfuscation.

A token that may be disguised (leetspeak, inserted separators, spaced-out or repeated letters) becomes a character
lattice: each character may stand for itself, for the letters it imitates, or for nothing. Viterbi search under a
character trigram model, plus a channel cost per change, restores the likeliest word. Tokens with one reading stay.

The restored text is scored by patterns (substrings of words) that mark toxic training documents, found with an
Aho-Corasick automaton, and a logistic regression over what they add up to. The trigrams are counted over all
documents; the rest is fitted on a bounded sample of labelled rows (``SAMPLE``, the smallest hashes of doc_id; texts of
over ``LONGEST`` characters aren't learnt from): patterns (from words of at most 40 letters) on one half, regression on
the other. Every text is scored whole and every token decoded in one pass, however long. The decoder's model holds the
``GRAMS`` commonest trigrams (all of them, but in corpora of very many scripts); rarer ones have their letters' probabilities.

Defined results: null text is empty; empty text gets the score of a text without patterns; rows with equal texts get
equal scores; repeated labels of a document count as toxic if any is; of rows with one doc_id the least text is learnt
from; without usable labels every score is that of log odds -30 (about 1e-13); other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import sys
import uuid
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold_of, map_rows, small_batches, texts, trim, worker_keeps

SAMPLE = 6000  # labelled documents that the models are fitted on, at most
THRESHOLD = 0.3
LONGEST = 20_000  # characters of a text that is learnt from, at most
MEMO = 150_000  # tokens that a worker remembers the restored form of; a full memo is emptied
WORD = 64  # characters of a token that is remembered, at most
GRAMS = 200_000  # trigrams that the decoder's model holds, at most

# The letters that a character is used to imitate.
IMITATES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "*": "aeiou", "#": "h"}
_ZERO = "­​‌‍⁠﻿"  # marks without width
SEPARATORS = ".-_*~ '" + _ZERO
SWAP, DROP, REPEAT, DOUBLE, LOSE = -1.2, -0.7, -0.4, -1.2, -6.0  # log channel costs

_GAP = rf"(?:[\s{_ZERO}]+|[.*_~-])"
_SPACED = re.compile(rf"(?<!\S)(?:[^\W_]|[@$!|+*])(?:{_GAP}(?:[^\W_]|[@$!|+*])){{2,}}(?=[.,;:!?\"')\]}}]*(?!\S))")
_WIDE, _GAPS = re.compile(r"\s{2,}"), re.compile(rf"[\s.*_~{_ZERO}-]")
_HINT = re.compile(rf"[^\W\d_][0-9@$!|+*#(._~{_ZERO}-]+[^\W\d_]|(?<!\S)[0-9@$!|+*(][0-9@$!|+*(]?[^\W\d_]|[^\W\d_][0-9@$+](?![^\s.,;:!?\"'])|([^\W\d_])\1")
_TWICE = re.compile(r"(.)\1")
_EDGE = " \t\r\n.,;:!?\"'()[]{}<>|*#&%$~_-=+/\\"


class CharTrigrams:
    """Log probabilities of a letter after two others, interpolated with lower orders; '^' opens, '$' ends a word."""

    def __init__(self, grams: dict[str, int]):
        self.n = [Counter(), Counter(), Counter()]
        for gram, k in grams.items():
            for order in range(3):
                self.n[order][gram[2 - order :]] += k
        self.of = [Counter(), Counter(), Counter()]
        for order in range(3):
            for gram, k in self.n[order].items():
                self.of[order][gram[:-1]] += k
        self.memo: dict[str, float] = {}

    def log(self, gram: str) -> float:
        """log p(last | first two)."""
        if (found := self.memo.get(gram)) is not None:
            return found
        p = 1 / 200
        for order in range(3):
            part = gram[2 - order :]
            below = self.of[order][part[:-1]]
            p = (self.n[order][part] + 2 * p) / (below + 2)
        self.memo[gram] = math.log(p)
        return self.memo[gram]


def lattice(token: str) -> Iterator[tuple[list[tuple[str, float]], float | None]]:
    """For each character, the letters that it may stand for and what they cost, and the cost of leaving it out (null: not allowed)."""
    run = 0
    for i, c in enumerate(token):
        run = run + 1 if i and token[i - 1] == c else 1
        arcs: list[tuple[str, float]] = [(c, 0.0)] if c.isalpha() else []
        arcs += [(x, SWAP) for x in IMITATES.get(c, "")]
        yield arcs, DROP if c in SEPARATORS or not arcs else REPEAT if run >= 2 and (run >= 3 or token[i + 1 : i + 2] == c) else LOSE if not c.isalpha() else DOUBLE if run == 2 else None


@dataclass
class Restorer:
    lm: CharTrigrams
    memo: dict[str, str] = field(default_factory=dict)

    def decode(self, token: str) -> str:
        """The likeliest word behind a token's characters. What all paths agree on is put aside as it grows, so that a path's
        text stays short."""
        paths: dict[str, tuple[float, str]] = {"^^": (0.0, "")}
        agreed: list[str] = []
        for i, (arcs, drop) in enumerate(lattice(token)):
            step: dict[str, tuple[float, str]] = {}
            for last, (score, said) in paths.items():
                for x, cost in arcs:
                    to = (score + cost + self.lm.log(last + x), said + x)
                    if last[1] + x not in step or step[last[1] + x] < to:
                        step[last[1] + x] = to
                if drop is not None and (last not in step or step[last] < (score + drop, said)):
                    step[last] = (score + drop, said)
            paths = step
            if i % WORD == WORD - 1 and (common := os.path.commonprefix([said for _, said in paths.values()])):
                agreed.append(common)
                paths = {last: (score, said[len(common) :]) for last, (score, said) in paths.items()}
        return "".join(agreed) + max((score + self.lm.log(last + "$"), said) for last, (score, said) in paths.items())[1] if paths else token

    def word(self, token: str) -> str:
        """A token's restored form, remembered unless it is very long."""
        out = self._word(token)
        if len(token) <= WORD:
            if len(self.memo) > MEMO:
                self.memo.clear()
            self.memo[token] = out
        return out

    def _word(self, token: str) -> str:
        if token.isalpha() and not _TWICE.search(token):
            return token
        core = token.strip(_EDGE)
        # A mark at the edge may be a letter in disguise, unless it's one of a run or plain punctuation.
        lead = token[: len(token) - len(token.lstrip(_EDGE))][-1:]
        tail = token[len(token.rstrip(_EDGE)) :]
        core = (lead if lead and lead in "@$!|+*(" and token[:1] == lead else "") + core + (tail if tail in ("$", "+", "!", "|") else "")
        if core.isalpha() and not _TWICE.search(core):
            return core  # one reading
        letters = sum(c.isalpha() for c in core)
        # Marks that imitate letters count beside them, as long as there is a letter at all.
        like = letters + sum(c in IMITATES and not c.isdigit() or c in "0134" for c in core)
        return self.decode(core) if letters and len(core) < 4 * max(letters, like) else token

    def spaced(self, m: re.Match) -> str:
        """Spaced-out letters as one word, as the words that wider gaps part, and as they are."""
        parts = _WIDE.split(m[0])
        said = [_GAPS.sub("", x) for x in ([m[0], *parts] if len(parts) > 1 else parts)]
        return " ".join([*(self.decode(x) for x in said if len(x) > 2), m[0]])

    def __call__(self, text: str) -> str:
        text = text.lower()
        if not _HINT.search(text) and not _SPACED.search(text):
            return text
        tokens = _SPACED.sub(self.spaced, text).split()
        said = list(map(self.memo.get, tokens))
        if None in said:
            for i, word in enumerate(said):
                if word is None:
                    said[i] = self.memo.get(tokens[i]) or self.word(tokens[i])
        return " ".join(said)


def _grams(words: Counter) -> Counter:
    """Trigrams of the plain words among counted tokens."""
    out: Counter = Counter()
    for token, k in words.items():
        word = token.strip(_EDGE)
        if word.isalpha() and not re.search(r"(.)\1\1", word):
            padded = f"^^{word}$"
            for i in range(len(padded) - 2):
                out[padded[i : i + 3]] += k
    return out


def count_grams(docs: DataFrame) -> dict[str, int]:
    """Trigram counts over all texts: the ``GRAMS`` commonest of them come to the driver."""

    def make():
        words, grams, held = Counter(), Counter(), [0]

        def step(batch: pa.RecordBatch):
            for text in batch.column(0).to_pylist():
                words.update(text.lower().split())
                held[0] += len(text)
                if len(words) > MEMO or held[0] > 16_000_000:
                    grams.update(_grams(words))
                    words.clear()
                    held[0] = 0
            return ()

        def end():
            grams.update(_grams(words))
            yield {"gram": list(grams), "k": list(grams.values())}

        step.last = end
        return step

    rows = map_rows(texts(docs).select("text"), "gram string, k long", make).groupBy("gram").agg(F.sum("k").alias("k")).orderBy(F.desc("k"), "gram").limit(GRAMS)
    return {r["gram"]: r["k"] for r in sorted(rows.collect(), key=lambda r: r["gram"])}


def _plain_words(text: str) -> set[str]:
    return {w for w in (t.strip(_EDGE) for t in text.split()) if w}


def _patterns(docs: list[tuple[tuple[str, ...], int]]) -> dict[str, float]:
    """Substrings of words (4 letters or more, or whole words) and their log odds between toxic and other documents.

    Sets of documents are bits of whole numbers, toxic ones and others numbered apart.
    """
    import ahocorasick

    toxic = sum(y for _, y in docs)
    clean = len(docs) - toxic
    hot: dict[str, int] = defaultdict(int)  # a word's toxic documents
    cold: dict[str, list[int]] = defaultdict(list)  # and its other ones
    number = [0, 0]
    for words, y in docs:
        for w in words:
            if y:
                hot[w] |= 1 << number[1]
            else:
                cold[w].append(number[0])
        number[y] += 1
    odds = lambda t, c: math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))

    def bits(at: list[int]) -> int:
        out = bytearray(clean // 8 + 1)
        for i in at:
            out[i >> 3] |= 1 << (i & 7)
        return int.from_bytes(out, "little")

    # Longer patterns are only looked for in words with a five-letter part that is itself telling.
    parts = lambda w: {f" {w} "[i : i + 5] for i in range(len(w) - 2)}
    fives: dict[str, int] = defaultdict(int)
    for w, t in hot.items():
        if len(w) <= 40:
            for g in parts(w):
                fives[g] |= t
    fives = {g: t for g, t in fives.items() if t.bit_count() >= 5}
    clear: dict[str, int] = defaultdict(int)
    for w, at in cold.items():
        if shared := parts(w) & fives.keys():
            others = bits(at)
            for g in shared:
                clear[g] |= others
    telling = {g for g, t in fives.items() if odds(t.bit_count(), clear[g].bit_count()) > 1.5}
    del fives, clear
    seeds: dict[str, int] = defaultdict(int)
    for w, t in hot.items():
        if len(w) <= 40 and not telling.isdisjoint(parts(w)):
            marked = f" {w} "
            for lo in range(len(marked)):
                for hi in range(lo + 4, min(lo + 12, len(marked)) + 1):
                    seeds[marked[lo:hi]] |= t
    seeds = {s: t for s, t in seeds.items() if t.bit_count() >= 5}
    if not seeds:
        return {}
    machine = ahocorasick.Automaton()
    for s in seeds:
        machine.add_word(s, s)
    machine.make_automaton()
    against: dict[str, int] = defaultdict(int)
    for w, at in cold.items():
        if found := {s for _, s in machine.iter(f" {w} ")}:
            others = bits(at)
            for s in found:
                against[s] |= others
    kept: dict[str, float] = {}
    seen: set[int] = set()
    for s, t in sorted(seeds.items(), key=lambda x: (-x[1].bit_count(), against[x[0]].bit_count(), -len(x[0]), x[0])):
        if (o := odds(t.bit_count(), against[s].bit_count())) > 3.5 and t not in seen:
            seen.add(t)
            kept[s] = o
    return kept


@dataclass
class Model:
    lm: CharTrigrams
    patterns: dict[str, float]
    weights: np.ndarray

    def scorer(self) -> Callable[[str], float]:
        import ahocorasick

        machine, restore = ahocorasick.Automaton(), Restorer(self.lm)
        for s, o in self.patterns.items():
            machine.add_word(s, (s, o))
        if self.patterns:
            machine.make_automaton()

        def score(text: str) -> float:
            z = float(self.weights @ features(restore(text), machine if self.patterns else None))
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))

        return score


def features(text: str, machine) -> np.ndarray:
    """What the patterns found in a restored text add up to."""
    hits = Counter(v for _, v in machine.iter(f" {' '.join(t.strip(_EDGE) for t in text.split())} ")) if machine else Counter()
    odds = sorted((o for _, o in hits), reverse=True)
    top = odds[:1] or [0.0]
    words = text.count(" ") + 1
    return np.array([1.0, top[0], sum(odds[1:4]) / 3, math.log1p(len(odds)), math.log1p(sum(hits.values())), math.log1p(100 * sum(hits.values()) / words), bool(odds)])


def fit(rows: list[tuple[str, int]], grams: dict[str, int] | None = None) -> Model:
    """From (text, toxic) pairs: patterns from every other row, weights from the rest; the character model from trigram counts, or the rows'."""
    if grams is None:
        grams = _grams(Counter(t for text, _ in rows for t in text.lower().split()))
    model = Model(CharTrigrams(grams), {}, np.array([-30.0, 0, 0, 0, 0, 0, 0]))
    restore = Restorer(model.lm)
    if len({int(y) for _, y in rows}) < 2:
        return model
    model.patterns = _patterns([(tuple(map(sys.intern, _plain_words(restore(t)))), int(y)) for t, y in rows[::2]])
    import ahocorasick

    machine = ahocorasick.Automaton()
    for s, o in model.patterns.items():
        machine.add_word(s, (s, o))
    if model.patterns:
        machine.make_automaton()
    rest = rows[1::2] or rows
    x = np.array([features(restore(t), machine if model.patterns else None) for t, _ in rest])
    y = np.array([v for _, v in rest], float)
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton's method with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(h, x.T @ (p - y) + 0.1 * w)
    model.weights = w
    return model


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out_fold: int = 2) -> Model:
    """Fit on at most ``SAMPLE`` labelled documents outside the held-out fold."""
    ids = F.col("doc_id").cast("long")
    known = labels.select(ids.alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic is not null")
    known = known.where(fold_of(F.col("doc_id"), folds) != held_out_fold).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    few = texts(docs, ids.alias("doc_id")).join(F.broadcast(some), "doc_id").where(F.length("text") <= LONGEST)
    rows = few.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).collect()
    model = fit([(r["text"], r["toxic"]) for r in sorted(rows, key=lambda r: r["doc_id"])], count_grams(docs))
    del rows
    trim()
    return model


def score_column(model: Model, text: str = "text") -> Column:
    """The model's score of a text column. A worker keeps the scorer, and what it remembers, from task to task."""
    tag = uuid.uuid4().hex

    @F.pandas_udf("double")
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        one = worker_keeps(f"toxicity {tag}", model.scorer)
        for part in parts:
            yield pd.Series([one(t) for t in part], dtype="float64")
        trim()

    small_batches(SparkSession.active())
    return score(F.coalesce(F.col(text).cast("string"), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out_fold: int = 2, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs`` (doc_id, text); labels: doc_id, toxic."""
    model = train(docs, labels, folds, held_out_fold)
    ids = F.col("doc_id").cast("long")
    rows = texts(docs, ids.alias("doc_id")).select("doc_id", (fold_of(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), score_column(model).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
