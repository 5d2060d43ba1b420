"""Periodic runs of words: stretches that repeat with a smallest period q, at least three times and over 24 words.

A run with period q has 2 q equal pairs of words q apart in one unbroken island, so a text's lags are first counted:
how many pairs of equal words lie q apart, for every q up to a third of the text. Words that are rare in the text count
their pairs one by one; for frequent ones, the sum of their power spectra gives the autocorrelation, whose rounded
values are exact. Only lags with enough matches get a scan for islands, and the matches of a run that is already found
don't count for multiples of its period: two runs share no such pair (Fine and Wilf), so what is left still counts
every run whose smallest period is the lag itself.

Texts are handled where they are, in one pass without a shuffle; the rare words of all texts of a batch are paired in
the same array operations.

Defined results: null text has no words and no runs; repeated rows give equal rows; no rows give none.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, texts
from .words import numbered_words

LENGTH, TIMES = 24, 3  # the least words of a run, and the least number of periods
PAIRS = 2_000_000  # pair differences that are held before they are counted


def needed(lag: np.ndarray | int, length: int = LENGTH, times: int = TIMES):
    """Pairs of equal words that a run of this period has in a row, at least."""
    return np.maximum(length - lag, (times - 1) * lag)


def frequent_from(n: np.ndarray) -> np.ndarray:
    """Above this count a word costs less by a Fourier transform than pair by pair."""
    return np.ceil(np.sqrt(n * np.log2(np.maximum(n, 2)))).astype(np.int64)


def lag_counts(ids: np.ndarray, counts: np.ndarray, times: int = TIMES) -> list[np.ndarray]:
    """For each text, the number of equal pairs at lags 0 (not counted) to a ``times``-th of its words."""
    most = counts // times
    bases = np.append(0, np.cumsum(most + 1))
    total = np.zeros(bases[-1], np.int64)
    text = np.repeat(np.arange(len(counts)), counts)
    begins = np.append(0, np.cumsum(counts))
    place = np.arange(len(ids)) - begins[text]
    key = text * (ids.max(initial=0) + 1) + ids
    order = np.argsort(key, kind="stable")
    _, group, size = np.unique(key[order], return_inverse=True, return_counts=True)
    often = size[group] > frequent_from(counts)[text[order]]

    # Rare words: the pairs with the next place of the same word, the one after it and so on, while they are near enough.
    rare = order[~often]
    of, at, where = group[~often], place[rare], text[rare]
    left, held, step = np.arange(len(rare)), [], 0
    while len(left):
        step += 1
        left = left[left + step < len(rare)]
        lag = at[left + step] - at[left]
        near = (of[left + step] == of[left]) & (lag <= most[where[left]])
        left = left[near]
        held.append(bases[where[left]] + lag[near])
        if sum(map(len, held)) > PAIRS or not len(left):
            pairs = np.concatenate(held)
            if len(pairs) * 8 > len(total):
                total += np.bincount(pairs, minlength=len(total))
            else:
                np.add.at(total, pairs, 1)
            held = []

    # Frequent words: a transform each, and one back for their sum.
    found = order[often]
    for one in np.unique(text[found]):
        mine = found[text[found] == one]
        size = 1 << int(counts[one] + most[one]).bit_length()
        power = np.zeros(size // 2 + 1)
        for word in np.unique(ids[mine]):
            shows = np.zeros(size)
            shows[place[mine[ids[mine] == word]]] = 1
            power += np.abs(np.fft.rfft(shows)) ** 2
        total[bases[one] : bases[one + 1]] += np.rint(np.fft.irfft(power, size)[: most[one] + 1]).astype(np.int64)
    return [total[a:b] for a, b in zip(bases[:-1], bases[1:], strict=True)]


def islands(ids: np.ndarray, lag: int, least: int) -> list[tuple[int, int]]:
    """(start, pairs) of unbroken stretches of at least ``least`` (two lags or more) words equal to that ``lag`` later."""
    posts = np.arange(0, len(ids) - lag, lag)  # two posts in a row stand on every such island
    stand = ids[posts] == ids[posts + lag]
    if not (stand[1:] & stand[:-1]).any():
        return []
    turns = np.diff((ids[lag:] == ids[:-lag]).astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    long = end - begin >= least
    return list(zip(begin[long].tolist(), (end - begin)[long].tolist(), strict=True))


def runs_of(ids: np.ndarray, matches: np.ndarray, length: int = LENGTH, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start, then period; ``matches`` as of ``lag_counts``, used up."""
    found: dict[tuple[int, int], int] = {}
    lags = np.arange(len(matches))
    least = needed(lags, length, times)
    for lag in lags[1:][matches[1:] >= least[1:]].tolist():
        if matches[lag] < least[lag]:  # what it had was of runs found meanwhile
            continue
        for start, pairs in islands(ids, lag, int(least[lag])):
            if (start, pairs + lag) not in found:
                found[start, pairs + lag] = lag
                multiples = np.arange(2 * lag, min(len(matches), pairs + lag), lag)
                matches[multiples] -= pairs + lag - multiples
    return sorted((start, n, lag) for (start, n), lag in found.items())


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with most periods; ties go to the earlier start, then to the smaller period."""
    return min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words joined by one space, of each run only its first period."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, n, period in runs:
            keep[start + period : start + n] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words).decode()


def find_runs(docs: DataFrame, length: int = LENGTH, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs (start, length, period), the strongest run's start, length and period, and collapsed.

    ``docs``: doc_id, text and others, which are left out.
    """
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            words, ids, counts = numbered_words(batch["text"].to_pylist())
            ends = np.cumsum(counts)
            found = [runs_of(ids[e - n : e], m, length, times) if n >= length else [] for e, n, m in zip(ends, counts, lag_counts(ids, counts, times), strict=True)]
            best = [strongest(r) for r in found]
            told = {name: [b and b[i] for b in best] for i, name in enumerate(("start", "length", "period"))}
            listed = [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in found]
            return told | {"doc_id": batch["doc_id"], "n_words": counts, "runs": listed, "collapsed": list(map(collapse, words, found))}

        return step

    schema = f"doc_id {doc_id}, n_words long, runs array<struct<start:long,length:long,period:long>>, start long, length long, period long, collapsed string"
    return map_rows(texts(docs, "doc_id"), schema, make)


def rewritten(docs: DataFrame) -> DataFrame:
    """doc_id and text, where a tenth of the texts, by the id's crc32, repeat a part of themselves to their end.

    A null id counts as the empty text.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = texts(docs, "doc_id").select("doc_id", "text", h.alias("h")).withColumn("w", F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("w").cast("long"), F.floor(F.col("h") / 10)
    marked = marked.withColumn("a", F.when(n > 0, g % n)).withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + g % 8)))
    w, a, p = F.col("w"), F.col("a"), F.col("p")
    again = F.transform(w, lambda _, i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
    return marked.select("doc_id", F.when(a.isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))
