"""PII by candidate gradient boosting.

Base kinds are found by their patterns and always stay. High-recall generators propose further, overlapping spans
(digit groups, single numbers and telephone shapes inside longer runs that a base pattern swallowed and then dropped,
spelled-out addresses, account numbers); boosted regression trees on format and context features give each a
probability; the threshold is the lowest that keeps ``PRECISION`` on a calibration set. Accepted candidates that overlap
no base span are added, best first, as kind ``model``.

The trees learn from two sources, each dealt half to fitting and half to calibration: candidates of a bounded sample of
the documents (at most ``SAMPLE`` of those with seven digits in a row or so, by hash, at most 200 of a text), weakly labelled (1
where a candidate is a base span, 0 where it lies inside a longer word, overlaps a base span without being it, or is a
card-sized number that fails its check digit; others aren't learnt from), and examples composed by rule from a fixed
seed, for the formats that the base kinds don't have. Texts are scanned whole; every pattern is linear in the text, and
so is the choice of spans, but for moving what is already listed.

Defined results: null text is empty; no finds give zero counts and empty spans; repeated rows are scanned each; without
documents only the composed examples are learnt from; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, texts

PRECISION = 0.98
SAMPLE, ROWS = 2000, 8000  # documents that are learnt from, and their candidates, at most
TREES, DEPTH, RATE = 60, 3, 0.2
SCORED = 20_000  # candidates that are scored at a time

# The base kinds' patterns, in the order of their spans.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# Digits are taken whole (possessive), so that long runs aren't tried again from each of their digits: a match that
# fails from a run's first digit fails from all others, and one that succeeds takes the run to its end.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone", "model")

_GENERATORS = (
    re.compile(r"[+(]?[0-9](?:[ ().-]{0,2}[0-9]){6,}+"),
    re.compile(r"[A-Za-z0-9._%+-]{1,64}(?: ?[\[(](?:at|AT|@)[\])] ?| at )[A-Za-z0-9-]{1,64}(?:(?: ?[\[(](?:dot|DOT|\.)[\])] ?| dot )[A-Za-z0-9-]{1,64})+"),
    re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){3,7}(?![0-9A-Za-z])"),
    re.compile(r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    re.compile(r"(?<![0-9])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9])"),
    re.compile(r"\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"),
    re.compile(r"\+[0-9]{1,3} ?\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}(?![0-9])"),
)
_SPELLED = re.compile(r" dot |[\[(](?:dot|DOT|\.)[\])]")
_DIGIT = re.compile(r"[0-9]")
# Words of context, by what they speak for.
_FOR = ("phone", "tel", "call", "mobile", "cell", "fax", "contact", "card", "visa", "iban", "account", "ssn", "mail", "email", "reach", "write", "whatsapp", "social")
_AGAINST = ("order", "invoice", "version", "page", "id", "ref", "isbn", "part", "serial", "total", "year", "date", "chapter", "price", "build", "item", "issue", "model")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[re.Match]:
    """EMAIL's leftmost non-overlapping matches, looking only around each '@'."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and (text[start - 1].isascii() and (text[start - 1].isalnum() or text[start - 1] in "._%+-")):
            start -= 1
        m = EMAIL.match(text, start) if start < at else None
        if m:
            yield m
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end), sorted."""
    out = [(m.start(), 0, m.end()) for m in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(x.lstrip("0")) < 4 and int(x[-4:]) <= 255 for x in m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(out)


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, end, generator); they may overlap."""
    out = []
    for g, pattern in enumerate(_GENERATORS):
        if g == 1 and not _SPELLED.search(text) or g != 1 and not _DIGIT.search(text):
            continue
        out += [(m.start(), m.end(), g) for m in pattern.finditer(text)]
    return out


def candidate_features(text: str, start: int, end: int, g: int) -> list[float]:
    """Format and context of a candidate."""
    span, d = text[start:end], _digits(text[start:end])
    groups = [len(x) for x in re.split(r"[^0-9]+", span) if x]
    before, after = text[max(0, start - 40) : start].lower(), text[end : end + 12].lower()
    words = re.findall(r"[a-z]+", before)[-4:]
    near = lambda names: min((len(words) - i for i, w in enumerate(words) if w in names), default=9)
    return [
        g, len(span), len(d), len(groups), max(groups, default=0), min(groups, default=0), groups[0] if groups else 0, groups[-1] if groups else 0,
        span.count(" "), span.count("-"), span.count("."), span.count("("), span.startswith("+"), span.startswith("("), span.count("/"), luhn(d) if d else 0, d[:1] in "3456",
        len(set(d)), near(_FOR), near(_AGAINST), before[-1:].isalnum(), after[:1].isalnum(), before.rstrip()[-1:] in ":=#", before.rstrip()[-1:] == "#", before.rstrip()[-1:] in "$€£",
        len(d) in (15, 16) and luhn(d), span.find(" ") >= 0 and max(groups, default=0) >= 13, after[:1] in "%€$", bool(re.match(r"(19|20)\d\d", d)), len(groups) == 3 and groups[0] == 3 and groups[1:] in ([2, 4], [3, 4]), bool(re.search(r" at |[\[(](at|@)", span, re.I)),
    ]


class Boosted:
    """Gradient boosted regression trees for the logistic loss, with second-order leaf values."""

    def __init__(self):
        self.trees: list[list[tuple]] = []
        self.prior = 0.0

    def _grow(self, x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, nodes: list) -> int:
        at = len(nodes)
        nodes.append(None)
        gain_of = lambda a, b: a * a / (b + 1.0)
        best = (1e-3, -1, 0.0)
        if depth and len(x) >= 20:
            for f in range(x.shape[1]):
                order = np.argsort(x[:, f], kind="stable")
                v, cg, ch = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
                cut = np.flatnonzero(v[1:] > v[:-1])
                if len(cut):
                    gain = gain_of(cg[cut], ch[cut]) + gain_of(cg[-1] - cg[cut], ch[-1] - ch[cut]) - gain_of(cg[-1], ch[-1])
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (float(gain[k]), f, float(v[cut[k]] + v[cut[k] + 1]) / 2)
        if best[1] < 0:
            nodes[at] = (-1, 0.0, 0, 0, float(-g.sum() / (h.sum() + 1.0)))
            return at
        low = x[:, best[1]] <= best[2]
        left = self._grow(x[low], g[low], h[low], depth - 1, nodes)
        right = self._grow(x[~low], g[~low], h[~low], depth - 1, nodes)
        nodes[at] = (best[1], best[2], left, right, 0.0)
        return at

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        self.prior = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
        z = np.full(len(y), self.prior)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-z))
            nodes: list = []
            self._grow(x, p - y, p * (1 - p), DEPTH, nodes)
            self.trees.append(nodes)
            z += RATE * self._leaves(nodes, x)
        return self

    @staticmethod
    def _leaves(nodes: list, x: np.ndarray) -> np.ndarray:
        """The leaf value of each row."""
        feature, cut, left, right, value = map(np.array, zip(*nodes, strict=True))
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        for _ in range(DEPTH):
            low = x[rows, feature[at]] <= cut[at]
            at = np.where(feature[at] < 0, at, np.where(low, left[at], right[at]))
        return value[at]

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = np.zeros(len(x))
        for tree in self.trees:
            z += self._leaves(tree, x)
        return 1 / (1 + np.exp(-self.prior - RATE * z))


def labelled(n: int = 3000, seed: int = 5) -> list[tuple[str, int, int, int, int]]:
    """(text, start, end, generator, label): examples and look-alikes in context, composed by rule."""
    rng = np.random.default_rng(seed)
    num = lambda k: "".join(map(str, rng.integers(0, 10, k)))
    word = lambda: "".join(rng.choice(list("abcdefghilmnoprstu"), rng.integers(2, 9)))
    pick = lambda xs: xs[rng.integers(len(xs))]
    upper = lambda k: "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), k))
    real = (
        lambda: f"({num(3)}) {num(3)}-{num(4)}", lambda: f"{num(3)}-{num(3)}-{num(4)}", lambda: f"{num(3)}.{num(3)}.{num(4)}", lambda: f"0{num(2)} {num(4)} {num(4)}", lambda: f"{num(3)}-{num(2)}-{num(4)}",
        lambda: f"{word()}.{word()} at {word()} dot com", lambda: f"{word()}{num(2)} (at) {word()} (dot) org", lambda: f"{word()}[at]{word()}[dot]net",
        lambda: f"DE{num(2)} {num(4)} {num(4)} {num(4)} {num(4)}", lambda: f"FR{num(2)}{num(16)}",
    )
    fake = (
        lambda: num(pick([7, 8, 9, 10, 12, 16, 20])), lambda: f"{num(4)}-{num(2)}-{num(2)}", lambda: f"{num(1)}.{num(7)}", lambda: f"19{num(2)} 20{num(2)}", lambda: f"{num(2)}.{num(2)}.20{num(2)}", lambda: f"{num(1)}.{num(2)}.{num(3)}.{num(3)}",
        lambda: f"{num(5)}-{num(6)}", lambda: f"{num(2)} {num(2)} {num(2)} {num(2)}", lambda: f"{num(3)} {num(3)} {num(3)}", lambda: f"AB{num(2)}{upper(12)}"[:16], lambda: f"978-{num(1)}-{num(4)}-{num(4)}-{num(1)}",
    )
    out = []
    while len(out) < n:
        good = rng.random() < 0.45
        cue = pick(_FOR if good else _AGAINST) if rng.random() < 0.55 else word()
        head = " ".join(word() for _ in range(rng.integers(0, 5))) + f" {cue}{pick(['', ':', ' is', ' no.', ' #', ' ='])} "
        span = (pick(real) if good else pick(fake))()
        text = f"{head}{span}{pick([' ', '. ', ', ', ''])}{word() if rng.random() < 0.8 else ''}"
        for s, e, g in candidates(text):
            if s < len(head) + len(span) and e > len(head):
                out.append((text, s, e, g, int(good and abs(s - len(head)) <= 1 and abs(e - len(head) - len(span)) <= 1)))
    return out[:n]


def weak_rows(text: str) -> Iterator[tuple[list[float], int]]:
    """(features, label) of a text's candidates that the base kinds or rules label."""
    base = base_spans(text)
    exact = {(s, e) for s, _, e in base}
    for s, e, g in candidates(text):
        digits = _digits(text[s:e])
        if (s, e) in exact:
            label = 1
        elif text[s - 1 : s].isalnum() or text[e : e + 1].isalnum() or any(s < b and a < e for a, _, b in base):
            label = 0
        elif 13 <= len(digits) <= 19 and not luhn(digits):
            label = 0
        else:
            continue
        yield candidate_features(text, s, e, g), label


def weak_sample(docs: DataFrame) -> list[tuple[list[float], int]]:
    """Weakly labelled candidates of at most ``SAMPLE`` documents, in a fixed order."""
    able = docs.where(F.col("text").rlike(r"[0-9]([ ().-]{0,2}[0-9]){6}")).select(F.xxhash64("doc_id", "text").alias("h"), "text")
    picked = able.select("h").distinct().orderBy("h").limit(SAMPLE)  # texts don't meet in one task: only hashes do
    some = able.join(F.broadcast(picked), "h").dropDuplicates(["h"])

    def make():
        def step(batch: pa.RecordBatch):
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = list(weak_rows(text))[:200]
                yield {"h": [h] * len(rows), "nth": list(range(len(rows))), "x": [[float(v) for v in x] for x, _ in rows], "y": [y for _, y in rows]}

        return step

    rows = map_rows(some, "h long, nth int, x array<double>, y int", make).orderBy("h", "nth").limit(ROWS).collect()
    return [(r["x"], r["y"]) for r in rows]


def fit(weak: list[tuple[list[float], int]] = ()) -> tuple[Boosted, float]:
    """The model and the lowest threshold with ``PRECISION`` on the calibration half."""
    rows = [(candidate_features(t, s, e, g), y) for t, s, e, g, y in labelled()]
    # Of each half, every other row: both sources are in both.
    learn, tell = rows[::2] + list(weak[::2]), rows[1::2] + list(weak[1::2])
    model = Boosted().fit(np.array([x for x, _ in learn], float), np.array([y for _, y in learn], float))
    p = model.scores(np.array([x for x, _ in tell], float))
    order = np.argsort(-p, kind="stable")
    right = np.cumsum(np.array([y for _, y in tell], float)[order]) / np.arange(1, len(order) + 1)
    good = np.flatnonzero((right >= PRECISION) & (np.append(np.diff(p[order]) < 0, True)))
    return model, float(p[order][good[-1]]) if len(good) else 1.1


def accepted(base: list[tuple[int, int, int]], scored: Iterable[tuple[float, int, int]]) -> list[tuple[int, int, int]]:
    """The best scored spans first, those that overlap no base span and none taken before; sorted."""
    starts, ends, high = [s for s, _, _ in base], [], 0
    for _, _, e in base:  # the farthest end of this span and all before it
        ends.append(high := max(high, e))
    taken: list[tuple[int, int]] = []  # in order; they don't overlap
    for _, s, e in sorted(scored, key=lambda x: (-x[0], x[1], x[2])):
        at = bisect_left(starts, e)
        if at and ends[at - 1] > s:
            continue
        at = bisect_left(taken, (e,))
        if not at or taken[at - 1][1] <= s:
            taken.insert(at, (s, e))
    return [(s, 4, e) for s, e in taken]


def find(texts: list[str], model: Boosted, threshold: float) -> Iterator[tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Of each text, base spans, and all spans with those that the model adds. Candidates of all texts are scored together,
    ``SCORED`` at a time."""
    found: list[list[tuple[float, int, int]]] = [[] for _ in texts]
    each = ((i, s, e, g) for i, text in enumerate(texts) for s, e, g in candidates(text))
    while some := list(islice(each, SCORED)):
        p = model.scores(np.array([candidate_features(texts[i], s, e, g) for i, s, e, g in some], float))
        for at in np.flatnonzero(p >= threshold).tolist():
            i, s, e, _ = some[at]
            found[i].append((float(p[at]), s, e))
    for text, scored in zip(texts, found, strict=True):
        base = base_spans(text)
        yield base, sorted(base + accepted(base, scored))


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_model for each row of ``docs`` (doc_id, text)."""
    docs = texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    model, threshold = fit(weak_sample(docs))

    def make():
        def step(batch: pa.RecordBatch):
            out: dict[str, list] = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "n_model", "base_sha256", "spans")}
            for base, every in find(batch.column(1).to_pylist(), model, threshold):
                for k in range(5):
                    out[f"n_{KINDS[k]}"].append(sum(x[1] == k for x in every))
                out["base_sha256"].append(hashlib.sha256(_told(base).encode()).hexdigest())
                out["spans"].append(_told(every))
            return out | {"doc_id": batch.column(0)}

        return step

    return map_rows(docs, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long", make)
