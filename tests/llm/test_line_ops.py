"""Periodic runs, whitening and line-first cleaning, against plain restatements."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabularium.llm import periodic, quality, queries, whitening


def plain_runs(w):
    """Every maximal stretch, lag by lag and word by word."""
    found = {}
    for q in range(1, len(w) // 3 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_periodic_runs_of_planted_and_random_words():
    rng = np.random.default_rng(3)
    cases = [list("ab") * 40, ["a"] * 100, ["a"] * 23, ["a"] * 24, list("abcdefgh") * 3, list("abcdefgh") * 2 + list("abcdefg"), [], ["x"]]
    for n in (40, 90, 200, 700):
        for letters in (2, 3, 30):
            cases.append([f"w{x}" for x in rng.integers(0, letters, n)])
            unit = [f"w{x}" for x in rng.integers(0, letters, rng.integers(1, 20))]
            cases.append(cases[-1][: n // 3] + unit * int(rng.integers(3, 9)) + cases[-1][n // 2 :] + unit * 5 + ["w0"] * 30)
    _, ids, counts = periodic.numbered_words([" ".join(c) for c in cases])
    ends = np.cumsum(counts)
    for case, end, n, matches in zip(cases, ends, counts, periodic.lag_counts(ids, counts), strict=True):
        mine = ids[end - n : end]
        assert matches[1:].tolist() == [int((mine[q:] == mine[:-q]).sum()) for q in range(1, n // 3 + 1)]
        assert periodic.runs_of(mine, matches) == plain_runs(case), case


def test_a_long_text_of_one_word_takes_one_scan():
    ids = np.zeros(300_000, np.int64)
    assert periodic.runs_of(ids, periodic.lag_counts(ids, np.array([len(ids)]))[0]) == [(0, 300_000, 1)]


def test_op11(spark, sf_dir, plain):
    got = {r["doc_id"]: r for r in queries.op11_periodic_runs(spark, sf_dir).collect()}
    assert got.keys() == plain.keys()
    planted = 0
    for i, text in plain.items():
        w, h = plain_words(text), zlib.crc32(str(i).encode())
        if len(w) > 1500:  # the restatement is quadratic
            continue
        if h % 10 == 0 and w:
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = w[:a] + [w[a + (j - a) % p] for j in range(a, len(w))]
        runs = plain_runs(w)
        planted += bool(runs)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        gone = {j for s, n, q in runs for j in range(s + q, s + n)}
        r = got[i]
        assert (r["n_words"], r["n_runs"], r["start"], r["length"], r["period"]) == (len(w), len(runs), *best)
        assert r["exponent_milli"] == (best[1] * 1000 // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()
    assert planted > 20


def test_periodic_messy(messy, empty):
    rows = periodic.find_runs(messy).collect()
    assert len(rows) == messy.count() and periodic.find_runs(empty).count() == 0
    by = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by[5]["runs"]] == [(0, 12000, 3)] and by[5]["collapsed"] == "lorem ipsum dolor"
    assert by[2]["n_words"] == 0 and by[2]["runs"] == [] and by[2]["start"] is None and by[2]["collapsed"] == ""
    assert by[11]["collapsed"] == "Ünïcödé — “quotes” 中文 \U0001f600 x"
    again = {r["doc_id"]: r["text"] for r in periodic.rewritten(messy).collect()}
    assert again[9] == "one" and again[2] == "" and len(again) == len(by)


def test_op12(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    vectors = {r["vec_id"]: r["embedding"] for r in table.collect() if r["embedding"] is not None}
    good = {i: v for i, v in vectors.items() if all(c is not None and np.isfinite(c) for c in v)}
    x = {i: [int(np.floor(1024 * c)) + 100_000 for c in v] for i, v in good.items()}
    n, total = len(x), [sum(c) for c in zip(*x.values(), strict=True)]
    deep = np.array(list(x.values()), np.longdouble)
    centred = deep - deep.mean(axis=0)
    cov = (centred.T @ centred / n).astype(float)
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    rows = queries.op12_whitening(spark, sf_dir).collect()
    assert len(rows) == 8 * n and {r["n"] for r in rows} == {n} and len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9
    made = np.zeros((n, 8))
    at = {i: j for j, i in enumerate(x)}
    for r in rows:
        assert r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(x[r["vec_id"]], total, strict=True))
        assert abs(r["explained"] / (values[r["component"] - 1] / np.trace(cov)) - 1) < 1e-9
        made[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    want = centred.astype(float) @ vecs[:, :8] / np.sqrt(values[:8])
    assert np.abs(np.abs(want) - np.abs(made)).max() < 1e-7
    assert np.abs(np.cov(made.T, bias=True) - np.eye(8)).max() < 1e-9


def test_merging_is_exact_far_from_zero():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 50, (4000, 5)) + 10**9
    state = None
    for part in np.array_split(rows, 37):
        state = whitening.merge(state, whitening.state_of(part))
    centred = rows - 10**9
    assert state[0] == 4000 and state[1].tolist() == rows.sum(axis=0).tolist()
    assert np.allclose(state[3], np.cov(centred.T, bias=True) * 4000, rtol=0, atol=1e-9 * state[3].max())
    wide = whitening.from_mean(np.array([[2**51, 0]]), (10**6, np.array([5, 7], object), np.zeros(2), np.zeros((2, 2))))
    assert whitening.square_sums(wide) == [(10**6 * 2**51 - 5) ** 2 + 49]


def test_whitening_of_odd_rows(spark):
    kinds = "vec_id long, embedding array<float>, component string, w string"
    rows = [(1, [1.0, 2.0, 5.0]), (1, [1.0, 2.0, 5.0]), (None, [2.0, 4.0, 5.0]), (4, [3.0, 1.0, 5.0]), (5, None), (6, [1.0, None, 2.0]), (7, [float("nan"), 0.0, 0.0]), (8, [float("inf"), 0.0, 0.0]), (9, []), (10, [1.0])]
    table = spark.createDataFrame([(*r, "z", "z") for r in rows], kinds).repartition(3)
    got = whitening.whiten(table).collect()
    assert Counter(r["vec_id"] for r in got) == {1: 6, None: 3, 4: 3}
    assert {r["component"] for r in got if r["whitened"] is None} == {3} and got[0]["n"] == 4 and got[0]["identity_error"] < 1e-12
    assert whitening.whiten(table.where("false")).collect() == []
    alone = whitening.whiten(table.where("vec_id = 4")).collect()
    assert len(alone) == 3 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 for r in alone)


def test_op13_keeps_prose_and_drops_junk(spark, sf_dir):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op13_quality_rules(spark, sf_dir).collect()
    judged = Counter((labels[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in labels and r["n_words"] >= 20)
    assert judged[1, True] >= 0.99 * (judged[1, True] + judged[1, False])
    assert judged[0, False] >= 0.9 * (judged[0, True] + judged[0, False])


@pytest.mark.parametrize(
    ("line", "rule"),
    [
        ("The quick brown fox jumps over the dog.", None), ("Home | News | Sports | Weather | About", "navigation"), ("Next » Previous", "navigation"), ("BUY NOW!! CHEAP!! STUFF!! HERE!! TODAY!!", "shouting"),
        ("so so so so it it it it goes goes goes.", "stuttering"), ("a### b*** c$$$ d&&& word.", "symbols"), ("All rights reserved.", "boilerplate"), ("a heading without an end", "punctuation"), ("AT&T paid $5 for 10% of it.", None), ("Er sagte: „So ist es.“", None),
        ("Was NASA there when the USA won?", None), ("Contact", "navigation"), ("中文句子在这里。", None),
    ],
)
def test_line_rules(spark, line, rule):
    row = quality.clean(spark.createDataFrame([(1, f"{line}\n\nOne more sentence is here.")], "doc_id long, text string")).first()
    assert {name: row[f"lines_{name}"] for name in quality.RULES} == {name: int(name == rule) for name in quality.RULES}
    assert row["cleaned"] == ("One more sentence is here." if rule else f"{line}\nOne more sentence is here.")


def test_quality_messy(messy, empty, spark):
    got = quality.clean(messy)
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == messy.count() and quality.clean(empty).count() == 0
    assert by[2]["n_words"] == 0 and by[2]["base_failed"] and not by[2]["kept"] and by[2]["cleaned"] == ""
    assert by[5]["n_repeat_words"] == 12000 and by[5]["base_failed"]
    assert by[11]["word_chars"] == len("Ünïcödé—“quotes”中文\U0001f600x")
    lines = "\n".join(["A line that is there twice in a text.", "Other words stand in this one, all told once.", "A line that is there twice in a text.", " \t", " ".join(f"word{i}" for i in range(40)) + "."])
    row = quality.clean(spark.createDataFrame([(1, lines)], "doc_id long, text string")).first()
    assert row["n_dup_lines"] == 1 and row["lines_repeated"] == 1 and row["kept"] and row["n_repeat_words"] == 18 and "\n".join(lines.split("\n")[:2] + lines.split("\n")[4:]) == row["cleaned"]
