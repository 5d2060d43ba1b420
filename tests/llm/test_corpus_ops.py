"""Operators over whole tables, against brute force."""

import math
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tabularium.llm import hamming, mixing, neardup, warc


def classes(texts, words, per_cent):
    sets = {i: {tuple(x) for x in zip(*[t[j:] for j in range(min(words, len(t)))], strict=False)} for i, t in ((i, (x or "").encode().lower().split()) for i, x in texts.items())}
    where, shared, top = defaultdict(list), Counter(), {i: i for i in texts}
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for at in where.values():
        shared.update(combinations(sorted(at), 2))

    def root(v):
        while top[v] != v:
            v = top[v]
        return v

    for (a, b), n in shared.items():
        if 100 * n >= per_cent * (len(sets[a]) + len(sets[b]) - n):
            x, y = root(a), root(b)
            top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in texts}


def spark_rows(df, rows):
    return df.sparkSession.createDataFrame(rows, "doc_id long, text string")


def test_near_duplicates(docs, plain, spark):
    rng = np.random.default_rng(5)
    base = [f"w{x}" for x in rng.integers(0, 5000, 200)]
    texts = dict(plain)
    for i in range(150):  # a dense group, larger than a leaf, whose members differ by up to a fifth
        own = list(base)
        for at in rng.choice(200, rng.integers(0, 9), replace=False):
            own[at] = f"n{rng.integers(0, 10**6)}"
        texts[10_000 + i] = " ".join(own)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = classes(texts, 3, 85)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(df, 3, 0.85).collect()}
    assert got == want
    assert neardup.near_duplicates(df, 3, 0.85).where("kept").count() == len({c for _, c in want.values()})


def test_near_duplicates_hidden_in_a_dense_group(spark):
    """Ten documents that link only to each other, in nodes full of ones that share their body and link to none."""
    body = [f"b{i}" for i in range(200)]
    short = set(range(150, 3010, 300))
    texts = [(i, " ".join(body + [f"o{i}x{j}" for j in range(5 if i in short else 33)])) for i in range(3010)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(df, 1, 0.85).collect()}
    assert got == {i: min(short) if i in short else i for i in range(3010)}


def test_near_duplicates_that_share_a_page_frame(spark):
    """All texts have a common run; partners share a little more and link (0.856), all others do not (0.805)."""
    body = [f"c{i}" for i in range(300)]
    texts = [(i, " ".join([*body, *[f"p{i // 2}x{j}" for j in range(10)], *[f"o{i}x{j}" for j in range(26)]])) for i in range(600)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    rows = neardup.near_duplicates(df, 3, 0.85, leaf=8).select("doc_id", "component_id").collect()
    assert all(r["component_id"] in (r["doc_id"], r["doc_id"] // 2 * 2) for r in rows)
    assert sum(r["component_id"] < r["doc_id"] for r in rows) >= 0.99 * 300


def test_near_copies_are_not_branched_deeper(spark, monkeypatch):
    """More levels don't part a group of near copies: they only multiplied its rows."""
    rng = np.random.default_rng(7)
    base, texts, went = [f"w{x}" for x in rng.integers(0, 5000, 150)], {}, {}
    for i in range(600):
        own = list(base)
        for at in rng.choice(150, rng.integers(0, 7), replace=False):
            own[at] = f"n{rng.integers(0, 10**6)}"
        texts[i] = " ".join(own)
    written = neardup.materialise

    def counting(df, tag):
        out = written(df, tag)
        if tag.startswith("rows"):
            went[tag] = out.count()
        return out

    monkeypatch.setattr(neardup, "materialise", counting)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in neardup.near_duplicates(spark_rows(spark.range(1), list(texts.items())), 3, 0.85).collect()}
    assert got == classes(texts, 3, 85)
    assert went.pop("rows") <= 600 and sum(went.values()) <= 8 * 600, went


def test_trees_follow_from_recall():
    assert neardup.trees_for(0.999, 0.85) >= neardup.trees_for(0.99, 0.85) > neardup.trees_for(0.9, 0.85, 3) >= 1


def test_near_duplicates_messy(messy, empty):
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in neardup.near_duplicates(messy).collect())
    assert (2, 0, 2, True) in got and (4, 0, 4, True) in got and (-1, 1, -1, True) in got and got.count((7, 3, 7, True)) == 2 and (8, 3, 7, False) in got and len(got) == 12
    assert neardup.near_duplicates(empty).count() == 0 and neardup.keep_one(empty).count() == 0
    left = neardup.keep_one(messy)
    clash = spark_rows(messy, [(1, "a b c d e f"), (1, "u v w x y z"), (None, "q"), (None, "q")])
    assert sorted((r["doc_id"] or -1, r["text"]) for r in neardup.keep_one(clash).collect()) == [(-1, "q"), (-1, "q"), (1, "a b c d e f")]
    assert left.columns == messy.columns and sorted(r["doc_id"] or -1 for r in left.collect()) == [-1, 1, 2, 3, 4, 5, 7, 9, 10, 11]


def test_components(spark):
    rng = np.random.default_rng(2)
    pairs = [(int(max(a, b)), int(min(a, b))) for a, b in rng.integers(0, 300, (220, 2)) if a != b] + [(1000 + i + 1, 1000 + i) for i in range(60)]
    top = {}

    def root(v):
        while top.get(v, v) != v:
            v = top[v]
        return v

    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            top[max(x, y)] = min(x, y)
    got = {r["v"]: r["root"] for r in neardup.components(spark.createDataFrame(pairs, "v long, r long")).collect()}
    every = {v for p in pairs for v in p}
    assert got == {v: root(v) for v in every if root(v) != v}


def test_mixing(docs, messy, empty, spark):
    rows = mixing.mix(docs).select("doc_id", "source", "rate", "n_copies", "copy").collect()
    assert all(0 <= r["copy"] < r["n_copies"] for r in rows) and len({(r["doc_id"], r["copy"]) for r in rows}) == len(rows)
    by = {r["source"]: r["rate"] for r in rows}
    known = {r["doc_id"]: (r["u"], r["source"]) for r in docs.select("doc_id", "source", mixing.uniform(F.col("doc_id"), F.lit(17)).alias("u")).collect()}
    counts = Counter(r["doc_id"] for r in rows)
    for i, (u, s) in known.items():
        if s in by:
            p, total, k = math.exp(-by[s]), math.exp(-by[s]), 0
            while total <= u:
                k += 1
                p *= by[s] / k
                total += p
            assert counts[i] == k
    order = [r["doc_id"] for r in rows]
    assert order != sorted(order)
    weights = spark.createDataFrame([("a", 1.0), ("zzz", 3.0), ("a", 1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(messy, weights).collect()} <= {"a"}
    odd = spark.createDataFrame([("a", 1.0), ("b", None), ("c", float("nan")), (None, -1.0)], "source string, weight double")
    assert {r["source"] for r in mixing.mix(messy, odd).collect()} <= {"a"}
    few = spark.createDataFrame([(i, "x" * 9, f"s{i}") for i in range(3000)], "doc_id long, text string, source string")
    many = mixing.mix(few.unionByName(few.withColumn("source", F.lit("s1")))).groupBy("doc_id", "source").count()
    assert 1500 < many.count() < 5000 and many.where("source <> 's1'").count() > 1000
    out = mixing.mix(messy, tell=False)
    assert set(out.columns) == set(messy.columns) and mixing.mix(empty).count() == 0
    big = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"), F.lit("s").alias("source"))
    assert abs(mixing.mix(big, budget=30.0).count() - 120_000) < 4 * math.sqrt(120_000)


def test_warc(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    more = spark.createDataFrame([(9001, None, None), (9002, "http://x.org/a?b=2&a=1", ""), (9003, "bad [url", "z"), (9003, "bad [url", "z"), (9000, "http://www.x.org/", "z"), (None, "http://n.org", "z")], "page_id long, url string, html string")
    pages = pages.unionByName(more.withColumn("seq", F.lit("extra")), allowMissingColumns=True)
    source = [(r["page_id"], r["html"] or "") for r in pages.collect()]
    first = {}
    for i, h in sorted((x for x in source if x[0] is not None)):
        first.setdefault(h, i)
    rows = warc.capture_histories(pages).collect()
    want = Counter((i, len(h.encode()), warc.sha1_base32(h.encode()), *(("response", None) if i is None or first[h] == i else ("revisit", first[h]))) for i, h in source)
    assert Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows) == want
    ordered = [(r["url_key"], r["stamp"], r["page_id"] is not None, r["page_id"] or 0) for r in sorted(rows, key=lambda r: (r["history_part"], r["history_place"]))]
    assert ordered == sorted(ordered)
    assert warc.capture_histories(pages.where("false")).count() == 0


def test_warc_orders_by_stored_urls(spark):
    rows = [(i, u, "") for i, u in enumerate(["http://a z.org/", "http://aa.org/", "http://a b.org/", "http://a\tc.org/x\r\ny", " http://b.org", "http://a\u2003y.org"])]
    rows += [(None, "http://a a.org/", "p"), (None, "http://a a.org/", "p"), (4, "http://b.org", "p")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    told = sorted(warc.ranked(warc.capture_histories(pages)).collect(), key=lambda r: r["history_rank"])
    keys = [(r["url_key"], r["stamp"], r["page_id"] is not None, r["page_id"] or 0) for r in told]
    assert keys == sorted(keys) and len(told) == len(rows) and [r["url_key"] for r in told][:3] == ["org,aa)/"] * 3


def test_loser_tree():
    rng = np.random.default_rng(4)
    for k in (0, 1, 2, 3, 7, 16):
        runs = [sorted(rng.integers(0, 50, rng.integers(0, 30)).tolist()) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(x for r in runs for x in r)


def test_top_k(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    same = spark.range(100_000, 101_001, 25).toDF("vec_id").crossJoin(df.select("embedding").limit(1))
    odd = spark.createDataFrame([(50_000_000, None), (None, [1.0] * 64), (50_000_050, []), (50_000_100, [1.0])], "vec_id long, embedding array<float>")
    df = df.select("vec_id", "embedding").unionByName(same).unionByName(odd)
    rows = [(r["vec_id"], np.array(r["embedding"]) > 0) for r in df.collect() if r["vec_id"] is not None and r["embedding"] and len(r["embedding"]) == 64]
    got = defaultdict(list)
    for r in hamming.top_k(df, k=10).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["distance"], r["neighbour_id"]))
    codes, ids = np.stack([c for _, c in rows]), np.array([i for i, _ in rows])
    for i, c in rows:
        if i % 50 == 0:
            d = (codes != c).sum(axis=1)
            assert got.pop(i) == sorted((int(x), int(j)) for x, j in zip(d, ids, strict=True) if j != i)[:10]
    assert not got
    assert hamming.top_k(df.where("false")).count() == 0


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    sizes, ids = [], {r["doc_id"] for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        if name != "packing":
            assert sorted(out.columns) == sorted(docs.columns) and dict(out.dtypes) == dict(docs.dtypes)
        docs = spark.createDataFrame(out.collect(), out.schema)
        sizes.append(docs.count())
    assert sizes[1] < sizes[0] and {r["doc_id"] for r in docs.collect()} <= ids
    assert docs.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0
    assert corpus_pipeline.run(spark, sf_dir).count() == sizes[-1]


def test_pipeline_stages_messy(messy, empty, tmp_path, spark):
    spark.createDataFrame([(1, 0), (5, 1), (5, None), (None, 1), (7, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, messy, str(tmp_path))
        assert sorted(out.columns) == sorted(messy.columns) and stage(spark, empty, str(tmp_path)).count() == 0, name
        ids = sorted(r["doc_id"] or -1 for r in out.select("doc_id").collect())
        assert name == "mixing" or set(ids) == {-1, 1, 2, 3, 4, 5, 7, 9, 10, 11} | ({8} if name != "near_duplicates" else set()), name
    hidden = messy.select("doc_id", "text", "source").where("doc_id < 3").withColumn("text", F.when(F.col("doc_id") == 1, "token = 0123456789abcdef"))
    assert sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.mask_secrets(spark, hidden, "").collect()) == [(1, "[SECRET]"), (2, None)]
    packed = corpus_pipeline.pack(spark, messy, "").collect()
    assert len({r["doc_id"] for r in packed}) == 11 and sum(r["doc_id"] == 7 for r in packed) == 2 and not corpus_pipeline.pack(spark, empty, "").count()
