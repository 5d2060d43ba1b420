"""Secret scans with DataFrame functions only.

Base kinds are found by their patterns. The method adds spans of kind ``random``: runs of token characters whose
log-likelihood ratio between two character Markov models, one of random strings and one of ordinary identifiers, is
high. Both are trained from labelled samples by counting character pairs in Spark (ordinary ones from the words of at
most ``SAMPLE`` documents); the table of at most 68 * 68 log ratios becomes a literal. Short runs need as much evidence
in all as one of ``FULL`` characters. Of a run that meets base spans, the parts outside them are spans of their own.
Positions come from the lengths of matches and of the pieces between them.

Defined results: null text is empty; texts without finds have zero counts and empty spans; repeated rows are scanned
each; other columns are ignored (the scan) or kept (redaction).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts

# The base kinds' patterns, in the order of their spans.
ASSIGN = "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "(?<![0-9a-f])[0-9a-f]{16,}"
SHORT, FULL = 12, 20  # characters of a run or of its part outside base spans, at least; of a run that needs no more a character
RUN = f"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{SHORT},}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
WIDE = len(ALPHABET) + 1  # 0 is the start of a string
PER_CHAR = 0.6  # nats a character by which random must be likelier
SAMPLE = 400  # documents whose words are the ordinary sample, at most

_SPAN = "array<struct<start:int,kind:int,end:int>>"


def _matches(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """Spans of a pattern's leftmost non-overlapping matches that ``keep`` accepts.

    Matches and the pieces between them are zipped first: what a lambda names from outside is made again at each step.
    """
    hits, gaps = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    pairs = F.zip_with(gaps, hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), F.length(hit).alias("n"), (keep(hit) if keep else F.lit(True)).alias("good")))
    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("found"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["n"]).alias("end")))
        return F.struct((start + F.coalesce(x["n"], F.lit(0))).alias("at"), F.when(x["n"].isNotNull() & x["good"], F.concat(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.when(text.rlike(pattern), F.aggregate(pairs, begin, add, lambda acc: acc["found"])).otherwise(F.array().cast(_SPAN))


def pair_counts(samples: DataFrame) -> dict[tuple[int, int, int], int]:
    """Character pairs of (text, label) samples: (label, before, after) to count; at most 2 * 68 * 68 entries."""
    pairs = samples.select("label", F.explode(F.sequence(F.lit(1), F.length("text"))).alias("i"), "text").where("length(text) > 0")
    char = lambda i: F.expr(f"if({i} = 0, 0, locate(substring(text, {i}, 1), '{ALPHABET}'))")
    rows = pairs.select("label", char("i - 1").alias("a"), char("i").alias("b")).groupBy("label", "a", "b").count().collect()
    return {(r["label"], r["a"], r["b"]): r["count"] for r in rows}


def log_ratios(counts: dict[tuple[int, int, int], int]) -> list[float]:
    """log p(after | before, random) - log p(after | before, ordinary), add-half smoothed, by before * 68 + after."""
    out = []
    for a in range(WIDE):
        total = [sum(counts.get((label, a, b), 0) for b in range(WIDE)) for label in (0, 1)]
        for b in range(WIDE):
            p = [(counts.get((label, a, b), 0) + 0.5) / (total[label] + 0.5 * WIDE) for label in (0, 1)]
            out.append(math.log(p[1] / p[0]))
    return out


def default_samples(docs: DataFrame) -> DataFrame:
    """Label 1: digests in hexadecimal, base64 and capitals. Label 0: a bounded sample of documents' words, bare,
    joined by underscores, hyphens or slashes, and in camel case."""
    spark: SparkSession = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256)
    b64 = F.base64(F.unhex(digest))
    forms = F.array(F.substring(digest, 1, 40), b64, F.translate(b64, "+/=", "-_"), F.substring(F.translate(F.upper(b64), "+/=", "234"), 1, 20), F.upper(F.substring(digest, 1, 32)))
    strange = spark.range(3000).select(F.explode(forms).alias("text"), F.lit(1).alias("label"))
    ids = docs.select("doc_id").where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    words = texts(docs, "doc_id").join(F.broadcast(ids), "doc_id", "left_semi").select(F.expr("filter(split(text, '[^A-Za-z]+'), w -> length(w) > 1)").alias("w"))
    pairs = words.select(F.explode(F.expr("transform(sequence(0, size(w) - 2), i -> array(w[i], w[i + 1]))")).alias("p"), "w").where("size(w) > 1")
    a, b = F.col("p")[0], F.col("p")[1]
    usual = pairs.select(F.explode(F.array(a, b, F.concat_ws("_", a, b), F.concat_ws("-", a, b), F.concat_ws("/", a, b), F.concat(F.lower(a), F.initcap(b)), F.upper(a))).alias("text"), F.lit(0).alias("label"))
    return strange.unionByName(usual)


def train(docs: DataFrame) -> list[float]:
    return log_ratios(pair_counts(default_samples(docs)))


def spans(text: Column, ratios: list[float]) -> tuple[Column, Column]:
    """Base spans, and those that the Markov models add, each an array of (start, kind, end)."""
    base = F.concat(_matches(text, ASSIGN, 0, lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 12), _matches(text, ACCESS, 1), _matches(text, HEX, 2))
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")

    def strange(run: Column) -> Column:
        codes = F.transform(F.split(run, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)))
        pairs = F.zip_with(F.array_prepend(codes, F.lit(0)), codes, lambda a, b: F.when(b.isNull(), 0.0).otherwise(F.element_at(table, a * WIDE + b + 1)))
        return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x) > PER_CHAR * F.greatest(F.length(run), F.lit(FULL))

    return base, _matches(text, RUN, 3, strange)


KINDS = ("assign", "access", "hex", "random")


def find_secrets(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """Other columns of ``docs`` are dropped: doc_id, text, base and found (base and added spans, sorted)."""
    ratios = ratios or train(docs)
    base, added = spans(F.col("text"), ratios)
    return _found(texts(docs, F.col("doc_id").cast("long").alias("doc_id")), base, added)


def _apart(added: str, base: str) -> Column:
    """The parts of added spans that no base span (sorted by start) covers."""

    def parts(a: Column) -> Column:
        some = F.filter(base, lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"]))
        piece = lambda lo, hi: F.when(hi - lo >= SHORT, F.array(F.struct(lo.alias("start"), a["kind"].alias("kind"), hi.alias("end")))).otherwise(F.array().cast(_SPAN))
        begin = F.struct(a["start"].alias("at"), F.array().cast(_SPAN).alias("found"))
        step = lambda acc, b: F.struct(F.greatest(acc["at"], b["end"]).alias("at"), F.concat(acc["found"], piece(acc["at"], b["start"])).alias("found"))
        return F.aggregate(some, begin, step, lambda acc: F.concat(acc["found"], piece(acc["at"], a["end"])))

    return F.flatten(F.transform(added, parts))


def _found(rows: DataFrame, base: Column, added: Column) -> DataFrame:
    rows = rows.withColumns({"base": F.array_sort(base), "added": added})
    return rows.withColumn("found", F.array_sort(F.concat("base", _apart("added", "base")))).drop("added")


def _told(spans: str) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, ratios: list[float] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans for each row of ``docs`` (doc_id, text)."""
    rows = find_secrets(docs, ratios)
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return rows.select("doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)], F.sha2(_told("base"), 256).alias("base_sha256"), _told("found").alias("spans"))


def redact(docs: DataFrame, ratios: list[float] | None = None, mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every found span of ``text`` replaced; rows without finds stay as they are."""
    ratios = ratios or train(docs)
    base, added = spans(F.coalesce(F.col("text").cast("string"), F.lit("")), ratios)
    names = [f"_secret_{k}" for k in ("base", "added", "found")]
    rows = docs.withColumns({names[0]: F.array_sort(base), names[1]: added})
    rows = rows.withColumn(names[2], F.array_sort(F.concat(names[0], _apart(names[1], names[0]))))
    piece = lambda lo, n: F.substr(F.col("text"), lo + 1, n)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    step = lambda acc, s: F.when(
        s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["text"], piece(acc["at"], s["start"] - acc["at"]), F.lit(mask)).alias("text"))
    ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["text"].alias("text")))
    whole = F.aggregate(names[2], start, step, lambda acc: F.concat(acc["text"], F.substr(F.col("text"), acc["at"] + 1, F.length("text"))))
    return rows.withColumn("text", F.when(F.size(names[2]) > 0, whole).otherwise(F.col("text"))).drop(*names)
