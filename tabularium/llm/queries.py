"""The registered queries of this package: each applies its operator, with production parameters, to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import hamming, lm_nce, media, mixing, neardup, oracle, packing, periodic, pii, quality, secrets, toxicity, warc, whitening

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_nce.score_documents(_table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op3_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.document_media(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_table(spark, sf_dir, "documents"), words=3, threshold=0.85)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), 4096)


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Places in archives depend on how rows are dealt to tasks: the query tells those of the history.
    return warc.ranked(warc.capture_histories(_table(spark, sf_dir, "pages"))).drop("archive", "offset", "length")


def op10_binary_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.top_k(_table(spark, sf_dir, "embeddings"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(periodic.rewritten(_table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "start", "length", "period", F.floor(1000 * F.col("length") / F.col("period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"), "n_words",
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean(_table(spark, sf_dir, "documents"), tell=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_lm_scoring, op2_secret_scan, op3_media_columns, op4_toxicity, op5_near_duplicates, op6_packing, op7_pii, op8_mixing, op9_warc, op10_binary_search, op11_periodic_runs, op12_whitening, op13_quality_rules)
}

ORACLE_SQL: dict[str, str] = {"op5_near_duplicates": oracle.NEAR_DUPLICATES, "op8_mixing": oracle.MIXING, "op9_warc": oracle.CAPTURES, "op10_binary_search": oracle.BINARY_SEARCH, "op13_quality_rules": oracle.QUALITY}
