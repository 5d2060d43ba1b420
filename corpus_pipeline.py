"""A training corpus from raw documents: each stage's rows are written and read again by the next.

Toxic documents go, one document of each group of near-duplicates stays, secrets are masked, sources are mixed to
target shares, and what is left is packed into sequences. Part of subpackage llm: deleted and left out with it.

Every stage takes documents (doc_id, text, source and whatever else) with nulls in any column, empty and very long
texts, repeated rows and no rows at all; all but the last return the same columns, extra ones as they were.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.llm import mixing, neardup, packing, secrets, toxicity
from tabularium.llm.common import materialise
from tabularium.llm.queries import tokenizer_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; null text is empty, equal texts go or stay together."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score_column(model) < toxicity.THRESHOLD)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class; texts without words and null ids stay, rows of one id leave one."""
    return neardup.keep_one(docs, words=5, threshold=0.8)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets masked in the text, and n_chars (where there is one) counted anew; null text stays null."""
    masked = secrets.redact(docs)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their source's rate and shuffled; a document's copies are equal rows."""
    return mixing.mix(docs, tell=False).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of every row, copies included, with its place in a sequence; null text is the end id alone."""
    return packing.pack(docs, tokenizer_path(), 4096)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

ORACLE_SQL = None  # a trained classifier, a similarity join and a packing: tested against plain restatements instead


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, name)
    return docs
