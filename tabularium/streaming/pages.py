"""The stateless part of page parsing on a stream: repaired lines and their numbers, as files arrive.

Order-dependent steps (segmentation, gating) need a whole entry and run on the landed table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabularium.functions import text as X


def repaired_lines(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """A stream of (file, text, numbers) from text files under ``path``."""
    lines = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger).text(path)
    text = X.page_repair(F.col("value"))
    return lines.select(F.col("_metadata.file_name").alias("file"), text.alias("text"), X.numbers(X.row_repair(text)).alias("numbers")).where(F.trim("text") != "")
