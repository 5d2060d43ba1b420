"""Written tables in the folder that driver and executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; in local mode, where it may be unset, a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or f"file://{os.path.join(tempfile.gettempdir(), 'tabularium-shared')}").rstrip("/")


def fresh(spark: SparkSession, tag: str) -> str:
    """A new folder's path in the shared folder, deleted when the driver ends."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tabularium/{tag}-{uuid.uuid4().hex}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return path.toString()


def stored(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once and read back, for several outputs of one computation."""
    path = fresh(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def per_value(df: DataFrame, columns: list[str], derive: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``df`` joined with ``derive`` of its distinct values of ``columns``, of which it may drop some; nulls are values.

    The values are written before anything is derived: what is asked of a derived column would else be worked out for every
    row before rows are made distinct. They are dealt to tasks by a shuffle, whatever the input's files are.
    """
    values = stored(df.select(*columns).distinct(), "values").repartition(*columns)
    found = derive(values).withColumnsRenamed({c: f"_of_{c}" for c in columns})
    same = [df[c].eqNullSafe(found[f"_of_{c}"]) for c in columns]
    return df.join(found, same).drop(*[f"_of_{c}" for c in columns])
