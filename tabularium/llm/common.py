"""What the operators of this package share: written tables, hot-key lookups, small hashes."""

from __future__ import annotations

import contextlib
import ctypes
import os
import re
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOT_KEYS = 1000  # a key is hot when it holds over 1/HOT_KEYS of the rows, so there are fewer hot keys than this
KEEP = 200_000_000  # resident bytes above which a Python worker gives freed memory back after a task
SLICE = 4_000_000  # bytes of an Arrow batch that become Python objects at a time, about


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. A temporary folder does only in local mode,
    where driver and executor are one process (tests); on a cluster the setting is required."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return (found or f"file://{os.path.join(tempfile.gettempdir(), 'tabularium-shared')}").rstrip("/")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors, computes once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tabularium/{tag}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def hot_keys(left: DataFrame, key: str, total: int) -> DataFrame:
    """The keys that hold more than 1/HOT_KEYS of ``total`` rows: fewer than HOT_KEYS, however large the table is."""
    return materialise(left.groupBy(key).count().where(F.col("count") * HOT_KEYS > max(total, HOT_KEYS)).select(key), "hot")


def lookup(left: DataFrame, right: DataFrame, key: str, total: int) -> DataFrame:
    """Left outer join to ``right`` (unique on ``key``, which is never null) that no hot key can skew.

    ``left`` must come from a written table and have ``total`` rows. Only the hot keys' right rows are broadcast, which
    are fewer than HOT_KEYS; all others are joined by shuffle, at every size.
    """
    few = F.broadcast(hot_keys(left, key, total))
    head = left.join(F.broadcast(right.join(few, key, "left_semi")), key, "left").join(few, key, "left_semi")
    return left.join(few, key, "left_anti").join(right.hint("merge"), key, "left").unionByName(head)


def texts(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns that an operator reads: ``keep`` and text, null text as empty."""
    return docs.select(*keep, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``SLICE`` bytes, or of one row where a row is longer."""
    rows = max(1, SLICE * batch.num_rows // max(batch.nbytes, 1))
    return (batch.slice(at, rows) for at in range(0, batch.num_rows, rows))


def worker_keeps(tag: str | None, make: Callable | None = None):
    """What ``make`` gives, kept for later tasks of the Python worker with this tag; what has another tag is let go."""
    held = vars(sys.modules.setdefault("_tabularium_kept", types.ModuleType("_tabularium_kept"))).setdefault("held", {})
    for other in held.keys() - {tag}:
        del held[other]
    if make and tag not in held:
        held[tag] = make()
    return held.get(tag)


def trim() -> None:
    """Give freed memory back to the system where a worker holds much: it lives on, and would keep the most it ever used."""
    with open("/proc/self/statm") if os.path.exists("/proc/self/statm") else contextlib.nullcontext(["0 0"]) as told:
        if int(next(iter(told)).split()[1]) * 4096 < KEEP:
            return
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes for this session, unless it bounds them itself."""
    for key, value in (("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE)), ("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")):
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)


def map_rows(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterator[dict] | dict]], tag: str | None = None) -> DataFrame:
    """mapInArrow: ``make`` sets up a task's state and returns a function from part of a batch to a dict of columns.

    ``tag``: what of ``worker_keeps`` the tasks use.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = to_arrow_schema(StructType.fromDDL(schema))
    small_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_keeps(tag)
        step = make()
        for batch in batches:
            for part in slices(batch):
                made = step(part)
                for cols in [made] if isinstance(made, dict) else made:
                    yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in fields], schema=fields)
        last = getattr(step, "last", None)
        for cols in last() if last else ():
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], type=f.type) for f in fields], schema=fields)
        del step, last
        trim()

    return df.mapInArrow(run, schema)


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    return x ^ (x >> np.uint64(31))


def fold_of(doc_id: F.Column, n: int) -> F.Column:
    """crc32 of the id as text, modulo n (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n
