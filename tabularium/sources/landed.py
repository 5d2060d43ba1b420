"""A source of landed look-up batches, each tried up to three times; a batch that fails is reported and skipped.

Batches are dealt to a few partitions for each core, however many they are: a task of its own for each costs far more than its
look-up. A partition tells its batches one by one.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tabularium.operators import outcomes
from tabularium.sources.named import store_of
from tabularium.sources.store import stored

# Keys per request, of candidates and remarks, and of structures.
KEYS, STRUCTURES = 100, 50
BATCH = "batch-{:06d}"


class LandedReader(DataSourceReader):
    def __init__(self, schema, path: str, batches: int, tries: int, wait: float, parts: int):
        self.schema, self.path, self.batches, self.tries, self.wait, self.parts = schema, path, batches, tries, wait, parts

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(range(i, self.batches, self.parts)) for i in range(min(self.parts, self.batches))]

    def fetch(self, batch: int) -> list[dict]:
        """A batch's rows, from its file of JSON lines."""
        store, root = store_of(self.path)
        with store.open_input_stream(f"{root}/{BATCH.format(batch)}.json") as found:
            return [json.loads(x) for x in found.read().decode().splitlines()]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        if partition is None:  # there are no batches
            return
        schema = to_arrow_schema(self.schema)
        for batch in partition.value:
            yield pa.RecordBatch.from_pylist(self.tried(batch), schema=schema)

    def tried(self, batch: int) -> list[dict]:
        """A batch's rows with its number, or one row that tells why the last try failed."""
        for attempt in range(self.tries):
            if attempt:
                time.sleep(self.wait)
            try:
                return [r | {"_batch": batch} for r in self.fetch(batch)]
            except (OSError, ValueError) as e:  # not there, cut off, or no JSON
                error = f"{type(e).__name__}: {e}"
        return [{"_batch": batch, "_error": error}]


class LandedBatches(DataSource):
    """Options: path, batches, tries, wait (seconds between tries), parts (partitions at most). The schema has _batch and _error at its end."""

    @classmethod
    def name(cls) -> str:
        return "landed_batches"

    def reader(self, schema) -> LandedReader:
        get = self.options.get
        return LandedReader(schema, self.options["path"], int(get("batches", "0")), int(get("tries", "3")), float(get("wait", "5")), int(get("parts", "32")))


def requests(keys: DataFrame, key: str, size: int = KEYS) -> DataFrame:
    """(key, batch): distinct keys that aren't null, ``size`` to a batch in their order."""
    return outcomes.batch_ids(keys, key, size)


def read_landed(spark: SparkSession, path: str, asked: DataFrame, schema: str, source: type[DataSource] = LandedBatches, wait: float = 5.0) -> tuple[DataFrame, DataFrame]:
    """(rows, failures) of the batches in ``asked`` (batch): rows with _batch, and (_batch, _error) of what failed three times.

    The batches are looked up once and what came is written: rows and failures are of the same tries.
    """
    last = asked.agg(F.max("batch").alias("last")).first()["last"]
    spark.dataSource.register(source)
    options = {"path": path, "batches": str(0 if last is None else last + 1), "wait": str(wait), "parts": str(4 * spark.sparkContext.defaultParallelism)}
    found = stored(spark.read.format(source.name()).schema(f"{schema}, _batch long, _error string").options(**options).load(), "looked_up")
    return found.where("_error is null").drop("_error"), found.where("_error is not null").select("_batch", "_error")
