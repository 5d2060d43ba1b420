"""A sink of one named text file per key, with commit and abort, and a manifest of what is finished.

Tasks write to folders of their own attempt; the commit moves the files of the tasks that counted into place and then tells
their names in the manifest, so a retried or speculative task leaves one copy and a failed run leaves none. Files are
reached through Arrow's file systems: the path may be local, or any store that those know. A file per key suits outputs that
people open one by one; ``sources.io.write_materials`` puts many documents into a file.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from tabularium.operators import outcomes

MANIFEST, STAGING = "_manifest", "_staging"


def store_of(path: str):
    """(file system, path in it)."""
    from pyarrow import fs

    # Spark writes a local path with one slash or with three.
    found = f"file:///{path.removeprefix('file:').lstrip('/')}" if path.startswith(("file:", "/")) else path
    return fs.FileSystem.from_uri(found)


@dataclasses.dataclass
class Written(WriterCommitMessage):
    folder: str


class NamedFilesWriter(DataSourceWriter):
    def __init__(self, path: str, ending: str):
        self.path, self.ending, self.run = path.rstrip("/"), ending, uuid.uuid4().hex

    def write(self, rows: Iterator[Row]) -> Written:
        """Rows of (stem, text), each stem once."""
        task = TaskContext.get()
        store, root = store_of(self.path)
        folder = f"{root}/{STAGING}/{self.run}/{task.partitionId()}-{task.taskAttemptId()}"
        store.create_dir(folder)
        for row in rows:
            with store.open_output_stream(f"{folder}/{row['stem']}{self.ending}") as out:
                out.write((row["text"] or "").encode())
        return Written(folder)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = store_of(self.path)
        files = [f for m in messages if m for f in store.get_file_info(fs.FileSelector(m.folder))]
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: store.move(f.path, f"{root}/{f.base_name}"), files))
        store.create_dir(f"{root}/{MANIFEST}")
        with store.open_output_stream(f"{root}/{MANIFEST}/{self.run}.txt") as out:
            out.write("".join(f"{f.base_name.removesuffix(self.ending)}\n" for f in files).encode())
        store.delete_dir(f"{root}/{STAGING}/{self.run}")

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = store_of(self.path)
        if store.get_file_info(f"{root}/{STAGING}/{self.run}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/{STAGING}/{self.run}")


class NamedFiles(DataSource):
    """Options: path, ending (with its point)."""

    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "stem string, text string"

    def writer(self, schema, overwrite: bool) -> NamedFilesWriter:
        return NamedFilesWriter(self.options["path"], self.options.get("ending", ".txt"))


def finished(spark: SparkSession, path: str) -> DataFrame:
    """(stem): the names that earlier runs told in the manifest; none if there is no manifest."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFEST}")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], "stem string")
    return spark.read.text(folder.toString()).select(F.col("value").alias("stem")).distinct()


def save(df: DataFrame, stem: Column, text: Column, order: Column, path: str, ending: str, resume: bool = False) -> None:
    """A file per stem with the text of its last row by ``order``; files that are there are replaced, or with ``resume``
    left as they are and their rows not written. Rows with a null stem are left out, a null text is an empty file."""
    spark = df.sparkSession
    each = df.select(stem.alias("stem"), F.struct(order.alias("o"), F.coalesce(text, F.lit("")).alias("text")).alias("r")).where("stem is not null")
    if resume:
        each = outcomes.unfinished(each, finished(spark, path), "stem")
    spark.dataSource.register(NamedFiles)
    each.groupBy("stem").agg(F.max("r").alias("r")).select("stem", F.col("r.text").alias("text")).write.format("named_files").mode("append").option("path", path).option("ending", ending).save()
