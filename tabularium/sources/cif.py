"""Structure files by their grammar: quoted values, text fields between semicolons, comments, and loops of any number."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A text field from a semicolon at a line's begin to the next, a comment, a quoted value that ends before white space, or a bare word.
TOKEN = re.compile(r"^;(?P<field>.*?)\n;(?=\s|\Z)|\#[^\n]*|'(?P<single>(?:[^'\n]|'(?=\S))*)'(?=\s|\Z)|\"(?P<double>(?:[^\"\n]|\"(?=\S))*)\"(?=\s|\Z)|(?P<bare>\S+)", re.M | re.S)
ITEMS = "file string, block string, loop int, row int, values map<string,string>"


def tokens(text: str) -> Iterator[tuple[bool, str]]:
    """(is it a bare word, value), without comments."""
    for m in TOKEN.finditer(text.replace("\r\n", "\n")):
        if m.lastgroup:
            yield m.lastgroup == "bare", m[m.lastgroup]


def items(text: str) -> Iterator[tuple[str | None, int | None, int, dict[str, str | None]]]:
    """(block, loop, row, values): a row without a loop for each block's own names, and the rows of its loops, numbered from 0.

    Unknown and inapplicable values (a bare ? or .) are null. A loop's last row may lack values.
    """
    block, loops, own = None, 0, {}
    names: list[str] = []  # of the open loop, or the name that waits for its value
    values: list[str | None] = []
    looped = False

    def rows() -> Iterator[tuple]:
        for row, at in enumerate(range(0, len(values), len(names) or 1)):
            yield block, loops - 1, row, dict(zip(names, values[at : at + len(names)], strict=False))

    for bare, word in tokens(text):
        low = word.lower() if bare else ""
        name = bare and word.startswith("_")
        if looped and (values and name or low == "loop_" or low.startswith("data_")):
            yield from rows()
            names, values, looped = [], [], False
        if low.startswith("data_"):
            if own:
                yield block, None, 0, own
            block, loops, own, names = word[5:], 0, {}, []
        elif low == "loop_":
            loops, names, values, looped = loops + 1, [], [], True
        elif name:
            names = [*names, word] if looped else [word]
        else:
            value = None if bare and word in "?." else word
            if looped:
                values.append(value)
            elif names:
                own[names.pop()] = value
    if looped:
        yield from rows()
    if own:
        yield block, None, 0, own


def read_items(files: DataFrame) -> DataFrame:
    """(file, block, loop, row, values) of (file, body): a row per loop row, and one with a null loop per block."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ITEMS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, body in zip(batch["file"].to_pylist(), batch["body"].to_pylist(), strict=True):
                rows = [(file, b, loop, row, list(v.items())) for b, loop, row, v in items(body or "")]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * 5, schema, strict=True)], schema=schema)

    return files.select("file", "body").mapInArrow(run, ITEMS)


def number(value: Column) -> Column:
    """A value as a number, without the uncertainty that may stand in parentheses; null if it is none."""
    return F.regexp_extract(value, r"^([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)(?:\(\d+\))?$", 1).try_cast("double")


def typed(items: DataFrame) -> DataFrame:
    """``items`` with ``numbers``, a map of the values that are numbers."""
    each = F.transform(F.map_entries("values"), lambda x: F.struct(x["key"].alias("key"), number(x["value"]).alias("value")))
    return items.withColumn("numbers", F.map_from_entries(F.filter(each, lambda x: x["value"].isNotNull())))
