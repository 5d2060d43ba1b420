"""Projections, splits, unions and summaries of match results."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.sources.store import stored


def reindex(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Exactly these columns (name to type), in order; missing ones are null."""
    return df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in columns.items()])


def trim_header(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def label(df: DataFrame, cases: list[tuple[str, Column]], other: str, column: str = "outcome") -> DataFrame:
    """One pass that names each row's partition: the first case that holds, nulls not holding."""
    case = F
    for name, test in cases:
        case = case.when(F.coalesce(test, F.lit(False)), F.lit(name))
    return df.withColumn(column, case.otherwise(F.lit(other)))


def stack(*frames: DataFrame) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Counts of the values that aren't null, largest first."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def range_of(key: Column, bounds: list) -> Column:
    """How many of the ordered bounds are at or below a key. Every hundredth or so is looked at first: both looks are short."""
    if not bounds:
        return F.lit(0)
    step = math.isqrt(len(bounds)) + 1
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda values: F.size(F.filter(values, lambda b: b <= key))
    part = below(F.array(*[F.lit(p[0]) for p in parts]))
    return F.when(part == 0, 0).otherwise((part - 1) * step + below(F.get(F.array(*[F.array(*map(F.lit, p)) for p in parts]), part - 1)))


def key_ranges(keys: DataFrame, key: str, total: int, rows: int = 500_000, per: int = 64) -> list:
    """Bounds that part ``total`` distinct keys into ranges of about ``rows``: quantiles of the keys with the lowest hashes,
    ``per`` for every range, so that a range of over twice ``rows`` is out of the question however many there are."""
    ranges = math.ceil(total / rows)
    if ranges < 2:
        return []
    picked = sorted(r[0] for r in keys.orderBy(F.xxhash64(key), key).limit(ranges * per).collect())
    return sorted({picked[len(picked) * i // ranges] for i in range(1, ranges)})


def batch_ids(df: DataFrame, key: str, size: int, rows: int = 500_000) -> DataFrame:
    """Distinct keys in order with their batch: consecutive slices of ``size``.

    Ranks come from counts per range, so no task sees all keys; there are as many ranges as the count of the keys asks for.
    The keys are written once and the ranges' bounds are literals: a recomputed task deals its keys as before.
    """
    keys = stored(df.select(key).where(F.col(key).isNotNull()).distinct(), "keys")
    ranged = keys.withColumn("_part", range_of(F.col(key), key_ranges(keys, key, keys.count(), rows)))
    counts = ranged.groupBy("_part").count()
    before = F.sum("count").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    offsets = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("count")
    within = F.row_number().over(W.partitionBy("_part").orderBy(key))
    placed = ranged.withColumn("_rn", within).join(offsets, "_part")
    return placed.select(key, F.floor((F.col("_before") + F.col("_rn") - 1) / size).alias("batch"))


def observed(df: DataFrame, column: str, labels: list[str]) -> tuple[DataFrame, Observation]:
    """``df``, and an observation that holds the run's report once ``df`` was written: a count of each label, of nulls and of
    other values, all taken in the pass that writes."""
    value, seen = F.col(column), Observation()
    counts = [F.count_if(value == name).alias(name) for name in labels]
    return df.observe(seen, F.count(F.lit(1)).alias("_rows"), F.count_if(value.isNull()).alias("_null"), F.count_if(~value.isin(*labels)).alias("_other"), *counts), seen


def unfinished(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key has no output yet."""
    return df.join(done.select(key).distinct(), key, "left_anti")
