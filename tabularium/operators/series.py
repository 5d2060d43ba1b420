"""Ordered series of (t, cp, s, h, g) rows per key: gates, slopes, consistency flags and audited corrections."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tabularium.functions.text import snap_digit

PLAUSIBLE = (-20.0, 900.0)
MARGIN = 5.0


def monotone_gate(df: DataFrame, key: str, order: str, t: str, s: str, g: str, t_slack: float = 0.01, g_slack: float = 1.0) -> DataFrame:
    """``df`` with ``accepted``: a row passes unless t falls behind the last accepted row's, or g rises above its g
    while its s wasn't negative. Rows with a null t, s or g are not accepted and leave the state as it was.

    The state skips rejected rows, so no lag can express it. Rows stream through in key order with a state of three
    numbers: a key of any size needs no more memory.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import BooleanType, StructType

    schema = StructType(df.schema.fields).add("accepted", BooleanType())
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys, *cols = [batch.column(batch.schema.get_field_index(c)) for c in (key, t, s, g)]
            tv, sv, gv = [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in cols]
            null = np.zeros(n, bool)
            for c in cols:
                null |= c.is_null().to_numpy(zero_copy_only=False)
            codes = keys.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            group = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])])
            # A row that follows the one before it needs no state; only keys with another one are gone through.
            off = null.copy()
            off[1:] |= (group[1:] == group[:-1]) & ((tv[1:] < tv[:-1] - t_slack) | ((sv[:-1] >= 0) & (gv[1:] > gv[:-1] + g_slack)))
            odd = np.zeros(group[-1] + 1, bool)
            odd[group[off]] = True
            odd[0] |= last is not None and last[0] == keys[0].as_py()
            out = ~odd[group]
            at = np.flatnonzero(~out)
            for i, k, gone, ti, si, gi in zip(at.tolist(), keys.take(pa.array(at)).to_pylist(), null[at].tolist(), tv[at].tolist(), sv[at].tolist(), gv[at].tolist(), strict=True):
                if last is not None and last[0] != k:
                    last = None
                if not gone and (last is None or not (ti < last[1] - t_slack or (last[2] >= 0 and gi > last[3] + g_slack))):
                    last = (k, ti, si, gi)
                    out[i] = True
            if not odd[-1]:
                last = (keys[n - 1].as_py(), float(tv[-1]), float(sv[-1]), float(gv[-1]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.bool_())], schema=arrow)

    return df.repartition(F.col(key)).sortWithinPartitions(key, order).mapInArrow(run, schema)


class Series:
    """Column expressions over one series: its rows' neighbours, slopes and tests."""

    def __init__(self, keys: list[str], order: str, t: str = "t", cp: str = "cp", s: str = "s", h: str = "h"):
        self.w = W.partitionBy(*keys).orderBy(order)
        self.all = W.partitionBy(*keys)
        self.t, self.cp, self.s, self.h = t, cp, s, h
        self.i = F.row_number().over(self.w) - 1
        self.n = F.count(F.lit(1)).over(self.all)

    def at(self, c: str | Column, k: int) -> Column:
        """A column ``k`` rows on (back if negative)."""
        return F.lag(c, -k).over(self.w) if k < 0 else F.lead(c, k).over(self.w) if k else F.col(c) if isinstance(c, str) else c

    def slopes(self, a: int, b: int, s: str | None = None) -> tuple[Column, Column]:
        """Cp from enthalpy and from entropy between rows ``a`` and ``b``; null where t doesn't rise or the value is implausible."""
        at, bt, s = self.at(self.t, a), self.at(self.t, b), s or self.s
        from_h = F.when(bt > at, 1000.0 * (self.at(self.h, b) - self.at(self.h, a)) / (bt - at))
        from_s = F.when((bt > at) & (at > 0), (self.at(s, b) - self.at(s, a)) / (F.ln(bt) - F.ln(at)))
        return tuple(F.when(x.between(*PLAUSIBLE), x) for x in (from_h, from_s))

    def trend_breaks(self, cp: str | None = None) -> Column:
        """Does the last step of cp per t differ from the one before by over 0.02 and 40 %?"""
        cp = cp or self.cp
        before, step = self.at(self.t, -1) - self.at(self.t, -2), F.col(self.t) - self.at(self.t, -1)
        was, now = (self.at(cp, -1) - self.at(cp, -2)) / before, (F.col(cp) - self.at(cp, -1)) / step
        return F.when((self.i < 2) | (before <= 0) | (step <= 0), True).otherwise(F.abs(now - was) > F.greatest(F.lit(0.02), 0.4 * F.abs(was)))

    def sign_wrong(self) -> Column:
        """A lone negative s whose opposite fits the trend of the two rows before it better."""
        s, positive = F.col(self.s), F.count_if(F.col(self.s) > 0).over(self.all)
        before = self.at(self.t, -1) - self.at(self.t, -2)
        expected = self.at(self.s, -1) + (self.at(self.s, -1) - self.at(self.s, -2)) / before * (F.col(self.t) - self.at(self.t, -1))
        better = F.when((self.i < 2) | (before <= 0), True).otherwise(F.abs(-s - expected) < F.abs(s - expected))
        return F.coalesce((s < 0) & (positive >= self.n - 1) & (positive > 0) & better, F.lit(False))

    def outside(self, cp: str, x: Column, y: Column) -> Column:
        c = F.col(cp)
        return x.isNotNull() & y.isNotNull() & ~c.between(F.least(x, y) - MARGIN, F.greatest(x, y) + MARGIN)


def _estimates(df: DataFrame, one: Series, s: str) -> DataFrame:
    """Both slopes inside (suffix _in: before and after) and at the end (suffix _out: before, and skipping one)."""
    a, b, c = one.slopes(-1, 0, s), one.slopes(0, 1, s), one.slopes(-2, 0, s)
    return df.withColumns({"_i": one.i, "_n": one.n, "_h1": a[0], "_s1": a[1], "_h2": b[0], "_s2": b[1], "_h3": c[0], "_s3": c[1]})


def _tests(one: Series, cp: str) -> tuple[Column, Column]:
    col = F.col
    inside = (col("_i") > 0) & (col("_i") < col("_n") - 1) & one.outside(cp, col("_h1"), col("_h2")) & one.outside(cp, col("_s1"), col("_s2"))
    end = (col("_i") == col("_n") - 1) & (col("_n") > 2) & one.outside(cp, col("_h1"), col("_h3")) & one.outside(cp, col("_s1"), col("_s3"))
    return F.coalesce(inside, F.lit(False)), F.coalesce(end, F.lit(False))


def _temporary(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_")])


def consistency_flags(df: DataFrame, keys: list[str], order: str, last: Column | None = None) -> DataFrame:
    """``df`` (t, cp, s, h) with cp_wrong and s_sign_wrong. ``last``: may the series' last row be tested?"""
    one = Series(keys, order)
    rows = _estimates(df, one, "s").withColumns({"_breaks": one.trend_breaks(), "s_sign_wrong": one.sign_wrong()})
    inside, end = _tests(one, "cp")
    may = F.lit(False) if last is None else last
    return _temporary(rows.withColumn("cp_wrong", inside | (end & may & F.col("_breaks"))))


def corrections(df: DataFrame, keys: list[str], order: str, last: Column | None = None) -> DataFrame:
    """``df`` with cp_fixed, s_fixed and reasons. First signs, then inner rows; then the last row, from fixed ones.

    A value is changed only if both slopes contradict it and agree with each other; at the end only to a
    single-digit change of what was printed.
    """
    one = Series(keys, order)
    col = F.col
    rows = df.withColumn("s_fixed", F.when(one.sign_wrong(), -col("s")).otherwise(col("s")))
    rows = _estimates(rows, one, "s_fixed")
    inside, end = _tests(one, "cp")
    h, s = (col("_h1") + col("_h2")) / 2, (col("_s1") + col("_s2")) / 2
    fixed = F.when(inside & (F.abs(h - s) <= MARGIN), snap_digit(col("cp"), (h + s) / 2)).otherwise(col("cp"))
    rows = rows.withColumn("_cp1", fixed)
    d1, d2 = one.at("t", -1) - one.at("t", -2), col("t") - one.at("t", -1)
    near = lambda e: 2 * e - one.at("_cp1", -1)
    wide = lambda e: (2 * e * (d1 + d2) - d1 * one.at("_cp1", -2) - (d1 + d2) * one.at("_cp1", -1)) / d2
    final = ((near(col("_h1")) + wide(col("_h3"))) / 2 + (near(col("_s1")) + wide(col("_s3"))) / 2) / 2
    rows = rows.withColumns({"_final": final, "_breaks": one.trend_breaks("_cp1")})
    may = F.lit(False) if last is None else last
    h, s = (col("_h1") + col("_h3")) / 2, (col("_s1") + col("_s3")) / 2
    sure = end & may & col("_breaks") & (F.abs(h - s) <= MARGIN)
    cp = F.when(sure, F.coalesce(snap_digit(col("_cp1"), col("_final"), fallback=False), col("_cp1"))).otherwise(col("_cp1"))
    rows = rows.withColumn("cp_fixed", cp)
    reasons = F.concat_ws(",", F.when(col("cp_fixed") != col("cp"), F.lit("Cp")), F.when(col("s_fixed") != col("s"), F.lit("S_sign")))
    return _temporary(rows.withColumn("reasons", reasons))
