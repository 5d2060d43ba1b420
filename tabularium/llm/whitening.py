"""Whitening of embeddings: exact counts, merged covariances, and a second pass that checks them.

Every partition goes through its vectors batch by batch and keeps a count, the exact sum, the mean and the centred
scatter; Chan's pairwise formula merges such states inside a task and, by treeReduce, across tasks, so no product of
uncentred numbers ever cancels. One eigendecomposition of the dimensions' covariance runs on the driver (its size is
the square of the vectors' length, whatever the number of rows). A second pass projects all rows, merges the states of
what it made the same way, and tells how far their covariance is from the identity.

Vectors are fitted as whole numbers x = floor(1024 * c) + 100000 of their entries c; n * x - S is exact, and so is
the deviation. Whole numbers are held in 64 bits where their bound shows that this is enough, and as Python's own
otherwise: the results are the same.

Defined results: rows with a null vector or a null or non-finite entry are left out, and so are vectors of another length
than the commonest (ties: the longer) and empty ones; a null id is kept; repeated rows count each; entries beyond 2^42 count as 2^42;
a deviation of 2^63 or more is null; a component without variance (eigenvalue at most dimensions * 2^-52 of the largest)
has null as ``whitened`` and no part in ``identity_error``; ``explained`` is null where nothing varies. No rows give none.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

SCALE, SHIFT, WIDEST = 1024, 100_000, 2.0**42


# Of some vectors: count, exact sum (Python's whole numbers), mean, centred scatter. States of different tasks meet, so they are plain tuples.
State = tuple[int, np.ndarray, np.ndarray, np.ndarray]


def state_of(rows: np.ndarray) -> State:
    """Of the rows of one batch."""
    mean = rows.mean(axis=0)
    centred = rows - mean
    exact = rows.sum(axis=0).astype(object) if rows.dtype.kind == "i" else np.zeros(rows.shape[1], object)
    return len(rows), exact, mean, centred.T @ centred


def merge(a: State | None, b: State | None) -> State | None:
    """Chan's formula; None is the state of no rows."""
    if a is None or b is None:
        return b if a is None else a
    (n_a, sum_a, mean_a, scatter_a), (n_b, sum_b, mean_b, scatter_b) = a, b
    share, apart = n_b / (n_a + n_b), mean_b - mean_a
    return n_a + n_b, sum_a + sum_b, mean_a + apart * share, scatter_a + scatter_b + np.outer(apart, apart) * (n_a * share)


def gathered(rows: DataFrame, column: str, matrix) -> State | None:
    """The state of all rows; ``matrix`` makes rows of numbers of an Arrow column of lists."""

    def make():
        held: list[State | None] = [None]

        def step(batch: pa.RecordBatch) -> list:
            if batch.num_rows:
                held[0] = merge(held[0], state_of(matrix(batch[column])))
            return []

        step.last = lambda: [{"state": [pickle.dumps(held[0])]}]
        return step

    states = map_rows(rows.select(column), "state binary", make).rdd.map(lambda r: pickle.loads(r["state"]))
    return states.treeReduce(merge) if states.getNumPartitions() else None


def whole_numbers(dims: int):
    """From an Arrow column of lists of ``dims`` entries to rows of x."""

    def matrix(column: pa.Array) -> np.ndarray:
        entries = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)
        return np.floor(np.clip(entries, -WIDEST, WIDEST) * SCALE).astype(np.int64) + SHIFT

    return matrix


def from_mean(x: np.ndarray, state: State) -> np.ndarray:
    """n * x - S, exact."""
    n, total, _, _ = state
    kind = np.int64 if int(np.abs(x).max(initial=0)) * n + max(map(abs, total), default=0) < 2**62 else object
    return x.astype(kind) * n - total.astype(kind)


def square_sums(apart: np.ndarray) -> list[int]:
    """The sum of squares of each row, exact."""
    if apart.shape[1] * int(np.abs(apart).max(initial=0)) ** 2 >= 2**63:
        apart = apart.astype(object)
    return (apart * apart).sum(axis=1).tolist()


def components(state: State, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Unit eigenvectors as columns, their eigenvalues, their shares, and which have variance; largest entries positive."""
    cov = state[3] / state[0]
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:most]
    values, vectors, trace = values[order], vectors[:, order], np.trace(cov)
    lead = np.take_along_axis(vectors, np.abs(vectors).argmax(axis=0)[None], axis=0)
    varies = values > max(values.max(initial=0.0), 0) * len(cov) * 2.0**-52
    return vectors * np.sign(lead), values, values / trace if trace > 0 else np.full(len(values), np.nan), varies


def whiten(rows: DataFrame, most: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per vector and component."""
    inf = F.lit(float("inf"))
    given = rows.select(F.col(key).alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    # Each entry is below infinity on either side; null and NaN are not.
    given = given.where(F.size("v") > 0).where(F.forall("v", lambda c: F.coalesce((c < inf) & (c > -inf), F.lit(False))))
    wide = given.groupBy(F.size("v").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    dims = wide["dims"] if wide else 1
    given = given.where(F.size("v") == dims)
    matrix = whole_numbers(dims)
    state = gathered(given, "v", matrix)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"vec_id {kind}, deviation long, w array<double>"
    if state is None:
        given, vectors, values, shares, varies, n = given.where("false"), np.zeros((dims, 0)), np.zeros(0), np.zeros(0), np.zeros(0, bool), 0
    else:
        vectors, values, shares, varies = components(state, most)
        n = state[0]
    project = vectors[:, varies] / np.sqrt(values[varies])

    def make():
        def step(batch: pa.RecordBatch) -> dict:
            apart = from_mean(matrix(batch["v"]), state)
            made = (apart / n).astype(np.float64) @ project
            return {"vec_id": batch["vec_id"], "deviation": [s if s < 2**63 else None for s in square_sums(apart)], "w": list(made)}

        return step

    made = map_rows(given, schema, make)
    error = None
    if varies.any():
        again = gathered(made, "w", lambda column: column.flatten().to_numpy().reshape(-1, int(varies.sum())))
        error = float(np.abs(again[3] / again[0] - np.eye(int(varies.sum()))).max())
    place = np.cumsum(varies) - 1
    each = [
        F.struct(F.lit(i + 1).alias("component"), (F.get("w", F.lit(int(place[i]))) if varies[i] else F.lit(None).cast("double")).alias("whitened"), F.lit(None if np.isnan(shares[i]) else float(shares[i])).cast("double").alias("explained"))
        for i in range(len(values))
    ]
    none = F.expr("cast(array() as array<struct<component:int,whitened:double,explained:double>>)")
    split = made.select("vec_id", "deviation", F.explode(F.array(*each) if each else none).alias("c"))
    return split.select("vec_id", "c.component", F.lit(n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).cast("double").alias("identity_error"))
