"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the triangular factor.

Three passes over the vectors, each with one small sum per task: the distinct vectors' count and sums, their centred
scatter (a matrix of dimensions by dimensions), and the covariance of what comes out, as a check. The scatter alone
reaches the driver. There, Cholesky with pivoting writes it as ``L L'`` with ``L`` triangular and of the scatter's
rank. Rotations of pairs of columns of ``L`` make all of them orthogonal (one-sided Jacobi, a round of disjoint pairs
at a time); as rotations do not change ``L L'``, the squared norms of the columns are then the eigenvalues and the
normalised columns the components. The scatter itself is never rotated, so small eigenvalues keep their digits.

Components are integers ``floor(scale * c) + shift``, so counts, sums and deviations are exact, and every covariance
is centred before anything is multiplied. Copies of a vector count once in the fit and are transformed like all rows.

Defined cases: rows whose vector is null or holds a null or a component that is not finite take no part; an entry
beyond ``MOST`` counts as ``MOST``; where vectors differ in length, those of the commonest length (of equally common
ones the longest) take part; a component without variance has no whitened value, so there are as many components as
the rank, at most ``most``; one distinct vector, or vectors of length 0, have none and give no rows; repeated rows and
null ids give rows of their own; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.vectors import finite, matrix

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
MOST = 1 << 52
#: The scatter of this many dimensions (32 MB) is what the driver and a task may hold.
MOST_DIMENSIONS = 2048
ROWS = 4096  # that are multiplied at a time
SWEEPS = 60


def integers(vectors: DataFrame) -> DataFrame:
    """vec_id and the integer vector ``x`` of the rows that take part, written once."""
    at = F.transform("embedding", lambda c: F.least(F.greatest(F.floor(c.cast("double") * SCALE), F.lit(-MOST)), F.lit(MOST)) + SHIFT)
    rows = workspace.stored(vectors.where(finite(F.col("embedding"))).select("vec_id", at.alias("x")), "whitening-rows")
    sizes = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    return rows.where(F.size("x") == (sizes[0].width if sizes else 0))


def pivoted_cholesky(scatter: np.ndarray) -> np.ndarray:
    """``L`` with ``L @ L.T == scatter``, a column for each step until no variance is left to explain."""
    left, steps = scatter.diagonal().copy(), []
    floor = 16 * len(scatter) * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)  # what rounding may leave
    for _ in range(len(scatter)):
        pivot = int(left.argmax())
        if not left[pivot] > floor:
            break
        column = scatter[:, pivot] - sum((s * s[pivot] for s in steps), np.zeros(len(scatter)))
        column /= np.sqrt(left[pivot])
        column[left == -np.inf] = 0.0  # rows that were pivots before: the factor is triangular in their order
        column[pivot] = np.sqrt(left[pivot])
        steps.append(column)
        left = np.where(left == -np.inf, left, left - column**2)
        left[pivot] = -np.inf
    return np.stack(steps, axis=1) if steps else np.zeros((len(scatter), 0))


def disjoint_pairs(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rounds in which each of ``n`` columns meets each other once, as in a tournament."""
    seats = list(range(n + n % 2))
    for _ in range(len(seats) - 1):
        half = len(seats) // 2
        pairs = [(a, b) for a, b in zip(seats[:half], reversed(seats[half:])) if max(a, b) < n]
        yield np.array([p[0] for p in pairs], int), np.array([p[1] for p in pairs], int)
        seats = [seats[0], seats[-1], *seats[1:-1]]


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The factor's columns after rotations that make them orthogonal, the longest first."""
    columns = factor.copy()
    for _ in range(SWEEPS):
        worst = 0.0
        for i, j in disjoint_pairs(columns.shape[1]):
            a, b = columns[:, i], columns[:, j]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            off = np.abs(ab) / np.sqrt(np.maximum(aa * bb, np.finfo(float).tiny))
            worst = max(worst, off.max(initial=0.0))
            with np.errstate(divide="ignore", over="ignore"):
                zeta = (bb - aa) / (2 * ab)
            t = np.where(ab == 0, 0.0, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta)))
            c = 1 / np.sqrt(1 + t * t)
            s = c * t
            columns[:, i], columns[:, j] = c * a - s * b, s * a + c * b
        if worst <= 1e-15 * max(columns.shape):
            break
    return columns[:, np.argsort(-(columns * columns).sum(0), kind="stable")]


@dataclass
class Whitener:
    """``n`` distinct vectors with sums ``S`` per dimension; eigenvalues and unit components (as columns)."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float = float("nan")

    def centred(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        return exact_centred(x, self.n, self.sums)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Whitened values of the rows of ``x``, a column for each component."""
        return (self.centred(x).astype(float) / self.n) @ (self.components / np.sqrt(self.values))


def exact_centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    most = max((abs(int(v)) for v in (x.min(initial=0), x.max(initial=0))), default=0)
    small = n * most + max(map(abs, sums), default=0) < 1 << 62
    return n * x - np.array(sums, np.int64) if small else n * x.astype(object) - np.array(sums, object)


def summed_products(rows: DataFrame, column: str, width: int, to_float) -> np.ndarray:
    """The sum of ``y' y`` over all rows, with ``y = to_float(x)``: one matrix from each task, added up by Spark."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                y = to_float(matrix(batch.column(0).slice(start, ROWS), width, np.int64))
                total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel())], ["cell", "value"])

    added = rows.select(column).mapInArrow(of, "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
    size = int(round(len(added) ** 0.5))
    out = np.zeros(size * size)
    out[added["cell"].to_numpy()] = added["value"].to_numpy()
    return out.reshape(size, size)


def fit(rows: DataFrame, most: int = COMPONENTS) -> Whitener:
    """Learn from the distinct vectors ``x`` of ``rows``."""
    distinct = workspace.stored(rows.select("x").distinct(), "whitening-distinct")
    width = (distinct.agg(F.max(F.size("x"))).first()[0]) or 0
    if width > MOST_DIMENSIONS:
        raise ValueError(f"{width} dimensions; the driver is meant to hold the scatter of {MOST_DIMENSIONS} at most")
    exact = [F.sum(F.col("x")[k].cast("decimal(20,0)")).alias(f"s{k}") for k in range(width)]
    first = distinct.agg(F.count(F.lit(1)).alias("n"), *exact).first() if width else (0,)
    n, sums = first[0], [int(v) for v in first[1:] if v is not None]
    if not n or not width:
        return Whitener(0, [], np.zeros(0), np.zeros((width, 0)), 0.0)
    scatter = summed_products(distinct, "x", width, lambda x: exact_centred(x, n, sums).astype(float) / n) / n
    rotated = jacobi(pivoted_cholesky(scatter))
    values = (rotated * rotated).sum(0)
    keep = values > 0
    found = Whitener(n, sums, values[keep][:most], (rotated[:, keep] / np.sqrt(values[keep]))[:, :most], float(scatter.trace()))
    if len(found.values):
        out = summed_products(distinct, "x", width, found) / n
        found.identity_error = float(np.abs(out - np.eye(len(out))).max())
    return found


def whiten(vectors: DataFrame, most: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation (decimal), whitened, explained, identity_error: a row for each row and component."""
    rows = integers(vectors)
    model = fit(rows, most)
    width, share = len(model.sums), (model.values / model.trace if model.trace else model.values).tolist()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = matrix(part.column(1), width, np.int64)
                apart = model.centred(x)
                reach = max(abs(int(apart.max(initial=0))), abs(int(apart.min(initial=0))))
                if reach * reach * max(width, 1) >= 1 << 62:
                    apart = apart.astype(object)
                deviation = (apart * apart).sum(axis=1) if width else np.zeros(len(x), int)
                white = model(x)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([int(d) for d in deviation], pa.decimal128(38, 0)),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]), pa.array(white.ravel())),
                    ],
                    ["vec_id", "deviation", "white"],
                )

    if not len(model.values):
        schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
        return vectors.sparkSession.createDataFrame([], schema)
    done = rows.select("vec_id", "x").mapInArrow(of, "vec_id long, deviation decimal(38,0), white array<double>")
    each = done.select("vec_id", "deviation", F.posexplode("white").alias("k", "whitened"))
    return each.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*map(F.lit, share)), F.col("k") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def judge(vectors: DataFrame) -> DataFrame:
    """``whiten`` with the deviation as a long."""
    return whiten(vectors).withColumn("deviation", F.col("deviation").cast("long"))
