"""Quality classifier: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Random Fourier features z(x) = sqrt(2 / D) cos(Wx + b) approximate a Gaussian kernel over the statistics of a text.
Each task sums its own normal equations, by fold, in one pass over the labelled rows; the sums of all tasks are
added by Spark, and the driver solves systems of fixed size (D + 1). Since equations add up, the model that leaves a
fold out comes from the same sums: its scores on that fold, counted by score step, give the isotonic calibration.

Statistics are written once, a few numbers per document, and both fitting and scoring read them.

Defined cases: null and empty texts have all-zero counts and get a score like any other; labels that are null, or of
documents that are not there, are ignored, and repeated labels count as their mean; documents that share a doc_id
share its label; a null doc_id is scored and never learned from; without labels every score is 0.5; an empty table
gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import in_small_batches, utf8, vectorized
from farebox.llm.rules import SYMBOLS, repeat_words

FEATURES = 192
KERNEL_WIDTH = 2.0
RIDGE = 1e-3
STEP = 1000  # calibration counts scores by thousandths
THRESHOLD = 0.7
SEED = 7
FOLDS = (0, 1, 3)
HELD_OUT = 2

STATISTICS = (
    "log_words",
    "word_length",
    "symbol_share",
    "exclamation_share",
    "upper_share",
    "digit_share",
    "stop_share",
    "comma_share",
    "marked_words",
    "distinct_words",
    "repeated_words",
    "lines_per_word",
    "repeated_lines",
    "closed_lines",
    "beyond_ascii",
    "longest_word",
)

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))


def statistics(text: bytes) -> list[float]:
    words, lines = text.split(), [x for x in text.split(b"\n") if x.split()]
    n, size, k = max(len(words), 1), max(len(text), 1), max(len(lines), 1)

    def count(of: bytes) -> int:
        return len(text) - len(text.translate(None, of))

    upper, lower = count(_UPPER), count(_LOWER)
    marked = sum(1 for w in words if w[-2:-1] in b"#*$%&|<>!" and w[-1:] in b"#*$%&|<>!") - sum(1 for w in words if len(w) == 1 and w in b"#*$%&<>!")
    return [
        math.log1p(len(words)),
        sum(map(len, words)) / n,
        count(SYMBOLS) / size,
        text.count(b"!") / n,
        upper / max(upper + lower, 1),
        count(_DIGIT) / size,
        text.count(b".") / n,
        text.count(b",") / n,
        marked / n,
        len(set(words)) / n,
        repeat_words(words) / n,
        len(lines) / n,
        1 - len(set(lines)) / k if lines else 0.0,
        sum(1 for x in lines if x.rstrip().endswith((b".", b"!", b"?", b":"))) / k,
        1 - len(text.translate(None, bytes(range(128, 256)))) / size,
        math.log1p(max(map(len, words), default=0)),
    ]


@vectorized("array<double>")
def statistics_of(texts: pd.Series) -> pd.Series:
    return pd.Series([statistics(t) for t in texts])


class Fourier:
    """Standardised statistics to a constant and D cosines; made from means and spreads, the same on every task."""

    def __init__(self, means: np.ndarray, spreads: np.ndarray):
        draw = np.random.default_rng(SEED)
        self.means, self.spreads = means, np.where(spreads > 1e-9, spreads, 1.0)
        self.weights = draw.normal(0, 1 / (KERNEL_WIDTH * math.sqrt(len(means))) * math.sqrt(2), (len(means), FEATURES))
        self.shifts = draw.uniform(0, 2 * math.pi, FEATURES)

    def __call__(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((rows - self.means) / self.spreads, -6, 6)
        z = math.sqrt(2 / FEATURES) * np.cos(x @ self.weights + self.shifts)
        return np.concatenate([np.ones((len(rows), 1)), z], axis=1)


def normal_equations(learned: DataFrame, fourier: Fourier) -> dict[int, tuple[np.ndarray, np.ndarray, float]]:
    """By fold: sums of zz', zy and the number of rows. A task sends one set of sums per fold."""
    size = FEATURES + 1

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for fold, part in batch.groupby("fold"):
                for start in range(0, len(part), 2048):
                    piece = part.iloc[start : start + 2048]
                    z = fourier(np.stack(piece["x"].to_numpy()))
                    zy = np.concatenate([z, piece["y"].to_numpy()[:, None]], axis=1)
                    total[int(fold)] = total.get(int(fold), 0) + z.T @ zy
        for fold, matrix in total.items():
            flat = matrix.ravel()
            yield pd.DataFrame({"fold": fold, "cell": np.arange(flat.size), "value": flat})

    added = (
        learned.mapInPandas(sums, "fold int, cell int, value double")
        .groupBy("fold", "cell")
        .agg(F.sum("value").alias("value"))
        .toPandas()  # folds x (D + 1) x (D + 2) numbers, whatever the size of the corpus
    )
    out = {}
    for fold, part in added.groupby("fold"):
        matrix = np.zeros(size * (size + 1))
        matrix[part["cell"].to_numpy()] = part["value"].to_numpy()
        matrix = matrix.reshape(size, size + 1)
        out[int(fold)] = (matrix[:, :size], matrix[:, size], matrix[0, 0])
    return out


def solve(parts: list[tuple[np.ndarray, np.ndarray, float]]) -> np.ndarray:
    a, b, n = sum(p[0] for p in parts), sum(p[1] for p in parts), sum(p[2] for p in parts)
    penalty = RIDGE * np.eye(len(b))
    penalty[0, 0] = 1e-9
    return np.linalg.solve(a / n + penalty, b / n)


def isotonic(scores: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (score, value) knots of the rising step function, one at the centre of each pool."""
    pools: list[list[float]] = []  # weight, weighted score, weighted label
    for s, n, y in zip(scores, counts, sums):
        pools.append([n, n * s, y])
        while len(pools) > 1 and pools[-2][2] / pools[-2][0] >= pools[-1][2] / pools[-1][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    return np.array([p[1] / p[0] for p in pools]), np.array([p[2] / p[0] for p in pools])


def fit(learned: DataFrame):
    """A function from an array of statistics to scores; ``learned`` has x, y (0 to 1) and fold."""
    columns = [F.col("x")[k] for k in range(len(STATISTICS))]
    first = learned.agg(
        F.count(F.lit(1)), *(f(c) for c in columns for f in (F.avg, F.stddev_pop)), F.min("y"), F.max("y")
    ).first()
    if not first[0]:
        return lambda rows: np.full(len(rows), 0.5)
    if first[-1] == first[-2]:
        return lambda rows: np.full(len(rows), float(first[-1]))
    fourier = Fourier(np.array(first[1:-2:2], float), np.array(first[2:-2:2], float))
    equations = normal_equations(learned, fourier)
    whole = solve(list(equations.values()))
    without = {f: solve([e for g, e in equations.items() if g != f] or list(equations.values())) for f in equations}

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            z = fourier(np.stack(batch["x"].to_numpy()))
            raw = np.array([row @ without[f] for row, f in zip(z, batch["fold"])])
            step = np.rint(np.clip(raw, -1, 2) * STEP).astype(int)
            yield pd.DataFrame({"step": step, "y": batch["y"]}).groupby("step").agg(n=("y", "size"), s=("y", "sum")).reset_index()

    counted = (
        learned.mapInPandas(steps, "step int, n long, s double")
        .groupBy("step")
        .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        .orderBy("step")
        .toPandas()  # at most 3001 steps
    )
    at, value = isotonic(counted["step"].to_numpy() / STEP, counted["n"].to_numpy(), counted["s"].to_numpy())
    return lambda rows: np.clip(np.interp(fourier(rows) @ whole, at, value), 0, 1)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)).cast("int")
    rows = workspace.stored(
        in_small_batches(docs).select("doc_id", fold.alias("fold"), statistics_of(utf8(F.col("text"))).alias("x")), "quality-statistics"
    )
    known = labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.avg("quality").alias("y"))
    learned = rows.where(F.col("fold").isin(*FOLDS)).join(known, "doc_id").select("x", "y", "fold")
    model = fit(workspace.stored(learned, "quality-learned"))

    @F.pandas_udf("double")
    def score(xs: pd.Series) -> pd.Series:
        return pd.Series(np.round(model(np.stack(xs.to_numpy())), 6) if len(xs) else [], dtype=float)

    held_out = F.coalesce(F.col("fold") == HELD_OUT, F.lit(False))
    scored = rows.select("doc_id", held_out.alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))
