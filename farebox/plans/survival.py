"""Survival regression: a censored Weibull model, fitted by Newton steps with gradient and Hessian from one aggregate.

For a time t with inputs x, ``z = (ln t - b'x) / s`` and the log-likelihood is ``d (z - ln s) - exp(z)``, where d is 1
for an observed end and 0 for a time cut off. The parameters are b (an intercept first) and ln s. With s held at 1
the model is exponential, and the fitted rate of a group is its number of ends over its total time.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

MOST_STEPS = 60


def sums_at(rows: DataFrame, inputs: list[str], b: np.ndarray, log_s: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, gradient and Hessian in (b, ln s), per row, from one pass over ``rows`` (time, ended, inputs)."""
    x: list[Column] = [F.lit(1.0), *map(F.col, inputs)]
    fitted = sum((F.lit(float(v)) * c for v, c in zip(b[1:], x[1:])), F.lit(float(b[0])))
    s = math.exp(log_s)
    zed = rows.select(*inputs, F.col("ended").alias("d"), ((F.log("time") - fitted) / F.lit(s)).alias("z"))
    e, z, d = F.exp("z"), F.col("z"), F.col("d")
    k = len(x)
    by_b = [(e - d) * c / F.lit(s) for c in x]
    by_s = e * z - d * z - d
    second = {(i, j): -e * x[i] * x[j] / F.lit(s * s) for i in range(k) for j in range(i, k)}
    mixed = [-(e * z + e - d) * c / F.lit(s) for c in x]
    last = -e * z * z - (e - d) * z
    columns = [F.avg(d * (z - F.lit(log_s)) - e), *map(F.avg, by_b), F.avg(by_s), *map(F.avg, second.values()), *map(F.avg, mixed), F.avg(last)]
    got = [float(v) if v is not None else 0.0 for v in zed.agg(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()]
    hessian = np.zeros((k + 1, k + 1))
    for (i, j), v in zip(second, got[k + 2 :]):
        hessian[i, j] = hessian[j, i] = v
    hessian[:k, k] = hessian[k, :k] = got[k + 2 + len(second) : -1]
    hessian[k, k] = got[-1]
    return got[0], np.array(got[1 : k + 2]), hessian


def fit(rows: DataFrame, inputs: list[str], shape: bool = True, tol: float = 1e-10) -> tuple[np.ndarray, float]:
    """Coefficients (the intercept first) and scale of ``rows`` (time, ended, inputs); ``shape=False`` holds the scale at 1.

    Steps are halved until the likelihood rises, so the fit cannot run away from a poor start.
    """
    first = rows.agg(F.log(F.try_divide(F.sum("time"), F.sum("ended")))).first()[0]
    if first is None:
        raise ValueError("no row has ended: the model has no finite parameters")
    at = np.zeros(len(inputs) + 2)
    at[0] = first
    free = len(at) if shape else len(at) - 1
    value, gradient, hessian = sums_at(rows, inputs, at[:-1], at[-1])
    for _ in range(MOST_STEPS):
        if np.abs(gradient[:free]).max() < tol:
            break
        step = np.zeros(len(at))
        curve = -hessian[:free, :free]
        step[:free] = np.linalg.solve(curve + max(0.0, 1e-9 - np.linalg.eigvalsh(curve)[0]) * np.eye(free), gradient[:free])
        for _ in range(30):
            tried = at + step
            new = sums_at(rows, inputs, tried[:-1], tried[-1])
            if new[0] >= value - 1e-12:
                break
            step /= 2
        at, (value, gradient, hessian) = tried, new
    return at[:-1], math.exp(at[-1])


def lengths(t: Tables) -> DataFrame:
    """Lengths of the texts as times, cut off at 2,000 characters, with whether the language is English."""
    n = F.coalesce(F.length("text"), F.lit(0)) + 1
    rows = t.documents.select(
        F.least(n, F.lit(2000)).cast("double").alias("time"), (n < 2000).cast("double").alias("ended"), F.coalesce(F.col("lang") == "en", F.lit(False)).cast("double").alias("english")
    )
    return workspace.stored(rows, "survival")


_LENGTHS = """t AS (SELECT least(length(coalesce(text, '')) + 1, 2000)::DOUBLE AS time, CASE WHEN length(coalesce(text, '')) + 1 < 2000 THEN 1.0 ELSE 0.0 END AS ended,
  coalesce(lang = 'en', FALSE) AS english FROM documents)"""


def _weibull_in_sql(steps: int = 30) -> str:
    """Without inputs, the shape 1/s solves one equation; Newton steps for it as common table expressions."""
    parts = ["e AS (SELECT sum(ended) AS ends, sum(ended * ln(time)) / sum(ended) AS mean FROM t)", "k0 AS (SELECT 1.0::DOUBLE AS k)"]
    for i in range(steps):
        parts.append(
            f"""s{i} AS (SELECT k, sum(exp(k * (ln(time) - mean))) AS a, sum(exp(k * (ln(time) - mean)) * (ln(time) - mean)) AS b,
                 sum(exp(k * (ln(time) - mean)) * (ln(time) - mean) ** 2) AS c FROM t, e, k{i} GROUP BY k)"""
        )
        parts.append(f"k{i + 1} AS (SELECT k - (b / a - 1 / k) / ((c * a - b * b) / (a * a) + 1 / (k * k)) AS k FROM s{i})")
    scale = f"(SELECT ln(sum(exp(k * (ln(time) - mean))) / any_value(ends)) / any_value(k) + any_value(mean) FROM t, e, k{steps})"
    return (
        f"WITH {_LENGTHS}, {', '.join(parts)} "
        "SELECT 'exponential' AS model, 'intercept' AS parameter, round(ln(sum(time) / sum(ended)), 6) AS value FROM t "
        "UNION ALL SELECT 'exponential, by language', 'intercept', round(ln(sum(time) / sum(ended)), 6) FROM t WHERE NOT english "
        "UNION ALL SELECT 'exponential, by language', 'english', round(ln(sum(time) FILTER (english) / sum(ended) FILTER (english)) - ln(sum(time) FILTER (NOT english) / sum(ended) FILTER (NOT english)), 6) FROM t "
        f"UNION ALL SELECT 'weibull', 'intercept', round({scale}, 6) UNION ALL SELECT 'weibull', 'scale', round(1 / k, 6) FROM k{steps}"
    )


@query("ml_survival", _weibull_in_sql())
def ml_survival(t: Tables) -> DataFrame:
    """Coefficients and scale of three models of censored lengths: exponential without and with an input, and Weibull."""
    rows = lengths(t)
    plain, _ = fit(rows, [], shape=False)
    by_language, _ = fit(rows, ["english"], shape=False)
    weibull, scale = fit(rows, [])
    found = [
        ("exponential", "intercept", plain[0]),
        ("exponential, by language", "intercept", by_language[0]),
        ("exponential, by language", "english", by_language[1]),
        ("weibull", "intercept", weibull[0]),
        ("weibull", "scale", scale),
    ]
    table = t.spark.createDataFrame([(m, p, float(v)) for m, p, v in found], "model string, parameter string, value double")
    return table.withColumn("value", F.round("value", 6))
