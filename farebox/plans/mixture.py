"""Gaussian mixtures by expectation-maximisation. A round is one aggregate: weight, sums and products per component.

Only the parameters (a few numbers per component) are on the driver. Densities are compared as logarithms, and the
largest is taken off before they are added (log-sum-exp), so points far from every component keep their shares.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


@dataclass
class Component:
    """Share, mean and covariance of a component in two dimensions."""

    weight: float
    mean: tuple[float, float]
    cov: tuple[float, float, float]  # xx, xy, yy

    def log_density(self, x: Column, y: Column) -> Column:
        xx, xy, yy = self.cov
        det = xx * yy - xy * xy
        dx, dy = x - F.lit(self.mean[0]), y - F.lit(self.mean[1])
        distance = (dx * dx * F.lit(yy) - 2 * dx * dy * F.lit(xy) + dy * dy * F.lit(xx)) / F.lit(det)
        return F.lit(math.log(self.weight) - math.log(2 * math.pi) - 0.5 * math.log(det)) - distance / 2


def shares(x: Column, y: Column, components: list[Component]) -> tuple[list[Column], Column]:
    """The part that each component has in a point, and the logarithm of the point's density."""
    logs = [c.log_density(x, y) for c in components]
    top = F.greatest(*logs)
    parts = [F.exp(one - top) for one in logs]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts], top + F.log(total)


def em_round(points: DataFrame, components: list[Component], ridge: float = 0.0) -> tuple[list[Component], float]:
    """New components from one pass over ``points`` (x, y), and the log-likelihood of the old ones.

    Products are taken around the old means, so that no digits are lost for points far from zero.
    """
    x, y = F.col("x"), F.col("y")
    held, log_density = shares(x, y, components)
    names = [f"p{k}" for k in range(len(components))]
    rows = points.select("x", "y", log_density.alias("ll"), *(p.alias(n) for p, n in zip(held, names)))
    sums = [F.sum("ll").alias("ll"), F.count("*").alias("n")]
    for k, c in enumerate(components):
        p, dx, dy = F.col(names[k]), x - F.lit(c.mean[0]), y - F.lit(c.mean[1])
        sums += [F.sum(v).alias(f"{n}{k}") for n, v in (("w", p), ("sx", p * dx), ("sy", p * dy), ("xx", p * dx * dx), ("xy", p * dx * dy), ("yy", p * dy * dy))]
    found = rows.agg(*sums).first()
    if not found["n"]:
        return components, 0.0
    new = []
    for k, c in enumerate(components):
        w = found[f"w{k}"]
        if not w > 0:  # no point has a share in it any more
            new.append(c)
            continue
        mx, my = found[f"sx{k}"] / w, found[f"sy{k}"] / w
        cov = (found[f"xx{k}"] / w - mx * mx + ridge, found[f"xy{k}"] / w - mx * my, found[f"yy{k}"] / w - my * my + ridge)
        new.append(Component(w / found["n"], (c.mean[0] + mx, c.mean[1] + my), cov))
    return new, found["ll"]


ROUNDS = 6
#: Covariances get this on the diagonal, so that none becomes singular.
RIDGE = 1e-6
START = (Component(0.5, (-0.1, -0.1), (0.02, 0.0, 0.02)), Component(0.5, (0.1, 0.1), (0.02, 0.0, 0.02)))
MEASURES = ("weight", "mean_x", "mean_y", "cov_xx", "cov_xy", "cov_yy")


def _rounds_in_sql() -> str:
    """The same rounds as common table expressions; SQL takes products around zero."""
    rows = ", ".join(
        f"({k}, {c.weight}::DOUBLE, {c.mean[0]}::DOUBLE, {c.mean[1]}::DOUBLE, {c.cov[0]}::DOUBLE, {c.cov[1]}::DOUBLE, {c.cov[2]}::DOUBLE)" for k, c in enumerate(START)
    )
    parts = [
        "points AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)",
        f"m0 AS (SELECT * FROM (VALUES {rows}) v(k, w, mx, my, xx, xy, yy))",
    ]
    for r in range(ROUNDS):
        parts.append(
            f"""l{r} AS (SELECT p.*, k, ln(w) - ln(2 * pi()) - 0.5 * ln(xx * yy - xy * xy)
                 - ((x - mx) ** 2 * yy - 2 * (x - mx) * (y - my) * xy + (y - my) ** 2 * xx) / (xx * yy - xy * xy) / 2 AS l FROM points p, m{r})"""
        )
        parts.append(f"t{r} AS (SELECT *, max(l) OVER (PARTITION BY vec_id) AS top FROM l{r})")
        parts.append(f"p{r} AS (SELECT *, exp(l - top) / sum(exp(l - top)) OVER (PARTITION BY vec_id) AS p FROM t{r})")
        parts.append(
            f"""m{r + 1} AS (SELECT k, sum(p) / (SELECT count(*) FROM points) AS w, sum(p * x) / sum(p) AS mx, sum(p * y) / sum(p) AS my,
                 sum(p * x * x) / sum(p) - (sum(p * x) / sum(p)) ** 2 + {RIDGE} AS xx, sum(p * x * y) / sum(p) - sum(p * x) * sum(p * y) / sum(p) ** 2 AS xy,
                 sum(p * y * y) / sum(p) - (sum(p * y) / sum(p)) ** 2 + {RIDGE} AS yy FROM p{r} GROUP BY k)"""
        )
    shown = " UNION ALL ".join(
        f"SELECT CAST(k AS BIGINT) AS component, '{name}' AS measure, round({column}, 8) + 0 AS value FROM m{ROUNDS}"
        for name, column in zip(MEASURES, ("w", "mx", "my", "xx", "xy", "yy"))
    )
    return f"WITH {', '.join(parts)} {shown}"


@query("ml_gaussian_mixture", _rounds_in_sql())
def ml_gaussian_mixture(t: Tables) -> DataFrame:
    """Shares, means and covariances of two components over the first two dimensions of the vectors, after a few rounds."""
    points = t.embeddings.select(F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    components = list(START)
    for _ in range(ROUNDS):
        components, _ = em_round(points, components, RIDGE)
    rows = [(k, m, float(v)) for k, c in enumerate(components) for m, v in zip(MEASURES, (c.weight, *c.mean, *c.cov))]
    found = t.spark.createDataFrame(rows, "component bigint, measure string, value double")
    return found.withColumn("value", F.round("value", 8) + 0)
