"""Statistics of ranks: Kolmogorov-Smirnov and Spearman, from counts of equal values in one range sort.

Equal values are counted before anything is sorted, so ties are one row and a very common value is no task's burden;
running counts come from ``scale.running_sum``, whose slots are joined up by one offset each.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import running_sum
from farebox.tables import Tables

TERMS = 40


def value_counts(rows: DataFrame, value: str, *counts: Column) -> DataFrame:
    """(value, n, upto) of the distinct values: how many rows have it, and how many have it or a smaller one."""
    known = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"), *counts)
    names = [c for c in known.columns if c != value]
    return running_sum(known, [], [value], names, [f"{n}_upto" for n in names])


def mean_ranks(rows: DataFrame, value: str, name: str) -> DataFrame:
    """(value, name): the mean rank of each distinct value's rows."""
    return value_counts(rows, value).select(value, (F.col("n_upto") - (F.col("n") - 1) / 2).alias(name))


def spearman(rows: DataFrame, x: str, y: str) -> DataFrame:
    """rho: the correlation of mean ranks over the rows where both are known; null where one does not vary."""
    both = workspace.stored(rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(x, y).agg(F.count("*").alias("n_rows")), "spearman")
    repeated = F.col("n_rows")

    def ranked(value: str, name: str) -> DataFrame:
        known = both.groupBy(value).agg(F.sum(repeated).alias("n"))
        upto = running_sum(known, [], [value], ["n"], ["upto"])
        return upto.select(value, (F.col("upto") - (F.col("n") - 1) / 2).alias(name))

    placed = both.join(ranked(x, "a"), x).join(ranked(y, "b"), y)
    total = F.sum(repeated)
    middle = both.agg((total + 1) / 2).scalar()
    centred = placed.select("n_rows", (F.col("a") - middle).alias("a"), (F.col("b") - middle).alias("b"))  # the mean of both ranks is in the middle
    a, b = F.col("a"), F.col("b")
    sums = centred.agg(F.sum(repeated * a * b).alias("ab"), F.sum(repeated * a * a).alias("aa"), F.sum(repeated * b * b).alias("bb"), total.alias("n"))
    return sums.select("n", F.try_divide(F.col("ab"), F.sqrt(F.col("aa") * F.col("bb"))).alias("rho"))


def normal_cdf(x: Column, mean: float, sd: float) -> Column:
    """The normal distribution function, which Spark has no expression for."""

    @F.pandas_udf("double")
    def of(values: pd.Series) -> pd.Series:
        return values.map(lambda v: 0.5 * math.erfc((mean - v) / (sd * math.sqrt(2))))

    return of(x)


def kolmogorov_tail(lam: Column) -> Column:
    """The chance of a larger statistic, by Kolmogorov's series; its first terms alternate, so small values are 1."""
    terms = [F.lit(2.0 * (-1) ** (k - 1)) * F.exp(F.lit(-2.0 * k * k) * lam * lam) for k in range(1, TERMS + 1)]
    total = sum(terms[1:], terms[0])
    return F.when(lam < 0.2, 1.0).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def ks_one_sample(rows: DataFrame, value: str, cdf: Callable[[Column], Column]) -> DataFrame:
    """n, statistic and p value of the values against a distribution: the greatest distance on either side of a step."""
    counts = value_counts(rows, value)
    n = rows.where(F.col(value).isNotNull()).agg(F.count("*")).scalar()
    at = cdf(F.col(value))
    each = counts.withColumn("total", n)
    above, below = F.col("n_upto") / F.col("total") - at, at - (F.col("n_upto") - F.col("n")) / F.col("total")
    worst = each.agg(F.max(F.greatest(above, below)).alias("statistic"), F.first("total").alias("n"))
    return worst.select("n", "statistic", kolmogorov_tail(F.sqrt(F.col("n").cast("double")) * F.col("statistic")).alias("p_value"))


def ks_two_samples(rows: DataFrame, value: str, first: Column) -> DataFrame:
    """n, statistic and p value of the rows where ``first`` holds against the others."""
    counts = value_counts(rows, value, F.count_if(first).alias("a"), F.count_if(~first).alias("b"))
    known = rows.where(F.col(value).isNotNull())
    each = counts.withColumn("all_a", known.agg(F.count_if(first)).scalar()).withColumn("all_b", known.agg(F.count_if(~first)).scalar())
    apart = F.abs(F.col("a_upto") / F.col("all_a") - F.col("b_upto") / F.col("all_b"))
    worst = each.agg(F.max(apart).alias("statistic"), F.first("all_a").alias("all_a"), F.first("all_b").alias("all_b"))
    size = F.col("all_a") * F.col("all_b") / (F.col("all_a") + F.col("all_b"))
    return worst.select((F.col("all_a") + F.col("all_b")).alias("n"), "statistic", kolmogorov_tail(F.sqrt(size) * F.col("statistic")).alias("p_value"))


_TAIL = " + ".join(f"{2 * (-1) ** (k - 1)} * exp({-2 * k * k} * lam * lam)" for k in range(1, TERMS + 1))
_P = f"CASE WHEN lam < 0.2 THEN 1.0 ELSE least(greatest({_TAIL}, 0.0), 1.0) END"


@query(
    "ml_rank_tests",
    f"""WITH v AS (SELECT n_chars::DOUBLE / 1000 AS x, lang = 'en' AS en FROM documents WHERE n_chars IS NOT NULL AND lang IS NOT NULL),
         c AS (SELECT x, count(*) AS n, count(*) FILTER (en) AS a FROM v GROUP BY 1),
         u AS (SELECT x, n, sum(n) OVER w AS upto, sum(a) OVER w AS a_upto FROM c WINDOW w AS (ORDER BY x)),
         s AS (SELECT count(*) AS n, count(*) FILTER (en) AS a FROM v),
         d AS (SELECT x, upto, u.n AS here, s.n AS n, s.a AS a, a_upto, 1 - exp(-x) AS f FROM u, s),
         one AS (SELECT any_value(n) AS n, max(greatest(upto / n - f, f - (upto - here) / n)) AS statistic FROM d),
         two AS (SELECT any_value(n) AS n, any_value(a) AS a, max(abs(a_upto / a - (upto - a_upto) / (n - a))) AS statistic FROM d),
         p AS (SELECT 'lengths against exponential' AS test, n, statistic, sqrt(n) * statistic AS lam FROM one
               UNION ALL SELECT 'English lengths against others', n, statistic, sqrt(a * (n - a) / n) * statistic FROM two),
         k AS (SELECT n_chars AS x, length(coalesce(source, '')) AS y FROM documents WHERE n_chars IS NOT NULL),
         r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2 AS a, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS b FROM k)
       SELECT test, CAST(n AS BIGINT) AS n, round(statistic, 8) AS statistic, round({_P}, 8) AS p_value FROM p
       UNION ALL SELECT 'rank correlation of length and source', count(*), round(corr(a, b), 8) + 0, NULL FROM r""",
)
def ml_rank_tests(t: Tables) -> DataFrame:
    """Lengths of texts against an exponential distribution and between languages, and their rank correlation."""
    lengths = t.documents.where(F.col("n_chars").isNotNull() & F.col("lang").isNotNull())
    lengths = workspace.stored(lengths.select((F.col("n_chars").cast("double") / 1000).alias("x"), (F.col("lang") == "en").alias("en")), "rank-tests")
    one = ks_one_sample(lengths, "x", lambda x: 1 - F.exp(-x))
    two = ks_two_samples(lengths, "x", F.col("en"))
    sizes = t.documents.select(F.col("n_chars").alias("x"), F.length(F.coalesce("source", F.lit(""))).alias("y"))
    rho = spearman(sizes, "x", "y").select("n", F.col("rho").alias("statistic"), F.lit(None).cast("double").alias("p_value"))
    names = ("lengths against exponential", "English lengths against others", "rank correlation of length and source")
    parts = [
        d.select(F.lit(name).alias("test"), "n", (F.round("statistic", 8) + 0).alias("statistic"), F.round("p_value", 8).alias("p_value"))
        for name, d in zip(names, (one, two, rho))
    ]
    return parts[0].union(parts[1]).union(parts[2])
