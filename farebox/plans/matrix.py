"""Matrices as tables: rows of arrays, or (i, j, value) entries."""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


def partial_products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """X'X of every Arrow batch, added up over the partition: one row per pair of columns."""
    total = None
    for batch in batches:
        if len(batch):
            x = np.stack(batch["row"].to_numpy()).astype("float64")
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        i, j = np.indices(total.shape)
        yield pd.DataFrame({"i": i.ravel() + 1, "j": j.ravel() + 1, "value": total.ravel()})


#: Columns of a matrix whose Gramian (32 MB) may be decomposed on the driver.
MOST_COLUMNS = 2048


def gramian(rows: DataFrame, column: str) -> DataFrame:
    """A'A of a tall, narrow matrix given as one array per row."""
    partial = rows.select(F.col(column).alias("row")).mapInPandas(partial_products, "i int, j int, value double")
    return partial.groupBy("i", "j").agg(F.sum("value").alias("value"))


GRAM = """e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
  g AS (SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS value FROM e a JOIN e b ON a.vec_id = b.vec_id GROUP BY ALL)"""


@query("matrix_gramian", f"WITH {GRAM} SELECT i, j, round(value, 6) AS value FROM g")
def matrix_gramian(t: Tables) -> DataFrame:
    return gramian(t.embeddings, "embedding").withColumn("value", F.round("value", 6))


@query(
    "matrix_covariance",
    f"""WITH {GRAM}, m AS (SELECT i, avg(v) AS mean, count(*) AS n FROM e GROUP BY 1)
        SELECT g.i, g.j, round((value - a.n * a.mean * b.mean) / (a.n - 1), 8) AS cov FROM g JOIN m a ON g.i = a.i JOIN m b ON g.j = b.i""",
)
def matrix_covariance(t: Tables) -> DataFrame:
    """Covariance of the columns out of the Gramian and the column means (64 rows)."""
    means = t.embeddings.select(F.posexplode("embedding").alias("i", "v")).groupBy((F.col("i") + 1).alias("i")).agg(
        F.avg(F.col("v").cast("double")).alias("mean"), F.count("*").alias("n")
    )
    g = gramian(t.embeddings, "embedding")
    joined = g.join(means, "i").join(means.select(F.col("i").alias("j"), F.col("mean").alias("mean_j")), "j")
    cov = (F.col("value") - F.col("n") * F.col("mean") * F.col("mean_j")) / (F.col("n") - 1)
    return joined.select("i", "j", F.round(cov, 8).alias("cov"))


def cosines(g: DataFrame) -> DataFrame:
    norms = g.filter("i = j").select("i", F.sqrt("value").alias("norm"))
    return (
        g.filter("i < j")
        .join(norms, "i")
        .join(norms.select(F.col("i").alias("j"), F.col("norm").alias("norm_j")), "j")
        .select("i", "j", (F.col("value") / (F.col("norm") * F.col("norm_j"))).alias("cosine"))
    )


@query(
    "matrix_similarity",
    f"""WITH {GRAM} SELECT g.i, g.j, round(g.value / sqrt(a.value * b.value), 6) AS cosine FROM g
        JOIN g a ON a.i = g.i AND a.j = g.i JOIN g b ON b.i = g.j AND b.j = g.j WHERE g.i < g.j""",
)
def matrix_similarity(t: Tables) -> DataFrame:
    """Cosine of every pair of columns."""
    return cosines(gramian(t.embeddings, "embedding")).withColumn("cosine", F.round("cosine", 6))


@query("matrix_similarity_sampled")
def matrix_similarity_sampled(t: Tables, keep: float = 0.5) -> DataFrame:
    """Estimated cosines from a random half of the entries, with the worst error against the exact ones."""
    thinned = t.embeddings.select(F.transform("embedding", lambda x: x.cast("double")).alias("row"), "vec_id")
    drawn = F.transform(
        "row", lambda x, i: F.when(F.pmod(F.xxhash64("vec_id", i), F.lit(1000)) < int(keep * 1000), x / keep).otherwise(0.0)
    )
    sampled = gramian(thinned.select(drawn.alias("row")), "row").filter("i < j").withColumnRenamed("value", "dot")
    exact = gramian(t.embeddings, "embedding")
    norms = exact.filter("i = j").select("i", F.sqrt("value").alias("norm"))
    estimate = (
        sampled.join(norms, "i")
        .join(norms.select(F.col("i").alias("j"), F.col("norm").alias("norm_j")), "j")
        .select("i", "j", (F.col("dot") / (F.col("norm") * F.col("norm_j"))).alias("estimate"))
    )
    error = F.abs(F.col("estimate") - F.col("cosine"))
    return estimate.join(cosines(exact), ["i", "j"]).agg(F.count("*").alias("pairs"), F.max(error).alias("worst"), F.avg(error).alias("mean"))


def svd(rows: DataFrame, column: str, k: int, keep: list[str]) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """The k largest singular values of a tall, narrow matrix, its right factors, and one row of
    left factors (``u``) per input row.

    The Gramian has one row per pair of columns, whatever the number of rows, so it is
    decomposed on the driver; the left factors are a product with the rows, made by the tasks.
    """
    width = rows.agg(F.max(F.size(column))).first()[0] or 0
    if width > MOST_COLUMNS:
        raise ValueError(f"{width} columns; the driver is meant to hold the Gramian of {MOST_COLUMNS} at most")
    cells = gramian(rows, column).toPandas()
    square = cells.pivot(index="i", columns="j", values="value").to_numpy()
    values, vectors = np.linalg.eigh((square + square.T) / 2)
    best = np.argsort(values)[::-1][:k]
    lengths, right = np.sqrt(np.maximum(values[best], 0)), vectors[:, best]
    scaled = np.divide(right, lengths, out=np.zeros_like(right), where=lengths > 1e-12)

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x = np.stack(batch[column].to_numpy()).astype("float64")
                yield batch[keep].assign(u=list(x @ scaled))

    kept = rows.select(*keep, column)
    layout = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*keep).schema)
    return kept.mapInPandas(project, f"{layout}, u array<double>"), lengths, right


@query(
    "matrix_svd",
    "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 6) AS energy, 64 AS factors FROM embeddings",
)
def matrix_svd(t: Tables) -> DataFrame:
    """Left factors of all 64 axes; weighted by the singular values they keep each row's length."""
    left, lengths, _ = svd(t.embeddings, "embedding", 64, ["vec_id"])
    weights = F.array(*(F.lit(float(s)) for s in lengths))
    parts = F.zip_with("u", weights, lambda u, s: u * s * u * s)
    energy = F.aggregate(parts, F.lit(0.0), lambda total, x: total + x)
    return left.select("vec_id", F.round(energy, 6).alias("energy"), F.size("u").alias("factors"))


@query(
    "matrix_singular_values",
    """WITH x AS (SELECT vec_id, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
            g AS (SELECT a.i, b.i AS j, sum(a.v * b.v) AS v FROM x a JOIN x b USING (vec_id) GROUP BY ALL)
       SELECT count(DISTINCT i) AS factors, round(sum(CASE WHEN i = j THEN v END), 4) AS sum_of_squares, round(sum(v * v), 2) AS sum_of_fourths FROM g""",
)
def matrix_singular_values(t: Tables) -> DataFrame:
    """The singular values, by their second and fourth powers: the trace of the Gramian and of its square."""
    _, lengths, _ = svd(t.embeddings, "embedding", 64, ["vec_id"])
    values = t.spark.createDataFrame([(float(s),) for s in lengths], "s double")
    return values.agg(
        F.count("*").alias("factors"),
        F.round(F.sum(F.col("s") ** 2), 4).alias("sum_of_squares"),
        F.round(F.sum(F.col("s") ** 4), 2).alias("sum_of_fourths"),
    )


def multiply(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two entry tables: join on the inner index, add up per cell."""
    inner = b.select(F.col("i").alias("k"), F.col("j"), F.col("value").alias("w"))
    return (
        a.select("i", F.col("j").alias("k"), "value")
        .join(inner, "k")
        .groupBy("i", "j")
        .agg(F.sum(F.col("value") * F.col("w")).alias("value"))
    )


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "value")


def add(a: DataFrame, b: DataFrame, sign: int = 1) -> DataFrame:
    both = a.select("i", "j", "value").union(b.select("i", "j", (F.col("value") * sign).alias("value")))
    return both.groupBy("i", "j").agg(F.sum("value").alias("value"))


SUPPLY = """a AS (SELECT l_suppkey AS i, l_partkey AS j, sum(l_quantity) AS value FROM lineitem GROUP BY ALL),
  b AS (SELECT p_partkey AS i, CAST(substring(p_brand, 7) AS BIGINT) AS j, p_size::DOUBLE AS value FROM part)"""


def supply(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Quantity per (supplier, part) and size per (part, brand number)."""
    a = t.lineitem.groupBy(F.col("l_suppkey").alias("i"), F.col("l_partkey").alias("j")).agg(F.sum("l_quantity").alias("value"))
    brand = F.substring("p_brand", 7, 10).cast("bigint")
    return a, t.part.select(F.col("p_partkey").alias("i"), brand.alias("j"), F.col("p_size").cast("double").alias("value"))


@query(
    "matrix_multiply",
    f"WITH {SUPPLY} SELECT a.i, b.j, round(sum(a.value * b.value), 4) AS value FROM a JOIN b ON a.j = b.i GROUP BY ALL",
)
def matrix_multiply(t: Tables) -> DataFrame:
    a, b = supply(t)
    return multiply(a, b).withColumn("value", F.round("value", 4))


@query(
    "matrix_add",
    f"""WITH {SUPPLY}, s AS (SELECT j AS i, i AS j, value FROM b UNION ALL SELECT i, j, 2 * value FROM a UNION ALL SELECT i, j, -value FROM a)
        SELECT i, j, round(sum(value), 4) AS value FROM s GROUP BY ALL""",
)
def matrix_add(t: Tables) -> DataFrame:
    """Transpose, sum and difference."""
    a, b = supply(t)
    doubled = a.withColumn("value", F.col("value") * 2)
    return add(add(transpose(b), doubled), a, -1).withColumn("value", F.round("value", 4))
