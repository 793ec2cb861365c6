"""Models that are brought up to date with every batch of a stream."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.plans.metrics import assign
from farebox.registry import query
from farebox.streaming.runs import Feed, Run
from farebox.tables import SCHEMAS, Tables

PARTS = ("l_orderkey % 2 = 0", "l_orderkey % 2 = 1")


@query(
    "stream_ml_refit",
    """SELECT count(*) AS n, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem""",
)
def stream_ml_refit(t: Tables) -> DataFrame:
    """A line fitted to all rows so far, from sums that each batch adds to."""
    x, y = F.col("l_quantity"), F.col("l_extendedprice")

    def sums(batch: DataFrame, epoch: int) -> DataFrame:
        return batch.agg(
            F.count("*").alias("n"), F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"), F.sum(x * y).alias("sxy")
        )

    feed, run = Feed(t, SCHEMAS["lineitem"]), Run(t, "refit")
    for part in PARTS:
        run.per_batch(feed.add(t.lineitem.filter(part)).read(), "append", sums)
    total = run.batches().agg(*(F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "sxy")))
    slope = (F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx"))
    fitted = total.withColumn("slope", slope).withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("n"))
    return fitted.select("n", F.round("slope", 4).alias("slope"), F.round("intercept", 2).alias("intercept"))


START = ((5.0, 1.0), (25.0, 5.0), (45.0, 9.0))


def _centres_in_sql() -> str:
    """Both batches: the nearest centre of each row, then what was known (half as heavy) and the rows together."""
    rows = ", ".join(f"({k}, {x}::DOUBLE, {y}::DOUBLE, 0.0::DOUBLE)" for k, (x, y) in enumerate(START))
    parts = [f"c0 AS (SELECT * FROM (VALUES {rows}) v(cluster, x, y, weight))"]
    for b in range(2):
        parts += [
            f"""a{b} AS (SELECT px, py, arg_min(cluster, (d, cluster)) AS cluster FROM (SELECT p.*, cluster, (px - x) ** 2 + (py - y) ** 2 AS d
                 FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS px, l_discount * 100 AS py FROM lineitem WHERE l_orderkey % 2 = {b}) p, c{b}) GROUP BY l_orderkey, l_linenumber, l_partkey, px, py)""",
            f"""c{b + 1} AS (SELECT cluster, CASE WHEN w + n > 0 THEN (x * w + sx) / (w + n) ELSE x END AS x, CASE WHEN w + n > 0 THEN (y * w + sy) / (w + n) ELSE y END AS y, w + n AS weight
                 FROM (SELECT cluster, x, y, weight * 0.5 AS w, coalesce(n, 0) AS n, coalesce(sx, 0) AS sx, coalesce(sy, 0) AS sy
                       FROM c{b} LEFT JOIN (SELECT cluster, count(*) AS n, sum(px) AS sx, sum(py) AS sy FROM a{b} GROUP BY 1) USING (cluster)))""",
        ]
    return f"WITH {', '.join(parts)} SELECT CAST(cluster AS BIGINT) AS cluster, round(x, 6) AS x, round(y, 6) AS y, round(weight, 6) AS weight FROM c2"


@query("stream_kmeans_refit", _centres_in_sql())
def stream_kmeans_refit(t: Tables) -> DataFrame:
    """Centres that move with every batch; what was learned before counts half.

    The centres and their weights (k rows) are written with each batch and read back by
    the next one, so a restart goes on from the last finished batch.
    """
    decay = 0.5
    feed, run = Feed(t, SCHEMAS["lineitem"]), Run(t, "stream-kmeans")

    def before(epoch: int) -> list[tuple[float, float, float]]:
        if epoch == 0:
            return [(x, y, 0.0) for x, y in START]
        saved = t.spark.read.parquet(f"{run.out}/batch={epoch - 1}").orderBy("cluster").collect()  # k rows
        return [(row["x"], row["y"], row["weight"]) for row in saved]

    def move(batch: DataFrame, epoch: int) -> DataFrame:
        old = before(epoch)
        points = batch.select(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"))
        near = assign(F.col("x"), F.col("y"), [(x, y) for x, y, _ in old])
        sums = points.groupBy(near.alias("cluster")).agg(F.count("*").alias("n"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))
        kept = t.spark.createDataFrame([(i, x, y, w * decay) for i, (x, y, w) in enumerate(old)], "cluster bigint, x double, y double, w double")
        both = kept.join(sums, "cluster", "left").fillna(0)
        weight = F.col("w") + F.col("n")
        return both.select(
            "cluster",
            F.coalesce(F.try_divide(F.col("x") * F.col("w") + F.col("sx"), weight), F.col("x")).alias("x"),
            F.coalesce(F.try_divide(F.col("y") * F.col("w") + F.col("sy"), weight), F.col("y")).alias("y"),
            weight.alias("weight"),
        )

    for part in PARTS:
        run.per_batch(feed.add(t.lineitem.filter(part)).read(), "append", move)
    return run.last().select("cluster", *(F.round(c, 6).alias(c) for c in ("x", "y", "weight")))


#: A step of size ``STEP / sqrt(i)`` for the i-th of ``ROUNDS`` passes over a batch.
STEP, ROUNDS = 2.0, 4
WEIGHTS = ("w0", "w1", "w2")


def gradient_steps(rows: DataFrame, weights: tuple[float, ...], rounds: int = ROUNDS, step: float = STEP) -> tuple[float, ...]:
    """Weights after ``rounds`` gradient steps on ``rows`` (x1, x2, y), each from sums over all of them."""
    for i in range(1, rounds + 1):
        at = F.lit(weights[0]) + F.lit(weights[1]) * F.col("x1") + F.lit(weights[2]) * F.col("x2")
        miss = 1 / (1 + F.exp(-at)) - F.col("y")
        sums = rows.agg(F.count("*"), F.sum(miss), F.sum(miss * F.col("x1")), F.sum(miss * F.col("x2"))).first()
        if not sums[0]:
            return weights
        weights = tuple(w - step / i**0.5 * s / sums[0] for w, s in zip(weights, sums[1:]))
    return weights


def _steps_in_sql() -> str:
    """The same steps as common table expressions, one for each."""
    parts = [
        """rows AS (SELECT CAST(l_orderkey % 2 AS INT) AS batch, l_extendedprice / 50000 AS x1, l_discount AS x2,
             CASE WHEN l_extendedprice / 50000 * (1 - l_discount) > 1 THEN 1.0 ELSE 0.0 END AS y FROM lineitem)""",
        "v0 AS (SELECT 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2)",
    ]
    for k in range(2 * ROUNDS):
        size = STEP / (k % ROUNDS + 1) ** 0.5
        parts.append(
            f"""v{k + 1} AS (SELECT any_value(w0) - {size!r}::DOUBLE * sum(m) / count(*) AS w0, any_value(w1) - {size!r}::DOUBLE * sum(m * x1) / count(*) AS w1,
              any_value(w2) - {size!r}::DOUBLE * sum(m * x2) / count(*) AS w2
              FROM (SELECT *, 1 / (1 + exp(-(w0 + w1 * x1 + w2 * x2))) - y AS m FROM rows, v{k} WHERE batch = {k // ROUNDS}))"""
        )
    shown = ", ".join(f"round({w}, 8) AS {w}" for w in WEIGHTS)
    ends = " UNION ALL ".join(f"SELECT {b} AS batch, {shown} FROM v{(b + 1) * ROUNDS}" for b in range(2))
    return f"WITH {', '.join(parts)} {ends}"


@query("stream_logistic_steps", _steps_in_sql())
def stream_logistic_steps(t: Tables) -> DataFrame:
    """A logistic model that takes a few gradient steps on each batch, from the weights of the batch before.

    The weights are written as the output of the batch they belong to. A batch that runs again starts from the one
    before, so it does not step twice, and none reads rows of the past.
    """
    feed, run = Feed(t, SCHEMAS["lineitem"]), Run(t, "stream-logistic-steps")

    def learn(batch: DataFrame, epoch: int) -> DataFrame:
        start = (0.0,) * len(WEIGHTS)
        if epoch:
            start = tuple(t.spark.read.parquet(f"{run.out}/batch={epoch - 1}").select(*WEIGHTS).first())
        price = F.col("l_extendedprice") / 50000
        dear = (price * (1 - F.col("l_discount")) > 1).cast("double")
        rows = batch.select(price.alias("x1"), F.col("l_discount").alias("x2"), dear.alias("y"))
        return t.spark.createDataFrame([gradient_steps(rows, start)], "w0 double, w1 double, w2 double")

    for part in PARTS:
        run.per_batch(feed.add(t.lineitem.filter(part)).read(), "append", learn)
    return run.batches().select("batch", *(F.round(w, 8).alias(w) for w in WEIGHTS))


@query("stream_logistic_refit")
def stream_logistic_refit(t: Tables) -> DataFrame:
    """A logistic model fitted anew on all rows seen so far, with its quality per batch."""
    feed, run = Feed(t, SCHEMAS["lineitem"]), Run(t, "stream-logistic")
    inputs = VectorAssembler(inputCols=["price", "l_discount"], outputCol="features")
    chain = Pipeline(stages=[inputs, LogisticRegression(maxIter=5)])
    auc = BinaryClassificationEvaluator()
    seen = Run(t, "seen").out

    def refit(batch: DataFrame, epoch: int) -> DataFrame:
        price = F.col("l_extendedprice") / 50000
        dear = price * (1 - F.col("l_discount")) > 1
        rows = batch.select(price.alias("price"), "l_discount", dear.cast("double").alias("label"))
        rows.write.mode("overwrite").parquet(f"{seen}/batch={epoch}")
        so_far = t.spark.read.parquet(seen)
        value = auc.evaluate(chain.fit(so_far).transform(so_far))
        return so_far.agg(F.count("*").alias("n")).withColumn("area", F.lit(value))

    for part in PARTS:
        run.per_batch(feed.add(t.lineitem.filter(part)).read(), "append", refit)
    return run.batches()
