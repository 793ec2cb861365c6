"""Models whose fitted parameters have a closed form, so that SQL can check them."""

from pyspark.ml import classification as mc
from pyspark.ml import feature as mf
from pyspark.ml import regression as mr
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")  # fixed values: order priorities


def habits(t: Tables, kind: str) -> DataFrame:
    """Per customer the segment and how many orders of each priority, or whether any. One row per customer."""
    counts = [F.count_if(F.col("o_orderpriority") == p).cast("double") for p in PRIORITIES]
    shown = [F.least(c, F.lit(1.0)) for c in counts] if kind == "bernoulli" else counts
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.groupBy("c_custkey", "c_mktsegment").agg(F.array(*shown).alias("x"))
    labelled = mf.StringIndexer(inputCol="c_mktsegment", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
    return workspace.stored(labelled.transform(rows).select("label", "c_mktsegment", array_to_vector("x").alias("features")), f"habits-{kind}")


def naive_bayes(t: Tables, kind: str) -> DataFrame:
    """(segment, priority, theta): the fitted log chances. A row per class and feature."""
    rows = habits(t, kind)
    theta = mc.NaiveBayes(modelType=kind, smoothing=1.0).fit(rows).theta.toArray()
    names = [r[0] for r in rows.groupBy("label").agg(F.min("c_mktsegment").alias("name")).orderBy("label").select("name").collect()]
    found = [(s, p, float(theta[i][j])) for i, s in enumerate(names) for j, p in enumerate(PRIORITIES)]
    return t.spark.createDataFrame(found, "segment string, priority string, theta double").withColumn("theta", F.round("theta", 8))


_PAIRS = """s AS (SELECT DISTINCT c_mktsegment AS segment FROM customer JOIN orders ON o_custkey = c_custkey),
  p AS (SELECT * FROM (VALUES ('1-URGENT'), ('2-HIGH'), ('3-MEDIUM'), ('4-NOT SPECIFIED'), ('5-LOW')) v(priority))"""


@query(
    "ml_naive_bayes_multinomial",
    f"""WITH {_PAIRS}, n AS (SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
        a AS (SELECT segment, priority, coalesce(n, 0) AS n FROM s CROSS JOIN p LEFT JOIN n USING (segment, priority))
        SELECT segment, priority, round(ln((n + 1.0) / (sum(n) OVER (PARTITION BY segment) + 5.0)), 8) AS theta FROM a""",
)
def ml_naive_bayes_multinomial(t: Tables) -> DataFrame:
    return naive_bayes(t, "multinomial")


@query(
    "ml_naive_bayes_bernoulli",
    f"""WITH {_PAIRS}, k AS (SELECT c_mktsegment AS segment, o_orderpriority AS priority, count(DISTINCT c_custkey) AS n FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL),
        c AS (SELECT c_mktsegment AS segment, count(DISTINCT c_custkey) AS customers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)
        SELECT segment, priority, round(ln((coalesce(n, 0) + 1.0) / (customers + 2.0)), 8) AS theta FROM s CROSS JOIN p JOIN c USING (segment) LEFT JOIN k USING (segment, priority)""",
)
def ml_naive_bayes_bernoulli(t: Tables) -> DataFrame:
    return naive_bayes(t, "bernoulli")


# Family, link and response. With one indicator per group the fitted mean of a group is its own mean.
FAMILIES = (
    ("poisson", "log", "l_quantity"),
    ("gamma", "log", "l_extendedprice / 1000"),
    ("binomial", "logit", "CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END"),
    ("gaussian", "identity", "l_tax * 100"),
)


@query(
    "ml_glm_families",
    " UNION ALL ".join(
        f"SELECT '{family}' AS family, '{link}' AS link, l_returnflag, round(avg({y}), 3) AS mean FROM lineitem GROUP BY l_returnflag" for family, link, y in FAMILIES
    ),
)
def ml_glm_families(t: Tables) -> DataFrame:
    """Generalized linear models of four families, by their fitted mean per return flag."""
    flags = mf.StringIndexer(inputCol="l_returnflag", outputCol="flag", stringOrderType="alphabetAsc").fit(t.lineitem.select("l_returnflag"))
    coded = flags.transform(t.lineitem.select("l_returnflag", *(F.expr(y).cast("double").alias(f) for f, _, y in FAMILIES)))
    rows = mf.OneHotEncoder(inputCol="flag", outputCol="features", dropLast=False).fit(coded).transform(coded)
    rows = workspace.stored(rows, "glm")
    groups = rows.groupBy("l_returnflag").agg(F.first("features").alias("features"))
    parts = []
    for family, link, _ in FAMILIES:
        glm = mr.GeneralizedLinearRegression(family=family, link=link, labelCol=family, fitIntercept=False, tol=1e-8, maxIter=25)
        fitted = glm.fit(rows).transform(groups)
        parts.append(fitted.select(F.lit(family).alias("family"), F.lit(link).alias("link"), "l_returnflag", F.round("prediction", 3).alias("mean")))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])
