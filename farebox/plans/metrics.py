"""Model quality measures, density and clustering written as aggregates."""

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.scale import running_sum
from farebox.tables import Tables

# --- ranking and label sets ---------------------------------------------------------

K = 3
RANKED = """c AS (SELECT user_id, event_type, count(*) AS n, max(value) > 150 AS hit FROM events GROUP BY ALL),
  p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS pos, hit::INT AS rel FROM c),
  q AS (SELECT *, sum(rel) OVER (PARTITION BY user_id ORDER BY pos) AS hits, sum(rel) OVER (PARTITION BY user_id) AS total FROM p)"""


def ranked_types(t: Tables) -> DataFrame:
    """Per user the event types from most to least frequent, and which of them count as relevant.

    Events are reduced to one row per user and type first: a user's list has at most as
    many entries as there are types.
    """
    counts = t.events.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), (F.max("value") > 150).cast("int").alias("rel"))
    order = Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type")
    return counts.select("*", F.row_number().over(order).alias("pos"))


@query(
    "ml_rank_metrics",
    f"""WITH {RANKED}, u AS (SELECT user_id, sum(rel) FILTER (pos <= 3) / 3 AS prec,
          CASE WHEN max(total) = 0 THEN 0 ELSE sum(rel * hits / pos) / max(total) END AS ap,
          sum(rel / ln(pos + 1)) FILTER (pos <= 3) / NULLIF(sum(1 / ln(pos + 1)) FILTER (pos <= least(3, total)), 0) AS ndcg FROM q GROUP BY 1)
        SELECT count(*) AS users, round(avg(prec), 6) AS precision_at_3, round(avg(ap), 6) AS mean_avg_precision, round(avg(coalesce(ndcg, 0)), 6) AS ndcg_at_3 FROM u""",
)
def ml_rank_metrics(t: Tables) -> DataFrame:
    """Precision, mean average precision and NDCG of a ranking."""
    by_user = Window.partitionBy("user_id")
    placed = ranked_types(t).select(
        "user_id",
        "pos",
        "rel",
        F.sum("rel").over(by_user.orderBy("pos")).alias("hits"),
        F.sum("rel").over(by_user).alias("total"),
    )
    gain = 1 / F.log(F.col("pos") + 1)
    top = F.col("pos") <= K
    ideal = F.sum(F.when(F.col("pos") <= F.least(F.lit(K), F.col("total")), gain))
    users = placed.groupBy("user_id").agg(
        (F.sum(F.when(top, F.col("rel"))) / K).alias("prec"),
        F.coalesce(F.try_divide(F.sum(F.col("rel") * F.col("hits") / F.col("pos")), F.max("total")), F.lit(0.0)).alias("ap"),
        F.coalesce(F.try_divide(F.sum(F.when(top, F.col("rel") * gain)), ideal), F.lit(0.0)).alias("ndcg"),
    )
    return users.agg(
        F.count("*").alias("users"),
        F.round(F.avg("prec"), 6).alias("precision_at_3"),
        F.round(F.avg("ap"), 6).alias("mean_avg_precision"),
        F.round(F.avg("ndcg"), 6).alias("ndcg_at_3"),
    )


@query(
    "ml_multilabel_metrics",
    f"""WITH {RANKED}, u AS (SELECT user_id, count(*) FILTER (pos <= 3) AS guessed, sum(rel) AS truth, coalesce(sum(rel) FILTER (pos <= 3), 0) AS common FROM q GROUP BY 1)
        SELECT round(avg(common / guessed), 6) AS precision, round(avg(coalesce(common / NULLIF(truth, 0), 0)), 6) AS recall,
          round(avg(2.0 * common / (guessed + truth)), 6) AS f1, round(avg(common / (guessed + truth - common)), 6) AS accuracy,
          round(avg((guessed = common AND truth = common)::INT), 6) AS subset_accuracy,
          round(avg(guessed + truth - 2 * common) / 5, 6) AS hamming_loss, round(sum(common) / sum(guessed), 6) AS micro_precision FROM u""",
)
def ml_multilabel_metrics(t: Tables) -> DataFrame:
    """Guessed label sets (three most frequent types) against true ones. Sets hold event types, five at most."""
    labels = ranked_types(t).groupBy("user_id").agg(
        F.collect_set(F.when(F.col("pos") <= K, F.col("event_type"))).alias("guess"),
        F.collect_set(F.when(F.col("rel") == 1, F.col("event_type"))).alias("true"),
    )
    sizes = labels.select(
        F.size("guess").alias("g"), F.size("true").alias("r"), F.size(F.array_intersect("guess", "true")).alias("c")
    )
    g, r, c = F.col("g"), F.col("r"), F.col("c")
    return sizes.agg(
        F.round(F.avg(c / g), 6).alias("precision"),
        F.round(F.avg(F.coalesce(F.try_divide(c, r), F.lit(0.0))), 6).alias("recall"),
        F.round(F.avg(2 * c / (g + r)), 6).alias("f1"),
        F.round(F.avg(c / (g + r - c)), 6).alias("accuracy"),
        F.round(F.avg(((g == c) & (r == c)).cast("int")), 6).alias("subset_accuracy"),
        F.round(F.avg(g + r - 2 * c) / 5, 6).alias("hamming_loss"),
        F.round(F.sum(c) / F.sum(g), 6).alias("micro_precision"),
    )


# --- scores against labels ----------------------------------------------------------

SCORED = """s AS (SELECT l_quantity AS score, (l_returnflag = 'R')::INT AS label FROM lineitem)"""


def roc_area(scored: DataFrame) -> DataFrame:
    """Area under the ROC and the precision-recall curve of (score, label) rows.

    Rows are counted per score first; the running counts are built over the slots of a range
    sort, whatever the scale of the scores.
    """
    points = scored.groupBy("score").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n"))
    points = points.withColumn("all", F.lit(1)).withColumn("down", -F.col("score"))
    above = running_sum(points, ["all"], ["down"], ["p", "n"], ["tp", "fp"])
    totals = points.agg(F.sum("p").alias("pos"), F.sum("n").alias("neg"))
    row = above.withColumn("pos", totals.select("pos").scalar()).withColumn("neg", totals.select("neg").scalar())
    area = F.col("n") * (F.col("tp") - F.col("p") / 2)
    # The step before a score ends at (tp - p, fp - n); a curve starts at recall 0 with the first precision.
    before = F.coalesce(
        F.try_divide(F.col("tp") - F.col("p"), F.col("tp") - F.col("p") + F.col("fp") - F.col("n")), F.col("tp") / (F.col("tp") + F.col("fp"))
    )
    slice_pr = F.col("p") / F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")) + before) / 2
    return row.agg(
        (F.sum(area) / F.max(F.col("pos") * F.col("neg"))).alias("roc"), F.sum(slice_pr).alias("pr"), F.count("*").alias("thresholds")
    )


@query(
    "ml_evaluate",
    f"""WITH {SCORED}, g AS (SELECT score, sum(label) AS p, sum(1 - label) AS n FROM s GROUP BY 1),
        c AS (SELECT *, sum(p) OVER w AS tp, sum(n) OVER w AS fp, sum(p) OVER () AS pos, sum(n) OVER () AS neg FROM g WINDOW w AS (ORDER BY score DESC)),
        d AS (SELECT *, coalesce((tp - p) / NULLIF(tp - p + fp - n, 0), tp / (tp + fp)) AS before FROM c)
        SELECT round(sum(n * (tp - p / 2)) / max(pos * neg), 8) AS roc, round(sum(p / pos * (tp / (tp + fp) + before) / 2), 8) AS pr, count(*) AS thresholds FROM d""",
)
def ml_evaluate(t: Tables) -> DataFrame:
    """Binary measures of a score (quantity) against a label (returned or not)."""
    scored = t.lineitem.select(F.col("l_quantity").alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return roc_area(scored).select(F.round("roc", 8).alias("roc"), F.round("pr", 8).alias("pr"), "thresholds")


@query(
    "ml_evaluate_regression",
    """WITH r AS (SELECT l_extendedprice AS y, l_quantity * 1000 AS f FROM lineitem)
       SELECT round(avg(abs(y - f)), 4) AS mae, round(avg((y - f) * (y - f)), 2) AS mse, round(sqrt(avg((y - f) * (y - f))), 4) AS rmse,
         round(1 - sum((y - f) * (y - f)) / (var_pop(y) * count(*)), 6) AS r2, round(avg((f - m) * (f - m)), 2) AS explained
       FROM r, (SELECT avg(l_extendedprice) AS m FROM lineitem)""",
)
def ml_evaluate_regression(t: Tables) -> DataFrame:
    """Regression measures in one pass; the explained variance follows from sums."""
    y, f = F.col("l_extendedprice"), F.col("l_quantity") * 1000
    miss = y - f
    sums = t.lineitem.agg(
        F.avg(F.abs(miss)).alias("mae"),
        F.avg(miss * miss).alias("mse"),
        F.var_pop(y).alias("var_y"),
        F.avg(f).alias("mean_f"),
        F.var_pop(f).alias("var_f"),
        F.avg(y).alias("mean_y"),
    )
    shift = F.col("mean_f") - F.col("mean_y")
    return sums.select(
        F.round("mae", 4).alias("mae"),
        F.round("mse", 2).alias("mse"),
        F.round(F.sqrt("mse"), 4).alias("rmse"),
        F.round(1 - F.col("mse") / F.col("var_y"), 6).alias("r2"),
        F.round(F.col("var_f") + shift * shift, 2).alias("explained"),
    )


@query(
    "ml_evaluate_classes",
    """WITH m AS (SELECT o_orderstatus AS label, CASE WHEN o_totalprice < 150000 THEN 'F' WHEN o_totalprice < 350000 THEN 'O' ELSE 'P' END AS guess, count(*) AS n
                  FROM orders GROUP BY ALL),
            l AS (SELECT label, sum(n) AS truth, sum(n) FILTER (label = guess) AS tp FROM m GROUP BY 1), g AS (SELECT guess AS label, sum(n) AS guessed FROM m GROUP BY 1)
       SELECT label, round(tp / guessed, 6) AS precision, round(tp / truth, 6) AS recall, round(2.0 * tp / (guessed + truth), 6) AS f1,
         round(sum(tp) OVER () / sum(truth) OVER (), 6) AS accuracy FROM l JOIN g USING (label)""",
)
def ml_evaluate_classes(t: Tables) -> DataFrame:
    """Per-class measures from the confusion counts (nine rows)."""
    price = F.col("o_totalprice")
    guess = F.when(price < 150000, "F").when(price < 350000, "O").otherwise("P")
    cells = t.orders.groupBy(F.col("o_orderstatus").alias("label"), guess.alias("guess")).agg(F.count("*").alias("n"))
    right = F.sum(F.when(F.col("label") == F.col("guess"), F.col("n")))
    truth = cells.groupBy("label").agg(F.sum("n").alias("truth"), right.alias("tp"))
    guessed = cells.groupBy(F.col("guess").alias("label")).agg(F.sum("n").alias("guessed"))
    every = Window.partitionBy(F.lit(1))
    return truth.join(guessed, "label").select(
        "label",
        F.round(F.col("tp") / F.col("guessed"), 6).alias("precision"),
        F.round(F.col("tp") / F.col("truth"), 6).alias("recall"),
        F.round(2 * F.col("tp") / (F.col("guessed") + F.col("truth")), 6).alias("f1"),
        F.round(F.sum("tp").over(every) / F.sum("truth").over(every), 6).alias("accuracy"),
    )


# --- density ------------------------------------------------------------------------

POINTS = (0.0, 2500.0, 5000.0, 7500.0)
WIDTH = 500.0


@query(
    "ml_kernel_density",
    f"""SELECT point, round(avg(exp(-pow((c_acctbal - point) / {WIDTH}, 2) / 2) / ({WIDTH} * sqrt(2 * pi()))), 12) AS density
        FROM customer, (VALUES (0.0::DOUBLE), (2500.0), (5000.0), (7500.0)) v(point) GROUP BY 1""",
)
def ml_kernel_density(t: Tables) -> DataFrame:
    """Gaussian kernel density of balances at given points: one aggregate per point, in one pass."""
    return kernel_density(t.customer, "c_acctbal", POINTS, WIDTH).select("point", F.round("density", 12).alias("density"))


def kernel_density(df: DataFrame, column: str, points: tuple[float, ...], width: float) -> DataFrame:
    scale = 1 / (width * math.sqrt(2 * math.pi))

    def kernel(point: float):
        z = (F.col(column) - point) / width
        return F.avg(F.exp(-z * z / 2)) * scale

    sums = df.agg(*(kernel(p).alias(f"d{i}") for i, p in enumerate(points)))
    rows = F.array(*(F.struct(F.lit(p).alias("point"), F.col(f"d{i}").alias("density")) for i, p in enumerate(points)))
    return sums.select(F.inline(rows))


# --- k-means as group-bys -----------------------------------------------------------

START = ((5.0, 1.0), (15.0, 8.0), (30.0, 3.0), (45.0, 6.0))
ROUNDS = 3


def assign(x, y, centres):
    """Number of the nearest centre; the centres are a short literal list."""
    gaps = [((x - cx) * (x - cx) + (y - cy) * (y - cy)) for cx, cy in centres]
    return F.array_position(F.array(*gaps), F.least(*gaps)) - 1


def kmeans_rounds(points: DataFrame, centres, rounds: int) -> DataFrame:
    """Move each centre to the mean of its points. Per round k rows come back to the driver."""
    x, y = F.col("x"), F.col("y")
    for i in range(rounds):
        moved = points.groupBy(assign(x, y, centres).alias("cluster")).agg(
            F.count("*").alias("n"), F.avg("x").alias("cx"), F.avg("y").alias("cy")
        )
        if i + 1 < rounds:
            found = {row["cluster"]: (row["cx"], row["cy"]) for row in moved.collect()}  # k rows
            centres = tuple(found.get(c, centre) for c, centre in enumerate(centres))
    return moved


def unrolled_kmeans() -> str:
    values = ", ".join(f"({i}, {x}::DOUBLE, {y}::DOUBLE)" for i, (x, y) in enumerate(START))
    parts = [
        "p AS MATERIALIZED (SELECT l_quantity AS x, l_discount * 100 AS y, count(*) AS w FROM lineitem GROUP BY ALL)",
        f"c0 AS MATERIALIZED (SELECT * FROM (VALUES {values}) v(cluster, cx, cy))",
    ]
    for i in range(ROUNDS):
        parts.append(
            f"""a{i} AS (SELECT x, y, w, min_by(cluster, (x - cx) * (x - cx) + (y - cy) * (y - cy)) AS cluster FROM p, c{i} GROUP BY x, y, w),
            c{i + 1} AS MATERIALIZED (SELECT cluster, sum(x * w) / sum(w) AS cx, sum(y * w) / sum(w) AS cy, CAST(sum(w) AS BIGINT) AS n FROM a{i} GROUP BY 1)"""
        )
    return "WITH " + ", ".join(parts) + f" SELECT CAST(cluster AS BIGINT) AS cluster, n, round(cx, 4) AS cx, round(cy, 4) AS cy FROM c{ROUNDS}"


@query("ml_kmeans_sql", unrolled_kmeans())
def ml_kmeans_sql(t: Tables) -> DataFrame:
    """Three rounds of k-means over (quantity, discount)."""
    points = t.lineitem.select(F.col("l_quantity").alias("x"), (F.col("l_discount") * 100).alias("y"))
    moved = kmeans_rounds(points, START, ROUNDS)
    return moved.select("cluster", "n", F.round("cx", 4).alias("cx"), F.round("cy", 4).alias("cy"))
