"""User-defined functions in Python, and built-in twins where they exist.

Row functions show the surface; anything on a hot path is a pandas function on Arrow
batches. Functions over groups get bounded pieces of a group, never a whole hot key.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.scale import chunked
from farebox.tables import Tables


def price_band(price: float) -> str:
    return "high" if price >= 300_000 else "mid" if price >= 100_000 else "low"


def net_price(price: pd.Series, discount: pd.Series) -> pd.Series:
    return price * (1 - discount)


def running_scaler(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator form: set-up work before the loop runs once per task."""
    factor = 1 / 50.0
    for batch in batches:
        yield batch * factor


@query(
    "udf_scalar_python",
    """SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid' ELSE 'low' END AS band FROM orders""",
)
def udf_scalar_python(t: Tables) -> DataFrame:
    band = F.udf(price_band, "string", useArrow=True)  # values come in Arrow batches, not one by one
    return t.orders.select("o_orderkey", band("o_totalprice").alias("band"))


@query(
    "udf_scalar_pandas",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net, round(l_quantity / 50, 6) AS scaled FROM lineitem""",
)
def udf_scalar_pandas(t: Tables) -> DataFrame:
    net = F.pandas_udf(net_price, "double")
    scaled = F.pandas_udf(running_scaler, "double")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.round(net("l_extendedprice", "l_discount"), 4).alias("net"),
        F.round(scaled("l_quantity"), 6).alias("scaled"),
    )


@query(
    "udf_in_sql",
    """SELECT CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'mid' ELSE 'low' END AS band, count(*) AS n
       FROM orders WHERE o_totalprice >= 100000 GROUP BY 1""",
)
def udf_in_sql(t: Tables) -> DataFrame:
    """A registered function in the SELECT and WHERE of SQL text."""
    t.spark.udf.register("price_band", F.udf(price_band, "string", useArrow=True))
    return t.spark.sql(
        "SELECT price_band(o_totalprice) AS band, count(*) AS n FROM {orders} WHERE price_band(o_totalprice) <> 'low' GROUP BY 1",
        orders=t.orders,
    )


def centre_chunk(piece: pd.DataFrame) -> pd.DataFrame:
    return piece.assign(centred=(piece["value"] - piece["mean"]).round(4))[["event_id", "event_type", "centred"]]


@query(
    "udf_grouped_map",
    "SELECT event_id, event_type, round(value - avg(value) OVER (PARTITION BY event_type), 4) AS centred FROM events",
)
def udf_grouped_map(t: Tables) -> DataFrame:
    """Subtract the group mean. Means are built in; the function sees chunks of a group of bounded size."""
    means = t.events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    rows = t.events.select("event_id", "event_type", "value").join(means, "event_type")
    pieces = chunked(rows, ["event_type"], ["event_id"]).groupBy("event_type", "_chunk")
    return pieces.applyInPandas(centre_chunk, "event_id bigint, event_type string, centred double")


def mean_buffer(values: pd.Series) -> float:
    return float(values.sum())


@query(
    "udf_grouped_agg",
    """SELECT l_returnflag, round(avg(l_extendedprice), 4) AS udf_mean, round(avg(l_extendedprice), 4) AS built_in FROM lineitem GROUP BY 1""",
)
def udf_grouped_agg(t: Tables) -> DataFrame:
    """A mean with its own buffer: sums per chunk in Python, merged over the chunks."""
    chunk_sum = F.pandas_udf(mean_buffer, "double")
    lines = t.lineitem.select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice")
    buffers = (
        chunked(lines, ["l_returnflag"], ["l_orderkey", "l_linenumber"])
        .groupBy("l_returnflag", "_chunk")
        .agg(chunk_sum("l_extendedprice").alias("total"))
    )
    merged = buffers.groupBy("l_returnflag").agg(F.sum("total").alias("total"))
    twin = lines.groupBy("l_returnflag").agg(F.count("*").alias("n"), F.avg("l_extendedprice").alias("built_in"))
    return merged.join(twin, "l_returnflag").select(
        "l_returnflag", F.round(F.col("total") / F.col("n"), 4).alias("udf_mean"), F.round("built_in", 4).alias("built_in")
    )


def mean_of(values: pd.Series) -> float:
    return float(values.mean())


@query(
    "udf_window_agg",
    """WITH m AS (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY ALL)
       SELECT o_orderpriority, CAST(m AS DATE) AS order_month, n, round(avg(n) OVER (PARTITION BY o_orderpriority), 6) AS group_mean,
         round(avg(n) OVER (PARTITION BY o_orderpriority ORDER BY m ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS moving FROM m""",
)
def udf_window_agg(t: Tables) -> DataFrame:
    """A pandas aggregate over windows of monthly counts (one row per month and priority)."""
    mean = F.pandas_udf(mean_of, "double")
    months = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("order_month")).agg(
        F.count("*").alias("n")
    )
    whole = Window.partitionBy("o_orderpriority")
    moving = whole.orderBy("order_month").rowsBetween(-2, Window.currentRow)
    return months.select(
        "o_orderpriority",
        "order_month",
        "n",
        F.round(mean(F.col("n").cast("double")).over(whole), 6).alias("group_mean"),
        F.round(mean(F.col("n").cast("double")).over(moving), 6).alias("moving"),
    )


def batch_totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One partial row per key for every Arrow batch of the partition."""
    for batch in batches:
        totals = batch.groupby(["event_type", "part"], as_index=False).agg(n=("value", "size"), total=("value", "sum"))
        yield totals[["event_type", "part", "n", "total"]]


@query(
    "udf_map_partitions",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, TRUE AS has_part FROM events GROUP BY 1",
)
def udf_map_partitions(t: Tables) -> DataFrame:
    """A function over the batches of a partition, told its partition number."""
    rows = t.events.select("event_type", "value", F.spark_partition_id().alias("part"))
    partial = rows.mapInPandas(batch_totals, "event_type string, part int, n bigint, total double")
    return partial.groupBy("event_type").agg(
        F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), (F.min("part") >= 0).alias("has_part")
    )
