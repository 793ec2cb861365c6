"""Window functions.

A key may hold a large part of all rows, so row-level windows run inside slots of a range
sort and are joined up by offsets or by overlapping blocks (``farebox.scale``).
Windows partitioned by a key alone only see pre-aggregated rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.scale import EXACT, in_blocks, number_rows, running_sum
from farebox.tables import Tables


@query(
    "win_ranking",
    """WITH m AS (SELECT l_returnflag AS flag, date_trunc('month', l_shipdate) AS ship_month, count(*) AS n FROM lineitem GROUP BY ALL)
       SELECT flag, CAST(ship_month AS DATE) AS ship_month, n, CAST(row_number() OVER o AS BIGINT) AS row_no, CAST(rank() OVER w AS BIGINT) AS rnk,
         CAST(dense_rank() OVER w AS BIGINT) AS dense, round(percent_rank() OVER w, 8) AS pct, round(cume_dist() OVER w, 8) AS cume,
         CAST(ntile(4) OVER o AS BIGINT) AS quarter FROM m
       WINDOW w AS (PARTITION BY flag ORDER BY n DESC), o AS (PARTITION BY flag ORDER BY n DESC, ship_month)""",
)
def win_ranking(t: Tables) -> DataFrame:
    """Months ranked by shipments; a group has one row per month."""
    months = t.lineitem.groupBy(F.col("l_returnflag").alias("flag"), F.trunc("l_shipdate", "month").alias("ship_month")).agg(
        F.count("*").alias("n")
    )
    w = Window.partitionBy("flag").orderBy(F.desc("n"))
    o = Window.orderBy(F.desc("n"), "ship_month").partitionBy("flag")
    return months.select(
        "flag",
        "ship_month",
        "n",
        F.row_number().over(o).cast("bigint").alias("row_no"),
        F.rank().over(w).cast("bigint").alias("rnk"),
        F.dense_rank().over(w).cast("bigint").alias("dense"),
        F.round(F.percent_rank().over(w), 8).alias("pct"),
        F.round(F.cume_dist().over(w), 8).alias("cume"),
        F.ntile(4).over(o).cast("bigint").alias("quarter"),
    )


@query(
    "win_row_number",
    """SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders""",
)
def win_row_number(t: Tables) -> DataFrame:
    """Position of each order in its customer's history."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return number_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query(
    "win_top_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) <= 3""",
)
def win_top_per_key(t: Tables) -> DataFrame:
    """Three dearest orders of each customer. Spark keeps the best three of each task before
    the shuffle (a group limit under the window), so a busy customer sends few rows."""
    best_first = Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), F.asc("o_orderkey"))
    orders = t.orders.select("o_custkey", "o_orderkey", "o_totalprice")
    return orders.withColumn("place", F.row_number().over(best_first)).filter("place <= 3").drop("place")


@query(
    "win_running_sum",
    """SELECT o_custkey, o_orderkey, round(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey
         ROWS UNBOUNDED PRECEDING), 2) AS spent_so_far FROM orders""",
)
def win_running_sum(t: Tables) -> DataFrame:
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    summed = running_sum(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["o_totalprice"], ["spent_so_far"])
    return summed.select("o_custkey", "o_orderkey", F.round("spent_so_far", 2).alias("spent_so_far"))


@query(
    "win_share_of_total",
    """SELECT n_name, c_mktsegment, customers, round(customers / sum(customers) OVER (PARTITION BY n_name), 8) AS share,
         first_value(c_mktsegment) OVER w AS first_segment, last_value(c_mktsegment) OVER w AS last_segment
       FROM (SELECT n_name, c_mktsegment, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)
       WINDOW w AS (PARTITION BY n_name ORDER BY c_mktsegment ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
)
def win_share_of_total(t: Tables) -> DataFrame:
    """Share of each segment in its nation; the window sees one row per segment."""
    counts = (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "c_mktsegment")
        .agg(F.count("*").alias("customers"))
    )
    whole = Window.partitionBy("n_name")
    frame = whole.orderBy("c_mktsegment").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return counts.select(
        "*",
        F.round(F.col("customers") / F.sum("customers").over(whole), 8).alias("share"),
        F.first("c_mktsegment").over(frame).alias("first_segment"),
        F.last("c_mktsegment").over(frame).alias("last_segment"),
    )


@query(
    "win_lag_lead",
    """SELECT event_id, user_id, lag(event_type, 1, 'none') OVER w AS before, lead(event_type, 2) OVER w AS after_next,
         date_diff('second', lag(ts) OVER w, ts) AS gap FROM (SELECT * REPLACE (date_trunc('second', ts) AS ts) FROM events)
       WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
)
def win_lag_lead(t: Tables) -> DataFrame:
    """Neighbours of each event in its user's history."""
    events = t.events.select("event_id", "user_id", "event_type", F.date_trunc("second", "ts").alias("ts"))
    numbered = number_rows(events, ["user_id"], ["ts", "event_id"])
    w = Window.partitionBy("user_id", "_block").orderBy("rn")
    return (
        in_blocks(numbered, "rn", 50_000, before=1, after=2)
        .select(
            "event_id",
            "user_id",
            F.lag("event_type", 1, "none").over(w).alias("before"),
            F.lead("event_type", 2).over(w).alias("after_next"),
            (F.unix_timestamp("ts") - F.unix_timestamp(F.lag("ts").over(w))).alias("gap"),
            "_halo",
        )
        .filter("NOT _halo")
        .drop("_halo")
    )


@query(
    "win_rows_frame",
    """SELECT o_orderkey, round(avg(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS last3,
         max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS peak3 FROM orders""",
)
def win_rows_frame(t: Tables) -> DataFrame:
    """Moving mean over three orders and maximum around each order."""
    orders = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    numbered = number_rows(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    w = Window.partitionBy("o_custkey", "_block").orderBy("rn")
    return (
        in_blocks(numbered, "rn", 50_000, before=2, after=1)
        .select(
            "o_orderkey",
            F.round(F.avg("o_totalprice").over(w.rowsBetween(-2, Window.currentRow)), 4).alias("last3"),
            F.max("o_totalprice").over(w.rowsBetween(-1, 1)).alias("peak3"),
            "_halo",
        )
        .filter("NOT _halo")
        .drop("_halo")
    )


@query(
    "win_range_frame",
    """SELECT event_id, count(*) OVER w AS events_1h, round(sum(value) OVER w, 4) AS value_1h FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
)
def win_range_frame(t: Tables) -> DataFrame:
    """Events and value of the same user in the hour up to each event."""
    return trailing_totals(t.events, "user_id", "ts", "event_id", "value", 3_600_000_000).select(
        "event_id", F.col("n").alias("events_1h"), F.round("total", 4).alias("value_1h")
    )


def trailing_totals(rows: DataFrame, key: str, ts: str, unique: str, value: str, reach: int) -> DataFrame:
    """(unique, n, total): rows of the same key in the ``reach`` microseconds up to each row, and the sum of their values.

    Running totals at the row less those at the start of its frame: linear, however many rows a frame holds. The totals
    are decimals, so their differences lose no digits however long the key's history is; values are taken to 12 places
    and may be up to 1e26 in sum. A frame without a known value has no total. Among marks of one instant, starts of
    frames come first, then rows, then the ends that count them.
    """
    at = F.unix_micros(ts)

    def mark(kind: int, when: Column, one: int, known: Column, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), when.alias("at"), F.lit(one).alias("one"), known.alias("known"), amount.alias("amount"))

    zero, none = F.lit(0), F.lit(None).cast(EXACT)
    marks = F.array(
        mark(0, at - reach, 0, zero, none),
        mark(1, at, 1, F.col(value).isNotNull().cast("int"), F.col(value).cast(EXACT)),
        mark(2, at, 0, zero, none),
    )
    spread = rows.select(F.col(unique).alias("_id"), F.col(key).alias("_key"), F.inline(marks))
    totals = running_sum(spread, ["_key"], ["at", "kind", "_id"], ["one", "known", "amount"], ["n", "n_known", "total"])
    ends = F.col("kind") == 2
    sign = F.when(ends, 1).otherwise(-1)
    summed = totals.filter("kind <> 1").groupBy("_id").agg(
        F.sum(sign * F.col("n")).alias("n"), F.sum(sign * F.col("n_known")).alias("known"), F.sum(F.when(ends, F.col("total")).otherwise(-F.col("total"))).alias("total")
    )
    return summed.select(F.col("_id").alias(unique), "n", F.when(F.col("known") > 0, F.col("total").cast("double")).alias("total"))


@query(
    "win_fill_gaps",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS event_day, max(value) FILTER (value > 95) AS peak FROM events GROUP BY ALL)
       SELECT event_type, event_day, peak, last_value(peak IGNORE NULLS) OVER w AS latest, first_value(peak IGNORE NULLS) OVER w AS earliest,
         nth_value(peak, 2 IGNORE NULLS) OVER w AS second FROM d
       WINDOW w AS (PARTITION BY event_type ORDER BY event_day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
)
def win_fill_gaps(t: Tables) -> DataFrame:
    """Days without a peak take the latest one before; nulls are passed over. The window sees one row per day."""
    days = t.events.groupBy("event_type", F.to_date("ts").alias("event_day")).agg(
        F.max(F.when(F.col("value") > 95, F.col("value"))).alias("peak")
    )
    w = Window.partitionBy("event_type").orderBy("event_day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.select(
        "*",
        F.last("peak", ignorenulls=True).over(w).alias("latest"),
        F.first("peak", ignorenulls=True).over(w).alias("earliest"),
        F.nth_value("peak", 2, ignoreNulls=True).over(w).alias("second"),
    )
