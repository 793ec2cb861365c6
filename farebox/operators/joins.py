"""Joins. Strategies are left to Spark: it broadcasts sides below its size limit and
splits skewed keys of sort-merge joins at run time."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.scale import EXACT, running_sum
from farebox.tables import Tables


@query(
    "join_inner",
    """SELECT c_mktsegment, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL""",
)
def join_inner(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment", "o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "join_left",
    """SELECT o_orderkey, count(l_partkey) AS lines, round(coalesce(sum(l_quantity), 0), 2) AS qty
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R' GROUP BY 1""",
)
def join_left(t: Tables) -> DataFrame:
    """Returned lines per order. They are summed before the join, so it moves one row per order."""
    returned = (
        t.lineitem.filter("l_returnflag = 'R'")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("qty"))
    )
    return (
        t.orders.select("o_orderkey")
        .join(returned, "o_orderkey", "left")
        .select("o_orderkey", F.coalesce("lines", F.lit(0)).alias("lines"), F.round(F.coalesce("qty", F.lit(0.0)), 2).alias("qty"))
    )


@query(
    "join_right",
    """SELECT n_name, s_suppkey, s_acctbal FROM (SELECT * FROM supplier WHERE s_acctbal < 0)
       RIGHT JOIN nation ON s_nationkey = n_nationkey""",
)
def join_right(t: Tables) -> DataFrame:
    in_debt = t.supplier.filter("s_acctbal < 0")
    return in_debt.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"), "right").select(
        "n_name", "s_suppkey", "s_acctbal"
    )


@query(
    "join_full",
    """SELECT key, old_total, new_total FROM
       (SELECT o_custkey AS key, round(sum(o_totalprice), 2) AS old_total FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)
       FULL JOIN (SELECT o_custkey AS key, round(sum(o_totalprice), 2) AS new_total FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1)
       USING (key)""",
)
def join_full(t: Tables) -> DataFrame:
    def totals(where: str, name: str) -> DataFrame:
        return t.orders.filter(where).groupBy(F.col("o_custkey").alias("key")).agg(
            F.round(F.sum("o_totalprice"), 2).alias(name)
        )

    old = totals("o_orderdate < TIMESTAMP '1998-01-01'", "old_total")
    return old.join(totals("o_orderdate >= TIMESTAMP '1998-01-01'", "new_total"), "key", "full")


@query(
    "join_semi",
    """SELECT c_custkey, c_mktsegment FROM customer WHERE EXISTS
       (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)""",
)
def join_semi(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_mktsegment")


@query(
    "join_anti",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS
       (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'N')""",
)
def join_anti(t: Tables) -> DataFrame:
    kept = t.lineitem.filter("l_returnflag = 'N'")
    return t.orders.join(kept, F.col("l_orderkey") == F.col("o_orderkey"), "left_anti").select("o_orderkey", "o_orderstatus")


@query(
    "join_theta_range",
    """WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 8 AS w FROM orders),
            b AS (SELECT i AS band, lo + i * w AS low, CASE WHEN i < 7 THEN lo + (i + 1) * w END AS high FROM e, range(8) r(i))
       SELECT band, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders
       JOIN b ON o_totalprice >= low AND (high IS NULL OR o_totalprice < high) GROUP BY 1""",
)
def join_theta_range(t: Tables) -> DataFrame:
    """Orders by price band. Bands do not overlap and the last is open above, so a row meets one band; the eight
    bands are one row of a global aggregate, and go to every task."""
    price = F.col("o_totalprice")
    width = (F.max(price) - F.min(price)) / 8
    bands = t.orders.agg(F.min(price).alias("lo"), width.alias("w")).select("lo", "w", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i"))
    bands = bands.select(
        F.col("i").cast("bigint").alias("band"),
        (F.col("lo") + F.col("i") * F.col("w")).alias("low"),
        F.when(F.col("i") < 7, F.col("lo") + (F.col("i") + 1) * F.col("w")).alias("high"),
    )
    inside = (price >= F.col("low")) & (F.col("high").isNull() | (price < F.col("high")))
    return (
        t.orders.join(F.broadcast(bands), inside)
        .groupBy("band")
        .agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )


@query(
    "join_range_totals",
    """WITH spells AS (SELECT event_id AS spell, user_id, ts AS start_ts, ts + INTERVAL 6 HOUR AS end_ts
                       FROM events WHERE event_type = 'signup')
       SELECT spell, count(*) AS events_inside, round(sum(value), 2) AS value_inside
       FROM spells s JOIN events e ON s.user_id = e.user_id AND e.ts >= s.start_ts AND e.ts < s.end_ts GROUP BY 1""",
)
def join_range_totals(t: Tables) -> DataFrame:
    """Events within six hours of a signup of the same user, with no pair ever made.

    The total inside a spell is the running total at its end less that at its start, so
    the work is linear in events and spells even where one user has most of both. Totals are decimals, so that their
    differences lose no digits; a spell without a known value has no total.
    """

    def mark(kind: int, at, one: int, known, amount) -> Column:
        return F.struct(at.alias("at"), F.lit(kind).alias("kind"), F.lit(one).alias("one"), known.alias("known"), amount.alias("amount"))

    # An edge sorts before the events of its own instant: the start counts them, the end does not.
    ts, zero, none = F.col("ts"), F.lit(0), F.lit(None).cast(EXACT)
    event = mark(2, ts, 1, F.col("value").isNotNull().cast("int"), F.col("value").cast(EXACT))
    edges = [mark(0, ts, 0, zero, none), mark(1, ts + F.expr("INTERVAL 6 HOURS"), 0, zero, none)]
    of_row = F.when(F.col("event_type") == "signup", F.array(event, *edges)).otherwise(F.array(event))
    marks = t.events.select("user_id", F.col("event_id").alias("id"), F.inline(of_row))
    totals = running_sum(marks, ["user_id"], ["at", "kind", "id"], ["one", "known", "amount"], ["n", "n_known", "total"])
    ends = F.col("kind") == 1
    sign = F.when(ends, 1).otherwise(-1)
    summed = (
        totals.filter("kind < 2")
        .groupBy(F.col("id").alias("spell"))
        .agg(
            F.sum(sign * F.col("n")).alias("events_inside"),
            F.sum(sign * F.col("n_known")).alias("known"),
            F.sum(F.when(ends, F.col("total")).otherwise(-F.col("total"))).alias("total"),
        )
        .filter("events_inside > 0")
    )
    inside = F.when(F.col("known") > 0, F.round(F.col("total").cast("double"), 2))
    return summed.select("spell", "events_inside", inside.alias("value_inside"))


@query(
    "join_cross",
    """SELECT c_custkey, round(c_acctbal - mean_balance, 4) AS above_mean FROM customer
       CROSS JOIN (SELECT avg(c_acctbal) AS mean_balance FROM customer WHERE c_acctbal > 0) WHERE c_acctbal > mean_balance""",
)
def join_cross(t: Tables) -> DataFrame:
    """Cartesian product with a one-row table: attach a total to each row.

    One side is a global aggregate, so the product never has more rows than the other.
    """
    mean = t.customer.filter("c_acctbal > 0").agg(F.avg("c_acctbal").alias("mean_balance"))
    return (
        t.customer.crossJoin(F.broadcast(mean))
        .filter(F.col("c_acctbal") > F.col("mean_balance"))
        .select("c_custkey", F.round(F.col("c_acctbal") - F.col("mean_balance"), 4).alias("above_mean"))
    )


@query(
    "join_broadcast",
    """SELECT n_name, r_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM customer
       JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
)
def join_broadcast(t: Tables) -> DataFrame:
    """Small dimensions go to every task: Spark broadcasts a side whose size in bytes is below its limit."""
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_name", "r_name")
        .agg(F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance"))
    )


@query(
    "join_self_alias",
    """SELECT a.o_orderkey AS order_key, b.o_orderkey AS next_key, round(b.o_totalprice - a.o_totalprice, 2) AS step
       FROM orders a JOIN orders b ON b.o_orderkey = a.o_orderkey + 1 AND a.o_custkey < b.o_custkey""",
)
def join_self_alias(t: Tables) -> DataFrame:
    """Each order with the one numbered next, where that belongs to a higher customer."""
    a, b = t.orders.alias("a"), t.orders.alias("b")
    on = (F.col("b.o_orderkey") == F.col("a.o_orderkey") + 1) & (F.col("a.o_custkey") < F.col("b.o_custkey"))
    return a.join(b, on).select(
        F.col("a.o_orderkey").alias("order_key"),
        F.col("b.o_orderkey").alias("next_key"),
        F.round(F.col("b.o_totalprice") - F.col("a.o_totalprice"), 2).alias("step"),
    )


@query(
    "join_cogroup",
    """WITH c AS (SELECT c_nationkey AS nation, count(*) AS customers, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments
                  FROM customer GROUP BY 1),
            s AS (SELECT s_nationkey AS nation, count(*) AS suppliers, round(max(s_acctbal), 2) AS best FROM supplier GROUP BY 1)
       SELECT nation, n_name, customers, segments, suppliers, best FROM c FULL JOIN s USING (nation)
       FULL JOIN (SELECT n_nationkey AS nation, n_name FROM nation) USING (nation)""",
)
def join_cogroup(t: Tables) -> DataFrame:
    """Bring the groups of three tables together by key.

    Each side is reduced first (the list of segments holds distinct values only), so a
    large group is never held in one place.
    """
    customers = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(
        F.count("*").alias("customers"),
        F.array_join(F.array_sort(F.collect_set("c_mktsegment")), ",").alias("segments"),
    )
    suppliers = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(
        F.count("*").alias("suppliers"), F.round(F.max("s_acctbal"), 2).alias("best")
    )
    names = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return customers.join(suppliers, "nation", "full").join(names, "nation", "full")
