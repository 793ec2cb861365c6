"""Sorts, limits and ids."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.scale import dense_ids
from farebox.tables import Tables


@query(
    "sort_orders",
    """SELECT c_custkey, NULLIF(c_nationkey, 3) AS nation, NULLIF(c_mktsegment, 'BUILDING') AS segment, c_acctbal FROM customer
       ORDER BY nation NULLS FIRST, segment DESC NULLS LAST, c_acctbal DESC, c_custkey""",
)
def sort_orders(t: Tables) -> DataFrame:
    """Ascending and descending keys with the place of nulls given."""
    return (
        t.customer.select(
            "c_custkey",
            F.nullif("c_nationkey", F.lit(3)).alias("nation"),
            F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
            "c_acctbal",
        )
        .orderBy(F.asc_nulls_first("nation"), F.desc_nulls_last("segment"), F.desc("c_acctbal"), F.asc("c_custkey"))
    )


@query(
    "sort_nulls_other",
    """SELECT c_custkey, NULLIF(c_nationkey, 3) AS nation, NULLIF(c_mktsegment, 'BUILDING') AS segment FROM customer
       ORDER BY nation DESC NULLS FIRST, segment NULLS LAST, c_custkey DESC""",
)
def sort_nulls_other(t: Tables) -> DataFrame:
    """The remaining orders, written as methods of the columns."""
    rows = t.customer.select(
        "c_custkey", F.nullif("c_nationkey", F.lit(3)).alias("nation"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment")
    )
    return rows.sort(
        F.col("nation").desc_nulls_first(), F.col("segment").asc_nulls_last(), F.col("c_custkey").desc()
    )


@query(
    "top_k",
    """(SELECT 'dearest' AS list, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20)
       UNION ALL (SELECT 'cheapest', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5)
       UNION ALL (SELECT 'first', o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1)""",
)
def top_k(t: Tables) -> DataFrame:
    """First rows under an order: each task keeps its own best, so there is no full sort."""
    orders = t.orders.select("o_orderkey", "o_totalprice")

    def head(name: str, n: int, *order) -> DataFrame:
        return orders.orderBy(*order).limit(n).select(F.lit(name).alias("list"), "o_orderkey", "o_totalprice")

    return (
        head("dearest", 20, F.desc("o_totalprice"), "o_orderkey")
        .union(head("cheapest", 5, "o_totalprice", "o_orderkey"))
        .union(head("first", 1, "o_orderkey"))
    )


@query(
    "id_zip_with_index",
    """SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS id,
         l_orderkey, l_linenumber, l_partkey FROM lineitem""",
)
def id_zip_with_index(t: Tables) -> DataFrame:
    """0-based dense index in ship order."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return dense_ids(t.lineitem.select(order), order).select("id", "l_orderkey", "l_linenumber", "l_partkey")


@query(
    "id_zip",
    """SELECT a.id, a.o_orderkey AS early_order, b.o_orderkey AS dear_order FROM
       (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS id, o_orderkey FROM orders) a JOIN
       (SELECT row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS id, o_orderkey FROM orders) b USING (id)""",
)
def id_zip(t: Tables) -> DataFrame:
    """Pair the n-th earliest order with the n-th dearest one."""
    early = dense_ids(t.orders.select("o_orderdate", "o_orderkey"), ["o_orderdate", "o_orderkey"])
    dear = dense_ids(t.orders.select("o_totalprice", "o_orderkey"), [F.desc("o_totalprice"), "o_orderkey"])
    return early.select("id", F.col("o_orderkey").alias("early_order")).join(
        dear.select("id", F.col("o_orderkey").alias("dear_order")), "id"
    )


@query("id_unique", "SELECT count(*) AS n, count(*) AS ids, TRUE AS part_in_id FROM lineitem")
def id_unique(t: Tables) -> DataFrame:
    """Unique ids that need no shuffle; the upper bits hold the partition."""
    ids = t.lineitem.select(F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"))
    return ids.agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("ids"),
        F.bool_and(F.shiftright("id", 33) == F.col("part")).alias("part_in_id"),
    )
