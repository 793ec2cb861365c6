"""Catalog tables, views, SQL text and tables made from Python values."""

import uuid

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import parts_of
from farebox.tables import Tables


def fresh(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex}"


def save_table(writer, t: Tables, label: str) -> str:
    """Save as a catalog table whose files lie in the shared folder."""
    name = fresh(label)
    writer.option("path", workspace.scratch(t.spark, label)).saveAsTable(name)
    return name


@query(
    "io_table_roundtrip",
    """SELECT s_name, s_acctbal, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_acctbal > 1000""",
)
def io_table_roundtrip(t: Tables) -> DataFrame:
    """Save a table, read it by name in two ways and join it with a view in SQL."""
    name = save_table(t.supplier.write, t, "suppliers")
    rich = t.spark.table(name).filter("s_acctbal > 1000").select("s_suppkey")
    view = fresh("nations")
    t.nation.createTempView(view)
    joined = t.spark.sql(f"SELECT s_suppkey, s_name, s_acctbal, n_name FROM {name} JOIN {view} ON s_nationkey = n_nationkey")
    kept = joined.join(t.spark.read.table(name).select("s_suppkey"), "s_suppkey").join(rich, "s_suppkey", "left_semi")
    return kept.select("s_name", "s_acctbal", "n_name")


@query(
    "io_bucketed_write",
    """SELECT o_orderkey, o_totalprice, count(*) AS lines, round(sum(l_quantity), 2) AS qty FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL""",
)
def io_bucketed_write(t: Tables) -> DataFrame:
    """Two tables bucketed alike: the join and the group-by on the bucket key move no rows."""
    buckets = parts_of(t.orders)
    # Dealt out by the key first: each task then writes one file, not one per bucket.
    dealt = lambda df, key: df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    orders = save_table(dealt(t.orders, "o_orderkey"), t, "bucketed_orders")
    lines = save_table(dealt(t.lineitem, "l_orderkey"), t, "bucketed_lines")
    joined = t.spark.table(orders).join(t.spark.table(lines).hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderkey", "o_totalprice").agg(
        F.count("*").alias("lines"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "io_insert_into",
    "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1",
)
def io_insert_into(t: Tables) -> DataFrame:
    """Insert by position into an existing table."""
    picked = t.customer.select("c_custkey", "c_mktsegment")
    name = save_table(picked.filter("c_mktsegment = 'BUILDING'").write, t, "inserted")
    picked.filter("c_mktsegment <> 'BUILDING'").write.insertInto(name)
    return t.spark.table(name).groupBy("c_mktsegment").agg(F.count("*").alias("n"))


@query(
    "io_dynamic_partition",
    """SELECT o_orderstatus, count(*) AS n, round(sum(CASE o_orderstatus WHEN 'F' THEN -o_totalprice ELSE o_totalprice END), 2) AS total FROM orders GROUP BY 1""",
)
def io_dynamic_partition(t: Tables) -> DataFrame:
    """Overwrite only the partitions that the new rows belong to."""
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus")
    name = save_table(rows.write.partitionBy("o_orderstatus"), t, "by_status")
    changed = rows.filter("o_orderstatus = 'F'").withColumn("o_totalprice", -F.col("o_totalprice"))
    mode = "spark.sql.sources.partitionOverwriteMode"  # inserts by position read it from the session only
    before = t.spark.conf.get(mode)
    t.spark.conf.set(mode, "dynamic")
    try:
        changed.write.insertInto(name, overwrite=True)
    finally:
        t.spark.conf.set(mode, before)
    return t.spark.table(name).groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "sql_text_queries",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey
       WHERE o_totalprice BETWEEN 50000 AND 300000 AND NOT (c_nationkey = 3) GROUP BY o_orderpriority HAVING count(*) > 10 ORDER BY n DESC""",
)
def sql_text_queries(t: Tables) -> DataFrame:
    """SQL text with DataFrames as its tables."""
    return t.spark.sql(
        """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
           FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           WHERE o_totalprice BETWEEN 50000 AND 300000 AND NOT (c_nationkey = 3)
           GROUP BY o_orderpriority HAVING count(*) > 10 ORDER BY n DESC""",
        orders=t.orders,
        customer=t.customer,
    )


@query(
    "sql_forms",
    """SELECT c_custkey, c_acctbal * 2 + 1 AS number, CASE WHEN c_nationkey = 1 THEN 'one' END AS named, 20 AS second_item, c_mktsegment AS tag
       FROM customer WHERE NOT (c_acctbal < 0)""",
)
def sql_forms(t: Tables) -> DataFrame:
    """Constructors and access for lists, maps and structs, and the table function ``range`` up to the largest key."""
    end = t.customer.agg(F.max("c_custkey")).first()[0]
    return t.spark.sql(
        f"""SELECT c_custkey, c_acctbal * 2 + 1 AS number, try_element_at(map(1, 'one'), c_nationkey) AS named,
                  array(10, 20)[1] AS second_item, named_struct('tag', c_mktsegment).tag AS tag
           FROM {{customer}} JOIN range(0, {(end or 0) + 1}) r ON c_custkey = r.id WHERE NOT (c_acctbal < 0)""",
        customer=t.customer,
    )


@query(
    "sql_views",
    """SELECT 'temp' AS view, count(*) AS n FROM nation UNION ALL SELECT 'replaced', count(*) FROM region
       UNION ALL SELECT 'global', count(*) FROM supplier UNION ALL SELECT 'global replaced', count(*) FROM customer""",
)
def sql_views(t: Tables) -> DataFrame:
    temp, shared = fresh("view"), fresh("shared")
    spark = t.spark
    counted = []

    def count(label: str, name: str) -> None:
        counted.append(spark.sql(f"SELECT '{label}' AS view, count(*) AS n FROM {name}"))

    t.nation.createTempView(temp)
    count("temp", temp)
    t.region.createOrReplaceTempView(temp)
    count("replaced", temp)
    t.supplier.createGlobalTempView(shared)
    count("global", f"global_temp.{shared}")
    t.customer.createOrReplaceGlobalTempView(shared)
    count("global replaced", f"global_temp.{shared}")
    return counted[0].union(counted[1]).union(counted[2]).union(counted[3])


@query(
    "src_range",
    """SELECT id, CAST(id % 7 AS BIGINT) AS weekday FROM range(0, (SELECT max(o_orderkey) + 1 FROM orders)) r(id)
       WHERE id NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def src_range(t: Tables) -> DataFrame:
    """Order numbers without a line: the range of all numbers less those that have lines."""
    last = t.orders.agg(F.max("o_orderkey")).first()[0]
    numbers = t.spark.range(0, last + 1, 1)
    used = t.lineitem.select(F.col("l_orderkey").alias("id"))
    return numbers.join(used, "id", "left_anti").withColumn("weekday", F.col("id") % 7)


@query(
    "src_create_dataframe",
    """SELECT o_orderpriority, w AS weight, h AS hours, d AS desk, count(*) AS n FROM orders
       JOIN (VALUES ('1-URGENT', 9, 1.5::DOUBLE, 'a'), ('2-HIGH', 5, 4.0, 'b'), ('3-MEDIUM', 3, 8.0, 'b')) v(p, w, h, d) ON o_orderpriority = p GROUP BY ALL""",
)
def src_create_dataframe(t: Tables) -> DataFrame:
    """Lookup tables from tuples, rows, pandas and nothing, joined to orders."""
    spark = t.spark
    weights = spark.createDataFrame([("1-URGENT", 9), ("2-HIGH", 5)], "o_orderpriority string, weight bigint")
    more = spark.createDataFrame([Row(o_orderpriority="3-MEDIUM", weight=3)])
    none = spark.createDataFrame([], weights.schema)
    hours = spark.createDataFrame(pd.DataFrame({"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM"], "hours": [1.5, 4.0, 8.0]}))
    desks = spark.createDataFrame([{"o_orderpriority": p, "desk": d} for p, d in (("1-URGENT", "a"), ("2-HIGH", "b"), ("3-MEDIUM", "b"))])
    lookup = weights.union(more).union(none).join(hours, "o_orderpriority").join(desks, "o_orderpriority")
    counts = t.orders.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    return counts.join(lookup, "o_orderpriority").select("o_orderpriority", "weight", "hours", "desk", "n")
