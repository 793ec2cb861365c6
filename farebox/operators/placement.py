"""Where rows are placed: repartition, range, coalesce, cache."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import parts_of
from farebox.tables import Tables


@query("part_hash", "SELECT o_orderkey, 1 AS places, o_totalprice FROM orders")
def part_hash(t: Tables) -> DataFrame:
    """Hash placement by key: all rows of a key are in one partition."""
    orders = t.orders.select("o_orderkey", "o_totalprice")
    placed = orders.repartition(parts_of(orders), "o_orderkey")
    return (
        placed.withColumn("place", F.spark_partition_id())
        .groupBy("o_orderkey")
        .agg(F.count_distinct("place").alias("places"), F.max("o_totalprice").alias("o_totalprice"))
    )


@query("part_range", "SELECT count(*) AS n, TRUE AS apart FROM orders")
def part_range(t: Tables) -> DataFrame:
    """Range placement: the partitions hold neighbouring, non-overlapping key ranges."""
    orders = t.orders.select("o_orderkey")
    placed = orders.repartitionByRange(parts_of(orders), "o_orderkey")
    ranges = placed.groupBy(F.spark_partition_id().alias("place")).agg(
        F.count("*").alias("n"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high")
    )
    # One row per partition: sorted by its low end, each range must end before the next begins.
    listed = ranges.agg(F.sum("n").alias("n"), F.array_sort(F.collect_list(F.struct("low", "high"))).alias("r"))
    apart = F.forall(
        F.sequence(F.lit(1), F.size("r") - 1), lambda i: F.element_at("r", i)["high"] < F.element_at("r", i + 1)["low"]
    )
    return listed.select("n", apart.alias("apart"))


@query("part_coalesce", "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum, TRUE AS fewer FROM orders")
def part_coalesce(t: Tables) -> DataFrame:
    """Fewer partitions with no shuffle."""
    orders = t.orders.select("o_orderkey")
    half = max(1, parts_of(orders) // 2)
    merged = orders.repartition(parts_of(orders)).coalesce(half).withColumn("place", F.spark_partition_id())
    return merged.agg(
        F.count("*").alias("n"),
        F.sum("o_orderkey").alias("key_sum"),
        (F.count_distinct("place") <= half).alias("fewer"),
    )


@query(
    "part_sort_within",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem",
)
def part_sort_within(t: Tables) -> DataFrame:
    """Sorted inside each hash partition, as writers of sorted files want it."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return lines.repartition(parts_of(lines), "l_orderkey", "l_linenumber").sortWithinPartitions("l_orderkey", "l_linenumber")


@query(
    "part_cache",
    """SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_orderstatus = 'O' GROUP BY 1""",
)
def part_cache(t: Tables) -> DataFrame:
    """Two uses of one filtered table: the second reads the stored blocks.

    The level allows disk, and a lost block is computed again from the scan.
    """
    open_orders = t.orders.filter("o_orderstatus = 'O'").select("o_orderpriority", "o_totalprice")
    kept = open_orders.persist(StorageLevel.MEMORY_AND_DISK)
    counts = kept.groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    totals = kept.groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    both = workspace.stored(counts.join(totals, "o_orderpriority"), "cached")
    kept.unpersist()
    return both


@query("part_profile")
def part_profile(t: Tables) -> DataFrame:
    """Rows and key range per partition, in place of gathering each partition in a list."""
    return (
        t.lineitem.select("l_orderkey", "l_linenumber").repartition("l_orderkey", "l_linenumber")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.count("*").alias("n"), F.min("l_orderkey").alias("low"), F.max("l_orderkey").alias("high"))
    )
