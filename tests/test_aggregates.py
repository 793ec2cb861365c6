"""Forms that give the same rows as the query of the catalogue."""

from functools import reduce

from pyspark.sql import functions as F

from farebox import workspace
from farebox.operators import aggregates
from farebox.plans import tips


def rows(df):
    return sorted(map(repr, df.collect()))


def test_describe_is_summary(tables):
    numbers = lambda df: df.select("summary", *(F.round(F.col(c).cast("double"), 4).alias(c) for c in ("c_acctbal", "c_nationkey")))
    described = numbers(tables.customer.select("c_acctbal", "c_nationkey").describe())
    assert rows(described) == rows(aggregates.agg_summary(tables).drop("source"))


def test_short_forms_of_grouped_data(tables):
    by = tables.orders.select("o_orderpriority", "o_totalprice").groupby("o_orderpriority")
    forms = {"n": by.count(), "avg_price": by.avg(), "sum_price": by.sum(), "min_price": by.min(), "max_price": by.max()}
    parts = [df.toDF("o_orderpriority", name) for name, df in forms.items()]
    joined = reduce(lambda a, b: a.join(b, "o_orderpriority"), parts)
    rounded = joined.withColumn("avg_price", F.round("avg_price", 4)).withColumn("sum_price", F.round("sum_price", 2))
    assert rows(rounded) == rows(aggregates.agg_grouped_short(tables))


def test_grouping_sets_are_part_of_the_cube(tables):
    flags = ["l_returnflag", "l_linestatus"]
    cubed = tables.lineitem.cube(*flags).agg(
        F.grouping("l_returnflag").cast("bigint").alias("g_flag"), F.grouping_id(*flags).alias("g_id"), F.count("*").alias("n")
    )
    sets = rows(aggregates.agg_grouping_sets(tables))
    assert set(sets) <= set(rows(cubed)) and len(sets) == len(set(sets)) > 2


def test_one_scan(tables):
    for make in (aggregates.agg_grouped_short, aggregates.agg_grouping_sets, aggregates.agg_summary):
        assert make(tables)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_random_ids_are_all_different(tables):
    import pandas as pd

    ids = tips.random_hex(pd.Series(range(1000)))
    assert ids.str.fullmatch("[0-9a-f]{32}").all() and ids.nunique() == 1000
    assert len(tips.random_hex(pd.Series([], dtype=int))) == 0


def test_paths_have_one_address(spark, tmp_path):
    assert workspace.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert workspace.qualified(spark, f"file://{tmp_path}/") == f"file:{tmp_path}"
    store, base = workspace.file_store(workspace.qualified(spark, str(tmp_path)))
    assert (type(store).__name__, base) == ("LocalFileSystem", str(tmp_path))


def test_clean_up(spark, monkeypatch):
    monkeypatch.setattr(workspace, "_made", [])
    kept = workspace.stored(spark.range(10), "cleaned")
    assert kept.count() == 10
    assert workspace.clean_up(spark) == 1 and workspace.clean_up(spark) == 0


def test_quantile_sketch_is_close(tables):
    points = [0.1, 0.25, 0.5, 0.9]
    for r in aggregates.quantiles(tables.lineitem, "l_returnflag", "l_extendedprice", points).collect():
        price, n = tables.lineitem.filter(F.col("l_returnflag") == r.l_returnflag).select("l_extendedprice"), None
        n = price.count()
        for p, q in zip(points, r.q):
            upto = price.filter(F.col("l_extendedprice") <= q).count() / n
            below = price.filter(F.col("l_extendedprice") < q).count() / n
            assert below < p + 0.001 and upto > p - 0.001


def test_distinct_sketch_is_close(tables):
    rough, fine = F.approx_count_distinct("l_orderkey"), F.approx_count_distinct("l_orderkey", rsd=0.01)
    for r in tables.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("n"), rough.alias("rough"), fine.alias("fine")).collect():
        assert abs(r.rough - r.n) < 0.2 * r.n and abs(r.fine - r.n) < 0.04 * r.n
