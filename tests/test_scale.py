"""The helpers for busy keys against plain Python, on rows where one key has most of them."""

import random
import time

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from farebox import scale, workspace
from farebox.operators.windows import trailing_totals


def skewed_rows(n=3000, seed=1):
    rng = random.Random(seed)
    return [(i, "hot" if rng.random() < 0.6 else f"k{rng.randrange(40)}", rng.randrange(500), rng.randrange(100)) for i in range(n)]


@pytest.fixture(scope="module")
def skewed(spark):
    rows = skewed_rows()
    return rows, spark.createDataFrame(rows, "id bigint, k string, at int, v bigint").repartition(5)


def by_key(rows):
    groups = {}
    for row in sorted(rows, key=lambda r: (r[2], r[0])):
        groups.setdefault(row[1], []).append(row)
    return groups


def test_number_rows(skewed):
    rows, df = skewed
    found = {r.id: r.rn for r in scale.number_rows(df, ["k"], ["at", "id"]).collect()}
    assert found == {row[0]: i + 1 for group in by_key(rows).values() for i, row in enumerate(group)}


def test_running_sum(skewed):
    rows, df = skewed
    sums = scale.running_sum(df, ["k"], ["at", "id"], ["v"], ["upto"])
    found = {r.id: r.upto for r in sums.collect()}
    want = {}
    for group in by_key(rows).values():
        total = 0
        for row in group:
            total += row[3]
            want[row[0]] = total
    assert found == want


@pytest.mark.parametrize("size", [3, 7, 1000])
def test_blocks_give_exact_frames(skewed, size):
    rows, df = skewed
    numbered = scale.number_rows(df, ["k"], ["at", "id"])
    w = Window.partitionBy("k", "_block").orderBy("rn")
    framed = scale.in_blocks(numbered, "rn", size, before=2, after=1).select(
        "id", F.sum("v").over(w.rowsBetween(-2, 0)).alias("s"), F.lead("v").over(w).alias("n"), "_halo"
    )
    found = {r.id: (r.s, r.n) for r in framed.filter("NOT _halo").collect()}
    want = {}
    for group in by_key(rows).values():
        values = [row[3] for row in group]
        for i, row in enumerate(group):
            want[row[0]] = (sum(values[max(0, i - 2) : i + 1]), values[i + 1] if i + 1 < len(values) else None)
    assert found == want


def test_dense_ids_split_a_frequent_value(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    rows = scale.dense_ids(df, ["v", "id"], name="n").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(2000))
    assert [(r.v, r.id) for r in rows] == sorted((r.v, r.id) for r in rows)


def test_chunks_are_bounded(skewed):
    _, df = skewed
    sizes = scale.chunked(df, ["k"], ["id"], rows=100).groupBy("k", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] < 200
    assert sizes.agg(F.sum("count")).first()[0] == 3000


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.none() | st.integers(0, 30), st.none() | st.integers(0, 9)), min_size=1, max_size=60))
def test_slots_match_one_window(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id bigint, k string, at int, v bigint")
    plain = Window.partitionBy("k").orderBy("at", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    number = F.row_number().over(Window.partitionBy("k").orderBy("at", "id"))
    want = {r.id: (r.n, r.s) for r in df.select("id", number.alias("n"), F.sum("v").over(plain).alias("s")).collect()}
    two = scale.number_rows(scale.running_sum(df, ["k"], ["at", "id"], ["v"], ["s"]), ["k"], ["at", "id"])
    assert {r.id: (r.rn, r.s) for r in two.collect()} == want
    assert scale.chunked(df, ["k"], ["id"], rows=5).count() == len(rows)


def test_median_with_nulls_and_small_values(spark):
    from farebox.operators.aggregates import grouped_median, skewed_summary

    rng = random.Random(2)
    rows = [(rng.choice(["hot"] * 9 + ["cold", None]), rng.choice([None, rng.random()]), rng.choice([None, 1, 2])) for _ in range(500)]
    df = spark.createDataFrame(rows, "event_type string, value double, user_id bigint")
    plain = df.groupBy("event_type").agg(
        F.round(F.median("value"), 4).alias("middle"), F.count("*").alias("n"), F.countDistinct("user_id").alias("users")
    )
    want = {r.event_type: (r.middle, r.n, r.users) for r in plain.collect()}
    assert {r.event_type: r.middle for r in grouped_median(df, "event_type", "value").collect()} == {k: v[0] for k, v in want.items()}
    assert {r.event_type: (r.middle, r.n, r.users) for r in skewed_summary(df).collect()} == want


def test_area_under_curve_of_probabilities(spark):
    from farebox.plans.metrics import roc_area

    rng = random.Random(3)
    rows = [(round(rng.random(), 3), rng.randrange(2)) for _ in range(400)]
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / len(pos) / len(neg)
    assert roc_area(spark.createDataFrame(rows, "score double, label int")).first().roc == pytest.approx(want)


def test_odd_log_lines(spark):
    from farebox.operators.aggregates import log_stats

    lines = ['1.1.1.1 - u [01/01/2024:00:00:00] "GET /a HTTP/1.1" 200 5', "not a log line", None, ""]
    rows = log_stats(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    assert sorted((r.ip or "", r.hits, r.bytes) for r in rows) == [("", 3, None), ("1.1.1.1", 1, 5)]


def test_trailing_totals_are_exact(spark):
    """One key has nine tenths of the rows; values up to 1e9 of both signs and nulls: the same as a plain window over decimals."""
    draw = random.Random(11)
    rows = []
    for i in range(6000):
        key = 1 if i % 10 else draw.choice([2, 3, None])
        value = None if draw.random() < 0.3 else draw.choice([1, -1]) * round(draw.uniform(0, 1e9), 4)
        rows.append((i, key, draw.randrange(0, 50_000_000) * 1000, value if key != 3 else None))
    df = spark.createDataFrame(rows, "id bigint, key bigint, us bigint, value double").withColumn("ts", F.timestamp_micros("us")).drop("us")
    got = {r.id: (r.n, r.total) for r in trailing_totals(df.repartition(7), "key", "ts", "id", "value", 60_000_000).collect()}
    frame = Window.partitionBy("key").orderBy(F.unix_micros("ts")).rangeBetween(-60_000_000, Window.currentRow)
    plain = df.select("id", F.count("*").over(frame).alias("n"), F.sum(F.col("value").cast("decimal(30,6)")).over(frame).cast("double").alias("total"))
    want = {r.id: (r.n, r.total) for r in plain.collect()}
    assert got == want
    assert any(total is None for _, total in want.values()) and any(n > 5 for n, _ in want.values())


def test_stored_tables_leave_no_shuffle_files(spark):
    """The shuffle files of a step go when it is written; the session's setting stays as it was."""

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}

    before, setting = shuffled(), spark.conf.get(workspace.SHUFFLE_CLEANUP, None)
    rows = workspace.stored(spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count(), "no-shuffle")
    for _ in range(50):
        if left := shuffled() - before:
            time.sleep(0.2)
    assert not left
    assert spark.conf.get(workspace.SHUFFLE_CLEANUP, None) == setting
    assert rows.count() == 7
