"""Streams: nothing lost or repeated over restarts, late rows dropped, sessions merged."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farebox.streaming import jobs
from farebox.streaming.runs import Feed, Run

AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def rows(spark, minutes, first_id=0):
    return spark.createDataFrame([(first_id + i, AT + dt.timedelta(minutes=m)) for i, m in enumerate(minutes)], "id bigint, ts timestamp")


def test_restart_reads_each_row_once(spark, tables):
    feed, run = Feed(tables, "id bigint, ts timestamp"), Run(tables, "restart")
    for i in range(3):
        run.append(feed.add(rows(spark, range(10), 10 * i)).read())
    run.append(feed.read())  # nothing new
    ids = [r.id for r in run.rows().collect()]
    assert sorted(ids) == list(range(30))


def test_a_batch_that_runs_again_replaces_its_rows(spark, tables):
    run = Run(tables, "again")
    feed = Feed(tables, "id bigint, ts timestamp").add(rows(spark, range(5)))
    run.per_batch(feed.read(), "append")
    again = Run(tables, "again")
    again.out = run.out  # the same output, but a checkpoint that knows of no batch
    again.per_batch(feed.read(), "append")
    assert run.batches().count() == 5


def test_late_rows_are_dropped_and_counted(spark, tables):
    feed, run = Feed(tables, "id bigint, ts timestamp"), Run(tables, "late")
    for minutes in ([0, 5, 300], [1, 290, 400], [800]):
        windows = feed.add(rows(spark, minutes)).read().withWatermark("ts", "10 minutes").groupBy(F.window("ts", "10 minutes")).count()
        run.append(windows.select(F.col("window.start").alias("start"), "count"))
    found = {r.start: r["count"] for r in run.rows().collect()}
    at = lambda m: (AT + dt.timedelta(minutes=m)).replace(tzinfo=None)
    assert found == {at(0): 2, at(290): 1, at(300): 1, at(400): 1}  # minute 1 came too late
    assert sum(op["numRowsDroppedByWatermark"] for p in run.progress for op in p["stateOperators"]) == 1


def test_spans_merge_when_closer_than_the_gap():
    gap = jobs.GAP
    merged = jobs.merge_spans([(0, 10, 2), (9 + gap, 20 + gap, 1)])
    assert merged == [(0, 20 + gap, 3)]
    assert jobs.merge_spans([(0, 10, 2), (10 + gap, 20 + gap, 1)]) == [(0, 10, 2), (10 + gap, 20 + gap, 1)]


def test_squeeze_keeps_users_apart():
    import pandas as pd

    minute = 60 * 1_000_000
    batch = pd.DataFrame({"user_id": [1, 2, 1, 1], "at": [0, minute, 10 * minute, 60 * minute]})
    (out,) = list(jobs.squeeze(iter([batch])))
    assert out[["user_id", "first", "last", "n"]].values.tolist() == [
        [1, 0, 10 * minute, 2],
        [1, 60 * minute, 60 * minute, 1],
        [2, minute, minute, 1],
    ]


@pytest.mark.parametrize("name", ["stream_kmeans_refit", "stream_logistic_refit"])
def test_models_on_streams_give_rows(spark, name):
    import __spark_entry__ as entry
    from tests.conftest import SF

    rows = entry.queries()[name](spark, SF).collect()
    assert rows
    if name == "stream_kmeans_refit":
        assert len(rows) == 3 and all(0 < r.x < 51 for r in rows)
    else:
        assert all(r.area > 0.7 for r in rows)


def test_rows_of_a_user_are_one_row_of_a_batch():
    import pandas as pd

    from farebox.streaming import jobs

    (found,) = jobs.combine(iter([pd.DataFrame({"user_id": [7, 8, 7, 7], "n": [1, 1, 1, 1]})]))
    assert dict(zip(found["user_id"], found["n"])) == {7: 3, 8: 1} and list(found.columns) == ["user_id", "n"]
