"""State that starts from a table, and steps on batches: right after every batch and over restarts."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from farebox.streaming import learning, state
from farebox.tables import SCHEMAS

AT = dt.datetime(2024, 3, 1)


def events(spark, rows):
    """(user, kind, hours after the start) as events."""
    data = [(i, AT + dt.timedelta(hours=h), user, kind, 1.0, None) for i, (user, kind, h) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMAS["events"])


def test_every_update_goes_on_from_the_table(spark, tables):
    known = events(spark, [(1, "a", 0), (1, "a", 1), (1, "b", 2), (2, "a", 0), (4, None, 1)])
    first = events(spark, [(1, "a", 3), (1, None, 4), (3, "c", 5)])
    second = events(spark, [(1, "c", 6), (3, "c", 7), (3, "c", 8), (4, "a", 9)])
    end = events(spark, [(-1, "end", 200)])
    run = state.user_totals(tables, known, [first, second, end], "state-test")
    rows = [(r.batch, r.user_id, r.event, r.n, r.kinds, r.last_ts) for r in run.batches().collect() if r.user_id != -1]
    at = lambda h: AT + dt.timedelta(hours=h)
    updates = sorted((batch, user, n, kinds, last) for batch, user, event, n, kinds, last in rows if event == "update")
    batches = sorted({u[0] for u in updates})
    assert [u[1:] for u in updates] == [
        (1, 5, 3, at(4)),
        (3, 1, 1, at(5)),
        (1, 6, 4, at(6)),
        (3, 3, 1, at(8)),
        (4, 2, 2, at(9)),
    ]
    assert len(batches) == 2  # the second start of the query read its own slice only
    quiet = sorted((user, n, kinds, last) for _, user, event, n, kinds, last in rows if event == "quiet")
    assert quiet == [(1, 6, 4, at(6)), (2, 1, 1, at(0)), (3, 3, 1, at(8)), (4, 2, 2, at(9))]



def test_null_users_are_nobody_else(spark, tables):
    known = events(spark, [(None, "a", 0), (None, "a", 1), (1, "a", 0), (2, "a", 1)])
    first = events(spark, [(None, "b", 3), (1, "a", 3), (2, "a", 4)])
    second = events(spark, [(None, "b", 6), (None, "c", 6), (1, "a", 6), (2, "a", 7)])
    run = state.user_totals(tables, known, [first, second], "null-test")
    found = {r.user_id: r.n for r in run.latest("user_id", "event").where("event = 'update'").collect()}
    assert found == {None: 5, 1: 3, 2: 3}


class Remembered:
    """State and timers of one user, with the messages that they took."""

    def __init__(self):
        self.value, self.map, self.timers, self.asked = None, {}, set(), []

    def get(self):
        self.asked.append("get")
        return self.value

    def update(self, value):
        self.value = value

    def getValue(self, key):
        self.asked.append(key)
        return self.map.get(key)

    def updateValue(self, key, value):
        self.map[key] = value

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_state_is_read_once_for_each_kind_of_event():
    user, kept = state.UserTotals(), Remembered()
    user.handle = user.total = user.kinds = kept
    tally = lambda kind, n, at: {"event_type": kind, "n": n, "last_us": at}
    assert user.add([tally("a", 2, 5_000), tally(None, 1, None), tally("a", 1, 9_000)]) == (4, 9_000, 2)
    assert kept.asked == ["get"]  # a new user has no kinds to read
    assert user.add([tally("a", 1, 7_000), tally("b", 1, 11_000), tally("a", 1, 8_000)]) == (7, 11_000, 3)
    assert kept.asked == ["get", "get", ("a",), ("b",)]
    assert kept.map == {("a",): (5,), ("",): (1,), ("b",): (1,)} and kept.timers == {11 + state.QUIET_MS}


def steps(rows, weights, rounds):
    for i in range(1, rounds + 1):
        miss = [1 / (1 + math.exp(-(weights[0] + weights[1] * a + weights[2] * b))) - y for a, b, y in rows]
        sums = [sum(miss), sum(m * a for m, (a, _, _) in zip(miss, rows)), sum(m * b for m, (_, b, _) in zip(miss, rows))]
        weights = tuple(w - learning.STEP / i**0.5 * s / len(rows) for w, s in zip(weights, sums))
    return weights


def test_gradient_steps_equal_plain_python(spark):
    rows = [(0.1 * i, 0.5 - 0.01 * i, float(i > 20)) for i in range(50)]
    df = spark.createDataFrame(rows, "x1 double, x2 double, y double").repartition(4)
    assert learning.gradient_steps(df, (0.0, 0.0, 0.0), 6) == pytest.approx(steps(rows, (0.0, 0.0, 0.0), 6))
    assert learning.gradient_steps(df.limit(0), (1.0, 2.0, 3.0)) == (1.0, 2.0, 3.0)


def test_a_repeated_batch_does_not_step_twice(spark, tables):
    """The last batch runs again with a checkpoint that does not know of it: its weights stay the same."""
    query = learning.stream_logistic_steps
    first = {r.batch: (r.w0, r.w1, r.w2) for r in query(tables).collect()}
    again = {r.batch: (r.w0, r.w1, r.w2) for r in query(tables).collect()}
    assert first == again and len(first) == 2


def test_known_answers_of_row_hashes(spark):
    """Fixed values, as documented for these functions."""
    row = spark.range(1).select(
        F.hash(F.lit("Spark"), F.array(F.lit(123)), F.lit(2)).alias("h"),
        F.xxhash64(F.lit("Spark"), F.array(F.lit(123)), F.lit(2)).alias("x"),
        F.crc32(F.lit("Spark")).alias("c"),
        F.soundex(F.lit("Miller")).alias("s"),
    ).first()
    assert (row.h, row.x, row.c, row.s) == (-1321691492, 5602566077635097486, 1557323817, "M460")
