"""Keyed state that starts from a table: counts per user with value and map state, and timers that report quiet users."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from farebox.registry import query
from farebox.streaming.runs import Feed, Run, end_marker
from farebox.tables import SCHEMAS, Tables

QUIET_MS = 24 * 3600 * 1000
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"

#: What one task has seen of a user and a kind of event, and what is handed out. Times are microseconds, but for the watermark.
TALLY = "user_id bigint, event_type string, n bigint, last_ts timestamp"
TOTAL = "user_id bigint, event string, n bigint, kinds bigint, last_us bigint"
NO_TYPE = ""  # map state keeps no null keys


class UserTotals(StatefulProcessor):
    """Running totals of a user, handed out with every batch that has news, and once more after a day of quiet.

    Value state holds the number of events, the time of the last one, the number of kinds and the timer that is set; map
    state the number of each kind. The initial table fills both before the first row is seen. Every read or write of
    state is a message to the executor's JVM, so each is made once: rows are added up first, and what was read is kept.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.total = handle.getValueState("total", "n bigint, last_us bigint, kinds bigint, timer_ms bigint")
        self.kinds = handle.getMapState("kinds", "event_type string", "n bigint")

    def add(self, tallies: Iterable[Row | dict]) -> tuple[int, int | None, int]:
        """Add (event_type, n, last_us) rows to the state, and wait for a day after the last event with one timer."""
        known = self.total.get()
        n, last, kinds, timer = known or (0, None, 0, None)
        fresh: Counter[str] = Counter()
        for tally in tallies:
            fresh[NO_TYPE if tally["event_type"] is None else tally["event_type"]] += tally["n"]
            if (at := tally["last_us"]) is not None:
                last = at if last is None else max(last, at)
        for kind, count in fresh.items():
            before = self.kinds.getValue((kind,)) if known else None
            kinds += before is None
            self.kinds.updateValue((kind,), (count if before is None else before[0] + count,))
            n += count
        until = None if last is None else last // 1000 + QUIET_MS
        if until != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(until)
        self.total.update((n, last, kinds, until))
        return n, last, kinds

    def handleInitialState(self, key, initialState: Row, timerValues) -> None:
        self.add(initialState.tallies)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        n, last, kinds = self.add(rows)
        yield Row(user_id=key[0], event="update", n=n, kinds=kinds, last_us=last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        n, last, kinds, _ = self.total.get()
        self.total.update((n, last, kinds, None))
        yield Row(user_id=key[0], event="quiet", n=n, kinds=kinds, last_us=last)


def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the events of an Arrow batch before they are shuffled, so that a busy user is a few rows of a batch."""
    for batch in batches:
        yield batch.groupby(["user_id", "event_type"], dropna=False, as_index=False).agg(n=("ts", "size"), last_ts=("ts", "max"))


def user_totals(t: Tables, known: DataFrame, slices: list[DataFrame], label: str) -> Run:
    """Run over ``slices`` of events, one start of the query for each, on top of the events of ``known``."""
    before = t.spark.conf.get(PROVIDER, None)
    t.spark.conf.set(PROVIDER, ROCKS)
    try:
        feed, run = Feed(t, SCHEMAS["events"]), Run(t, label)
        for part in slices:
            tallies = feed.add(part).read().select("user_id", "event_type", "ts").mapInPandas(combine, TALLY).withWatermark("last_ts", "1 hour")
            tallies = tallies.withColumn("last_us", F.unix_micros("last_ts"))
            start = known.groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.unix_micros(F.max("ts")).alias("last_us"))
            # One row for each user: there are a few types of events.
            start = start.groupBy("user_id").agg(F.collect_list(F.struct("event_type", "n", "last_us")).alias("tallies"))
            totals = tallies.groupBy("user_id").transformWithState(UserTotals(), TOTAL, "Update", "EventTime", initialState=start.groupBy("user_id"))
            run.per_batch(totals.select("user_id", "event", "n", "kinds", F.timestamp_micros("last_us").alias("last_ts")), "update")
        return run
    finally:
        if before is None:
            t.spark.conf.unset(PROVIDER)
        else:
            t.spark.conf.set(PROVIDER, before)


@query(
    "stream_initial_state",
    """SELECT user_id, 'quiet' AS event, count(*) AS n, count(DISTINCT event_type) AS kinds, max(ts) AS last_ts FROM events GROUP BY 1
       UNION ALL SELECT user_id, 'update', count(*), count(DISTINCT event_type), max(ts) FROM events GROUP BY 1
         HAVING max(ts) >= TIMESTAMP '2024-01-16 12:00:00'""",
)
def stream_initial_state(t: Tables) -> DataFrame:
    """Totals per user: the first half of the month is known before the start, the second half streams in, in two runs.

    The newest total of each user is the whole table's, both the one of the last update and the one given out when
    the user has been quiet for a day; users of the first half only are reported by their timer alone.
    """
    half, third = F.lit("2024-01-16 12:00:00").cast("timestamp"), F.lit("2024-01-24").cast("timestamp")
    early, late = F.col("ts") < half, F.col("ts") >= third
    slices = [t.events.where(~early & ~late), t.events.where(late), end_marker(t)]
    run = user_totals(t, t.events.where(early), slices, "initial-state")
    return run.latest("user_id", "event").where("user_id <> -1").select("user_id", "event", "n", "kinds", "last_ts")
