"""Event-time windows over the event stream."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.streaming.runs import Feed, Run, end_marker
from farebox.tables import SCHEMAS, Tables

DELAY = "1 hour"
EPOCH = "TIMESTAMP '1970-01-01'"


@query(
    "stream_tumbling",
    f"""SELECT time_bucket(INTERVAL 1 HOUR, ts, {EPOCH}) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events
        GROUP BY 1, 2""",
)
def stream_tumbling(t: Tables) -> DataFrame:
    """Hourly counts; a window is written once, when the watermark has passed its end. A marker closes the last ones."""

    def hourly(events: DataFrame) -> DataFrame:
        windows = (
            events.withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "1 hour"), "event_type")
            .agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))
        )
        return windows.select(F.col("window.start").alias("start"), "event_type", "n", "total")

    return Run(t, "tumbling").append_all(t.events, hourly, end_marker(t)).rows()


@query(
    "stream_sliding",
    f"""WITH steps AS (SELECT time_bucket(INTERVAL 15 MINUTE, ts, {EPOCH}) - i * INTERVAL 15 MINUTE AS start, event_type, value
                       FROM events, range(4) r(i))
        SELECT start, event_type, count(*) AS n, max(value) AS peak FROM steps GROUP BY ALL""",
)
def stream_sliding(t: Tables) -> DataFrame:
    """Counts per type over one-hour windows that start every quarter of an hour."""

    def counts(events: DataFrame) -> DataFrame:
        windows = (
            events.withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "1 hour", "15 minutes"), "event_type")
            .agg(F.count("*").alias("n"), F.max("value").alias("peak"))
        )
        return windows.select(F.col("window.start").alias("start"), "event_type", "n", "peak")

    return Run(t, "sliding").append_all(t.events, counts, end_marker(t)).rows()


@query(
    "stream_session_window",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e)
       SELECT user_id, min(ts) AS started, max(ts) + INTERVAL 30 MINUTE AS ended, count(*) AS events FROM s GROUP BY user_id, session""",
)
def stream_session_window(t: Tables) -> DataFrame:
    """Sessions end after 30 quiet minutes; rows of a session are merged before they are shuffled."""
    t.spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")

    def sessions(events: DataFrame) -> DataFrame:
        found = events.withWatermark("ts", DELAY).groupBy(F.session_window("ts", "30 minutes"), "user_id").agg(F.count("*").alias("events"))
        return found.select("user_id", F.col("session_window.start").alias("started"), F.col("session_window.end").alias("ended"), "events")

    return Run(t, "sessions").append_all(t.events, sessions, end_marker(t)).rows()


def daily_counts(events: DataFrame) -> DataFrame:
    counts = events.withWatermark("ts", DELAY).groupBy(F.window("ts", "1 day")).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), "n")


@query(
    "stream_late_data",
    f"""SELECT time_bucket(INTERVAL 1 DAY, ts, {EPOCH}) AS start, count(*) AS n, TRUE AS some_dropped FROM events
        WHERE ts >= TIMESTAMP '2024-01-16' GROUP BY 1""",
)
def stream_late_data(t: Tables) -> DataFrame:
    """The first half of the month comes after the second half, and is dropped as late. A marker closes the last day."""
    feed = Feed(t, SCHEMAS["events"])
    run = Run(t, "late")
    for part in (t.events.filter("ts >= TIMESTAMP '2024-01-16'"), t.events.filter("ts < TIMESTAMP '2024-01-16'"), end_marker(t)):
        run.append(daily_counts(feed.add(part).read()))
    dropped = sum(op["numRowsDroppedByWatermark"] for p in run.progress for op in p["stateOperators"])
    return run.rows().withColumn("some_dropped", F.lit(dropped > 0))


@query(
    "stream_output_modes",
    f"""WITH d AS (SELECT time_bucket(INTERVAL 1 DAY, ts, {EPOCH}) AS start, count(*) AS n FROM events GROUP BY 1)
        SELECT 'append' AS mode, start, n FROM d UNION ALL SELECT 'update', start, n FROM d UNION ALL SELECT 'complete', start, n FROM d""",
)
def stream_output_modes(t: Tables) -> DataFrame:
    """Daily counts written under each mode, over two slices of the input; in append mode a marker closes the last day."""
    parts = []
    halves = [t.events.filter("ts < TIMESTAMP '2024-01-16 12:00:00'"), t.events.filter("ts >= TIMESTAMP '2024-01-16 12:00:00'")]
    for mode in ("append", "update", "complete"):
        feed, run = Feed(t, SCHEMAS["events"]), Run(t, mode)
        for part in [*halves, end_marker(t)] if mode == "append" else halves:
            daily = daily_counts(feed.add(part).read())
            if mode == "append":
                run.append(daily)
            else:
                run.per_batch(daily, mode)
        answer = {"append": run.rows, "update": lambda r=run: r.latest("start"), "complete": run.last}[mode]()
        parts.append(answer.select(F.lit(mode).alias("mode"), "start", "n"))
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "stream_clickstream",
    f"""WITH v AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, {EPOCH}) - i * INTERVAL 6 HOUR AS start, c_mktsegment AS segment, event_type, user_id
                   FROM events JOIN customer ON user_id = c_custkey, range(2) r(i))
        SELECT start, segment, count(*) AS views, count(*) FILTER (event_type = 'error') AS errors,
          round(count(*) FILTER (event_type = 'error') / count(*), 6) AS error_rate, count(DISTINCT user_id) AS active FROM v GROUP BY ALL""",
)
def stream_clickstream(t: Tables) -> DataFrame:
    """Views, error rate and active users per segment over sliding half days, with user data joined in.

    Events are counted per user in the stream, and the users of a closed window in the batch that reads it, so the
    number of users is exact and no state holds a list of them.
    """
    people = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    is_error = F.col("event_type") == "error"

    def per_user(events: DataFrame) -> DataFrame:
        windows = (
            events.withWatermark("ts", DELAY)
            .groupBy(F.window("ts", "12 hours", "6 hours"), "user_id")
            .agg(F.count("*").alias("views"), F.count_if(is_error).alias("errors"))
        )
        return windows.select(F.col("window.start").alias("start"), "user_id", "views", "errors")

    seen = Run(t, "clicks").append_all(t.events, per_user, end_marker(t)).rows().join(people, "user_id")
    totals = seen.groupBy("start", "segment").agg(F.sum("views").alias("views"), F.sum("errors").alias("errors"), F.count("user_id").alias("active"))
    return totals.select("start", "segment", "views", "errors", F.round(F.col("errors") / F.col("views"), 6).alias("error_rate"), "active")
