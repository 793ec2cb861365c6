"""Stream sources, sinks, triggers, recovery, joins and state."""

import json
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from farebox import workspace
from farebox.registry import query
from farebox.scale import dense_ids
from farebox.streaming.runs import Feed, Run, end_marker
from farebox.tables import SCHEMAS, Tables

BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"
STOP_WORDS = ["the", "of", "and", "der", "la"]  # fixed values: words left out of the count


@query("stream_rate", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def stream_rate(t: Tables) -> DataFrame:
    """Counted ticks, one per order, joined to the order of that number. Orders are numbered: their keys may have gaps."""
    ticks = t.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", t.orders.count()).load()
    orders = dense_ids(t.orders.select("o_orderkey", "o_orderpriority"), ["o_orderkey"], "value").drop("o_orderkey")
    run = Run(t, "rate")
    stream = ticks.join(orders, "value").select("o_orderpriority")
    writer = stream.writeStream.format("parquet").option("checkpointLocation", run.checkpoint)
    writer.trigger(availableNow=True).start(run.out).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(run.out).groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "stream_files",
    """SELECT source, count(*) AS n, round(sum(value), 2) AS total FROM events, (VALUES ('json'), ('csv'), ('orc'), ('parquet')) v(source) GROUP BY 1
       UNION ALL SELECT 'binaryFile', 1, 0""",
)
def stream_files(t: Tables) -> DataFrame:
    """Streams over files of five formats in one query. Two slices arrive; files are taken a few at a time."""
    schema = "event_id bigint, event_type string, value double"
    feeds = [Feed(t, schema, fmt) for fmt in ("json", "csv", "orc", "parquet")]
    run = Run(t, "files")

    def all_feeds() -> DataFrame:
        streams = [f.read(maxFilesPerTrigger=2).select(F.lit(f.fmt).alias("source"), F.lit(1).alias("rows"), "value") for f in feeds]
        raw = t.spark.readStream.format("binaryFile").schema(BINARY_FILE).load(t.pattern("region"))
        streams.append(raw.select(F.lit("binaryFile").alias("source"), F.lit(1).alias("rows"), F.lit(0.0).alias("value")))
        first, *rest = streams
        for other in rest:
            first = first.unionByName(other)
        return first

    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        for feed in feeds:
            feed.add(t.events.filter(part).select("event_id", "event_type", "value"))
        run.append(all_feeds())
    return run.rows().groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("value"), 2).alias("total"))


def word_stream(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.select(F.explode(F.split(F.lower(column), r"\s+")).alias("word")).filter("word <> ''")


@query(
    "stream_wordcount",
    r"""SELECT word, count(*) AS n, CAST(sum(length(word)) AS BIGINT) AS letters FROM
        (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1""",
)
def stream_wordcount(t: Tables) -> DataFrame:
    """Running word count over text files, the whole table after every batch."""
    feed, run = Feed(t, "value string", "text"), Run(t, "words")
    feed.add(t.documents.select("text"))
    counts = (
        word_stream(feed.read())
        .withColumn("letters", F.length("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"), F.sum("letters").alias("letters"))
    )
    return run.per_batch(counts, "complete").last()


@query(
    "stream_filter",
    "SELECT doc_id, lang FROM documents WHERE contains(text, 'license') OR contains(text, 'the ')",
)
def stream_filter(t: Tables) -> DataFrame:
    """Keep the texts that hold a phrase."""
    kept = t.stream("documents").filter(F.col("text").contains("license") | F.col("text").contains("the "))
    return Run(t, "grep").append(kept.select("doc_id", "lang")).rows()


@query(
    "stream_union",
    "SELECT kind, event_type, count(*) AS n FROM (SELECT 'busy' AS kind, event_type FROM events WHERE event_type IN ('click', 'view') UNION ALL SELECT 'rare', event_type FROM events WHERE value > 100) GROUP BY ALL",
)
def stream_union(t: Tables) -> DataFrame:
    busy = t.stream("events").filter(F.col("event_type").isin("click", "view")).select(F.lit("busy").alias("kind"), "event_type")
    rare = t.stream("events").filter("value > 100").select(F.lit("rare").alias("kind"), "event_type")
    counts = busy.union(rare).groupBy("kind", "event_type").agg(F.count("*").alias("n"))
    return Run(t, "union").per_batch(counts, "complete").last()


@query(
    "stream_sinks",
    """SELECT 'parquet' AS sink, event_type, count(*) AS n FROM events GROUP BY 2 UNION ALL SELECT 'memory', event_type, count(*) FROM events GROUP BY 2
       UNION ALL SELECT 'text', 'all', count(*) FROM events""",
)
def stream_sinks(t: Tables) -> DataFrame:
    """Partitioned files, text files, and a table in memory (for a result of five rows)."""
    events = t.stream("events")
    files = Run(t, "sink-files").append(events.select("event_id", "event_type"), "event_type").rows()
    text = Run(t, "sink-text")
    lines = events.select(F.concat_ws(",", F.col("event_id").cast("string"), "event_type").alias("value"))
    writer = lines.writeStream.format("text").option("checkpointLocation", text.checkpoint).option("path", text.out)
    writer.trigger(availableNow=True).start().awaitTermination()
    name = f"sink_{uuid.uuid4().hex}"
    counts = events.groupBy("event_type").agg(F.count("*").alias("n"))
    memory = counts.writeStream.format("memory").queryName(name).outputMode("complete")
    memory.trigger(availableNow=True).start().awaitTermination()
    by_type = files.groupBy("event_type").agg(F.count("*").alias("n"))
    return (
        by_type.select(F.lit("parquet").alias("sink"), "event_type", "n")
        .union(t.spark.table(name).select(F.lit("memory"), "event_type", "n"))
        .union(t.spark.read.text(text.out).agg(F.lit("text"), F.lit("all"), F.count("*")))
    )


@query(
    "stream_triggers",
    "SELECT kind, count(*) AS n, FALSE AS failed, FALSE AS running FROM events, (VALUES ('available now'), ('once'), ('interval')) v(kind) GROUP BY 1",
)
def stream_triggers(t: Tables) -> DataFrame:
    """The same count under three triggers, with the state of the handle after the end."""
    parts = []
    for kind, trigger in (("available now", {"availableNow": True}), ("once", {"once": True}), ("interval", {"processingTime": "1 second"})):
        run = Run(t, "trigger")
        stream = t.stream("events").select("event_id")
        writer = stream.writeStream.format("parquet").option("checkpointLocation", run.checkpoint)
        handle = writer.trigger(**trigger).start(run.out)
        if kind == "interval":
            handle.processAllAvailable()
            handle.stop()
        handle.awaitTermination()
        found = t.spark.read.schema(stream.schema).parquet(run.out).agg(F.count("*").alias("n"))
        failed, running = handle.exception() is not None, handle.status["isTriggerActive"]
        parts.append(found.select(F.lit(kind).alias("kind"), "n", F.lit(failed).alias("failed"), F.lit(running).alias("running")))
    return parts[0].union(parts[1]).union(parts[2])


@query(
    "stream_recovery",
    r"""WITH w AS (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents)
        SELECT word, count(*) AS n, (SELECT count(*) FROM w WHERE word IN ('the', 'of', 'and', 'der', 'la')) AS left_out
        FROM w WHERE word <> '' AND word NOT IN ('the', 'of', 'and', 'der', 'la') GROUP BY 1""",
)
def stream_recovery(t: Tables) -> DataFrame:
    """Word count that stops after each slice and resumes from its checkpoint.

    Left-out words are joined away; a counter observed on the way says how many there were.
    """
    spark = t.spark
    feed, run = Feed(t, SCHEMAS["documents"]), Run(t, "recovery")
    left_out = spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")
    for part in range(3):
        feed.add(t.documents.filter(F.pmod("doc_id", F.lit(3)) == part))
        words = word_stream(feed.read(), "text").observe("words", F.count_if(F.col("word").isin(STOP_WORDS)).alias("left_out"))
        counts = words.join(F.broadcast(left_out), "word", "left_anti").groupBy("word").agg(F.count("*").alias("n"))
        run.per_batch(counts, "update")
    dropped = run.observed("words", "left_out")
    return run.latest("word").withColumn("left_out", F.lit(dropped).cast("bigint"))


class CountPerTask:
    """Row sink: counts the rows of one task and writes the count when the task ends.

    The file is named by partition and batch, so a task that runs again replaces it.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def open(self, partition: int, epoch: int) -> bool:
        self.name, self.count = f"{epoch}-{partition}", 0
        return True

    def process(self, row) -> None:
        self.count += 1

    def close(self, error) -> None:
        store, base = workspace.file_store(self.folder)
        store.create_dir(base, recursive=True)
        if error is None:
            with store.open_output_stream(f"{base}/{self.name}.json") as out:
                out.write(json.dumps({"rows": self.count}).encode())


@query(
    "stream_foreach_batch",
    """SELECT event_type, count(*) AS n, max(value) AS peak, (SELECT count(*) FROM events) AS rows_by_row FROM events GROUP BY 1""",
)
def stream_foreach_batch(t: Tables) -> DataFrame:
    """SQL over each micro-batch, written per batch; beside it a sink that is handed single rows."""

    def summarise(batch: DataFrame, epoch: int) -> DataFrame:
        return batch.sparkSession.sql(
            "SELECT event_type, count(*) AS n, max(value) AS peak FROM {batch} GROUP BY event_type", batch=batch
        )

    feed, run = Feed(t, SCHEMAS["events"]), Run(t, "foreach")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        feed.add(t.events.filter(part))
        run.per_batch(feed.read(), "append", summarise)
    rows = Run(t, "foreach-row")
    writer = feed.read().select("event_id").writeStream.foreach(CountPerTask(rows.out))
    writer.option("checkpointLocation", rows.checkpoint).trigger(availableNow=True).start().awaitTermination()
    seen = t.spark.read.schema("rows bigint").json(rows.out).agg(F.sum("rows").alias("rows_by_row"))
    totals = run.batches().groupBy("event_type").agg(F.sum("n").alias("n"), F.max("peak").alias("peak"))
    return totals.withColumn("rows_by_row", seen.scalar())


@query(
    "stream_static_join",
    """SELECT *, CAST(rank() OVER (ORDER BY n * weight DESC, event_type) AS BIGINT) AS place FROM (SELECT event_type, weight, count(*) AS n FROM events
       JOIN (VALUES ('purchase', 5), ('click', 2), ('view', 1), ('error', -4)) v(kind, weight) ON event_type = kind GROUP BY 1, 2)""",
)
def stream_static_join(t: Tables) -> DataFrame:
    """Weigh event types by a static table and rank them in every batch."""
    weights = t.spark.createDataFrame([("purchase", 5), ("click", 2), ("view", 1), ("error", -4)], "event_type string, weight bigint")

    def rank(batch: DataFrame, epoch: int) -> DataFrame:
        # One row per event type by now.
        order = Window.orderBy(F.desc(F.col("n") * F.col("weight")), "event_type")
        return batch.withColumn("place", F.rank().over(order).cast("bigint"))

    counts = t.stream("events").join(F.broadcast(weights), "event_type").groupBy("event_type", "weight").agg(F.count("*").alias("n"))
    return Run(t, "static-join").per_batch(counts, "complete", rank).last()


@query(
    "stream_stream_join",
    """WITH l AS (SELECT * FROM events WHERE event_type IN ('click', 'view')), r AS (SELECT * FROM events WHERE value > 50),
        j AS (SELECT l.event_id AS seen, l.user_id, r.event_id AS paid, r.value FROM l FULL JOIN r ON l.event_id = r.event_id)
        SELECT 'inner' AS kind, * FROM j WHERE seen IS NOT NULL AND paid IS NOT NULL UNION ALL SELECT 'left_outer', * FROM j WHERE seen IS NOT NULL
        UNION ALL SELECT 'right_outer', * FROM j WHERE paid IS NOT NULL UNION ALL SELECT 'full_outer', * FROM j""",
)
def stream_stream_join(t: Tables) -> DataFrame:
    """Two streams about the same events, joined on the event under four join types.

    The time bound lets old state go. Two markers past the end, one for either side, close the wait for partners of
    the last rows; they are not each other's partner.
    """

    def seen(events: DataFrame) -> DataFrame:
        kept = events.filter("event_type IN ('click', 'view')").withWatermark("ts", "1 hour")
        return kept.select(F.col("event_id").alias("seen"), "user_id", F.col("ts").alias("seen_ts"))

    def paid(events: DataFrame) -> DataFrame:
        kept = events.filter("value > 50").withWatermark("ts", "1 hour")
        return kept.select(F.col("event_id").alias("paid"), "value", F.col("ts").alias("paid_ts"))

    markers = end_marker(t, -1, "click", 0.0).union(end_marker(t, -2, "marker", 100.0))
    on = F.expr("seen = paid AND paid_ts >= seen_ts AND paid_ts <= seen_ts + INTERVAL 1 HOUR")
    parts = []
    for kind in ("inner", "left_outer", "right_outer", "full_outer"):
        run = Run(t, kind).append_all(t.events, lambda e, kind=kind: seen(e).join(paid(e), on, kind), markers)
        parts.append(run.rows().withColumn("kind", F.lit(kind)))
    every = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    return every.select("kind", "seen", "user_id", "paid", "value")


def count_rows(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    (seen,) = state.get if state.exists else (0,)
    seen += sum(int(piece["n"].sum()) for piece in pieces)
    state.update((seen,))
    yield pd.DataFrame({"user_id": [key[0]], "n": [seen]})


def combine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Add up the rows of an Arrow batch before they are shuffled."""
    for batch in batches:
        yield batch.groupby("user_id", as_index=False).agg(n=("n", "sum"))


@query(
    "stream_stateful",
    "SELECT user_id, count(*) + (SELECT count(*) FROM orders WHERE o_custkey = user_id) AS n FROM events GROUP BY 1",
)
def stream_stateful(t: Tables) -> DataFrame:
    """Running count per user kept in state of our own, on top of counts known before the start.

    Rows are combined before they move, so a busy user is a row of each Arrow batch, and one state is enough for each user.
    """
    feed, run = Feed(t, SCHEMAS["events"]), Run(t, "stateful")
    layout = "user_id bigint, n bigint"
    for part in ("event_id % 3 = 0", "event_id % 3 <> 0"):
        rows = feed.add(t.events.filter(part)).read().select("user_id", F.lit(1).cast("bigint").alias("n"))
        counts = (
            rows.mapInPandas(combine, layout)
            .groupBy("user_id")
            .applyInPandasWithState(count_rows, layout, "seen bigint", "update", GroupStateTimeout.NoTimeout)
        )
        run.per_batch(counts, "update")
    counted = run.latest("user_id").withColumnRenamed("n", "counted")
    known = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("known"))
    return counted.join(known, "user_id", "left").select("user_id", (F.col("counted") + F.coalesce("known", F.lit(0))).alias("n"))


GAP = 30 * 60 * 1_000_000  # microseconds of quiet that end a session


def squeeze(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Merge events of a user that lie less than a gap apart inside one Arrow batch."""
    for batch in batches:
        batch = batch.sort_values(["user_id", "at"])
        fresh = (batch["user_id"] != batch["user_id"].shift()) | (batch["at"].diff() >= GAP)
        piece = batch.groupby(fresh.cumsum()).agg(user_id=("user_id", "first"), first=("at", "min"), last=("at", "max"), n=("at", "size"))
        yield piece.assign(last_ts=pd.to_datetime(piece["last"], unit="us", utc=True))[["user_id", "first", "last", "n", "last_ts"]]


def merge_spans(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Join (first, last, count) spans that are less than a gap apart."""
    merged: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if merged and first < merged[-1][1] + GAP:
            before = merged[-1]
            merged[-1] = (before[0], max(before[1], last), before[2] + n)
        else:
            merged.append((first, last, n))
    return merged


def track_sessions(key, pieces: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep the open sessions of a user; hand out those the watermark has closed."""
    spans = list(zip(*state.get)) if state.exists else []
    for piece in pieces:
        spans = merge_spans(spans + list(zip(piece["first"].tolist(), piece["last"].tolist(), piece["n"].tolist())))
    watermark = state.getCurrentWatermarkMs()
    done = [s for s in spans if (s[1] + GAP) // 1000 < watermark]
    still_open = [s for s in spans if (s[1] + GAP) // 1000 >= watermark]
    if still_open:
        state.update(tuple(list(column) for column in zip(*still_open)))
        state.setTimeoutTimestamp(max(min(s[1] for s in still_open) // 1000 + GAP // 1000, watermark + 1))
    elif state.exists:
        state.remove()
    yield pd.DataFrame(
        {"user_id": [key[0]] * len(done), "first": [s[0] for s in done], "last": [s[1] for s in done], "events": [s[2] for s in done]}
    ).astype("int64")


@query(
    "stream_session_state",
    """WITH e AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 30 MINUTE OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            s AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM e)
       SELECT user_id, min(ts) AS started, max(ts) AS last_event, count(*) AS events FROM s GROUP BY user_id, session""",
)
def stream_session_state(t: Tables) -> DataFrame:
    """The sessions again, with hand-kept state and an event-time timeout per user.

    Events are merged into spans inside each Arrow batch, so little of a busy user is shuffled.
    """
    feed, run = Feed(t, SCHEMAS["events"]), Run(t, "session-state")
    early = F.col("ts") < "2024-01-16 12:00:00"
    for part in (t.events.filter(early), t.events.filter(~early), end_marker(t)):
        spans = (
            feed.add(part)
            .read()
            .select("user_id", F.unix_micros("ts").alias("at"))
            .mapInPandas(squeeze, "user_id bigint, first bigint, last bigint, n bigint, last_ts timestamp")
            .withWatermark("last_ts", "1 hour")
        )
        sessions = spans.groupBy("user_id").applyInPandasWithState(
            track_sessions,
            "user_id bigint, first bigint, last bigint, events bigint",
            "first array<bigint>, last array<bigint>, n array<bigint>",
            "append",
            GroupStateTimeout.EventTimeTimeout,
        )
        run.append(sessions)
    return (
        run.rows()
        .select("user_id", F.timestamp_micros("first").alias("started"), F.timestamp_micros("last").alias("last_event"), "events")
    )


WELCH = "(mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b)"


@query(
    "stream_ab_test",
    """WITH g AS (SELECT count(*) FILTER (user_id % 2 = 0) AS n_a, count(*) FILTER (user_id % 2 = 1) AS n_b, avg(value) FILTER (user_id % 2 = 0) AS mean_a,
         avg(value) FILTER (user_id % 2 = 1) AS mean_b, var_samp(value) FILTER (user_id % 2 = 0) AS var_a, var_samp(value) FILTER (user_id % 2 = 1) AS var_b FROM events)
       SELECT n_a, n_b, round(mean_a, 6) AS mean_a, round(mean_b, 6) AS mean_b, round((mean_a - mean_b) / sqrt(var_a / n_a + var_b / n_b), 5) AS t FROM g""",
)
def stream_ab_test(t: Tables) -> DataFrame:
    """Welch's t between two groups of users, from sums that every batch adds to."""

    def sums(batch: DataFrame, epoch: int) -> DataFrame:
        is_a = F.col("user_id") % 2 == 0
        return batch.groupBy(is_a.alias("is_a")).agg(
            F.count("*").alias("n"), F.sum("value").alias("s"), F.sum(F.col("value") ** 2).alias("s2")
        )

    feed, run = Feed(t, SCHEMAS["events"]), Run(t, "ab")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        feed.add(t.events.filter(part))
        run.per_batch(feed.read(), "append", sums)

    def of(group: str, name: str):
        return F.sum(F.when(F.col("is_a") if group == "a" else ~F.col("is_a"), F.col(name)))

    totals = run.batches().agg(*(of(g, c).alias(f"{c}_{g}") for g in "ab" for c in ("n", "s", "s2")))
    for g in "ab":
        totals = totals.withColumn(f"mean_{g}", F.col(f"s_{g}") / F.col(f"n_{g}")).withColumn(
            f"var_{g}", (F.col(f"s2_{g}") - F.col(f"s_{g}") * F.col(f"mean_{g}")) / (F.col(f"n_{g}") - 1)
        )
    return totals.select(
        "n_a", "n_b", F.round("mean_a", 6).alias("mean_a"), F.round("mean_b", 6).alias("mean_b"), F.round(F.expr(WELCH), 5).alias("t")
    )
