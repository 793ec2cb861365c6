"""Running a stream over the data at hand and reading what it wrote.

Every run keeps its input, output and checkpoint in the shared folder. A run ends when
the available files are used up (``availableNow``) and can be resumed on more files.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from farebox import workspace
from farebox.tables import Tables


def end_marker(t: Tables, event_id: int = -1, event_type: str = "click", value: float = 0.0) -> DataFrame:
    """One event two days after the last, to close what is still open; its id is none of the table's."""
    row = F.struct(
        F.lit(event_id).cast("bigint").alias("event_id"),
        (F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"),
        F.lit(-1).cast("bigint").alias("user_id"),
        F.lit(event_type).alias("event_type"),
        F.lit(value).alias("value"),
        F.lit(None).cast("string").alias("props"),
    )
    return t.events.agg(row.alias("e")).where("e.ts IS NOT NULL").select("e.*")


class Feed:
    """A folder that fills up slice by slice, read as a stream."""

    def __init__(self, t: Tables, schema: str | StructType, fmt: str = "parquet"):
        self.t, self.schema, self.fmt = t, schema, fmt
        self.path = workspace.scratch(t.spark, f"feed-{fmt}")

    def add(self, rows: DataFrame, **options) -> Feed:
        rows.write.mode("append").format(self.fmt).options(**options).save(self.path)
        return self

    def read(self, **options) -> DataFrame:
        return self.t.spark.readStream.format(self.fmt).schema(self.schema).options(**options).load(self.path)


class Run:
    """One streaming query with its checkpoint and output folder."""

    def __init__(self, t: Tables, label: str):
        self.t = t
        self.out = workspace.scratch(t.spark, f"{label}-out")
        self.checkpoint = workspace.scratch(t.spark, f"{label}-checkpoint")
        self.progress: list = []

    def _finish(self, query: StreamingQuery) -> None:
        query.awaitTermination()
        self.progress += query.recentProgress

    def append(self, stream: DataFrame, *by: str) -> Run:
        """Append finished rows to files; the sink's log makes each batch count once."""
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", self.checkpoint)
        if by:
            writer = writer.partitionBy(*by)
        self.schema = stream.schema
        self._finish(writer.trigger(availableNow=True).start(self.out))
        return self

    def per_batch(self, stream: DataFrame, mode: str, step: Callable[[DataFrame, int], DataFrame] | None = None) -> Run:
        """Write each batch to a folder of its own; a batch that runs again replaces it."""
        out = self.out

        def write(batch: DataFrame, epoch: int) -> None:
            (step(batch, epoch) if step else batch).write.mode("overwrite").parquet(f"{out}/batch={epoch}")

        writer = stream.writeStream.outputMode(mode).option("checkpointLocation", self.checkpoint).foreachBatch(write)
        self._finish(writer.trigger(availableNow=True).start())
        return self

    def append_all(self, rows: DataFrame, stream: Callable[[DataFrame], DataFrame], markers: DataFrame) -> Run:
        """An append run over ``rows``, and then over ``markers`` that lie past the end of every window.

        The markers move the watermark on, so that all windows of ``rows`` are closed and written; their own are not.
        """
        feed = Feed(self.t, rows.schema)
        for part in (rows, markers):
            self.append(stream(feed.add(part).read()))
        return self

    def rows(self) -> DataFrame:
        """All rows of an append run."""
        return self.t.spark.read.schema(self.schema).parquet(self.out)

    def batches(self) -> DataFrame:
        """All rows of a per-batch run, with their batch number."""
        return self.t.spark.read.parquet(self.out)

    def last(self) -> DataFrame:
        """Rows of the last batch, the whole answer in complete mode."""
        newest = self.batches().agg(F.max("batch").alias("batch"))
        return self.batches().join(F.broadcast(newest), "batch").drop("batch")

    def latest(self, *keys: str) -> DataFrame:
        """The newest row of each key, the whole answer in update mode."""
        rows = self.batches()
        values = F.struct(*(c for c in rows.columns if c not in keys and c != "batch"))
        newest = rows.groupBy(*keys).agg(F.max_by(values, "batch").alias("_v"))
        return newest.select(*keys, "_v.*")

    def observed(self, name: str, field: str) -> int:
        """Sum of an observed counter over the batches of this run."""
        found = [p["observedMetrics"].get(name) for p in self.progress]
        return sum(row[field] for row in found if row is not None)
