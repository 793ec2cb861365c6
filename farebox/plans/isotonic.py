"""Isotonic regression: adjacent violators are pooled inside slots of bounded size, again and again until none is left.

Equal inputs are one row before anything else. Rows are numbered along the input and cut into slots; a task pools the
violators of its slot and returns the blocks that are left. Blocks of neighbouring slots may still violate the order,
so the slots of the next round are shifted by half. Pools may be made in any order with the same result, and every
round that is needed makes blocks fewer, so the rounds end; a task never holds more than a slot's blocks.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import dense_ids
from farebox.tables import Tables

SLOT = 50_000
BLOCK = "low double, high double, weight double, total double"


def pooled(frame: pd.DataFrame) -> pd.DataFrame:
    """The blocks of a slot in which no mean is above the next one's (equal means are one block)."""
    kept: list[list[float]] = []
    for low, high, weight, total in frame.sort_values("low")[["low", "high", "weight", "total"]].itertuples(index=False):
        kept.append([low, high, weight, total])
        while len(kept) > 1 and kept[-2][3] * kept[-1][2] >= kept[-1][3] * kept[-2][2]:
            _, high, weight, total = kept.pop()
            kept[-1] = [kept[-1][0], high, kept[-1][2] + weight, kept[-1][3] + total]
    return pd.DataFrame(kept, columns=["low", "high", "weight", "total"])


def violations(blocks: DataFrame) -> bool:
    """Whether some block's mean is not below the next one's. ``blocks``: slot, and blocks pooled inside it.

    Only the first and last block of a slot can violate; the window sees one row per slot.
    """
    mean = F.col("total") / F.col("weight")
    ends = blocks.groupBy("slot").agg(F.min_by(mean, "low").alias("first"), F.max_by(mean, "low").alias("last"))
    follows = Window.orderBy("slot")
    return bool(ends.select("last", F.lead("first").over(follows).alias("next")).where("last >= next").limit(1).count())


def isotonic(rows: DataFrame, x: str, y: str, slot: int = SLOT, rising: bool = True) -> DataFrame:
    """(low, high, n, value): the blocks of the non-decreasing step function nearest to y, by the x they cover.

    Rows with a null x or y take no part.
    """
    sign = 1.0 if rising else -1.0
    blocks = (
        rows.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).cast("double").alias("low"))
        .agg(F.count("*").cast("double").alias("weight"), (F.sum(F.col(y).cast("double")) * sign).alias("total"))
        .select("low", F.col("low").alias("high"), "weight", "total")
    )
    shift = 0
    while True:
        numbered = dense_ids(blocks, ["low"]).withColumn("slot", F.floor((F.col("id") + shift) / slot))
        pools = numbered.groupBy("slot").applyInPandas(_pooled_with_slot, f"slot bigint, {BLOCK}")
        pools = workspace.stored(pools, "isotonic")
        blocks = pools.drop("slot")
        if not violations(pools):
            return blocks.select("low", "high", F.col("weight").cast("long").alias("n"), (F.col("total") / F.col("weight") * sign).alias("value"))
        shift = slot // 2 - shift


def _pooled_with_slot(frame: pd.DataFrame) -> pd.DataFrame:
    out = pooled(frame)
    out.insert(0, "slot", frame["slot"].iloc[0])
    return out


@query(
    "ml_isotonic",
    """WITH l AS (SELECT doc_id, avg(quality) AS q FROM labels WHERE quality IS NOT NULL GROUP BY 1),
         r AS (SELECT CAST(length(coalesce(text, '')) // 20 AS DOUBLE) AS x, count(*) AS w, sum(q) AS s FROM documents JOIN l USING (doc_id) GROUP BY 1),
         o AS (SELECT x, w, s, row_number() OVER (ORDER BY x) AS i, sum(w) OVER u - w AS w0, sum(s) OVER u - s AS s0, sum(w) OVER u AS w1, sum(s) OVER u AS s1 FROM r WINDOW u AS (ORDER BY x)),
         m AS (SELECT a.i AS a, b.i AS b, (b.s1 - a.s0) / (b.w1 - a.w0) AS mean FROM o a JOIN o b ON a.i <= b.i),
         lo AS (SELECT a, b AS i, min(mean) OVER (PARTITION BY a ORDER BY b DESC) AS least FROM m),
         f AS (SELECT i, round(max(least), 8) AS value FROM lo GROUP BY i)
       SELECT min(x) AS low, max(x) AS high, CAST(sum(w) AS BIGINT) AS n, value FROM f JOIN o USING (i) GROUP BY value""",
)
def ml_isotonic(t: Tables) -> DataFrame:
    """The rising step function of quality over the length of a text, one row per step."""
    labelled = t.labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.avg("quality").alias("quality"))
    rows = t.documents.select("doc_id", F.floor(F.length(F.coalesce("text", F.lit(""))) / 20).alias("size")).join(labelled, "doc_id")
    return isotonic(rows, "size", "quality", slot=200).withColumn("value", F.round("value", 8))
