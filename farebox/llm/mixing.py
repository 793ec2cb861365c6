"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source has a target number of words. With r = target / words of the source, each document gets floor(r) certain
whole copies, and the fraction of r that is left is its inclusion probability p for one copy more. Documents are
ranked within their source by the Pareto order (u / (1 - u)) / (p / (1 - p)), where u is a random number made from the
doc_id, and taken in this order until the words of the source's sample reach what the target leaves. The document
that crosses the mark is taken if that comes nearer. So a sample has a fixed size in words, to half a document.

No source is ordered by one task, however large: Pareto ranks are first summed by (source, slot of rank), combined
before the shuffle; running sums over the slots find the one slot of each source where the mark lies, and only the rows
of that slot are put in order. Ranks near 1 are where marks lie, and slots are evenly spread over rank / (1 + rank).

Defined cases: null, empty and blank texts have size 0 and are taken 0 words of; a null source is a source of its own,
last in order; a null doc_id and repeated rows share a random number, and ties are broken by doc_id, size and text
hash, beyond which rows are equal; an empty table or one without words gives targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import WORD

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SLOTS = 4096
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def uniform(seed: str) -> Column:
    """A number strictly between 0 and 1, the same for the same doc_id on every run: 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(source, source_size, target): shares by weight, with the excess over ``most`` times a size reshared.

    In the end every source below its cap has the same words per weight, so sources are capped in the order of
    cap / weight, up to the first whose cap lies above the words per weight that are left. One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    weighed = per_source.withColumn("weight", cycle[F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))])
    weighed = weighed.withColumn("cap", most * F.col("source_size").cast("double"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = by_cap.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    zero = F.lit(0.0)
    level = (F.sum(F.col("source_size").cast("double")).over(whole) - F.coalesce(F.sum("cap").over(before), zero)) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), zero)
    )
    leveled = weighed.withColumn("level", level)
    open_level = F.min(F.struct(F.col("cap") / F.col("weight"), "level")).alias("at")
    free = leveled.where(F.col("cap") >= F.col("level") * F.col("weight")).agg(open_level)
    return leveled.join(free).select(
        "source",
        "source_size",
        F.least("cap", F.coalesce(F.col("at.level"), zero) * F.col("weight")).alias("target"),
    )


def pareto_cut(ranked: DataFrame, strata: list[str], need: str, slots: int = SLOTS) -> DataFrame:
    """Rows (all of ``ranked``) with ``taken_extra``: 1 for those within the first ``need`` words of their stratum.

    ``ranked`` has ``size``, ``rank`` and the tie breaker ``tie``; ``need`` is the same for all rows of a stratum.
    Strata may be null.
    """
    slotted = ranked.withColumn("slot", F.floor(slots * F.col("rank") / (1 + F.col("rank"))).cast("int"))
    below = Window.partitionBy(*strata).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        slotted.groupBy(*strata, "slot")
        .agg(F.sum("size").alias("words"), F.first(need).alias("goal"))
        .withColumn("base", F.coalesce(F.sum("words").over(below), F.lit(0)))
    )
    mark = (
        sums.where((F.col("base") < F.col("goal")) & (F.col("base") + F.col("words") >= F.col("goal")))
        .groupBy(*strata)
        .agg(F.min(F.struct("slot", "base")).alias("mark"))
    )
    goal = sums.groupBy(*strata).agg(F.max("goal").alias("goal"))
    marked = goal.join(mark, [goal[s].eqNullSafe(mark[s]) for s in strata], "left").select(
        *(goal[s].alias(f"of_{s}") for s in strata), "goal", "mark"
    )
    # Written, so that its true size (a row per stratum) decides how it is joined.
    marks = workspace.stored(marked, "mix-marks")
    placed = slotted.join(marks, [F.col(s).eqNullSafe(F.col(f"of_{s}")) for s in strata])
    inside = Window.partitionBy(*strata).orderBy("rank", "tie").rowsBetween(Window.unboundedPreceding, -1)
    at_mark = placed.where(F.col("slot") == F.col("mark.slot"))
    start = F.col("mark.base") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    over, under = start + F.col("size") - F.col("goal"), F.col("goal") - start
    cut = at_mark.withColumn("taken_extra", F.when((over <= 0) | ((under > 0) & (over < under)), 1).otherwise(0))
    no_mark = F.col("mark").isNull() & (F.col("goal") > 0)  # the goal is all there is, to rounding
    rest = placed.where(F.col("mark").isNull() | (F.col("slot") != F.col("mark.slot"))).withColumn(
        "taken_extra", F.when(no_mark | F.coalesce(F.col("slot") < F.col("mark.slot"), F.lit(False)), 1).otherwise(0)
    )
    return cut.unionByName(rest).select(*ranked.columns, "taken_extra")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every document."""
    size = word_count(F.col("text"))
    tie = F.struct("doc_id", size.alias("size"), F.xxhash64("text").alias("text"))
    sizes = workspace.stored(docs.select("doc_id", "source", size.alias("size"), tie.alias("tie")), "mix-sizes")
    goals = workspace.stored(targets(sizes, weights, most).withColumnRenamed("source", "name"), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = sizes.join(goals, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    shares = joined.withColumn("whole", F.floor(ratio)).withColumn("p", ratio - F.floor(ratio))
    u = uniform(seed)
    ranked = shares.withColumn("need", F.col("target") - F.col("whole") * F.col("source_size")).withColumn(
        "rank", F.when(F.col("p") > 0, (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))).otherwise(F.lit(1e300))
    )
    copies = F.when(F.col("size") > 0, F.col("whole") + F.col("taken_extra")).otherwise(0).cast("long")
    return pareto_cut(ranked, ["source"], "need").select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken")
    )


ORACLE = rf"""
WITH z AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM z GROUP BY source),
w AS (SELECT *, (['5', '2', '1'])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
             {MOST_COPIES} * source_size::DOUBLE AS cap FROM s),
v AS (SELECT *, (sum(source_size::DOUBLE) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
      FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT arg_min(level, cap / weight) AS open FROM v WHERE cap >= level * weight),
t AS (SELECT source, source_size, least(cap, open * weight) AS target FROM v, g),
r AS (SELECT z.*, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio
      FROM z JOIN t ON z.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, ratio - floor(ratio) AS p, target - floor(ratio) * source_size AS need,
             (('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0 AS u
      FROM r),
k AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) ELSE 1e300 END AS rank FROM q),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM k),
e AS (SELECT *, (floor(ratio) + CASE WHEN start + size <= need OR (start < need AND start + size - need < need - start)
                                     THEN 1 ELSE 0 END)::BIGINT AS copies FROM c)
SELECT doc_id, source, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE copies END AS copies, copies * size AS taken FROM e
"""
