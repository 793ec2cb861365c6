"""Sums, counts and means with a stated confidence from growing samples of blocks, until the interval is narrow enough.

A table is kept in ``BLOCKS`` folders by a hash of its key, so a round reads only the blocks that are new to it. The
blocks are drawn as clusters: with totals t of m of B blocks, the whole is B times their mean, and its standard error
follows from their spread, less what a full count leaves no doubt about (1 - m / B). The mean of a column is a ratio
of two totals, with the spread of what each block departs from that ratio.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

BLOCKS = 64
#: Blocks read by the end of each round, and Student's t for 95% with one degree less; fixed values of the distribution.
STUDENT = {4: 3.182446, 8: 2.364624, 16: 2.131450, 32: 2.039513, 64: 1.998341}
MEASURES = ("count", "sum", "mean")


def block_of(key: Column, seed: int) -> Column:
    """A number below ``BLOCKS`` for a key, by multiplying and taking the high bits."""
    spread = F.pmod(F.pmod(key, F.lit(1 << 32)) * 668265263 + F.lit(seed * 97_531), F.lit(1 << 32))
    mixed = spread.bitwiseXOR(F.shiftright(spread, 15))
    return F.shiftright(F.pmod(mixed * 374761393, F.lit(1 << 32)), 26).cast("int")


def in_blocks(rows: DataFrame, key: str, value: str, seed: int = 0) -> DataFrame:
    """(block, value) of ``rows``, written once in a folder for each block."""
    path = workspace.scratch(rows.sparkSession, "blocks")
    rows.select(F.col(value).cast("double").alias("value"), block_of(F.col(key), seed).alias("block")).write.partitionBy("block").parquet(path)
    return rows.sparkSession.read.schema("value double, block int").parquet(path)


def totals(rows: DataFrame, first: int, last: int) -> DataFrame:
    """(block, n, s, known) of the blocks in [first, last), empty ones included; the others are not read."""
    every = rows.sparkSession.range(first, last).select(F.col("id").cast("int").alias("block"))
    part = rows.where((F.col("block") >= first) & (F.col("block") < last))
    counted = part.groupBy("block").agg(F.count("*").alias("n"), F.sum("value").alias("s"), F.count("value").alias("known"))
    return every.join(counted, "block", "left").fillna(0).select("block", F.col("n").cast("double").alias("n"), F.coalesce("s", F.lit(0.0)).alias("s"), F.col("known").cast("double").alias("known"))


def estimates(blocks: DataFrame, m: int) -> DataFrame:
    """(measure, estimate, half) from the totals of m blocks."""
    means = blocks.agg(*(F.avg(c).alias(f"m_{c}") for c in ("s", "known")))
    ratio = F.try_divide(F.col("m_s"), F.col("m_known"))
    left = F.col("s") - means.select(ratio).scalar() * F.col("known")
    spread = blocks.agg(
        F.avg("n").alias("m_n"),
        F.avg("s").alias("m_s"),
        F.try_divide(F.avg("s"), F.avg("known")).alias("ratio"),
        F.avg("known").alias("m_known"),
        F.var_samp("n").alias("v_n"),
        F.var_samp("s").alias("v_s"),
        (F.sum(left * left) / (m - 1)).alias("v_r"),
    )
    error = lambda v: F.sqrt(F.col(v) / m * (1 - m / BLOCKS)) * STUDENT[m]
    made = F.array(
        F.struct(F.lit("count").alias("measure"), (F.col("m_n") * BLOCKS).alias("estimate"), (error("v_n") * BLOCKS).alias("half")),
        F.struct(F.lit("sum").alias("measure"), (F.col("m_s") * BLOCKS).alias("estimate"), (error("v_s") * BLOCKS).alias("half")),
        F.struct(F.lit("mean").alias("measure"), F.col("ratio").alias("estimate"), F.try_divide(error("v_r"), F.col("m_known")).alias("half")),
    )
    return spread.select(F.inline(made))


def approximate(rows: DataFrame, within: float) -> DataFrame:
    """(round, blocks, measure, estimate, low, high): one row per round and measure, to the round that is good enough.

    ``rows``: (block, value) from ``in_blocks``. The rounds end when the half width of every measure is at most
    ``within`` of its estimate, or when all blocks are read and the answer is exact.
    """
    done, seen, out = 0, None, None
    for number, m in enumerate(STUDENT, 1):
        new = workspace.stored(totals(rows, done, m), "estimate-totals")
        seen = new if seen is None else seen.unionByName(new)
        found = estimates(seen, m).select(
            F.lit(number).alias("round"), F.lit(m).alias("blocks"), "measure", "estimate", (F.col("estimate") - F.col("half")).alias("low"), (F.col("estimate") + F.col("half")).alias("high")
        )
        out = found if out is None else out.unionByName(found)
        wide = found.where((F.col("high") - F.col("low")) / 2 > within * F.abs("estimate")).limit(1).count()
        done = m
        if not wide:
            break
    return out


WITHIN = 0.05


def _rounds_in_sql() -> str:
    parts = [
        """b AS (SELECT *, CAST(((xor(h, h >> 15) * 374761393) % 4294967296) >> 26 AS INT) AS block
             FROM (SELECT value, (event_id * 668265263) % 4294967296 AS h FROM events))""",
        f"""t AS (SELECT block, coalesce(n, 0) AS n, coalesce(s, 0) AS s, coalesce(known, 0) AS known FROM (SELECT CAST(r AS INT) AS block FROM range({BLOCKS}) v(r))
             LEFT JOIN (SELECT block, count(*) AS n, sum(value) AS s, count(value) AS known FROM b GROUP BY 1) USING (block))""",
    ]
    for number, (m, student) in enumerate(STUDENT.items(), 1):
        error = f"sqrt({{}} / {m} * (1 - {m} / {BLOCKS})) * {student}"
        parts.append(f"s{number} AS (SELECT * FROM t, (SELECT avg(s) / avg(known) AS ratio FROM t WHERE block < {m}) WHERE block < {m})")
        parts.append(
            f"""e{number} AS (SELECT 'count' AS measure, avg(n) * {BLOCKS} AS estimate, {error.format('var_samp(n)')} * {BLOCKS} AS half FROM s{number}
                 UNION ALL SELECT 'sum', avg(s) * {BLOCKS}, {error.format('var_samp(s)')} * {BLOCKS} FROM s{number}
                 UNION ALL SELECT 'mean', any_value(ratio), {error.format(f'(sum((s - ratio * known) ** 2) / ({m} - 1))')} / avg(known) FROM s{number})"""
        )
    rounds = []
    for number, m in enumerate(STUDENT, 1):
        earlier = " AND ".join(f"EXISTS (SELECT 1 FROM e{k} WHERE half > {WITHIN} * abs(estimate))" for k in range(1, number)) or "TRUE"
        rounds.append(
            f"SELECT {number} AS round, {m} AS blocks, measure, round(estimate, 4) AS estimate, round(estimate - half, 4) AS low, round(estimate + half, 4) AS high FROM e{number} WHERE {earlier}"
        )
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(rounds)}"


@query("agg_estimates", _rounds_in_sql())
def agg_estimates(t: Tables) -> DataFrame:
    """Number, sum and mean of event values within five per cent with 95% confidence, from as few blocks as it takes."""
    found = approximate(in_blocks(t.events, "event_id", "value"), WITHIN)
    return found.select("round", "blocks", "measure", *(F.round(c, 4).alias(c) for c in ("estimate", "low", "high")))
