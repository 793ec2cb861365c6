"""Small helpers that keep jobs even when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from farebox import workspace

ROWS_PER_CHUNK = 10_000
#: For running totals whose differences are wanted: doubles lose the digits of small values as a total grows.
EXACT = "decimal(38,12)"


def parts_of(df: DataFrame) -> int:
    """The cluster's own number of shuffle partitions, for the few places that must name one."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def join_same(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, where a null equals a null; Spark plans it as it does plain equality. Keys come once."""
    renamed = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys))
    return left.join(renamed, on, how).drop(*(f"_same_{k}" for k in keys))


def sorted_slots(df: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """``df`` sorted by range and written once, with ``_place`` (growing along the order) and ``_slot``.

    A slot is a partition of the sort: consecutive rows of bounded number, so that a key with most of the rows is
    spread over many slots. ``order`` should end in a unique column.
    """
    placed = workspace.stored(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "sorted")
    return placed.withColumn("_slot", F.shiftright("_place", 33))


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """``row_number`` per key, with no key ordered by one task and no window over the rows.

    Rows of a key are neighbours in the sort, so a row's number is its place less the first place of its key in the
    slot, plus the rows of the key in earlier slots. Null keys and null order values are kept, as by a window.
    """
    placed = sorted_slots(df, [*keys, *order])
    ahead = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy(*keys, "_slot").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
    shift = F.coalesce(F.sum("_n").over(ahead), F.lit(0)) - F.col("_first") + 1
    shifts = counts.select(*keys, "_slot", shift.alias("_shift"))
    joined = join_same(placed, shifts, [*keys, "_slot"])
    return joined.select(*df.columns, (F.col("_place") + F.col("_shift")).alias(name))


def in_blocks(df: DataFrame, rn: str, size: int, before: int = 0, after: int = 0) -> DataFrame:
    """Split numbered rows into blocks of ``size``, with the neighbours each block needs.

    A block also gets copies of the ``before`` last rows ahead of it and the ``after``
    first rows behind it (marked ``_halo``), so a row frame of that reach is exact
    inside (key, block). Needs ``before`` and ``after`` below ``size``.
    """
    zero = F.col(rn) - 1
    home = F.floor(zero / size)
    at = F.pmod(zero, F.lit(size))
    targets = F.array(
        home,
        F.when(at >= size - before, home + 1),
        F.when(at < after, home - 1),
    )
    return (
        df.withColumn("_home", home)
        .withColumn("_block", F.explode(F.array_compact(targets)))
        .withColumn("_halo", F.col("_block") != F.col("_home"))
        .drop("_home")
    )


def dense_ids(df: DataFrame, order: Sequence[Column | str], name: str = "id", start: int = 0) -> DataFrame:
    """Consecutive ids along ``order`` with no single-task window.

    The rows are sorted by range and written once with their place in the partition;
    ids then add the sizes of the partitions before. ``order`` should end in a unique
    key, so that one frequent value can be split over several ranges.
    """
    placed = sorted_slots(df, order).withColumn("_pos", F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)))
    # One row per slot: the window below never sees more rows than there are slots.
    ahead = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slot", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    )
    return (
        placed.join(offsets, "_slot")
        .withColumn(name, F.col("_offset") + F.col("_pos") + F.lit(start))
        .drop("_place", "_slot", "_pos", "_offset")
    )


def chunked(df: DataFrame, keys: Sequence[str], unique: Sequence[str], rows: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``_chunk`` so that (key, chunk) groups hold about ``rows`` rows, however big the key. Keys may be null."""
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    chunk = F.pmod(F.xxhash64(*unique), F.ceil(F.col("_n") / rows))
    return join_same(df, sizes, keys).select(*df.columns, chunk.alias("_chunk"))


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], values: Sequence[str], names: Sequence[str]
) -> DataFrame:
    """Running sums of ``values`` per key: inside the slots of a range sort, plus the sums of earlier slots.

    Null values add nothing; before the first value of a key the sum is null, as in SQL. Keys may be null.
    """
    placed = sorted_slots(df, [*keys, *order])
    inside = [*keys, "_slot"]
    ahead = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    frame = Window.partitionBy(*inside).orderBy("_place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = placed.groupBy(*inside).agg(*(F.sum(v).alias(f"_sum_{n}") for v, n in zip(values, names)))
    offsets = sums.select(*inside, *(F.sum(f"_sum_{n}").over(ahead).alias(f"_offset_{n}") for n in names))
    local = placed.select("*", *(F.sum(v).over(frame).alias(f"_local_{n}") for v, n in zip(values, names)))
    joined = join_same(local, offsets, inside)

    def total(n: str) -> Column:
        offset, here = F.col(f"_offset_{n}"), F.col(f"_local_{n}")
        kind = local.schema[f"_local_{n}"].dataType
        if isinstance(kind, DecimalType):  # one digit less before the point, or the sum would have one place less
            offset, here = (c.cast(DecimalType(37, kind.scale)) for c in (offset, here))
        return F.coalesce(offset + here, offset, here).alias(n)

    return joined.select(*df.columns, *(total(n) for n in names))
