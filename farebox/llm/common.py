"""What the text operators share: row numbers, words, columns with clashing names."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(text: Column) -> Column:
    """Lower case for A to Z only, whatever the locale."""
    return F.translate(text, ASCII_UPPER, ASCII_UPPER.lower())


def utf8(text: Column) -> Column:
    """The bytes of a text (null: none), so that tasks need not decode and encode again."""
    return F.coalesce(text.cast("binary"), F.lit(b"").cast("binary"))


#: Texts that a Python task holds at a time. Texts may be long, so far fewer than Spark's 10,000.
BATCH_TEXTS = 400


def in_small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batch size to ``BATCH_TEXTS`` rows, for functions over whole texts.

    The size is read when a query is planned, so it stays lowered; a smaller one of the user's own is kept.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    size = int(df.sparkSession.conf.get(name))
    if size <= 0 or size > BATCH_TEXTS:
        df.sparkSession.conf.set(name, str(BATCH_TEXTS))
    return df


def vectorized(returns: str):
    """A pandas UDF that is built when it is called: a type given as text cannot be read before a session is there."""

    def wrap(fn):
        def call(*columns: Column | str) -> Column:
            return F.pandas_udf(fn, returns)(*columns)

        call.__doc__ = fn.__doc__
        return call

    return wrap


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def frames(rows: Iterator[dict], columns: list[str], size: int = 50_000) -> Iterator[pd.DataFrame]:
    """Gather the rows that a task makes into frames of bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)
