"""Database tables over JDBC, read and written by many tasks at once.

Not in the query catalogue: it needs a database that all executors reach.
"""

from pyspark.sql import DataFrame, SparkSession


def read_table(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, parts: int, fetch: int = 10_000, **options: str
) -> DataFrame:
    """Split ``table`` into ``parts`` ranges of ``column``, one connection each.

    Rows outside [low, high] are kept: they fall in the first and last range.
    """
    return spark.read.jdbc(
        url, table, column=column, lowerBound=low, upperBound=high, numPartitions=parts,
        properties={"fetchsize": str(fetch), **options},
    )


def read_slices(spark: SparkSession, url: str, table: str, predicates: list[str], **options: str) -> DataFrame:
    """One task per condition; together the conditions must cover each row once."""
    return spark.read.jdbc(url, table, predicates=predicates, properties=options)


def write_table(df: DataFrame, url: str, table: str, mode: str = "errorifexists", batch: int = 10_000, connections: int = 16, **options: str) -> None:
    """Write in batches, over at most ``connections`` connections."""
    df.write.option("numPartitions", connections).option("batchsize", batch).jdbc(url, table, mode=mode, properties=options)
