"""Where jobs keep written tables, stream checkpoints and cut lineage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import Column, DataFrame, SparkSession


#: What was made so far: (session, table or None for a file, its name).
_made: list[tuple[str, bool, str]] = []


def _session(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def qualified(spark: SparkSession, path: str) -> str:
    """The full address of a path: without a scheme it is one of the default file system, for Spark and Python alike."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(hadoop).toString().rstrip("/")


def root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a folder of the default file system is taken, but only for a local master of one process:
    whether other executors could read it is not known.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        tmp = spark.sparkContext._jsc.hadoopConfiguration().get("hadoop.tmp.dir")
        base = f"{tmp}/farebox-{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", base)
    return qualified(spark, base)


def scratch(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{root(spark)}/{label}-{uuid.uuid4().hex}"
    _made.append((_session(spark), False, path))
    return path


def clean_up(spark: SparkSession) -> int:
    """Remove what this session has written below the shared folder so far, and tables over it; how many files or folders.

    Results still to be read go too.
    """
    mine, removed = _session(spark), 0
    for entry in [e for e in _made if e[0] == mine]:
        _made.remove(entry)
        _, table, name = entry
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            continue
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        removed += hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    return removed


def file_store(folder: str):
    """The pyarrow file system of ``folder`` and the path inside it, for tasks that write files themselves."""
    from pyarrow import fs

    parts = urlparse(folder)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(folder)


#: Spark removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Plan with ``key`` at ``value``, and put back what was there."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and read it back, so that later steps all see the same rows.

    What was shuffled for it is not needed any more then, and its files go at once.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    with setting(spark, SHUFFLE_CLEANUP, "true"):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str | Sequence[str], label: str, counted: dict[str, Column] | None = None, n: int | None = None) -> DataFrame:
    """Write ``df`` once, bucketed and sorted by ``key``: joins and groups on the key move none of its rows again.

    There are ``n`` buckets, or as many as shuffle partitions, so that the other side of a join is dealt out alike, and each
    task writes one bucket. A bucket cannot be split, so no key may have too many rows. ``counted`` are columns over windows
    of ``key``, which are made where the rows have been dealt out.
    """
    spark, name, keys = df.sparkSession, f"{label}_{uuid.uuid4().hex}", [key] if isinstance(key, str) else list(key)
    n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartition(n, *keys).withColumns(counted or {}).write.bucketBy(n, *keys).sortBy(*keys)
    dealt.option("path", scratch(spark, label)).saveAsTable(name)
    _made.append((_session(spark), True, name))
    return spark.table(name)


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: drops the lineage of an iterative job."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root(spark))
    return df.checkpoint()
