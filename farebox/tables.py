"""Typed access to the input tables.

Schemas are declared, so no job runs to infer them and stream readers can use
the same text. Timestamps are read as instants; the session zone is UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp",
    "events": "event_id bigint, ts timestamp, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """``Tables(spark, dir).orders`` is the lazy scan of that table."""

    def __init__(self, spark: SparkSession, path: str):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.path = path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        return self.spark.read.schema(SCHEMAS[name]).parquet(self.file(name))

    def file(self, name: str) -> str:
        return f"{self.path}/{name}.parquet"

    def pattern(self, name: str) -> str:
        """A glob for the table alone: stream sources take a single file only by pattern."""
        return f"{self.path}/{name}.parque[t]"

    def stream(self, name: str, **options) -> DataFrame:
        """The same table, a file or a folder of files, read as an unbounded stream."""
        return self.spark.readStream.schema(SCHEMAS[name]).options(**options).parquet(self.pattern(name))
