"""File sources and sinks: what is written is read back and compared with the source table."""

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farebox import workspace
from farebox.registry import query
from farebox.tables import SCHEMAS, Tables

ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders"


def some_orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")


@query("io_parquet_roundtrip", ORDERS + " WHERE o_totalprice > 100000")
def io_parquet_roundtrip(t: Tables) -> DataFrame:
    path = workspace.scratch(t.spark, "parquet")
    some_orders(t).write.parquet(path, compression="zstd")
    return t.spark.read.parquet(path).filter("o_totalprice > 100000")


@query("io_orc_roundtrip", ORDERS)
def io_orc_roundtrip(t: Tables) -> DataFrame:
    path = workspace.scratch(t.spark, "orc")
    some_orders(t).write.orc(path)
    return t.spark.read.orc(path)


@query("io_json_roundtrip", "SELECT event_id, event_type, value, 'click' AS tag, 0 AS broken FROM events")
def io_json_roundtrip(t: Tables) -> DataFrame:
    """JSON lines with nested values; lines that do not parse go to their own column."""
    path = workspace.scratch(t.spark, "json")
    nested = t.events.select("event_id", "event_type", "value", F.array(F.lit("click")).alias("tags"))
    nested.write.json(path)
    schema = "event_id bigint, event_type string, value double, tags array<string>, _corrupt_record string"
    back = t.spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    return back.select(
        "event_id", "event_type", "value", F.col("tags")[0].alias("tag"), F.col("_corrupt_record").isNotNull().cast("int").alias("broken")
    )


@query("io_csv_roundtrip", "SELECT c_custkey, c_name, c_acctbal, NULLIF(c_mktsegment, 'BUILDING') AS segment FROM customer")
def io_csv_roundtrip(t: Tables) -> DataFrame:
    path = workspace.scratch(t.spark, "csv")
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"))
    rows.write.csv(path, header=True, nullValue="NA")
    return t.spark.read.csv(path, header=True, schema=rows.schema, nullValue="NA", enforceSchema=False)


@query("io_csv_options", "SELECT doc_id, lang, text FROM documents")
def io_csv_options(t: Tables) -> DataFrame:
    """Quotes, separators and line breaks inside values survive with the right options."""
    path = workspace.scratch(t.spark, "csv-options")
    texts = t.documents.select("doc_id", "lang", "text")
    options = {"sep": ";", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    texts.write.option("header", True).option("quoteAll", True).options(**options).csv(path)
    return t.spark.read.option("header", True).option("multiLine", True).options(**options).schema(texts.schema).csv(path)


@query("io_explicit_schema", "SELECT n_nationkey, n_name, CAST(n_regionkey AS BIGINT) AS n_regionkey, 'both' AS found FROM nation")
def io_explicit_schema(t: Tables) -> DataFrame:
    """One file read with a schema object and with schema text; rows of both are returned."""
    path = workspace.scratch(t.spark, "schema")
    t.nation.write.csv(path)
    as_object = T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType()),
            T.StructField("n_name", T.StringType()),
            T.StructField("n_regionkey", T.LongType()),
        ]
    )
    first = t.spark.read.schema(as_object).csv(path)
    second = t.spark.read.schema("n_nationkey int, n_name string, n_regionkey bigint").csv(path)
    return first.intersect(second).withColumn("found", F.lit("both"))


@query("io_generic_roundtrip", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def io_generic_roundtrip(t: Tables) -> DataFrame:
    """The general form of readers and writers: format, options, save and load."""
    path = workspace.scratch(t.spark, "generic")
    t.supplier.write.format("json").option("compression", "gzip").mode("error").save(path)
    return t.spark.read.format("json").schema(SCHEMAS["supplier"]).load(path)


@query(
    "io_text_roundtrip",
    """SELECT 'lines' AS kind, count(*) AS n, CAST(sum(length(p_name)) AS BIGINT) AS chars FROM part
       UNION ALL SELECT 'files', count(*), CAST(sum(length(p_name) + 1) AS BIGINT) FROM part""",
)
def io_text_roundtrip(t: Tables) -> DataFrame:
    """Text by line, and by file with the file's path at hand (here the files are added up)."""
    path = workspace.scratch(t.spark, "text")
    t.part.select("p_name").write.option("maxRecordsPerFile", 1_000_000).text(path, compression="gzip")
    lines = t.spark.read.text(path, lineSep="\n")
    files = t.spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    ends = F.length("value") - F.length(F.replace("value", F.lit("\n"), F.lit("")))
    by_line = lines.agg(F.lit("lines").alias("kind"), F.count("*").alias("n"), F.sum(F.length("value")).alias("chars"))
    by_file = files.groupBy("file").agg(F.sum(ends).alias("n"), F.sum(F.length("value")).alias("chars"))
    return by_line.union(by_file.agg(F.lit("files").alias("kind"), F.sum("n").alias("n"), F.sum("chars").alias("chars")))


@query(
    "io_save_modes",
    """SELECT 'append' AS mode, 2 * count(*) AS n FROM nation UNION ALL SELECT 'overwrite', count(*) FROM nation
       UNION ALL SELECT 'ignore', count(*) FROM nation UNION ALL SELECT 'error', 1 FROM region WHERE r_regionkey = 0""",
)
def io_save_modes(t: Tables) -> DataFrame:
    """What a second write to the same place does, by mode. The count for ``error`` is of refusals."""
    counts = []
    for mode in ("append", "overwrite", "ignore"):
        path = workspace.scratch(t.spark, mode)
        t.nation.write.parquet(path)
        t.nation.write.mode(mode).parquet(path)
        counts.append(t.spark.read.parquet(path).agg(F.lit(mode).alias("mode"), F.count("*").alias("n")))
    refused = 0
    try:
        t.nation.write.mode("errorifexists").parquet(path)
    except Exception as error:
        refused += "PATH_ALREADY_EXISTS" in str(error)
    counts.append(t.region.filter("r_regionkey = 0").select(F.lit("error").alias("mode"), F.lit(refused).alias("n")))
    return counts[0].union(counts[1]).union(counts[2]).union(counts[3])


@query(
    "io_partitioned_write",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL",
)
def io_partitioned_write(t: Tables) -> DataFrame:
    """Folders per value; a filter on the folder column lists only the matching ones."""
    path = workspace.scratch(t.spark, "partitioned")
    t.lineitem.select("l_returnflag", "l_linestatus", "l_quantity").write.partitionBy("l_returnflag", "l_linestatus").parquet(path)
    kept = t.spark.read.parquet(path).filter("l_returnflag = 'R'")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"))


@query(
    "io_schema_merge",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice,
         CASE WHEN o_orderstatus = 'O' THEN o_custkey END AS o_custkey, o_orderstatus AS status FROM orders""",
)
def io_schema_merge(t: Tables) -> DataFrame:
    """Files with different columns under one folder, read as one table with all columns."""
    path = workspace.scratch(t.spark, "merged")
    t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice").write.parquet(f"{path}/status=F")
    t.orders.filter("o_orderstatus = 'O'").select("o_orderkey", "o_custkey").write.parquet(f"{path}/status=O")
    t.orders.filter("o_orderstatus = 'P'").select("o_orderkey").write.parquet(f"{path}/status=P")
    return t.spark.read.option("mergeSchema", True).parquet(path)


@query("io_path_query", "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_totalprice BETWEEN 100000 AND 200000 GROUP BY 1")
def io_path_query(t: Tables) -> DataFrame:
    """SQL over a file named by its path."""
    return t.spark.sql(
        f"SELECT o_orderpriority, count(*) AS n FROM parquet.`{t.file('orders')}` WHERE o_totalprice BETWEEN 100000 AND 200000 GROUP BY 1"
    )


@query("io_binary_files", "SELECT 'region' AS source, 1 AS files, 'PAR1' AS magic, NULL::BIGINT AS key_sum UNION ALL "
       "SELECT 'records', count(*), NULL, CAST(sum(o_orderkey) AS BIGINT) FROM orders")  # fmt: skip
def io_binary_files(t: Tables) -> DataFrame:
    """Whole files as bytes, and flat files of 16-byte records cut into rows."""
    files = (
        t.spark.read.format("binaryFile")
        .load(t.file("region"))
        .select(
            F.lit("region").alias("source"),
            F.lit(1).cast("bigint").alias("files"),
            F.substring("content", 1, 4).cast("string").alias("magic"),
            F.lit(None).cast("bigint").alias("key_sum"),
        )
    )
    size = 21  # every bigint fits before the line feed
    path = workspace.scratch(t.spark, "records")
    keys = t.orders.select(F.lpad(F.col("o_orderkey").cast("string"), size - 1, "0").alias("record"))
    keys.write.option("maxRecordsPerFile", 1_000_000).text(path)  # a file is one value when read as bytes
    flat = t.spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(path).filter("length > 0")
    at = F.explode(F.sequence(F.lit(0), (F.col("length") / size).cast("int") - 1))
    records = flat.select("content", at.alias("i")).select(
        F.col("content").substr(F.col("i") * size + 1, F.lit(size - 1)).cast("string").cast("bigint").alias("key")
    )
    return files.union(
        records.agg(F.lit("records"), F.count("*"), F.lit(None).cast("string"), F.sum("key"))
    )


@query("io_libsvm", "SELECT CAST(label AS DOUBLE) AS label, count(*) AS n, round(sum(list_sum(CAST(embedding AS DOUBLE[]))), 4) AS total FROM embeddings GROUP BY 1")
def io_libsvm(t: Tables) -> DataFrame:
    """Labelled sparse vectors as text."""
    path = workspace.scratch(t.spark, "libsvm")
    vectors = t.embeddings.select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    vectors.write.format("libsvm").save(path)
    back = t.spark.read.format("libsvm").option("numFeatures", 64).load(path)
    total = F.aggregate(vector_to_array("features"), F.lit(0.0), lambda s, x: s + x)
    return back.groupBy("label").agg(F.count("*").alias("n"), F.round(F.sum(total), 4).alias("total"))
