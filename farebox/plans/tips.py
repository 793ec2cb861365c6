"""Tip analysis of taxi trips: how much of the fare riders add, as shares of all trips."""

import os
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox import scale, workspace
from farebox.registry import query
from farebox.tables import Tables

MEASURES = ("passenger_count", "trip_distance", "fare_amount", "tip_amount")
TOP = 50  # ratios from here on share one bucket
ERROR = "Error"


@dataclass(frozen=True)
class Fleet:
    """One trip source and the names of its two time columns."""

    name: str
    pickup: str
    dropoff: str


# Column names of the published trip files.
YELLOW = Fleet("Yellow", "tpep_pickup_datetime", "tpep_dropoff_datetime")
GREEN = Fleet("Green", "lpep_pickup_datetime", "lpep_dropoff_datetime")
FLEETS = (YELLOW, GREEN)
# Columns that the cleaned files leave out.
UNUSED = {
    "Yellow": [
        "VendorID", "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
        "extra", "mta_tax", "tolls_amount", "improvement_surcharge", "total_amount", "payment_type",
        "congestion_surcharge", "airport_fee",
    ],
    "Green": [
        "VendorID", "store_and_fwd_flag", "RatecodeID", "PULocationID", "DOLocationID", "passenger_count",
        "extra", "mta_tax", "tolls_amount", "ehail_fee", "improvement_surcharge", "total_amount", "payment_type",
        "trip_type", "congestion_surcharge",
    ],
}


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def core_columns(trips: DataFrame, fleet: Fleet, *keep: str) -> DataFrame:
    """The columns both fleets share, under common names, and any row keys to ``keep``."""
    return trips.select(
        *MEASURES,
        F.lit(fleet.name).alias("taxi_type"),
        F.col(fleet.pickup).alias("pickup_datetime"),
        F.col(fleet.dropoff).alias("dropoff_datetime"),
        *keep,
    )


def union_fleets(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for other in rest:
        first = first.unionByName(other)
    return first


def since_year(trips: DataFrame, year: int) -> DataFrame:
    """Pickups from 1 January of ``year`` on; there is no upper bound and null pickups go."""
    return trips.filter(F.col("pickup_datetime") >= F.lit(f"{year}-01-01 00:00:00").cast("timestamp"))


def drop_unused(trips: DataFrame, fleet: Fleet) -> DataFrame:
    return trips.drop(*UNUSED[fleet.name])


def tip_ratio() -> Column:
    """Tip in percent of the fare, null for a zero fare."""
    return F.try_divide("tip_amount", "fare_amount") * 100


def bucket_start(ratio: Column, interval: int) -> Column:
    """Lower end of the bucket a ratio falls in, as a number; -1 stands for an error.

    The ratio counts by its integer part, so (-1, 0) is part of the first bucket. NaN
    is tested before the top bucket because it compares above every number.
    """
    low = (F.floor(ratio) / interval).cast("int") * interval
    return (
        F.when(ratio.isNull(), -1)
        .when((ratio >= 0) & (ratio < TOP), low)
        .when(F.isnan(ratio), 0)
        .when(ratio >= TOP, TOP)
        .when(ratio > -1, 0)
        .otherwise(-1)
    )


def bucket_name(start: Column, interval: int) -> Column:
    """Text of a bucket in reports."""
    text = start.cast("string")
    return (
        F.when(start < 0, ERROR)
        .when(start >= TOP, f"{TOP}+")
        .otherwise(F.concat(text, F.lit(" - "), (start + interval).cast("string")))
    )


def bucket_label(ratio: Column, interval: int) -> Column:
    return bucket_name(bucket_start(ratio, interval), interval)


def share_column(fleet_label: str, year: int) -> str:
    return f"Percentage of all {fleet_label} Taxi Rides in {year} year in NYC"


def tip_counts(trips: DataFrame, interval: int, *keys: str) -> DataFrame:
    """Trips per bucket. Rows are grouped by a number; only the few results get their text."""
    rated = trips.select(*keys, tip_ratio().alias("ratio"))
    counts = rated.groupBy(*keys, bucket_start(F.col("ratio"), interval).alias("start")).agg(F.count("*").alias("trips"))
    return counts.select(*keys, bucket_name(F.col("start"), interval).alias("TipProcent"), "trips")


def share_report(trips: DataFrame, interval: int, year: int, fleet_label: str) -> DataFrame:
    """Share of trips per tip bucket. The total is a window over the bucket counts, at most 7 rows for 10."""
    share = F.col("trips") * 100 / F.sum("trips").over(Window.partitionBy(F.lit(1)))
    return (
        tip_counts(trips, interval)
        .select("TipProcent", share.alias(share_column(fleet_label, year)))
        .orderBy("TipProcent")
    )


def all_reports(trips: DataFrame, interval: int) -> DataFrame:
    """The reports of every fleet and of all together, from one scan of the trips."""
    trips_in_bucket = F.sum("trips").alias("trips")
    counts = tip_counts(trips, interval, "taxi_type")
    both = counts.groupBy("TipProcent").agg(trips_in_bucket).withColumn("report", F.lit("Yellow and Green"))
    reports = counts.withColumnRenamed("taxi_type", "report").unionByName(both)
    share = F.col("trips") * 100 / F.sum("trips").over(Window.partitionBy("report"))
    return reports.select("report", "TipProcent", "trips", share.alias("share"))


def save_report(report: DataFrame, path: str) -> None:
    """One CSV file with a header; the report has a handful of rows, and an existing path is an error."""
    report.coalesce(1).write.mode("errorifexists").csv(path, header=True)


# --- the same job on the test tables: line items stand for trips -------------------

YEAR = 1998
INTERVAL = 10


def lineitem_trips(t: Tables) -> DataFrame:
    """Raw trips with the columns of both fleets, told apart by ``l_linestatus``."""
    fare = F.when((F.col("l_tax") == 0) & (F.col("l_linenumber") == 7), 0.0).otherwise(
        F.col("l_extendedprice") / 100
    )
    return t.lineitem.select(
        "l_linestatus",
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_id"),
        F.col("l_partkey").alias("part_id"),
        F.col("l_suppkey").alias("VendorID"),
        F.col("l_shipdate").alias("pickup"),
        F.date_add("l_shipdate", 1).cast("timestamp").alias("dropoff"),
        F.col("l_linenumber").alias("passenger_count"),
        F.col("l_quantity").alias("trip_distance"),
        fare.alias("fare_amount"),
        F.col("l_quantity").alias("tip_amount"),
        F.col("l_tax").alias("extra"),
    )


def fleet_trips(t: Tables, fleet: Fleet) -> DataFrame:
    status = "O" if fleet is YELLOW else "F"
    return (
        lineitem_trips(t)
        .filter(F.col("l_linestatus") == status)
        .drop("l_linestatus")
        .withColumnsRenamed({"pickup": fleet.pickup, "dropoff": fleet.dropoff})
    )


def core_trips(t: Tables, *keep: str) -> DataFrame:
    """Both fleets under common names, from one scan."""
    is_yellow = F.col("l_linestatus") == "O"
    return (
        lineitem_trips(t)
        .filter(F.col("l_linestatus").isin("O", "F"))
        .select(
            *MEASURES,
            F.when(is_yellow, YELLOW.name).otherwise(GREEN.name).alias("taxi_type"),
            F.col("pickup").alias("pickup_datetime"),
            F.col("dropoff").alias("dropoff_datetime"),
            *keep,
        )
    )


# SQL shared by the twins below.
TRIPS = """trips AS (
  SELECT CASE l_linestatus WHEN 'O' THEN 'Yellow' ELSE 'Green' END AS taxi_type,
         l_orderkey AS order_id, l_linenumber AS line_id, l_partkey AS part_id,
         l_shipdate AS pickup_datetime, l_linenumber AS passenger_count, l_quantity AS trip_distance,
         CASE WHEN l_tax = 0 AND l_linenumber = 7 THEN 0 ELSE l_extendedprice / 100 END AS fare_amount,
         l_quantity AS tip_amount
  FROM lineitem WHERE l_linestatus IN ('O', 'F'))"""
LABELLED = f"""{TRIPS}, rated AS (
  SELECT *, tip_amount / NULLIF(fare_amount, 0) * 100 AS r FROM trips
  WHERE pickup_datetime >= TIMESTAMP '1998-01-01'), labelled AS (
  SELECT *, CASE WHEN r IS NULL OR r <= -1 THEN 'Error' WHEN r >= 50 THEN '50+'
    ELSE CAST(CAST(floor(greatest(r, 0) / 10) * 10 AS BIGINT) AS VARCHAR) || ' - ' ||
         CAST(CAST(floor(greatest(r, 0) / 10) * 10 + 10 AS BIGINT) AS VARCHAR) END AS TipProcent
  FROM rated)"""
REPORTS = f"""{LABELLED}, counts AS (
  SELECT coalesce(taxi_type, 'Yellow and Green') AS report, TipProcent, count(*) AS trips
  FROM labelled GROUP BY GROUPING SETS ((taxi_type, TipProcent), (TipProcent))), reports AS (
  SELECT report, TipProcent, trips, trips * 100.0 / sum(trips) OVER (PARTITION BY report) AS share FROM counts)"""


@query(
    "taxi_read",
    """SELECT l_linestatus, count(*) AS trips, round(sum(l_quantity), 2) AS tips,
         CAST(max(l_shipdate) AS VARCHAR) AS last_pickup FROM lineitem GROUP BY 1""",
)
def taxi_read(t: Tables) -> DataFrame:
    """Scan trips; only the columns asked for are read."""
    trips = read_trips(t.spark, t.file("lineitem"))
    return trips.groupBy("l_linestatus").agg(
        F.count("*").alias("trips"),
        F.round(F.sum("l_quantity"), 2).alias("tips"),
        F.date_format(F.max("l_shipdate"), "yyyy-MM-dd HH:mm:ss").alias("last_pickup"),
    )


@query(
    "taxi_core_columns",
    f"""WITH {TRIPS} SELECT taxi_type, order_id, line_id, part_id, passenger_count, trip_distance,
      round(fare_amount, 6) AS fare_amount, tip_amount, pickup_datetime,
      pickup_datetime + INTERVAL 1 DAY AS dropoff_datetime FROM trips WHERE taxi_type = 'Yellow'""",
)
def taxi_core_columns(t: Tables) -> DataFrame:
    core = core_columns(fleet_trips(t, YELLOW), YELLOW, "order_id", "line_id", "part_id")
    return core.withColumn("fare_amount", F.round("fare_amount", 6))


@query(
    "taxi_union",
    f"""WITH {TRIPS} SELECT taxi_type, passenger_count, count(*) AS trips, round(sum(tip_amount), 2) AS tips
      FROM trips GROUP BY ALL""",
)
def taxi_union(t: Tables) -> DataFrame:
    both = union_fleets(core_columns(fleet_trips(t, f), f) for f in FLEETS)
    return both.groupBy("taxi_type", "passenger_count").agg(
        F.count("*").alias("trips"), F.round(F.sum("tip_amount"), 2).alias("tips")
    )


@query(
    "taxi_since_year",
    f"""WITH {TRIPS} SELECT taxi_type, CAST(year(pickup_datetime) AS BIGINT) AS pickup_year, count(*) AS trips
      FROM trips WHERE pickup_datetime >= TIMESTAMP '1998-01-01' GROUP BY ALL""",
)
def taxi_since_year(t: Tables) -> DataFrame:
    return (
        since_year(core_trips(t), YEAR)
        .groupBy("taxi_type", F.year("pickup_datetime").cast("bigint").alias("pickup_year"))
        .agg(F.count("*").alias("trips"))
    )


@query(
    "taxi_add_id",
    f"""WITH {TRIPS} SELECT row_number() OVER (
        ORDER BY pickup_datetime, order_id, line_id, part_id, tip_amount, fare_amount) AS id,
      pickup_datetime, order_id, line_id, part_id
      FROM trips WHERE pickup_datetime >= TIMESTAMP '1998-01-01'""",
)
def taxi_add_id(t: Tables) -> DataFrame:
    """1-based id in pickup order; ties are broken by the row's key."""
    trips = since_year(core_trips(t, "order_id", "line_id", "part_id"), YEAR)
    order = ["pickup_datetime", "order_id", "line_id", "part_id", "tip_amount", "fare_amount"]
    ids = scale.dense_ids(trips.select(order), order, start=1)
    return ids.select("id", "pickup_datetime", "order_id", "line_id", "part_id")


@query(
    "taxi_tip_ratio",
    f"""WITH {TRIPS} SELECT order_id, line_id, part_id,
      round(tip_amount / NULLIF(fare_amount, 0) * 100, 6) AS tip_ratio FROM trips""",
)
def taxi_tip_ratio(t: Tables) -> DataFrame:
    return core_trips(t, "order_id", "line_id", "part_id").select(
        "order_id", "line_id", "part_id", F.round(tip_ratio(), 6).alias("tip_ratio")
    )


@query(
    "taxi_bucket_label",
    f"""WITH {LABELLED} SELECT taxi_type, TipProcent, count(*) AS trips, round(min(r), 6) AS lowest,
      round(max(r), 6) AS highest FROM labelled GROUP BY ALL""",
)
def taxi_bucket_label(t: Tables) -> DataFrame:
    rated = since_year(core_trips(t), YEAR).withColumn("r", tip_ratio())
    return rated.groupBy("taxi_type", bucket_label(F.col("r"), INTERVAL).alias("TipProcent")).agg(
        F.count("*").alias("trips"), F.round(F.min("r"), 6).alias("lowest"), F.round(F.max("r"), 6).alias("highest")
    )


@query(
    "taxi_tip_share",
    f"""WITH {REPORTS} SELECT TipProcent, round(share, 8) AS share FROM reports
      WHERE report = 'Yellow and Green' ORDER BY 1""",
)
def taxi_tip_share(t: Tables) -> DataFrame:
    """The flagship report: share of all trips per tip bucket."""
    label = "Yellow and Green"
    report = share_report(since_year(core_trips(t), YEAR), INTERVAL, YEAR, label)
    return report.select("TipProcent", F.round(F.col(f"`{share_column(label, YEAR)}`"), 8).alias("share"))


@query(
    "taxi_all_reports",
    f"WITH {REPORTS} SELECT report, TipProcent, trips, round(share, 8) AS share FROM reports",
)
def taxi_all_reports(t: Tables) -> DataFrame:
    reports = all_reports(since_year(core_trips(t), YEAR), INTERVAL)
    return reports.withColumn("share", F.round("share", 8))


@query(
    "taxi_report_csv",
    f"""WITH {REPORTS} SELECT TipProcent, round(share, 8) AS share FROM reports WHERE report = 'Green'""",
)
def taxi_report_csv(t: Tables) -> DataFrame:
    """Save one fleet's report as CSV and read the file back."""
    trips = since_year(core_columns(fleet_trips(t, GREEN), GREEN), YEAR)
    path = workspace.scratch(t.spark, "tip-report")
    save_report(share_report(trips, INTERVAL, YEAR, GREEN.name), path)
    saved = t.spark.read.csv(path, header=True, schema="TipProcent string, share double", enforceSchema=True)
    return saved.withColumn("share", F.round("share", 8))


@query("taxi_sample")
def taxi_sample(t: Tables) -> DataFrame:
    """Seeded Bernoulli sample; the fraction is a probability between 0 and 1."""
    return core_trips(t, "order_id", "line_id").sample(fraction=0.1, seed=123)


@query("taxi_uuid_udf")
def taxi_uuid_udf(t: Tables) -> DataFrame:
    """A random 32-digit hex id per trip, and one from a function of our own over a whole batch of trips.

    The latter is marked nondeterministic, so that it is not run a second time for a value.
    """
    own = F.pandas_udf(random_hex, "string").asNondeterministic()
    return core_trips(t, "order_id", "line_id").select(
        "order_id", "line_id", F.replace(F.uuid(), F.lit("-"), F.lit("")).alias("trip_uuid"), own("order_id").alias("own_uuid")
    )


def random_hex(keys: pd.Series) -> pd.Series:
    """The digits of all ids of a batch at once, cut into pieces of 32."""
    digits = os.urandom(16 * len(keys)).hex()
    return pd.Series(np.frombuffer(digits.encode(), "S32").astype(str))


@query(
    "taxi_profile",
    """SELECT name AS column_name, kind AS column_type, filled AS non_null, total - filled AS nulls FROM (
        SELECT count(*) AS total, count(l_shipdate) AS c1, count(l_linenumber) AS c2, count(l_quantity) AS c3,
               count(NULLIF(l_tax, 0)) AS c4 FROM lineitem),
      LATERAL (VALUES ('pickup', 'timestamp', c1), ('passenger_count', 'int', c2),
        ('trip_distance', 'double', c3), ('extra', 'double', c4)) v(name, kind, filled)""",
)
def taxi_profile(t: Tables) -> DataFrame:
    """Type and null count per column, in one pass over the trips."""
    trips = lineitem_trips(t).select(
        "pickup", "passenger_count", "trip_distance", F.nullif("extra", F.lit(0.0)).alias("extra")
    )
    return profile(trips)


def profile(df: DataFrame) -> DataFrame:
    total = F.count("*").alias("_total")
    counts = df.agg(total, *(F.count(name).alias(name) for name in df.columns))
    rows = F.array(
        *(
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("column_type"),
                F.col(name).alias("non_null"),
                (F.col("_total") - F.col(name)).alias("nulls"),
            )
            for name, kind in df.dtypes
        )
    )
    return counts.select(F.inline(rows))


@query(
    "taxi_rows_removed",
    f"""WITH {TRIPS} SELECT taxi_type, count(*) AS rows_before,
      count(*) FILTER (pickup_datetime >= TIMESTAMP '1998-01-01') AS rows_kept,
      count(*) FILTER (pickup_datetime < TIMESTAMP '1998-01-01') AS rows_removed FROM trips GROUP BY 1""",
)
def taxi_rows_removed(t: Tables) -> DataFrame:
    kept = F.count_if(F.col("pickup_datetime") >= F.lit(f"{YEAR}-01-01").cast("timestamp"))
    return (
        core_trips(t)
        .groupBy("taxi_type")
        .agg(F.count("*").alias("rows_before"), kept.alias("rows_kept"))
        .withColumn("rows_removed", F.col("rows_before") - F.col("rows_kept"))
    )


@query(
    "taxi_clean_columns",
    f"""WITH {TRIPS} SELECT order_id, line_id, part_id, pickup_datetime AS lpep_pickup_datetime,
      pickup_datetime + INTERVAL 1 DAY AS lpep_dropoff_datetime, trip_distance,
      round(fare_amount, 6) AS fare_amount, tip_amount FROM trips WHERE taxi_type = 'Green'""",
)
def taxi_clean_columns(t: Tables) -> DataFrame:
    return drop_unused(fleet_trips(t, GREEN), GREEN).withColumn("fare_amount", F.round("fare_amount", 6))


@query(
    "taxi_clean_write",
    f"""WITH {TRIPS} SELECT taxi_type, CAST(year(pickup_datetime) AS BIGINT) AS pickup_year, count(*) AS trips,
      round(sum(tip_amount), 2) AS tips FROM trips
      WHERE pickup_datetime >= TIMESTAMP '1999-01-01' GROUP BY ALL""",
)
def taxi_clean_write(t: Tables) -> DataFrame:
    """Save cleaned trips by pickup year; reading later years skips the earlier folders."""
    path = workspace.scratch(t.spark, "clean-trips")
    clean = since_year(core_trips(t), YEAR).withColumn("pickup_year", F.year("pickup_datetime"))
    clean.write.partitionBy("pickup_year").parquet(path)
    saved = t.spark.read.parquet(path).filter(F.col("pickup_year") > YEAR)
    return saved.groupBy("taxi_type", F.col("pickup_year").cast("bigint").alias("pickup_year")).agg(
        F.count("*").alias("trips"), F.round(F.sum("tip_amount"), 2).alias("tips")
    )


@query(
    "taxi_share_check",
    f"""WITH {REPORTS} SELECT report, round(sum(share), 6) AS total, abs(sum(share) - 100) < 1e-6 AS complete
      FROM reports GROUP BY 1""",
)
def taxi_share_check(t: Tables) -> DataFrame:
    total = F.sum("share")
    return (
        all_reports(since_year(core_trips(t), YEAR), INTERVAL)
        .groupBy("report")
        .agg(F.round(total, 6).alias("total"), (F.abs(total - 100) < 1e-6).alias("complete"))
    )


@query(
    "taxi_bar_series",
    f"""WITH {REPORTS} SELECT TipProcent, round(max(share) FILTER (report = 'Yellow'), 8) AS Yellow,
      round(max(share) FILTER (report = 'Green'), 8) AS Green FROM reports GROUP BY 1""",
)
def taxi_bar_series(t: Tables) -> DataFrame:
    """Yellow and green shares side by side, one row per bucket."""
    reports = all_reports(since_year(core_trips(t), YEAR), INTERVAL)
    return (
        reports.groupBy("TipProcent")
        .pivot("report", [YELLOW.name, GREEN.name])
        .agg(F.round(F.max("share"), 8))
    )
