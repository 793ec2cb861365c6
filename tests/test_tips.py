"""The label rule on hand-written rows, and the report built on it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from farebox.plans import tips

# Fare, tip and label of the edge cases.
EDGES = [
    (10.0, 0.0, "0 - 10"),
    (10.0, 0.999, "0 - 10"),
    (10.0, 1.0, "10 - 20"),
    (10.0, 4.99, "40 - 50"),
    (10.0, 5.0, "50+"),
    (10.0, -0.05, "0 - 10"),
    (10.0, -0.1, "Error"),
    (-10.0, 1.0, "Error"),
    (-10.0, -1.0, "10 - 20"),
    (0.0, 1.0, "Error"),
    (None, 1.0, "Error"),
    (10.0, None, "Error"),
    (10.0, float("nan"), "0 - 10"),
    (1e-9, 1.0, "50+"),
    (1e-300, 1e300, "50+"),
    (10.0, -0.0, "0 - 10"),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_labels(spark, ansi):
    rows = [(i, fare, tip) for i, (fare, tip, _) in enumerate(EDGES)]
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(rows, "i int, fare_amount double, tip_amount double")
        found = df.select("i", tips.bucket_label(tips.tip_ratio(), 10).alias("label")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert {r.i: r.label for r in found} == {i: label for i, (_, _, label) in enumerate(EDGES)}


@pytest.mark.parametrize("interval, label", [(5, "15 - 20"), (25, "0 - 25"), (20, "0 - 20")])
def test_other_intervals(spark, interval, label):
    df = spark.createDataFrame([(100.0, 17.9)], "fare_amount double, tip_amount double")
    assert df.select(tips.bucket_label(tips.tip_ratio(), interval)).first()[0] == label


def trips(spark, rows, fleet):
    schema = (
        f"passenger_count int, trip_distance double, fare_amount double, tip_amount double, {fleet.pickup} timestamp, {fleet.dropoff} timestamp, VendorID int"
    )
    return spark.createDataFrame([(1, 1.0, fare, tip, at, at, 7) for fare, tip, at in rows], schema)


def test_report_of_two_fleets(spark):
    new, old = dt.datetime(2021, 1, 1), dt.datetime(2020, 12, 31, 23, 59, 59)
    yellow = trips(spark, [(10.0, 0.0, new), (10.0, 2.0, new), (10.0, 2.5, new), (0.0, 1.0, new), (10.0, 9.0, old)], tips.YELLOW)
    green = trips(spark, [(10.0, 0.0, new), (10.0, 6.0, dt.datetime(2030, 1, 1)), (10.0, 1.0, None)], tips.GREEN)
    both = tips.since_year(tips.union_fleets([tips.core_columns(yellow, tips.YELLOW), tips.core_columns(green, tips.GREEN)]), 2021)
    assert both.count() == 6  # no upper bound; the old and the unknown pickup are gone
    report = tips.share_report(both, 10, 2021, "Yellow and Green")
    assert report.columns == ["TipProcent", "Percentage of all Yellow and Green Taxi Rides in 2021 year in NYC"]
    rows = [tuple(r) for r in report.collect()]
    assert [r[0] for r in rows] == ["0 - 10", "20 - 30", "50+", "Error"]  # sorted by text
    assert [r[1] for r in rows] == pytest.approx([200 / 6, 200 / 6, 100 / 6, 100 / 6])
    shares = tips.all_reports(both, 10).groupBy("report").agg(F.sum("share").alias("s"), F.sum("trips").alias("n")).collect()
    assert {r.report: r.n for r in shares} == {"Yellow": 4, "Green": 2, "Yellow and Green": 6}
    assert all(r.s == pytest.approx(100) for r in shares)


def test_saved_report_refuses_to_overwrite(spark, tmp_path):
    report = spark.createDataFrame([("0 - 10", 60.0), ("Error", 40.0)], "TipProcent string, share double")
    path = str(tmp_path / "report")
    tips.save_report(report, path)
    assert len(list((tmp_path / "report").glob("*.csv"))) == 1
    assert spark.read.csv(path, header=True).columns == ["TipProcent", "share"]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tips.save_report(report, path)


def test_cleaning_drops_the_unused_columns(spark):
    green = trips(spark, [(1.0, 1.0, dt.datetime(2021, 1, 1))], tips.GREEN)
    assert tips.drop_unused(green, tips.GREEN).columns == [
        "trip_distance", "fare_amount", "tip_amount", "lpep_pickup_datetime", "lpep_dropoff_datetime"
    ]
