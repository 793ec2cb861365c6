"""Files with awkward contents, samples, and the shared folder."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from farebox import workspace
from farebox.operators import projection
from tests.conftest import SF

QUERIES = entry.queries()


def test_json_lines_arrays_and_broken_rows(spark, tmp_path):
    (tmp_path / "people.json").write_text('{"name": "Ann", "age": null}\n{"name": "Bob", "age": 30}\nnot json\n')
    schema = "name string, age bigint, _corrupt_record string"
    read = spark.read.schema(schema).json(str(tmp_path / "people.json")).cache()
    assert read.filter("_corrupt_record IS NOT NULL").count() == 1
    dropped = spark.read.schema("name string, age bigint").option("mode", "DROPMALFORMED").json(str(tmp_path / "people.json"))
    assert [r.name for r in dropped.orderBy("name").collect()] == ["Ann", "Bob"]
    with pytest.raises(Exception):
        spark.read.schema("name string, age bigint").option("mode", "FAILFAST").json(str(tmp_path / "people.json")).collect()
    (tmp_path / "array.json").write_text('[{"name": "Ann"},\n {"name": "Bob"}]')
    assert spark.read.json(str(tmp_path / "array.json"), multiLine=True).count() == 2


def test_csv_with_line_breaks_in_quotes(spark, tmp_path):
    (tmp_path / "ages.csv").write_text('Joe,20,"Hi,\nI am Jeo"\nTom,30,"My name is Tom"\n')
    rows = spark.read.csv(str(tmp_path / "ages.csv"), multiLine=True).collect()
    assert [r[2] for r in rows] == ["Hi,\nI am Jeo", "My name is Tom"]


def test_split_parts_hold_every_row_once(spark):
    row = QUERIES["sample_split"](spark, SF).first()
    assert row.orders == spark.read.parquet(f"{SF}/orders.parquet").count() and row.times == 1 and row.in_order


def test_fixed_size_sample_is_of_that_size(spark):
    rows = QUERIES["sample_fixed_size"](spark, SF).collect()
    assert len({r.o_orderkey for r in rows}) == 100


def test_stratified_sample_keeps_all_of_a_full_stratum(spark, tables):
    drawn = projection.stratified(tables, {"click": 0.1, "view": 0.2, "purchase": 1.0})
    rows = {r.event_type: r["count"] for r in drawn.groupBy("event_type").count().collect()}
    assert rows["purchase"] == tables.events.filter("event_type = 'purchase'").count()
    assert "error" not in rows


def test_random_ids_are_unique_hex(spark):
    ids = QUERIES["taxi_uuid_udf"](spark, SF)
    for column in ("trip_uuid", "own_uuid"):
        assert ids.filter(~F.col(column).rlike("^[0-9a-f]{32}$")).isEmpty()


def test_unique_ids(spark, tables):
    row = QUERIES["id_unique"](spark, SF).first()
    assert row.n == row.ids == tables.lineitem.count() and row.part_in_id


def test_scratch_is_below_the_named_folder(spark):
    assert workspace.scratch(spark, "x").startswith(workspace.qualified(spark, spark.conf.get("spark.checkpoint.dir")))


def test_random_columns_follow_their_distributions(spark):
    row = (
        QUERIES["src_random_tables"](spark, SF)
        .agg(F.avg("uniform"), F.stddev("normal"), F.avg("exponential"), F.avg("poisson"), F.avg("gamma"))
        .first()
    )
    assert tuple(row) == pytest.approx((0.5, 1.0, 2.0, 4.0, 6.0), rel=0.1)
