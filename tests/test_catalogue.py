"""Every query with a SQL twin gives the same rows as the twin; the others give rows."""

import duckdb
import pytest

import __spark_entry__ as entry
from farebox.registry import ORACLES as TWINS
from farebox.registry import QUERIES
from farebox.tables import SCHEMAS
from tests.conftest import SF


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def canon(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_as_twin(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(TWINS[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    rows = canon(df.collect(), df.columns)
    assert rows
    assert rows == canon(cur.fetchall(), names)


@pytest.mark.parametrize("name", sorted(n for n in set(QUERIES) - set(TWINS) if not n.startswith(("ml_", "stream_"))))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    report = entry.entry(spark)
    assert report.columns == ["TipProcent", "share"]
    assert report.count() > 0


def test_entry_holds_the_catalogue():
    assert set(QUERIES) <= set(entry.queries())
    assert set(TWINS) <= set(entry.oracle_sql()) <= set(entry.queries())
