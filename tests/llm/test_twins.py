"""The text queries with a SQL twin give the twin's rows; all of them give a row per document or page."""

import duckdb
import pytest

from farebox.llm.queries import ORACLES, QUERIES
from farebox.tables import SCHEMAS
from tests.llm.conftest import SMALL
from tests.test_catalogue import canon


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in SCHEMAS:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_twin(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert canon(df.collect(), df.columns) == canon(cur.fetchall(), names)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
