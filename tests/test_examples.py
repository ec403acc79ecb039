"""Every example query against its SQL on the smallest test tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from gallery.catalog import EXAMPLES
from tools.check import VIEWS, rows_of

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for view in VIEWS:
        connection.execute(f"CREATE VIEW {view} AS SELECT * FROM '{FOLDER}/{view}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(EXAMPLES))
def test_example(spark, con, name):
    frame = EXAMPLES[name].run(spark, FOLDER)
    found = con.execute(EXAMPLES[name].sql)
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(frame.columns)
    assert rows_of(frame.columns, frame.collect()) == rows_of(columns, found.fetchall())


def test_entry_points_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(EXAMPLES) <= set(entry.oracle_sql())
    assert "monthly_revenue" in entry.queries()


def test_flagship_query(spark):
    assert entry.entry(spark).columns == ["year_month_key", "total_revenue", "total_orders", "avg_order_value"]
