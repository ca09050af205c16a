"""Registered queries against DuckDB on the smallest tables."""

import hashlib
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_point
from tillroll.catalog import QUERIES, _digests
from tillroll.sources import ingest, tables

FOLDER = Path("/root/testdata/sf0.001")
TABLES = ("lineitem", "orders", "part", "supplier", "nation")
CHOSEN = (
    "clean_line",
    "customer_dim",
    "segment_summary",
    "purchase_intervals",
    "churn_validation",
    "cohort_retention",
    "clv_predicted",
    "clv_validation",
    "monthly_revenue",
    "order_medians",
)

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")


def test_every_query_of_the_analysis_has_an_oracle():
    assert set(QUERIES) <= set(entry_point.oracle_sql())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows_as_duckdb(spark, duck, name):
    found = entry_point.queries()[name](spark, str(FOLDER))
    columns = sorted(found.columns)
    wanted = duck.sql(entry_point.oracle_sql()[name])
    assert sorted(wanted.columns) == columns
    rows = [tuple(row[c] for c in columns) for row in found.collect()]
    expected = wanted.select(", ".join(f'"{c}"' for c in columns)).fetchall()
    assert sorted(map(repr, rows)) == sorted(map(repr, expected))


def test_entry_returns_ten_segments(spark):
    assert entry_point.entry(spark).count() == 10


def test_load_log_registers_the_digest_of_the_whole_file(spark):
    path = FOLDER / "lineitem.parquet"
    entry = ingest.load_entry(tables.raw_lines(spark, str(FOLDER)), _digests(spark, str(FOLDER)), "this load")
    (row,) = entry.collect()
    assert row.sha256 == hashlib.sha256(path.read_bytes()).hexdigest()
    (logged,) = QUERIES["load_log"](spark, str(FOLDER)).collect()
    assert (logged.name, logged.rows, logged.has_digest) == (row["name"], row.rows, True)
