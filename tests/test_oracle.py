"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check import TABLES, compare  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_rows(spark, db, name):
    got = QUERIES[name](spark, FOLDER).toPandas()
    assert compare(got, db.execute(ORACLES[name]).df()) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and rows[0]["total_sales"] >= rows[-1]["total_sales"]
