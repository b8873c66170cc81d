"""Every registered query against its SQL on the smallest data set."""

import duckdb
import pytest

import __spark_entry__ as entry_point
from check_oracles import TABLES, compare
from demesne.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result, _ = compare(spark, con, name, FOLDER)
    assert result.startswith("ok") and "TYPES" not in result, result


def test_entry_and_registry(spark):
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())
    assert entry_point.entry(spark).count() > 0
