"""Every registered query against its SQL on the smallest data."""

import duckdb
import pytest

from __spark_entry__ import SMALL, entry
from catalogue.fixtures import BASE
from catalogue.registry import ORACLES, QUERIES
from check_oracle import compare


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in BASE:
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["persona", "n", "percent"] and result.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    state, note = compare(spark, con, SMALL, name)
    assert state == "ok", note
