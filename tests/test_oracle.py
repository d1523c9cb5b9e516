"""Every registered query against its SQL in DuckDB."""

import datetime

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import SF, SF_SMALL, own_queries


def _plain(value):
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


def _rows(rows, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_sql():
    assert own_queries().keys() <= contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF])
@pytest.mark.parametrize("key", own_queries())
def test_same_rows(spark, key, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{sf_dir}/events.parquet'")
    expected = con.execute(contract.oracle_sql()[key])
    names = [column[0] for column in expected.description]
    got = contract.queries()[key](spark, sf_dir)
    assert sorted(got.columns) == sorted(names)
    assert _rows(got.collect(), got.columns) == _rows(expected.fetchall(), names)


def test_entry(spark):
    assert contract.entry(spark).count() == 1
