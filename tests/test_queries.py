"""Every registered query with SQL gives the rows of that SQL; the others give rows."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry_module
from curiomill.catalog import load
from curiomill.catalog.derive import GIVEN
from tools.check import rows_of

QUERIES = {name: q for name, q in load().items()}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in GIVEN:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf, name):
    made = QUERIES[name].run(spark, sf)
    got = made.collect()
    if QUERIES[name].oracle is None:
        return
    cursor = duck.execute(QUERIES[name].oracle)
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(made.columns)
    assert rows_of(got, made.columns) == rows_of(cursor.fetchall(), columns)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
