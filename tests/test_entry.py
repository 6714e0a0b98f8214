"""Every registered query against its SQL, and the driver contract."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as driver
from check_oracle import TABLES, TYPES, rows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_an_oracle():
    assert set(driver.core_queries()) == set(driver.ORACLE)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["order_date_parsed", "order_count", "total_quantity", "total_revenue"]
    assert df.count() > 0


@pytest.mark.parametrize("name", list(driver.core_queries()))
def test_query_agrees_with_sql(spark, oracle, name):
    df = driver.queries()[name](spark, FOLDER)
    result = oracle.execute(driver.oracle_sql()[name])
    names = [column[0] for column in result.description]
    assert {n: TYPES[kind] for n, kind in df.dtypes} == {
        column[0]: str(column[1]) for column in result.description
    }
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())
