"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload import base

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if pd.isna(value):
        return None
    return f"{float(value):.9g}" if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def _rows(frame):
    frame = frame.reindex(sorted(frame.columns), axis=1).astype(object)
    return sorted((tuple(map(_plain, row)) for row in frame.itertuples(index=False, name=None)), key=str)


def test_every_query_has_sql():
    assert set(base.QUERIES) == set(base.SQL)
    assert set(base.QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(base.QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = queries()[name](spark, SF).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) > 0
    assert _rows(got) == _rows(want)


def test_entry(spark):
    assert entry(spark).count() > 0
