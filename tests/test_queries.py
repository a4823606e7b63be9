"""Registered queries against their SQL twins on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as repo
from check_queries import compare
from sievework.catalog import load
from sievework.catalog.results import RESULTS

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = repo.queries(), repo.oracle_sql()
CHECKED = sorted(set(ORACLES) & set(RESULTS))


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_every_oracle_declares_its_result():
    assert set(RESULTS) == set(load()[1])


def test_entry(spark):
    assert repo.entry(spark).limit(5).count() == 5


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", CHECKED)
def test_equals_sql(spark, con, name):
    df_types = dict(QUERIES[name](spark, FOLDER).dtypes)
    assert df_types == dict(c.rsplit(" ", 1) for c in RESULTS[name].split(", "))
    state, note, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER)
    assert state == "ok", note
