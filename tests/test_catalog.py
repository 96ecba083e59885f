"""Every catalog query against its SQL twin, on the smallest tables.

`OBSFLOW_SF_DIR` points the comparison at larger ones.
"""

import os

import duckdb
import pytest
from conftest import SMALL

import __spark_entry__ as entry
from obsflow.plans.catalog import QUERIES as CATALOG

SF_DIR = os.environ.get("OBSFLOW_SF_DIR", SMALL)
QUERIES, ORACLE = entry.queries(), entry.oracle_sql()
# A hundred boosting rounds or trees, or a full grid: compared on request (OBSFLOW_SLOW=1), and by the driver each round.
SLOW = set() if os.environ.get("OBSFLOW_SLOW") else {"boosted_base", "forest_base", "boosted_on_sample", "tune_boosted_full"}
# Queries of the optional package have their own tests.
CORE = set(CATALOG)


@pytest.fixture(scope="module")
def other():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{SF_DIR}/lineitem.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE.keys() & CORE - SLOW))
def test_same_rows_as_sql(spark, other, name):
    ours = QUERIES[name](spark, SF_DIR)
    names = sorted(ours.columns)
    theirs = other.sql(ORACLE[name])
    assert sorted(theirs.columns) == names
    places = [theirs.columns.index(n) for n in names]
    got = sorted(repr(tuple(r[n] for n in names)) for r in ours.collect())
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in theirs.fetchall())
    assert got


def test_every_query_has_a_twin():
    assert CORE <= ORACLE.keys()


def test_oracle_names_are_queries():
    assert ORACLE.keys() <= QUERIES.keys()


def test_entry(spark):
    assert entry.entry(spark).count() == 1074


def test_random_split_derives_its_rows_once(spark, own_tables):
    found = CATALOG["random_split"](spark, own_tables)
    assert found.inputFiles() and not any("lineitem" in file for file in found.inputFiles())
    assert {(r.sides, r.fair) for r in found.select("sides", "fair").collect()} <= {(1, True), (1, False)}
    assert found.count() == CATALOG["feature_table"](spark, own_tables).count()
