"""Text queries against their SQL twins."""

import duckdb
import pytest

from obsflow.llm.queries import QUERIES
from obsflow.llm.twins import TWINS

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(TWINS))
def test_same_rows_as_sql(spark, name):
    other = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        other.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    ours = QUERIES[name](spark, SF)
    theirs = other.sql(TWINS[name])
    names = sorted(ours.columns)
    assert sorted(theirs.columns) == names
    places = [theirs.columns.index(n) for n in names]
    assert sorted(repr(tuple(r[n] for n in names)) for r in ours.collect()) == sorted(repr(tuple(r[i] for i in places)) for r in theirs.fetchall())
