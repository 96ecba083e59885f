"""The registered search of forests takes the job's whole grid, base settings and number kept."""

import duckdb

import __spark_entry__ as entry
from obsflow.operators import models
from obsflow.operators.tuning import Candidate, StagedSearch, described, forest_grid
from obsflow.plans import catalog


def test_tune_forest_searches_the_whole_grid(spark, own_tables, monkeypatch):
    asked = {}

    def search(estimator, grid, train, fractions, top_n, **_):
        asked.update(estimator=estimator, fractions=fractions, top_n=top_n, rows=train.count())
        ranked = [Candidate(params, float(place)) for place, params in enumerate(grid)]
        return StagedSearch(None, ranked[0], [ranked, ranked[:top_n]])

    monkeypatch.setattr(catalog, "staged_search", search)
    found = catalog.tune_forest(spark, own_tables).collect()
    whole = forest_grid(models.forest_base())
    spelled = {", ".join(f"{k}={v}" for k, v in sorted(described(params).items())) for params in whole}
    assert len(found) == len(spelled) == 48 and {r.params for r in found} == spelled
    assert all(r.ordered and r.advanced_right for r in found)
    assert asked["top_n"] == 5 and min(asked["fractions"]) >= 0.2
    assert asked["rows"] == catalog.split_features(spark, own_tables)[0].count() > 0
    base = asked["estimator"]
    assert (base.getNumTrees(), base.getMinInstancesPerNode()) == (100, 10)
    # Depth is the grid's alone: the base does not bound it.
    assert not base.isSet("maxDepth")
    assert {r[0] for r in duckdb.sql(f"SELECT params FROM ({entry.oracle_sql()['tune_forest']})").fetchall()} == spelled
