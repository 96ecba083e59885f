"""Node tables scored here and by another engine give the model's own predictions."""

import duckdb
import pytest

from obsflow.operators.models import boosted_trees, random_forest
from obsflow.operators.node_tables import node_table, score_by_nodes
from obsflow.operators.vectors import assembler
from obsflow.sources.session import enable_checkpoints

WALK = """
WITH RECURSIVE walk AS (
  SELECT id, tree, node, a, b FROM obs, (SELECT tree, node FROM nodes WHERE node = 0)
  UNION ALL
  SELECT id, walk.tree, CASE WHEN [a, b][n.feature + 1] <= n.threshold THEN n."left" ELSE n."right" END, a, b
  FROM walk JOIN nodes n ON walk.tree = n.tree AND walk.node = n.node WHERE n.feature IS NOT NULL)
SELECT id, sum(weight * value) FROM walk JOIN nodes USING (tree, node) WHERE value IS NOT NULL GROUP BY id
"""


@pytest.mark.parametrize("make", [lambda: random_forest(label="y", numTrees=7), lambda: boosted_trees(label="y", maxIter=5)])
def test_same_predictions_everywhere(spark, make):
    enable_checkpoints(spark)
    rows = spark.range(300).selectExpr("id", "double(id % 17) AS a", "double(id * 7 % 23) AS b", "double(id % 17 * 2 - id * 7 % 23) AS y")
    model = make().fit(assembler(["a", "b"], "features").transform(rows))
    want = {r.id: r.prediction for r in model.transform(assembler(["a", "b"], "features").transform(rows)).collect()}
    nodes = node_table(spark, model)
    ours = {r.id: r.p for r in score_by_nodes(rows, nodes, ["a", "b"], ["id"], "p").collect()}
    other = duckdb.connect()
    tables = {"nodes": nodes.toArrow(), "obs": rows.toArrow()}
    for table, frame in tables.items():
        other.register(table, frame)
    theirs = dict(other.sql(WALK).fetchall())
    assert ours.keys() == theirs.keys() == want.keys()
    assert all(ours[i] == pytest.approx(want[i]) == theirs[i] for i in want)


def test_no_rows_and_no_nodes(spark):
    rows = spark.range(20).selectExpr("id", "double(id) AS a", "double(1) AS y")
    model = random_forest(label="y", numTrees=2).fit(assembler(["a"], "features").transform(rows))
    nodes = node_table(spark, model)  # every tree is one leaf
    assert {r.prediction for r in score_by_nodes(rows, nodes, ["a"], ["id"]).collect()} == {1.0}
    assert score_by_nodes(rows.where("false"), nodes, ["a"], ["id"]).collect() == []
    assert score_by_nodes(rows, nodes.where("false"), ["a"], ["id"]).collect() == []
