"""Fitted tree ensembles as tables of nodes, and predictions by joins with them.

A node table can be read and scored by any SQL engine, without the model's library: a row starts at
node 0 of every tree and follows the children until it is at a leaf; leaf values times the
trees' weights add up to the prediction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.functions.packed import name
from obsflow.sources.session import scratch_path

#: Nodes that are sent to all tasks; larger ensembles are joined by sorting.
SENT = 1_000_000


def node_table(spark: SparkSession, model: GBTRegressionModel | RandomForestRegressionModel) -> DataFrame:
    """``tree``, ``weight``, ``node``, ``feature`` (its place, null at leaves), ``threshold``, ``left``, ``right``, ``value``.

    Read from the model as it is saved. A value at most as large as the threshold goes left. Trees of a
    forest share the weight of one. Splits are of numbers, which is all that assembled columns hold.
    """
    path = scratch_path(spark, "nodes")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").selectExpr("treeID AS tree", "inline(array(nodeData))")
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "settings", "weight")
    share = 1.0 / model.getNumTrees if isinstance(model, RandomForestRegressionModel) else 1.0
    inner = "leftChild >= 0"
    return nodes.join(weights, "tree").selectExpr(
        "tree",
        f"weight * {share!r}D AS weight",
        "id AS node",
        f"IF({inner}, split.featureIndex, NULL) AS feature",
        f"IF({inner}, split.leftCategoriesOrThreshold[0], NULL) AS threshold",
        f"IF({inner}, leftChild, NULL) AS left",
        f"IF({inner}, rightChild, NULL) AS right",
        f"IF({inner}, NULL, prediction) AS value",
    )


def score_by_nodes(rows: DataFrame, nodes: DataFrame, features: Sequence[str], keep: Sequence[str], output: str = "prediction") -> DataFrame:
    """``keep`` columns of every row and its prediction: one join per level, one sum per row.

    The sum is partly made where the row lies, so a row's trees are not shuffled one by one. A null
    feature goes right, as does NaN. An empty node table gives no rows.
    """
    nodes = nodes.withColumn("leaf", F.col("feature").isNull())
    facts = nodes.agg(F.count("*").alias("nodes"), F.max("tree").alias("last")).first()
    if facts.nodes <= SENT:
        nodes = F.broadcast(nodes)
    # Depth: how often children can be followed, from the table alone.
    depth, front = 0, nodes.where("node = 0 AND NOT leaf").select("tree", "left", "right")
    while not front.isEmpty():
        depth += 1
        ends = front.select("tree", F.explode(F.array("left", "right")).alias("node"))
        front = nodes.where("NOT leaf").join(ends, ["tree", "node"]).select("tree", "left", "right")
    last = -1 if facts.last is None else facts.last
    values = ", ".join(f"CAST({name(c)} AS DOUBLE)" for c in features)
    each = rows.withColumn("__row", F.monotonically_increasing_id()).selectExpr("__row", *map(name, keep), f"array({values}) AS __v")
    each = each.withColumn("tree", F.explode(F.expr(f"filter(sequence(0, {max(last, 0)}), x -> x <= {last})"))).withColumn("node", F.lit(0))
    kept = ["__row", *keep, "__v", "tree"]
    for _ in range(depth):
        below = "IF(leaf, node, IF(__v[feature] <= threshold, left, right)) AS node"
        each = each.join(nodes, ["tree", "node"]).selectExpr(*map(name, kept), below)
    ended = each.join(nodes, ["tree", "node"])
    return ended.groupBy("__row", *keep).agg(F.sum(F.col("weight") * F.col("value")).alias(output)).drop("__row")
