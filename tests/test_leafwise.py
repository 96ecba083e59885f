"""Leaf-wise boosting against a trainer in plain Python, other partitionings and the library's boosting."""

import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from obsflow.operators import leafwise
from obsflow.operators.models import boosted_rounds, fit_predict
from obsflow.operators.vectors import assembler

NAMES = ("a", "b", "c")


def table(spark, n=400, seed=1):
    chance = np.random.default_rng(seed)
    x = np.round(chance.uniform(-5, 5, (n, 3)), 3)
    x[:, 2] = np.round(x[:, 2])
    y = np.round(3 * np.sin(x[:, 0]) + np.where(x[:, 1] > 1, 4, 0) * (x[:, 2] > 0) + chance.normal(0, 0.1, n), 2)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double"), rows


def plain(rows, rounds, leaves, rate, l2, bins, least):
    """The same trees, one split at a time, every leaf summed anew."""
    x, y = [r[:3] for r in rows], [math.floor(r[3] * leafwise.ONE + 0.5) for r in rows]
    edges = []
    for j in range(3):
        edges.append(sorted({round(float(np.quantile([r[j] for r in x], i / bins)), 6) for i in range(1, bins)}))
    b = [[sum(v > e for e in edges[j]) for j, v in enumerate(r)] for r in x]
    f = [math.floor(float(sum(y)) / len(y))] * len(y)
    for _ in range(rounds):
        node = [1] * len(y)
        for step in range(1, leaves):
            best = None
            for k in sorted(set(node)):
                own = [i for i in range(len(y)) if node[i] == k]
                total = sum(y[i] - f[i] for i in own)
                for j in range(3):
                    for cut in range(bins):
                        left = [i for i in own if b[i][j] <= cut]
                        if len(left) < least or len(own) - len(left) < least:
                            continue
                        g = sum(y[i] - f[i] for i in left)
                        gain = float(g) * g / (len(left) + l2) + float(total - g) * (total - g) / (len(own) - len(left) + l2) - float(total) * total / (len(own) + l2)
                        if gain > 0 and (best is None or gain > best[0]):
                            best = (gain, k, j, cut)
            if best is None:
                break
            _, k, j, cut = best
            node = [(2 * step if b[i][j] <= cut else 2 * step + 1) if n == k else n for i, n in enumerate(node)]
        values = {k: math.floor(rate * float(sum(y[i] - f[i] for i in range(len(y)) if node[i] == k)) / (node.count(k) + l2) + 0.5) for k in set(node)}
        f = [p + values[n] for p, n in zip(f, node, strict=True)]
    return [p / leafwise.ONE for p in f]


@pytest.mark.parametrize("leaves", [1, 2, 7])
def test_equals_the_plain_trainer(spark, leaves):
    df, rows = table(spark)
    model = leafwise.fit_leafwise(df.repartition(5), NAMES, "y", rounds=3, leaves=leaves, rate=0.3, l2=2.0, bins=8, least=15)
    got = {tuple(r)[:4]: r.prediction for r in model.predict(df).collect()}
    want = plain(rows, 3, leaves, 0.3, 2.0, 8, 15)
    assert [got[r] for r in rows] == want
    again = leafwise.fit_leafwise(df.repartition(2), NAMES, "y", rounds=3, leaves=leaves, rate=0.3, l2=2.0, bins=8, least=15)
    assert again.node_rows() == model.node_rows()


def test_node_table_gives_the_predictions(spark):
    df, rows = table(spark)
    model = leafwise.fit_leafwise(df, NAMES, "y", rounds=12, leaves=5, bins=16)
    nodes = {(t, n): rest for t, n, *rest in model.node_rows()}
    for r in model.predict(df).limit(50).collect():
        total = model.base / leafwise.ONE
        for t in range(12):
            at = 1
            while nodes[t, at][0] is not None:
                feature, edge, left, right, _ = nodes[t, at]
                at = left if r[feature] <= edge else right
            total += nodes[t, at][4]
        assert r.prediction == pytest.approx(total, abs=1e-9)


def test_edges(spark):
    df, _ = table(spark, 60)
    odd = spark.createDataFrame([(None, 1.0, 1.0, 1.0), (float("nan"), 1.0, 1.0, 1.0), (1.0, 1.0, 1.0, None)], df.schema)
    model = leafwise.fit_leafwise(df.union(odd), NAMES, "y", rounds=2, leaves=3, bins=4)
    assert model.node_rows() == leafwise.fit_leafwise(df, NAMES, "y", rounds=2, leaves=3, bins=4).node_rows()
    assert [r.prediction is None for r in model.predict(odd.coalesce(1)).collect()] == [True, True, False]
    empty = leafwise.fit_leafwise(df.where("false"), NAMES, "y", rounds=2)
    assert empty.trees == [] and {r.prediction for r in empty.predict(df).collect()} == {0.0}
    same = leafwise.fit_leafwise(df.selectExpr("a", "b", "c", "2D AS y"), NAMES, "y", rounds=5, leaves=4)
    assert {r.prediction for r in same.predict(df).collect()} == {2.0}


def test_no_worse_than_level_wise_boosting(spark):
    # A large step, since the library does not shrink its first tree.
    train, test = table(spark, 4000, 2)[0].cache(), table(spark, 2000, 3)[0].cache()
    model = leafwise.fit_leafwise(train, NAMES, "y", rounds=10, leaves=31, rate=0.4, bins=32)
    vectors = [assembler(NAMES, "features").transform(x) for x in (train, test)]
    other = fit_predict(boosted_rounds(10, label="y", stepSize=0.4), *vectors)
    judge = RegressionEvaluator(labelCol="y", metricName="rmse")
    assert judge.evaluate(model.predict(test)) <= judge.evaluate(other)
