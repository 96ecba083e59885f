"""Gradient boosting that grows leaf by leaf, from histograms that Spark sums.

Features are binned once at exact quantiles of the training rows. A pass over the binned
rows sums gradients and counts by leaf, feature and bin; only these sums reach the
driver, which splits the leaf of the largest gain until a tree has its leaves. Of
two new leaves only the smaller is summed, its sibling is what is left of their parent, and
one pass serves the most promising leaves together. Gains and leaf values are damped by ``l2``.

Labels, gradients and predictions are whole numbers (multiples of 1 / ``ONE``), so sums do not depend on
how rows are partitioned, subtraction is exact and a rerun gives the same trees.

Rows with a null or NaN in the label or a feature are not fitted on; rows with one in a feature get a null
prediction. Ties go to the older leaf, the earlier feature and the lower bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.packed import name
from obsflow.operators.profiling import quantiles
from obsflow.sources.session import scratch_path

ONE = 1 << 20
#: Leaves whose children are summed in one pass.
AHEAD = 16
#: Trees scored in one projection.
TOGETHER = 10


@dataclass(frozen=True)
class Split:
    feature: int
    bin: int
    gain: float
    left: tuple[int, int]
    right: tuple[int, int]


@dataclass
class Node:
    """A tree node: where it lies, what it holds (sum of gradients, rows), how it is split."""

    id: int
    test: str
    total: tuple[int, int]
    split: Split | None = None
    children: tuple[Node, Node] | None = None
    value: int = 0


@dataclass
class LeafwiseModel:
    """Edges of the bins, the start value and the trees; ``rate`` is already in the leaves."""

    features: tuple[str, ...]
    edges: list[list[float]]
    base: int
    trees: list[Node] = field(default_factory=list)

    def node_rows(self) -> list[tuple]:
        """(tree, node, feature, threshold, left, right, value) of every node; a value at most goes left."""
        out = []
        for t, tree in enumerate(self.trees):
            todo = [tree]
            while todo:
                n = todo.pop()
                if n.children:
                    edges = self.edges[n.split.feature]
                    edge = edges[n.split.bin] if n.split.bin < len(edges) else math.inf
                    out.append((t, n.id, self.features[n.split.feature], edge, n.children[0].id, n.children[1].id, None))
                    todo += n.children
                else:
                    out.append((t, n.id, None, None, None, None, n.value / ONE))
        return out

    def predict(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """The frame with predictions: projections over its own columns, no shuffle."""
        known = " AND ".join(f"{name(c)} IS NOT NULL AND NOT isnan({name(c)})" for c in self.features)
        rows = df.withColumn("__sum", F.lit(self.base).cast("bigint"))
        for first in range(0, len(self.trees), TOGETHER):
            part = " + ".join(self._leaf_of(t) for t in self.trees[first : first + TOGETHER])
            # A row of an array is laid out again, so that the next projection does not repeat this one.
            rows = rows.withColumn("__sum", F.explode(F.array(F.expr(f"__sum + {part}"))))
        return rows.withColumn(output, F.expr(f"CASE WHEN {known} THEN __sum / {float(ONE)!r}D END")).drop("__sum")

    def _leaf_of(self, node: Node) -> str:
        if not node.children:
            return f"{node.value}L"
        edges = self.edges[node.split.feature]
        if node.split.bin >= len(edges):
            return self._leaf_of(node.children[0])
        test = f"{name(self.features[node.split.feature])} <= {edges[node.split.bin]!r}D"
        return f"IF({test}, {self._leaf_of(node.children[0])}, {self._leaf_of(node.children[1])})"


def bin_edges(rows: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Inner quantiles of each feature, rounded to six places, without repeats."""
    shares = [i / bins for i in range(1, bins)]
    found: dict[str, set[float]] = {c: set() for c in features}
    for r in quantiles(rows, features, shares).selectExpr("`column`", "round(quantile, 6) + 0D AS edge").collect():
        if r.edge is not None:
            found[r["column"]].add(r.edge)
    return [sorted(found[c]) for c in features]


def best_split(sums: np.ndarray, counts: np.ndarray, least: int, l2: float) -> Split | None:
    """The split of largest gain of a node, from its histograms by feature and bin."""
    below, rows_below = np.cumsum(sums, axis=1), np.cumsum(counts, axis=1)
    total, rows = int(below[0, -1]), int(rows_below[0, -1])
    above, rows_above = total - below, rows - rows_below
    gain = below.astype(float) * below / (rows_below + l2) + above.astype(float) * above / (rows_above + l2) - float(total) * total / (rows + l2)
    gain[(rows_below < least) | (rows_above < least)] = -np.inf
    feature, place = divmod(int(gain.argmax()), gain.shape[1])
    if not gain[feature, place] > 0:
        return None
    return Split(
        feature,
        place,
        float(gain[feature, place]),
        (int(below[feature, place]), int(rows_below[feature, place])),
        (int(above[feature, place]), int(rows_above[feature, place])),
    )


def leaf_value(total: tuple[int, int], rate: float, l2: float) -> int:
    return math.floor(rate * float(total[0]) / (total[1] + l2) + 0.5)


class _Grower:
    """Grows one tree over binned rows ``y``, ``f``, ``b0``, ``b1``, … ."""

    def __init__(self, rows: DataFrame, features: int, bins: int, least: int, l2: float):
        self.rows, self.features, self.bins, self.least, self.l2 = rows, features, bins, least, l2
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _histograms(self, nodes: Sequence[Node]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Sums and counts by feature and bin of each node, from one pass."""
        leaf = f"CASE {' '.join(f'WHEN {n.test} THEN {n.id}' for n in nodes)} END"
        cells = ", ".join(f"struct({j} AS j, b{j} AS b)" for j in range(self.features))
        each = self.rows.selectExpr(f"{leaf} AS leaf", "y - f AS g", *[f"b{j}" for j in range(self.features)]).where("leaf IS NOT NULL")
        sums = each.selectExpr("leaf", "g", f"inline(array({cells}))").groupBy("leaf", "j", "b").agg(F.sum("g").alias("g"), F.count("*").alias("n"))
        out = {n.id: tuple(np.zeros((self.features, self.bins), np.int64) for _ in range(2)) for n in nodes}
        for r in sums.collect():
            out[r.leaf][0][r.j, r.b], out[r.leaf][1][r.j, r.b] = r.g, r.n
        return out

    def _learn(self, node: Node, found: tuple[np.ndarray, np.ndarray]) -> None:
        self.known[node.id] = found
        node.split = best_split(*found, self.least, self.l2)

    def _children(self, node: Node, first: int) -> tuple[Node, Node]:
        test = f"b{node.split.feature} <= {node.split.bin}"
        return Node(first, f"{node.test} AND {test}", node.split.left), Node(first + 1, f"{node.test} AND NOT ({test})", node.split.right)

    def grow(self, leaves: int) -> tuple[Node, list[Node]]:
        """The root and the leaves of a tree."""
        root = Node(1, "true", (0, 0))
        (found,) = self._histograms([root]).values()
        root.total = (int(found[0][0].sum()), int(found[1][0].sum()))
        self._learn(root, found)
        ends, ready = [root], {}
        for step in range(1, leaves):
            # Largest gain first, the older of two equal ones.
            open_ = sorted((n for n in ends if n.split), key=lambda n: (-n.split.gain, n.id))
            if not open_:
                break
            if step < leaves - 1 and open_[0].id not in ready:
                ahead = [n for n in open_ if n.id not in ready][: min(AHEAD, leaves - step)]
                smaller = {}
                for n in ahead:
                    sides = self._children(n, 0)
                    light = 0 if sides[0].total[1] <= sides[1].total[1] else 1
                    smaller[n.id] = (light, Node(n.id, sides[light].test, sides[light].total))
                for i, own in self._histograms([x for _, x in smaller.values()]).items():
                    rest = tuple(a - b for a, b in zip(self.known[i], own, strict=True))
                    ready[i] = (own, rest) if smaller[i][0] == 0 else (rest, own)
            node = open_[0]
            node.children = self._children(node, 2 * step)
            ends.remove(node)
            ends += node.children
            if node.id in ready:
                for child, own in zip(node.children, ready.pop(node.id), strict=True):
                    self._learn(child, own)
            self.known.pop(node.id)
        return root, ends


def binned(rows: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]]) -> list[str]:
    """SQL of each feature's bin: how many edges it lies above."""
    return [f"{' + '.join(f'CAST({name(c)} > {e!r}D AS INT)' for e in own) or '0'} AS b{j}" for j, (c, own) in enumerate(zip(features, edges, strict=True))]


def fit_leafwise(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    rounds: int = 100,
    leaves: int = 31,
    rate: float = 0.1,
    l2: float = 1.0,
    bins: int = 64,
    least: int = 20,
) -> LeafwiseModel:
    """Boosted trees of up to ``leaves`` leaves with at least ``least`` rows each.

    The binned rows are stored once and, with the predictions so far, once a round in the
    shared folder: a lost executor reads them again, and no plan grows with the rounds.
    """
    spark = train.sparkSession
    known = " AND ".join(f"{name(c)} IS NOT NULL AND NOT isnan({name(c)})" for c in (label, *features))
    path = scratch_path(spark, "leafwise-rows")
    train.where(known).select(label, *features).write.parquet(path)
    rows = spark.read.parquet(path)
    edges = bin_edges(rows, features, bins)
    target = rows.selectExpr(f"CAST(floor({name(label)} * {ONE} + 0.5D) AS BIGINT) AS y", *binned(rows, features, edges))
    path = scratch_path(spark, "leafwise-bins")
    target.write.parquet(path)
    start = spark.read.parquet(path).agg(F.sum("y").alias("y"), F.count("*").alias("n")).first()
    model = LeafwiseModel(tuple(features), edges, math.floor(float(start.y) / start.n) if start.n else 0)
    if not start.n:
        return model
    state = spark.read.parquet(path).withColumn("f", F.lit(model.base).cast("bigint"))
    for step in range(rounds):
        root, ends = _Grower(state, len(features), bins, least, l2).grow(leaves)
        for n in ends:
            n.value = leaf_value(n.total, rate, l2)
        model.trees.append(root)
        if not root.children and not root.value:
            break
        if step < rounds - 1:
            added = f"f + CASE {' '.join(f'WHEN {n.test} THEN {n.value}L' for n in ends)} END"
            path = scratch_path(spark, "leafwise-round")
            state.withColumn("f", F.expr(added)).write.parquet(path)
            state = spark.read.parquet(path)
    return model
