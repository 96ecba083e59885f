"""Staged search: a wide grid on a small sample, the best few on a larger one, then all rows."""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession

from obsflow.operators.ledger import SearchLedger
from obsflow.operators.splitting import SEED, bernoulli_sample, hash_sample, hash_split, salted_bucket
from obsflow.sources.session import enable_checkpoints

ParamMap = dict[Param, object]

# The grids searched for each model.
BOOSTED_GRID = {
    "maxDepth": [3, 5, 8],
    "maxIter": [20, 50],
    "stepSize": [0.05, 0.1],
    "maxBins": [32, 64],
}
FOREST_GRID = {
    "numTrees": [50, 100],
    "maxDepth": [6, 10, 14],
    "maxBins": [32, 64],
    "subsamplingRate": [0.8, 1.0],
    "featureSubsetStrategy": ["auto", "sqrt"],
}


def build_grid(estimator: Estimator, values: dict[str, list]) -> list[ParamMap]:
    """Every combination of the listed values, as parameter maps."""
    builder = ParamGridBuilder()
    for name, choices in values.items():
        builder = builder.addGrid(estimator.getParam(name), choices)
    return builder.build()


def boosted_grid(estimator: GBTRegressor) -> list[ParamMap]:
    """The 24-point grid."""
    return build_grid(estimator, BOOSTED_GRID)


def forest_grid(estimator: RandomForestRegressor) -> list[ParamMap]:
    """The 48-point grid."""
    return build_grid(estimator, FOREST_GRID)


def described(params: ParamMap) -> dict[str, str]:
    """Parameter names and values as text."""
    return {p.name: str(v) for p, v in params.items()}


def _spelled(estimator: Estimator) -> list:
    """An estimator's kind and all its settings, the same for equal estimators."""
    return [type(estimator).__name__, sorted(described(estimator.extractParamMap()).items())]


@dataclass(frozen=True)
class Candidate:
    """One parameter map and what it scored."""

    params: ParamMap
    metric: float


def rank(candidates: Sequence[Candidate], larger_better: bool) -> list[Candidate]:
    """Best first; a candidate without a usable score goes last, ties keep their order."""
    sign = -1.0 if larger_better else 1.0
    return sorted(candidates, key=lambda c: (c.metric != c.metric, sign * c.metric))


def _rounds_nest(estimator: Estimator, evaluator: Evaluator) -> bool:
    """Whether a fit of more boosting rounds holds the fits of fewer, and can be scored at each."""
    return isinstance(estimator, GBTRegressor) and isinstance(evaluator, RegressionEvaluator) and evaluator.getMetricName() == "rmse"


def nested_fits(estimator: Estimator, evaluator: Evaluator, grid: Sequence[ParamMap]) -> list[list[int]]:
    """Places in ``grid`` that one fit can score: maps that differ only in the rounds of boosting.

    A round's seed follows from its number alone, so a fit of 50 rounds begins with the fit of 20.
    Forests do not nest: their row weights are drawn for all trees at once.
    """
    nest, groups = _rounds_nest(estimator, evaluator), {}
    for place, params in enumerate(grid):
        rest = tuple(sorted((p.name, str(v)) for p, v in params.items() if p.name != "maxIter"))
        groups.setdefault(rest if nest else place, []).append(place)
    return list(groups.values())


def _metrics_of_one_fit(estimator, evaluator, maps: Sequence[ParamMap], train: DataFrame, held: DataFrame) -> list[float]:
    """Metrics of parameter maps that differ only in rounds, from a fit of the most rounds."""
    if len(maps) == 1:
        return [evaluator.evaluate(estimator.fit(train, maps[0]).transform(held))]
    rounds = [params.get(estimator.maxIter, estimator.getMaxIter()) for params in maps]
    model = estimator.fit(train, {**maps[0], estimator.maxIter: max(rounds)})
    errors = model.evaluateEachIteration(held, "squared")
    return [math.sqrt(errors[n - 1]) for n in rounds]


def validation_search(
    estimator: Estimator,
    grid: Sequence[ParamMap],
    data: DataFrame,
    evaluator: Evaluator,
    train_ratio: float = 0.8,
    parallelism: int = 8,
    seed: int = SEED,
    keys: Sequence[str] | None = None,
    ledger: SearchLedger | None = None,
    phase: int = 1,
) -> list[Candidate]:
    """Score every parameter map on one held-out part, best first.

    The two parts are kept (memory, then disk) while the search runs; maps that differ only in the
    rounds of boosting share a fit, ``parallelism`` fits run at a time, and a model is let go once scored.
    With ``keys`` the parts follow from a hash of those columns, whatever the partitioning. Scores go to
    the ``ledger`` as fits end; maps that it knows are not fitted again.
    """
    metrics: list[float | None] = ledger.known(phase, [described(p) for p in grid]) if ledger else [None] * len(grid)
    fits = [[i for i in group if metrics[i] is None] for group in nested_fits(estimator, evaluator, grid)]
    fits = [group for group in fits if group]
    if keys:
        parts = hash_split(data, train_ratio, keys, salted_bucket(f"validation {seed}"))
    else:
        parts = data.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    train, held = (p.persist(StorageLevel.MEMORY_AND_DISK) for p in parts)

    def fit_group(group: list[int]) -> None:
        for i, metric in zip(group, _metrics_of_one_fit(estimator, evaluator, [grid[i] for i in group], train, held), strict=True):
            metrics[i] = metric
            if ledger:
                ledger.record(phase, described(grid[i]), metric)

    try:
        if fits:
            with ThreadPool(parallelism) as pool:
                pool.map(inheritable_thread_target(data.sparkSession)(fit_group), fits, chunksize=1)
    finally:
        for p in (train, held):
            p.unpersist()
    return rank([Candidate(p, m) for p, m in zip(grid, metrics, strict=True)], evaluator.isLargerBetter())


@dataclass
class StagedSearch:
    """Outcome of :func:`staged_search`: the final model and how it was chosen."""

    model: Model
    best: Candidate
    phases: list[list[Candidate]] = field(default_factory=list)

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per candidate and phase: phase, rank, params, metric."""
        rows = [
            (phase, place, described(c.params), float(c.metric))
            for phase, ranked in enumerate(self.phases, 1)
            for place, c in enumerate(ranked, 1)
        ]
        return spark.createDataFrame(rows, "phase int, rank int, params map<string,string>, metric double")


def staged_search(
    estimator: Estimator,
    grid: Sequence[ParamMap],
    train: DataFrame,
    fractions: Sequence[float] = (0.01, 0.1),
    train_ratio: float = 0.8,
    top_n: int = 5,
    parallelism: int = 8,
    seed: int = SEED,
    reset_base: bool = False,
    keys: Sequence[str] | None = None,
    ledger: str | None = None,
) -> StagedSearch:
    """Search ``grid`` on growing samples, then fit the winner on all of ``train``.

    Each phase but the last keeps its ``top_n`` best. The final fit keeps the
    estimator's own settings next to the winning ones; ``reset_base`` drops
    them back to library defaults, for comparison with a search that did so.

    ``keys`` are columns whose hash draws samples and held-out parts, the same under any
    partitioning. ``ledger`` is a path of the shared folder that keeps every score; a search begun
    again with the same settings and path goes on where it stopped. The path stands for the data:
    use another one for other rows.
    """
    evaluator = RegressionEvaluator(
        labelCol=estimator.getLabelCol(), predictionCol=estimator.getPredictionCol(), metricName="rmse"
    )
    enable_checkpoints(train.sparkSession)
    remaining, phases = list(grid), []
    for phase, fraction in enumerate(fractions, 1):
        sample = hash_sample(train, fraction, keys, f"sample {seed}") if keys else bernoulli_sample(train, fraction, seed)
        settings = json.dumps([_spelled(estimator), fraction, train_ratio, seed, list(keys or ())])
        book = SearchLedger(train.sparkSession, ledger, settings) if ledger else None
        ranked = validation_search(estimator, remaining, sample, evaluator, train_ratio, parallelism, seed, keys, book, phase)
        phases.append(ranked)
        remaining = [c.params for c in ranked[:top_n]]
    best = phases[-1][0]
    if reset_base:
        plain = type(estimator)(featuresCol=estimator.getFeaturesCol(), labelCol=estimator.getLabelCol(), seed=seed)
        final = plain.setParams(**{p.name: v for p, v in best.params.items()})
    else:
        final = estimator.copy(best.params)
    return StagedSearch(final.fit(train), best, phases)
