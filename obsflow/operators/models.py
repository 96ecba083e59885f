"""Regression estimators with the settings the pipeline uses.

All are ``pyspark.ml`` estimators: rows stay on the executors, which send
fixed-size statistics to the driver. Seeds are fixed so reruns agree.
"""

from __future__ import annotations

from pyspark.ml.base import Estimator
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.operators.splitting import SEED, sample_about
from obsflow.operators.vectors import VECTOR
from obsflow.plans.features import LABEL
from obsflow.sources.session import enable_checkpoints, scratch_path
from obsflow.sources.staging import write_stage

BOUNDED_ROWS = 1_000_000


def linear(features: str = VECTOR, label: str = LABEL, **params) -> LinearRegression:
    """Least squares, no penalty."""
    return LinearRegression(featuresCol=features, labelCol=label, **params)


def boosted_trees(features: str = VECTOR, label: str = LABEL, **params) -> GBTRegressor:
    """Gradient-boosted trees, library defaults."""
    return GBTRegressor(featuresCol=features, labelCol=label, **{"seed": SEED, **params})


def random_forest(features: str = VECTOR, label: str = LABEL, **params) -> RandomForestRegressor:
    """Random forest, library defaults."""
    return RandomForestRegressor(featuresCol=features, labelCol=label, **{"seed": SEED, **params})


# Settings the tuned models start from.
BOOSTED_BASE = {"maxIter": 100, "maxDepth": 5, "subsamplingRate": 0.8}
FOREST_BASE = {"numTrees": 100, "minInstancesPerNode": 10}


def boosted_base(features: str = VECTOR, label: str = LABEL, **params) -> GBTRegressor:
    """Gradient-boosted trees as tuning starts from them."""
    return boosted_trees(features, label, **{**BOOSTED_BASE, **params})


def forest_base(features: str = VECTOR, label: str = LABEL, **params) -> RandomForestRegressor:
    """Random forest as tuning starts from it."""
    return random_forest(features, label, **{**FOREST_BASE, **params})


def boosted_rounds(rounds: int = 100, features: str = VECTOR, label: str = LABEL, **params) -> GBTRegressor:
    """Boosting on squared error with a given number of rounds."""
    return boosted_trees(features, label, **{"maxIter": rounds, "lossType": "squared", **params})


def bounded_training(train: DataFrame, rows: int = BOUNDED_ROWS) -> DataFrame:
    """Labelled training rows, about ``rows`` of them at random.

    Only the rows a model is fitted on are bounded; whatever is scored stays
    whole. A limit would send up to that many rows of *every* partition to one
    task; the sample stays where the rows are. It is stored, so that a trainer's
    many passes read the sample and not the whole table again.
    """
    sample = sample_about(train.where(F.col(LABEL).isNotNull()), rows)
    return write_stage(sample, scratch_path(train.sparkSession, "bounded"))


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame) -> DataFrame:
    """Fit on one frame, add predictions to the other.

    Nothing is persisted here: least squares reads its rows once, and the tree
    trainers keep their own binned form. Boosting cuts its lineage in the shared folder.
    """
    enable_checkpoints(train.sparkSession)
    return estimator.fit(train.select(estimator.getFeaturesCol(), estimator.getLabelCol())).transform(test)
