"""Station-observation analytics as Spark DataFrame and ``pyspark.ml`` operations."""

from obsflow.operators.cleaning import FieldSpec, clean_column, clean_field
from obsflow.operators.scoring import best_model, score
from obsflow.operators.splitting import hash_split, random_split
from obsflow.operators.tuning import staged_search
from obsflow.operators.vectors import feature_pipeline
from obsflow.plans.features import BASELINE, COMPACT, PRODUCTION, FeaturePlan, load_features, model_table, prepare
from obsflow.plans.job import TrainingSettings, run_job, train_models
from obsflow.sources.observations import read_by_header, read_inferred, read_observations
from obsflow.sources.schema import OBSERVATION_SCHEMA
from obsflow.sources.session import create_session

__all__ = [
    "BASELINE", "COMPACT", "PRODUCTION", "FeaturePlan", "FieldSpec", "OBSERVATION_SCHEMA", "TrainingSettings",
    "best_model", "clean_column", "clean_field", "create_session", "feature_pipeline", "hash_split",
    "load_features", "model_table", "prepare", "random_split", "read_by_header", "read_inferred",
    "read_observations", "run_job", "score", "staged_search", "train_models",
]
