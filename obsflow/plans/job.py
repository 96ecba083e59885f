"""The whole job: read, clean, split, train, score, save."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.operators.models import boosted_base, forest_base
from obsflow.operators.scoring import metrics_record, score
from obsflow.operators.splitting import fast_bucket, in_train
from obsflow.operators.tuning import BOOSTED_GRID, FOREST_GRID, build_grid, staged_search
from obsflow.operators.vectors import VECTOR, feature_pipeline
from obsflow.plans.features import LABEL, PRODUCTION, FeaturePlan, model_table
from obsflow.plans.progress import Progress
from obsflow.sources.observations import read_observations
from obsflow.sources.session import enable_checkpoints
from obsflow.sources.staging import write_stage

BOOSTED_NAME = "Gradient Boosting Trees"
FOREST_NAME = "Random Forest"


@dataclass(frozen=True)
class TrainingSettings:
    """What to search and how hard. The defaults are the full search."""

    boosted: dict = field(default_factory=dict)
    forest: dict = field(default_factory=dict)
    boosted_grid: dict = field(default_factory=lambda: dict(BOOSTED_GRID))
    forest_grid: dict = field(default_factory=lambda: dict(FOREST_GRID))
    fractions: Sequence[float] = (0.01, 0.1)
    search_ratio: float = 0.8
    top_n: int = 5
    parallelism: int = 8
    reset_base: bool = False


def run_directory(base: str, now: datetime) -> str:
    """Directory of one run, named after its start."""
    return f"{base.rstrip('/')}/{now.strftime('%Y%m%d_%H%M%S')}"


def save_model(model: MLWritable, path: str, overwrite: bool = True) -> None:
    """Save a fitted model or pipeline; without ``overwrite`` an existing one is an error."""
    writer = model.write()
    (writer.overwrite() if overwrite else writer).save(path)


def save_metrics(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write the one-row metrics record as a single JSON part."""
    record.coalesce(1).write.mode(mode).json(path)


def _begin(spark: SparkSession, output_path: str, clock, resume: str | None, *settings) -> Progress:
    """Progress of a new run, or of the one to go on with."""
    return Progress(spark, resume.rstrip("/") if resume else run_directory(output_path, clock()), repr(settings))


def train_models(
    train: DataFrame,
    test: DataFrame,
    output_path: str,
    settings: TrainingSettings = TrainingSettings(),
    plan: FeaturePlan = PRODUCTION,
    clock: Callable[[], datetime] = datetime.now,
    resume: str | None = None,
) -> dict:
    """Train on ``train``, score on ``test``, save below a time-stamped directory.

    Both parts are stored as columns first; training reads them many times.
    ``resume`` names the directory of a stopped run to go on with, given the same parts.
    """
    spark = train.sparkSession
    progress = _begin(spark, output_path, clock, resume, settings, plan)
    finished = progress.outcome()
    if finished is not None:
        return finished
    paths = {side: f"{progress.run}/stage/{side}" for side in ("train", "test")}
    for side, part in (("train", train), ("test", test)):
        if not progress.done(f"stage_{side}"):
            write_stage(_labelled(part.select(*plan.columns)), paths[side], mode="overwrite" if resume else "errorifexists")
            progress.finish(f"stage_{side}")
    return _train_into(progress, *(spark.read.parquet(path) for path in paths.values()), settings, plan, clock)


def _labelled(table: DataFrame) -> DataFrame:
    return table.where(f"{LABEL} IS NOT NULL")


def _saved(progress: Progress, part: str, reader: type, make: Callable[[], MLWritable]) -> MLWritable:
    """A model of this run: the one saved before, or a new one, saved and recorded."""
    path = f"{progress.run}/models/{part}"
    if progress.done(part):
        return reader.load(path)
    model = make()
    save_model(model, path)
    progress.finish(part)
    return model


def _train_into(progress: Progress, train: DataFrame, test: DataFrame, settings, plan, clock) -> dict:
    """Fit the feature pipeline and both tuned models, save them, score them, save the scores.

    ``train`` and ``test`` are stored tables, so full passes read those files
    instead of filling executor memory; the search keeps its samples, and the
    tree trainers their own compact form of the rows. Both models are scored
    in one pass over ``test``. Each model is saved as soon as it is fitted, and
    a search keeps its scores, so a run that goes on repeats at most the fits under way.
    """
    spark, run = train.sparkSession, progress.run
    enable_checkpoints(spark)
    for side, part in (("training", train), ("test", test)):
        if part.isEmpty():
            raise ValueError(f"the {side} side has no rows; nothing was trained")
    pipeline = _saved(progress, "feature_pipeline", PipelineModel, lambda: feature_pipeline(plan.features).fit(train))
    vectors = pipeline.transform(train).select(VECTOR, LABEL)
    fitted = {}
    for name, part, reader, estimator, grid in (
        (BOOSTED_NAME, "gradient_boosting", GBTRegressionModel, boosted_base(**settings.boosted), settings.boosted_grid),
        (FOREST_NAME, "random_forest", RandomForestRegressionModel, forest_base(**settings.forest), settings.forest_grid),
    ):

        def searched() -> MLWritable:
            return staged_search(
                estimator,
                build_grid(estimator, grid),
                vectors,
                fractions=settings.fractions,
                train_ratio=settings.search_ratio,
                top_n=settings.top_n,
                parallelism=settings.parallelism,
                reset_base=settings.reset_base,
                ledger=f"{progress.searches}/{part}",
            ).model

        fitted[name] = _saved(progress, part, reader, searched)

    scored, columns = pipeline.transform(test).select(VECTOR, LABEL), {}
    for place, (name, model) in enumerate(fitted.items()):
        columns[name] = f"prediction_{place}"
        scored = model.copy().setPredictionCol(columns[name]).transform(scored)
    record = metrics_record(score(scored, columns), clock().isoformat())
    metrics = record.first()
    # Without a manifest, metrics that are there were left by a stopped attempt.
    save_metrics(spark.createDataFrame([metrics], record.schema), f"{run}/metrics", "overwrite")
    outcome = metrics.asDict(recursive=True)
    progress.complete(outcome)
    return outcome


def split_stage(table: DataFrame, path: str, train_ratio: float = 0.7, compact: bool = False, mode: str = "errorifexists"):
    """Write the model table once with its split as partitions; return train and test readers.

    Each side is a partition of the stage, so reading one never touches the other.
    """
    side = in_train(fast_bucket(table.columns), train_ratio).cast("int").alias("in_train")
    staged = write_stage(table.select("*", side), path, ["in_train"], compact, mode=mode)
    return _sides(staged, table.columns)


def _sides(staged: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    train, test = (staged.where(F.col("in_train") == i).select(*columns) for i in (1, 0))
    return train, test


def run_job(
    spark: SparkSession,
    data_path: str,
    output_path: str,
    train_ratio: float = 0.7,
    settings: TrainingSettings = TrainingSettings(),
    plan: FeaturePlan = PRODUCTION,
    clock: Callable[[], datetime] = datetime.now,
    compact: bool = False,
    reader: Callable[[SparkSession, str], DataFrame] = read_observations,
    resume: str | None = None,
) -> dict:
    """Directory of observation files in, saved models and metrics out.

    The files are parsed once, into a columnar stage inside the run directory;
    every later pass reads that. ``reader`` may be ``read_by_header`` for a
    directory of mixed layouts. Returns the metrics record.

    ``resume`` names the directory of a stopped run: its finished stage, models and candidates are
    used as they are, a complete run only returns its metrics, and other settings than the run was
    begun with are an error.
    """
    if not 0 < train_ratio < 1:
        raise ValueError(f"a training share between 0 and 1 is needed, not {train_ratio}")
    progress = _begin(spark, output_path, clock, resume, data_path, train_ratio, settings, plan)
    finished = progress.outcome()
    if finished is not None:
        return finished
    path = f"{progress.run}/stage"
    if progress.done("stage"):
        train, test = _sides(spark.read.parquet(path), plan.columns)
    else:
        table = _labelled(model_table(reader(spark, data_path), plan))
        train, test = split_stage(table, path, train_ratio, compact, "overwrite" if resume else "errorifexists")
        progress.finish("stage")
    return _train_into(progress, train, test, settings, plan, clock)
