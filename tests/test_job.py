import json
from datetime import datetime
from pathlib import Path

import pytest
from conftest import SMALL
from pyspark.ml import PipelineModel
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressionModel

from obsflow.plans import catalog, job
from obsflow.plans.features import PRODUCTION, model_table
from obsflow.plans.fixture import as_file_rows
from obsflow.operators.splitting import hash_split
from obsflow.plans.job import TrainingSettings, run_directory, run_job, split_stage, train_models
from obsflow.plans.progress import complete_runs
from obsflow.sources.observations import read_by_header, read_observations

QUICK = TrainingSettings(
    boosted={"maxIter": 2},
    forest={"numTrees": 3},
    boosted_grid={"maxDepth": [2, 3]},
    forest_grid={"maxDepth": [2]},
    fractions=(0.3, 0.6),
    top_n=1,
    parallelism=2,
)


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("files") / "csv")
    as_file_rows(catalog.observations(spark, SMALL)).write.csv(path, header=True)
    return path


def test_whole_job(spark, files, tmp_path):
    metrics = run_job(spark, files, str(tmp_path), settings=QUICK, clock=lambda: datetime(2024, 5, 6, 7, 8, 9))
    run = Path(run_directory(str(tmp_path), datetime(2024, 5, 6, 7, 8, 9)))
    assert run.name == "20240506_070809"
    assert sorted(p.name for p in run.iterdir()) == ["manifest", "metrics", "models", "progress", "stage"]
    parts = [p for p in (run / "metrics").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1 and json.loads(parts[0].read_text()) == metrics
    assert metrics["timestamp"] == "2024-05-06T07:08:09"
    assert [m["model"] for m in metrics["models"]] == ["Gradient Boosting Trees", "Random Forest"]
    assert metrics["best_model"] == min(metrics["models"], key=lambda m: m["rmse"])["model"]
    assert all(m["r2"] > 0.3 for m in metrics["models"])
    assert GBTRegressionModel.load(f"{run}/models/gradient_boosting").getSubsamplingRate() == 0.8
    assert RandomForestRegressionModel.load(f"{run}/models/random_forest").getMinInstancesPerNode() == 10
    assert len(PipelineModel.load(f"{run}/models/feature_pipeline").stages) == 2


def test_job_on_mixed_layouts(spark, files, tmp_path):
    rows, mixed = read_observations(spark, files), str(tmp_path / "mixed")
    rows.where("LATITUDE >= 0").write.csv(mixed, header=True)
    rows.where("LATITUDE < 0").select(*rows.columns[::-1]).write.mode("append").csv(mixed, header=True)
    out, clock = str(tmp_path / "out"), lambda: datetime(2024, 1, 1)
    run_job(spark, mixed, out, settings=QUICK, clock=clock, reader=read_by_header)
    staged = spark.read.parquet(f"{run_directory(out, clock())}/stage").select(*PRODUCTION.columns)
    assert sorted(map(tuple, staged.collect())) == sorted(map(tuple, model_table(rows).collect()))


def test_training_on_given_parts(spark, files, tmp_path):
    train, test = hash_split(model_table(read_observations(spark, files)), 0.7)
    metrics = train_models(train, test, str(tmp_path), QUICK, clock=lambda: datetime(2024, 1, 1))
    run = Path(run_directory(str(tmp_path), datetime(2024, 1, 1)))
    assert sorted(p.name for p in (run / "stage").iterdir()) == ["test", "train"]
    assert spark.read.parquet(f"{run}/stage/train").count() == train.count()
    assert [m["model"] for m in metrics["models"]] == ["Gradient Boosting Trees", "Random Forest"]


def test_split_stage(spark, files, tmp_path):
    table = model_table(read_observations(spark, files))
    train, test = split_stage(table, str(tmp_path / "stage"), 0.7)
    assert train.columns == list(PRODUCTION.columns)
    assert sorted(map(tuple, train.unionAll(test).collect())) == sorted(map(tuple, table.collect()))
    assert "PartitionFilters: [isnotnull(in_train" in train._jdf.queryExecution().toString()


def test_a_stopped_job_is_not_complete_and_goes_on(spark, files, tmp_path, monkeypatch):
    out, clock = str(tmp_path), lambda: datetime(2024, 1, 1)
    run, search, searched = run_directory(out, clock()), job.staged_search, []

    def stopped(estimator, *args, **kwargs):
        searched.append(type(estimator).__name__)
        if searched == ["GBTRegressor", "RandomForestRegressor"]:
            raise RuntimeError("stopped")
        return search(estimator, *args, **kwargs)

    def unread(session, path):
        raise AssertionError("files were read again")

    monkeypatch.setattr(job, "staged_search", stopped)
    with pytest.raises(RuntimeError):
        run_job(spark, files, out, settings=QUICK, clock=clock)
    assert complete_runs(spark, out).count() == 0 and not Path(run, "manifest").exists()
    with pytest.raises(ValueError, match="other settings"):
        run_job(spark, files, out, 0.6, QUICK, clock=clock, resume=run)
    metrics = run_job(spark, files, out, settings=QUICK, clock=clock, reader=unread, resume=run)
    assert searched == ["GBTRegressor", "RandomForestRegressor", "RandomForestRegressor"]
    assert [m["model"] for m in metrics["models"]] == ["Gradient Boosting Trees", "Random Forest"]
    row = complete_runs(spark, out).first()
    assert (row.run, json.loads(row.metrics)) == ("20240101_000000", metrics)
    assert row.parts == ["stage", "feature_pipeline", "gradient_boosting", "random_forest"]
    # A complete run is not run again.
    assert run_job(spark, files, out, settings=QUICK, reader=unread, resume=run) == metrics and len(searched) == 3
    whole = run_job(spark, files, out, settings=QUICK, clock=lambda: datetime(2025, 1, 1))
    for a, b in zip(whole["models"], metrics["models"]):
        assert a["rmse"] == pytest.approx(b["rmse"], rel=0.2)


def test_a_half_written_stage_is_written_again(spark, files, tmp_path):
    out, clock = str(tmp_path), lambda: datetime(2024, 1, 1)
    run = run_directory(out, clock())
    spark.range(3).selectExpr("id", "1 AS in_train").write.partitionBy("in_train").parquet(f"{run}/stage")
    metrics = run_job(spark, files, out, settings=QUICK, clock=clock, resume=run)
    assert spark.read.parquet(f"{run}/stage").count() == model_table(read_observations(spark, files)).count()
    assert metrics["best_model"] and complete_runs(spark, out).count() == 1
