import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from obsflow.operators import models, scoring, tuning
from obsflow.operators.tuning import Candidate
from obsflow.operators.vectors import RAW_VECTOR, VECTOR, assembler, feature_pipeline, unpack
from obsflow.plans.job import save_model


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 3)) * [1, 10, 100] + [0, 5, 1000]
    y = 2 * x[:, 0] - 0.5 * x[:, 1] + np.abs(x[:, 2] - 1000) / 50 + rng.normal(size=900) / 10
    return spark.createDataFrame([tuple(map(float, (*r, t))) for r, t in zip(x, y)], "a double, b double, c double, temperature double")


@pytest.fixture(scope="module")
def vectors(table):
    return feature_pipeline("abc").fit(table).transform(table).persist()


def test_assembler_skips_or_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 1.0), (3.0, float("nan"))], "a double, b double")
    assert [list(r[RAW_VECTOR]) for r in assembler("ab").transform(df).collect()] == [[1.0, 2.0]]
    with pytest.raises(Exception):
        assembler("ab", invalid="error").transform(df).collect()


def test_scaled_moments(vectors):
    plain = unpack(vectors, VECTOR, "abc").toPandas()
    assert np.allclose(plain.mean(), 0, atol=1e-9) and np.allclose(plain.std(ddof=1), 1)


def test_scaler_knows_only_the_training_part(table):
    train, test = table.where("b < 5"), table.where("b >= 5")
    scaled = unpack(feature_pipeline("abc").fit(train).transform(test), VECTOR, "abc").toPandas()
    mean, sd = (train.agg(f("b")).first()[0] for f in (F.avg, F.stddev_samp))
    assert np.allclose(np.sort(scaled.b), np.sort((test.toPandas().b - mean) / sd))


def test_linear_equals_least_squares(table, vectors):
    frame = table.toPandas()
    design = np.column_stack([frame[["a", "b", "c"]], np.ones(len(frame))])
    fitted = design @ np.linalg.lstsq(design, frame.temperature, rcond=None)[0]
    got = models.fit_predict(models.linear(), vectors, vectors).toPandas()
    assert np.allclose(np.sort(got.prediction), np.sort(fitted), atol=1e-8)


@pytest.mark.parametrize("make", [lambda: models.boosted_trees(maxIter=5), lambda: models.random_forest(numTrees=8)])
def test_trees_beat_the_mean_and_repeat(vectors, make):
    first, second = (models.fit_predict(make(), vectors, vectors) for _ in range(2))
    row = scoring.score(first, {"m": "prediction"}).first()
    assert row.r2 > 0.5
    assert first.select("prediction").collect() == second.select("prediction").collect()


def test_base_settings():
    boosted, forest, rounds = models.boosted_base(), models.forest_base(), models.boosted_rounds()
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getSubsamplingRate()) == (100, 5, 0.8)
    assert (forest.getNumTrees(), forest.getMinInstancesPerNode()) == (100, 10)
    assert (rounds.getMaxIter(), rounds.getLossType(), rounds.getSeed()) == (100, "squared", 42)


def test_bounded_training_drops_unlabelled_rows(spark):
    df = spark.range(100).selectExpr("id", "if(id % 2 = 0, null, cast(id as double)) as temperature")
    assert models.bounded_training(df, 1000).count() == 50
    assert models.bounded_training(df, 10).count() < 30


def test_bounded_training_reads_its_own_stored_rows(spark):
    df = spark.range(100).selectExpr("CAST(id AS DOUBLE) AS temperature")
    bounded = models.bounded_training(df, 10)
    assert bounded.inputFiles() and bounded.collect() == bounded.collect()


def test_save_and_reload(vectors, table, tmp_path):
    path = str(tmp_path / "gbt")
    model = models.boosted_trees(maxIter=2).fit(vectors)
    save_model(model, path, overwrite=False)
    with pytest.raises(Exception):
        save_model(model, path, overwrite=False)
    save_model(model, path)
    again = GBTRegressionModel.load(path).transform(vectors).select("prediction")
    assert again.collect() == model.transform(vectors).select("prediction").collect()
    pipeline = feature_pipeline("abc").fit(table)
    save_model(pipeline, str(tmp_path / "p"))
    loaded = PipelineModel.load(str(tmp_path / "p")).transform(table)
    assert loaded.select(VECTOR).collect() == pipeline.transform(table).select(VECTOR).collect()


def test_scores_equal_the_evaluator(spark, vectors):
    scored = models.fit_predict(models.linear(), vectors, vectors).withColumn("zero", F.lit(0.0))
    rows = {r.model: r for r in scoring.score(scored, {"line": "prediction", "zero": "zero"}).collect()}
    for model, column in (("line", "prediction"), ("zero", "zero")):
        for metric in scoring.METRICS:
            evaluator = RegressionEvaluator(labelCol="temperature", predictionCol=column, metricName=metric)
            assert rows[model][metric] == pytest.approx(evaluator.evaluate(scored))


def test_constant_label_scores_zero(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 4.0)], "temperature double, prediction double")
    assert scoring.score(df, {"m": "prediction"}).first().r2 == 0.0


def test_best_and_record(spark):
    scores = spark.createDataFrame(
        [(0, "x", 2.0, 0.1, 1.0), (1, "y", 1.5, 0.2, 1.0), (2, "z", 1.5, 0.9, 0.1)],
        "position int, model string, rmse double, r2 double, mae double",
    )
    assert scoring.best_model(scores).first().model == "y"
    record = scoring.metrics_record(scores.repartition(3), "now").first().asDict(recursive=True)
    assert record["timestamp"] == "now" and record["best_model"] == "y"
    assert [m["model"] for m in record["models"]] == ["x", "y", "z"]
    assert record["models"][1] == {"model": "y", "rmse": 1.5, "r2": 0.2, "mae": 1.0}


def test_grids():
    assert len(tuning.boosted_grid(models.boosted_base())) == 24
    assert len(tuning.forest_grid(models.forest_base())) == 48
    first = tuning.boosted_grid(models.boosted_base())[0]
    assert tuning.described(first) == {"maxBins": "32", "maxDepth": "3", "maxIter": "20", "stepSize": "0.05"}


def test_rank():
    nan = float("nan")
    found = [Candidate({}, m) for m in (2.0, nan, 1.0, 3.0)]
    assert [c.metric for c in tuning.rank(found, False)][:3] == [1.0, 2.0, 3.0]
    assert [c.metric for c in tuning.rank(found, True)][:3] == [3.0, 2.0, 1.0]
    assert tuning.rank(found, True)[3].metric != tuning.rank(found, True)[3].metric


@pytest.mark.parametrize("reset", [False, True])
def test_staged_search(spark, vectors, reset):
    estimator = models.boosted_base(maxIter=2, subsamplingRate=0.7)
    grid = tuning.build_grid(estimator, {"maxDepth": [1, 3], "stepSize": [0.1, 0.3]})
    found = tuning.staged_search(
        estimator, grid, vectors, fractions=(0.4, 0.8), top_n=2, parallelism=2, reset_base=reset
    )
    assert [len(p) for p in found.phases] == [4, 2]
    assert {str(tuning.described(c.params)) for c in found.phases[1]} == {
        str(tuning.described(c.params)) for c in found.phases[0][:2]
    }
    assert found.best == found.phases[1][0] == min(found.phases[1], key=lambda c: c.metric)
    chosen = {p.name: v for p, v in found.best.params.items()}
    assert found.model.getMaxDepth() == chosen["maxDepth"] and found.model.getStepSize() == chosen["stepSize"]
    assert found.model.getSubsamplingRate() == (1.0 if reset else 0.7)
    report = found.report(spark).collect()
    assert [(r.phase, r["rank"]) for r in report] == [(1, 1), (1, 2), (1, 3), (1, 4), (2, 1), (2, 2)]
    assert not estimator.hasDefault("maxDepth") or estimator.getMaxDepth() == 5
