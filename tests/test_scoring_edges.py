"""Scores that are missing, and names that are taken."""

import pytest

from obsflow.operators import cleaning, scoring
from obsflow.plans.job import run_job


def test_a_null_score_never_wins(spark):
    rows = [(0, "broken", None, None, None), (1, "nan", float("nan"), 0.1, 0.1), (2, "good", 1.5, 0.5, 1.0)]
    scores = spark.createDataFrame(rows, "position int, model string, rmse double, r2 double, mae double")
    assert scoring.best_model(scores).first().model == "good"
    assert scoring.metrics_record(scores, "now").first().best_model == "good"


def test_cleaning_twice_replaces(raw_rows):
    once = cleaning.clean_field(raw_rows({}), cleaning.DEW_POINT, keep_raw=True)
    again = cleaning.clean_field(once, cleaning.DEW_POINT)
    assert again.columns.count("dew_clean") == 1 and again.first().dew_clean == 12.2


@pytest.mark.parametrize("ratio", [0.0, 1.0, 1.7])
def test_job_refuses_ratios_without_two_sides(spark, ratio, tmp_path):
    with pytest.raises(ValueError):
        run_job(spark, str(tmp_path), str(tmp_path), train_ratio=ratio)
