"""Regression scores: every metric of every model from one aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.functions.packed import literal, name
from obsflow.plans.features import LABEL

METRICS = ("rmse", "r2", "mae")


def error_metrics(label: str, prediction: str) -> dict[str, str]:
    """Aggregates for RMSE, R² (0 for a constant label) and mean absolute error."""
    error = f"({name(label)} - {name(prediction)})"
    total = f"(var_pop({name(label)}) * count({name(label)}))"
    return {
        "rmse": f"sqrt(avg({error} * {error}))",
        "r2": f"CASE WHEN {total} = 0 THEN 0D ELSE 1 - sum({error} * {error}) / {total} END",
        "mae": f"avg(abs({error}))",
    }


def score(predictions: DataFrame, models: Mapping[str, str], label: str = LABEL) -> DataFrame:
    """One row per model: position, model, rmse, r2, mae.

    ``models`` maps a model name to its prediction column, so models scored on
    the same rows share the pass.
    """
    wide = predictions.selectExpr(
        *[
            f"{metric} AS `{out}:{i}`"
            for i, prediction in enumerate(models.values())
            for out, metric in error_metrics(label, prediction).items()
        ]
    )
    rows = (
        f"struct({i} AS position, {literal(model)} AS model, {', '.join(f'`{m}:{i}` AS {m}' for m in METRICS)})"
        for i, model in enumerate(models)
    )
    return wide.selectExpr(f"inline(array({', '.join(rows)}))")


#: Order in which models win: lowest RMSE first, one without a score last, ties as listed.
WINNING = "struct(rmse IS NULL OR isnan(rmse) AS unknown, rmse, position)"


def best_model(scores: DataFrame) -> DataFrame:
    """The row of lowest RMSE; on a tie, the one listed first."""
    return scores.orderBy(F.expr(WINNING)).limit(1)


def metrics_record(scores: DataFrame, timestamp: str) -> DataFrame:
    """Scores as one record: timestamp, models, best_model."""
    entry = F.struct("model", *METRICS)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", entry.alias("entry")))), lambda r: r["entry"])
    # One element per model, so these lists are as short as `scores`.
    return scores.agg(
        F.lit(timestamp).alias("timestamp"),
        listed.alias("models"),
        F.min_by("model", F.expr(WINNING)).alias("best_model"),
    )
