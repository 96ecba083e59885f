"""Feature vectors: assemble, standardise, unpack."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

RAW_VECTOR = "raw_features"
VECTOR = "features"


def assembler(columns: Sequence[str], output: str = RAW_VECTOR, invalid: str = "skip") -> VectorAssembler:
    """Columns to one vector; ``invalid`` says what a null or NaN does to its row."""
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def feature_pipeline(
    columns: Sequence[str], raw: str = RAW_VECTOR, scaled: str = VECTOR, invalid: str = "skip"
) -> Pipeline:
    """Assemble, then bring every component to mean 0 and sample deviation 1.

    Fit it on the training part only: one aggregate pass.
    """
    scaler = StandardScaler(inputCol=raw, outputCol=scaled, withMean=True, withStd=True)
    return Pipeline(stages=[assembler(columns, raw, invalid), scaler])


def unpack(df: DataFrame, vector: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Vector components as plain columns."""
    values = df.withColumn("__values", vector_to_array(vector))
    return values.selectExpr(*keep, *[f"__values[{i}] AS {name}" for i, name in enumerate(names)])
