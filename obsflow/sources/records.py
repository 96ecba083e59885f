"""Small records in the shared folder: a directory each, with one row that is seen whole or not at all."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.types import StructType


def put_record(spark: SparkSession, path: str, values: Mapping[str, object], schema: StructType | str) -> None:
    """Write one record, replacing what a stopped attempt left there.

    Every record has a directory of its own, so that threads can write records at the same time.
    """
    spark.createDataFrame([tuple(values.values())], schema).coalesce(1).write.mode("overwrite").json(path)


def read_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The records that ``path`` (a directory or a pattern of such) names; none if nothing is there yet."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def get_record(spark: SparkSession, path: str, schema: StructType | str) -> Row | None:
    """The record at ``path``, or None."""
    return read_records(spark, path, schema).first()
