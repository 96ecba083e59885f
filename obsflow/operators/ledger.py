"""Durable record of a search: what every candidate of every phase scored, written as candidates end."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obsflow.sources.records import put_record, read_records

SCHEMA = "key string, phase int, params map<string,string>, metric double"


class SearchLedger:
    """Scores below one path of the shared folder.

    A score counts only for the settings it was found with: they are part of its key, as are the phase
    and the parameters. One small record per candidate and phase, so its size follows the grid alone.
    """

    def __init__(self, spark: SparkSession, path: str, settings: str = "") -> None:
        self.spark, self.path, self.settings = spark, path.rstrip("/"), settings

    def _key(self, phase: int, params: Mapping[str, str]) -> str:
        return hashlib.sha256(json.dumps([self.settings, phase, sorted(params.items())]).encode()).hexdigest()

    def record(self, phase: int, params: Mapping[str, str], metric: float) -> None:
        """Keep one score."""
        key = self._key(phase, params)
        put_record(self.spark, f"{self.path}/{key}", {"key": key, "phase": phase, "params": dict(params), "metric": float(metric)}, SCHEMA)

    def entries(self) -> DataFrame:
        """Every score found so far: key, phase, params, metric."""
        return read_records(self.spark, f"{self.path}/*", SCHEMA)

    def known(self, phase: int, candidates: list[Mapping[str, str]]) -> list[float | None]:
        """The kept score of each candidate, None where there is none."""
        kept = {r.key: r.metric for r in self.entries().where(F.col("phase") == phase).collect()}
        return [kept.get(self._key(phase, params)) for params in candidates]

    def ranking(self, larger_better: bool = False) -> DataFrame:
        """phase, rank (1 is best, a NaN last, ties by parameters), params as text, metric."""
        text = "array_join(transform(array_sort(map_entries(params)), e -> concat(e.key, '=', e.value)), ', ')"
        sign = -1 if larger_better else 1
        # Few rows: candidates of a grid.
        best = Window.partitionBy("phase").orderBy(F.isnan("metric"), F.col("metric") * sign, "params")
        return self.entries().select("phase", F.expr(text).alias("params"), "metric").withColumn("rank", F.row_number().over(best))
