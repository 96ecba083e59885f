"""How far a run of the job has come, so that a stopped one is told from a whole one and can go on."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsflow.sources.records import get_record, put_record, read_records

PART_SCHEMA = "part string, settings string"
MANIFEST_SCHEMA = "parts array<string>, settings string, metrics string"


class Progress:
    """Finished parts of one run directory.

    A part is recorded after all its files are written, and the manifest after all parts: a run
    without one is not complete, whatever else its directory holds.
    """

    def __init__(self, spark: SparkSession, run: str, settings: str) -> None:
        self.spark, self.run = spark, run
        self.settings = hashlib.sha256(settings.encode()).hexdigest()
        self.parts: list[str] = []

    @property
    def searches(self) -> str:
        """Folder of the searches' ledgers."""
        return f"{self.run}/progress/searches"

    def done(self, part: str) -> bool:
        """Whether this part was finished before; an error if that was under other settings."""
        found = get_record(self.spark, f"{self.run}/progress/parts/{part}", PART_SCHEMA)
        if found is None:
            return False
        self._same(found.settings)
        self.parts.append(part)
        return True

    def finish(self, part: str) -> None:
        """Record that all files of a part are there."""
        put_record(self.spark, f"{self.run}/progress/parts/{part}", {"part": part, "settings": self.settings}, PART_SCHEMA)
        self.parts.append(part)

    def complete(self, metrics: dict) -> None:
        """Write the manifest, the last file of a run."""
        values = {"parts": self.parts, "settings": self.settings, "metrics": json.dumps(metrics)}
        put_record(self.spark, f"{self.run}/manifest", values, MANIFEST_SCHEMA)

    def outcome(self) -> dict | None:
        """Metrics of a complete run, None for any other."""
        found = get_record(self.spark, f"{self.run}/manifest", MANIFEST_SCHEMA)
        if found is None:
            return None
        self._same(found.settings)
        return json.loads(found.metrics)

    def _same(self, settings: str) -> None:
        if settings != self.settings:
            raise ValueError(f"{self.run} was begun with other settings")


def complete_runs(spark: SparkSession, output_path: str) -> DataFrame:
    """``run`` (directory name), ``parts`` and ``metrics`` (JSON text) of every complete run below a path."""
    found = read_records(spark, f"{output_path.rstrip('/')}/*/manifest", MANIFEST_SCHEMA)
    if not found.inputFiles():
        return found.selectExpr("'' AS run", "parts", "metrics")
    return found.select(F.element_at(F.split("_metadata.file_path", "/"), -3).alias("run"), "parts", "metrics")
