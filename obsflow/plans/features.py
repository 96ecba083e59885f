"""From raw observation rows to the feature table.

Three published recipes share one shape and differ in a few settings, so each
is a :class:`FeaturePlan`. Whatever the recipe, the result is one filter over
raw columns and one projection: no shuffle, no action, no Python on executors,
and unused output columns cost nothing once a later ``select`` leaves them out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from obsflow.functions import packed
from obsflow.functions.encodings import as_timestamp, cyclic, unit_sphere
from obsflow.operators.cleaning import (
    CEILING,
    DEW_POINT,
    LABEL_BOUNDS,
    PRESSURE,
    TEMPERATURE,
    VISIBILITY,
    WIND,
    FieldSpec,
    has_elevation,
    within_bounds,
)
from obsflow.sources.observations import read_observations

LABEL = TEMPERATURE.output


@dataclass(frozen=True)
class FeaturePlan:
    """Settings of one feature recipe."""

    fields: tuple[FieldSpec, ...]
    features: tuple[str, ...]
    day_name: str
    day_period: int
    pi: float = math.pi
    sphere: bool = True
    label_bounds: tuple[float, float] | None = None
    drop_unknown_elevation: bool = False

    @property
    def columns(self) -> tuple[str, ...]:
        """Label first, then the features in vector order."""
        return (LABEL, *self.features)


# Feature order, day period and circle constant of each recipe.
PRODUCTION = FeaturePlan(
    fields=(DEW_POINT, PRESSURE, WIND, CEILING, VISIBILITY),
    features=(
        "geo_x", "geo_y", "geo_z", "elevation", "dew_clean", "slp_clean", "wind_speed",
        "cloud_ceiling", "visibility", "hour_sin", "hour_cos", "day_of_year_sin", "day_of_year_cos",
    ),
    day_name="day_of_year",
    day_period=365,
    pi=3.14159265359,
    label_bounds=LABEL_BOUNDS,
    drop_unknown_elevation=True,
)
BASELINE = FeaturePlan(
    fields=(
        DEW_POINT,
        PRESSURE,
        replace(WIND, output="wind_speed_clean"),
        replace(CEILING, output="ceiling_height_clean"),
        replace(VISIBILITY, output="visibility_dist_clean"),
    ),
    features=(
        "elevation", "geo_x", "geo_y", "geo_z", "dew_clean", "slp_clean", "wind_speed_clean",
        "ceiling_height_clean", "visibility_dist_clean", "hour_sin", "hour_cos", "day_sin", "day_cos",
    ),
    day_name="day",
    day_period=366,
)
COMPACT = FeaturePlan(
    fields=(DEW_POINT, PRESSURE),
    features=(
        "latitude", "longitude", "elevation", "dew_clean", "slp_clean",
        "hour_sin", "hour_cos", "day_sin", "day_cos",
    ),
    day_name="day",
    day_period=366,
    sphere=False,
)


def row_filters(plan: FeaturePlan = PRODUCTION) -> list[tuple[str, str]]:
    """The recipe's row tests in order, named after the column they look at."""
    tests = [(spec.column, spec.keep) for spec in (TEMPERATURE, *plan.fields)]
    if plan.label_bounds is not None:
        tests.append((LABEL, within_bounds(TEMPERATURE.number, plan.label_bounds)))
    if plan.drop_unknown_elevation:
        tests.append(("elevation", has_elevation(_as_double("ELEVATION"))))
    return tests


def _as_double(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def prepare(raw: DataFrame, plan: FeaturePlan = PRODUCTION) -> DataFrame:
    """Clean rows with every column the recipe carries.

    Packed fields other than the label's are replaced by their numbers, raw
    coordinates by position features; everything else passes through.
    """
    latitude, longitude, elevation = map(_as_double, ("LATITUDE", "LONGITUDE", "ELEVATION"))
    replaced = {"latitude", "longitude", *(spec.column.lower() for spec in plan.fields)}
    timestamp = as_timestamp("DATE")
    position = (
        unit_sphere(latitude, longitude)
        if plan.sphere
        else [f"{latitude} AS latitude", f"{longitude} AS longitude"]
    )
    produced = [
        f"{packed.parts(TEMPERATURE.raw)} AS tmp_parts",
        f"{TEMPERATURE.value} AS tmp_value",
        f"{TEMPERATURE.flag} AS tmp_flag",
        TEMPERATURE.clean,
        f"{timestamp} AS timestamp",
        *cyclic(f"hour({timestamp})", 24, "hour", plan.pi),
        *cyclic(f"dayofyear({timestamp})", plan.day_period, plan.day_name, plan.pi),
        *position,
        *[spec.clean for spec in plan.fields],
    ]
    # What is produced takes the place of a column of that name.
    replaced |= {expression.rpartition(" AS ")[2].strip("`").lower() for expression in produced}
    carried = [
        f"{elevation} AS elevation" if c.lower() == "elevation" else packed.name(c)
        for c in raw.columns
        if c.lower() not in replaced
    ]
    return raw.where(" AND ".join(test for _, test in row_filters(plan))).selectExpr(*carried, *produced)


def model_table(raw: DataFrame, plan: FeaturePlan = PRODUCTION, keep: tuple[str, ...] = ()) -> DataFrame:
    """Label and features only, rows of unknown elevation removed.

    ``keep`` names carried columns to leave in front (row keys, for example).
    """
    prepared = prepare(raw, plan)
    if not plan.drop_unknown_elevation:
        prepared = prepared.where(has_elevation("elevation"))
    return prepared.select(*keep, *plan.columns)


def load_features(spark: SparkSession, path: str, plan: FeaturePlan = PRODUCTION) -> DataFrame:
    """Read a directory of observation files and prepare it. Lazy."""
    return prepare(read_observations(spark, path), plan)
