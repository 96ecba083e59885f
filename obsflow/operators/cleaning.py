"""Cleaning of packed fields: one declaration per field, one filter, one projection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from obsflow.functions import packed

# Quality flags that mean "passed".
GOOD_FLAGS = ("1", "5")


@dataclass(frozen=True)
class FieldSpec:
    """How one packed field becomes a number. Properties are SQL expressions.

    ``missing`` is compared with the text of the value part, before scaling.
    """

    column: str
    output: str
    missing: str
    scale: float = 1.0
    value_part: int = 0
    flag_part: int = 1
    good_flags: tuple[str, ...] = GOOD_FLAGS
    signed: bool = False

    @property
    def raw(self) -> str:
        return packed.name(self.column)

    @property
    def value(self) -> str:
        """Text of the value part."""
        return packed.part(self.raw, self.value_part)

    @property
    def flag(self) -> str:
        """Text of the quality flag part."""
        return packed.part(self.raw, self.flag_part)

    @property
    def keep(self) -> str:
        """Row test: packed, reported and trusted. Null (a null field) drops the row.

        The first term is implied by the other two; it is there because the
        file reader can apply it while parsing.
        """
        return " AND ".join(
            (
                packed.has_separator(self.raw),
                packed.is_reported(self.value, self.missing),
                packed.is_trusted(self.flag, self.good_flags),
            )
        )

    @property
    def number(self) -> str:
        """The scaled number, unnamed."""
        text = packed.without_plus(self.value) if self.signed else self.value
        return packed.scaled_number(text, self.scale)

    @property
    def clean(self) -> str:
        """The scaled number under its output name."""
        return f"{self.number} AS {packed.name(self.output)}"


# Missing codes, scales and part positions of the six fields.
TEMPERATURE = FieldSpec("TMP", "temperature", missing="+9999", scale=10.0)
DEW_POINT = FieldSpec("DEW", "dew_clean", missing="+9999", scale=10.0, signed=True)
PRESSURE = FieldSpec("SLP", "slp_clean", missing="99999", scale=10.0)
WIND = FieldSpec("WND", "wind_speed", missing="9999", scale=10.0, value_part=3, flag_part=4)
CEILING = FieldSpec("CIG", "cloud_ceiling", missing="99999")
VISIBILITY = FieldSpec("VIS", "visibility", missing="999999")

ALL_FIELDS = (TEMPERATURE, DEW_POINT, PRESSURE, WIND, CEILING, VISIBILITY)


def keep_all(specs: Iterable[FieldSpec]) -> str:
    """One predicate: every field of the row passes."""
    return " AND ".join(spec.keep for spec in specs)


def clean_field(df: DataFrame, spec: FieldSpec, keep_raw: bool = False) -> DataFrame:
    """Keep the rows whose field passes and add its number.

    The packed column is dropped unless ``keep_raw``; a column that has the
    output's name already is replaced.
    """
    gone = {spec.output.lower()} | (set() if keep_raw else {spec.column.lower()})
    kept = [c for c in df.columns if c.lower() not in gone]
    return df.where(spec.keep).selectExpr(*map(packed.name, kept), spec.clean)


def clean_column(
    df: DataFrame,
    column: str,
    missing: str,
    good_flags: Iterable[str] = GOOD_FLAGS,
    scale: float = 1.0,
    signed: bool = False,
) -> DataFrame:
    """Ad-hoc form of :func:`clean_field` for a ``value,flag`` column.

    The result column is ``<column>_clean`` in lower case.
    """
    spec = FieldSpec(
        column,
        f"{column.lower()}_clean",
        missing=missing,
        scale=scale,
        good_flags=tuple(good_flags),
        signed=signed,
    )
    return clean_field(df, spec)


# Accepted label range in degrees, and the "no elevation" code.
LABEL_BOUNDS = (-100.0, 60.0)
ELEVATION_SENTINEL = -999.9


def within_bounds(label: str, bounds: tuple[float, float] = LABEL_BOUNDS) -> str:
    """The label is present and inside the closed range."""
    low, high = bounds
    return f"{label} BETWEEN {low!r}D AND {high!r}D"


def has_elevation(elevation: str) -> str:
    """The elevation is known: neither null nor the missing code."""
    return f"{elevation} <> {ELEVATION_SENTINEL!r}D"
