"""Declared schema of a coded hourly station observation file.

The column order is positional: a delimited file is read against it by place,
see :mod:`obsflow.sources.observations`.
"""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType

# The 39 file columns, in file order.
COLUMNS = (
    "STATION", "DATE", "SOURCE", "LATITUDE", "LONGITUDE", "ELEVATION", "NAME", "REPORT_TYPE",
    "CALL_SIGN", "QUALITY_CONTROL", "WND", "CIG", "VIS", "TMP", "DEW", "SLP",
    "AA1", "AA2", "AA3", "AJ1", "AY1", "AY2", "GA1", "GA2", "GA3", "GE1", "GF1", "IA1",
    "KA1", "KA2", "MA1", "MD1", "MW1", "OC1", "OD1", "SA1", "UA1", "REM", "EQD",
)

#: Numbers; every other column is text.
POSITION_COLUMNS = ("LATITUDE", "LONGITUDE", "ELEVATION")

#: Text fields that pack a value with its quality flag.
PACKED_COLUMNS = ("WND", "CIG", "VIS", "TMP", "DEW", "SLP")

#: The leading 16 columns, the ones an analyst looks at first, and the rest.
CORE_COLUMNS, CARRIED_COLUMNS = COLUMNS[:16], COLUMNS[16:]

#: Raw columns the feature table is computed from.
MODEL_INPUT_COLUMNS = ("DATE",) + POSITION_COLUMNS + PACKED_COLUMNS

OBSERVATION_SCHEMA = StructType(
    [
        StructField(name, DoubleType() if name in POSITION_COLUMNS else StringType(), True)
        for name in COLUMNS
    ]
)
