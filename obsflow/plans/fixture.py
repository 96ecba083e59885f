"""Observation rows derived from a ``lineitem`` table.

There is no public observation sample small enough to ship, so queries, tests
and the bench read one projected from ``lineitem`` with integer arithmetic
only. The projection is narrow, grows with the table, and has a SQL twin
(:data:`OBS_SQL`) that gives the same rows on another engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from obsflow.functions.packed import name
from obsflow.sources.schema import OBSERVATION_SCHEMA


def _digits(value: str, width: int) -> str:
    return f"lpad(string({value}), {width}, '0')"


def _pick(flags: str, position: str) -> str:
    """One flag character out of ``flags``; ``position`` counts from 0."""
    return f"substring('{flags}', int(({position}) % {len(flags)}) + 1, 1)"


def _signed(value: str) -> str:
    return f"if({value} < 0, '-', '+'), {_digits(f'abs({value})', 4)}"


def _coded(specials: dict[int, str], otherwise: str) -> str:
    """The text for the first divisor of ``k``, else the packed field."""
    cases = " ".join(f"WHEN k % {divisor} = 0 THEN {text}" for divisor, text in specials.items())
    return f"CASE {cases} ELSE concat({otherwise}) END"


def laid_out(df: DataFrame) -> DataFrame:
    """The same rows and columns, with all that follows in a generated method of its own.

    The JVM compiles methods of up to 8,000 bytes and interprets longer ones for every row, several times
    slower; deriving, cleaning and scaling in one method are longer than that.
    """
    return df.selectExpr(f"inline(array(struct({', '.join(map(name, df.columns))})))")


def observations_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Project ``lineitem`` to raw observation rows (plus the row key ``k``)."""
    wind = f"'160,1,N,', {_digits('k * 11 % 300', 4)}, ',', {_pick('1551152', 'k * 3')}"
    ceiling = f"{_digits('k * 13 % 22001', 5)}, ',', {_pick('1551152', 'k * 5')}, ',M,N'"
    visibility = f"{_digits('k * 17 % 16001', 6)}, ',', {_pick('1155115', 'k')}, ',N,1'"
    temperature = f"{_signed('t')}, ',', {_pick('1551152', 'k * 2')}"
    dew = f"{_signed('(t - k % 150)')}, ',', {_pick('5115512', 'k * 4')}"
    pressure = f"{_digits('9600 + k * 19 % 900', 5)}, ',', {_pick('1151512', 'k * 6')}"
    keyed = lineitem.selectExpr("l_suppkey", "l_shipdate", "l_orderkey * 7 + l_partkey * 3 + l_linenumber AS k")
    columns = [
        "k",
        f"concat('S', {_digits('l_suppkey', 5)}) AS STATION",
        f"concat(substring(string(l_shipdate), 1, 10), 'T', {_digits('k % 24', 2)}, ':00:00') AS DATE",
        "double(l_suppkey * 37 % 181 - 90) AS LATITUDE",
        "double(l_suppkey * 53 % 361 - 180) AS LONGITUDE",
        "CASE WHEN l_suppkey % 13 = 0 THEN -999.9D WHEN l_suppkey % 29 = 0 THEN NULL"
        " ELSE double(l_suppkey * 10) END AS ELEVATION",
        f"{_coded({37: "'160,1'", 41: "'999,9,9,9999,9'"}, wind)} AS WND",
        f"{_coded({43: "'99999,9,9,N'"}, ceiling)} AS CIG",
        f"{_coded({47: "'999999,9,9,9'"}, visibility)} AS VIS",
        f"{_coded({23: "'+9999,9'", 29: "'TMP'", 31: 'NULL', 53: "'+1O2,1'"}, temperature)} AS TMP",
        f"{_coded({19: "'+9999,9'"}, dew)} AS DEW",
        f"{_coded({17: "'99999,9'"}, pressure)} AS SLP",
    ]
    # One array of one row, laid out again: later filters and projections then read the texts as columns.
    # Without it, each of their dozen uses of a text would compute it anew, in code too long to compile.
    texts = keyed.selectExpr("*", "k % 1301 - 600 AS t").selectExpr(f"inline(array(struct({', '.join(columns)})))")
    return laid_out(texts)


def as_file_rows(observations: DataFrame) -> DataFrame:
    """Give fixture rows the full 39-column file layout (absent columns null)."""
    have = set(observations.columns)
    return observations.selectExpr(
        *[
            f.name if f.name in have else f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}"
            for f in OBSERVATION_SCHEMA
        ]
    )


def _sql_signed(value: str) -> str:
    return (
        f"CASE WHEN {value} < 0 THEN '-' ELSE '+' END "
        f"|| lpad(CAST(abs({value}) AS VARCHAR), 4, '0')"
    )


def _sql_pick(flags: str, position: str) -> str:
    return f"substr('{flags}', CAST(({position}) % 7 + 1 AS INT), 1)"


#: The same rows as :func:`observations_from_lineitem`, as standard SQL text.
OBS_SQL = f"""
SELECT k,
  'S' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS "STATION",
  substr(CAST(l_shipdate AS VARCHAR), 1, 10) || 'T' || lpad(CAST(k % 24 AS VARCHAR), 2, '0') || ':00:00' AS "DATE",
  CAST((l_suppkey * 37) % 181 - 90 AS DOUBLE) AS "LATITUDE",
  CAST((l_suppkey * 53) % 361 - 180 AS DOUBLE) AS "LONGITUDE",
  CASE WHEN l_suppkey % 13 = 0 THEN CAST(-999.9 AS DOUBLE)
       WHEN l_suppkey % 29 = 0 THEN NULL
       ELSE CAST(l_suppkey * 10 AS DOUBLE) END AS "ELEVATION",
  CASE WHEN k % 37 = 0 THEN '160,1' WHEN k % 41 = 0 THEN '999,9,9,9999,9'
       ELSE '160,1,N,' || lpad(CAST((k * 11) % 300 AS VARCHAR), 4, '0') || ',' || {_sql_pick("1551152", "k * 3")} END AS "WND",
  CASE WHEN k % 43 = 0 THEN '99999,9,9,N'
       ELSE lpad(CAST((k * 13) % 22001 AS VARCHAR), 5, '0') || ',' || {_sql_pick("1551152", "k * 5")} || ',M,N' END AS "CIG",
  CASE WHEN k % 47 = 0 THEN '999999,9,9,9'
       ELSE lpad(CAST((k * 17) % 16001 AS VARCHAR), 6, '0') || ',' || {_sql_pick("1155115", "k")} || ',N,1' END AS "VIS",
  CASE WHEN k % 23 = 0 THEN '+9999,9' WHEN k % 29 = 0 THEN 'TMP' WHEN k % 31 = 0 THEN NULL
       WHEN k % 53 = 0 THEN '+1O2,1'
       ELSE {_sql_signed("t")} || ',' || {_sql_pick("1551152", "k * 2")} END AS "TMP",
  CASE WHEN k % 19 = 0 THEN '+9999,9'
       ELSE {_sql_signed("(t - k % 150)")} || ',' || {_sql_pick("5115512", "k * 4")} END AS "DEW",
  CASE WHEN k % 17 = 0 THEN '99999,9'
       ELSE lpad(CAST(9600 + (k * 19) % 900 AS VARCHAR), 5, '0') || ',' || {_sql_pick("1151512", "k * 6")} END AS "SLP"
FROM (SELECT *, k % 1301 - 600 AS t
      FROM (SELECT *, l_orderkey * 7 + l_partkey * 3 + l_linenumber AS k FROM lineitem))
"""
