import contextlib
import io

import pytest

from obsflow.sources.schema import OBSERVATION_SCHEMA
from obsflow.sources.session import create_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = create_session(
        "obsflow-tests",
        "local[*]",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_driver_memory="8g",
        spark_sql_shuffle_partitions="8",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


GOOD = {
    "STATION": "72503014732",
    "DATE": "2024-02-29T06:00:00",
    "LATITUDE": 40.0,
    "LONGITUDE": -75.0,
    "ELEVATION": 3.0,
    "WND": "160,1,N,0057,5",
    "CIG": "01524,5,M,N",
    "VIS": "016000,1,N,1",
    "TMP": "-0050,5",
    "DEW": "+0122,1",
    "SLP": "10038,1",
}


@pytest.fixture
def raw_rows(spark):
    """Frame of raw rows: each a good row with some fields replaced."""

    def make(*changes):
        names = OBSERVATION_SCHEMA.fieldNames()
        rows = [{**GOOD, **change} for change in changes]
        return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], OBSERVATION_SCHEMA)

    return make


@pytest.fixture(scope="session")
def own_tables(spark, tmp_path_factory):
    """Folder with a lineitem table of its own."""
    path = str(tmp_path_factory.mktemp("tables"))
    rows = spark.range(600).selectExpr(
        "id AS l_orderkey", "id * 13 % 97 AS l_partkey", "id % 89 AS l_suppkey", "CAST(id % 7 AS INT) AS l_linenumber",
        "CAST(DATE '1996-01-02' + CAST(id % 900 AS INT) AS TIMESTAMP_NTZ) AS l_shipdate",
    )
    rows.write.parquet(f"{path}/lineitem.parquet")
    return path


def plan_of(df):
    """Text of ``explain("formatted")``."""
    with contextlib.redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()
