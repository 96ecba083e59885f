import math

import pytest
from conftest import plan_of

from obsflow.plans.features import BASELINE, COMPACT, PRODUCTION, load_features, model_table, prepare
from obsflow.sources.schema import CARRIED_COLUMNS, MODEL_INPUT_COLUMNS, OBSERVATION_SCHEMA


def test_production_row(raw_rows):
    row = model_table(raw_rows({})).first()
    hour, day = 2 * math.pi * 6 / 24, 2 * math.pi * 60 / 365
    phi, lam = math.radians(40.0), math.radians(-75.0)
    expected = {
        "temperature": -5.0, "geo_x": math.cos(phi) * math.cos(lam), "geo_y": math.cos(phi) * math.sin(lam),
        "geo_z": math.sin(phi), "elevation": 3.0, "dew_clean": 12.2, "slp_clean": 1003.8, "wind_speed": 5.7,
        "cloud_ceiling": 1524.0, "visibility": 16000.0, "hour_sin": math.sin(hour), "hour_cos": math.cos(hour),
        "day_of_year_sin": math.sin(day), "day_of_year_cos": math.cos(day),
    }
    assert row.asDict() == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize("date, day", [("2024-02-29T00:00:00", 60), ("2024-12-31T23:00:00", 366)])
def test_leap_year_days(raw_rows, date, day):
    rows = raw_rows({"DATE": date})
    assert model_table(rows, BASELINE).first().day_cos == pytest.approx(math.cos(2 * math.pi * day / 366))
    assert model_table(rows, PRODUCTION).first().day_of_year_sin == pytest.approx(
        math.sin(2 * math.pi * day / 365), abs=1e-9
    )


def test_full_output_columns(raw_rows):
    out = prepare(raw_rows({}))
    assert {"STATION", "TMP", "tmp_parts", "tmp_value", "tmp_flag", "timestamp", *CARRIED_COLUMNS} <= set(out.columns)
    assert set(PRODUCTION.columns) <= set(out.columns)
    gone = {"LATITUDE", "LONGITUDE", "ELEVATION", "DEW", "SLP", "WND", "CIG", "VIS"}
    assert not gone & set(out.columns)
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    row = out.first()
    assert (row.tmp_parts, row.tmp_value, row.tmp_flag) == (["-0050", "5"], "-0050", "5")


def test_bad_numbers(raw_rows):
    rows = raw_rows({"TMP": "+1O2,1"}, {"DEW": "+1O2,1"}, {"TMP": "+0700,1"}, {"ELEVATION": -999.9}, {"ELEVATION": None})
    # A bad label goes at once; a bad feature stays as null until vectors are assembled.
    kept = model_table(rows).collect()
    assert [r.dew_clean for r in kept] == [None]
    # The other recipes have no label range.
    assert sorted((r.temperature is None, r.temperature or 0) for r in model_table(rows, COMPACT).collect()) == [
        (False, -5.0), (False, 70.0), (True, 0),
    ]


def test_bad_date_gives_null_times(raw_rows):
    row = model_table(raw_rows({"DATE": "yesterday"})).first()
    assert row.hour_sin is None and row.day_of_year_cos is None and row.temperature == -5.0


def test_identities(raw_rows):
    rows = raw_rows(*[{"LATITUDE": a, "LONGITUDE": o, "DATE": f"2023-0{m}-11T0{m}:00:00"}
                      for a, o, m in ((-90.0, 0.0, 1), (0.0, 180.0, 5), (33.3, -179.9, 9))])
    for r in model_table(rows).collect():
        assert r.geo_x**2 + r.geo_y**2 + r.geo_z**2 == pytest.approx(1)
        assert r.hour_sin**2 + r.hour_cos**2 == pytest.approx(1)
        assert r.day_of_year_sin**2 + r.day_of_year_cos**2 == pytest.approx(1)


def test_one_scan_filter_and_projection(spark, raw_rows, tmp_path):
    path = str(tmp_path / "files")
    raw_rows({}, {"TMP": "TMP"}).write.csv(path, header=True)
    table = load_features(spark, path).select(*PRODUCTION.columns)
    assert table.count() == 1
    plan = plan_of(table)
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("* Filter") == 1 and plan.count("* Project") == 1
    assert "StringContains(TMP" in plan and "StringContains(VIS" in plan
    read = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {c.split(":")[0] for c in read.split(",")} == set(MODEL_INPUT_COLUMNS)


def test_streamed_files_give_the_same_rows(spark, raw_rows, tmp_path):
    path = str(tmp_path / "files")
    raw_rows({}, {"TMP": "TMP"}, {"DEW": "+0001,5"}).write.csv(path, header=True)
    stream = spark.readStream.option("header", True).schema(OBSERVATION_SCHEMA).csv(path)
    sink = model_table(stream).writeStream.format("memory").queryName("streamed").trigger(availableNow=True).start()
    sink.awaitTermination()
    batch = model_table(raw_rows({}, {"DEW": "+0001,5"}))
    assert sorted(map(tuple, spark.table("streamed").collect())) == sorted(map(tuple, batch.collect()))
