import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from obsflow.functions import packed
from obsflow.operators import cleaning
from obsflow.operators.cleaning import CEILING, DEW_POINT, PRESSURE, TEMPERATURE, VISIBILITY, WIND

TEXTS = st.lists(st.text(alphabet="01+-9, é", max_size=12), min_size=1, max_size=40)


def column_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "f string")


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_part_equals_split(spark, texts):
    parts = [f"{packed.part('f', i)} AS p{i}" for i in range(5)]
    for row in column_of(spark, texts).selectExpr("f", *parts).collect():
        pieces = row["f"].split(",")
        assert [row[f"p{i}"] for i in range(5)] == [pieces[i] if i < len(pieces) else None for i in range(5)]


def test_part_of_null_is_null(spark):
    row = column_of(spark, [None]).selectExpr(packed.part("f", 0), packed.part("f", 3)).first()
    assert list(row) == [None, None]


@pytest.mark.parametrize(
    "text, number",
    [("+0122", 12.2), ("-0050", -5.0), ("0000", 0.0), ("+1O2", None), ("", None), ("+" + "0" * 150 + "7", 0.7)],
)
def test_signed_number(spark, text, number):
    value = packed.scaled_number(packed.without_plus("f"), 10.0)
    assert column_of(spark, [text]).selectExpr(value).first()[0] == number


@pytest.mark.parametrize(
    "spec, raw, clean",
    [
        (WIND, "160,1,N,0057,1", 5.7),
        (CEILING, "01524,5,M,N", 1524.0),
        (VISIBILITY, "016000,1,N,1", 16000.0),
        (DEW_POINT, "+0122,1", 12.2),
        (PRESSURE, "10038,1", 1003.8),
        (TEMPERATURE, "-0050,5", -5.0),
    ],
)
def test_stated_values(spark, raw_rows, spec, raw, clean):
    rows = cleaning.clean_field(raw_rows({spec.column: raw}), spec)
    assert [r[spec.output] for r in rows.collect()] == [clean]
    assert spec.column not in rows.columns


@pytest.mark.parametrize("spec", cleaning.ALL_FIELDS, ids=lambda s: s.column)
def test_rows_a_field_drops(raw_rows, spec):
    def text(value, flag):
        parts = ["160", "1", "N", "7", "7"]
        parts[spec.value_part], parts[spec.flag_part] = value, flag
        return ",".join(parts)

    bad = [None, "TMP", "", text(spec.missing, "1"), text("0100", "2"), text("0100", "9"), text("0100", "")]
    good = [text("0100", "1"), text("-9999", "5")]
    rows = cleaning.clean_field(raw_rows(*[{spec.column: t} for t in bad + good]), spec, keep_raw=True)
    assert sorted(r[spec.column] for r in rows.collect()) == sorted(good)


def test_short_wind_and_empty_part(raw_rows):
    rows = raw_rows({"WND": "160,1"}, {"WND": "160,1,N"}, {"WND": "160,1,N,,1"}, {"WND": "160,1,N,abc,1"})
    # Empty or non-numeric text passes the text tests and only then becomes null.
    assert [r.wind_speed for r in cleaning.clean_field(rows, WIND).collect()] == [None, None]


def test_missing_code_is_text(raw_rows):
    rows = raw_rows({"TMP": "9999,1"}, {"TMP": "+09999,1"}, {"TMP": "+9999,1"})
    assert sorted(r.temperature for r in cleaning.clean_field(rows, TEMPERATURE).collect()) == [999.9, 999.9]


def test_generic_column(spark):
    df = spark.createDataFrame([("+0010,3", 1), ("+0020,1", 2), ("NA,3", 3)], "ABC string, id int")
    out = cleaning.clean_column(df, "ABC", "NA", ["3"], 10.0, signed=True)
    assert out.columns == ["id", "abc_clean"]
    assert [tuple(r) for r in out.collect()] == [(1, 1.0)]


def test_field_order_does_not_matter(raw_rows):
    rows = raw_rows({}, {"DEW": "+9999,9"}, {"SLP": "99999,1"}, {"TMP": "+0100,3"}, {"VIS": None})
    forward, backward = rows, rows
    for spec in cleaning.ALL_FIELDS:
        forward = cleaning.clean_field(forward, spec)
    for spec in reversed(cleaning.ALL_FIELDS):
        backward = cleaning.clean_field(backward, spec)
    names = [s.output for s in cleaning.ALL_FIELDS]
    assert forward.select(names).collect() == backward.select(names).collect()
    assert forward.count() == rows.where(cleaning.keep_all(cleaning.ALL_FIELDS)).count() == 1


def test_bounds_and_elevation(spark):
    df = spark.createDataFrame(
        [(v,) for v in (-100.1, -100.0, 0.0, 60.0, 60.1, None, float("nan"), -999.9)], "v double"
    )
    assert [r.v for r in df.where(cleaning.within_bounds("v")).collect()] == [-100.0, 0.0, 60.0]
    kept = [r.v for r in df.where(cleaning.has_elevation("v")).collect()]
    assert None not in kept and -999.9 not in kept and len(kept) == 6


def test_quoting(spark):
    df = spark.createDataFrame([("it's,1",), ("x\\,1",), ("ok,1",)], "`a b` string")
    for missing in ("it's", "x\\"):
        spec = cleaning.FieldSpec("a b", "out", missing=missing)
        assert f"{missing},1" not in [r["a b"] for r in cleaning.clean_field(df, spec, keep_raw=True).collect()]
