import csv
import random
from types import SimpleNamespace

import pytest
from conftest import GOOD, plan_of

from obsflow.sources.observations import header_places, read_by_header, read_inferred, read_observations
from obsflow.sources.schema import CORE_COLUMNS, OBSERVATION_SCHEMA
from obsflow.sources.session import create_session, scratch_path, shared_folder
from obsflow.sources.staging import write_stage


def write_file(folder, name, columns, rows, bom=False):
    lines = [",".join(columns)] + [",".join(f'"{r.get(c) or ""}"' for c in columns) for r in rows]
    (folder / name).write_text(("\ufeff" if bom else "") + "\n".join(lines) + "\n", encoding="utf-8")


def test_schema():
    types = [f.dataType.typeName() for f in OBSERVATION_SCHEMA]
    assert len(types) == 39 and types.count("double") == 3 and types.count("string") == 36
    assert all(f.nullable for f in OBSERVATION_SCHEMA) and len(CORE_COLUMNS) == 16


def test_strict_reader_checks_used_columns_only(spark, tmp_path):
    write_file(tmp_path, "a.csv", OBSERVATION_SCHEMA.fieldNames(), [GOOD])
    write_file(tmp_path, "b.csv", [*CORE_COLUMNS, "ZZ9"], [{**GOOD, "TMP": "+0010,1", "ZZ9": "x"}])
    rows = read_observations(spark, str(tmp_path)).select("TMP", "LATITUDE")
    assert sorted(tuple(r) for r in rows.collect()) == [("+0010,1", 40.0), ("-0050,5", 40.0)]


def test_strict_reader_refuses_misplaced_columns(spark, tmp_path):
    write_file(tmp_path, "a.csv", CORE_COLUMNS[::-1], [GOOD])
    with pytest.raises(Exception, match="a.csv"):
        read_observations(spark, str(tmp_path)).select("TMP").collect()
    # Read by place without the check, the value comes from another column.
    loose = read_observations(spark, str(tmp_path), strict=False).select("TMP").first().TMP
    assert loose != GOOD["TMP"]


def test_by_header_reads_mixed_layouts(spark, tmp_path):
    write_file(tmp_path, "a.csv", CORE_COLUMNS, [GOOD, {**GOOD, "STATION": "A2"}])
    write_file(tmp_path, "b c%20.csv", CORE_COLUMNS[::-1], [{**GOOD, "STATION": "B"}], bom=True)
    write_file(tmp_path, "c.csv", [c for c in CORE_COLUMNS if c != "SLP"], [{**GOOD, "STATION": "C"}])
    write_file(tmp_path, "d.csv", CORE_COLUMNS, [{**GOOD, "STATION": "D"}])
    rows = read_by_header(spark, str(tmp_path), ("STATION", "TMP", "SLP", "LATITUDE"))
    found = {r.STATION: tuple(r)[1:] for r in rows.collect()}
    full = (GOOD["TMP"], GOOD["SLP"], 40.0)
    assert found == {GOOD["STATION"]: full, "A2": full, "B": full, "C": (GOOD["TMP"], None, 40.0), "D": full}


@pytest.mark.parametrize("broadcast_files", [0, 1000])
def test_by_header_reads_many_layouts_in_one_scan(spark, tmp_path, broadcast_files):
    spark = spark.newSession()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    numbers = random.Random(5)
    wanted = ("STATION", "LATITUDE", "TMP", "SLP", "NAME")
    want = {}
    for i in range(60):
        columns = [c for c in CORE_COLUMNS if c == "STATION" or numbers.random() > 0.1] if i % 3 else list(CORE_COLUMNS)
        if i % 3:
            numbers.shuffle(columns)
        row = {**GOOD, "STATION": f"S{i}", "LATITUDE": i / 4, "NAME": 'x "y", z' if i % 2 else None}
        with open(tmp_path / f"f {i}%.csv", "w", newline="") as out:
            csv.writer(out, escapechar="\\", doublequote=False).writerows([columns, [row.get(c) for c in columns]])
        want[f"S{i}"] = tuple(row[c] if c in columns else None for c in wanted[1:])
    rows = read_by_header(spark, str(tmp_path), wanted, broadcast_files=broadcast_files)
    plan = plan_of(rows)
    # Once in the tree of the plan and once in its details.
    assert plan.count("Scan csv") == 2 and ("BroadcastHashJoin" in plan) == (broadcast_files > 0)
    assert {r.STATION: tuple(r)[1:] for r in rows.collect()} == want


def test_by_header_without_any_wanted_column(spark, tmp_path):
    write_file(tmp_path, "a.csv", CORE_COLUMNS[::-1], [GOOD, GOOD])
    assert [tuple(r) for r in read_by_header(spark, str(tmp_path), ("AA1", "REM")).collect()] == [(None, None)] * 2


def test_by_header_text_in_a_number_is_null(spark, tmp_path):
    write_file(tmp_path, "a.csv", CORE_COLUMNS, [{**GOOD, "LATITUDE": "north"}, GOOD])
    write_file(tmp_path, "b.csv", CORE_COLUMNS[::-1], [{**GOOD, "LATITUDE": "north"}, GOOD])
    rows = read_by_header(spark, str(tmp_path), ("TMP", "LATITUDE"))
    assert sorted((r.LATITUDE for r in rows.collect()), key=str) == [40.0, 40.0, None, None]
    assert rows.schema["LATITUDE"].dataType.typeName() == "double"


def test_header_places_one_row_per_file(spark, tmp_path):
    for i in range(5):
        write_file(tmp_path, f"{i}.csv", CORE_COLUMNS, [GOOD] * 50)
    found = header_places(spark, str(tmp_path), ["TMP", "nope"]).collect()
    assert len(found) == 5 and {tuple(r.places) for r in found} == {(CORE_COLUMNS.index("TMP"), -1)}


def test_by_header_single_layout_reads_the_directory(spark, tmp_path):
    for i in range(3):
        write_file(tmp_path, f"{i}.csv", CORE_COLUMNS, [GOOD])
    rows = read_by_header(spark, str(tmp_path))
    assert rows.count() == 3 and "Union" not in rows._jdf.queryExecution().toString()


def test_inferred_types(spark, tmp_path):
    write_file(tmp_path, "a.csv", ["STATION", "DATE", "LATITUDE", "TMP"], [{**GOOD, "LATITUDE": "40.5"}])
    assert dict(read_inferred(spark, str(tmp_path)).dtypes) == {
        "STATION": "bigint", "DATE": "timestamp", "LATITUDE": "double", "TMP": "string",
    }


def test_session_settings(spark):
    assert create_session().sparkContext is spark.sparkContext
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"


def test_scratch_is_below_the_named_folder(spark):
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))


def test_temporary_folder_only_for_a_local_session():
    def session(master):
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=context)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))
    assert shared_folder(session("local[2]")) == shared_folder(session("local[2]"))



@pytest.mark.parametrize("compact", [False, True])
def test_stage_keeps_rows_and_partitions(spark, tmp_path, compact):
    df = spark.range(1000).selectExpr("id", "case when id % 3 = 0 then 1 else id % 7 end as part")
    staged = write_stage(df, str(tmp_path / "s"), ["part"], compact)
    assert staged.count() == 1000 and staged.where("part = 1").count() == df.where("part = 1").count()
    assert "PartitionFilters: [isnotnull(part" in staged.where("part = 1")._jdf.queryExecution().toString()
