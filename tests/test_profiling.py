import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from obsflow.operators import profiling


@pytest.fixture(scope="module")
def numbers():
    rng = np.random.default_rng(7)
    frame = pd.DataFrame({"a": rng.normal(1000, 1, 3000), "b": rng.exponential(5, 3000)})
    frame["c"] = frame.a * 3 + frame.b
    frame["d"] = np.where(np.arange(3000) % 3 == 0, 7.5, np.round(rng.uniform(0, 20, 3000)))
    frame.loc[::11, "a"] = np.nan
    frame.loc[::7, "d"] = np.nan
    return frame


@pytest.fixture(scope="module")
def table(spark, numbers):
    # NaN in `a` stays NaN; in `d` it becomes null.
    return spark.createDataFrame(numbers).withColumn("d", F.nanvl("d", F.lit(None))).repartition(6).persist()


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_summary(table, numbers):
    got = by(profiling.summary(table, ["b", "d"]), "column")
    for c in ("b", "d"):
        want = numbers[c].describe()
        assert [got[c][m] for m in ("count", "mean", "stddev", "min", "max")] == pytest.approx(
            [want[m] for m in ("count", "mean", "std", "min", "max")]
        )


def test_summary_of_nothing(table):
    row = profiling.summary(table.where("false"), ["b"]).first()
    assert tuple(row) == ("b", 0, None, None, None, None)


def test_summary_equals_describe(table):
    ours = by(profiling.summary(table, ["a", "b", "c", "d"]), "column")
    for row in table.describe().collect():
        for c in "abcd":
            assert float(row[c]) == pytest.approx(ours[c][row["summary"]], nan_ok=True)


def test_text_summary(spark):
    df = spark.createDataFrame([("b", "1"), ("a", None), (None, "x"), ("c", "4")], "s string, n string")
    got = by(profiling.text_summary(df, ["s", "n"]), "column")
    assert tuple(got["s"]) == ("s", 3, None, None, "a", "c")
    assert got["n"].mean == 2.5 and got["n"].max == "x" and got["n"]["count"] == 3


def test_quantiles_are_exact(table, numbers):
    ps = (0.0, 0.05, 0.25, 0.5, 0.75, 1.0)
    got = by(profiling.quantiles(table, ["a", "b", "d"], ps), "column", "probability")
    assert len(got) == 18
    for c in ("a", "b", "d"):
        want = numbers[c].quantile(ps)
        assert [got[c, p].quantile for p in ps] == pytest.approx(list(want), rel=1e-12)


def test_quantiles_of_a_column_that_is_mostly_one_value(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 == 0, F.col("id") * 1.0).otherwise(5.0).alias("v"))
    df = df.unionAll(spark.createDataFrame([(float("inf"),), (float("-inf"),), (None,)], "v double"))
    want = df.toPandas().v.quantile([0.1, 0.5, 0.9])
    got = by(profiling.quantiles(df, ["v"], (0.1, 0.5, 0.9)), "probability")
    assert [got[p].quantile for p in (0.1, 0.5, 0.9)] == pytest.approx(list(want))


def shuffled(spark):
    """Bytes that tasks of this session have written to shuffles."""
    executors = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(executors.apply(i).totalShuffleWrite() for i in range(executors.size()))


@pytest.mark.parametrize("cells", [2, 7, 2048])
def test_quantiles_of_doubles_of_every_size(spark, cells):
    rng = np.random.default_rng(3)
    values = rng.choice([-1.0, 1.0], 4000) * 10.0 ** rng.uniform(-320, 308, 4000)
    values = np.concatenate([values, [5e-324, -5e-324, 0.0, -0.0, 1.7976931348623157e308, 0.1, np.nextafter(0.1, 1)], [2.5] * 900])
    ps = (0.0, 0.01, 1 / 3, 0.5, 0.5001, 0.9, 1.0)
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(5)
    got = by(profiling.quantiles(df, ["v"], ps, cells=cells), "probability")
    order = np.sort(values)
    for p in ps:
        at = p * (len(values) - 1)
        low, high = order[int(np.floor(at))], order[int(np.ceil(at))]
        assert got[p].quantile == (low if low == high else low + (high - low) * (at - np.floor(at)))


def test_quantiles_shuffle_does_not_follow_distinct_values(spark):
    def written(n):
        df = spark.range(0, n, numPartitions=4).selectExpr("cast(id * 7919 % 1000003 as double) / 3 AS v")
        before = shuffled(spark)
        assert profiling.quantiles(df, ["v"], (0.5,), cells=64).count() == 1
        return shuffled(spark) - before

    assert 0 < written(1_000_000) < 1.5 * written(50_000)


def test_quantiles_edges(spark):
    df = spark.range(5).selectExpr("cast(id as int) AS v", "cast(null as double) AS w")
    assert profiling.quantiles(df, []).count() == 0 and profiling.quantiles(df, ["v"], ()).count() == 0
    got = [tuple(r) for r in profiling.quantiles(df, ["v", "v", "w"], (0.5, 0.5)).collect()]
    assert got == [("v", 0.5, 2.0)] * 4 + [("w", 0.5, None)] * 2
    assert profiling.quantiles(df.where("false"), ["v"]).where("quantile IS NULL").count() == 3
    with pytest.raises(ValueError, match="two cells"):
        profiling.quantiles(df, ["v"], cells=1)


def test_quartiles_frame(table, numbers):
    got = by(profiling.summary_with_quartiles(table, ["b"]), "column")["b"]
    want = numbers.b.describe()
    assert [got.q25, got.q50, got.q75, got.max] == pytest.approx([want["25%"], want["50%"], want["75%"], want["max"]])


def test_null_and_nan(table, numbers):
    got = by(profiling.null_nan_counts(table, ["a", "b", "d"]), "column")
    assert {c: r.missing for c, r in got.items()} == numbers[["a", "b", "d"]].isna().sum().to_dict()


def test_correlation_is_pairwise(table, numbers):
    got = by(profiling.correlation(table, list("abcd")), "left", "right")
    want = numbers.corr()
    assert len(got) == 16
    for (a, b), row in got.items():
        assert row.corr == pytest.approx(want.loc[a, b], abs=1e-9)


def test_correlation_of_a_constant_is_null(spark):
    df = spark.range(50).selectExpr("cast(id as double) x", "3.0d y")
    got = by(profiling.correlation(df, ["x", "y"]), "left", "right")
    assert got["x", "y"].corr is None and got["x", "x"].corr == pytest.approx(1)


def test_rows_kept_equals_counting_each_step(table):
    tests = [("d", "d > 5"), ("b", "b < 4 OR b IS NULL"), ("none", "false")]
    got = [tuple(r) for r in profiling.rows_kept(table, tests).orderBy("position").collect()]
    one, two = table.where(tests[0][1]), table.where(tests[0][1]).where(tests[1][1])
    assert got == [("read", 0, 3000), ("d", 1, one.count()), ("b", 2, two.count()), ("none", 3, 0)]


def test_column_info(table):
    got = [tuple(r) for r in profiling.column_info(table.select("b", "d")).orderBy("position").collect()]
    assert got == [("b", 0, "double", 3000), ("d", 1, "double", table.where("d is not null").count())]


def test_names_with_dots_and_empty_columns(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), (None, 4.0)], "`a.b` double, `c d` double")
    got = {(r["column"], r.probability): r.quantile for r in profiling.quantiles(df, ["a.b", "c d"], (0.5,)).collect()}
    assert got == {("a.b", 0.5): None, ("c d", 0.5): 2.0}
    pairs = {(r.left, r.right): r["corr"] for r in profiling.correlation(df, ["a.b", "c d"]).collect()}
    assert pairs[("a.b", "c d")] is None and abs(pairs[("c d", "c d")] - 1) < 1e-12


def test_correlation_is_lazy_and_keeps_offsets(spark):
    df = spark.range(1000, numPartitions=7).selectExpr("id + 1e9 AS x", "if(id % 3 = 0, null, 5e8 - id * id) AS y")
    got = {(r.left, r.right): r["corr"] for r in profiling.correlation(df, ["x", "y"]).collect()}
    want = df.where("y IS NOT NULL").selectExpr("corr(x - 1e9, y - 5e8)").first()[0]
    assert abs(got[("x", "y")] - want) < 1e-9


def test_rows_kept_counts_each_test_once(spark):
    df = spark.range(100).selectExpr("id", "if(id = 7, null, id) AS v")
    got = {r.step: r.rows for r in profiling.rows_kept(df, [("v", "v >= 5"), ("even", "v % 2 = 0")]).collect()}
    assert got == {"read": 100, "v": 94, "even": 47}
