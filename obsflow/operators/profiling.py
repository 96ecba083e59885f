"""Whole-table profiles, each as a small long-form frame (one row per column).

A profile is one aggregate over one scan; turning its single wide row into
long form happens after the data has shrunk.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obsflow.functions.packed import literal, name
from obsflow.sources.session import scratch_path
from obsflow.sources.staging import write_stage


def _long(wide: DataFrame, labels: Sequence[str], key: str, fields: Sequence[str]) -> DataFrame:
    """One wide row to one row per label; its columns are ``<field>:<label number>``."""
    structs = (
        f"struct({literal(label)} AS {name(key)}, {', '.join(f'{name(f"{field}:{i}")} AS {name(field)}' for field in fields)})"
        for i, label in enumerate(labels)
    )
    return wide.selectExpr(f"inline(array({', '.join(structs)}))")


def is_missing(df: DataFrame, column: str) -> str:
    """Null, or NaN where the type has one."""
    value = name(column)
    if df.schema[column].dataType.typeName() in ("double", "float"):
        return f"{value} IS NULL OR isnan({value})"
    return f"{value} IS NULL"


def rows_kept(df: DataFrame, tests: Sequence[tuple[str, str]]) -> DataFrame:
    """Rows left before any test and after each one, tests applied in order.

    ``tests`` are names with SQL conditions. All steps are counted in one scan.
    """
    names = ["read", *[step for step, _ in tests]]
    # How many tests a row passes before the first that it fails; null fails.
    failing = " ".join(f"WHEN NOT coalesce({test}, false) THEN {i}" for i, (_, test) in enumerate(tests))
    passed = df.selectExpr(f"CASE {failing} ELSE {len(tests)} END AS passed" if tests else "0 AS passed")
    wide = passed.selectExpr(
        *[f"count_if(passed >= {i}) AS `rows:{i}`" for i in range(len(names))],
        *[f"{i} AS `position:{i}`" for i in range(len(names))],
    )
    return _long(wide, names, "step", ("position", "rows"))


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum, maximum per numeric column.

    The mean is kept as sum over count: with seven buffer fields per column a
    14-column table stays below the field limit of whole-stage code generation.
    """
    measures = {"count": "count", "sum": "sum", "stddev": "stddev_samp", "min": "min", "max": "max"}
    wide = df.selectExpr(*[f"CAST({name(c)} AS DOUBLE) AS `{i}`" for i, c in enumerate(columns)]).selectExpr(
        *[f"{function}(`{i}`) AS `{out}:{i}`" for i in range(len(columns)) for out, function in measures.items()]
    )
    return _long(wide, columns, "column", tuple(measures)).selectExpr(
        "column", "count", "try_divide(sum, count) AS mean", "stddev", "min", "max"
    )


def text_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same for text columns: mean and deviation of the values that are numbers."""
    measures = {
        "count": "count(?)",
        "mean": "avg(try_cast(? AS DOUBLE))",
        "stddev": "stddev_samp(try_cast(? AS DOUBLE))",
        "min": "min(?)",
        "max": "max(?)",
    }
    wide = df.selectExpr(
        *[
            f"{measure.replace('?', name(c))} AS `{out}:{i}`"
            for i, c in enumerate(columns)
            for out, measure in measures.items()
        ]
    )
    return _long(wide, columns, "column", tuple(measures))


QUANTILE_SCHEMA = "column string, probability double, quantile double"

#: Orders doubles by sign and power of two; zero and the infinities have cells of their own.
_BINADE = "coalesce(signum(value) * (floor(least(log2(abs(value)), 1025D)) + 2000), 0D)"


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float] = (0.25, 0.5, 0.75),
    cells: int = 2048,
) -> DataFrame:
    """Exact quantiles, linear between neighbours; nulls and NaN left out.

    ``percentile`` keeps every distinct value of a column in one task's memory,
    and sorting shuffles them all. Here ranks are found by refinement: the
    columns are stored once in the shared folder, a scan counts the values by
    sign and power of two, and each further scan cuts the one cell that holds a
    wanted rank into ``cells`` equal parts, all ranks and columns at once. A cell
    of at most ``cells`` rows is cut into its single values. A scan's shuffle is
    bounded by tasks, wanted cells and ``cells``, whatever the number of distinct
    values, and the driver gets at most two rows per column and probability.
    Doubles of one power of two need at most five such cuts.

    The work is done when this is called. A column without values has a null
    for each probability.
    """
    if cells < 2:
        raise ValueError(f"at least two cells are needed, not {cells}")
    spark, shares = df.sparkSession, sorted({float(p) for p in probabilities})
    if not shares or not columns:
        return spark.createDataFrame([], QUANTILE_SCHEMA)
    # Columns go by number, so that any name will do. Adding zero makes -0 and 0 one value.
    stored = write_stage(
        df.selectExpr(*[f"CAST({name(c)} AS DOUBLE) + 0D AS `{i}`" for i, c in enumerate(columns)]),
        scratch_path(spark, "quantiles"),
    )

    def by_column(numbers: Sequence[int]) -> DataFrame:
        values = stored.select(*map(str, numbers)).unpivot([], [str(i) for i in numbers], "column", "value")
        return values.where("value IS NOT NULL AND NOT isnan(value)")

    def cut(values: DataFrame, cell: str, keys: Sequence[str]) -> DataFrame:
        """Rows, least and greatest value per cell, and the rows of the cells of lower values."""
        keys = [*keys, "column"]
        counted = values.withColumn("cell", F.expr(cell)).groupBy(*keys, "cell").agg(
            F.count(F.lit(1)).alias("rows"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        # At most `cells` rows, or one per power of two, in each of these windows.
        upto = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        return counted.withColumn("lower", F.sum("rows").over(upto) - F.col("rows"))

    first = cut(by_column(range(len(columns))), _BINADE, ()).withColumn("total", F.sum("rows").over(Window.partitionBy("column")))
    place = first.select("*", F.explode(F.array(*map(F.lit, shares))).alias("share")).withColumn("place", F.expr("share * (total - 1)"))
    held = place.withColumn("rank", F.explode(F.expr("array_distinct(array(floor(place), ceil(place)))")))
    held = held.where("rank >= lower AND rank < lower + rows").collect()
    places = {(int(r.column), r.share): r.place for r in held}
    found = {(int(r.column), r.rank): (r.low, r.high, r.rows, r.lower) for r in held}

    while wanted := {key: cell for key, cell in found.items() if cell[0] < cell[1]}:
        numbers = sorted({column for column, _ in wanted})
        inside = spark.createDataFrame(
            sorted({(str(column), *cell) for (column, _), cell in wanted.items()}),
            "column string, least double, most double, held long, before long",
        )
        ranks = spark.createDataFrame(
            [(str(column), cell[0], rank) for (column, rank), cell in wanted.items()], "column string, least double, rank long"
        )
        # Both tables have at most two rows per column and probability.
        values = by_column(numbers).join(F.broadcast(inside), "column").where("value BETWEEN least AND most")
        part = f"IF(held <= {cells}, value, floor(least((value - least) / (most - least) * {cells}, {cells - 1}D)))"
        finer = cut(values, part, ("least", "before")).withColumn("lower", F.expr("before + lower"))
        finer = finer.join(F.broadcast(ranks), ["column", "least"]).where("rank >= lower AND rank < lower + rows")
        found.update({(int(r.column), r.rank): (r.low, r.high, r.rows, r.lower) for r in finer.collect()})

    def between(column: int, share: float) -> float | None:
        if (column, share) not in places:
            return None
        at = places[column, share]
        low, high = found[column, math.floor(at)][0], found[column, math.ceil(at)][0]
        return low if low == high else low + (high - low) * (at - math.floor(at))

    rows = [(c, float(p), between(i, float(p))) for i, c in enumerate(columns) for p in probabilities]
    return spark.createDataFrame(rows, QUANTILE_SCHEMA)


def summary_with_quartiles(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """:func:`summary` plus the three quartiles."""
    names = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
    wide = quantiles(df, columns, tuple(names)).groupBy("column").agg(
        *[F.expr(f"max(CASE WHEN probability = {p}D THEN quantile END) AS {n}") for p, n in names.items()]
    )
    # One row per profiled column on either side.
    return summary(df, columns).join(F.broadcast(wide), "column", "left")


def null_nan_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null or NaN values per column."""
    wide = df.selectExpr(*[f"count_if({is_missing(df, c)}) AS `missing:{i}`" for i, c in enumerate(columns)])
    return _long(wide, columns, "column", ["missing"])


def column_info(df: DataFrame) -> DataFrame:
    """Position, name, type and non-null count of every column."""
    wide = df.selectExpr(*[f"count({name(c)}) AS `non_null:{i}`" for i, c in enumerate(df.columns)])
    facts = [f"{i} AS `position:{i}`" for i in range(len(df.columns))]
    facts += [f"{literal(t)} AS `type:{i}`" for i, (_, t) in enumerate(df.dtypes)]
    return _long(wide.selectExpr("*", *facts), df.columns, "column", ("position", "type", "non_null"))


def correlation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair of columns, long form.

    A pair uses the rows where both values are present (null and NaN are not).
    One scan: each task keeps counts, means and centred moments of all pairs,
    merged batch by batch from matrix products, and a few hundred numbers per
    task are merged the same way. Nothing runs before an action asks for it.
    """
    columns = list(columns)
    size = len(columns)
    present = df.selectExpr(*[f"nanvl(CAST({name(c)} AS DOUBLE), NULL) AS `{i}`" for i, c in enumerate(columns)])

    def pair_moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, x, xx, xy = (np.zeros((size, size)) for _ in range(4))
        for batch in batches:
            values = batch.to_numpy(dtype=float)
            known = ~np.isnan(values)
            filled = np.where(known, values, 0.0)
            center = filled.sum(axis=0) / np.maximum(known.sum(axis=0), 1)
            filled, known = np.where(known, values - center, 0.0), known.astype(float)
            # Moments of the batch about each pair's own means.
            rows = known.T @ known
            mean = (filled.T @ known) / np.maximum(rows, 1)
            squares = (filled * filled).T @ known - rows * mean * mean
            products = filled.T @ filled - rows * mean * mean.T
            shift = mean + center[:, None] - x
            both = n + rows
            weight = n * rows / np.maximum(both, 1)
            xx += squares + weight * shift * shift
            xy += products + weight * shift * shift.T
            x += shift * rows / np.maximum(both, 1)
            n = both
        left, right = np.indices((size, size))
        cells = {"i": left, "j": right, "n": n, "x": x, "y": x.T, "xx": xx, "yy": xx.T, "xy": xy}
        yield pd.DataFrame({name: cell.ravel() for name, cell in cells.items()})

    cells = present.mapInPandas(pair_moments, "i int, j int, n double, x double, y double, xx double, yy double, xy double")
    # The tasks' moments, moved to the common means: a few hundred rows per task.
    pair = "OVER (PARTITION BY i, j)"
    moved = cells.selectExpr("*", *[f"{v} - sum(n * {v}) {pair} / nullif(sum(n) {pair}, 0) AS d{v}" for v in "xy"])
    total = moved.groupBy("i", "j").agg(
        *[F.expr(f"sum({a}{b} + coalesce(n * d{a} * d{b}, 0)) AS {a}{b}") for a, b in ("xx", "yy", "xy")]
    )
    names = f"array({', '.join(map(literal, columns))})"
    return total.selectExpr(f"{names}[i] AS left", f"{names}[j] AS right", "try_divide(xy, sqrt(xx * yy)) AS corr")
