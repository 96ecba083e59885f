"""Splits, samples and limits."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 42
#: Column of a row's hash while a sample is drawn.
HASH = "_row_hash"
#: Copies of one row that a task writes out at most.
COPIES = 65_536


def random_split(df: DataFrame, train_ratio: float = 0.7, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Seeded random split.

    Which rows land where depends on how the input is partitioned, and every
    partition is sorted to make a rerun agree; :func:`hash_split` needs neither.
    """
    train, test = df.randomSplit([train_ratio, 1 - train_ratio], seed=seed)
    return train, test


def md5_bucket(keys: Sequence[str], salt: str = "") -> tuple[Column, int]:
    """Hash of a row from the MD5 of its keys (after ``salt``), the same on any engine, and its width in bits."""
    before = [F.lit(salt)] if salt else []
    text = F.concat_ws("|", *before, *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint"), 32


def salted_bucket(salt: str) -> Callable[[Sequence[str]], tuple[Column, int]]:
    """:func:`md5_bucket` after ``salt``: draws with different salts are independent of each other."""
    return lambda keys: md5_bucket(keys, salt)


def fast_bucket(keys: Sequence[str]) -> tuple[Column, int]:
    """Hash of a row from Spark's own 64-bit hash, several times cheaper, and its width in bits."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 1), 63


def in_train(bucket: tuple[Column, int], train_ratio: float = 0.7) -> Column:
    """The hash lies in the training share of its whole range."""
    if not 0 <= train_ratio <= 1:
        raise ValueError(f"a share between 0 and 1 is needed, not {train_ratio}")
    value, bits = bucket
    limit = round(train_ratio * (1 << bits))
    return F.lit(True) if limit >= 1 << bits else value < F.lit(limit)


def hash_split(
    df: DataFrame, train_ratio: float = 0.7, keys: Sequence[str] | None = None, bucket=fast_bucket
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of each row's keys (all columns by default).

    A row's side depends on its content alone, so the split survives
    repartitioning and lost executors, and costs no sort and no shuffle.
    """
    side = in_train(bucket(list(keys or df.columns)), train_ratio)
    return df.where(side), df.where(~side)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """Each row independently with probability ``fraction``."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def hash_sample(df: DataFrame, fraction: float, keys: Sequence[str], salt: str = "") -> DataFrame:
    """Rows whose hash lies in the first ``fraction`` of its range: nested by fraction, the same under any partitioning."""
    return df.where(in_train(md5_bucket(keys, salt), fraction))


def _part_of_hash(value: Column, bits: int, width: int) -> Column:
    """The hash without its lowest ``bits - width`` bits."""
    return F.shiftright(value, bits - width)


def exact_sample(df: DataFrame, rows: int, bucket=md5_bucket, step: int = 11) -> DataFrame:
    """Exactly ``rows`` rows (all, if there are no more): those of least hash over all columns.

    The same rows under any partitioning and after any retry. The hash value that bounds the sample is
    found from histograms of 2^``step`` counts, each scan refining one cell of the last, so no row is
    sorted and only counts reach the driver. Rows at the bounding hash itself are taken in the order of
    their columns (nulls first); equal rows are counted, and written out as often as needed by many tasks.
    """
    if rows < 0:
        raise ValueError(f"a number of rows from 0 is needed, not {rows}")
    value, bits = bucket(df.columns)
    hashed = df.withColumn(HASH, value)
    prefix, width, below = 0, 0, 0
    while width < bits:
        finer = min(bits, width + step)
        inside = F.lit(True) if width == 0 else _part_of_hash(F.col(HASH), bits, width) == prefix
        cells = hashed.where(inside).groupBy(_part_of_hash(F.col(HASH), bits, finer).alias("cell")).count()
        counts = sorted(map(tuple, cells.collect()))  # at most 2^step
        for cell, n in counts:
            if below + n > rows:
                break
            below += n
        else:
            return df  # there are no more rows than asked for
        prefix, width = cell, finer
    surely = hashed.where(F.col(HASH) < prefix).drop(HASH)
    if below == rows:
        return surely
    # Rows that share the one bounding hash: different rows seldom do, equal rows are one counted row.
    tied = hashed.where(F.col(HASH) == prefix).drop(HASH).groupBy(*df.columns).agg(F.count(F.lit(1)).alias(HASH))
    before = F.coalesce(F.sum(HASH).over(Window.orderBy(*df.columns).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = tied.withColumn(HASH, F.least(F.col(HASH), F.lit(rows - below) - before)).where(F.col(HASH) > 0)
    blocks = taken.withColumn("_start", F.explode(F.sequence(F.lit(0), F.col(HASH) - 1, F.lit(COPIES)))).repartition("_start")
    copies = F.explode(F.array_repeat(F.lit(0), F.least(F.lit(COPIES), F.col(HASH) - F.col("_start")).cast("int")))
    return surely.unionByName(blocks.select(*df.columns, copies.alias("_copy")).select(*df.columns))


def sample_about(df: DataFrame, rows: int, seed: int = SEED) -> DataFrame:
    """About ``rows`` random rows; all of them if there are no more (a sample of share 1).

    Unlike a limit of that size this stays spread over all partitions.
    """
    return bernoulli_sample(df, min(1.0, rows / max(1, df.count())), seed)


def first_rows(df: DataFrame, n: int, columns: Sequence[str] = ()) -> DataFrame:
    """``n`` rows of the frame, whichever come first; for looking, not for sampling."""
    return (df.select(*columns) if columns else df).limit(n)
