"""Readers for directories of observation files."""

from __future__ import annotations

import csv
from collections import defaultdict
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from obsflow.sources.schema import MODEL_INPUT_COLUMNS, OBSERVATION_SCHEMA
from obsflow.sources.session import scratch_path
from obsflow.sources.staging import write_stage


def read_observations(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: StructType = OBSERVATION_SCHEMA,
    strict: bool = True,
) -> DataFrame:
    """Files with a header line, read by position against a declared schema.

    One pass, no inference. With ``strict`` each file's header must carry the
    schema's name at the place of every column the query uses, otherwise the
    job fails and names the file; columns the query leaves out may differ.
    Without it the header is skipped unread.
    """
    return (
        spark.read.option("header", True)
        .option("enforceSchema", not strict)
        .schema(schema)
        .csv(path)
    )


def read_inferred(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Column names from the header and types from an extra pass over the data."""
    return spark.read.csv(path, header=True, inferSchema=True)


def header_places(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``file`` and ``places`` (index of each column in its header, -1 if absent).

    One small task per file, which stops after the first batch of lines, so
    the cost follows the number of files and not their size.
    """
    wanted = list(columns)
    schema = StructType([StructField("file", StringType()), StructField("places", ArrayType(IntegerType()))])

    def first_line(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                line, file = batch.column("value")[0].as_py(), batch.column("file_path")[0].as_py()
                names = next(csv.reader([line.lstrip("\ufeff")]))
                places = [names.index(c) if c in names else -1 for c in wanted]
                types = [pa.string(), pa.list_(pa.int32())]
                yield pa.record_batch([pa.array([v], t) for v, t in zip((file, places), types)], ["file", "places"])
                return

    # A session of its own: these two settings give every file its own task.
    one_file_per_task = spark.newSession()
    for setting in ("maxPartitionBytes", "openCostInBytes"):
        one_file_per_task.conf.set(f"spark.sql.files.{setting}", str(1 << 50))
    lines = one_file_per_task.read.text(path).select("value", "_metadata.file_path")
    return lines.mapInArrow(first_line, schema)


#: Files with a layout of their own up to which their table is sent to every task (about 200 bytes each).
BROADCAST_FILES = 200_000


def read_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] = MODEL_INPUT_COLUMNS,
    schema: StructType = OBSERVATION_SCHEMA,
    broadcast_files: int = BROADCAST_FILES,
) -> DataFrame:
    """The named columns, wherever each file's header puts them; null where a file lacks one.

    A first pass stores one row per file, with the place of each column, in the
    shared folder. If all files agree, the directory is an ordinary scan.
    Otherwise it is one scan by place, joined on the file's path with the stored
    rows of the files that differ from the commonest layout; a column is taken
    from the place its file names. No file name reaches the driver: it gets the
    commonest layout and, per column, the places in use. The join sends the
    stored rows to all tasks up to ``broadcast_files`` of them.
    """
    columns = list(columns)
    layouts = write_stage(header_places(spark, path, columns), scratch_path(spark, "layouts"))
    commonest = layouts.groupBy("places").count().orderBy(F.desc("count"), "places").first()
    if commonest is None:
        return spark.createDataFrame([], StructType([schema[c] for c in columns]))
    usual = list(commonest.places)
    rare = layouts.where(F.col("places") != F.array(*map(F.lit, usual)))
    used = rare.agg(F.count(F.lit(1)).alias("files"), *[F.collect_set(F.col("places")[i]).alias(str(i)) for i in range(len(columns))]).first()
    places = [sorted({place, *used[str(i)]}) for i, place in enumerate(usual)]

    # A place is read with the type of its columns, or as text if these differ.
    types = defaultdict(set)
    for column, mine in zip(columns, places):
        for place in mine:
            types[place].add(schema[column].dataType)
    width = max(0, *types) + 1
    declared = [next(iter(types[i])) if len(types[i]) == 1 else StringType() for i in range(width)]
    by_place = StructType([StructField(f"_{i}", kind) for i, kind in enumerate(declared)])
    rows = read_observations(spark, path, by_place, strict=False)
    if used.files:
        known = rare.withColumnsRenamed({"file": "_file", "places": "_places"})
        if used.files <= broadcast_files:
            known = F.broadcast(known)
        rows = rows.withColumn("_path", F.col("_metadata.file_path")).join(known, F.col("_path") == F.col("_file"), "left")

    def taken(column: str, place: int) -> Column:
        kind = schema[column].dataType
        if place < 0:
            return F.lit(None).cast(kind)
        return F.col(f"_{place}") if declared[place] == kind else F.col(f"_{place}").try_cast(kind)

    def chosen(i: int, column: str) -> Column:
        value = taken(column, usual[i])
        own = F.col("_places")[i] if used.files else None
        for place in places[i]:
            if place != usual[i]:
                value = F.when(own == place, taken(column, place)).otherwise(value)
        return value.alias(column)

    return rows.select(*[chosen(i, c) for i, c in enumerate(columns)])
