"""Text output."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from wordloom.functions.rendering import stripe_text
from wordloom.ordering import range_bounds, range_of
from wordloom.storage import stored
from wordloom.textfiles import write_values


def _field(field: T.StructField) -> Column:
    """A column as text: maps as stripes, NULL as an empty field that keeps its place."""
    column = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.MapType):
        text = stripe_text(column)
    elif isinstance(field.dataType, (T.ArrayType, T.StructType)):
        raise TypeError(f"{field.name}: {field.dataType.simpleString()} has no text form")
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def tsv_lines(rows: DataFrame) -> DataFrame:
    """``value``: the columns of every row, joined by tabs.

    NULL is an empty field, a map is ``{a=1, b=2}``; arrays and structs are errors.
    """
    return rows.select(F.concat_ws("\t", *map(_field, rows.schema.fields)).alias("value"))


def write_tsv(
    rows: DataFrame,
    path: str,
    overwrite: bool = False,
    order_by: Sequence[str] | None = None,
    within_files: bool = False,
    files: int | None = None,
) -> None:
    """Write tab-separated lines; fail on an existing path unless told to overwrite.

    With ``order_by`` the part files follow each other in that (byte) order. The rows are
    computed once and stored; a summary of their keys gives ranges of about equal numbers
    of rows, as many as ``files`` (``spark.sql.shuffle.partitions`` unless given), and each
    range is dealt to one task, which sorts it and writes one file. A key counts with all
    its columns, so many rows that share the first are spread. ``within_files`` orders each
    file by itself instead: rows are dealt by a hash of the first column, as reducers get
    keys.
    """
    if order_by and within_files:
        rows = rows.repartition(order_by[0]).sortWithinPartitions(*order_by)
    elif order_by:
        rows = in_ranges(stored(rows), order_by, files)
    mode = "overwrite" if overwrite else "errorifexists"
    tsv_lines(rows).write.mode(mode).text(path)


def in_ranges(rows: DataFrame, order_by: Sequence[str], files: int | None = None) -> DataFrame:
    """The rows in partitions that follow each other in the order of the columns, each of
    them sorted. Reads ``rows`` twice, the first time only the columns to order by."""
    parts = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = range_bounds(rows, order_by, parts)
    dealt = rows.repartitionById(parts, range_of(order_by, bounds, rows.schema))
    return dealt.sortWithinPartitions(*(F.col(f"`{c}`") for c in order_by))


def write_documents(documents: DataFrame, path: str, overwrite: bool = False) -> None:
    """Write every text as a text file of its own, the way a corpus of files comes.

    A task writes a new file for every row; the names differ and carry no ids. Files cost
    more than bytes, so rows are dealt evenly over ``spark.sql.shuffle.partitions`` tasks
    however few splits they come in, and tasks, not the driver, move their files into place:
    a job that fails can leave some there, without ``_SUCCESS``. On a local disk they are
    written past Hadoop, see :mod:`wordloom.textfiles`. Fails on an existing path unless
    told to overwrite.
    """
    mode = "overwrite" if overwrite else "errorifexists"
    tasks = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select(F.col("text").alias("value")).repartition(tasks)
    if not write_values(rows, path, mode):
        writer = rows.write.mode(mode)
        writer = writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        writer.option("maxRecordsPerFile", 1).text(path)


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file_number, line_number, value`` of what :func:`write_tsv` has written: the
    number that the name of a part file has, and that of the line in it, from 0.

    Files may have any size. They are read line by line, a large one by several tasks. The
    lines are stored with running numbers; a table of the splits, a row each, says how many
    lines of a file come before each of them.
    """
    number = F.regexp_extract(F.col("_metadata.file_name"), r"^part-([0-9]+)", 1).cast("int")
    lines = spark.read.text(path, lineSep="\n").select(
        number.alias("file_number"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"),
        "value",
    )
    lines = stored(lines)
    count = F.count(F.lit(1)).alias("count")
    splits = lines.groupBy("file", "split").agg(F.min("id").alias("first"), count)
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("count").over(earlier), F.lit(0))
    starts = splits.select("file", "split", (before - F.col("first")).alias("start"))
    numbered = lines.join(F.broadcast(starts), ["file", "split"])
    place = (F.col("start") + F.col("id")).cast("int").alias("line_number")
    return numbered.select("file_number", place, "value")
