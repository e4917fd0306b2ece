"""Corpora: text files, keyed text files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wordloom.functions.tokens import document_id, lines_of


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``: one row per line of every file under the path."""
    return spark.read.text(path)


#: Bytes of a text file that is read whole. A line reader copies Hadoop's settings for every
#: file, one after the other in a process: more than such a file takes to read.
WHOLE = 1 << 20


def documents_from_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``doc_id, text``: one row per line, the id taken from the name of the file.

    Files of the same base name in different folders are one document. Large files are
    split among tasks, so a row is a line and not a file. Small ``.txt`` files, which no
    codec claims, are read whole, many by a task: ``spark.sql.shuffle.partitions`` tasks in
    all, or two for as many bytes as a partition of files has.
    """
    # File names arrive percent-encoded, except for the plus sign.
    encoded = F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B"))
    doc_id = document_id(F.url_decode(encoded)).alias("doc_id")
    whole = (F.col("_metadata.file_size") <= WHOLE) & F.endswith(
        F.col("_metadata.file_name"), F.lit(".txt")
    )
    files = spark.read.format("binaryFile").load(path)
    conf = spark._jsparkSession.sessionState().conf()
    size = int(files._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    tasks = max(conf.numShufflePartitions(), 2 * size // conf.filesMaxPartitionBytes())
    small = files.filter(whole).select(doc_id, _without_mark(F.col("content")).alias("content"))
    lines = _file_lines(small.coalesce(tasks))
    # Decided by the list of files, none of which is opened.
    if files.filter(~whole).isEmpty():
        return lines
    others = spark.read.text(path).filter(~whole)
    return others.select(doc_id, F.col("value").alias("text")).unionByName(lines)


def _without_mark(content: Column) -> Column:
    """A byte order mark, which a line reader leaves out, is cut off."""
    marked = F.substring(content, 1, 3) == F.lit(b"\xef\xbb\xbf")
    return F.when(marked, F.substring(content, 4, WHOLE)).otherwise(content)


def _file_lines(files: DataFrame) -> DataFrame:
    """``doc_id, text``: what a line reader makes of whole files (``doc_id, content``); bytes
    that are no UTF-8 stay as they are."""
    text = F.col("content").cast("string")
    body = F.when(text.endswith("\n"), F.substring(text, F.lit(1), F.length(text) - 1))
    plain = F.split(F.coalesce(body, text), "\n")  # a single character, so no expression
    files = files.filter(F.octet_length("content") > 0)
    files = files.withColumn("valid", F.is_valid_utf8(text))
    lines = F.when(F.col("valid") & ~text.contains("\r"), plain).when(F.col("valid"), lines_of(text))
    lines = lines.otherwise(lines_of(F.decode("content", "ISO-8859-1")))
    rows = files.select("doc_id", "valid", F.explode(lines).alias("text"))
    raw = F.encode("text", "ISO-8859-1").cast("string")
    return rows.select("doc_id", F.when(F.col("valid"), F.col("text")).otherwise(raw).alias("text"))


def keyed_documents(lines: DataFrame) -> DataFrame:
    """``doc_id, text`` from ``id TAB content`` lines; lines without a tab are skipped."""
    value = F.col("value")
    key = F.substring_index(value, "\t", 1)
    return lines.filter(value.contains("\t")).select(
        key.alias("doc_id"),
        F.substring(value, F.length(key) + 2, F.length(value)).alias("text"),
    )


def document_table(
    spark: SparkSession,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    partitions: int | None = None,
) -> DataFrame:
    """``doc_id, text`` of a Parquet table, one row per document.

    Texts without any line are left out. The table is read where it lies; a caller who
    knows that it has too few splits for its cores (one small file, say) gives a number of
    ``partitions`` to deal the rows out to, at the price of a shuffle.
    """
    table = spark.read.parquet(path).select(
        F.col(id_column).alias("doc_id"), F.col(text_column).alias("text")
    )
    documents = table.filter(F.col("text") != "")
    return documents.repartition(partitions) if partitions else documents


def text_lines(documents: DataFrame) -> DataFrame:
    """``value``: the lines of every text, as a line reader would give them."""
    return documents.filter(F.col("text") != "").select(
        F.explode(lines_of("text")).alias("value")
    )
