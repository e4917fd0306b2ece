"""Intermediate tables in the folder that all executors share, and what is known of them."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a table is sent to every executor.
SMALL = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate results that all executors reach.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only on a single machine
    (a local master) a temporary folder is made where that is unset; on a cluster the lack
    of it is an error, since executors would write to disks of their own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not folder:
        known = context._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='wordloom-')}"
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that nothing has been written to."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared folder and read from there.

    Cuts the lineage: the rows are computed once, and a lost executor costs no more than
    the tasks that read the table.
    """
    spark = frame.sparkSession
    path = new_path(spark)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@dataclass(frozen=True)
class Listed:
    """A stored list of distinct terms whose size is known."""

    terms: DataFrame
    count: int
    size: int  # bytes, about

    @property
    def small(self) -> bool:
        return self.size <= SMALL

    def sent(self) -> Broadcast[pa.Array]:
        """The terms as a variable of the executors; for a small list."""
        if not self.small:
            raise ValueError(f"{self.size} bytes are too many to send")
        terms = self.terms.select("term").toArrow().column("term").combine_chunks()
        return self.terms.sparkSession.sparkContext.broadcast(terms)


def listed(words: DataFrame, *more: str) -> Listed:
    """The distinct first column of ``words``, as ``term``, without nulls, and ``more`` of
    its columns; stored once and measured."""
    term = F.col(words.columns[0]).alias("term")
    rows = stored(words.select(term, *more).filter("term is not null").dropDuplicates(["term"]))
    width = F.octet_length("term") + 16 + 16 * len(more)
    known = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
    return Listed(rows, known["n"], known["size"])
