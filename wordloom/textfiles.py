"""Text files of one value each in a local folder.

Hadoop sets the mode of every file it makes on a local disk and, where it has no native
library, starts a process for that: two for each file, as its checksums are a file, too.
Here tasks open the files themselves. What lies there afterwards is what Hadoop leaves,
checksums included, and its readers verify them.
"""

from __future__ import annotations

import os
import shutil
import struct
import sys
import uuid
import zlib
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from py4j.java_gateway import is_instance_of
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Executors need not have this package installed: ship the functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def local_folder(spark: SparkSession, path: str) -> tuple[str, int, int] | None:
    """The folder's name on the disk, the bytes of a checksum and the mode of files, if
    Hadoop's local file system has the path; other systems take no process for a file."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsparkSession.sessionState().newHadoopConf()
    name = hadoop.Path(path)
    system = name.getFileSystem(conf)
    local = is_instance_of(spark._sc._gateway, system, "org.apache.hadoop.fs.LocalFileSystem")
    if not local or system.getUri().getScheme() != "file":
        return None
    mode = 0o666 & ~hadoop.permission.FsPermission.getUMask(conf).toShort()
    return system.makeQualified(name).toUri().getPath(), system.getBytesPerSum(), mode


def _write_file(folder: str, name: str, text: bytes, each: int, mode: int) -> None:
    """The file, and the CRC32 of every ``each`` bytes in Hadoop's form of them."""
    sums = [zlib.crc32(text[at : at + each]) for at in range(0, len(text), each)]
    crc = b"crc\0" + struct.pack(f">i{len(sums)}I", each, *sums)
    for file, content in ((f".{name}.crc", crc), (name, text)):
        with open(f"{folder}/{file}", "xb", buffering=0) as out:
            os.fchmod(out.fileno(), mode)
            rest = memoryview(content)
            while rest:
                rest = rest[out.write(rest) :]


def _written(folder: str, each: int, mode: int) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count = TaskContext.get().partitionId(), 0
        attempt = f"{folder}/{uuid.uuid4().hex}"
        os.mkdir(attempt)
        for batch in batches:
            for value in batch.column(0).cast(pa.large_binary()):
                name = f"part-{part:05d}-c{count:03d}.txt"
                _write_file(attempt, name, (value.as_py() or b"") + b"\n", each, mode)
                count += 1
        yield pa.RecordBatch.from_pydict(
            {"attempt": [attempt], "files": pa.array([count], pa.int64())}
        )

    return write


def _moved(folder: str) -> Callable:
    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for attempt in batch.column("attempt").to_pylist():
                # A repeated task finds what the former has left. Checksums, which begin
                # with a dot, go first.
                with suppress(FileNotFoundError):
                    for name in sorted(os.listdir(attempt)):
                        with suppress(FileNotFoundError):
                            os.rename(f"{attempt}/{name}", f"{folder}/{name}")
        yield from ()

    return move


def _removed(folder: str, tasks: int) -> Callable:
    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = set(batch.column(0).to_pylist())
            for entry in os.scandir(folder):
                if zlib.crc32(os.fsencode(entry.name)) % tasks in own:
                    with suppress(FileNotFoundError):
                        if not entry.is_dir(follow_symlinks=False):
                            os.remove(entry.path)
        yield from ()

    return remove


def _remove_files(spark: SparkSession, folder: str) -> None:
    """Take a folder's many files away by all cores; what it has else is left to Spark."""
    tasks = spark.sparkContext.defaultParallelism
    numbers = spark.range(0, tasks, 1, tasks)
    numbers.mapInArrow(_removed(folder, tasks), "id long").collect()


def write_values(rows: DataFrame, path: str, mode: str) -> bool:
    """Write the only column of ``rows`` as a file for each row; False, and nothing done,
    if the path is not on a local disk.

    Spark itself makes the folder, so the mode means what it means there. Every attempt of
    a task writes to a folder of its own; those of the attempts that Spark has counted are
    moved to their place by a second job.
    """
    spark = rows.sparkSession
    if not (found := local_folder(spark, path)):
        return False
    folder, each, bits = found
    if mode == "overwrite" and os.path.isdir(folder):
        _remove_files(spark, folder)
    empty = spark.range(0, 0, 1, 1).selectExpr("cast(id as string) as value").write.mode(mode)
    empty.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").text(path)
    none = os.listdir(folder)  # a file without rows, which stays if no other is written
    attempts = f"{folder}/_temporary"
    os.makedirs(attempts, exist_ok=True)
    try:
        written = rows.mapInArrow(_written(attempts, each, bits), "attempt string, files long")
        tasks = written.filter("files > 0").toArrow()  # a row a task
        if tasks.num_rows:
            frame = spark.createDataFrame(tasks).repartition(tasks.num_rows)
            frame.mapInArrow(_moved(folder), "attempt string").collect()
            if left := [a for a in tasks["attempt"].to_pylist() if os.listdir(a)]:
                raise OSError(f"files are left in {left[0]}")
            for name in none:
                os.remove(f"{folder}/{name}")
    finally:
        shutil.rmtree(attempts, ignore_errors=True)  # and what attempts that failed have left
    _write_file(folder, "_SUCCESS", b"", each, bits)
    return True
