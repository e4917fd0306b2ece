"""What the operators share: tables, names, batches of texts; and the stored tables of
the library, by the names they are known by here."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wordloom.storage import shared_folder, stored


__all__ = [
    "free_names", "membership", "schema_of", "shared_folder", "stored", "table", "text_slices",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the Parquet tables of a folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names for columns of one's own, like those wanted, that differ from all taken ones
    however these are written."""
    used = {name.lower() for name in taken}
    found = []
    for name in wanted:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        found.append(name)
    return found


def schema_of(frame: DataFrame, columns: Iterable[str], **more: str) -> T.StructType:
    """Fields of a frame followed by new ones, given as ``name="type"``."""
    fields = [T.StructField(c, frame.schema[c].dataType) for c in columns]
    return T.StructType(
        fields + [T.StructField(n, T._parse_datatype_string(t)) for n, t in more.items()]
    )


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", chars: int = 1_500_000
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches with about so many characters (one text at least), together
    with their texts; a null text is an empty one."""
    for batch in batches:
        texts = [text or "" for text in batch.column(column).to_pylist()]
        begin = size = 0
        for end, text in enumerate(texts):
            if size and size + len(text) > chars:
                yield batch.slice(begin, end - begin), texts[begin:end]
                begin, size = end, 0
            size += len(text)
        if begin < len(texts):
            yield batch.slice(begin), texts[begin:]


def membership(ids: DataFrame, column: str, bits: int = 26) -> Callable[[str], Column]:
    """A test of whether a value may be one of ``ids``: never false for one that is.

    It is a bitmap of ``2 ** bits`` hash places (8 MB), gathered by the executors and
    broadcast, so its size does not depend on the number of ids. With more ids more other
    values pass, and what passes is to be joined with the ids. Used to keep most rows with
    their texts out of a shuffle.
    """
    place = F.xxhash64(column).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        ids.select(place.alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("mask"))
        .toArrow()
    )
    bitmap = np.zeros(1 << (bits - 6), dtype=np.int64)
    bitmap[words["word"].to_numpy()] = words["mask"].to_numpy()
    sent = ids.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf("boolean")
    def hit(places: pd.Series) -> pd.Series:
        at = places.to_numpy()
        return pd.Series((sent.value[at >> 6] >> (at & 63)) & 1 == 1)

    return lambda name: hit(F.xxhash64(name).bitwiseAND(F.lit((1 << bits) - 1)))
