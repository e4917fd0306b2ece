"""Ranges of keys of about equal weight, found in one pass over the keys."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Keys that a summary holds. Up to so many distinct keys it is exact.
SUMMARY = 8_192
#: Summaries that one task merges.
FAN_IN = 16


def _counted(tables: list[pa.Table], names: list[str]) -> pa.Table:
    """Keys in their order, each once, with their weights added."""
    whole = pa.concat_tables(tables).combine_chunks()
    summed = whole.group_by(names).aggregate([("weight", "sum")]).rename_columns([*names, "weight"])
    order = pc.sort_indices(
        summed, sort_keys=[(n, "ascending") for n in names], null_placement="at_start"
    )
    return summed.take(order)


def _summary(tables: list[pa.Table], names: list[str], size: int = SUMMARY) -> pa.Table:
    """At most ``size`` keys whose weights stand for all keys from the one before on.

    Of more keys those are kept at which the running weight passes a multiple of the whole
    over ``size``; a kept key takes the weight of the ones left out before it. So the
    weight below any key is off by at most that share of the whole, for every time that
    keys were left out. Merging is the same again.
    """
    counted = _counted(tables, names)
    if counted.num_rows <= size:
        return counted
    running = pc.cumulative_sum(counted["weight"]).to_numpy()
    step = running[-1] / (size - 1)
    level = (running / step).astype("int64")
    kept = np.append(True, level[1:] != level[:-1])
    kept[-1] = True  # the largest key, with the weight after the last level
    weights = running[kept].copy()
    weights[1:] -= running[kept][:-1]
    keys = counted.select(names).filter(pa.array(kept))
    return keys.append_column("weight", pa.array(weights, pa.int64()))


def range_bounds(rows: DataFrame, columns: Sequence[str], parts: int) -> list[Row]:
    """Keys that cut the ordered rows into ``parts`` ranges of about equal numbers of rows.

    The i-th bound is the first key of range i, so there are ``parts - 1`` at most, and
    fewer where one key has more rows than a range. Only the key columns are read, once:
    every task counts its keys and sums them up in :data:`SUMMARY` of them, tasks merge
    those, and the driver gets one summary. With no more distinct keys than that the
    bounds are exact: the rows of rank ``ceil(i * rows / parts)``, counted from 0.
    """
    names = [f"k{i}" for i in range(len(columns))]
    keys = rows.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(columns, names)))
    schema = T.StructType([*keys.schema.fields, T.StructField("weight", T.LongType())])
    numbered = T.StructType([*schema.fields, T.StructField("part", T.LongType())])

    def summarise(batches):
        held, waiting = [], 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held.append(table.append_column("weight", pa.array([1] * len(batch), pa.int64())))
            waiting += len(batch)
            if waiting > 8 * SUMMARY:
                held, waiting = [_summary(held, names)], 0
        if held:
            last = _summary(held, names)
            part = pa.array([TaskContext.get().partitionId()] * len(last), pa.int64())
            yield from last.append_column("part", part).to_batches()

    def merge(group: pa.Table) -> pa.Table:
        merged = _summary([group.select([*names, "weight"])], names)
        return merged.append_column("part", pa.array([group["part"][0].as_py() // FAN_IN] * len(merged), pa.int64()))

    found = keys.mapInArrow(summarise, numbered)
    for _ in range(2):  # 256 tasks to one summary; more come together on the driver
        found = found.groupBy(F.floor(F.col("part") / FAN_IN)).applyInArrow(merge, numbered)
    table = found.toArrow().select([*names, "weight"])
    if not table.num_rows:
        return []
    whole = _summary([table], names)
    below = pc.subtract(pc.cumulative_sum(whole["weight"]), whole["weight"]).to_pylist()
    total = below[-1] + whole["weight"][-1].as_py()
    places, at = [], 0
    for i in range(1, parts):
        target = -(-i * total // parts)
        # The key at this rank begins at or before it; a range begins with a whole key.
        while at + 1 < len(below) and below[at + 1] <= target:
            at += 1
        places.append(at)
    chosen = whole.select(names).take(pa.array(sorted(set(places) - {0}), pa.int64()))
    # In Spark's own order, should that of Arrow differ for a type.
    frame = rows.sparkSession.createDataFrame(chosen, schema=keys.schema)
    return frame.orderBy(*names).collect()


def range_of(columns: Sequence[str], bounds: list[Row], schema: T.StructType) -> Column:
    """The number of the range, from 0, that the key ``columns`` of a row lie in: a binary
    search among the bounds, as one expression."""
    key = F.struct(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(columns)))
    types = [schema[c].dataType for c in columns]

    def literal(row: Row) -> Column:
        return F.struct(*(F.lit(v).cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(row, types))))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(key < literal(bounds[middle]), search(low, middle)).otherwise(
            search(middle + 1, high)
        )

    return search(0, len(bounds))
