"""Documents by the whole vocabulary: counts and scores with their zeros.

The vocabulary is a stored table of blocks. A block is one row: a map from its terms to
what the result needs of them. A document meets a block by an equi join on the number of
the block; there its own counts are laid over the block's terms in one pass over both.
So neither a task nor the driver holds more of the vocabulary than a block, whatever is
known of a term (its weight) needs no join of its own, and zeros appear last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordloom.storage import Listed, stored

#: Terms in a block, about.
BLOCK_TERMS = 10_000


def block_of(term: Column | str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(blocks)).cast("int")


def term_blocks(vocabulary: Listed, value: Column, blocks: int) -> DataFrame:
    """``block, entries``: the terms of each block with a number for each. Large blocks are
    stored."""
    rows = vocabulary.terms.select("term", value.cast("double").alias("value"))
    entries = F.map_from_entries(F.collect_list(F.struct("term", "value")))
    found = rows.groupBy(block_of("term", blocks).alias("block")).agg(entries.alias("entries"))
    return found if vocabulary.small else stored(found)


def lay_over(rows: DataFrame, blocks: DataFrame, small: bool, count: int) -> DataFrame:
    """``doc_id, term, tf, value`` for every term of the block that each row of ``rows``
    names: ``doc_id, block, found`` with ``found`` as an array of ``term, tf``.

    Small blocks, whose size has been measured, are sent to all tasks. Others are shuffled
    with the rows; as there are few numbers of blocks, each block goes to several parts,
    over which documents are dealt by their ids.
    """
    if small:
        met = rows.join(F.broadcast(blocks), "block")
    else:
        partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = max(1, -(-2 * partitions // count))
        dealt = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
        # Measured to be too large, whatever the size of its compressed files suggests.
        dealt_blocks = blocks.select("block", "entries", every).hint("merge")
        met = rows.withColumn("part", dealt).join(dealt_blocks, ["block", "part"])
    laid = F.map_zip_with(
        "entries",
        F.map_from_entries("found"),
        # Own terms outside of the vocabulary have no value and go below.
        lambda term, value, tf: F.struct(F.coalesce(tf, F.lit(0).cast("bigint")).alias("tf"), value.alias("value")),
    )
    filled = met.select("doc_id", F.explode(laid).alias("term", "entry"))
    return filled.filter("entry.value is not null").select("doc_id", "term", "entry.tf", "entry.value")
