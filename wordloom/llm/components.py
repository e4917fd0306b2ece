"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a, b``, of one type).

    The component is its smallest node. Large and small stars alternate: every node first
    links its larger neighbours, then its smaller ones, to the smallest it knows, until
    nothing changes; the number of rounds grows with the logarithm of the longest path.
    No neighbour lists are built, minima are taken before the shuffle, and each round is
    written to the shared folder.
    """
    pairs = links.filter("a <> b")
    edges = stored(
        pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    seen = None
    while True:
        state = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if state == seen or state["n"] == 0:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.min("v").alias("m"))
        smallest = smallest.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(smallest, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        smallest = large.groupBy("u").agg(F.min("v").alias("m"))
        edges = stored(
            large.join(smallest, "u")
            .filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smallest.withColumnRenamed("m", "v"))
            .distinct()
        )
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots
    ).distinct()
