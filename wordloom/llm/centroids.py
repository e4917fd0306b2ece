"""Centroid clustering by equal-average equal-variance search."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import schema_of, stored
from wordloom.llm.vectors import as_matrix, integer_vectors


class Search:
    """Nearest centroids, exact in whole numbers.

    For vectors x and c of d components with means m and deviations s (the length of what
    is left without the mean), ``|x - c|^2 >= d (m_x - m_c)^2 + (s_x - s_c)^2``. Centroids
    lie in the order of their means. A vector starts between the two whose means enclose
    its own and walks outward, the nearer mean first: once the first term alone is larger
    than the best distance, all that is farther out is; a centroid for which both terms
    together are larger is passed over; for the others the distance is computed.
    """

    def __init__(self, centroids: np.ndarray):
        sums = centroids.sum(axis=1)
        self.order = np.argsort(sums, kind="stable")
        self.centroids = centroids[self.order]
        self.sums = sums[self.order]
        self.deviations = _deviations(self.centroids)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """For every row the number of the nearest centroid (the smallest of equally near
        ones) and the squared distance; and how many distances were computed."""
        n, d = x.shape
        k = len(self.sums)
        sums, deviations = x.sum(axis=1), _deviations(x)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, k)
        above = np.searchsorted(self.sums, sums)
        below = above - 1
        walking = np.arange(n)
        computed = 0
        while len(walking):
            low, high = below[walking], above[walking]
            own = sums[walking]
            to_low = np.where(low >= 0, np.abs(own - self.sums[np.maximum(low, 0)]), np.inf)
            to_high = np.where(high < k, np.abs(own - self.sums[np.minimum(high, k - 1)]), np.inf)
            down = to_low <= to_high
            gap = np.minimum(to_low, to_high)
            # Strictly larger, with room for rounding: equal distances are compared.
            goes_on = gap * gap <= best[walking].astype(float) * d * (1 + 1e-12)
            goes_on &= np.isfinite(gap)
            walking, down, gap = walking[goes_on], down[goes_on], gap[goes_on]
            place = np.where(down, below[walking], above[walking])
            below[walking] -= down
            above[walking] += ~down
            spread, other = deviations[walking], self.deviations[place]
            bound = gap * gap / d + (spread - other) ** 2
            near = bound <= best[walking].astype(float) * (1 + 1e-12) + 1e-6 * (1 + spread + other)
            rows, place = walking[near], place[near]
            off = x[rows] - self.centroids[place]
            distance = (off * off).sum(axis=1)
            computed += len(rows)
            named = self.order[place]
            better = (distance < best[rows]) | ((distance == best[rows]) & (named < number[rows]))
            best[rows[better]] = distance[better]
            number[rows[better]] = named[better]
        return number, best, computed


def _deviations(x: np.ndarray) -> np.ndarray:
    off = x - x.mean(axis=1, keepdims=True)
    return np.sqrt((off * off).sum(axis=1))


def first_centroids(vectors: DataFrame, k: int, seed: int, dimensions: int) -> np.ndarray:
    """The ``k`` vectors with the smallest hash of seed and id; equal ids by their vectors."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_id").cast("string"), F.lit("null")))
    first = vectors.orderBy(F.sha2(text, 256), "_x").limit(k).select("_x").toArrow()
    return as_matrix(first.column("_x").combine_chunks(), dimensions)


def moved(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: the floor of the mean of those nearest to each; one to
    which none is nearest stays. A task sends one row of sums per centroid and dimension."""
    k, dimensions = centroids.shape
    search = Search(centroids)

    def add(batches):
        sums = np.zeros((k, dimensions), dtype=np.int64)
        counts = np.zeros(k, dtype=np.int64)
        for batch in batches:
            x = as_matrix(batch.column("_x"), dimensions)
            if not len(x):
                continue
            number, _, _ = search.nearest(x)
            order = np.argsort(number, kind="stable")
            found, begins, n = np.unique(number[order], return_index=True, return_counts=True)
            sums[found] += np.add.reduceat(x[order], begins, axis=0)
            counts[found] += n
        used = np.flatnonzero(counts)
        cluster, dimension = np.repeat(used, dimensions), np.tile(np.arange(dimensions), len(used))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(cluster, pa.int32()),
                pa.array(dimension, pa.int32()),
                pa.array(sums[used].reshape(-1)),
                pa.array(np.repeat(counts[used], dimensions)),
            ],
            names=["cluster", "dimension", "total", "n"],
        )

    parts = vectors.select("_x").mapInArrow(add, "cluster int, dimension int, total long, n long")
    exact = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    # One row per centroid and dimension, whatever the number of vectors.
    sums = parts.groupBy("cluster", "dimension").agg(exact, F.sum("n").alias("n")).toArrow()
    after = centroids.copy()
    for row in sums.to_pylist():
        after[row["cluster"], row["dimension"]] = int(row["total"]) // row["n"]
    return after


def cluster_vectors(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    seed: int = 1,
    dimensions: int = 64,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector.

    Components become whole numbers ``floor(scale * c)``. The first centroids are the ``k``
    vectors with the smallest SHA-256 of ``seed:id``, of which there are fewer if there are
    fewer vectors. Every round assigns each vector to the nearest centroid by
    :class:`Search` and moves centroids to the floor of the mean; after the last round
    vectors are assigned once more. All arithmetic on distances and means is exact.

    Vectors that are null, of another length, or have a component that is null, not finite
    or of 2^27 or more after scaling, have no row. Rows that repeat an id are vectors of
    their own, null ids hash as ``null``; an empty table gives an empty result; other
    columns are not read. Nothing but sums per task is shuffled, so copies of a vector or
    a large cluster do not gather anywhere; the driver holds ``k`` centroids.
    """
    rows = stored(integer_vectors(vectors, dimensions, scale, id_column, vector_column))
    centroids = first_centroids(rows, k, seed, dimensions)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(rows, centroids)
    search = Search(centroids)

    def assign(batches):
        for batch in batches:
            number, distance, _ = search.nearest(as_matrix(batch.column("_x"), dimensions))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), pa.array(number, pa.int32()), pa.array(distance)],
                names=["_id", "cluster", "distance"],
            )

    schema = schema_of(rows, ["_id"], cluster="int", distance="long")
    assigned = stored(rows.mapInArrow(assign, schema))
    inertia = F.sum("distance").alias("cluster_inertia")
    totals = assigned.groupBy("cluster").agg(inertia).collect()  # at most k rows
    whole = sum(row["cluster_inertia"] for row in totals)
    facts = vectors.sparkSession.createDataFrame(
        [
            (
                row["cluster"],
                row["cluster_inertia"],
                whole,
                hashlib.sha256(",".join(map(str, centroids[row["cluster"]].tolist())).encode()).hexdigest(),
            )
            for row in totals
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(facts), "cluster").select(
        F.col("_id").alias(id_column),
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        "centroid_sha256",
    )


def check_sql(k: int = 16, rounds: int = 3, seed: int = 1, dimensions: int = 64, scale: int = 64) -> str:
    """The same for the table ``embeddings``, comparing every vector with every centroid."""
    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id,
    list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY hash, v) - 1 AS cluster, v AS c
  FROM (SELECT sha256('{seed}:' || coalesce(CAST(vec_id AS VARCHAR), 'null')) AS hash, v FROM kept
        ORDER BY hash, v LIMIT {k}))"""
    ]
    for turn in range(rounds + 1):
        steps.append(
            f"""a{turn} AS MATERIALIZED (
  SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(cluster, (distance, cluster)) AS cluster,
    min(distance) AS distance
  FROM (SELECT row, vec_id, v, cluster, CAST(list_sum(list_transform(list_zip(v, c),
          lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS distance
        FROM kept CROSS JOIN c{turn})
  GROUP BY row)"""
        )
        if turn < rounds:
            steps.append(
                f"""c{turn + 1} AS MATERIALIZED (
  SELECT c{turn}.cluster, coalesce(m.c, c{turn}.c) AS c
  FROM c{turn} LEFT JOIN (
    SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY dimension) AS c
    FROM (SELECT cluster, dimension, sum(x) AS s, count(*) AS n
          FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS dimension FROM a{turn})
          GROUP BY cluster, dimension)
    GROUP BY cluster) m USING (cluster))"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f"""
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance,
  CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (cluster)"""
    )
