"""Lloyd's clustering of integer vectors, nearest centroids by the threshold algorithm.

Each component has a list of the centroids sorted by their value there. From
a vector's own value the lists are walked outward, one centroid of each list
at a time; a centroid met for the first time gets its exact distance. No
centroid that is still unseen can be nearer than the sum of the squared
distances at the lists' frontiers, so the walk stops when that sum strictly
exceeds the best exact distance: centroids at the same distance are all met,
and the smallest number wins.

A round is one pass over the stored vectors. Tasks send exact partial sums,
one row for each batch, cluster and component; only the new centroids, as
many numbers as clusters times components, reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.common import map_batches, stored

SCALE, DIMENSIONS, CLUSTERS, ROUNDS, SEED = 1024, 64, 8, 10, 3
#: Below this size of components, squared distances fit in 64 bits.
SMALL = 1 << 27
LONG = (1 << 63) - 1
_BATCH = 4096


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each vector's nearest centroid.

    Both arrays hold integers, one row a vector; of object type where squares
    exceed 64 bits.
    """
    n, k = len(vectors), len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable").T  # a list of centroids for each component
    values = np.take_along_axis(centroids.T, order, axis=1)
    best = np.zeros(n, np.int64)
    distance = np.full(n, 1 << 200 if vectors.dtype == object else LONG, vectors.dtype)  # beyond any
    met = np.zeros((n, k), bool)
    right = np.stack([np.searchsorted(v, x) for v, x in zip(values, vectors.T, strict=True)], axis=1)
    left, active, lists = right - 1, np.arange(n), np.arange(len(order))
    for step in range(k):
        if not len(active):
            break
        x, lo, hi = vectors[active], left[active], right[active]
        below = x - values[lists, np.maximum(lo, 0)]
        above = values[lists, np.minimum(hi, k - 1)] - x
        down = (lo >= 0) & ((hi >= k) | (below <= above))
        seen = order[lists, np.where(down, lo, hi)]
        frontier = np.where(down, below, above)
        left[active], right[active] = lo - down, hi + ~down
        new = np.zeros((len(active), k), bool)
        np.put_along_axis(new, seen, True, axis=1)
        new &= ~met[active]
        met[active] |= new
        for c in np.flatnonzero(new.any(axis=0)):  # by number, so that the first of equal distances stays
            rows = active[new[:, c]]
            gap = vectors[rows] - centroids[c]
            exact = (gap * gap).sum(axis=1)
            old = distance[rows]
            nearer = ((exact < old) | ((exact == old) & (c < best[rows]))).astype(bool)
            best[rows[nearer]], distance[rows[nearer]] = c, exact[nearer]
        bound = (frontier * frontier).sum(axis=1)
        active = active[~(bound > distance[active]).astype(bool)]
    return best, distance


def _assigned(ints: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Clusters and distances; distances beyond 64 bits stand at the limit of long."""
    best, distance = np.zeros(len(ints), np.int64), np.zeros(len(ints), np.int64)
    wide = max((abs(v) for c in centroids for v in c), default=0) >= SMALL
    large = np.full(len(ints), wide) | (ints >= SMALL).any(axis=1) | (ints <= -SMALL).any(axis=1)
    for some, kind in ((~large, np.int64), (large, object)):
        if some.any():
            near, far = nearest(ints[some].astype(kind), np.array(centroids, dtype=kind))
            best[some], distance[some] = near, np.minimum(far, LONG).astype(np.int64)
    return best, distance


def _batches(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for frame in frames:
        for i in range(0, len(frame), _BATCH):
            part = frame.iloc[i:i + _BATCH]
            yield part, np.stack(part["ints"].to_numpy()).astype(np.int64)


def _sums(centroids: list[list[int]]):
    """Partial sums of a batch, in two limbs of 32 bits, which cannot overflow."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, ints in _batches(frames):
            best, _ = _assigned(ints, centroids)
            rows = [(c, int(mine.sum()), (ints[mine] >> 32).sum(axis=0), (ints[mine] & 0xFFFFFFFF).sum(axis=0))
                    for c in np.unique(best) for mine in [best == c]]
            yield pd.DataFrame(rows, columns=["cluster", "n", "high", "low"])
    return run


def _labels(centroids: list[list[int]]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, ints in _batches(frames):
            best, distance = _assigned(ints, centroids)
            yield pd.DataFrame({"vec_id": part["vec_id"], "cluster": best, "distance": distance})
    return run


def integers(vectors: DataFrame, id_col: str, vector_col: str, dimensions: int) -> DataFrame:
    """vec_id, ints of the vectors with ``dimensions`` finite components.

    floor(SCALE * x) as long; products beyond its limits stand at the limits.
    """
    x = F.col("_vector")
    scaled = F.transform(x, lambda v: F.floor(v * F.lit(float(SCALE))))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return (vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("_vector"))
            .where((F.size("_vector") == dimensions) & ~bad).select("vec_id", scaled.alias("ints")))


def _start(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    draw = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(draw.asc_nulls_last(), "ints").limit(k).select("ints").collect()  # k rows
    return [list(r["ints"]) for r in rows]


def _moved(kept: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """Floor of the mean of each cluster; an empty cluster's centroid stays."""
    sums = map_batches(kept, _sums(centroids), "cluster long, n long, high array<long>, low array<long>")
    wide = "decimal(38,0)"
    rows = (sums.select("cluster", "n", F.posexplode(F.arrays_zip("high", "low")).alias("d", "z"))
            .groupBy("cluster", "d").agg(F.sum("n").alias("n"), F.sum(F.col("z.high").cast(wide)).alias("high"),
                                         F.sum(F.col("z.low").cast(wide)).alias("low")).collect())
    out = [list(c) for c in centroids]
    for r in rows:  # clusters x components
        out[r["cluster"]][r["d"]] = ((int(r["high"]) << 32) + int(r["low"])) // r["n"]
    return out


def _long_sum(col: str) -> Column:
    return F.least(F.sum(F.col(col).cast("decimal(38,0)")), F.lit(LONG).cast("decimal(38,0)")).cast("long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = CLUSTERS,
            dimensions: int = DIMENSIONS, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Keeps the vectors with ``dimensions`` components, none null or not
    finite, as integers (``integers``). The first centroids are the ``k``
    kept vectors with the smallest sha256 of ``<seed>:<vec_id>``; equal ids
    follow their vectors, null ids come last. Fewer kept vectors than ``k``
    give as many clusters. Repeated rows are clustered each. Distances and
    inertias beyond 64 bits stand at the limit of long; assignments use the
    exact numbers. Other columns are ignored; an empty table gives no rows.
    """
    kept = stored(integers(vectors, id_col, vector_col, dimensions), "vectors")
    centroids = _start(kept, k, seed)
    schema = "vec_id long, cluster long, distance long"
    if not centroids:
        return kept.selectExpr("vec_id", "0 AS cluster", "0L AS distance", "0L AS cluster_inertia", "0L AS inertia",
                               "'' AS centroid_sha256").limit(0)
    for _ in range(rounds):
        moved = _moved(kept, centroids)
        if moved == centroids:  # the next rounds would repeat it
            break
        centroids = moved
    labelled = stored(map_batches(kept, _labels(centroids), schema), "clusters")
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    names = vectors.sparkSession.createDataFrame(list(enumerate(digests)), "cluster long, centroid_sha256 string")
    sizes = labelled.groupBy("cluster").agg(_long_sum("distance").alias("cluster_inertia"))
    total = labelled.agg(_long_sum("distance").alias("t")).first()["t"]
    return (labelled.join(F.broadcast(sizes.join(F.broadcast(names), "cluster")), "cluster")  # k rows
            .select("vec_id", F.col("cluster").cast("int").alias("cluster"), "distance", "cluster_inertia",
                    F.lit(total).cast("long").alias("inertia"), "centroid_sha256"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def _sql_round(r: int) -> str:
    """CTEs that assign the kept vectors to the centroids c{r} and move them to c{r+1}."""
    return f"""
n{r} AS (
  SELECT i, arg_min(c, (distance, c)) AS c, min(distance) AS distance
  FROM (SELECT v.i, c.c, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
        FROM flat v JOIN c{r} c ON v.d = c.d GROUP BY v.i, c.c)
  GROUP BY i
), m{r} AS (
  SELECT n.c, v.d, sum(v.x)::BIGINT AS s, count(*) AS n FROM n{r} n JOIN flat v ON n.i = v.i GROUP BY n.c, v.d
), c{r + 1} AS (
  SELECT o.c, o.d, coalesce((m.s - ((m.s % m.n) + m.n) % m.n) // m.n, o.x) AS x
  FROM c{r} o LEFT JOIN m{r} m ON o.c = m.c AND o.d = m.d
),"""


OP13_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS i, vec_id, [floor({SCALE} * e::DOUBLE)::BIGINT for e in embedding] AS ints
  FROM embeddings
  WHERE len(embedding) = {DIMENSIONS} AND len([e for e in embedding if e IS NOT NULL AND isfinite(e)]) = {DIMENSIONS}
), flat AS MATERIALIZED (
  SELECT i, unnest(range({DIMENSIONS})) AS d, unnest(ints) AS x FROM kept
), first AS (
  SELECT i, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id) NULLS LAST, ints) - 1 AS c FROM kept
), c0 AS (SELECT f.c, v.d, v.x FROM first f JOIN flat v ON f.i = v.i WHERE f.c < {CLUSTERS}),
{''.join(_sql_round(r) for r in range(ROUNDS + 1)).rstrip(',').replace(' AS (', ' AS MATERIALIZED (')},
named AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM c{ROUNDS} GROUP BY c
), inertias AS (SELECT c, sum(distance)::BIGINT AS cluster_inertia FROM n{ROUNDS} GROUP BY c)
SELECT k.vec_id, n.c::INTEGER AS cluster, n.distance, s.cluster_inertia,
  (SELECT sum(distance)::BIGINT FROM n{ROUNDS}) AS inertia, h.centroid_sha256
FROM n{ROUNDS} n JOIN kept k USING (i) JOIN inertias s ON n.c = s.c JOIN named h ON n.c = h.c
"""
