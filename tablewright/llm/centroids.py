"""Centroid clustering in rounds, with bounds tightened by planar geometry.

Every vector keeps its centroid and a lower bound of its distance to all others.  When
centroids have moved, the bound is loosened: not by how far the others drifted, but by how much
a drift can bring a centroid closer to any point of the vector's cluster sphere (the centroid
before the move, and the largest distance in the cluster).  That is a matter of the plane
through the sphere's centre and the drift: seen from the drifting centroid, the sphere fills a
cone, and the drift counts by the cosine of its angle to the nearest side of the cone.  A drift
away from the sphere even raises the bound.  A vector whose exact distance to its own centroid
is below the bound keeps it; only the others are compared with all centroids.

Vectors are integers and distances exact; bounds are rounded outwards, so skipping a vector
never changes a result.  Rounds read and write one table without a shuffle; what is gathered is
a row of sums for each cluster.

Defined results:

* vectors that are null, of another length, or hold null or non-finite components are left out;
* components beyond +-2**27 count as that limit, so that squared distances fit 63 bits;
* repeated rows are vectors of their own; with fewer vectors than clusters each starts one;
* a null key is hashed as no key at all: it can start a cluster only if others are lacking;
* equal distances go to the smaller number; empty clusters keep their centroid;
* sums of distances beyond 63 bits count as the largest number of 63 bits;
* an empty table, or one without usable vectors, gives no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import field, narrowed
from tablewright.shared import fan_out, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LARGEST = 1 << 27
#: Parts of a drift, each judged by the cone at its begin.
PARTS = 8
#: Outward rounding of distances in double precision.
SLACK = 1e-9


def whole_components(vector: Column, scale: int) -> Column:
    """``floor(scale * x)`` of every component."""
    def scaled(x: Column) -> Column:
        bounded = F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))),
                             F.lit(-float(LARGEST)))
        return F.floor(bounded).cast("int")

    return F.transform(vector, scaled)


def usable(vector: Column, dimensions: int) -> Column:
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf"))

    return (F.size(vector) == dimensions) & F.coalesce(F.forall(vector, finite), F.lit(False))


def first_centroids(kept: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """The vectors with the smallest digests of their keys."""
    digest = F.sha2(F.concat(F.lit(salt), F.col("key").cast("string")), 256)
    rows = kept.select("v", digest.alias("digest")).orderBy(
        F.col("digest").asc_nulls_last(), "v").limit(clusters).collect()
    return np.array([r["v"] for r in rows], np.int64)


def squared_distances(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (np.einsum("ij,ij->i", vectors, vectors)[:, None] - 2 * (vectors @ centroids.T)
            + np.einsum("ij,ij->i", centroids, centroids))


def drift_towards(spheres: np.ndarray, radii: np.ndarray, old: np.ndarray,
                  new: np.ndarray) -> np.ndarray:
    """For every sphere (row) how much closer each centroid (column) can come to any of its
    points by moving from ``old`` to ``new``: never more than the drift, negative if it leaves.

    A point at an angle to the drift comes closer by at most its cosine, and that angle only
    grows on the way, as does the angle at which a point of the sphere can be seen at least.
    """
    drift = new - old
    length = np.sqrt((drift ** 2).sum(1))
    closer = np.zeros((len(spheres), len(old)))
    moving = np.flatnonzero(length)
    direction = drift[moving] / length[moving, None]
    for part in range(PARTS):
        at = old[moving] + drift[moving] * (part / PARTS)
        away = np.sqrt(np.maximum(
            (spheres ** 2).sum(1)[:, None] - 2 * spheres @ at.T + (at ** 2).sum(1), 0))
        along = spheres @ direction.T - (at * direction).sum(1)
        outside = away > radii[:, None] * (1 + SLACK) + SLACK
        safe = np.where(outside, away, 1)
        side = (np.arccos(np.clip(along / safe, -1, 1))
                - np.arcsin(np.clip(radii[:, None] / safe, 0, 1)))
        cosine = np.where(outside, np.cos(np.maximum(side, 0)), 1)
        closer[:, moving] += cosine * (length[moving] / PARTS)
    return closer + SLACK * (1 + length)


def loosening(radii: np.ndarray, old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """By cluster, how much the bound on the distance to all other centroids goes down."""
    old, new = old.astype(float), new.astype(float)
    closer = drift_towards(old, radii, old, new)
    np.fill_diagonal(closer, -np.inf)
    worst = closer.max(1)
    return np.where(np.isfinite(worst), worst, 0)


def _assign(centroids: np.ndarray, loose: np.ndarray | None):
    """One round over batches: all vectors at first, then only the ambiguous ones."""

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            vectors = flat.astype(np.int64).reshape(batch.num_rows, -1)
            if loose is None:
                cluster = np.zeros(len(vectors), np.int32)
                distance = np.zeros(len(vectors), np.int64)
                bound, scans = np.zeros(len(vectors)), np.zeros(len(vectors), np.int32)
                open_rows = np.arange(len(vectors))
            else:
                cluster, distance, bound, scans = (
                    batch.column(c).to_numpy(zero_copy_only=False).copy()
                    for c in ("cluster", "distance", "bound", "scans"))
                apart = vectors - centroids[cluster]
                distance = np.einsum("ij,ij->i", apart, apart)
                bound = bound - loose[cluster]
                bound -= SLACK * np.abs(np.where(np.isfinite(bound), bound, 0))
                open_rows = np.flatnonzero(np.sqrt(distance) * (1 + SLACK) + SLACK >= bound)
            if len(open_rows):
                every = squared_distances(vectors[open_rows], centroids)
                best = every.argmin(1)
                cluster[open_rows] = best
                distance[open_rows] = every[np.arange(len(best)), best]
                if len(centroids) > 1:
                    bound[open_rows] = np.sqrt(np.partition(every, 1, axis=1)[:, 1])
                else:
                    bound[open_rows] = np.inf
                scans[open_rows] += 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("v"), pa.array(cluster, pa.int32()),
                 pa.array(distance, pa.int64()), pa.array(bound, pa.float64()),
                 pa.array(scans, pa.int32())],
                names=["key", "v", "cluster", "distance", "bound", "scans"])

    return assigned


def _clusters(state: DataFrame, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Moved centroids and the radii of the clusters around the old ones: a row of sums for
    each cluster, added up by every task before it is sent."""
    sums = [F.sum(F.col("v")[i].cast("long")).alias(f"s{i}") for i in range(centroids.shape[1])]
    rows = state.groupBy("cluster").agg(
        F.count("*").alias("n"), F.max("distance").alias("far"), *sums).collect()
    moved, radii = centroids.copy(), np.zeros(len(centroids))
    for r in rows:
        moved[r["cluster"]] = [r[f"s{i}"] // r["n"] for i in range(centroids.shape[1])]
        radii[r["cluster"]] = np.sqrt(r["far"]) * (1 + SLACK)
    return moved, radii


def cluster(
    df: DataFrame, clusters: int = 40, rounds: int = 5, dimensions: int = 64, scale: int = 256,
    salt: str = "2:", key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(key, cluster, distance, scans, cluster_inertia, inertia, centroid)``: after ``rounds``
    rounds every vector's nearest centroid, squared distance, and in how many of the
    ``rounds + 1`` assignments it was compared with all centroids."""
    spark = df.sparkSession
    named = narrowed(df, key=key, vector=vector)
    kept = written(
        fan_out(named).filter(usable(F.col("vector"), dimensions))
        .select("key", whole_components(F.col("vector"), scale).alias("v")), "vectors")
    schema = (f"{field('key', named.schema['key'].dataType)}, v array<int>, cluster int, "
              "distance long, bound double, scans int")
    centroids = first_centroids(kept, clusters, salt)
    if not len(centroids):
        return kept.select(
            "key", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
            F.lit(0).alias("scans"), F.lit(0).cast("long").alias("cluster_inertia"),
            F.lit(0).cast("long").alias("inertia"), "v").withColumnRenamed("v", "centroid")
    state = written(kept.mapInArrow(_assign(centroids, None), schema), "round")
    for _ in range(rounds):
        moved, radii = _clusters(state, centroids)
        loose = loosening(radii, centroids, moved)
        centroids = moved
        state = written(state.mapInArrow(_assign(centroids, loose), schema), "round")
    # one row a cluster; decimals, since a sum of distances may not fit 63 bits
    sums = {r["cluster"]: int(r["sum"]) for r in state.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(20,0)")).alias("sum")).collect()}
    largest = (1 << 63) - 1
    total = min(sum(sums.values()), largest)
    found = spark.createDataFrame(
        [(number, min(sums.get(number, 0), largest), total, row.tolist())
         for number, row in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid array<int>")
    return state.select("key", "cluster", "distance", "scans").join(
        F.broadcast(found), "cluster").select(  # a row for each cluster
        "key", "cluster", "distance", "scans", "cluster_inertia", "inertia", "centroid")


def centroid_digest(centroid: Column) -> Column:
    """SHA-256 of the components, decimal and joined by commas."""
    return F.sha2(F.array_join(F.transform(centroid, lambda c: c.cast("string")), ","), 256)
