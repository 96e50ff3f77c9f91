"""Ball k-means: exact Lloyd rounds that compare a vector only with the centroids its ball has to do with.

A cluster's members in a batch of rows are a ball: its centroid, and the distance of its farthest member as radius. A
centroid is a neighbour where it is at most two radii from the ball's own; centroids farther off can be nearest to no member.
Members nearer to their centroid than half the distance to the nearest neighbour are the stable core and stay. The others lie
in annuli between the half distances to the first, second, ... neighbour, and a member of the m-th annulus is compared with
the first m neighbours only. All of it is in whole numbers, so rounds, ties and centroids are exact: 4 |x - c|^2 against
|c - d|^2 for half distances, floor of sum over count for centroids.

A round writes the vectors with their clusters to the checkpoint folder, so a lost executor costs one round. The driver
holds the centroids and their sums alone, k rows.

Defined results: null vectors, vectors of another length and those with a null or non-finite component are left out; repeated
rows and rows of one id are each assigned; a row without an id is assigned too but comes last as a first centroid; fewer
vectors than k give as many centroids; an empty table gives an empty table; ties go to the centroid of smaller number; further
columns are ignored. Components of such a size that squares would not be exact are an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import cut_lineage
from fennmark.llm.vectors import EXACT, floored, is_clean, largest, lists, matrix, squared

Centroids = list[list[int]]


def whole_vectors(vectors: DataFrame, dims: int, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v): the clean vectors of `dims` components as whole numbers."""
    v = F.col(f"`{embedding}`")
    kept = vectors.filter((F.size(v) == dims) & is_clean(v))
    return kept.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), floored(v, scale).alias("v"))


def first_centroids(rows: DataFrame, k: int, order: Column) -> Centroids:
    """The vectors of the k least `order`, nulls last; rows that are still alike go by their components."""
    return [r["v"] for r in rows.orderBy(order.asc_nulls_last(), "v").limit(k).select("v").collect()]


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each point by comparison with all."""
    found = squared(points, centroids)
    best = found.argmin(axis=1)
    return best, found[np.arange(len(points)), best]


def reassigned(points: np.ndarray, before: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of each point, whose former cluster is `before`; and how many distances were computed."""
    best, distance = before.copy(), ((points - centroids[before]) ** 2).sum(axis=1)
    apart, computed = squared(centroids, centroids), len(points)
    for own in np.unique(before).tolist():
        members = np.flatnonzero(before == own)
        radius = distance[members].max()
        order = np.argsort(apart[own], kind="stable")
        neighbours = order[(apart[own][order] <= 4 * radius) & (order != own)]
        # The annulus of a member: how many neighbours are at most twice as far from the centroid as it is.
        annulus = np.searchsorted(apart[own][neighbours], 4 * distance[members], side="right")
        for m in np.unique(annulus[annulus > 0]).tolist():
            ring = members[annulus == m]
            others = np.sort(neighbours[:m])
            found = squared(points[ring], centroids[others])
            computed += found.size
            at = found.argmin(axis=1)
            least = found[np.arange(len(ring)), at]
            moves = (least < distance[ring]) | ((least == distance[ring]) & (others[at] < own))
            best[ring[moves]], distance[ring[moves]] = others[at[moves]], least[moves]
    return best, distance, computed


def assign(rows: DataFrame, centroids: Centroids) -> DataFrame:
    """(vec_id, v, cluster, distance) of rows (vec_id, v), by their balls where they have a cluster already."""
    held = np.array(centroids, dtype=np.float64)
    known = "cluster" in rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = matrix(batch.column(1), held.shape[1])
            if known:
                cluster, distance, _ = reassigned(points, batch.column(2).to_numpy().astype(np.int64), held)
            else:
                cluster, distance = nearest(points, held)
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(points), pa.array(cluster, pa.int32()), pa.array(distance.astype(np.int64))], ["vec_id", "v", "cluster", "distance"])

    return rows.select("vec_id", "v", *(["cluster"] if known else [])).mapInArrow(run, "vec_id long, v array<bigint>, cluster int, distance long")


def moved(assigned: DataFrame, centroids: Centroids) -> Centroids:
    """The centroids as floor(sum / count) of their members; those without members stay. Batches are summed up first."""
    dims = len(centroids[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points, cluster = matrix(batch.column(0), dims).astype(np.int64), batch.column(1).to_numpy()
            found = np.unique(cluster)
            sums = np.stack([points[cluster == c].sum(axis=0) for c in found]) if len(found) else np.empty((0, dims))
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int32()), pa.array([int((cluster == c).sum()) for c in found], pa.int64()), lists(sums)], ["cluster", "n", "sums"])

    parts = assigned.select("v", "cluster").mapInArrow(run, "cluster int, n long, sums array<bigint>")
    totals = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.get("sums", F.lit(k))) for k in range(dims)]).alias("sums"))
    out = [list(c) for c in centroids]
    for r in totals.collect():
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def ball_kmeans(rows: DataFrame, k: int, rounds: int, order: Column) -> tuple[DataFrame, Centroids]:
    """(vec_id, v, cluster, distance) of rows (vec_id, v) after `rounds` rounds of assigning and moving and a last assigning,
    and the centroids. Vectors all have one length."""
    rows = cut_lineage(rows)
    centroids = first_centroids(rows, k, order)
    if not centroids:
        return rows.select("vec_id", "v", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), []
    most = rows.agg(F.max(largest("v"))).first()[0]
    if len(centroids[0]) * (2 * most + 1) ** 2 * 4 >= EXACT:
        raise ValueError(f"components of {most} in size are too large for exact squared distances")
    for _ in range(rounds):
        rows = cut_lineage(assign(rows, centroids))
        centroids = moved(rows, centroids)
    return cut_lineage(assign(rows, centroids)), centroids


def described(assigned: DataFrame, centroids: Centroids) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    spark = assigned.sparkSession
    digests = [(k, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for k, c in enumerate(centroids)]
    sums = {r["cluster"]: r["s"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    held = spark.createDataFrame([(k, sums.get(k, 0), sum(sums.values()), digest) for k, digest in digests], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(held), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")  # k rows
