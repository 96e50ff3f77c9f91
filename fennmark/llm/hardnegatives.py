"""Hard negatives by one-dimensional distance keys: exact top-k inner products from annuli around pivots.

Inner products become distances by one more component: with M the greatest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0)
have |x' - q'|^2 = |q|^2 + M^2 - 2 x.q, so the nearest have the greatest product. Each vector is stored under its nearest
pivot by its distance to it. The table is sorted by (pivot, distance) and cut into annuli, ranges of the distance to one
pivot, and these into chunks of at most `chunk_rows` vectors. By the triangle inequality a query at distance d from the pivot is
at least d - hi or lo - d from all of an annulus [lo, hi]. So a search scans, around every pivot, the key interval
[d - r, d + r], and widens r: while it has too few it doubles the annuli scanned; once it has k, r goes to the k-th distance
and no farther. What was not scanned then lies beyond the k-th, so the result is exact, ties included. A search may ask
for products in a window [low, high] only, which also leaves out the annuli wholly nearer than `high`.

Widening is a loop of Spark joins: the annuli that a block of queries wants next meet the chunks of these annuli, and only
the best k of each pair go on. No join is broadcast, since neither compressed files nor queries that are yet to be sent to all
their annuli show how large they get. Pivots and the ranges of annuli (at most `pivots` x `annuli` numbers) are what the driver
and tasks hold besides; pivots and ranges are learnt from a sample of about `sample` vectors, every vector is stored.

Defined results: rows without id, label or vector, or with a null or non-finite component, take no part; rows alike in id,
label and vector count once, and a row of the anchor's own id is never its partner; shorter vectors count as filled
up with zeros; ties go to the smaller id, then to any of the rows of one id; an empty table or one without anchors gives an empty table; further
columns are ignored. Components too large for exact products are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fennmark.llm.common import cut_lineage, written
from fennmark.llm.vectors import EXACT, floored, is_clean, largest, lists, matrix, squared

#: Products no smaller and no greater.
ANY = 2**62


def whole_rows(vectors: DataFrame, label: Column | None = None, scale: int = 256, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, label, v): the clean rows once each, components as whole numbers; `label` may replace the label."""
    label = F.col("label") if label is None else label
    kept = vectors.filter(F.col(f"`{vec_id}`").isNotNull() & F.col("label").isNotNull() & is_clean(F.col(f"`{embedding}`")))
    return kept.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), label.cast("long").alias("label"), floored(F.col(f"`{embedding}`"), scale).alias("v")).distinct()


def sampled(rows: DataFrame, n: int, sample: int) -> DataFrame:
    """About `sample` of n distinct rows(vec_id, label, v), those whose hash is least, in order of it; all if they are fewer.
    The share is kept row by row, so the driver gets no more than that, whatever the number of tasks (an ordered limit gives it as
    many of each). The label and vector are hashed too, so many rows of one id are not kept or left together."""
    spread = F.xxhash64("vec_id", "label", "v")
    kept = rows if n <= sample else rows.filter(spread < int(-(2**63) + 2**64 * sample / n))
    return kept.orderBy(spread, "vec_id")


class DistanceKeys:
    """The stored table, its pivots and annuli."""

    def __init__(self, rows: DataFrame, pivots: int = 32, annuli: int = 64, chunk_rows: int = 512, sample: int = 4096) -> None:
        n, most, self.dims = rows.agg(F.count("*"), F.coalesce(F.max(largest("v")), F.lit(0)), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
        if max(1, self.dims) * (most + 1) ** 2 * 4 >= EXACT:
            raise ValueError(f"components of {most} in size are too large for exact products")
        self.rows = written(rows.select("vec_id", "label", F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), self.dims - F.size("v"))).alias("v")))
        norm = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
        self.most_norm = float(self.rows.agg(F.coalesce(F.max(norm), F.lit(0))).first()[0])
        chosen = sampled(self.rows, n, sample).select("v").collect()
        learnt = self.lifted(np.array([r["v"] for r in chosen], dtype=np.float64).reshape(len(chosen), self.dims))
        self.pivots = _pivots(learnt, max(1, min(pivots, len(learnt) // 8)))
        nearest, distance = self.keyed(learnt)
        self.edges = []
        for p in range(len(self.pivots)):
            own = distance[nearest == p]
            parts = min(annuli, max(1, round(len(own) / max(1, len(learnt)) * n / chunk_rows)))
            self.edges.append(np.unique(np.quantile(own, np.arange(1, parts) / parts)) if len(own) else np.empty(0))
        self.starts = np.cumsum([0, *(len(e) + 1 for e in self.edges)])
        self.dtype = np.dtype(next(t for t in ("<i2", "<i4", "<i8") if most < np.iinfo(t).max))
        self.chunks = self._store(chunk_rows)
        found = self.chunks.groupBy("annulus").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("n").alias("n")).orderBy("annulus").collect()
        self.annuli = np.array([r["annulus"] for r in found], dtype=np.int64)
        self.pivot_of = np.searchsorted(self.starts, self.annuli, side="right") - 1
        self.lo, self.hi, self.n = (np.array([r[c] for r in found], dtype=np.float64) for c in ("lo", "hi", "n"))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("rows", "chunks")}

    def lifted(self, points: np.ndarray) -> np.ndarray:
        """Points with the component that makes all norms alike."""
        return np.column_stack([points, np.sqrt(np.maximum(self.most_norm - (points**2).sum(axis=1), 0))])

    def keyed(self, lifted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pivot, distance) of each point."""
        found = squared(lifted, self.pivots)
        nearest = found.argmin(axis=1)
        return nearest, np.sqrt(((lifted - self.pivots[nearest]) ** 2).sum(axis=1))

    def annulus(self, pivot: np.ndarray, distance: np.ndarray) -> np.ndarray:
        out = np.empty(len(pivot), dtype=np.int64)
        for p in np.unique(pivot).tolist():
            own = pivot == p
            out[own] = self.starts[p] + np.searchsorted(self.edges[p], distance[own], side="right")
        return out

    def _store(self, chunk_rows: int) -> DataFrame:
        """(annulus, lo, hi, n, ids, labels, v), sorted by (pivot, distance): annuli are numbered in that order."""
        dims, dtype = self.dims, self.dtype

        def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                pivot, distance = self.keyed(self.lifted(matrix(batch.column(2), dims)))
                yield pa.RecordBatch.from_arrays([pa.array(self.annulus(pivot, distance)), pa.array(distance), *batch.columns], ["annulus", "distance", "vec_id", "label", "v"])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                annulus, distance, ids, labels = (batch.column(k).to_numpy() for k in range(4))
                values = matrix(batch.column(4), dims).astype(dtype)
                bounds = [0, *(np.flatnonzero(np.diff(annulus)) + 1).tolist(), len(annulus)]
                spans = [(a, min(a + chunk_rows, b)) for lo, b in zip(bounds, bounds[1:], strict=False) for a in range(lo, b, chunk_rows)]
                columns = [pa.array([int(annulus[a]) for a, _ in spans], pa.int64()), pa.array([float(distance[a]) for a, _ in spans], pa.float64()), pa.array([float(distance[b - 1]) for _, b in spans], pa.float64())]
                columns += [pa.array([b - a for a, b in spans], pa.int64()), *(pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in (ids, labels, values))]
                yield pa.RecordBatch.from_arrays(columns, ["annulus", "lo", "hi", "n", "ids", "labels", "v"])

        keys = written(self.rows.mapInArrow(key, "annulus long, distance double, vec_id long, label long, v array<bigint>"))
        by = ("annulus", "distance", "vec_id")
        return written(keys.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(cut, "annulus long, lo double, hi double, n long, ids binary, labels binary, v binary"))

    def distance_of(self, norm: float, product: float) -> float:
        """The distance that a product stands for, to a query of this squared norm."""
        return float(np.sqrt(max(0.0, norm + self.most_norm - 2 * product)))

    def reach(self, query: np.ndarray, high: float) -> np.ndarray:
        """The least distance at which each annulus may hold something with a product up to `high`; infinite if it cannot."""
        to_pivots = np.sqrt(np.maximum(squared(np.append(query, 0.0)[None, :], self.pivots)[0], 0))[self.pivot_of]
        least = np.maximum(np.maximum(to_pivots - self.hi, self.lo - to_pivots), 0)
        start = self.distance_of(float(query @ query), high)
        return np.where(to_pivots + self.hi < start - _slack(start), np.inf, np.maximum(least, start - _slack(start)))

    def widened(self, query: np.ndarray, high: float, floor: float, full: bool, radius: float, first_rows: int) -> float:
        """The distance up to which a query scans next, `radius` if it has done. floor: the least product it still wants."""
        near = self.reach(query, high)
        rest = np.sort(near[(near > radius) & np.isfinite(near)])
        last = self.distance_of(float(query @ query), floor)
        last += _slack(last)
        if not len(rest) or rest[0] > last:
            return radius
        if full:
            return last
        seen = int((near <= radius).sum())
        rows = np.cumsum(self.n[np.argsort(near, kind="stable")][seen:])
        until = rest[min(len(rest), max(seen, int(np.searchsorted(rows, first_rows)) + 1)) - 1]
        return float(min(until, last))


def _slack(distance: float) -> float:
    """More than what rounding may add to a distance."""
    return 1e-6 * (1 + distance)


def _pivots(points: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k means of the points by Lloyd's rounds, from points that are spread over their order."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    centres = points[np.linspace(0, len(points) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        of = squared(points, centres).argmin(axis=1)
        for c in range(k):
            if (of == c).any():
                centres[c] = points[of == c].mean(axis=0)
    return centres


def search(keys: DistanceKeys, asked: DataFrame, k: int, same_label: bool, block: int = 256, first_rows: int = 2048) -> DataFrame:
    """(anchor_id, slot, vec_id, score): for each row of asked(anchor_id, slot, label, v, low, high) the k rows of the same, or of
    another, label and of another id with the greatest products within [low, high], ties by smaller id. A slot tells
    the searches of one anchor apart."""
    spark = asked.sparkSession
    n = asked.count()
    state = asked.select("anchor_id", "slot", "label", "v", "low", "high", F.pmod(F.xxhash64("anchor_id", "slot"), F.lit(max(1, -(-n // block)))).alias("qb"), F.lit(-1.0).alias("radius"))
    found = spark.createDataFrame([], "anchor_id long, slot int, vec_id long, score long")
    dims, dtype = keys.dims, keys.dtype
    tasks = min(max(1, -(-n // block)), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            get = batch.schema.get_field_index
            queries = matrix(batch.column(get("v")), dims)
            of = [batch.column(get(c)).to_pylist() for c in ("high", "floor", "full", "radius")]
            until = [keys.widened(q, *x, first_rows) for q, *x in zip(queries, *of, strict=True)]
            yield batch.append_column("until", pa.array(until, pa.float64()))

    def visit(group: pa.Table) -> pa.Table:
        queries = matrix(group.column("v").combine_chunks(), dims)
        near = np.stack([keys.reach(q, h) for q, h in zip(queries, group.column("high").to_pylist(), strict=True)])
        radius, until = (group.column(c).to_numpy()[:, None] for c in ("radius", "until"))
        wanted = (near > radius) & (near <= until)
        at = [(int(a), np.flatnonzero(wanted[:, k])) for k, a in enumerate(keys.annuli) if wanted[:, k].any()]
        cells = {c: group.column(c).to_numpy() for c in ("anchor_id", "slot", "label", "floor", "high")} | {"v": queries.astype(dtype)}
        return pa.table({"annulus": pa.array([a for a, _ in at], pa.int64())} | {c: pa.array([x[m].tobytes() for _, m in at], pa.binary()) for c, x in cells.items()})

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                anchor, label, floor, high = (np.frombuffer(r[c], dtype=np.int64) for c in ("anchor_id", "label", "floor", "high"))
                slot, ids, labels = np.frombuffer(r["slot"], dtype=np.int32), np.frombuffer(r["ids"], dtype=np.int64), np.frombuffer(r["labels"], dtype=np.int64)
                points, queries = (np.frombuffer(r[c], dtype=dtype).reshape(n, dims).astype(np.float64) for c, n in (("c_v", len(ids)), ("v", len(anchor))))
                scores = (queries @ points.T).astype(np.int64)
                fits = (scores >= floor[:, None]) & (scores <= high[:, None]) & (anchor[:, None] != ids[None, :]) & ((label[:, None] == labels[None, :]) == same_label)
                q, c = np.nonzero(fits)
                order = np.lexsort((ids[c], -scores[q, c], q))
                q, c = q[order], c[order]
                best = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
                q, c = q[best], c[best]
                out.append((anchor[q], slot[q], ids[c], scores[q, c]))
            parts = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 4
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(parts, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["anchor_id", "slot", "vec_id", "score"])

    chunks = keys.chunks.select("annulus", "ids", "labels", F.col("v").alias("c_v"))
    best = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    while True:
        kth = found.groupBy("anchor_id", "slot").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
        full = F.coalesce(F.col("n") >= k, F.lit(False))
        held = state.hint("merge").join(kth.hint("merge"), ["anchor_id", "slot"], "left").select(*state.columns, F.when(full, F.greatest("low", "kth")).otherwise(F.col("low")).alias("floor"), full.alias("full"))
        kinds = ", ".join(f"{c} {t}" for c, t in held.dtypes)
        wide = cut_lineage(held.mapInArrow(widen, f"{kinds}, until double"))
        ahead = wide.filter("until > radius")
        if ahead.isEmpty():
            return found
        # Few bytes of queries become many of visits, so their blocks are dealt over tasks by count, not by size.
        visits = ahead.repartition(tasks, "qb").groupBy("qb").applyInArrow(visit, "annulus long, anchor_id binary, slot binary, label binary, floor binary, high binary, v binary")
        fresh = visits.hint("merge").join(chunks.hint("merge"), "annulus").mapInArrow(scan, "anchor_id long, slot int, vec_id long, score long")
        found = cut_lineage(found.unionByName(fresh).withColumn("k", F.row_number().over(best)).filter(F.col("k") <= k).drop("k"))
        # A query without anything ahead is done: nothing that it would find later could count.
        state = ahead.select(*[F.col("until").alias(c) if c == "radius" else F.col(c) for c in state.columns])


def mine_hard_negatives(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, **how) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of rows(vec_id, label, v) where `anchors`
    holds: the best `negatives` rows of other labels with a score from least_percent of the positive's up to the positive's."""
    keys = DistanceKeys(rows, **how)
    asked = keys.rows.filter(anchors).select(F.col("vec_id").alias("anchor_id"), F.lit(0).alias("slot"), "label", "v")
    # Rows of one anchor id that differ are anchors of their own.
    many = Window.partitionBy("anchor_id").orderBy("label", "v")
    asked = written(asked.withColumn("slot", F.row_number().over(many).cast("int") - 1))
    own = search(keys, asked.withColumns({"low": F.lit(-ANY), "high": F.lit(ANY)}), positives, same_label=True)
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    own = own.withColumn("k", F.row_number().over(order).cast("int")).select("anchor_id", "slot", "k", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    pairs = written(own.join(asked.hint("merge"), ["anchor_id", "slot"]).withColumn("slot", (F.col("slot") * positives + F.col("k")).cast("int")))
    part = F.col("positive_score") * least_percent
    low = F.floor((part + F.pmod(-part, F.lit(100))) / 100).cast("bigint")  # the least whole number with 100 low >= part
    wanted = pairs.withColumns({"low": low, "high": F.col("positive_score")}).filter("low <= high")
    found = search(keys, wanted, negatives, same_label=False)
    ranked = found.withColumn("rank", F.row_number().over(order).cast("int")).join(pairs.select("anchor_id", "slot", "positive_id", "positive_score").hint("merge"), ["anchor_id", "slot"])
    return ranked.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
