"""Ranks, vector retrieval, rank fusion and context under a budget. Lexical retrieval is in postings.py."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ranked(rows: DataFrame, score: str, key: str = "doc_id", bins: int = 256) -> DataFrame:
    """(key, rank) by falling score, ties by key. Rows are dealt into bins by quantiles of the score, then of the key, numbered
    in each bin, and what stands in the bins before is added, so no task sorts them all; a bin holds more than its share only
    where as many rows have one score and one key."""
    shares = [k / bins for k in range(1, bins)]
    edges = lambda value: F.coalesce(F.array_distinct(F.percentile_approx(value, shares, 100 * bins)), F.array()).alias(f"{value}_edges")
    edged = rows.select(key, score).crossJoin(F.broadcast(rows.agg(edges(score), edges(key))))  # one row
    over = lambda value: F.size(F.filter(f"{value}_edges", lambda e: F.col(value) > e))
    # Odd numbers are scores that equal an edge, which alone may be many; only those are cut by key.
    edge = F.array_contains(f"{score}_edges", F.col(score))
    placed = edged.select(key, score, (-(2 * over(score) + edge.cast("int"))).alias("bin"), F.when(edge, over(key)).otherwise(0).alias("part"))
    inside = F.row_number().over(Window.partitionBy("bin", "part").orderBy(F.desc(score), key))
    counts = placed.groupBy("bin", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("bin", "part").rowsBetween(Window.unboundedPreceding, -1))  # of at most a few bins squared rows
    starts = counts.select("bin", "part", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.withColumn("k", inside).join(F.broadcast(starts), ["bin", "part"]).select(key, (F.col("before") + F.col("k")).cast("bigint").alias("rank"))


def top_k(scores: DataFrame, k: int, doc_id: str = "doc_id", score: str = "score") -> DataFrame:
    """The k best with their rank; ties by id."""
    best = scores.orderBy(F.desc(score), doc_id).limit(k)
    return best.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(score), doc_id)).cast("bigint"))


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", block: int = 2048) -> DataFrame:
    """(query_id, vec_id, cosine, rank): the k nearest vectors of each query, itself aside; a zero vector has cosine 0 to all.

    Vectors and queries are gathered into rows of about `block` vectors by hash of their ids; every block of queries meets
    every block of vectors, in one plan whatever their number, and gives k rows a query, which is what the ranking reads.
    """

    def blocks(rows: DataFrame, name: str) -> DataFrame:
        n = max(1, -(-rows.count() // block))
        dealt = rows.select(F.pmod(F.xxhash64(vec_id), F.lit(n)).alias("b"), F.struct(F.col(vec_id).cast("long").alias("i"), F.col(embedding).alias("e")).alias("v"))
        return dealt.groupBy("b").agg(F.collect_list("v").alias("v")).select(F.col("v.i").alias(f"{name}_ids"), F.flatten("v.e").alias(f"{name}_values"))

    def unit(ids: np.ndarray, values: np.ndarray) -> np.ndarray:
        rows = np.asarray(values, dtype=float).reshape(len(ids), -1)
        norms = np.linalg.norm(rows, axis=1, keepdims=True)
        return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                ids, asked = np.asarray(r.v_ids), np.asarray(r.q_ids)
                scores = np.round(unit(asked, r.q_values) @ unit(ids, r.v_values).T, 6)
                scores[asked[:, None] == ids[None, :]] = -np.inf
                order = np.lexsort((np.broadcast_to(ids, scores.shape), -scores), axis=1)[:, :k]
                found = pd.DataFrame({"query_id": np.repeat(asked, order.shape[1]), "vec_id": ids[order].ravel(), "cosine": np.take_along_axis(scores, order, axis=1).ravel()})
                yield found[found["cosine"] > -np.inf]

    pairs = blocks(vectors, "v").crossJoin(blocks(queries, "q"))  # a stated query set against all rows, in blocks
    found = pairs.mapInPandas(run, "query_id long, vec_id long, cosine double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("cosine"), "vec_id"))
    return found.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= k)


def fuse_ranks(*rankings: DataFrame, key: str = "doc_id", constant: int = 60) -> DataFrame:
    """(key, score): the sum of 1 / (constant + rank) over the rankings."""
    both = rankings[0].select(key, "rank")
    for r in rankings[1:]:
        both = both.unionByName(r.select(key, "rank"))
    return both.groupBy(key).agg(F.round(F.sum(1 / (constant + F.col("rank"))), 9).alias("score"))


def context_under_budget(ranked: DataFrame, budget: int, group: str, size: str = "n_chars", rank: str = "rank", deals: int = 256) -> DataFrame:
    """Of each group, in order of rank, the rows whose sizes (not negative) add up to the budget at most.

    Each group is dealt over tasks first. A row that is beyond the budget among its deal alone is beyond it in all, and so is
    every row behind it; the first such row of a deal is kept, so that the sums of those behind stay beyond the budget too."""
    dealt = ranked.withColumn("deal", F.pmod(F.xxhash64(rank), F.lit(deals)))
    running = lambda *keys: F.sum(size).over(Window.partitionBy(*keys).orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")
    near = dealt.withColumn("running", running(group, "deal")).filter(F.col("running") - F.col(size) <= budget).drop("running", "deal")
    return near.withColumn("running", running(group)).filter(F.col("running") <= budget)
