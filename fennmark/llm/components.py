"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import cut_lineage, written


def _mark(edges: DataFrame) -> tuple:
    """What two equal edge tables have in common: their size and an order-free sum of hashes."""
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # Written, so that the join has plain shuffles on both sides: Spark splits those where a node has very many edges.
    least = written(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = written(down.groupBy("u").agg(F.min("v").alias("m")))
    tied = down.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """edges(u, v) of two longs -> (node, root), root being the least node reachable.

    Only nodes that have an edge to another node appear. Self-loops and repeated edges count once; rows with a
    null end are no edges. Each round is written to the checkpoint folder, so a lost executor costs one round.
    Rounds grow with the logarithm of the longest path, and no neighbourhood is gathered in one row.
    """
    now = cut_lineage(edges.select("u", "v").filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    mark = _mark(now)
    for _ in range(max_rounds):
        if not mark[0]:
            break
        now = cut_lineage(_small_star(_large_star(now)))
        before, mark = mark, _mark(now)
        if mark == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots).distinct()
