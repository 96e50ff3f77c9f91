"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly over a fixed number of shards.

A group (equal texts) goes where the dot product of its size vector with the shard's residual capacity is highest. Groups
over a 64th of a shard are few whatever the input's size (at most 64 x shards for each dimension), so the driver places
them first, each whole where it fits; one that fits nowhere is split by a hash of its rows. All other groups are dealt by
hash into blocks of bounded size, one row a group however many documents it has, and each block fills its part of the
capacity that the large groups left. Slots are numbered in blocks of bounded size too, with what stands before each added.
Only ids, sizes and digests are shuffled, never texts.

Defined results: a null text is empty and counts as equal to an empty one; a very long text is a large group; repeated rows each
get a slot, also where ids are null; ties go to the least shard; an empty table gives an empty table; further columns are
ignored.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fennmark.llm.common import cut_lineage, whole, written

DIMENSIONS = ("size", "tokens", "n")
#: What a balanced byte is worth against a token or a row, each as a share of the shard's capacity.
WEIGHTS = np.array([4.0, 1.0, 1.0])
LARGE, CHUNKS, BLOCK_ROWS = 1 / 64, 8, 4096
#: How far over its capacity a shard may go for a group to stay whole.
OVER = 0.002


def place(items: np.ndarray, residual: np.ndarray, capacity: np.ndarray, fit: bool = False) -> np.ndarray:
    """Shard of each item (rows of sizes), largest first; residual (shards x dimensions) is used up in place. With fit, an item
    that has no room in any shard is left out and gets -1."""
    scale = WEIGHTS / np.maximum(capacity, 1e-9) ** 2
    order = np.argsort(-(items / np.maximum(capacity, 1e-9)).max(axis=1), kind="stable")
    out = np.full(len(items), -1, dtype=np.int64)
    for k in order:
        value = residual @ (items[k] * scale)
        if fit:
            value[(residual + OVER * capacity < items[k]).any(axis=1)] = -np.inf
        shard = int(np.argmax(value))
        if value[shard] > -np.inf:
            residual[shard] -= items[k]
            out[k] = shard
    return out


def token_estimate(text: Column) -> Column:
    """Words: one more than the runs' white-space characters."""
    return (F.length(text) - F.length(F.translate(text, " \n\t\r", "")) + 1).cast("long")


def shard_documents(docs: DataFrame, shards: int = 40, doc_id: str = "doc_id", text: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): size is UTF-8 bytes plus 16; slots count from 0 in each shard."""
    held = whole(text)
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.octet_length(held) + 16).cast("long").alias("size"),
        token_estimate(held).alias("tokens"),
        F.crc32(held.cast("binary")).alias("crc"),
        F.unhex(F.substring(F.sha2(held, 256), 1, 32)).alias("key"),
    )
    rows = cut_lineage(rows).withColumn("row", F.monotonically_increasing_id())  # of a checkpoint, so it stays the same
    spark = rows.sparkSession
    totals = rows.agg(F.sum("size"), F.sum("tokens"), F.count("*")).first()
    capacity = np.array([x or 0 for x in totals], dtype=float) / shards
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("n")]
    groups = rows.groupBy("key").agg(*sums)
    over = " or ".join(f"{d} > {float(c * LARGE)!r}D" for d, c in zip(DIMENSIONS, capacity, strict=True))
    sized = lambda found: np.array([[r[d] for d in DIMENSIONS] for r in found], dtype=float).reshape(-1, len(DIMENSIONS))
    large = sorted(groups.filter(over).collect(), key=lambda r: bytes(r["key"]))
    residual = np.tile(capacity, (shards, 1))
    at = place(sized(large), residual, capacity, fit=True)
    fixed = [(bytes(r["key"]), 0, int(p)) for r, p in zip(large, at, strict=True) if p >= 0]
    ratio = (sized(large) / np.maximum(capacity, 1e-9)).max(axis=1, initial=0)
    split = [(bytes(r["key"]), int(np.ceil(x * CHUNKS)) + 1) for r, p, x in zip(large, at, ratio, strict=True) if p < 0]
    kinds = F.broadcast(spark.createDataFrame([*((k, 1) for k, _, _ in fixed), *split], "key binary, k long"))
    rows = rows.join(kinds, "key", "left").withColumn("chunk", F.pmod(F.xxhash64("doc_id", "row"), F.coalesce("k", F.lit(1))))
    if split:
        chunks = sorted(rows.filter("k > 1").groupBy("key", "chunk").agg(*sums).collect(), key=lambda r: (bytes(r["key"]), r["chunk"]))
        fixed += [(bytes(r["key"]), int(r["chunk"]), int(p)) for r, p in zip(chunks, place(sized(chunks), residual, capacity), strict=True)]
    blocks = max(1, ceil((totals[2] or 0) / block_rows))
    room = np.maximum(residual, 0)
    room_share = np.where(room.sum(axis=0) > 0, room / np.maximum(room.sum(axis=0), 1e-9), 1 / shards)

    def fill(of_block: pd.DataFrame) -> pd.DataFrame:
        of_block = of_block.sort_values("key")
        sizes = of_block[list(DIMENSIONS)].to_numpy(dtype=float)
        found = place(sizes, room_share * sizes.sum(axis=0), sizes.sum(axis=0) / shards)
        return pd.DataFrame({"key": of_block["key"], "chunk": 0, "shard": found})

    loose = groups.filter(f"not ({over})").withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks))).groupBy("block").applyInPandas(fill, "key binary, chunk long, shard int")
    # Written, so that the join has plain shuffles on both sides: Spark splits those where a group is large.
    places = written(loose.unionByName(spark.createDataFrame([(k, c, p) for k, c, p in fixed], "key binary, chunk long, shard int")))
    numbered = rows.select("doc_id", "size", "crc", "key", "chunk", "row").join(places, ["key", "chunk"]).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(1, blocks // shards))))
    along = Window.partitionBy("shard", "block").orderBy("doc_id", "crc", "row")
    filled = cut_lineage(numbered.select("doc_id", "size", "crc", "shard", "block", (F.row_number().over(along) - 1).cast("long").alias("at")))
    counts = filled.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return filled.join(starts, ["shard", "block"]).select("doc_id", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("start") + F.col("at")).alias("slot"))
