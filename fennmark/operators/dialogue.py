"""Dialogues: whole threads, recent context and who spoke before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def threads(turns: DataFrame) -> DataFrame:
    """(conv_id, turns, thread): a thread's turns in order, as lines `role: text`."""
    gathered = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    lines = F.transform("t", lambda t: F.concat(t["role"], F.lit(": "), t["text"]))
    return gathered.select("conv_id", F.size("t").cast("bigint").alias("turns"), F.array_join(lines, "\n").alias("thread"))


def recent_context(turns: DataFrame, n: int = 3) -> DataFrame:
    """(conv_id, turn, context_turns, context_chars): what a turn and the n - 1 before it hold."""
    frame = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(1 - n, 0)
    return turns.select("conv_id", "turn", F.count("*").over(frame).alias("context_turns"), F.sum(F.length("text")).over(frame).cast("bigint").alias("context_chars"))


def previous_speaker(turns: DataFrame) -> DataFrame:
    return turns.select("conv_id", "turn", "role", F.lag("role").over(Window.partitionBy("conv_id").orderBy("turn")).alias("previous_role"))
