"""Usage events: daily activity, sessions, funnels and properties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def daily_activity(events: DataFrame) -> DataFrame:
    """(day, event_type, events, users)."""
    by = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("events"), F.count_distinct("user_id").alias("users"))
    return by.select(F.to_date("w.start").alias("day"), "event_type", "events", "users")


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """(user_id, session_start, last_event, events): runs of events that are the gap apart at most."""
    by = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"), F.max("ts").alias("last_event"))
    return by.select("user_id", F.col("w.start").alias("session_start"), "last_event", "events")


def funnel(events: DataFrame, first: str, then: str) -> DataFrame:
    """(users_first, users_then): users with the first step, and those with the second after their first first."""
    starts = events.filter(F.col("event_type") == first).groupBy("user_id").agg(F.min("ts").alias("began"))
    ends = events.filter(F.col("event_type") == then).groupBy("user_id").agg(F.max("ts").alias("ended"))
    both = starts.join(ends, "user_id", "left")
    return both.agg(F.count("*").alias("users_first"), F.count_if(F.col("ended") > F.col("began")).alias("users_then"))


def property_totals(events: DataFrame, name: str = "k") -> DataFrame:
    """(event_type, events, total): a numeric property of the JSON column props, added up; what is no number counts as none."""
    value = F.get_json_object("props", f"$.{name}").try_cast("bigint")
    return events.groupBy("event_type").agg(F.count(value).alias("events"), F.sum(value).cast("bigint").alias("total"))


def distinct_sketches(events: DataFrame, by: Column, *keys: str, of: str = "user_id", lg_k: int = 12) -> DataFrame:
    """(by, keys..., sketch): a HyperLogLog sketch of the distinct values, a few kilobytes whatever their number. Null values do
    not count; a group of nulls alone has an empty sketch."""
    return events.groupBy(by.alias("by"), *keys).agg(F.hll_sketch_agg(of, lg_k).alias("sketch"))


def merged_distinct(sketches: DataFrame, by: Column, *keys: str) -> DataFrame:
    """(by, keys..., estimate): the distinct values of coarser groups from the sketches of finer ones, without the rows."""
    return sketches.groupBy(by.alias("by"), *keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
