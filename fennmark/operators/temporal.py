"""Joins in time and windows by value: as-of, interval and trailing-range, by equality of time buckets, never by nested loops.

Times are timestamps with or without zone; both sides of a join have the same kind. A key may be hot: its rows are split by time
bucket, so a task holds the rows of one key in one bucket of time, and only one row a key and bucket is carried on.

Defined results are with each function.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(time: Column) -> Column:
    """A time as a whole number of microseconds since the epoch, the wall clock's where it has no zone."""
    return F.unix_micros(time.cast("timestamp"))


def as_of_join(left: DataFrame, right: DataFrame, key: str, time: str, order: str, carry: list[str], bucket_seconds: int = 86_400, strictly: bool = False) -> DataFrame:
    """left with, of each row, `carry` (prefixed by last_) and the time (last_<time>) of the latest right row of its key that is not
    later, or, if `strictly`, that is earlier. Of right rows of one time the one with the greatest `order` counts.

    Both sides are put together and cut by key and bucket of time. In a bucket the last right row so far is carried forward by a
    window; what a bucket begins with comes from a second window over one row for each key and bucket that has right rows.

    Defined results: a left row without an earlier right row, or with a null key or time, stays with nulls; right rows with a null key
    or time are left out; repeated left rows all stay; empty sides give no rows or nulls; other columns of left pass."""
    cell = lambda t: F.floor(micros(t) / (bucket_seconds * 1_000_000)).cast("bigint")
    held = F.struct(F.col(time).alias("t"), *[F.col(c) for c in carry])
    values = right.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(F.col(key).alias("k"), cell(F.col(time)).alias("cell"), F.col(time).alias("at"), F.col(order).cast("bigint").alias("o"), held.alias("value"), F.lit(None).cast(left.schema).alias("row"))
    asked = left.select(F.col(key).alias("k"), cell(F.col(time)).alias("cell"), F.col(time).alias("at"), F.lit(None).cast("bigint").alias("o"), F.lit(None).cast(values.schema["value"].dataType).alias("value"), F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"))
    # At one time right rows come first, in their order; strictly, they come behind.
    turn = F.col("row").isNotNull() if not strictly else F.col("row").isNull()
    along = Window.partitionBy("k", "cell").orderBy("at", turn, "o").rowsBetween(Window.unboundedPreceding, 0)
    near = values.unionByName(asked).withColumn("near", F.last("value", ignorenulls=True).over(along)).filter("row is not null")
    ends = values.groupBy("k", "cell").agg(F.max_by("value", F.struct("at", "o")).alias("end"))
    # The carry: what stood at the end of the bucket with right rows before. One row a key and bucket is sorted, not the events.
    starts = near.select("k", "cell").distinct().join(ends, ["k", "cell"], "full")
    before = F.last("end", ignorenulls=True).over(Window.partitionBy("k").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    carried = starts.select("k", "cell", before.alias("carried")).filter("carried is not null")
    found = near.join(carried, ["k", "cell"], "left").withColumn("found", F.coalesce("near", "carried"))
    return found.select("row.*", F.col("found.t").alias(f"last_{time}"), *[F.col(f"found.{c}").alias(f"last_{c}") for c in carry])


def interval_join(points: DataFrame, spans: DataFrame, time: str, start: str, end: str, bin_seconds: int = 3600, on: Column | None = None) -> DataFrame:
    """Every point with every span [start, end] that holds it and fulfils `on`; columns of points, then of spans, whose names must differ.

    A span is repeated for each time bin that it touches, a point has one bin; they meet by equality of bins, and then the exact
    condition decides, so each pair is found once. A bin should be about as long as a usual span.

    Defined results: nulls in a time meet nothing, as do spans that end before they start; both ends count; repeated
    rows all meet; empty sides give no rows."""
    cell = lambda t: F.floor(micros(t) / (bin_seconds * 1_000_000)).cast("bigint")
    whole = spans.filter(F.col(start) <= F.col(end)).withColumn("bin", F.explode(F.sequence(cell(F.col(start)), cell(F.col(end)))))
    placed = points.filter(F.col(time).isNotNull()).withColumn("bin", cell(F.col(time)))
    inside = (F.col(time) >= F.col(start)) & (F.col(time) <= F.col(end))
    return placed.join(whole, "bin").filter(inside if on is None else inside & on).drop("bin")


def trailing(rows: DataFrame, key: str, time: str, seconds: int, **sums: Column) -> DataFrame:
    """rows with each of `sums`, an aggregate, over the rows of the key within `seconds` up to and with the row's own time.

    A frame by value: rows of equal time count for each other, and a gap in time leaves rows out, however many rows lie between.
    Defined results: rows without a time see one another alone, as do those without a key; repeated rows all count."""
    frame = Window.partitionBy(key).orderBy(micros(F.col(time))).rangeBetween(-seconds * 1_000_000, Window.currentRow)
    return rows.withColumns({name: value.over(frame) for name, value in sums.items()})


def trailing_counts(rows: DataFrame, key: str, time: str, seconds: int, value: str, *passed: str) -> DataFrame:
    """(passed..., key, time, n, total) of each row as trailing() counts rows and adds up `value`, with hot keys split by time.

    Time is cut into buckets as long as the trailing window, so a row sees its own bucket and the one before: each bucket is sent
    to the next one too, and no task sorts a key's whole history."""
    width = seconds * 1_000_000
    at = rows.select(*passed, F.col(key), F.col(time), F.col(value).alias("value"), micros(F.col(time)).alias("us"))
    own = F.floor(F.col("us") / width).cast("bigint")
    sent = at.withColumn("to", F.explode(F.array(F.struct(own.alias("cell"), F.lit(False).alias("halo")), F.struct((own + 1).alias("cell"), F.lit(True).alias("halo")))))
    frame = Window.partitionBy(key, "to.cell").orderBy("us").rangeBetween(-width, Window.currentRow)
    return sent.withColumns({"n": F.count("*").over(frame), "total": F.sum("value").over(frame)}).filter("not to.halo").select(*passed, key, time, "n", "total")
