"""Streams of events: without repeats, counted in windows, and as an upserted state. Each runs what is there and ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fennmark.session import table, work_folder


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream, with ts as TIMESTAMP, which watermarks need (the session's time zone is meant to be UTC)."""
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "events*.parquet").parquet(sf_dir)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def without_repeats(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    return stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])


def windowed_counts(stream: DataFrame, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(start, event_type, events) of windows that the watermark has closed."""
    counts = stream.withWatermark("ts", delay).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"))
    return counts.select(F.col("window.start").alias("start"), "event_type", "events")


def run_to_files(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """All that the stream gives, written to the shared folder and read again."""
    folder = work_folder(spark, name)
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


def in_steps(rows: DataFrame, time: str, steps: int, behind: Column | None = None) -> list[DataFrame]:
    """rows as they arrive in `steps` deliveries, by equal parts of their time, and one more; rows where `behind` holds come one delivery after their own."""
    low, high = rows.agg(F.min(F.unix_micros(time)), F.max(F.unix_micros(time))).first()
    width = max(1, -(-((high or 0) - (low or 0) + 1) // steps))
    step = F.floor((F.unix_micros(time) - F.lit(low or 0)) / width) + F.when(F.lit(False) if behind is None else behind, 1).otherwise(0)
    return [rows.filter(step == k) for k in range(steps + 1)]


def run_in_steps(spark: SparkSession, steps: list[DataFrame], build: Callable[[DataFrame], DataFrame], name: str, **settings: str) -> DataFrame:
    """What build(stream) gives where the steps arrive one after another, written to the shared folder and read again. After
    each step the query ends and goes on from its checkpoint, as a scheduled job does; so the watermark of a step is what the
    steps before have left. `settings` hold for the session while the query runs."""
    folder, schema = work_folder(spark, name), steps[0].schema
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for step in steps:
            step.write.mode("append").parquet(f"{folder}/in")
            out = build(spark.readStream.schema(schema).parquet(f"{folder}/in"))
            out.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state").option("path", f"{folder}/out").trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return spark.read.schema(out.schema).parquet(f"{folder}/out")


def window_counts(stream: DataFrame, width: str, slide: str | None = None, delay: str = "1 day") -> DataFrame:
    """(start, events) of the windows that the watermark has closed. Rows count for those of their windows only that were still
    open when they came."""
    counts = stream.withWatermark("ts", delay).groupBy(F.window("ts", width, slide)).agg(F.count("*").alias("events"))
    return counts.select(F.col("window.start").alias("start"), "events")


def with_late(counted: DataFrame, rows: DataFrame, width: str, slide: str | None = None) -> DataFrame:
    """(start, events, late): counted windows beside the number of their rows that came after they were closed."""
    everything = rows.groupBy(F.window("ts", width, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "n")
    return counted.join(everything, "start").select("start", "events", (F.col("n") - F.col("events")).alias("late"))


def session_counts(stream: DataFrame, gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """(user_id, session_start, session_end, events) of the sessions that the watermark has closed. Events up to the gap apart are one."""
    by = stream.withWatermark("ts", delay).groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"))
    return by.select("user_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")


class KeyedState:
    """The row of each key with the greatest order columns, kept up from batch to batch, by partitions of the key's hash.

    state/generation=N/part=P has what batch N made of the partitions that it touched; manifest/generation=N says for each partition
    which generation has its rows. A batch reads the manifest before its own and the partitions of its keys, and writes these alone. A batch that
    is run again reads the same and writes the same over it. When a batch begins, the one before is committed, so what that one
    has replaced is removed.

    Rows with null order columns come before all others; a null key is a key; repeated rows change nothing."""

    def __init__(self, spark: SparkSession, folder: str, schema: StructType, key: str, order: tuple[str, ...], partitions: int = 16) -> None:
        self.spark, self.folder, self.schema, self.key, self.order, self.partitions = spark, folder, schema, key, order, partitions

    def manifest(self, number: int) -> dict[int, int]:
        """Partition -> generation, at most `partitions` of them."""
        if number < 0:
            return {}
        rows = self.spark.read.schema("part int, generation long").parquet(f"{self.folder}/manifest/batch-{number}")
        return {r["part"]: r["generation"] for r in rows.collect()}

    def read(self, manifest: dict[int, int]) -> DataFrame:
        paths = [f"{self.folder}/state/generation={g}/part={p}" for p, g in sorted(manifest.items())]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, number: int) -> None:
        held = self.manifest(number - 1)
        self._remove({p: g for p, g in self.manifest(number - 2).items() if held.get(p) != g})
        rows = batch.withColumn("part", F.pmod(F.xxhash64(self.key), F.lit(self.partitions)).cast("int"))
        touched = {r["part"] for r in rows.select("part").distinct().collect()}  # at most `partitions`
        both = batch.unionByName(self.read({p: g for p, g in held.items() if p in touched}))
        latest = both.groupBy(self.key).agg(F.max_by(F.struct(*both.columns), F.struct(*self.order)).alias("r")).select("r.*")
        latest = latest.withColumn("part", F.pmod(F.xxhash64(self.key), F.lit(self.partitions)).cast("int"))
        latest.write.mode("overwrite").partitionBy("part").parquet(f"{self.folder}/state/generation={number}")
        now = held | dict.fromkeys(touched, number)
        self.spark.createDataFrame(list(now.items()), "part int, generation long").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/manifest/batch-{number}")

    def _remove(self, replaced: dict[int, int]) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path
        for p, g in replaced.items():
            old = path(f"{self.folder}/state/generation={g}/part={p}")
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)

    def latest(self) -> DataFrame:
        """The rows after the last batch."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        numbers = [int(f.getPath().getName().removeprefix("batch-")) for f in files.listStatus(path)] if files.exists(path) else []
        return self.read(self.manifest(max(numbers, default=-1)))


def upsert_latest(spark: SparkSession, stream: DataFrame, key: str, *order: str, folder: str | None = None, partitions: int = 16) -> DataFrame:
    """The row of each key with the greatest order columns, of all that the stream has, as KeyedState keeps it. A query that is
    started again on the same folder goes on from what is there."""
    folder = folder or work_folder(spark, "upsert")
    state = KeyedState(spark, folder, stream.schema, key, order, partitions)
    stream.writeStream.foreachBatch(state.merge).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return state.latest()
