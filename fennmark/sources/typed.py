"""Text formats read with a declared schema: rows that do not fit are kept apart, folders named column=value are partitions.

Nothing is inferred from the data, so a read costs no pass ahead of it. Whether a row fits is judged by all declared columns,
whichever are asked for afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fennmark.session import work_folder

CORRUPT = "_corrupt_record"


def read_typed(spark: SparkSession, path: str, kind: str, schema: str, partitions: str = "", **options: str) -> DataFrame:
    """The rows of JSON or CSV files with the columns of schema, those of `partitions`, which stand in folder names, and CORRUPT: the
    line of a row that does not fit, else null. Filters on partitions leave out whole folders."""
    whole = ", ".join(x for x in (schema, f"{CORRUPT} string", partitions) if x)
    reader = spark.read.format(kind).schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    return reader.options(**options).load(path)


def _fits(rows: DataFrame) -> Column:
    # Reads all declared columns, as a column that nobody reads is not parsed and so never found to be wrong.
    return F.col(CORRUPT).isNull() & (F.hash(*[c for c in rows.columns if c != CORRUPT]) >= -(2**31))


def fitting(rows: DataFrame) -> DataFrame:
    """The rows of read_typed() that fit the schema, without CORRUPT."""
    return rows.filter(_fits(rows)).drop(CORRUPT)


def misfits(rows: DataFrame, *partitions: str) -> DataFrame:
    """(partitions..., line) of the rows of read_typed() that do not fit."""
    return rows.filter(~_fits(rows)).select(*partitions, F.col(CORRUPT).alias("line"))


def write_partitioned(rows: DataFrame, kind: str, name: str, *partitions: str, **options: str) -> str:
    """The folder below the shared one to which rows went. Rows of a partition meet, in as many files as their size asks for."""
    folder = work_folder(rows.sparkSession, name)
    rows.hint("rebalance", *partitions).write.format(kind).partitionBy(*partitions).options(**options).save(folder)
    return folder
