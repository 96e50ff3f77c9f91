"""Versioned catalogues: latest version, reconciliation, differences, facets and control totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_versions(entries: DataFrame, name: str = "name_en") -> DataFrame:
    """(name, year, rev): of each name the greatest (year, rev)."""
    return entries.groupBy(name).agg(F.max(F.struct("year", "rev")).alias("v")).select(name, "v.year", "v.rev")


def reconcile(a: DataFrame, b: DataFrame, name: str = "name_en") -> DataFrame:
    """(name, status, year_a, rev_a, year_b, rev_b): same, conflict, only_a or only_b. Joined by name, never by translation. Of
    a name that a side has more than once its latest version counts."""
    a, b = (latest_versions(side, name) for side in (a, b))
    left = a.select(name, F.col("year").alias("year_a"), F.col("rev").alias("rev_a"), F.lit(True).alias("in_a"))
    right = b.select(name, F.col("year").alias("year_b"), F.col("rev").alias("rev_b"), F.lit(True).alias("in_b"))
    same = F.col("year_a").eqNullSafe(F.col("year_b")) & F.col("rev_a").eqNullSafe(F.col("rev_b"))
    status = F.when(F.col("in_b").isNull(), "only_a").when(F.col("in_a").isNull(), "only_b").when(same, "same").otherwise("conflict")
    return left.join(right, name, "full").select(name, status.alias("status"), "year_a", "rev_a", "year_b", "rev_b")


def missing_from(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Rows of a whose key b lacks."""
    return a.join(b, key, "left_anti")


def left_over(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rows of a beyond those of b, each as often as it has more in a."""
    return a.exceptAll(b)


def facets(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def check_totals(summary: DataFrame, entries: DataFrame) -> DataFrame:
    """(stated, counted, agrees): the summary's total against the number of entries."""
    stated, counted = summary.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("stated")), entries.agg(F.count("*").alias("counted"))
    return stated.crossJoin(counted).withColumn("agrees", F.col("stated") == F.col("counted"))  # one row each
