"""Corpus preparation: chunks, exact copies, label gates, repeated lines and composition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def chunks(docs: DataFrame, size: int = 1000, overlap: int = 200, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, chunk, start, text): windows of `size` characters, each starting size - overlap after the one before."""
    step = size - overlap
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - overlap - 1, F.lit(0)), F.lit(step))
    rows = docs.select(doc_id, text, F.posexplode(starts).alias("chunk", "start"))
    return rows.select(doc_id, "chunk", "start", F.substring(text, F.col("start") + 1, F.lit(size)).alias("text"))


def exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(digest, keeper, copies): one row per distinct text, with the least id that has it."""
    return docs.groupBy(F.md5(text).alias("digest")).agg(F.min(doc_id).alias("keeper"), F.count("*").alias("copies"))


def quality_gate(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents labelled good and not toxic. Unlabelled ones do not pass."""
    passed = labels.filter("quality = 1 and toxic = 0").select(doc_id)
    return docs.join(passed, doc_id, "left_semi")


def toxicity_gate(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Documents not labelled toxic; unlabelled ones pass."""
    return docs.join(labels.filter("toxic = 1").select(doc_id), doc_id, "left_anti")


def repeated_line_ratio(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, lines, ratio): the share of a text's lines that repeat another of them."""
    lines = F.split(text, "\n")
    return docs.select(doc_id, F.size(lines).cast("bigint").alias("lines"), F.round(1 - F.size(F.array_distinct(lines)) / F.size(lines), 6).alias("ratio"))


def composition(docs: DataFrame, *columns: str) -> DataFrame:
    """Counts and characters by a rollup of the columns; level tells totals from null values."""
    return docs.rollup(*columns).agg(F.grouping_id().cast("bigint").alias("level"), F.count("*").alias("docs"), F.sum(F.length("text")).cast("bigint").alias("chars"))
