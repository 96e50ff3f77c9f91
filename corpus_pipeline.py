"""From raw documents to packed training sequences, each stage by one of the operators.

Every stage works on all that the one before kept. All but the last return the columns of documents, further ones with them.

Defined results of every stage: rows with null texts count as empty texts, rows with null ids keep what their operator says;
very long texts are whole; repeated rows and ties are treated alike; an empty table gives an empty table.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fennmark.llm import decontamination, linededup, packing, quality, simhash
from fennmark.llm.common import shared_folder, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier rejects go; without labels of both classes its prior decides for all alike."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels"), quality.learnable()))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages stay at their first place only; rows stay, emptied if need be, and a null text stays null."""
    return linededup.drop_repeated_chunks(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of copies and near copies stays, the one of least id; rows without an id stay."""
    return simhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go; without items all stay."""
    return decontamination.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of packed sequences; an empty text is one piece, its end id."""
    return packing.pack_documents(docs)


STAGES = [("quality", quality_stage), ("line_dedup", line_dedup_stage), ("near_dedup", near_dedup_stage), ("decontamination", decontamination_stage), ("packing", packing_stage)]
#: SQL has no dictionary compression, so none for the whole.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; what a stage returns is written to the folder of spark.checkpoint.dir and read again."""
    docs = table(spark, sf_dir, "documents")
    work = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{work}/{name}")
        docs = spark.read.parquet(f"{work}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
