import importlib.util

import pytest

from fennmark.llm import decontamination, queries, simhash
from fennmark.llm.common import table
from tests.llm.edge import documents
from tests.oracle import SF

if importlib.util.find_spec("corpus_pipeline") is None:
    pytest.skip("without the pipeline", allow_module_level=True)
import corpus_pipeline


def test_every_stage(spark, tmp_path):
    docs = table(spark, SF, "documents")
    columns, before = docs.columns, {r.doc_id for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k == len(corpus_pipeline.STAGES) - 1:
            assert {r.doc_id for r in out.collect()} == before
            break
        assert out.columns == columns and [t for _, t in out.dtypes] == [t for _, t in docs.dtypes]
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r.doc_id for r in docs.collect()}
        assert after <= before and len(after) > 0.5 * len(before)
        assert (after == before) == (name == "line_dedup")
        before = after
    assert decontamination.find_leaks(docs, table(spark, SF, "benchmark")).count() == 0
    assert simhash.drop_near_duplicates(docs).count() == docs.count()


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} == set(got.columns) and got.count() > 0


def test_stages_on_odd_and_no_rows(spark):
    for docs in (documents(spark), documents(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= max(docs.count(), 1) * 200


def test_names():
    assert [int(n[2:].split("_")[0]) for n in queries.queries()] == list(range(1, 14))
