"""Quality and toxicity: accuracy on held-out rows, what may be learnt from, odd rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from fennmark.llm import quality, queries, toxicity
from fennmark.llm.common import table
from tests.llm.edge import ROWS, documents
from tests.oracle import SF

LARGER = SF.replace("sf0.001", "sf0.1")


def auc(scores, labels):
    scores, labels = np.array(scores), np.array(labels)
    good, bad = scores[labels == 1], scores[labels == 0]
    return float(((good[:, None] > bad[None, :]) + 0.5 * (good[:, None] == bad[None, :])).mean())


@pytest.mark.parametrize(("query", "label", "parts", "held", "least_auc", "least_accuracy"), [(queries.op4_quality, "quality", 3, 1, 0.98, 0.97), (queries.op5_toxicity, "toxic", 5, 0, 0.95, 0.96)])
def test_held_out_accuracy(spark, query, label, parts, held, least_auc, least_accuracy):
    got = query(spark, LARGER).join(table(spark, LARGER, "labels"), "doc_id", "left").select("doc_id", "held_out", "score", "predicted", label).collect()
    assert len(got) == table(spark, LARGER, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == held) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    rows = [r for r in got if r.held_out and r[label] is not None]
    assert auc([r.score for r in rows], [r[label] for r in rows]) > least_auc
    assert np.mean([r.predicted == r[label] for r in rows]) > least_accuracy


@pytest.mark.parametrize(("fit", "score", "label"), [(quality.fit_quality, quality.score_quality, "quality"), (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic")])
def test_held_out_labels_and_other_columns_change_nothing(spark, fit, score, label):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    learn = quality.learnable(parts=3, held_out=1)
    usual = {r.doc_id: r.score for r in score(docs, fit(docs, labels, learn)).collect()}
    turned = labels.withColumn(label, F.when(learn, F.col(label)).otherwise(1 - F.col(label)))
    assert usual == {r.doc_id: r.score for r in score(docs, fit(docs, turned, learn)).collect()}
    others = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "n_chars": F.lit(0)})
    assert usual == {r.doc_id: r.score for r in score(others, fit(docs, labels, learn)).collect()}


@pytest.mark.parametrize(("fit", "score"), [(quality.fit_quality, quality.score_quality), (toxicity.fit_toxicity, toxicity.score_toxicity)])
def test_odd_rows(spark, fit, score):
    docs = documents(spark)
    odd = spark.createDataFrame([(1, 1, None), (2, None, 1), (5, 0, 0), (6, 1, 1), (6, 0, 0), (None, 1, 1), (77, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (odd, odd.limit(0), table(spark, SF, "labels")):
        trained_on = table(spark, SF, "documents") if labels is not odd else docs
        got = score(docs, fit(trained_on, labels)).collect()
        assert len(got) == len(ROWS) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert score(documents(spark, []), fit(documents(spark, []), odd)).count() == 0


def test_only_one_label(spark):
    labels = table(spark, SF, "labels").withColumns({"quality": F.lit(1), "toxic": F.lit(0)})
    docs = table(spark, SF, "documents")
    assert all(r.score > 0.9 for r in quality.score_quality(docs, quality.fit_quality(docs, labels)).collect())
    assert all(r.score < 0.1 for r in toxicity.score_toxicity(docs, toxicity.fit_toxicity(docs, labels)).collect())


def test_scores_of_parts_of_a_long_text_equal_those_of_the_whole(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, SF, "labels"))
    texts = [r.text for r in docs.select("text").limit(40).collect()] + ["", "one"]
    whole = model.scores(texts)
    monkeypatch.setattr(toxicity, "AT_ONCE", 37)
    assert np.allclose(whole, model.scores(texts), atol=1e-5)


def test_keep_good_keeps_columns_and_rejects(spark):
    docs = table(spark, SF, "documents")
    model = quality.fit_quality(docs, table(spark, SF, "labels"))
    kept = quality.keep_good(documents(spark), model)
    assert kept.columns == documents(spark).columns
    scores = {r.doc_id: r.score for r in quality.score_quality(docs, model).collect()}
    assert {r.doc_id for r in quality.keep_good(docs, model).collect()} == {d for d, s in scores.items() if s >= 0.5}


@pytest.mark.parametrize(("fit", "score", "label"), [(quality.fit_quality, quality.score_quality, "quality"), (toxicity.fit_toxicity, toxicity.score_toxicity, "toxic")])
def test_a_text_that_does_not_fit_is_left_out_alone(spark, fit, score, label):
    folder = SF.replace("sf0.001", "sf0.01")
    docs, labels = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels").select("doc_id", label)
    sizes, cap = docs.agg(F.max(F.length("text")), F.sum(F.length("text"))).first()
    first = [r.id for r in spark.range(10**6, 10**6 + 5000).orderBy(F.xxhash64("id")).limit(2).collect()]  # before all others
    long = spark.createDataFrame([(i, "wort " * (cap // 5 + 1)) for i in first], "doc_id long, text string")
    odd = labels.unionByName(spark.createDataFrame([(i, y) for y, i in enumerate(first)], f"doc_id long, {label} int"))
    usual = {r.doc_id: r.score for r in score(docs, fit(docs, labels, sample_chars=cap)).collect()}
    assert usual == {r.doc_id: r.score for r in score(docs, fit(docs.unionByName(long), odd, sample_chars=cap)).collect()}
    assert len(set(usual.values())) > 100


def test_a_class_that_does_not_fit_is_reported(spark):
    docs = spark.createDataFrame([(k, "ab " * (400 if k < 5 else 2)) for k in range(20)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k < 5)) for k in range(20)], "doc_id long, quality int")
    with pytest.warns(UserWarning, match="quality = 1"):
        rows = quality.sample_labelled(docs, labels, "quality", None, 100, sample_chars=1000).collect()
    assert sorted(r.doc_id for r in rows) == list(range(5, 20))
