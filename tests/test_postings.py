"""The index against counting by hand, what its plans read, odd rows, and a term in every document."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fennmark.functions import text as T
from fennmark.operators import postings, retrieval
from fennmark.session import work_folder

ROWS = [(1, "the cat The CAT the"), (2, None), (3, ""), (4, " .,; "), (5, "dog"), (5, "dog and cat"), (None, "no id the"), (6, "the " * 5000 + "end"), (7, "naïve café 文字"), (2**40, "the dog")]


def build(spark, rows, **how):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, term string, block int, length string")
    return postings.build_postings(docs, work_folder(spark, "index"), buckets=4, **how)


def test_odd_rows(spark):
    index = build(spark, ROWS, block_docs=3)
    found = sorted((r.term, d.doc_id, d.tf, d.length) for r in index.postings().collect() for d in r.docs)
    expected = sorted((term, i, n, len(words)) for i, t in ROWS if i is not None for words in ["".join(c if c.isalnum() else " " for c in (t or "").lower()).split()] for term, n in Counter(words).items())
    assert found == expected
    assert index.stats.first().n_docs == 9
    assert {(r.term, r.df) for r in index.terms(["the", "dog", "nowhere"]).collect()} == {("the", 3), ("dog", 3)}
    assert index.bm25(["nowhere"]).count() == 0 and index.best(["nowhere"], 3).count() == 0


def test_no_rows(spark):
    index = build(spark, [])
    assert index.terms().count() == index.postings().count() == index.bm25(["a"]).count() == index.best(["a"], 5).count() == index.vectors().count() == 0


def test_questions_read_no_text_and_only_their_buckets(spark):
    index = build(spark, ROWS)
    scored = index.bm25(["cat", "dog"])
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "/forward" not in plan
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0] and "In(term, [cat,dog])" in plan
    folders = {f.rsplit("/", 2)[1] for f in scored.inputFiles() if "/postings/" in f}
    assert {r.b for r in spark.createDataFrame([("cat",), ("dog",)], "t string").select(F.concat(F.lit("bucket="), postings.bucket_of(F.col("t"), 4).cast("string")).alias("b")).collect()} & folders


def test_the_commonest_term_is_one_row_for_each_block(spark):
    index = build(spark, [(k, "the " + "x" * (k % 7)) for k in range(1000)], block_docs=50)
    blocks = index.postings(["the"]).collect()
    assert len(blocks) >= 18 and max(r.n for r in blocks) <= 60 and sum(r.n for r in blocks) == 1000
    ordered = [[d.doc_id for d in r.docs] for r in sorted(blocks, key=lambda r: r.block)]
    assert sum(ordered, []) == list(range(1000))


def test_best_equals_all_scores_and_leaves_blocks_out(spark):
    rng = random.Random(2)
    rows = [(k, " ".join(rng.choices(["cat", "dog", "cow", "hen", "pig", "fox"], [k // 100 + 1, 5, 20, 20, 20, 20], k=rng.randrange(1, 60)))) for k in range(600)]
    index = build(spark, rows, block_docs=20)
    for asked in (["cat"], ["cat", "dog"], ["cat", "hen", "none"]):
        everything = index.bm25(asked).orderBy(F.desc("score"), "doc_id").limit(7).collect()
        assert index.best(asked, 7, first_blocks=1).orderBy(F.desc("score"), "doc_id").collect() == everything
    rare = build(spark, [(k, "cat cat cat" if k in (7, 400) else "dog " * 30 + "cat") for k in range(600)], block_docs=20)
    weights = sorted((r.weight for r in rare.postings(["cat"]).collect()), reverse=True)
    assert weights[1] > 1.5 * weights[2]  # so most blocks cannot hold the best two
    assert [r.doc_id for r in rare.best(["cat"], 2, first_blocks=1).orderBy("doc_id").collect()] == [7, 400]


def test_vectors_have_length_one_and_find_the_like(spark):
    index = build(spark, [(1, "lung cancer guide"), (2, "lung cancer guide lung cancer guide"), (3, "skin care"), (4, None)])
    vectors = {r.doc_id: r.vector for r in index.vectors(64).collect()}
    assert set(vectors) == {1, 2, 3} and all(len(v) == 64 and abs(sum(x * x for x in v) - 1) < 1e-9 for v in vectors.values())
    near = {r.doc_id: r.score for r in postings.cosine(index.vectors(64), index.question_vector(["lung", "guide"], 64)).collect()}
    assert near[1] == near[2] > 0.5 and near.get(3, 0) < 0.3
    assert postings.cosine(index.vectors(64), index.question_vector(["nowhere"], 64)).count() == 0


@pytest.mark.parametrize(("text", "expected"), [("肝癌治疗and 肺 CT2", ["肝癌", "癌治", "治疗", "and", "肺", "ct2"]), ("", []), ("...", []), (None, None), ("第1章x", ["第", "1", "章", "x"])])
def test_mixed_tokens(spark, text, expected):
    assert spark.createDataFrame([(text,)], "t string").select(T.mixed_tokens(F.col("t"))).first()[0] == expected


def test_han_text_is_found(spark):
    index = build(spark, [(1, "肝癌治疗指南"), (2, "肺癌 guide"), (3, "癌肝")], tokenise=T.mixed_tokens)
    assert [r.doc_id for r in index.bm25(["肝癌"]).collect()] == [1]
    assert {r.doc_id for r in retrieval.ranked(index.bm25(["治疗", "肺癌"]), "score").collect()} == {1, 2}


def exchanges(df):
    """What each shuffle of the plan holds: its columns, by name."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.split("\n") if "Exchange " in line and "Broadcast" not in line and "Reused" not in line]


def test_vectors_shuffle_rows_of_postings_once(spark):
    """The postings of a block meet by whole rows; before, each posting was shuffled alone, and their sums again."""
    index = build(spark, [(k, f"the cat {k} {k % 7}") for k in range(200)], block_docs=50)
    assert len([x for x in exchanges(index.vectors(16)) if "block#" in x or "doc_id#" in x]) == 1
    by_hand = {}
    n, df = 200, Counter(t for k in range(200) for t in {"the", "cat", str(k), str(k % 7)})
    signs = {r.term: (r.dim, r.sign) for r in index.terms().select("term", *postings.hashed(F.col("term"), 16)).collect()}
    for k in range(200):
        sums = [0.0] * 16
        for term, tf in Counter(["the", "cat", str(k), str(k % 7)]).items():
            dim, sign = signs[term]
            sums[dim] += sign * tf * math.log(1 + (n - df[term] + 0.5) / (df[term] + 0.5))
        norm = math.sqrt(sum(x * x for x in sums))
        by_hand[k] = [x / norm if norm else 0.0 for x in sums]
    got = {r.doc_id: r.vector for r in index.vectors(16).collect()}
    assert set(got) == set(by_hand) and all(abs(a - b) < 1e-9 for k in got for a, b in zip(got[k], by_hand[k], strict=True))


def test_dictionary_and_postings_agree_when_dealt_over_many_tasks(spark, monkeypatch):
    rows = [(k, "the " * (1 + k % 3) + f"w{k} w{k % 11}") for k in range(300)]
    usual = build(spark, rows, block_docs=40)
    monkeypatch.setattr(postings, "TASK_POSTINGS", 50)
    dealt = build(spark, rows, block_docs=40)
    counts, docs = Counter(), Counter()
    for _, text in rows:
        counts.update(text.split())
        docs.update(set(text.split()))
    for index in (usual, dealt):
        assert {(r.term, r.df, r.tf) for r in index.terms().collect()} == {(t, docs[t], n) for t, n in counts.items()} and index.terms().count() == len(counts)
        found = index.postings().collect()
        assert all(r.df == docs[r.term] and r.n == len(r.docs) for r in found) and sum(r.n for r in found) == sum(docs.values())
    assert sorted(map(str, usual.postings().collect())) == sorted(map(str, dealt.postings().collect()))
    assert len(dealt.postings().inputFiles()) > len(usual.postings().inputFiles())
