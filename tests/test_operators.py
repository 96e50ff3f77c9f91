"""Edge cases and properties that the driver's tables don't have."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from fennmark.functions import text as T
from fennmark.operators import catalogue, corpus, retrieval, routing, usage
from fennmark.sources import catalogue as reader


def test_versions_order_by_year(spark):
    rows = spark.createDataFrame([("a", 2025, 2), ("a", 2026, 1), ("b", 2025, 9), ("b", 2025, 10)], "name_en string, year int, rev int")
    assert {tuple(r) for r in catalogue.latest_versions(rows).collect()} == {("a", 2026, 1), ("b", 2025, 10)}


def test_reconcile_nulls(spark):
    a = spark.createDataFrame([("x", None, None), ("y", 2025, 1)], "name_en string, year int, rev int")
    assert {r.name_en: r.status for r in catalogue.reconcile(a, a).collect()} == {"x": "same", "y": "same"}


def test_table_shapes(spark):
    lines = ["| 1 | 🎯 A | 甲 | 2.2025 |", "|2|✅B: C/D|乙|1.2026||", "| seq | name | x | y |", "no row"]
    got = reader.parse_table(spark.createDataFrame([(x,) for x in lines], "value string")).collect()
    assert [tuple(r) for r in got] == [(1, "🎯", "A", "甲", 2025, 2), (2, "✅", "B: C/D", "乙", 2026, 1)]


def test_read_tree(spark, tmp_path):
    for path in ("kb/guides/lung/a.md", "kb/guides/liver/b.md"):
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text("one\ntwo")
    got = {(r.category, r.topic, r.value) for r in reader.read_tree(spark, str(tmp_path / "kb")).collect()}
    assert got == {("guides", "lung", "one\ntwo"), ("guides", "liver", "one\ntwo")}


def test_chunks_rebuild_the_text(spark):
    texts = [(k, "".join(chr(97 + (j * j) % 26) for j in range(n))) for k, n in enumerate((0, 1, 199, 200, 201, 1000, 1001, 5000))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    back = {}
    for r in corpus.chunks(docs).orderBy("doc_id", "chunk").collect():
        back[r.doc_id] = back.get(r.doc_id, "")[: r.start] + r.text
    assert back == dict(texts)


def test_redaction_is_idempotent(spark):
    df = spark.createDataFrame([("mail a.b@c.example or +1 (202) 555-0100 now",), ("",), (None,)], "t string")
    once = df.select(T.redact(F.col("t")).alias("t"))
    assert [r[0] for r in once.collect()] == ["mail [EMAIL] or [PHONE] now", "", None]
    assert once.select(T.redact(F.col("t"))).collect() == once.collect()


def test_han_bigrams(spark):
    df = spark.createDataFrame([("肝癌治疗 and 肺",), ("no han",)], "t string")
    assert [r[0] for r in df.select(T.han_bigrams(F.col("t"))).collect()] == [["肝癌", "癌治", "治疗", "肺"], []]


def test_unrouted(spark):
    docs = spark.createDataFrame([(1, "nothing here"), (2, "the end"), (3, None), (4, "")], "doc_id long, text string")
    keywords = spark.createDataFrame([("x", "the")], "topic string, term string")
    assert {r.doc_id: r.route for r in routing.keyword_route(docs, keywords).collect()} == {1: "unrouted", 2: "x", 3: "unrouted", 4: "unrouted"}


def test_session_gap_of_exactly_thirty_minutes(spark):
    t = datetime(2024, 1, 1)
    rows = [(1, t), (1, t + timedelta(minutes=30)), (1, t + timedelta(minutes=60, seconds=1))]
    got = usage.sessions(spark.createDataFrame(rows, "user_id long, ts timestamp_ntz")).orderBy("session_start").collect()
    assert [r.events for r in got] == [2, 1]


def test_top_k_blocks_agree(spark):
    rows = [(k, [float((k * 7 + j * 3) % 11 - 5) for j in range(4)]) for k in range(60)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries = vectors.filter("vec_id % 20 = 0")
    whole = retrieval.cosine_top_k(vectors, queries, 5).collect()
    assert sorted(whole) == sorted(retrieval.cosine_top_k(vectors, queries, 5, block=1).collect())
    assert len(whole) == 15


def test_upsert_over_batches(spark, tmp_path):
    from fennmark.streaming import events

    schema = "k long, v long"
    for k, rows in enumerate(([(1, 1), (2, 5)], [(1, 3), (2, 4)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(tmp_path))
    assert {tuple(r) for r in events.upsert_latest(spark, stream, "k", "v").collect()} == {(1, 3), (2, 5)}


def test_upsert_goes_on_after_a_restart(spark, tmp_path):
    from fennmark.streaming import events

    schema, folder = "k long, v long", str(tmp_path / "work")
    read = lambda: events.upsert_latest(spark, spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), "k", "v", folder=folder)
    spark.createDataFrame([(1, 1), (2, 5)], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    assert {tuple(r) for r in read().collect()} == {(1, 1), (2, 5)}
    assert {tuple(r) for r in read().collect()} == {(1, 1), (2, 5)}
    spark.createDataFrame([(1, 3), (2, 4)], schema).coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    assert {tuple(r) for r in read().collect()} == {(1, 3), (2, 5)}


def test_ranks_with_many_ties(spark):
    rows = [(k, float(k % 7 if k % 3 else 3)) for k in range(500)]
    got = {r.doc_id: r.rank for r in retrieval.ranked(spark.createDataFrame(rows, "doc_id long, score double"), "score", bins=8).collect()}
    assert got == {k: n + 1 for n, (k, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])))}
    assert retrieval.ranked(spark.createDataFrame([], "doc_id long, score double"), "score").count() == 0


def test_context_is_the_same_however_it_is_dealt(spark):
    rows = [(k, "g" if k % 3 else "h", (k * 37) % 50) for k in range(400)]
    df = spark.createDataFrame(rows, "rank long, grp string, n_chars long")
    got = [sorted(map(tuple, retrieval.context_under_budget(df, 600, "grp", deals=n).collect())) for n in (1, 7, 256)]
    want = []
    for g in "gh":
        total = 0
        for k, of, size in rows:
            if of == g and (total := total + size) <= 600:
                want.append((k, g, size, total))
    assert got == [sorted(want)] * 3


def test_zero_and_repeated_vectors(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [(r.vec_id, r.cosine) for r in retrieval.cosine_top_k(vectors, vectors.filter("vec_id = 1").limit(1), 3).orderBy("rank").collect()]
    assert got == [(2, 0.707107), (0, 0.0), (3, -1.0)]


def test_reconcile_takes_the_latest_of_a_name(spark):
    a = spark.createDataFrame([("x", 2025, 1), ("x", 2026, 1)], "name_en string, year int, rev int")
    assert [tuple(r) for r in catalogue.reconcile(a, a.limit(1)).collect()][0][:2] == ("x", "conflict")
