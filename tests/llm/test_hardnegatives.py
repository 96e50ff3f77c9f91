import math
import random

import numpy as np
from pyspark.sql import functions as F

from fennmark.llm import hardnegatives, queries
from tests.oracle import SF, duck, duck_rows, spark_rows

FIELDS = "vec_id long, embedding array<float>, label int, v string, slot int, low long, annulus int, score double"
NAN, INF = float("nan"), float("inf")


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None, None) for r in rows], FIELDS)


def brute(rows, anchor, k=5):
    """The contract by comparison of all anchors with all rows; rows of (vec_id, vector, label)."""
    kept = {(i, int(y), tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v, y in rows if None not in (i, v, y) and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, y, v in sorted(kept):
        if not anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j, z) for j, z, w in kept if j != i))
        for s, j, _ in [x for x in scored if x[2] == y][:k]:
            fits = [(t, n) for t, n, z in scored if z != y and 80 * -s <= 100 * -t <= 100 * -s][:k]
            out += [(i, j, r, n, -s, -t) for r, (t, n) in enumerate(fits, 1)]
    return sorted(out)


def mined(df, anchors, **how):
    return sorted(map(tuple, hardnegatives.mine_hard_negatives(hardnegatives.whole_rows(df), anchors, **how).collect()))


def test_search_equals_brute_force_with_few_rows_scanned_at_first(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(9, 12)) * 0.5
    rows = [(k, [float(x) for x in centres[k % 9] + rng.normal(size=12) * 0.2], int(rng.integers(0, 4))) for k in range(900)]
    rows += [(1000 + k, [0.5] * 12, 1) for k in range(200)]  # one vector of many rows: ties by id
    rows += [(2000, [0.25] * 12, 7), (2002, [0.25] * 12, 8), (2003, [0.0] * 12, 0)]  # labels of one row
    found = mined(rows_of(spark, rows), F.col("vec_id") % 7 == 0, pivots=8, annuli=6, chunk_rows=40, sample=500)
    assert found == brute(rows, lambda i: i % 7 == 0)


def test_annuli_out_of_reach_are_not_scanned(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(8, 6))
    rows = [(k, [float(x) for x in centres[k % 8] + rng.normal(size=6) * 0.01], k % 2) for k in range(1600)]
    keys = hardnegatives.DistanceKeys(hardnegatives.whole_rows(rows_of(spark, rows)), pivots=8, annuli=8, chunk_rows=25, sample=800)
    query = np.floor(256 * np.float64(np.float32(rows[0][1])))
    products = sorted((-int(np.floor(256 * np.float64(np.float32(v))) @ query) for _, v, _ in rows))
    scanned = keys.n[keys.reach(query, hardnegatives.ANY) <= keys.widened(query, hardnegatives.ANY, -products[5], True, -1.0, 1)].sum()
    assert keys.n.sum() == 1600 and scanned < 0.5 * 1600


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (0, [0.5, 1.0], 1), (None, [1.0, 1.0], 1), (7, None, 1), (14, [1.0, None], 2), (21, [NAN, 1.0], 2), (22, [INF, 1.0], 2), (28, [1.0, 0.4], None)]
    rows += [(1, [1.0, 0.5], 1), (2, [1.0, 0.5], 2), (3, [1.0], 2), (4, [], 2), (5, [0.9, 0.5, 2.0], 2), (6, [0.9, 0.45], 2), (8, [-1.0, -1.0], 1), (100, [1.0, 0.0], 1), (200, [-1.0, -1.0], 3)]
    assert mined(rows_of(spark, rows), F.col("vec_id") % 100 == 0) == brute(rows, lambda i: i % 100 == 0)
    assert mined(rows_of(spark, []), F.col("vec_id") % 100 == 0) == []
    assert mined(rows_of(spark, [(0, [], 1), (1, [], 1), (2, [], 2)]), F.col("vec_id") == 0) == [(0, 1, 1, 2, 0, 0)]


def test_query_equals_sql(spark):
    df = queries.op12_hard_negatives(spark, SF)
    names, expected = duck_rows(duck(), queries.oracle_sql()["op12_hard_negatives"])
    assert sorted(df.columns) == names and spark_rows(df) == expected and expected


def test_random_tables(spark):
    rng = random.Random(1)
    rows = [(k, [rng.choice([-1.0, -0.5, 0.0, 0.5, 1.0]) for _ in range(3)], rng.randrange(3)) for k in range(150)]
    assert mined(rows_of(spark, rows), F.col("vec_id") % 3 == 0, pivots=4, annuli=4, chunk_rows=8, sample=64) == brute(rows, lambda i: i % 3 == 0)


def test_the_driver_gets_one_sample_whatever_the_number_of_tasks(spark):
    """Rows of one id and of many, in one task and in forty: what is sent to the driver does not grow with tasks."""
    rows = spark.range(20_000).selectExpr("if(id % 2 = 0, 0, id) vec_id", "id % 5 label", "array(id, id * id % 1000) v").distinct()
    for tasks in (1, 40):
        dealt = rows.repartition(tasks)
        kept = [tuple(r) for r in hardnegatives.sampled(dealt, 20_000, 500).select("vec_id", "label").collect()]
        assert 400 < len(kept) < 600 and 100 < sum(i == 0 for i, _ in kept) < 400
        plan = hardnegatives.sampled(dealt, 20_000, 500)._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Limit" not in plan
    assert hardnegatives.sampled(rows, 20_000, 20_000).count() == 20_000


def test_nothing_is_broadcast(spark):
    """Queries are few bytes until each goes to all its annuli, and chunks are few until they are read: all pass shuffles alone."""
    rng = np.random.default_rng(16)
    rows = [(k, [float(x) for x in rng.normal(size=8)], k % 3) for k in range(400)]
    spark.conf.set("spark.sql.maxBroadcastTableSize", "1")
    try:
        assert mined(rows_of(spark, rows), F.col("vec_id") % 20 == 0, pivots=8, annuli=8, chunk_rows=20, sample=200) == brute(rows, lambda i: i % 20 == 0)
    finally:
        spark.conf.unset("spark.sql.maxBroadcastTableSize")
