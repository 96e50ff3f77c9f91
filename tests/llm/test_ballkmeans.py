import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from fennmark.llm import ballkmeans, queries
from tests.oracle import SF, duck, duck_rows, spark_rows

FIELDS = "vec_id long, embedding array<double>, v string, cluster string, distance string, n int"


def rows_of(spark, rows):
    return spark.createDataFrame([(*r, None, None, None, None) for r in rows], FIELDS)


def seeds():
    return F.sha2(F.concat(F.lit("2:"), F.col("vec_id").cast("string")), 256)


def brute(rows, k, rounds, dims):
    """Lloyd's rounds by comparison with all centroids, in Python's whole numbers."""
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [list(v) for _, v in order[:k]]
    for step in range(rounds + 1):
        found = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids)) for _, v in kept]
        if step < rounds:
            for j in range(len(centroids)):
                own = [v for (_, v), (_, at) in zip(kept, found, strict=True) if at == j]
                if own:
                    centroids[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    return sorted(((i, j, d) for (i, _), (d, j) in zip(kept, found, strict=True)), key=key), centroids


def clustered(df, k, rounds, dims):
    assigned, centroids = ballkmeans.ball_kmeans(ballkmeans.whole_vectors(df, dims), k, rounds, seeds())
    rows = [(r["vec_id"], r["cluster"], r["distance"]) for r in assigned.collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:])), centroids


def test_equals_brute_force_with_ties(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.integers(-3, 4, size=3) / 4]) for k in range(400)]  # many equal distances
    rows += [(k % 5, [0.25, 0.25, 0.25]) for k in range(100)]
    assert clustered(rows_of(spark, rows), 12, 5, 3) == brute(rows, 12, 5, 3)


def test_odd_rows(spark):
    rows = [(1, None), (2, []), (3, [1.0]), (4, [1.0, None]), (5, [1.0, float("nan")]), (6, [1.0, float("inf")]), (7, [0.1, 0.2]), (7, [0.1, 0.2]), (7, [0.9, 0.2]), (None, [0.5, 0.5]), (8, [-0.001, -0.001])]
    assert clustered(rows_of(spark, rows), 3, 2, 2) == brute(rows, 3, 2, 2)
    assert clustered(rows_of(spark, rows), 40, 2, 2) == brute(rows, 40, 2, 2)  # fewer vectors than centroids
    assert clustered(rows_of(spark, []), 3, 2, 2) == ([], [])
    empty = ballkmeans.described(*ballkmeans.ball_kmeans(ballkmeans.whole_vectors(rows_of(spark, []), 2), 3, 2, seeds()))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "cluster"]


def test_balls_leave_out_comparisons():
    rng = np.random.default_rng(6)
    centres = rng.integers(-2000, 2000, size=(20, 8)).astype(float)
    points = np.round(np.repeat(centres, 50, axis=0) + rng.normal(size=(1000, 8)) * 100)
    moved = np.round(centres + rng.normal(size=centres.shape) * 60)
    before, _ = ballkmeans.nearest(points, centres)
    cluster, distance, computed = ballkmeans.reassigned(points, before, moved)
    expected = ballkmeans.nearest(points, moved)
    assert (cluster == expected[0]).all() and (distance == expected[1]).all()
    assert computed < 0.3 * len(points) * len(centres)


def test_query_equals_sql(spark):
    df = queries.op13_ball_kmeans(spark, SF)
    names, expected = duck_rows(duck(), queries.oracle_sql()["op13_ball_kmeans"])
    assert sorted(df.columns) == names and spark_rows(df) == expected and expected
