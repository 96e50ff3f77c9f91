"""Routing of texts and vectors to topics, and its confusion matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fennmark.functions.text import let, tokens


def keyword_route(docs: DataFrame, keywords: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, route, hits): the topic most of whose keywords occur (ties by name), else "unrouted". keywords(topic, term)
    is a short list; it is broadcast as one map, and no row is multiplied."""
    topics = keywords.groupBy("topic").agg(F.collect_set("term").alias("terms"))
    topics = topics.agg(F.sort_array(F.collect_list(F.struct("topic", "terms"))).alias("topics"), F.flatten(F.collect_list("terms")).alias("words"))
    counted = docs.select(doc_id, text).crossJoin(F.broadcast(topics))  # one row
    hits = lambda words: F.transform("topics", lambda t: F.struct((-F.size(F.filter(words, lambda w: F.array_contains(t["terms"], w)))).alias("minus"), t["topic"].alias("topic")))
    any_word = F.filter(tokens(F.col(text)), lambda w: F.array_contains("words", w))
    best = counted.select(doc_id, let(any_word, lambda words: F.array_min(hits(words))).alias("best"))
    none = F.coalesce("best.minus", F.lit(0)) == 0
    return best.select(doc_id, F.when(none, "unrouted").otherwise(F.col("best.topic")).alias("route"), F.coalesce(-F.col("best.minus"), F.lit(0)).cast("bigint").alias("hits"))


def centroids(vectors: DataFrame, label: str = "label", embedding: str = "embedding") -> DataFrame:
    """(label, centroid): the mean vector of each label."""
    each = vectors.select(label, F.posexplode(embedding).alias("k", "x")).groupBy(label, "k").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return each.groupBy(label).agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "m"))), lambda p: p["m"]).alias("centroid"))


def centroid_route(vectors: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """(vec_id, label, route, score): the label whose centroid has the greatest dot product (ties by the lesser label).

    The centroids, one per label, are gathered in one broadcast row."""
    held = centroids(vectors, label, embedding).agg(F.sort_array(F.collect_list(F.struct(label, "centroid"))).alias("held"))
    dot = lambda c: F.round(F.aggregate(F.zip_with(embedding, c["centroid"], lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x), 6)
    scored = vectors.crossJoin(F.broadcast(held)).select(vec_id, label, F.array_min(F.transform("held", lambda c: F.struct((-dot(c)).alias("minus"), c[label].alias("route")))).alias("best"))
    return scored.select(vec_id, label, "best.route", (-F.col("best.minus")).alias("score"))


def confusion(routed: DataFrame, label: str = "label", route: str = "route", routes: list | None = None) -> DataFrame:
    """One row per label, one column per route."""
    return routed.groupBy(label).pivot(route, routes).agg(F.count(F.lit(1))).na.fill(0)
