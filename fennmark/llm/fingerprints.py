"""Document fingerprints: a threshold-scaled sketch keeps every shingle hash below a fixed fraction of the hash range.

Two sketches made with one fraction can be merged by union and compared by containment however unequal the documents are.
A text whose hashes all lie above the threshold keeps its least hash, so only texts without words have empty sketches.

Defined results: a null text is empty; an empty text has no words, no shingles and an empty sketch; a text of fewer words
than a shingle is one shingle; two empty sketches have likeness 1, an empty and another one 0; a very long text has a sketch of
an eighth of its shingles; repeated rows and rows of one id follow one another by hash of the text; an empty table gives an
empty table; further columns are ignored, whatever their names. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fennmark.llm.common import let, whole

WORDS, FRACTION = 5, 1 / 8


def shingle_hashes(text: Column, words: int = WORDS) -> Column:
    """64-bit hashes of the shingles of `words` lower-case words, in order, repeats included."""
    split = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    shingles = lambda h: (
        F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
        .when(F.size(h) < words, F.array(F.xxhash64(h)))
        .otherwise(F.transform(F.sequence(F.lit(0), F.size(h) - words), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(words)])))
    )
    return let(F.transform(split, lambda w: F.xxhash64(w)), shingles)


def scaled_sketch(text: Column, fraction: float = FRACTION, words: int = WORDS) -> Column:
    """Sorted distinct shingle hashes below the fraction, counted from the least 64-bit value."""
    below = -(2**63) + int(2**64 * fraction)
    keep = lambda h: let(F.filter(h, lambda x: x < F.lit(below)), lambda k: F.when(F.size(k) > 0, F.sort_array(F.array_distinct(k))).otherwise(F.filter(F.array(F.array_min(h)), lambda x: x.isNotNull())))
    return let(shingle_hashes(text, words), keep)


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both documents' shingles together."""
    below = -(2**63) + int(2**64 * fraction)
    return let(F.array_sort(F.array_union(a, b)), lambda u: let(F.filter(u, lambda x: x < F.lit(below)), lambda k: F.when(F.size(k) > 0, k).otherwise(F.slice(u, 1, 1))))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, F.lit(1.0)).otherwise(both / union)


def containment(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """Estimated share of a's shingles that b has, 0 to 1; 1 where a has none. Null, for unknown, where a has no hash below the
    threshold and b does not hold its least one: b, if longer, keeps no such hash even where it has the shingle."""
    below = -(2**63) + int(2**64 * fraction)
    share = F.size(F.array_intersect(a, b)) / F.size(a)
    return F.when(F.size(a) == 0, F.lit(1.0)).when((F.get(a, F.lit(0)) >= F.lit(below)) & (share == 0), F.lit(None).cast("double")).otherwise(share)


def as_text(sketch: Column) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), " ")


def bucket_of(k: Column, edges: list[float], top: float, per: int) -> Column:
    """The bucket of a number: `per` of equal width between each two neighbours of `edges`, which ascend. It never falls as k grows."""
    widths = F.lit([max((b - a) / per, 1e-9) for a, b in zip(edges, [*edges[1:], top], strict=True)])
    lows, steps = F.lit(edges), [1 << s for s in range(len(edges).bit_length() - 1, -1, -1)]
    further = lambda at, step: F.when(F.coalesce(F.get(lows, at + step) <= k, F.lit(False)), at + step).otherwise(at)
    return let(F.aggregate(F.lit(steps), F.lit(0), further), lambda at: at * F.lit(per).cast("long") + F.least(F.floor((k - F.get(lows, at)) / F.get(widths, at)), F.lit(per - 1).cast("long")))


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bucket_rows: int = 64, max_buckets: int = 200_000, ranges: int = 256) -> tuple[DataFrame, Window]:
    """Rows (doc_id, text, next_text, halo) and the window in which a row's next document stands, by descending doc_id.

    After the last document comes the first. Ids are dealt into buckets, so no task holds the whole order; the first row of
    each bucket is sent along to the bucket before it (halo), which is what joins the buckets. Buckets have equal width within
    `ranges` quantiles of the ids, so ids that lie unevenly crowd one range at most. The table of bucket heads has at most
    about max_buckets rows. Rows without an id come last, by hash of their text; rows of one id are ordered by that hash too.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).withColumn("h", F.xxhash64("text"))
    n = docs.count()
    ranges = max(1, min(ranges, math.ceil(n / bucket_rows)))
    per = max(1, math.ceil(min(max_buckets, n / bucket_rows) / ranges))
    ids = F.col(doc_id).cast("long")
    low, high, quantiles = docs.agg(F.min(ids), F.max(ids), F.percentile_approx(ids, [k / ranges for k in range(ranges)], 100 * ranges)).first()
    edges = sorted({float(x) for x in [low or 0, *(quantiles or [])]})
    rows = rows.withColumns({"named": F.col("doc_id").isNotNull(), "k": F.coalesce("doc_id", "h")})
    named, other = bucket_of(F.col("k").cast("double"), edges, float(high or 0) + 1.0, per), bucket_of(F.col("k").cast("double"), [-(2.0**63)], 2.0**63, ranges * per)
    rows = rows.withColumn("bucket", F.when(F.col("named"), named).otherwise(other))
    heads = rows.groupBy("named", "bucket").agg(F.max(F.struct("k", "h")).alias("head"))
    order = Window.orderBy(F.desc("named"), F.desc("bucket"))
    first = F.first(F.struct("named", "head")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select(F.col("named").alias("to_named"), F.col("bucket").alias("to_bucket"), F.coalesce(F.lead(F.struct("named", "head")).over(order), first).alias("next"))
    heads = heads.select("to_named", "to_bucket", F.col("next.named").alias("named"), F.col("next.head.k").alias("k"), F.col("next.head.h").alias("h"))
    own = F.struct("named", "bucket", F.lit(0).alias("halo"))
    sent = F.struct(F.col("to_named").alias("named"), F.col("to_bucket").alias("bucket"), F.lit(1).alias("halo"))
    placed = rows.join(F.broadcast(heads), ["named", "k", "h"], "left").select("doc_id", "text", "k", "h", F.explode(F.when(F.col("to_bucket").isNull(), F.array(own)).otherwise(F.array(own, sent))).alias("at"))
    placed = placed.select("doc_id", "text", "k", "h", "at.named", "at.bucket", "at.halo")
    along = Window.partitionBy("named", "bucket").orderBy("halo", F.desc("k"), F.desc("h"))
    return placed.withColumn("next_text", F.lead("text").over(along)), along


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fraction: float = FRACTION, words: int = WORDS) -> DataFrame:
    """Each document beside an edited copy and beside the next document.

    The edited text has the last floor(n/2) of n code points replaced by as many (or all) from the start of the next
    document. Columns: doc_id, text, edited, sketch, edited_sketch, near_edited, near_next. One shuffle of the texts.
    """
    rows, along = with_next(docs, doc_id, text)
    sketched = rows.withColumn("sketch", scaled_sketch(F.col("text"), fraction, words))
    half = F.floor(F.length("text") / 2).cast("int")
    paired = sketched.withColumn("next_sketch", F.lead("sketch").over(along)).filter("halo = 0")
    edited = paired.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)))
    edited = edited.withColumn("edited_sketch", scaled_sketch(F.col("edited"), fraction, words))
    return edited.select("doc_id", "text", "edited", "sketch", "edited_sketch", likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"), likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
