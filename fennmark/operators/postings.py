"""A persisted inverted index: its forward table, dictionary and postings, and BM25 and vectors from it without the texts.

In the index's folder stand
  forward   (doc_id, block, length, terms array<(term, tf)>)   what each document has, from one reading of the texts
  stats     (n_docs, mean_length)                              one row
  terms     bucket=K/ (term, df, tf)                           the dictionary
  postings  bucket=K/ (term, block, n, weight, df, docs array<(doc_id, tf, length)>)
A bucket is a hash of the term, so a question reads the few folders of its terms, and within them the row groups of its terms, as
rows are sorted by term. A block is a range of document ids; the postings of a term are one row for each block that has
it, sorted by id, so the postings of the commonest term are spread over as many rows as there are blocks. `weight` is the greatest BM25
weight, without the idf, in the row: a bound for all of its documents.

Defined results: null texts and texts without words have length 0 and no postings; documents without an id are left out, as no
question could name them; rows of one id count as one document each; ties go to the smaller id; of no documents the index is empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fennmark.functions.text import let, tokens

K1, B = 1.2, 0.75
#: Postings of a task when they are dealt by term.
TASK_POSTINGS = 1_000_000
#: Declared, so that an empty index can be read too.
SCHEMAS = {
    "forward": "doc_id long, block int, length int, terms array<struct<term:string,tf:int>>",
    "stats": "n_docs long, mean_length double",
    "terms": "term string, df long, tf long, bucket int",
    "postings": "term string, block int, n long, weight double, df long, docs array<struct<doc_id:bigint,tf:int,length:int>>, bucket int",
}


def term_frequencies(words: Column) -> Column:
    """array<(term, tf)> of a list of words, sorted by term: the words are sorted in the row, where each term is a run."""

    def runs(w: Column) -> Column:
        opens = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda k: F.coalesce(F.get(w, k - 1) != F.get(w, k), F.lit(True)))
        return let(opens, lambda at: F.transform(at, lambda k, j: F.struct(F.get(w, k).alias("term"), (F.coalesce(F.get(at, j + 1), F.size(w)) - k).cast("int").alias("tf"))))

    nothing = F.array().cast("array<struct<term:string,tf:int>>")
    return let(F.sort_array(words), lambda w: F.when(F.size(w) > 0, runs(w)).otherwise(nothing))


def saturation(tf: Column, length: Column, mean_length: Column) -> Column:
    """BM25's weight of a term in a document, without the idf."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))


def idf(df: Column, n_docs: Column) -> Column:
    return F.ln(1 + (n_docs - df + 0.5) / (df + 0.5))


@dataclass(frozen=True)
class Postings:
    """An index in its folder."""

    spark: SparkSession
    folder: str
    buckets: int

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(SCHEMAS[name]).parquet(f"{self.folder}/{name}")

    @property
    def forward(self) -> DataFrame:
        return self._read("forward")

    @property
    def stats(self) -> DataFrame:
        return self._read("stats")

    def terms(self, asked: list[str] | None = None) -> DataFrame:
        """(term, df, tf) of all terms, or of the asked ones from their buckets alone."""
        return self._of(self._read("terms"), asked).select("term", "df", "tf")

    def postings(self, asked: list[str] | None = None) -> DataFrame:
        """(term, block, n, weight, df, docs)."""
        return self._of(self._read("postings"), asked).drop("bucket")

    def _of(self, rows: DataFrame, asked: list[str] | None) -> DataFrame:
        if asked is None:
            return rows
        # Both are constants to the optimiser: the first prunes folders, the second goes down to the row groups.
        return rows.filter(F.col("bucket").isin(*[bucket_of(F.lit(t), self.buckets) for t in asked]) & F.col("term").isin(*asked))

    def bm25(self, asked: list[str], of: DataFrame | None = None) -> DataFrame:
        """(doc_id, score) of every document that has one of the terms and, if `of` (doc_id) is given, is there."""
        hits = self.postings(asked).select("term", "df", F.inline("docs"))
        hits = hits if of is None else hits.join(of.select("doc_id"), "doc_id", "left_semi")
        return _summed(hits, self.stats)

    def best(self, asked: list[str], k: int, first_blocks: int = 2) -> DataFrame:
        """(doc_id, score) of the k documents of greatest BM25, ties by id, by block maxima.

        The sum of its terms' weights bounds every document of a block. The blocks of greatest bound are scored first; of the
        others only those are read on whose bound reaches the k-th score found there."""
        weighed = self.postings(asked).crossJoin(F.broadcast(self.stats)).groupBy("block").agg(F.sum(F.col("weight") * idf(F.col("df"), F.col("n_docs"))).alias("bound"))
        head = weighed.orderBy(F.desc("bound"), "block").limit(first_blocks * k)
        first = [r["block"] for r in head.collect()]  # at most first_blocks * k numbers
        rows = lambda hits: _summed(hits.select("doc_id", "term", "df", "tf", "length"), self.stats).orderBy(F.desc("score"), "doc_id").limit(k)
        opened = self.postings(asked).select("term", "block", "df", F.inline("docs"))
        found = rows(opened.filter(F.col("block").isin(*first))).collect()
        least = found[-1]["score"] if len(found) == k else -math.inf
        # Scores are rounded to six digits, so a bound within that of the k-th may tie with it.
        able = [r["block"] for r in weighed.filter(F.col("bound") >= least - 2e-6).select("block").limit(10_001).collect()]
        kept = opened.filter(F.col("block").isin(*able)) if len(able) <= 10_000 else opened.join(weighed.filter(F.col("bound") >= least - 2e-6), "block", "left_semi")
        return rows(kept)

    def vectors(self, dims: int = 256) -> DataFrame:
        """(doc_id, vector): feature-hashed tf-idf of every document with words, of length 1; see hashed()."""
        weight = idf(F.col("df"), F.col("n_docs"))
        # The documents of a block meet by whole rows of postings, so no posting is shuffled alone; sums need no further shuffle then.
        rows = self.postings().crossJoin(F.broadcast(self.stats)).select("block", *hashed(F.col("term"), dims), weight.alias("idf"), F.col("docs.doc_id").alias("ids"), F.col("docs.tf").alias("tfs"))
        each = rows.repartition("block").select("block", "dim", "sign", "idf", F.inline(F.arrays_zip("ids", "tfs")))
        return gathered(each.select("block", F.col("ids").alias("doc_id"), "dim", "sign", (F.col("tfs") * F.col("idf")).alias("weight")), dims, "block")

    def question_vector(self, asked: list[str], dims: int = 256) -> DataFrame:
        """(doc_id, vector) of one row, id null: the asked terms that the index has, each once."""
        each = self.terms(asked).crossJoin(F.broadcast(self.stats))
        return gathered(each.select(F.lit(None).cast("bigint").alias("doc_id"), *hashed(F.col("term"), dims), idf(F.col("df"), F.col("n_docs")).alias("weight")), dims)


def bucket_of(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def _summed(hits: DataFrame, stats: DataFrame) -> DataFrame:
    scored = hits.crossJoin(F.broadcast(stats))  # one row
    part = idf(F.col("df"), F.col("n_docs")) * saturation(F.col("tf"), F.col("length"), F.col("mean_length"))
    return scored.groupBy("doc_id").agg(F.round(F.sum(part), 6).alias("score"))  # a row for each term asked and document


def hashed(term: Column, dims: int) -> tuple[Column, Column]:
    """(dim, sign) of a term, by digits of its MD5."""
    digits = lambda a, n: F.conv(F.substring(F.md5(term), a, n), 16, 10).cast("bigint")
    return (digits(1, 6) % dims).cast("int").alias("dim"), F.when(digits(7, 1) < 8, 1).otherwise(-1).alias("sign")


def gathered(parts: DataFrame, dims: int, *by: str) -> DataFrame:
    """(doc_id, vector) of rows (doc_id, dim, sign, weight): sums by dimension, scaled to length 1; without a sum, zeros.
    by: columns that go with doc_id, by which the rows lie together already."""
    sums = parts.groupBy(*by, "doc_id", "dim").agg(F.sum(F.col("sign") * F.col("weight")).alias("x"))
    cells = sums.groupBy(*by, "doc_id").agg(F.map_from_entries(F.collect_list(F.struct("dim", "x"))).alias("m"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("norm"))  # at most dims cells
    unit = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: F.coalesce(F.try_element_at("m", k) / F.nullif("norm", F.lit(0.0)), F.lit(0.0)))
    return cells.select("doc_id", unit.alias("vector"))


def cosine(vectors: DataFrame, question: DataFrame) -> DataFrame:
    """(doc_id, score): the cosine of each vector, of length 1, to the one row of `question`, where it is over 0."""
    both = vectors.crossJoin(F.broadcast(question.select(F.col("vector").alias("asked"))))  # one row
    dot = F.aggregate(F.zip_with("vector", "asked", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return both.select("doc_id", F.round(dot, 6).alias("score")).filter("score > 0")


def build_postings(docs: DataFrame, folder: str, doc_id: str = "doc_id", text: str = "text", tokenise: Callable[[Column], Column] = tokens, buckets: int = 64, block_docs: int = 4096, most_blocks: int = 4096) -> Postings:
    """Writes the index to `folder`. Blocks are ranges between quantiles of the ids, of about block_docs documents each, or of
    more where that would be more than most_blocks."""
    spark = docs.sparkSession
    index = Postings(spark, folder, buckets)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")).filter("doc_id is not null")
    n = rows.count()
    blocks = max(1, min(most_blocks, math.ceil(n / block_docs)))
    edges = sorted({*(rows.agg(F.percentile_approx("doc_id", [k / blocks for k in range(1, blocks)], 100 * blocks)).first()[0] or [])}) if blocks > 1 else []
    block = F.size(F.filter(F.lit(edges), lambda e: e < F.col("doc_id"))) if edges else F.lit(0)
    words = F.coalesce(tokenise(F.col("text")), F.array().cast("array<string>"))
    made = rows.select("doc_id", block.cast("int").alias("block"), let(words, lambda w: F.struct(F.size(w).alias("length"), term_frequencies(w).alias("terms"))).alias("x"))
    made.select("doc_id", "block", "x.*").write.parquet(f"{folder}/forward")
    facts = index.forward.agg(F.count("*").alias("n_docs"), F.avg("length").alias("mean_length"), F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()
    spark.createDataFrame([facts[:2]], SCHEMAS["stats"]).coalesce(1).write.parquet(f"{folder}/stats")
    # Documents meet by block, where their postings are gathered without a shuffle of each; the rows of a term and block are then
    # dealt by term, a few arrays each, and df is added up there. So the hottest term is one row for each block, and a task has about
    # TASK_POSTINGS whatever the number of documents, which it can sort in memory.
    each = index.forward.repartitionByRange(blocks, "block").select("doc_id", "block", "length", F.inline("terms"))
    weight = F.max(saturation(F.col("tf"), F.col("length"), F.lit(facts["mean_length"]).cast("double"))).alias("weight")
    held = each.groupBy("block", "term").agg(F.sum("tf").cast("bigint").alias("tf"), weight, F.sort_array(F.collect_list(F.struct("doc_id", "tf", "length"))).alias("docs"))
    tasks = max(1, math.ceil(facts["n"] / TASK_POSTINGS))
    dealt = held.select(
        bucket_of(F.col("term"), buckets).alias("bucket"),
        F.pmod(F.hash("term"), F.lit(4 * math.ceil(tasks / buckets))).alias("part"),
        *("term", "block", "weight", F.col("tf").alias("own")),
        *[F.col(f"docs.{c}").alias(c) for c in ("doc_id", "tf", "length")],
    ).repartition(tasks, "bucket", "part")
    n, same = F.size("doc_id").cast("bigint"), Window.partitionBy("bucket", "part", "term")
    summed = dealt.select("*", n.alias("n"), F.sum(n).over(same).alias("df"), F.sum("own").over(same).alias("all"), (F.min("block").over(same) == F.col("block")).alias("head"))
    # The term's first row has its occurrences for the dictionary.
    made = summed.select("term", "block", "n", "weight", "df", F.arrays_zip("doc_id", "tf", "length").alias("docs"), F.when(F.col("head"), F.col("all")).alias("tf"), "bucket")
    made.sortWithinPartitions("bucket", "term", "block").write.partitionBy("bucket").parquet(f"{folder}/postings")
    firsts = spark.read.schema("term string, df long, tf long, bucket int").parquet(f"{folder}/postings").filter("tf is not null")
    _write(firsts, f"{folder}/terms", "term")
    return index


def _write(rows: DataFrame, folder: str, *order: str) -> None:
    """By bucket; a bucket goes to a few tasks by a hash of the term, so a file has few row groups and each a range of terms."""
    parts = F.pmod(F.hash(*order), F.lit(4))
    rows.repartition("bucket", parts).sortWithinPartitions("bucket", *order).write.partitionBy("bucket").parquet(folder)
