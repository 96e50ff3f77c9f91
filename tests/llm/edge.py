"""Rows with every oddity, used by the tests of all operators on documents."""

from fennmark.llm.common import table
from tests.oracle import SF

LONG = "Eine lange Zeile, mit Komma. " * 4000
#: (doc_id, text): null and repeated ids, null, empty, blank and very long texts, repeated rows, ties, no ASCII, a control mark.
ROWS = [(1, "One two three four five six seven."), (2, None), (3, ""), (4, " \n\t "), (5, LONG), (6, "One two three four five six seven."), (6, "One two three four five six seven."), (None, "no id here at all, none"), (None, None), (8, "naïve café \U0001f600 文字 \x01 end"), (9, "x"), (6, "Another text of the same id.")]
#: Names that the operators use inside themselves.
CLASHES = ["hash", "key", "size", "n", "score", "k1", "k2", "h", "spans", "new", "bucket", "vertex", "f0", "grp", "shard", "seen", "start", "c0", "c1", "part", "y", "label"]


def documents(spark, rows=None):
    """The rows as documents with columns whose names clash."""
    rows = ROWS if rows is None else rows
    plain = spark.createDataFrame([(i, t, None, None, None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    from pyspark.sql import functions as F

    return plain.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHES])


def prose(spark, n=60):
    """Some of the driver's documents as (doc_id, text), under 3,000 characters."""
    rows = table(spark, SF, "documents").filter("n_chars between 600 and 3000").orderBy("doc_id").limit(n).select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]
