"""Readers of versioned catalogues kept as Markdown, and of directory trees used as classification.

The parsers take a DataFrame with a text column `value`, as spark.read.text gives it. Versions such as 2.2025 become
(year, rev): they look like decimals, but 1.2026 is later than 2.2025. Names are never split at `/`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKERS = r"[\x{1F3AF}\x{2705}]"
LINK = r"\[(.+)\]\(([^()\s]+)\)"


def version(text: Column) -> Column:
    """struct(year, rev) of `rev.year`; null if it is none."""
    rev, year = F.regexp_extract(text, r"([0-9]+)\.([0-9]{4})", 1), F.regexp_extract(text, r"([0-9]+)\.([0-9]{4})", 2)
    return F.when(year != "", F.struct(year.cast("int").alias("year"), rev.cast("int").alias("rev")))


def guide_id(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit("id")).try_cast("int")


def _cells(lines: DataFrame) -> DataFrame:
    """Rows of a pipe table whose first cell is a number; a stray pipe at the end is no cell."""
    row = F.regexp_replace(F.trim("value"), r"^\||\|+\s*$", "")
    return lines.select(F.transform(F.split(row, r"\|"), lambda x: F.trim(x)).alias("c")).filter(F.get("c", F.lit(0)).rlike("^[0-9]+$") & (F.size("c") >= 4))


def parse_table(lines: DataFrame) -> DataFrame:
    """(seq, marker, name_en, name_zh, year, rev) of `| seq | name | translation | version |`."""
    c = _cells(lines).select(F.get("c", F.lit(0)).cast("int").alias("seq"), F.get("c", F.lit(1)).alias("name"), F.get("c", F.lit(2)).alias("name_zh"), version(F.get("c", F.lit(3))).alias("v"))
    marker = F.regexp_extract("name", f"({MARKERS})", 1)
    return c.select("seq", F.when(marker != "", marker).alias("marker"), F.trim(F.regexp_replace("name", MARKERS, "")).alias("name_en"), "name_zh", "v.year", "v.rev")


def parse_linked_table(lines: DataFrame) -> DataFrame:
    """(seq, name_en, url, guide_id, year, rev, name_zh) of `| seq | [name](url) | version | translation |`."""
    c = _cells(lines).select(F.get("c", F.lit(0)).cast("int").alias("seq"), F.get("c", F.lit(1)).alias("link"), version(F.get("c", F.lit(2))).alias("v"), F.get("c", F.lit(3)).alias("name_zh"))
    c = c.select("seq", F.regexp_extract("link", LINK, 1).alias("name_en"), F.regexp_extract("link", LINK, 2).alias("url"), "v.year", "v.rev", "name_zh")
    return c.select("seq", "name_en", "url", guide_id(F.col("url")).alias("guide_id"), "year", "rev", "name_zh")


def parse_blocks(files: DataFrame) -> DataFrame:
    """(pos, name_en, url, guide_id, year, rev) of link lines each followed by a version line; value holds a whole file."""
    block = r"\[([^\n]+)\]\(([^()\s]+)\)[^\n]*\n\s*Version: ([0-9]+\.[0-9]{4})"
    found = F.arrays_zip(*[F.regexp_extract_all("value", F.lit(block), k).alias(n) for k, n in ((1, "name_en"), (2, "url"), (3, "version"))])
    rows = files.select(F.posexplode(found).alias("at", "b")).select((F.col("at") + 1).alias("pos"), "b.name_en", "b.url", version(F.col("b.version")).alias("v"))
    return rows.select("pos", "name_en", "url", guide_id(F.col("url")).alias("guide_id"), "v.year", "v.rev")


def parse_summary(lines: DataFrame) -> DataFrame:
    """(system, n) of bullets with a bold name, a full-width colon and a count."""
    bullet = r"^\s*[-*]\s*\*\*(.+?)\*\*\s*[：:]\s*([0-9]+)"
    rows = lines.select(F.regexp_extract("value", bullet, 1).alias("system"), F.regexp_extract("value", bullet, 2).alias("n"))
    return rows.filter("system <> ''").select("system", F.col("n").cast("int").alias("n"))


def read_tree(spark: SparkSession, root: str) -> DataFrame:
    """(path, category, topic, value): every file below root as one row; category and topic are its two innermost folders."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True)
    parts = F.split("_metadata.file_path", "/")
    return files.select(F.col("_metadata.file_path").alias("path"), F.element_at(parts, -3).alias("category"), F.element_at(parts, -2).alias("topic"), "value")
