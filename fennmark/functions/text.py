"""Text functions over built-in Spark SQL; all take and return columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9][0-9 ().-]{7,}[0-9]"


def normalise(text: Column) -> Column:
    """Lower case, runs of white space as one space, trimmed."""
    return F.trim(F.regexp_replace(F.lower(text), r"[ \t\r\n]+", " "))


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits, without empty ones."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value worked out once a row, even where body uses it often or within a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def han_bigrams(text: Column) -> Column:
    """Pairs of neighbouring Han characters within unbroken runs; a run of one character is itself. For Chinese text,
    which has no spaces to split at."""
    runs = F.regexp_extract_all(text, F.lit(r"([\x{4E00}-\x{9FFF}]+)"), 1)
    pairs = F.transform(runs, lambda r: F.when(F.length(r) == 1, F.array(r)).otherwise(F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda k: F.substring(r, k, F.lit(2)))))
    return F.flatten(pairs)


def mixed_tokens(text: Column) -> Column:
    """Tokens of text that changes between scripts: a run of Han characters as its bigrams, any other run of letters and digits
    as a lower-case word. A run ends where the script does, so words that stand in Chinese text unspaced are words too."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"([\x{4E00}-\x{9FFF}]+|[\p{L}\p{N}&&[^\x{4E00}-\x{9FFF}]]+)"), 1)
    return F.flatten(F.transform(runs, lambda r: F.when(r.rlike(r"^[\x{4E00}-\x{9FFF}]"), han_bigrams(r)).otherwise(F.array(r))))


def html_to_text(html: Column) -> Column:
    """Markup, scripts, styles and comments as spaces; white space runs as one space."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"[ \t\r\n]+", " "))


def redact(text: Column) -> Column:
    """E-mail addresses and phone numbers as [EMAIL] and [PHONE]; doing it twice changes nothing more."""
    return F.regexp_replace(F.regexp_replace(text, EMAIL, "[EMAIL]"), PHONE, "[PHONE]")


def url_host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def url_parameter(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def sample_bucket(key: Column, buckets: int) -> Column:
    """0 to buckets - 1 by the key's MD5, the same on any engine."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint") % buckets
