"""Line dedup by content-defined chunks: passages of several lines that occur more than once stay at their first place.

A line is what ends at a newline or at a punctuation mark and space, so a passage within a paragraph has lines too. A
rolling hash goes over the hashes of neighbouring lines, by windows of two lines or of as many as it takes to have
`chunk_chars` characters; an empty line counts for one, so these are `chunk_chars` lines at most. Where it is divisible by `mean_lines` there is a boundary, so boundaries depend on content alone
and shift with it. A boundary whose rolling hash occurs twice in the corpus anchors a chunk, the lines from the boundary
before to the one behind. A passage seldom begins and ends at boundaries, so all windows in such chunks are looked up, to
both sides of a line; a line that is long by itself (`lone_chars` characters or more than `lone_words` words) is a window
too. Windows with the same first 16 bytes of the SHA-256 of their bytes are equal; the first of them, the one in the smallest
doc_id, stays and the others go. What is taken out must add up to a run of
`least_chars` characters, so short headings and formulas stay. Each line that goes has an equal one before it that stays.
Equal texts, by two 64-bit hashes of the whole text, are one class: its first document goes through all this, its other copies
are emptied if they are long enough.

With mean_lines=1 all windows are looked up and all repeated ones are found; the default looks up half as many hashes and
misses some short passages (README).

Defined results: a null text stays null; a text that is taken out wholly becomes empty, its row stays; rows equal in id
and text, rows without an id too, are one document and keep the same text; rows of one id with several texts are several
documents; a row without an id comes after all others; an empty table gives an empty table; a very long text is one row
like any other, cut into an array of its lines; other columns are untouched, whatever their names. Only built-in functions
are used.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fennmark.llm.common import let, whole, written

#: The tests cut lines at CLOSES with the help of MARK.
MARK, CLOSES = "\x01", ("\n", ". ", "! ", "? ", "; ", ": ", ", ")
#: The same as a regular expression: a newline or one of ENDS and a space.
ENDS = "".join(close[0] for close in CLOSES[1:])
CLOSE = rf"\n|[{ENDS}] "
NO_ID = 2**63 - 1
#: Windows of up to so many lines are written out as expressions; longer ones, of very short lines, are added up line by line.
WRITTEN_OUT = 8
#: From the boundary behind, at least so many lines are looked up where two have too few characters.
REACH = 8
#: Windows of texts with seeds that occur more often are dealt over several tasks; results do not depend on it.
SALT_ROWS = 10_000


def lines(text: Column) -> Column:
    """The text cut into lines that join to the text again. All quantifiers are possessive, so this neither looks back nor recurs."""
    return F.when(text == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(text, F.lit(f"(?:[^{ENDS}\\n]++|[{ENDS}](?! ))++(?:{CLOSE})?|{CLOSE}"), F.lit(0)))


def bare(line: Column) -> Column:
    """A line without the spaces and the newline around it (one may end where another goes on)."""
    return F.trim(F.replace(line, F.lit("\n"), F.lit(" ")))


def is_lone(line: Column, chars: Column, lone_chars: int, lone_words: int) -> Column:
    return (chars > 2 * lone_words) & ((chars >= lone_chars) | (chars - F.length(F.replace(line, F.lit(" "), F.lit(""))) >= lone_words))


class Page:
    """The lines of a text as columns: b (bare), h (hashes, where they are asked for), c (characters, as doubles: in lambdas
    Spark adds these faster than whole numbers, whose overflow it guards by a call)."""

    def __init__(self, b: Column, h: Column | None, c: Column, chunk_chars: int, lone_chars: int, lone_words: int) -> None:
        self.b, self.h, self.c, self.chunk_chars, self.lone_chars, self.lone_words = b, h, c, chunk_chars, lone_chars, lone_words

    def crowded(self) -> Column:
        """Whether there may be WRITTEN_OUT lines with too few characters: one such run has all but two of its lines behind every third."""
        chars = lambda k, n: sum([F.get(self.c, k + m) for m in range(1, n)], F.get(self.c, k))
        small = lambda k: (chars(k, 3) < self.chunk_chars) & (chars(k, WRITTEN_OUT - 2) < self.chunk_chars)
        return F.coalesce(F.exists(F.sequence(F.lit(0), F.size(self.c) - 1, F.lit(3)), small), F.lit(False))

    def many(self, at: Column) -> Column:
        """array of spot(start, n): the windows of more than WRITTEN_OUT lines that begin or end at the lines `at`."""

        def short(k: Column, step: int) -> Column:
            chars = [F.get(self.c, k + step * m) for m in range(WRITTEN_OUT)]
            # Each line has a character at least, so most lines are done with by three.
            return (sum(chars[1:3], chars[0]) < self.chunk_chars) & (sum(chars[1:], chars[0]) < self.chunk_chars) & self.goes_on(k, step)

        def behind(k: Column) -> Column:
            chars = lambda n: F.aggregate(F.slice(self.c, k - n + 2, n - 1), F.lit(0.0), lambda s, x: s + x)
            return let(self.added_up(k, -1), lambda n: F.when(chars(n) >= self.chunk_chars, spot(k - n + 1, n)))

        ahead = F.transform(F.filter(at, lambda k: short(k, 1)), lambda k: let(self.added_up(k, 1), lambda n: spot(k, n)))
        back = F.transform(F.filter(at, lambda k: short(k, -1)), behind)
        return F.when(self.crowded(), F.filter(F.concat(ahead, back), lambda w: w.isNotNull())).otherwise(F.array().cast("array<bigint>"))

    def goes_on(self, k: Column, step: int = 1) -> Column:
        """Whether the text has lines beyond those that are written out."""
        return k + WRITTEN_OUT < F.size(self.c) if step > 0 else k >= WRITTEN_OUT

    def far(self, k: Column) -> Column:
        """How many lines the window from line k on has, where WRITTEN_OUT lines have too few characters; else null."""
        return F.when(self.goes_on(k) & (sum([F.get(self.c, k + m) for m in range(1, WRITTEN_OUT)], F.get(self.c, k)) < self.chunk_chars), self.added_up(k, 1))

    def added_up(self, k: Column, step: int) -> Column:
        """The same by adding up; each line has a character at least, so no more than chunk_chars lines are looked at."""
        start = k + 1 if step > 0 else F.greatest(k + 2 - self.chunk_chars, F.lit(1))
        near = F.slice(self.c, start, self.chunk_chars if step > 0 else k + 2 - start)
        so_far = F.struct(F.lit(0).alias("n"), F.lit(0.0).alias("chars"))
        more = lambda s, x: F.when(s["chars"] >= self.chunk_chars, s).otherwise(F.struct((s["n"] + 1).alias("n"), (s["chars"] + x).alias("chars")))
        return F.aggregate(near if step > 0 else F.reverse(near), so_far, more, lambda s: F.when((s["chars"] >= self.chunk_chars) & (s["n"] > 1), s["n"]))

    def is_lone(self, k: Column) -> Column:
        return is_lone(F.get(self.b, k), F.get(self.c, k), self.lone_chars, self.lone_words)


def on_page(text: Column, body: Callable[[Page], Column], *sizes: int, hashed: bool = True) -> Column:
    counted = lambda b, h: let(F.transform(b, lambda x: F.greatest(F.length(x), F.lit(1)).cast("double")), lambda c: body(Page(b, h, c, *sizes)))
    return let(F.transform(lines(text), bare), lambda b: let(F.transform(b, lambda x: F.xxhash64(x)), lambda h: counted(b, h)) if hashed else counted(b, None))


def spot(start: Column, n: Column) -> Column:
    """A window as one number; null where n is null."""
    return F.shiftleft(start.cast("long"), 32).bitwiseOR(n.cast("long"))


def span(lo: Column, hi: Column) -> Column:
    """The lines from lo up to hi as one number."""
    return spot(lo, hi).alias("span")


def seeds(texts: DataFrame, mean_lines: int, *sizes: int) -> DataFrame:
    """(the columns of texts but text, hash, span): the rolling hashes that are boundaries, and the lines from the boundary
    before through the window of the one behind, as span() packs them. Boundaries become rows before their spans are made, so
    that this is compiled and not run by lambdas."""

    def of(page: Page) -> Column:
        at = F.sequence(F.lit(0), F.size(page.h) - 1)

        def rolling(k: Column) -> Column:
            """The hash of the window from line k on; null where WRITTEN_OUT lines or all that the text has are too few characters."""
            chars, hashes, out = F.get(page.c, k), [F.get(page.h, k)], F
            for m in range(1, WRITTEN_OUT):
                chars, hashes = chars + F.get(page.c, k + m), [*hashes, F.get(page.h, k + m)]
                out = out.when(chars >= page.chunk_chars, F.xxhash64(*hashes))
            return out

        def marked(r: Column, far: Column | None) -> Column:
            def packed(w: Column) -> Column:
                n = F.lit(None).cast("array<int>") if far is None else F.transform(w, lambda k: F.get(far, k))
                return F.struct(page.h.alias("h"), page.c.alias("c"), r.alias("r"), w.alias("w"), n.alias("far"), F.filter(at, page.is_lone).alias("lone"))

            return let(F.filter(at, lambda k: F.pmod(F.get(r, k), F.lit(mean_lines)) == 0), packed)

        def long(r: Column) -> Column:
            """The same where windows are of more lines."""
            hashed = lambda far: F.transform(at, lambda k: F.when(F.get(far, k).isNull(), F.get(r, k)).otherwise(F.xxhash64(F.slice(page.h, k + 1, F.get(far, k)))))
            return let(F.transform(at, page.far), lambda far: let(hashed(far), lambda all_: marked(all_, far)))

        return let(F.transform(at, rolling), lambda r: F.when(page.crowded(), long(r)).otherwise(marked(r, None)))

    keep = [c for c in texts.columns if c != "text"]
    cut = texts.select(*keep, on_page(F.col("text"), of, *sizes).alias("page")).select(*keep, "page.*")
    rows = cut.select(*keep, "h", "c", "r", "w", "far", F.posexplode(F.concat("w", "lone")).alias("q", "k"))
    q, k, behind = F.col("q"), F.col("k"), F.col("behind")
    near = rows.select(*keep, "h", "c", "r", k, (q >= F.size("w")).alias("lone"), F.coalesce(F.get("w", q - 1), F.lit(0)).alias("lo"), F.get("w", q + 1).alias("behind"), F.get("far", q + 1).alias("far"))
    # Two lines, mostly, or REACH, or as many as the window of the boundary behind has.
    reach = F.when(F.get("c", behind) + F.get("c", behind + 1) >= sizes[0], 2).otherwise(F.coalesce("far", F.lit(REACH)))
    between = span(F.col("lo"), F.coalesce(behind + reach, F.size("c")))
    return near.select(*keep, F.when(F.col("lone"), F.xxhash64(F.lit(1), F.get("h", k))).otherwise(F.get("r", k)).alias("hash"), F.when(F.col("lone"), span(k, k + 1)).otherwise(between).alias("span"))


def few(chars: list[Column], chunk_chars: int, back: bool) -> Column:
    """How many of the lines that have so many characters make a window, two at least; back: only three or more that make one
    without the first too, as the others are found from their other end. Else null."""
    out, total = F, chars[0]
    for m in range(2, len(chars) + 1):
        total = total + chars[m - 1]
        out = out.when(total >= chunk_chars, F.when((total - chars[0] >= chunk_chars) & F.lit(m > 2), m) if back else F.lit(m))
    return F.when(chars[1] > 0, out)


def windows(texts: DataFrame, *sizes: int) -> DataFrame:
    """(the columns of texts but text and spans, start, n, bytes): the windows that start or end at a line within spans,
    an array of what span() packs. Lines become rows before windows are hashed, so that this is compiled and not run by lambdas."""

    def of(page: Page) -> Column:
        at = F.filter(F.array_distinct(F.flatten(F.transform("spans", lambda s: F.sequence(F.shiftright(s, 32).cast("int"), s.bitwiseAND(F.lit(2**32 - 1)).cast("int") - 1)))), lambda k: k < F.size(page.c))
        return F.struct(page.b.alias("b"), page.c.alias("c"), at.alias("at"), page.many(at).alias("many"))

    keep = [c for c in texts.columns if c not in ("text", "spans")]
    cut = texts.select(*keep, on_page(F.col("text"), of, *sizes, hashed=False).alias("page")).select(*keep, "page.*")
    # Windows of many lines come once a text, with a line before the first.
    lined = cut.select(*keep, "b", "c", "many", F.explode(F.concat(F.array(F.lit(-1)), F.col("at"))).alias("k"))
    # Lines beyond the ends have no characters. Columns of their own keep the compiled code short enough for the JVM's compiler.
    k, around = F.col("k"), {m: f"c{m}" for m in range(1 - WRITTEN_OUT, WRITTEN_OUT)}
    near = lined.select(*keep, "b", "many", "k", *[F.coalesce(F.get("c", k + m), F.lit(0.0)).alias(c) for m, c in around.items()])
    counts = near.select(*keep, "b", "many", "k", few([F.col(around[m]) for m in range(WRITTEN_OUT)], sizes[0], False).alias("ahead"), few([F.col(around[-m]) for m in range(WRITTEN_OUT)], sizes[0], True).alias("back"), is_lone(F.get("b", k), F.col(around[0]), *sizes[1:]).alias("lone"))
    one = F.array(spot(k, F.col("ahead")), spot(k - F.col("back") + 1, F.col("back")), spot(k, F.when(F.col("lone"), 1)))
    spots = counts.select(*keep, "b", F.explode(F.when(k < 0, F.col("many")).otherwise(one)).alias("spot")).filter("spot is not null")
    spots = spots.select(*keep, "b", F.shiftright("spot", 32).cast("int").alias("start"), F.col("spot").bitwiseAND(F.lit(2**32 - 1)).cast("int").alias("n"))
    pair = F.col("n") == 2
    first, second = F.get("b", F.col("start")), F.get("b", F.col("start") + 1)
    data = F.when(pair, F.concat(first, F.lit("\n"), second)).otherwise(F.array_join(F.slice("b", F.col("start") + 1, F.col("n")), "\n"))
    return spots.select(*keep, "start", "n", F.substring(F.unhex(F.sha2(data, 256)), 1, 16).alias("bytes"))


def without(text: Column, spans: Column, least_chars: int) -> Column:
    """The text without the lines in spans, an array of (start, n), where they make runs of least_chars characters or more."""

    def rebuilt(u: Column) -> Column:
        def runs(c: Column) -> Column:
            at = F.sequence(F.lit(0), F.size(c) - 1)
            opens = F.filter(at, lambda k: (k == 0) | (F.get(c, k) != F.get(c, k - 1) + 1))
            ends = F.filter(at, lambda k: (k == F.size(c) - 1) | (F.get(c, k + 1) != F.get(c, k) + 1))
            spans_ = F.zip_with(opens, ends, lambda a, b: F.struct(F.get(c, a).alias("a"), F.get(c, b).alias("b")))
            long = F.filter(spans_, lambda r: F.aggregate(F.slice(u, r["a"] + 1, r["b"] - r["a"] + 1), F.lit(0), lambda s, x: s + F.length(x)) >= least_chars)
            return F.flatten(F.transform(long, lambda r: F.sequence(r["a"], r["b"])))

        covered = F.sort_array(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))))
        kept = F.array_except(F.sequence(F.lit(0), F.size(u) - 1), let(covered, runs))
        return F.array_join(F.transform(kept, lambda i: F.get(u, i)), "")

    return let(lines(text), rebuilt)


def _hashable(kind: T.DataType) -> bool:
    """Whether hash() takes the type: none with a map or a variant in it."""
    return not any(word in kind.simpleString() for word in ("map<", "variant"))


def repeated_spans(rows: DataFrame, text: str, mean_lines: int, *sizes: int) -> DataFrame:
    """(ka, kb, first, copied, spans) of the classes of equal texts that have something to take out: the id of the first
    document, whether there are others, and what to take out of the first, an array of (start, n) or null. rows have k1, the
    id, and ka and kb, two hashes of the text."""
    found = written(seeds(rows.select("k1", "ka", "kb", whole(text).alias("text")), mean_lines, *sizes))
    classes = written(found.groupBy("ka", "kb").agg(F.min("k1").alias("first"), (F.min("k1") < F.max("k1")).alias("copied")))
    # Written, so that the join with it has plain shuffles on both sides: Spark splits those where a hash is very common.
    # What is repeated in copies of one text alone is left to the class.
    place = F.xxhash64("ka", "kb", "span")
    often = written(found.groupBy("hash").agg(F.count("*").alias("times"), F.min(place).alias("a"), F.max(place).alias("b")).filter("a <> b").select("hash", "times"))
    places = found.select("hash", "ka", "kb", "span").join(often, "hash")
    wanted = written(places.groupBy("ka", "kb").agg(F.collect_set("span").alias("spans"), F.max("times").alias("times")).join(classes, ["ka", "kb"]))
    # The condition reads all columns, so that these joins and the last one share one shuffle of the texts.
    hashed = [f.name for f in rows.schema.fields if _hashable(f.dataType)]

    def looked(of: DataFrame, *more: Column) -> DataFrame:
        """The windows near the anchors of some of the wanted texts."""
        held = of.select("ka", "kb", "first", "times", F.col("spans").alias("near"))
        firsts = rows.withColumnRenamed("k1", "id").join(held, ["ka", "kb"]).filter((F.col("id") <= F.col("first")) & (F.hash("first", *["id" if c == "k1" else c for c in hashed]) >= -(2**31)))
        return windows(firsts.select(F.col("id").alias("k1"), "ka", "kb", *more, whole(text).alias("text"), F.col("near").alias("spans")), *sizes)

    def placed(windowed: DataFrame, *dealt: str) -> DataFrame:
        """With behind = 0 for the first window of the same bytes, among those dealt alike. Not by rank(): for its firsts Spark
        would plan a window of their own, which could not share the shuffle with that of the others."""
        return windowed.withColumn("behind", F.percent_rank().over(Window.partitionBy("bytes", *dealt).orderBy("k1", "ka", "kb", "start")))

    # Windows of texts with a common anchor are first compared within a deal, and the first of each deal go on. Deals change no
    # result, as what is not first in its deal is not first in all. Without such texts this part is empty and Spark drops it.
    common = placed(looked(wanted.filter(F.col("times") > SALT_ROWS), F.pmod(F.xxhash64("ka", "kb"), F.ceil(F.col("times") / SALT_ROWS)).alias("salt")), "salt")
    rest = looked(wanted.filter(F.col("times") <= SALT_ROWS)).unionByName(common.filter("behind = 0").drop("salt", "behind"))
    later = placed(rest).filter("behind > 0").select("ka", "kb", "start", "n").unionByName(common.filter("behind > 0").select("ka", "kb", "start", "n"))
    gone = later.groupBy("ka", "kb").agg(F.collect_set(F.struct("start", "n")).alias("spans"))
    return classes.join(gone, ["ka", "kb"], "left").filter("copied or spans is not null")


def drop_repeated_chunks(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    n_chars: str | None = "n_chars",
    mean_lines: int = 2,
    chunk_chars: int = 36,
    least_chars: int = 90,
    lone_chars: int = 280,
    lone_words: int = 50,
) -> DataFrame:
    """docs with repeated passages taken out of the text; a column n_chars, if there is one, follows the new text."""
    names, kinds = docs.columns, dict(docs.dtypes)
    at = {c: f"c{k}" for k, c in enumerate(names)}  # names of ours cannot clash with theirs
    held = whole(F.col(f"`{text}`"))
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(NO_ID)).alias("k1"), F.xxhash64(held).alias("ka"), F.xxhash64(F.lit(1), held).alias("kb"), *[F.col(f"`{c}`").alias(at[c]) for c in names if c != doc_id])
    joined = rows.join(repeated_spans(rows, at[text], mean_lines, chunk_chars, lone_chars, lone_words), ["ka", "kb"], "left")
    old = F.col(at[text])
    long = (F.length(old) >= least_chars) & (old.rlike(rf"(?s)(?:{CLOSE}).") | is_lone(old, F.length(old), lone_chars, lone_words))
    new = F.when(F.col("k1") > F.col("first"), F.when(long, F.lit("")).otherwise(old)).when(F.col("spans").isNotNull(), without(old, F.col("spans"), least_chars)).otherwise(old)
    joined = joined.withColumn("new", F.when(F.col("first").isNull(), old).otherwise(new))
    out = {doc_id: F.when(F.col("k1") != NO_ID, F.col("k1")).cast(kinds[doc_id]), text: F.col("new")}
    if n_chars in names:
        out[n_chars] = F.when(F.col("first").isNull(), F.col(at[n_chars])).otherwise(F.length("new").cast(kinds[n_chars]))
    return joined.select(*[(out[c] if c in out else F.col(at[c])).alias(c) for c in names])
