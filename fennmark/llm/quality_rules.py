"""Quality rules as weak supervision: rules vote or abstain, and what the votes are worth is estimated without labels.

Each rule looks at counts of a text and votes good (1), bad (-1) or abstains (0). Quality is a hidden class. For each class and
rule there is a probability of each vote; expectation-maximisation estimates these accuracies and the share of good texts
from all documents, and the posterior probability of being good replaces the demand that all rules pass. Votes are counted by
pattern first, at most 3 ** rules of them whatever the number of documents, so a round reads that small table alone.

It starts from the texts without a bad vote as good; pseudo-votes keep probabilities off 0 and 1, and in each class an accurate
vote has more of them, so that the classes cannot change places. All rounds are rounded to six digits, so the order of adding does not matter.

Repeated words are found exactly up to collisions of 64-bit hashes of the five words of a window within one text.

Defined results: a null text has no words; an empty text fails the base rule, as does any of under `least_words`
words; a very long text is one row like any other, an array of its words; repeated rows and ties are each judged alike; rows
without an id are judged too; an empty table gives an empty table; further columns are ignored.
Only built-in functions are used.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import let, whole, written

SPACES, SPACE, SYMBOL = " \t\n\x0b\f\r", r"[\x20\x09-\x0D]", "[#*$%&|<>]"
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20
#: Frequent function words of English, French, German and Spanish. Fixed values.
STOP_WORDS = "the and of to in is that for le la les des et est que der die das und ist den ein el los las del que y una".split()
#: What a rule votes where good_if or bad_if, an SQL condition over the counts of base_counts(), holds; bad goes first.
RULES = {
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "repeats": ("100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    "lines": ("n_dup_lines >= 3 and 10 * n_dup_lines > 3 * n_lines", "20 * n_dup_lines <= n_lines"),
    "capitals": ("10 * n_capitals > 4 * word_chars", "10 * n_capitals <= word_chars"),
    "shouts": ("20 * n_shouts > n_words", "200 * n_shouts <= n_words"),
    "word_length": ("word_chars > 15 * n_words or word_chars < 2 * n_words", "word_chars between 3 * n_words and 9 * n_words"),
    "stop_words": ("n_words >= 30 and n_stops = 0", "20 * n_stops > n_words"),
    "variety": ("n_words >= 30 and 10 * n_distinct < 2 * n_words", "10 * n_distinct > 3 * n_words"),
}
ROUNDS, PSEUDO, DIGITS = 15, 4.0, 6
#: Shares of the pseudo-votes of a good text: bad, abstaining, good; of a bad text the other way round.
LEAN = (0.05, 0.45, 0.5)


def word_list(text: Column) -> Column:
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words stand in windows of `window` words that the text has twice or more, the first included."""

    def covered(starts: Column) -> Column:
        # Starts ascend: each adds a window's words, or as many as there are up to the next start.
        return F.aggregate(F.transform(starts, lambda a, k: F.least(F.lit(window), F.coalesce(F.get(starts, k + 1) - a, F.lit(window)))), F.lit(0), lambda n, x: n + x)

    def counted(keys: Column) -> Column:
        def again(order: Column) -> Column:
            key = lambda k: F.get(order, k)["key"]
            twice = lambda x, k: F.coalesce(x["key"] == key(k - 1), F.lit(False)) | F.coalesce(x["key"] == key(k + 1), F.lit(False))
            return let(F.sort_array(F.transform(F.filter(order, twice), lambda x: x["at"])), covered)

        places = F.sort_array(F.transform(keys, lambda h, k: F.struct(h.alias("key"), k.alias("at"))))
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0)).otherwise(let(places, again))

    def windows(h: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(h) - window), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(window)]))

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(hashes, lambda h: let(windows(h), counted)))


def base_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, counts...) of each document, all long: what the rules look at."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole(F.col(f"`{text}`")).alias("text"))
    t = F.col("text")
    lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    of_words = lambda w: F.struct(
        F.size(w).alias("n_words"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(F.array_distinct(w)).alias("n_distinct"),
        F.size(F.filter(w, lambda x: x.isin(*STOP_WORDS))).alias("n_stops"),
    )
    times = lambda pattern: F.regexp_count(t, F.lit(pattern))
    made = rows.select(
        "doc_id",
        let(word_list(t), of_words).alias("w"),
        (F.length(t) - times(SPACE)).alias("word_chars"),
        times(SYMBOL).alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))).alias("x"),
        times("[A-Z]").alias("n_capitals"),
        times("!!").alias("n_shouts"),
    ).select("*", "w.*", "x.*").drop("w", "x")
    return made.select("doc_id", *[F.col(c).cast("long").alias(c) for c in made.columns if c != "doc_id"])


def votes(rules: dict[str, tuple[str, str]]) -> list[Column]:
    return [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).cast("int").alias(f"vote_{name}") for name, (bad, good) in rules.items()]


def fails_base(least_words: int = LEAST_WORDS, most_repeated: int = MOST_REPEATED) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


@dataclass
class VoteModel:
    """share: of good texts; chances[rule][vote + 1]: the probability of the vote in good and in bad texts."""

    share: float
    chances: dict[str, list[tuple[float, float]]]

    def weights(self) -> list[float]:
        """The logarithm of P(good) / P(bad), for each rule and vote in order, and before any vote."""
        return [*[math.log(good / bad) for of in self.chances.values() for good, bad in of], math.log(self.share / (1 - self.share))]

    def log_odds(self, outcomes: Column) -> Column:
        """Of a row's outcomes(): the logarithm of P(good) / P(bad)."""
        weights = F.lit(self.weights())
        return F.aggregate(outcomes, F.lit(0.0), lambda s, k: s + F.get(weights, k))


def outcomes(names: list[str]) -> Column:
    """The places in VoteModel.weights() that count for a row with votes."""
    return F.array(*[3 * k + F.col(f"vote_{name}") + 1 for k, name in enumerate(names)], F.lit(3 * len(names)))


def maximised(patterns: DataFrame, good: Column, names: list[str]) -> VoteModel:
    """The model of greatest likelihood for patterns(at, n), where `good` is the probability of each to be good."""
    each = patterns.select(F.explode("at").alias("at"), (F.col("n") * good).alias("g"), (F.col("n") * (1 - good)).alias("b"))
    sums = {r["at"]: (r["g"], r["b"]) for r in each.groupBy("at").agg(F.sum("g").alias("g"), F.sum("b").alias("b")).collect()}  # three a rule
    of = lambda at: sums.get(at, (0.0, 0.0))
    n_good, n_bad = of(3 * len(names))

    def chance(at: int) -> tuple[float, float]:
        g, b = of(at)
        lean_g, lean_b = LEAN[at % 3], LEAN[2 - at % 3]
        return max(round((g + PSEUDO * lean_g) / (n_good + PSEUDO), DIGITS), 1e-6), max(round((b + PSEUDO * lean_b) / (n_bad + PSEUDO), DIGITS), 1e-6)

    return VoteModel(round((n_good + PSEUDO) / (n_good + n_bad + 2 * PSEUDO), DIGITS), {name: [chance(3 * k + v) for v in range(3)] for k, name in enumerate(names)})


def fit_votes(voted: DataFrame, names: list[str], rounds: int = ROUNDS) -> VoteModel:
    """The model after `rounds` rounds of expectation and maximisation, or once nothing changes."""
    patterns = written(voted.groupBy(outcomes(names).alias("at")).agg(F.count("*").alias("n")).coalesce(1))
    no_bad = F.forall(F.slice("at", 1, len(names)), lambda k: k % 3 > 0)
    model = maximised(patterns, F.when(no_bad, 0.9).otherwise(0.1), names)
    for _ in range(rounds):
        before, model = model, maximised(patterns, 1 / (1 + F.exp(-model.log_odds(F.col("at")))), names)
        if model == before:
            break
    return model


def judge_quality(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rules: dict[str, tuple[str, str]] | None = None, least: float = 0.5) -> DataFrame:
    """(doc_id, counts..., votes..., posterior, base_failed, kept) of each document. `kept` where the posterior is at least
    `least` and the base rule does not fail."""
    rules = RULES if rules is None else rules
    counts = base_counts(docs, doc_id, text)
    voted = written(counts.select("*", *votes(rules)))
    model = fit_votes(voted, list(rules))
    judged = voted.withColumn("log_odds", model.log_odds(outcomes(list(rules))))
    kept = ~fails_base() & (F.col("log_odds") >= math.log(least / (1 - least)))
    return judged.select(*voted.columns, (1 / (1 + F.exp(-F.col("log_odds")))).alias("posterior"), fails_base().alias("base_failed"), kept.alias("kept"))
