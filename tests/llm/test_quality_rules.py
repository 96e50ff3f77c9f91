import math
import random
import re
from collections import Counter

from fennmark.llm import quality_rules as rules
from fennmark.llm import queries
from tests.llm.edge import ROWS, documents, prose
from tests.oracle import SF, duck, duck_rows, spark_rows

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_counts(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {k + j for k, w in enumerate(windows) if w in often for j in range(5)}
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall("[#*$%&|<>]", text)),
        "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_distinct": len(set(words)),
    }


def odd_texts():
    rng = random.Random(3)
    few = [" ".join(rng.choices("a b c".split(), k=rng.randrange(0, 60))) for _ in range(40)]
    return [*few, "a b c d e", "a b c d e a b c d e", "a a a a a", "a a a a a a", "x\x0by\x0cz\tq\r\nw", "| # $\n|\n|\n\n \n", "\U0001f600   wide space", "same\nsame\n same\n\nsame"]


def test_counts_equal_brute_force(spark):
    texts = dict(enumerate([t for _, t in [*ROWS, *prose(spark, 20)]] + odd_texts()))
    docs = documents(spark, list(texts.items()))
    found = {r["doc_id"]: r.asDict() for r in rules.base_counts(docs).collect()}
    for k, text in texts.items():
        expected = brute_counts(text)
        assert {c: found[k][c] for c in expected} == expected, text


def brute_em(patterns, rounds):
    """Rounds on {votes: n} with the formulas of the docstring, without Spark."""
    good = {v: 0.9 if min(v) >= 0 else 0.1 for v in patterns}
    for k in range(rounds + 1):
        g, b = ({v: n * (q if c else 1 - q) for v, n in patterns.items() for q in [good[v]]} for c in (1, 0))
        total = sum(g.values()), sum(b.values())
        share = round((total[0] + 4) / (sum(total) + 8), 6)
        lean = {-1: (0.05, 0.5), 0: (0.45, 0.45), 1: (0.5, 0.05)}
        chance = [{v: tuple(max(round((sum(x for p, x in of.items() if p[j] == v) + 4 * lean[v][c]) / (total[c] + 4), 6), 1e-6) for c, of in enumerate((g, b))) for v in (-1, 0, 1)} for j in range(len(next(iter(patterns))))]
        if k < rounds:
            odds = {p: math.log(share / (1 - share)) + sum(math.log(chance[j][v][0] / chance[j][v][1]) for j, v in enumerate(p)) for p in patterns}
            good = {p: 1 / (1 + math.exp(-x)) for p, x in odds.items()}
    return share, chance


def test_rounds_equal_brute_force_and_find_accuracies(spark):
    rng = random.Random(5)
    accuracy = {"a": 0.95, "b": 0.8, "c": 0.9, "d": 0.7}
    rows, truth = [], []
    for _ in range(3000):
        good = rng.random() < 0.7
        truth.append(good)
        rows.append(tuple(0 if rng.random() < 0.3 else (1 if good == (rng.random() < a) else -1) for a in accuracy.values()))
    names = list(accuracy)
    voted = spark.createDataFrame(rows, ", ".join(f"vote_{n} int" for n in names))
    model = rules.fit_votes(voted, names, rounds=15)
    share, chance = brute_em(Counter(rows), 15)
    assert abs(model.share - share) < 1e-5
    for j, name in enumerate(names):
        for v in (-1, 0, 1):
            assert all(abs(x - y) < 1e-5 for x, y in zip(model.chances[name][v + 1], chance[j][v], strict=True))
        (g_bad, _), (b_bad, b_good) = (model.chances[name][0][0], None), (model.chances[name][0][1], model.chances[name][2][1])
        found = 1 - (g_bad / (g_bad + model.chances[name][2][0]) + b_good / (b_bad + b_good)) / 2
        assert abs(found - accuracy[name]) < 0.08
    assert abs(model.share - sum(truth) / len(truth)) < 0.06


def test_odd_rows_and_no_rows(spark):
    found = rules.judge_quality(documents(spark))
    rows = found.collect()
    assert len(rows) == len(ROWS) and sum(r["doc_id"] is None for r in rows) == 2
    of = {r["doc_id"]: r for r in rows if r["doc_id"] in (1, 2, 3, 4, 9)}
    assert all(r["base_failed"] and not r["kept"] for r in of.values())
    empty = rules.judge_quality(documents(spark, []))
    assert empty.count() == 0 and empty.columns == found.columns


def test_query_equals_sql_and_labels(spark):
    df = queries.op11_quality_rules(spark, SF)
    names, expected = duck_rows(duck(), queries.oracle_sql()["op11_quality_rules"])
    assert sorted(df.columns) == names and spark_rows(df) == expected


def test_verdicts_agree_with_labels_that_they_never_saw(spark):
    found = queries.op11_quality_rules(spark, "/root/testdata/sf0.01").filter("not base_failed").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    right, n, lost = found.selectExpr("sum(int(kept = (quality = 1)))", "count(*)", "sum(int(quality = 1 and not kept))").first()
    assert right / n > 0.95 and lost / n < 0.02
