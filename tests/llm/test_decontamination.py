import pickle
import random
from collections import Counter

import numpy as np
import pytest

from fennmark.llm import decontamination as dc
from fennmark.llm import queries
from fennmark.llm.common import table
from tests.llm.edge import documents, prose
from tests.oracle import SF


def items(spark):
    return [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]


def test_retrieval_equals_scoring_every_item(spark):
    index = dc.build_indexes(table(spark, SF, "benchmark"))[0]
    rng = np.random.default_rng(1)
    for k in range(300):
        terms = np.unique(rng.integers(1, len(index.numbers) + 1, int(rng.integers(1, 60))))
        if k % 3 == 0:
            terms = np.unique(np.concatenate([terms, index.encode(items(spark)[k % 40][1]) if k < 30 else terms]))
        scores = np.zeros(len(index.ids))
        for t in terms:
            a, b = index.first[t], index.first[t + 1]
            scores[index.items[a:b]] += index.weights[a:b]
        for threshold in (0.05, 0.3, 0.7):
            found = dict(index.retrieve(terms, threshold))
            assert set(found) == set(np.flatnonzero(scores >= threshold - 1e-9).tolist())


def test_no_window_with_a_match_is_pruned(spark):
    """leaks() finds what scoring every window of two strides finds."""
    index, texts = dc.build_indexes(table(spark, SF, "benchmark"))[0], prose(spark, 20)
    rng = random.Random(2)
    for (_, text), (item, leak) in zip(texts, rng.sample(items(spark), 20), strict=True):
        words = text.split()
        at = rng.randrange(len(words))
        mixed = " ".join([*words[:at], leak, *words[at:]])
        ids, stride, want = index.encode(mixed), max(index.longest, 10), set()
        for start in range(0, len(ids), stride):
            window = ids[start : start + 2 * stride]
            for found, _ in index.retrieve(np.unique(window[window > 0])):
                n = lambda p: len(next(iter(p), ()))
                grams = {k: {tuple(window[i : i + k].tolist()) for i in range(len(window) - k + 1)} for k in range(1, 6)}
                if all(not p or len(p & grams[n(p)]) >= 0.8 * len(p) for p in index.parts[found]):
                    want.add(index.ids[found])
        got = {x[0] for x in index.leaks(mixed)}
        assert item in got and got == want


def test_planted_items_are_found_and_clean_documents_left(spark):
    bench, clean = items(spark), prose(spark, 40)
    leaking_ids = {r.doc_id for r in dc.find_leaks(documents(spark, clean), table(spark, SF, "benchmark")).collect()}
    clean = [(i, t) for i, t in clean if i not in leaking_ids]
    planted = [(10_000 + k, f"{clean[k % len(clean)][1]} {text.upper() if k % 2 else text} {clean[(k + 1) % len(clean)][1]}") for k, (_, text) in enumerate(bench)]
    halves = [(20_000 + k, f"{clean[k % len(clean)][1]} {' '.join(text.split()[: len(text.split()) // 3])}") for k, (_, text) in enumerate(bench)]
    docs = documents(spark, clean + planted + halves)
    found = {}
    for r in dc.find_leaks(docs, table(spark, SF, "benchmark")).collect():
        assert r.score >= 0.7 and min(r.question_overlap, r.answer_overlap) >= 0.8
        found.setdefault(r.doc_id, set()).add(r.item_id)
    assert all(bench[k][0] in found[10_000 + k] for k in range(len(bench)))
    assert set(found) == {d for d, _ in planted}
    kept = dc.drop_leaking(docs, table(spark, SF, "benchmark"))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i, _ in clean + halves}


def test_odd_rows(spark):
    bench = table(spark, SF, "benchmark")
    odd = spark.createDataFrame([(None, "One two three four five six seven. Yes it is."), (1, None), (2, ""), (3, "..."), (4, "One two three four five six seven."), (4, "One two three four five six seven.")], "item_id long, text string")
    assert dc.find_leaks(documents(spark), bench).count() == 0
    assert {(r.doc_id, r.item_id) for r in dc.find_leaks(documents(spark), odd).collect()} == {(1, 4), (6, 4)}
    assert dc.find_leaks(documents(spark), odd.limit(0)).count() == 0 and dc.find_leaks(documents(spark, []), bench).count() == 0
    assert dc.drop_leaking(documents(spark), odd.limit(0)).count() == documents(spark).count()
    assert dc.drop_leaking(documents(spark), odd).count() == documents(spark).count() - 3


def test_many_items_in_blocks(spark):
    docs = documents(spark, [(k, f"{a} and then {t}") for k, ((_, a), (_, t)) in enumerate(zip(prose(spark, 10), items(spark), strict=False))])
    whole = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, table(spark, SF, "benchmark")).collect()}
    got, indexes = set(), dc.build_indexes(table(spark, SF, "benchmark"), block_items=7)
    assert len(indexes) == 6
    for index in indexes:
        for r in docs.select("doc_id", "text").collect():
            got |= {(r.doc_id, x[0]) for x in index.leaks(r.text)}
    assert got == whole and len(whole) >= 10


def test_items_with_words_replaced_are_found(spark):
    index, bench, clean = dc.build_indexes(table(spark, SF, "benchmark"))[0], items(spark), prose(spark, 20)
    rng = random.Random(3)
    for altered, least in ((1, 0.95), (2, 0.7)):
        hits = trials = 0
        for k in range(5 * len(bench)):
            item, text = bench[k % len(bench)]
            words = text.split()
            for at in rng.sample(range(len(words)), altered):
                words[at] = "otherword"
            found = {x[0] for x in index.leaks(f"{clean[k % 20][1]} {' '.join(words)} {clean[(k + 1) % 20][1]}")}
            hits, trials = hits + (item in found), trials + 1
        assert hits >= least * trials


def test_long_texts_take_bounded_memory_and_lose_nothing(spark, monkeypatch):
    index, bench, clean = dc.build_indexes(table(spark, SF, "benchmark"))[0], items(spark), prose(spark, 40)
    text = " ".join(f"{c} {b}" for (_, c), (_, b) in zip(clean, bench, strict=False))
    want = index.leaks(text)
    assert {x[0] for x in want} >= {i for i, _ in bench[:40]}
    for strides in (1, 2, 3, 7):
        monkeypatch.setattr(dc, "AT_ONCE", strides)
        assert index.leaks(text) == want


def test_query_equals_brute_force(spark):
    """op7's pairs are those of which question and answer stand in the text, by looking at every place of every text."""
    words = lambda t: dc.words_of(t)
    got = {(r.doc_id, r.item_id) for r in queries.op7_decontamination(spark, SF).collect()}
    want = set()
    for r in table(spark, SF, "documents").select("doc_id", "text").collect():
        held = " ".join(["", *words(r.text), ""])
        want |= {(r.doc_id, i) for i, t in items(spark) if " ".join(["", *words(t), ""]) in held}
    assert want and got == want


def test_too_many_items_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(dc, "MOST_ITEMS", 3)
    with pytest.raises(ValueError, match="too many"):
        dc.build_indexes(table(spark, SF, "benchmark"))


def test_an_index_of_many_rare_words_stays_small():
    items = [(k, " ".join(f"w{k}x{j}" for j in range(400)) + f". Answer {k}.") for k in range(2000)]
    blocks = dc.cut_items(items, [402] * len(items))
    assert [i for b in blocks for i in b] == items and all(402 * len(b) <= dc.BLOCK_WORDS for b in blocks)
    index = dc.ItemIndex(blocks[0], dict.fromkeys((w for _, t in blocks[0] for w in dc.words_of(t)), 1), len(items), 402.0)
    assert sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray)) < 30_000_000
    assert len(pickle.dumps(index)) < 60_000_000
    assert [k for k, *_ in index.leaks("Before it. " + items[7][1] + " After it.")] == [7]


def test_one_long_item_does_not_widen_the_windows_of_others():
    items = [(k, " ".join(f"w{(k * 7 + j) % 90}" for j in range(20))) for k in range(50)] + [(99, " ".join(f"v{j}" for j in range(3000)))]
    blocks = dc.cut_items(items, [len(t.split()) for _, t in items])
    assert [len(b) for b in blocks] == [50, 1] and blocks[1] == items[50:]
    assert dc.cut_items([], []) == [] and [len(b) for b in dc.cut_items(items[:5], [20] * 5, block_items=2)] == [2, 2, 1]


def test_bounds_equal_brute_force():
    rng = random.Random(6)
    items = [(k, " ".join(f"w{rng.randrange(40)}" for _ in range(12))) for k in range(60)]
    frequency = Counter(w for _, t in items for w in set(dc.words_of(t)))
    index = dc.ItemIndex(items, frequency, len(items), 12.0)
    rows, terms = np.array([0, 0, 2, 2, 2]), np.array([1, 5, 0, 7, 8])
    want = np.zeros((3, index.n_blocks))
    for r, t in zip(rows, terms):
        for b in range(index.n_blocks):
            own = [w for i, w in zip(index.items[index.first[t] : index.first[t + 1]], index.weights[index.first[t] : index.first[t + 1]]) if i // dc.POSTINGS_BLOCK == b]
            want[r, b] += max(own, default=0)
    assert np.allclose(index.bounds(rows, terms, 3), want)
