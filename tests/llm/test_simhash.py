import random
import re

import numpy as np
import xxhash

from fennmark.llm import queries, simhash
from fennmark.llm.common import table
from fennmark.llm.components import connected_components
from tests.llm.edge import ROWS, documents, prose
from tests.oracle import SF

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_fingerprint(text):
    words = WORD.findall("".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    h = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def brute_components(n, near):
    root = list(range(n))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(n):
        for b in range(a):
            if near(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(n)]


def hold(got, rows):
    """rows: (doc_id, text) by id, ids not null."""
    prints = [brute_fingerprint(t) for _, t in rows]
    roots = brute_components(len(rows), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    want = sorted((rows[k][0], f"{prints[k]:016x}", rows[roots[k]][0]) for k in range(len(rows)))
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == want


def test_query_equals_brute_force(spark):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect())
    hold(queries.op10_simhash(spark, SF).collect(), rows)


def test_links_over_single_bits(spark):
    rng = random.Random(6)
    prints = sorted({base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))) for base in (0, 2**63, 0x0123456789ABCDEF) for _ in range(60)})
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    edges = simhash.links(spark.createDataFrame([(k, p) for k, p in enumerate(signed)], "vertex long, f0 long"), 1, 2, 8, 6)
    roots = brute_components(len(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert [got.get(k, k) for k in range(len(prints))] == roots


def test_odd_rows(spark):
    got = simhash.link_fingerprints(documents(spark)).collect()
    hold([r for r in got if r.doc_id is not None], sorted((i, t) for i, t in ROWS if i is not None and t != "Another text of the same id.") + [(6, "Another text of the same id.")])
    assert len(got) == len(ROWS) and {r.component_id for r in got if r.fingerprint == "0" * 16} == {2}
    assert simhash.link_fingerprints(documents(spark, [])).count() == 0


def near_copies(spark, n):
    """n edited copies of one text, which are all near it and often not near each other."""
    rng = random.Random(12)
    base = prose(spark, 30)
    words = max(base, key=lambda r: len(r[1]))[1].split()
    out = []
    for k in range(n):
        w = list(words)
        for at in rng.sample(range(len(w)), max(1, len(w) // 70)):
            w[at] = f"edit{k}x{at}"
        out.append((1000 + k, " ".join(w)))
    return base, [(999, " ".join(words)), *out]


def test_one_of_each_group_of_near_copies_stays(spark):
    base, group = near_copies(spark, 60)
    rows = [*base, *group, (2000, base[0][1]), (2001, base[0][1])]
    docs = documents(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    sets = [{tuple(w[k : k + 5]) for w in (t.lower().split(),) for k in range(max(1, len(w) - 4))} for _, t in rows]
    roots = brute_components(len(rows), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    groups = {}
    for k, r in enumerate(roots):
        groups.setdefault(r, []).append(rows[k][0])
    assert ids == {min(g) for g in groups.values()}


def test_large_groups_are_dealt_and_stay_linked(spark):
    base, group = near_copies(spark, 120)
    ids = {r.doc_id for r in simhash.drop_near_duplicates(documents(spark, group), most_rows=25).collect()}
    assert ids == {999}


def test_near_duplicates_of_odd_rows(spark):
    kept = simhash.drop_near_duplicates(documents(spark)).collect()
    ids = [r.doc_id for r in kept]
    assert sorted(str(i) for i in ids) == sorted(["1", "2", "5", "6", "8", "9", "None", "None"])  # texts without words are alike
    assert simhash.drop_near_duplicates(documents(spark, [])).count() == 0


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(500, 500), (501, 502), (502, 501), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {k: 0 for k in range(301)} | {501: 501, 502: 501}


def test_clusters_of_a_large_group_stay_linked(spark):
    """Many clusters that share one popular block, none near another: each is linked whole, however the group is dealt."""
    rng = random.Random(14)
    rows, want = [], {}
    for c in range(60):
        base = rng.getrandbits(63)
        for k in range(3):
            vertex = 1000 * k + c
            rows.append((vertex, base ^ (k << 20), 7))
            want[vertex] = c
    edges = simhash.links(spark.createDataFrame(rows, "vertex long, f0 long, f1 long"), 2, 4, 2, 1, most_rows=20)
    assert {r.node: r.root for r in connected_components(edges).collect()} == want


def test_ids_with_several_texts_lose_only_the_copies(spark):
    rows = [(1, "a text that stands under two ids and is a copy"), (6, "a text that stands under two ids and is a copy"), (6, "what only this row has must not go with the other row"), (6, "nor must this third one, which has yet other words")]
    kept = {(r.doc_id, r.text) for r in simhash.drop_near_duplicates(documents(spark, rows)).collect()}
    assert kept == set(rows) - {rows[1]}


def test_recall_on_isolated_pairs_by_length(spark):
    """Pairs edited to a five-word Jaccard similarity of 0.8 or more, none near another pair."""
    rng = random.Random(15)
    shingled = lambda w: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 7)))
    common = [word() for _ in range(60)]
    for low, high, least in ((13, 30, 0.85), (31, 80, 0.97), (81, 200, 0.97), (201, 400, 0.97)):
        rows, n = [], 0
        while n < 150:
            a = [rng.choice(common) if rng.random() < 0.5 else word() for _ in range(rng.randrange(low, high + 1))]
            b = list(a)
            for _ in range(max(1, len(a) // 50)):
                b[rng.choice((0, 1, len(b) - 1, rng.randrange(len(b))))] = word()
            x, y = shingled(a), shingled(b)
            if a != b and len(x & y) >= 0.8 * len(x | y):
                rows += [(2 * n, " ".join(a)), (2 * n + 1, " ".join(b))]
                n += 1
        gone = 2 * n - simhash.drop_near_duplicates(documents(spark, rows)).count()
        print(low, high, gone / n)
        assert least * n <= gone <= n


def shingled(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def test_short_near_copies_are_all_found(spark):
    """Fingerprints alone miss some of these, as a few words decide all bits of a short text."""
    rng, rows = random.Random(16), []
    while len(rows) < 600:
        a = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(rng.randrange(13, 25))]
        b = [*a, "end"] if rng.random() < 0.5 else ["start", *a]
        x, y = " ".join(a), " ".join(b)
        if 5 * len(shingled(x) & shingled(y)) >= 4 * len(shingled(x) | shingled(y)):
            rows += [(len(rows), x), (len(rows) + 1, y)]
    kept = simhash.drop_near_duplicates(documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == list(range(0, 600, 2))


def test_every_text_of_an_id_is_compared(spark):
    base, group = near_copies(spark, 8)
    rows = [*base, group[0], *((5000, t) for _, t in group[1:]), *((5000, t) for _, t in base[:3])]
    kept = {(r.doc_id, r.text) for r in simhash.drop_near_duplicates(documents(spark, rows)).collect()}
    assert group[0][1] not in {t for _, t in base[:3]}
    sets = [shingled(t) for _, t in rows]
    roots = brute_components(len(rows), lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))
    groups = {}
    for k, r in enumerate(roots):
        groups.setdefault(r, []).append(k)
    assert {i for i, _ in kept} == {min(rows[k][0] for k in g) for g in groups.values()} and len(kept) == len(groups)


def test_prefixes_miss_no_pair(spark):
    """Sets that share much below and above the similarity, some a common passage, in groups of their own and of others."""
    rng = random.Random(17)
    passage = [f"common{k}" for k in range(40)]
    rows = [(-1, "")]
    for k in range(160):
        if rng.random() < 0.4 and k:
            w = list(rng.choice(rows[1:20])[1].split())
            for _ in range(rng.randrange(1, 4)):
                w[rng.choice((0, 1, len(w) - 1, rng.randrange(len(w)))) % len(w)] = f"new{rng.randrange(9)}"
        else:
            w = [f"w{k}x{j}" for j in range(rng.randrange(1, 60))] + passage * (rng.random() < 0.3)
        rows.append((k, " ".join(w)))
    texts = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("doc_id", "text", "sha2(text, 256) digest")
    sets = [shingled(t) for _, t in rows]
    for similarity in (0.8, 0.5):
        near = {(a, b) for b in range(1, len(rows)) for a in range(1, b) if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])}
        assert len(near) > 60
        for most_rows, sample, of in ((None, 4096, 1), (10, 4096, 1), (10, 1, 1), (None, 1, 7)):
            with_roots = simhash.prefixes(texts, 5, similarity, sample=sample).selectExpr("doc_id vertex", f"if({of} = 1, doc_id, doc_id % {of}) root", "n", "cold", "tokens")
            got = {(r.u + 1, r.v + 1) for r in simhash.pairs_by_prefix(with_roots, similarity, most_rows).collect()}
            assert {(a, b) for a, b in near if of == 1 or (a - b) % of} <= got and all(of == 1 or (a - b) % of for a, b in got)
