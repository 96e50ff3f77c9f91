import zlib

import numpy as np

from fennmark.llm import queries, sharding
from fennmark.llm.common import table
from tests.llm.edge import ROWS, documents
from tests.oracle import SF


def hold(got, rows):
    assert sorted((str(r.doc_id), r["size"], r.text_crc32) for r in got) == sorted((str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    slots = {}
    for r in got:
        assert 0 <= r.shard < 40
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_query_balances_bytes(spark):
    sf = SF.replace("sf0.001", "sf0.1")
    got = queries.op6_sharding(spark, sf).collect()
    hold(got, [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()])
    sizes, counts, of = [0] * 40, [0] * 40, {}
    for r in got:
        sizes[r.shard] += r["size"]
        counts[r.shard] += 1
        of.setdefault((r.text_crc32, r["size"]), []).append(r.shard)
    assert max(sizes) <= 1.01 * sum(sizes) / 40 and max(counts) <= 1.05 * len(got) / 40
    assert all(len(set(s)) == 1 for s in of.values())  # no group of this table is larger than a shard
    assert {r.law for r in got} == {"bytes"}


def test_odd_rows(spark):
    hold(sharding.shard_documents(documents(spark)).collect(), ROWS)
    assert sharding.shard_documents(documents(spark, [])).count() == 0


def test_a_group_of_a_third_of_all_rows_is_split(spark):
    rows = [(k, "the same text " * 5 if k % 3 == 0 else f"text {k} " * 8) for k in range(3000)]
    got = sharding.shard_documents(documents(spark, rows), block_rows=500).collect()
    hold(got, rows)
    sizes = [sum(r["size"] for r in got if r.shard == s) for s in range(40)]
    assert max(sizes) < 1.1 * sum(sizes) / 40


def test_groups_without_ids_that_fit_stay_whole_and_are_numbered(spark):
    rows = [(None, "one text")] * 300 + [(None, "another")] * 150 + [(k, f"text {k} " * 3) for k in range(40_000)]
    got = sharding.shard_documents(documents(spark, rows), shards=40, block_rows=500).collect()
    hold(got, rows)
    of = {}
    for r in got:
        of.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in of.values())


def test_placing_equals_trying_every_shard():
    """Brute force: each item, largest first, goes where the weighted dot product with what is left is highest."""
    rng = np.random.default_rng(3)
    items, residual = rng.random((200, 3)), np.full((7, 3), 20.0)
    capacity, left = np.full(3, 20.0), residual.copy()
    got = sharding.place(items, residual, capacity)
    for k in sorted(range(200), key=lambda k: -max(items[k])):
        best = max(range(7), key=lambda s: (round(sum(w * a * b for w, a, b in zip(sharding.WEIGHTS, items[k], left[s])), 9), -s))
        assert best == got[k]
        left[best] -= items[k]
