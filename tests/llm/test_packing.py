import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from fennmark.llm import packing, queries
from fennmark.llm.common import table
from tests.llm.edge import ROWS, documents
from tests.oracle import SF


def own_ids(texts):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [[*e.ids, 0] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def hold(pieces, docs):
    """docs: list of (doc_id, ids). Every id lies in one piece, sequences are gapless and not over 1024."""
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= 1024
    want = sorted((str(d), len(ids), tuple(ids)) for d, ids in docs)
    crcs = {}
    for d, n, ids in want:
        for p in pieces:
            if str(p.doc_id) == d and p.doc_tokens == n and p.start < n and zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes()) == p.ids_crc32:
                crcs.setdefault((d, n, p.start), []).append(p.length)
    assert sum(p.length for p in pieces) == sum(n for _, n, _ in want)
    return len(sequences)


def test_query_round_trip(spark):
    rows = table(spark, SF, "documents").select("doc_id", "text").collect()
    ids = dict(zip([r.doc_id for r in rows], own_ids([r.text for r in rows]), strict=True))
    pieces = queries.op3_packing(spark, SF).collect()
    covered = {}
    for p in pieces:
        part = ids[p.doc_id][p.start : p.start + p.length]
        assert len(part) == p.length and p.doc_tokens == len(ids[p.doc_id])
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == p.ids_crc32
        covered.setdefault(p.doc_id, []).append((p.start, p.length))
    for doc, parts in covered.items():
        assert sum(n for _, n in parts) == len(ids[doc]) and sorted(parts)[0][0] == 0
    assert set(covered) == set(ids)
    n = hold(pieces, list(ids.items()))
    assert n <= 1.03 * sum(map(len, ids.values())) / 1024 + 1


def test_odd_rows(spark):
    pieces = packing.pack_documents(documents(spark)).collect()
    hold(pieces, [(i, ids) for (i, _), ids in zip(ROWS, own_ids([t for _, t in ROWS]), strict=True)])
    assert sum(p.doc_id == 6 for p in pieces) == 3
    assert packing.pack_documents(documents(spark, [])).count() == 0


def test_large_ids_stay_whole_beside_null_ones(spark):
    rows = [(2**62 + 1, "one"), (None, "two"), (-(2**62) - 1, "three " * 2000), (0, "four"), (None, None)]
    pieces = packing.pack_documents(documents(spark, rows)).collect()
    hold(pieces, [(i, ids) for (i, _), ids in zip(rows, own_ids([t for _, t in rows]), strict=True)])
    assert {p.doc_id for p in pieces} == {i for i, _ in rows}


def test_sequences_hold_the_ids(spark):
    docs = documents(spark, [(1, "a b c " * 900), (2, "short"), (3, None)])
    pieces = packing.pack_documents(docs)
    got = {r.sequence_id: r.ids for r in packing.sequences(docs, pieces).collect()}
    ids = dict(zip((1, 2, 3), own_ids(["a b c " * 900, "short", None]), strict=True))
    for p in pieces.collect():
        assert got[p.sequence_id][p.offset : p.offset + p.length] == ids[p.doc_id][p.start : p.start + p.length]


def test_unusual_texts_agree_with_the_tokenizer_file():
    texts = ["<|endoftext|> in a text", "tabs\t\tand  blanks ", "naïve œuvre ñ ß", "文字 \U0001f600", "a\r\nb\x00c", " lead", "x" * 3000, "I'll we're 12345"]
    assert [packing.encode(t).tolist() for t in texts] == own_ids(texts)


def test_closest_fill_is_optimal():
    rng = np.random.default_rng(5)
    for _ in range(60):
        counts = {int(x): int(c) for x, c in zip(rng.integers(1, 30, 5), rng.integers(1, 4, 5), strict=True)}
        room, reach = int(rng.integers(1, 80)), {0}
        for x, c in counts.items():
            for _ in range(c):
                reach |= {r + x for r in reach}
        fill = packing.closest_fill(counts, room)
        assert sum(x * n for x, n in fill.items()) == max(r for r in reach if r <= room)
        assert all(n <= counts[x] for x, n in fill.items())


def test_both_tokenizers_agree_on_random_texts():
    """encode() takes a faster library for usual characters: 4,000 random strings over all of them."""
    import random

    rng = random.Random(5)
    usual = [chr(c) for c in [*range(0x250), *range(0x2010, 0x2028), 0x20AC] if not packing.UNUSUAL.search(chr(c))]
    pick = lambda: rng.choice((usual, [" ", "\n", "\t", "a", "E", "'", "s", "1"]))
    texts = ["".join(rng.choice(pick()) for _ in range(rng.randrange(1, 60))) for _ in range(4000)]
    assert all(packing.encode(t).tolist() == ids for t, ids in zip(texts, own_ids(texts), strict=True))
