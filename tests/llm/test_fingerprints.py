import hashlib
import struct

import xxhash
from pyspark.sql import functions as F

from fennmark.llm import fingerprints as fp
from fennmark.llm import queries
from fennmark.llm.common import table
from tests.llm.edge import ROWS, documents
from tests.oracle import SF


def brute_sketch(text, fraction=fp.FRACTION, n=fp.WORDS):
    """Spark's hash of several values chains: each one's hash is the next one's seed."""
    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.lower().split()]
    if not words:
        return set()

    def chain(hs):
        seed = 42
        for h in hs:
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", h), seed)
        return seed - 2**64 if seed >= 2**63 else seed

    all_ = {chain(words[k : k + n]) for k in range(max(1, len(words) - n + 1))}
    return {h for h in all_ if h < -(2**63) + int(2**64 * fraction)} or {min(all_)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_equals_brute_force(spark):
    rows = sorted(((r.doc_id, r.text) for r in table(spark, SF, "documents").select("doc_id", "text").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.op2_fingerprints(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = brute_sketch(text), brute_sketch(edited), brute_sketch(following)
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == " ".join(f"{h % 2**64:016x}" for h in sorted(a))
        assert abs(r.near_edited - jaccard(a, b)) < 1e-12 and abs(r.near_next - jaccard(a, c)) < 1e-12


def test_odd_rows(spark):
    got = fp.compare_edited(documents(spark)).collect()
    assert len(got) == len(ROWS)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault(r.text, set()).add(tuple(r.sketch))
    assert all(len(s) == 1 for s in by_text.values()) and by_text[""] == {()} and by_text[" \n\t "] == {()}
    assert fp.compare_edited(documents(spark, [])).count() == 0
    alone = fp.compare_edited(documents(spark, [(1, "only this text")])).first()
    assert alone.edited == "only thonly th"[:14] and alone.near_next == 1.0


def test_merge_and_containment(spark):
    long = " ".join(f"w{k}" for k in range(4000))
    part = " ".join(f"w{k}" for k in range(1000, 1400))
    other = " ".join(f"v{k}" for k in range(400))
    df = spark.createDataFrame([(long, part, other)], "long string, part string, other string")
    s = {c: fp.scaled_sketch(F.col(c)) for c in df.columns}
    r = df.select(fp.containment(s["part"], s["long"]).alias("inside"), fp.containment(s["other"], s["long"]).alias("outside"), fp.merge(s["part"], s["other"]).alias("both"), F.array_sort(F.array_union(s["part"], s["other"])).alias("union"), F.size(s["long"]).alias("n")).first()
    assert r.inside == 1.0 and r.outside == 0.0 and r.both == r.union
    assert abs(r.n - 3996 / 8) < 120


def test_short_texts_in_long_ones_are_never_said_to_be_outside(spark):
    words = [f"w{k}" for k in range(3000)]
    rows = [(" ".join(words), " ".join(words[k : k + 8]), " ".join(f"v{k}x{j}" for j in range(8))) for k in range(0, 1000, 25)]
    df = spark.createDataFrame(rows, "long string, part string, other string")
    s = {c: fp.scaled_sketch(F.col(c)) for c in df.columns}
    got = df.select(fp.containment(s["part"], s["long"]).alias("inside"), fp.containment(s["other"], s["long"]).alias("outside")).collect()
    assert {r.inside for r in got} == {1.0, None} and {r.outside for r in got} <= {0.0, None}


def test_uneven_and_extreme_ids(spark):
    """The next document is right, and ids crowd no bucket, for dense ids beside ids 2^63 apart."""
    rows = [(k, f"text {k}") for k in range(6000)] + [(-(2**63), "lowest"), (2**63 - 1, "highest"), (4 * 10**18, "far"), (None, "none a"), (None, "none b")]
    found, _ = fp.with_next(documents(spark, rows))
    found = found.filter("halo = 0").select("doc_id", "text", "next_text", "bucket").collect()
    nexts = {r.doc_id: r.next_text for r in found if r.doc_id is not None}
    ids = sorted((i for i, _ in rows if i is not None), reverse=True)
    by = dict(rows)
    assert len(found) == len(rows) and all(nexts[a] == by[b] for a, b in zip(ids, ids[1:]))
    assert {nexts[ids[-1]], *(r.next_text for r in found if r.doc_id is None)} == {"none a", "none b", "highest"}
    sizes = {}
    for r in found:
        sizes[r.doc_id is None, r.bucket] = sizes.get((r.doc_id is None, r.bucket), 0) + 1
    assert max(sizes.values()) <= 300
