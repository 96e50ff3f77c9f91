"""SimHash near-duplicates: fingerprints are cut into blocks, rows meet where several blocks agree, Hamming distance decides.

A fingerprint has 64 bits for each of its `lanes`. With B blocks of which S must agree, any two fingerprints that differ in
at most B - S bits meet for certain, by the pigeonhole principle. Vertices that share a block key are sorted together and
streamed through a task, which measures distances on the first lane and emits only a minimum spanning forest of the links
among them and, where links are verified later, those to a few hubs: never all pairs.

With one lane, 8 blocks and 6 of them shared, distinct fingerprints of a group differ in 16 bits at most, so no group has
more than 65,536 whatever the input. With more lanes a group has no such bound: one of more than `most_rows` is dealt by
hash over buckets of half that size, and every pair of buckets is compared in a part of its own, so any two of the group
meet; a group's rows are then copied once for each other bucket, which grows with the square of the group.

Near copies by Jaccard similarity (near_duplicate_groups) are first sought by such fingerprints, which finds most of them at
little cost, and then to the last by prefixes: sets with a share t of their union in common have one of the first
n - ceil(t n) + 1 of their n shingles in common, whatever the order, so all pairs of different groups that meet there are
counted, held against what their sizes ask for and verified. The order puts shingles last that a sample shows to be common;
it decides how many pairs meet in vain, not what is found.

Defined results: a null text is empty; a text without words has fingerprint zero, and such texts are alike; fewer words than
a shingle make one shingle of the whole sequence; a very long text is hashed 255 words at a time; repeated rows have one
result (link_fingerprints) or go together (drop_near_duplicates), where rows of one id and text count once; rows without an
id take the component of their fingerprint or stay; rows of one id with several texts are told apart by their texts, each of
which is compared with all; ties among groups go to the smallest id, then to the least digest; an empty table gives an empty table; other columns pass, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import cut_lineage, whole, written
from fennmark.llm.components import connected_components
from fennmark.llm.fingerprints import likeness, shingle_hashes

SEED = 42

def majority(base: np.ndarray, lanes: int) -> list[int]:
    """The bits that over half the hashes have, for `lanes` hashes made from each: the hash itself, then others of it by the
    finisher of a 64-bit generator. Summed in bytes, so 255 hashes at a time; memory is bounded however long the text."""
    steps = np.arange(lanes, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    counts = np.zeros(lanes * 64, dtype=np.int64)
    for a in range(0, len(base), 255):
        h = base[a : a + 255, None] + steps
        h ^= h >> np.uint64(30)
        h *= np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(27)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
        h[:, 0] = base[a : a + 255]
        counts += np.unpackbits(h.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits((counts * 2 > len(base)).astype(np.uint8), bitorder="little").view("<u8").tolist()


def fingerprint(text: str, words: int = 3, lanes: int = 1, distinct: bool = False) -> list[int]:
    """`lanes` unsigned 64-bit words: a bit is set where over half the shingle hashes have it."""
    found = text.encode().lower().split()  # bytes: lowers A-Z only and splits at ASCII white space only
    if not found:
        return [0] * lanes
    if words == 1 or len(found) < words:
        shingles = found if len(found) >= words else [b" ".join(found)]
    else:
        joined = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found]) - 1
        starts = [0, *(ends[: -words] + 1).tolist()]
        shingles = [joined[a:b] for a, b in zip(starts, ends[words - 1 :].tolist(), strict=True)]
    shingles, digest = set(shingles) if distinct else shingles, xxhash.xxh64_intdigest
    return majority(np.array([digest(s, SEED) for s in shingles], dtype="<u8"), lanes)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, lanes: int = 1, distinct: bool = False, keep: Column | None = None) -> DataFrame:
    """(doc_id, f0, f1, ...) with the lanes as signed longs; a string `keep` of the row comes as digest."""
    names = ["doc_id", *(f"f{k}" for k in range(lanes)), *(["digest"] if keep is not None else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [fingerprint(t, words, lanes, distinct) for t in batch.column(1).to_pylist()]
            lanes_of = np.array(rows, dtype=np.uint64).reshape(-1, lanes).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(lanes_of[:, k].copy()) for k in range(lanes)), *batch.columns[2:]], names)

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"), *([keep.alias("digest")] if keep is not None else []))
    return rows.mapInArrow(run, ", ".join(f"{c} {'string' if c == 'digest' else 'long'}" for c in names))


def block_keys(vertices: DataFrame, lanes: int, blocks: int, shared: int) -> DataFrame:
    """(combo, key, vertex, f0): one row for each choice of `shared` out of `blocks` blocks."""
    edges = [round(k * 64 * lanes / blocks) for k in range(blocks + 1)]

    def mask(a: int, b: int, lane: int) -> int:
        bits = ((1 << b) - (1 << a)) >> (64 * lane) & (2**64 - 1)
        return bits - 2**64 if bits >= 2**63 else bits

    keys = []
    for combo in combinations(range(blocks), shared):
        masks = [sum(mask(edges[k], edges[k + 1], lane) for k in combo) for lane in range(lanes)]
        masks = [m + 2**64 if m < -(2**63) else m for m in masks]
        parts = [F.col(f"f{lane}").bitwiseAND(F.lit(m)) for lane, m in enumerate(masks) if m]
        keys.append(parts[0] if len(parts) == 1 else F.xxhash64(*parts))
    return vertices.select(F.posexplode(F.array(*keys)).alias("combo", "key"), "vertex", "f0")


def spanning_links(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Edges (index, index) of a minimum spanning forest of the graph that links rows of `prints` at `most` differing bits.

    Prim's algorithm: one row of distances at a time, so memory is linear in the group.
    """
    n = len(prints)
    left = np.arange(1, n)
    best, parent = np.full(n, 1 << 30), np.zeros(n, dtype=np.int64)
    at, out = 0, []
    while len(left):
        gap = np.bitwise_count(prints[left] ^ prints[at]).astype(np.int64)
        nearer = gap < best[left]
        best[left[nearer]], parent[left[nearer]] = gap[nearer], at
        k = int(np.argmin(best[left]))
        at = int(left[k])
        if best[at] <= most:
            out.append((int(parent[at]), at))
        left = np.delete(left, k)
    return out


def hub_links(prints: np.ndarray, most: int, hubs: int) -> list[tuple[int, int]]:
    """Edges to each row from the `hubs` rows nearest to the group's majority of bits, at `most` differing bits."""
    if len(prints) <= 2:
        return []
    bits = np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1)
    middle = np.packbits((bits.sum(axis=0) * 2 > len(prints)).astype(np.uint8)).view(np.uint64)[0]
    nearest = np.argsort(np.bitwise_count(prints ^ middle), kind="stable")[:hubs]
    return [(int(h), int(k)) for h in nearest for k in np.flatnonzero(np.bitwise_count(prints ^ prints[h]) <= most) if k != h]


def spans(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, sizes) of the groups of sorted rows whose first three columns are alike."""
    same = (rows[1:, :3] == rows[:-1, :3]).all(axis=1)
    starts = np.flatnonzero(np.concatenate(([True], ~same)))
    return starts, np.diff(np.append(starts, len(rows)))


def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Batches of longs sorted by their first three columns, as matrices that end where a group of these does."""
    rest: np.ndarray | None = None  # rows of the last group, which may go on in the next batch
    for batch in batches:
        rows = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]) if batch.num_rows else np.empty((0, batch.num_columns), np.int64)
        rows = rows if rest is None else np.concatenate([rest, rows])
        if not len(rows):
            continue
        other = np.flatnonzero((rows[:, :3] != rows[-1, :3]).any(axis=1))
        last = int(other[-1]) + 1 if len(other) else 0
        rest = rows[last:]
        if last:
            yield rows[:last]
    if rest is not None and len(rest):
        yield rest


def links(vertices: DataFrame, lanes: int, most: int, blocks: int, shared: int, most_rows: int | None = None, hubs: int = 0) -> DataFrame:
    """Edges (u, v) that join all vertices connected at `most` differing bits of the first lane within some block key, for
    vertices(vertex, f0, ...) with distinct `vertex`. For links that are verified later, `hubs` adds edges from the middle of
    each group, as the nearest by 64 bits may fail where the text that all were made from does not. Copies have been put into one vertex before, so that a group that
    shares S of B blocks of a single lane has at most 2 ** (64 * (B - S) / B) rows."""

    def emit(rows: np.ndarray) -> pa.RecordBatch:
        starts, sizes = spans(rows)
        u, v = [], []
        for a, n in zip(starts[sizes > 1].tolist(), sizes[sizes > 1].tolist(), strict=True):
            group = rows[a : a + n]
            prints = group[:, 4].copy().view(np.uint64)
            for i, j in spanning_links(prints, most) + hub_links(prints, most, hubs):
                u.append(min(group[i, 3], group[j, 3]))
                v.append(max(group[i, 3], group[j, 3]))
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(emit, whole_groups(batches))

    keyed = dealt(block_keys(vertices, lanes, blocks, shared), most_rows)
    together = keyed.repartition("combo", "key", "part").sortWithinPartitions("combo", "key", "part", "vertex")
    return together.select("combo", "key", "part", "vertex", "f0").mapInArrow(run, "u long, v long").distinct()


def dealt(keyed: DataFrame, most_rows: int | None, by: tuple[str, ...] = ("combo", "key"), large: str = "true") -> DataFrame:
    """keyed with a part: 0, but the groups of more than most_rows rows are dealt over buckets of half that size, and there is
    a part for each pair of buckets, so that any two rows of a group meet in some part, whatever its size. Groups are
    counted by their rows where `large` holds."""
    alone = keyed.withColumn("part", F.lit(0).cast("long"))
    if not most_rows:
        return alone
    large = written(keyed.filter(large).groupBy(*by).agg(F.count("*").alias("group_rows")).filter(F.col("group_rows") > most_rows))
    if large.isEmpty():
        return alone
    buckets = F.ceil(2 * F.col("group_rows") / most_rows)
    bucket = F.pmod(F.xxhash64("vertex", by[0]), buckets)
    others = F.filter(F.sequence(F.lit(0).cast("long"), buckets - 1), lambda j: j != bucket)
    parts = F.when(F.col("group_rows").isNull(), F.array(F.lit(0).cast("long"))).otherwise(F.transform(others, lambda j: F.least(j, bucket) * buckets + F.greatest(j, bucket)))
    return written(keyed).join(large, list(by), "left").select(*keyed.columns, F.explode(parts).alias("part"))


def link_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 3, most: int = 2, blocks: int = 8, shared: int = 6) -> DataFrame:
    """(doc_id, fingerprint, component_id): documents linked, over any number of steps, by fingerprints that differ in at
    most `most` bits; component_id is the smallest doc_id of them. Needs blocks - shared >= most."""
    if blocks - shared < most:
        raise ValueError("fingerprints could differ in every choice of blocks")
    prints = cut_lineage(fingerprints(docs, doc_id, text, words))
    classes = prints.groupBy("f0").agg(F.min("doc_id").alias("least"))
    found = connected_components(links(classes.select(F.col("f0").alias("vertex"), "f0"), 1, most, blocks, shared))
    rooted = classes.join(found.withColumnRenamed("node", "f0"), "f0").select("f0", "root", "least")
    named = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component")), "root").select("f0", "component")
    # Written, so that the last join has plain shuffles on both sides: Spark splits those where a fingerprint is very common.
    named = written(classes.join(named, "f0", "left").select("f0", F.coalesce("component", "least").alias("component_id")))
    return prints.join(named, "f0").select("doc_id", F.lpad(F.lower(F.hex("f0")), 16, "0").alias("fingerprint"), "component_id")


def asked_overlap(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """The least number of common members that sets of these sizes need for the similarity."""
    return np.ceil(similarity / (1 + similarity) * (a + b) - 1e-6).astype(np.int64)


def prefix_size(n: np.ndarray, similarity: float) -> np.ndarray:
    """How many first members of a set of n, in any order that all sets share, hold a common one with each set so similar."""
    return np.minimum(n, n - np.ceil(similarity * n - 1e-6).astype(np.int64) + 1)


def common_shingles(rows: DataFrame, words: int, sample: int, sample_chars: int, most: int) -> list[int]:
    """The shingles that most texts of a sample of rows(text) have, three at least: `most` of them or fewer.
    The sample has about `sample` texts and `sample_chars` characters."""
    texts, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    share = min(1.0, sample / max(1, texts), sample_chars / max(1, chars))
    spread = F.xxhash64("text")
    kept = (rows if share == 1 else rows.filter(spread < int(-(2**63) + 2**64 * share))).select(spread.alias("h"), "text").dropDuplicates(["h"])
    found = written(kept.select(F.explode(F.array_distinct(shingle_hashes(F.col("text"), words))).alias("s")).groupBy("s").count().filter("count > 2"))
    # By a count, not by an ordered limit, of which each task would send so many to the driver.
    sizes, least, total = found.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.desc("count")).collect(), 2**62, 0
    for r in sizes:
        total += r["n"]
        if total > most:
            break
        least = r["count"]
    return sorted(r["s"] for r in found.filter(F.col("count") >= least).collect())


def prefixes(rows: DataFrame, words: int, similarity: float, sample: int = 4096, sample_chars: int = 20_000_000, most_common: int = 2000) -> DataFrame:
    """(doc_id, digest, n, cold, tokens) of rows(doc_id, text, digest): the number of distinct shingles and the first of them, of
    which `cold` are none of common_shingles(). A text without shingles counts as having one of its own kind."""
    common = common_shingles(rows, words, sample, sample_chars, most_common)
    distinct = rows.select("doc_id", "digest", F.array_distinct(shingle_hashes(F.col("text"), words)).alias("s"))
    filled = distinct.withColumn("s", F.when(F.size("s") == 0, F.array(F.lit(0).cast("long"))).otherwise(F.col("s")))
    rare, rest = F.sort_array(F.filter("s", lambda x: ~x.isin(common))), F.sort_array(F.filter("s", lambda x: x.isin(common)))
    ordered = filled.select("doc_id", "digest", F.size("s").cast("long").alias("n"), rare.alias("rare"), rest.alias("rest"))
    size = F.least("n", F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - F.lit(1e-6)) + 1).cast("int")
    return ordered.select("doc_id", "digest", "n", F.least(F.size("rare"), size).cast("long").alias("cold"), F.slice(F.concat("rare", "rest"), F.lit(1), size).alias("tokens"))


def meetings(group: np.ndarray, similarity: float, at_once: int = 200_000) -> Iterator[np.ndarray]:
    """(u, v, least) of the pairs of different groups, among rows (.., vertex, root, n, at) that share a shingle at place `at` of
    their order, which may be similar by their sizes and places; least: in how many places of their prefixes they must meet."""
    roots, count = np.unique(group[:, 4], return_counts=True)
    if len(roots) < 2:
        return
    large = group[:, 4] == roots[count.argmax()]
    group = np.concatenate([group[~large], group[large]])  # rows of the largest are not compared among themselves
    vertex, root, n, at = group[:, 3:7].T
    rest, others, block = n - at - 1, int((~large).sum()), max(1, at_once // len(group))
    for a in range(0, others, block):
        b = min(a + block, others)
        i, j = np.nonzero(root[a:b, None] != root[None, a:])
        i, j = i + a, j + a
        fits = i < j
        i, j = i[fits], j[fits]
        least = asked_overlap(n[i], n[j], similarity)
        fits = (np.minimum(n[i], n[j]) >= similarity * np.maximum(n[i], n[j]) - 1e-6) & (np.minimum(at[i], at[j]) + 1 + np.minimum(rest[i], rest[j]) >= least)
        i, j, least = i[fits], j[fits], least[fits]
        least = least - np.maximum(n[i] - prefix_size(n[i], similarity), n[j] - prefix_size(n[j], similarity))
        yield np.column_stack([np.minimum(vertex[i], vertex[j]), np.maximum(vertex[i], vertex[j]), least])


def pairs_by_prefix(sets: DataFrame, similarity: float, most_rows: int | None) -> DataFrame:
    """(u, v): all pairs of sets(vertex, root, n, cold, tokens) of different roots that may have the similarity.

    Of a pair, what is common lies in both prefixes or behind one of them, so it meets at least as often in the prefixes as
    what it needs exceeds what may lie behind."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(found: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(found[:, k].copy()) for k in range(3)], ["u", "v", "least"])

        for rows in whole_groups(batches):
            starts, sizes = spans(rows)
            mixed = np.minimum.reduceat(rows[:, 4], starts) != np.maximum.reduceat(rows[:, 4], starts)
            ready, held = [], 0
            for a, n in zip(starts[mixed].tolist(), sizes[mixed].tolist(), strict=True):
                for found in meetings(rows[a : a + n], similarity):
                    ready, held = [*ready, found], held + len(found)
                    if held > 100_000:
                        yield batch(np.concatenate(ready))
                        ready, held = [], 0
            if held:
                yield batch(np.concatenate(ready))

    keyed = sets.select("vertex", "root", "n", "cold", F.posexplode("tokens").alias("at", "token"))
    keyed = dealt(keyed.withColumn("at", F.col("at").cast("long")), most_rows, ("token",), "at >= cold")
    names = ["token", "part", F.lit(0).cast("long").alias("none"), "vertex", "root", "n", "at"]
    together = keyed.repartition("token", "part").sortWithinPartitions("token", "part").select(*names)
    met = together.mapInArrow(run, "u long, v long, least long").groupBy("u", "v").agg(F.count("*").alias("times"), F.first("least").alias("least"))
    return met.filter("times >= least").select("u", "v")


def verified(candidates: DataFrame, rows: DataFrame, firsts: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (u, v) of vertices whose texts have the similarity."""
    ends = candidates.select(F.col("u").alias("vertex")).union(candidates.select(F.col("v").alias("vertex"))).distinct().join(firsts, "vertex").select("vertex", "doc_id", "digest")
    # Written, as are the keepers: joins with them are then split where one text has very many copies.
    texts = rows.join(ends, ["doc_id", "digest"])
    sets = written(texts.dropDuplicates(["vertex"]).select("vertex", F.array_distinct(shingle_hashes(F.col("text"), words)).alias("s")))
    pairs = candidates.join(sets.select(F.col("vertex").alias("u"), F.col("s").alias("a")), "u").join(sets.select(F.col("vertex").alias("v"), F.col("s").alias("b")), "v")
    return pairs.filter(likeness(F.col("a"), F.col("b")) >= similarity).select("u", "v")


def near_duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lanes: int = 32, most: int = 14, blocks: int = 64, shared: int = 1, words: int = 5, similarity: float = 0.8, most_rows: int = 20_000, hubs: int = 4) -> DataFrame:
    """(doc_id, digest, keeper, keeper_digest): every document that is a copy of another, by its id and the SHA-256 of its text, and
    the document of its group that stays.

    Equal texts are copies. Texts are linked if their sets of five-word shingles have a Jaccard similarity of 0.8 or more, and
    groups are connected components: all of them, whatever the text's length and the size of the group. Most links are
    found as candidates of 2048-bit fingerprints of the set of single words, in 64 blocks of 32 bits: pairs within 63 bits
    meet for certain, others by chance, and the first 64 bits differ in at most `most`. The groups that these leave apart are then
    compared by prefixes of their shingles, which miss nothing.
    """
    rows = docs.filter(F.col(f"`{doc_id}`").isNotNull()).select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), whole(F.col(f"`{text}`")).alias("text"))
    digest = F.sha2("text", 256)
    rows = rows.withColumn("digest", digest)
    at = ["doc_id", "digest"]
    # A text stands for itself under a number of its own, as an id may have several texts.
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), (F.count("*") > 1).alias("copied"))
    firsts = cut_lineage(firsts.withColumn("vertex", F.monotonically_increasing_id()))
    prints = fingerprints(rows.select("doc_id", "text"), words=1, lanes=lanes, distinct=True, keep=digest)
    prints = cut_lineage(prints.join(firsts.select(*at, "vertex"), at).drop(*at).dropDuplicates(["vertex"]))
    candidates = cut_lineage(links(prints, lanes, most, blocks, shared, most_rows, hubs))
    found = connected_components(verified(candidates, rows, firsts, words, similarity)).withColumnRenamed("node", "vertex")
    sets = prefixes(rows, words, similarity).join(firsts.select(*at, "vertex"), at).dropDuplicates(["vertex"])
    sets = written(sets.join(found, "vertex", "left").select("vertex", F.coalesce("root", "vertex").alias("root"), "n", "cold", "tokens"))
    missed = cut_lineage(pairs_by_prefix(sets, similarity, most_rows))
    if not missed.isEmpty():
        near = verified(missed, rows, firsts, words, similarity)
        found = connected_components(near.unionByName(found.select(F.col("root").alias("u"), F.col("vertex").alias("v")))).withColumnRenamed("node", "vertex")
    near = firsts.join(found, "vertex", "left").withColumn("root", F.coalesce("root", "vertex")).drop("vertex")
    keeper = F.min(F.struct(*at)).alias("k")
    keepers = written(near.join(near.groupBy("root").agg(keeper), "root").select("digest", F.col("k.doc_id").alias("keeper"), F.col("k.digest").alias("keeper_digest"), (F.col("copied") | (F.col("k.digest") != F.col("digest"))).alias("copied")))
    return rows.select(*at).join(keepers.filter("copied").drop("copied"), "digest").select(*at, "keeper", "keeper_digest").distinct()


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """docs without the copies that near_duplicate_groups() finds: of each group the smallest id stays."""
    gone = near_duplicate_groups(docs, doc_id, text, **how).filter("doc_id <> keeper or digest <> keeper_digest").select(F.col("doc_id").alias("gone of id"), F.col("digest").alias("gone of digest")).distinct()
    same = (F.col(f"`{doc_id}`").cast("long") == F.col("`gone of id`")) & (F.sha2(whole(F.col(f"`{text}`")), 256) == F.col("`gone of digest`"))
    return docs.join(gone, same, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
