"""Packing by minimum bin slack: documents become token pieces that fill sequences of fixed capacity almost wholly.

A document's ids, ended by id 0, are cut into whole windows and one remainder. Whole windows are sequences by themselves.
Remainders are dealt into groups of bounded size; in a group the longest one opens a window, and subset-sum dynamic
programming over the multiset of the other lengths (one bit of a big integer for each reachable sum) picks what comes
closest to the room left; counts are found by tracing the steps back, and a filling repeats while its lengths last.
Only lengths and checksums are shuffled, never texts or ids.

Defined results: a null text is empty and has the end id alone; a very long text is cut into whole windows; repeated rows each get
their own pieces; ties of length are taken in any order; ids may repeat or be null; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import whole

CAPACITY, END_ID, GROUP_ROWS = 1024, 0, 8192
TOKENIZER = "byte_bpe_50k"
#: Texts with other characters, or with the special token, go to the tokenizer file's own library.
UNUSUAL = re.compile("[^\x00-ɏ‐-‧€]|<\\|endoftext\\|>")


@lru_cache(maxsize=2)
def _tokenizers(name: str):
    """The tokenizer of the JSON file, and a faster reader of the same vocabulary."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(public_tokenizers.path(f"{name}.json")), fast


def encode(text: str, name: str = TOKENIZER) -> np.ndarray:
    """Ids as the tokenizer file gives them, without special tokens around, then END_ID; little-endian unsigned 32 bits.

    Both libraries give the same ids for texts without UNUSUAL characters (tested); the second takes a fifth of the time.
    """
    own, fast = _tokenizers(name)
    ids = own.encode(text, add_special_tokens=False).ids if UNUSUAL.search(text) else fast.encode_ordinary(text)
    return np.array([*ids, END_ID], dtype="<u4")


def closest_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """Of the multiset {length: count}, the sub-multiset with the greatest sum up to room, as {length: count}."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        many, take = min(counts[length], room // length), 1
        while many > 0:
            take = min(take, many)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            many, take = many - take, take * 2
            if reach >> room & 1:
                break
        if reach >> room & 1:
            break
    target, chosen = reach.bit_length() - 1, Counter()
    for length, take, before in reversed(steps):
        if not before >> target & 1:
            target -= length * take
            chosen[length] += take
    return dict(chosen)


def minimum_slack(lengths: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Bins of lengths (each up to capacity), every one opened by the longest that is left."""
    counts, bins = Counter(lengths), []
    for longest in sorted(counts, reverse=True):
        while counts[longest]:
            counts[longest] -= 1
            fill = closest_fill(counts, capacity - longest) if longest < capacity else {}
            again = 1 + min([counts[longest] // (1 + fill.get(longest, 0)), *((counts[x] - n) // n for x, n in fill.items() if x != longest)]) if fill.get(longest, 0) == 0 and fill else 1
            for x, n in fill.items():
                counts[x] -= n * again
            counts[longest] -= again - 1
            for _ in range(again):
                bins.append([longest, *(x for x, n in fill.items() for _ in range(n))])
        del counts[longest]
    return bins


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, name: str = TOKENIZER) -> DataFrame:
    """(doc_id, doc_tokens, crcs): tokens with the end id, and the CRC-32 of each piece of `capacity` ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, crcs = [], []
            for t in batch.column(1):
                ids = encode(t.as_py(), name)
                tokens.append(len(ids))
                crcs.append([zlib.crc32(ids[a : a + capacity].tobytes()) for a in range(0, len(ids), capacity)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "doc_tokens", "crcs"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(run, "doc_id long, doc_tokens long, crcs array<long>")


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, group_rows: int = GROUP_ROWS, name: str = TOKENIZER) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A group has about group_rows documents, whatever the input's size; its last window alone may stay partly empty.
    """
    groups = max(1, ceil(docs.count() / group_rows))

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        group = int(rows["grp"].iloc[0])
        rows = rows.assign(first=[c[0] for c in rows["crcs"]]).sort_values(["doc_id", "doc_tokens", "first"])
        out, made, waiting = [], 0, {}
        for row in rows.itertuples():
            tokens, crcs = int(row.doc_tokens), row.crcs
            doc = int(row.doc_id) if row.named else None
            for k in range(tokens // capacity):
                out.append((doc, k * capacity, capacity, int(crcs[k]), tokens, made, 0))
                made += 1
            if tokens % capacity:
                waiting.setdefault(tokens % capacity, []).append((doc, tokens - tokens % capacity, int(crcs[-1]), tokens))
        for lengths in minimum_slack([n for n, docs_ in waiting.items() for _ in docs_], capacity):
            offset = 0
            for n in lengths:
                doc, start, crc, tokens = waiting[n].pop()
                out.append((doc, start, n, crc, tokens, made, offset))
                offset += n
            made += 1
        found = pd.DataFrame([row[1:] for row in out], columns=["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        found.insert(0, "doc_id", pd.array([row[0] for row in out], dtype="Int64"))
        return found.assign(sequence_id=found["sequence_id"] + (group << 40))

    # By the row's place in its file partition too, so that rows alike in all are dealt over many groups; a retried task has the same.
    dealt = tokenized(docs, doc_id, text, capacity, name).withColumn("grp", F.pmod(F.xxhash64("doc_id", "doc_tokens", "crcs", F.monotonically_increasing_id()), F.lit(groups)))
    # pandas makes whole numbers with nulls floats, which would round large ids; so null ids are marked beside.
    marked = dealt.withColumn("named", F.col("doc_id").isNotNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)))
    return marked.groupBy("grp").applyInPandas(pack, PIECES)


def sequences(docs: DataFrame, pieces: DataFrame, doc_id: str = "doc_id", text: str = "text", name: str = TOKENIZER) -> DataFrame:
    """(sequence_id, ids): the packed ids themselves, for writing out. Needs distinct ids; texts are tokenized again where
    they lie, and only the ids travel."""
    spans = pieces.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("spans"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).join(spans, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(s["sequence_id"], s["offset"], ids[s["start"] : s["start"] + s["length"]].tolist()) for t, spans_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) for ids in (encode(t, name),) for s in spans_]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()), pa.array([f[2] for f in found], pa.list_(pa.int32()))], ["sequence_id", "offset", "ids"])

    parts = rows.select("text", "spans").mapInArrow(cut, "sequence_id long, offset long, ids array<int>")
    return parts.groupBy("sequence_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids"))
