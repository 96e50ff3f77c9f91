"""Benchmark decontamination: every passage of every document queries a BM25 index of the test items by block-max WAND.

Items are words, lower-cased and without marks around them. A term's weight in an item is its BM25 impact over the item's
score for itself, so that a passage with all of an item's words scores 1 and one threshold serves all items. Passages are
overlapping windows in which any item fits whole. Windows in which the block maxima of no block of items add up to the
threshold are pruned first, for many windows of a text at once; the others go through block-max WAND. What
scores the threshold or more is verified: of the item's question and of its answer, each at least `overlap` of the five-word
shingles must stand in the window; or else, as one altered word breaks five shingles, each at least `overlap` of the words
in order (one word may differ in parts of three to five words), by edit distance, the answer next to the question. Texts never leave their task; only found pairs, or kept rows, come out.

The index is built from the test items on the driver (a stated, small set; more than MOST_ITEMS or MOST_CHARS is an error); items
are indexed in blocks of at most `block_items` items and `block_words` words (an item of more is a block by itself), each block
against all documents, so that the index in a task has a bounded size. Block maxima are kept for the terms of a block alone. Items
of a block are at most WIDEST times as long as the shortest, so that one long item does not widen the windows of all. BM25
statistics cover all items.

Defined results: null texts are empty and match nothing; very long texts take bounded memory; an empty table gives an empty table
or, without items, all documents; ties of score go to the first window; items without words match nothing; equal items are found each by
its id; an item with no sentence end before its last third has its last third of words as answer; repeated rows are found
each; further columns are ignored (find_leaks) or passed through (drop_leaking).
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import whole

K1, B, THRESHOLD, OVERLAP, SHINGLE, POSTINGS_BLOCK, BLOCK_ITEMS, BLOCK_WORDS, SLACK = 1.2, 0.75, 0.7, 0.8, 5, 8, 2000, 200_000, 1e-4
#: Items of a block have at most so many times the words of its shortest, or as many as short ones may have.
WIDEST, SHORT_WORDS = 4, 128
#: Strides in work at once, which bounds the memory a long text takes; an item number behind all.
AT_ONCE, FAR = 256, 1 << 60
#: Most items and characters of items that a driver collects.
MOST_ITEMS, MOST_CHARS = 500_000, 200_000_000
MARKS = ".,;:!?\"'()[]{}<>*#%&$|-_…«»„“”"


def words_of(text: str) -> list[str]:
    return [w for w in (raw.strip(MARKS) for raw in text.lower().split()) if w]


def question_and_answer(text: str) -> tuple[str, str]:
    """The item's last sentence, if it has no more than half the words, is its answer; else its last third of words."""
    sentences = [s for s in re.split(r"(?<=[.!?])\s+|\n+", text.strip()) if words_of(s)]
    if len(sentences) > 1 and 2 * len(words_of(sentences[-1])) <= len(words_of(text)):
        return " ".join(sentences[:-1]), sentences[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def shingles(ids: list[int]) -> set[tuple[int, ...]]:
    n = min(SHINGLE, len(ids))
    return {tuple(ids[k : k + n]) for k in range(len(ids) - n + 1)} if n else set()


def edits(part: list[int], window: list[int]) -> int:
    """The least edit distance in words of `part` to any stretch of `window`."""
    row = [0] * (len(window) + 1)
    for k, w in enumerate(part, 1):
        last, row[0] = row[0], k
        for j, x in enumerate(window, 1):
            last, row[j] = row[j], min(last + (w != x), row[j] + 1, row[j - 1] + 1)
    return min(row)


def aligned(question: list[int], answer: list[int], window: list[int], overlap: float) -> tuple[float, float] | None:
    """Shares of the question's and the answer's words that stand unaltered, if both are enough and stand together."""

    def allowed(n: int) -> int:
        return max(int((1 - overlap) * n + 1e-9), int(n >= 3))

    q, a = edits(question, window), edits(answer, window)
    if q > allowed(len(question)) or a > allowed(len(answer)):
        return None
    both = edits(question + answer, window)
    # An answer that is matched by chance elsewhere costs its own words here.
    if both > allowed(len(question) + len(answer)) or both > q + a + 1:
        return None
    return 1 - q / max(1, len(question)), 1 - a / max(1, len(answer))


class Terms(dict):
    """Raw word -> term number, 0 for words that no item has; forgets what it has added when it has grown large."""

    def __init__(self, numbers: dict[str, int]) -> None:
        super().__init__()
        self.numbers = numbers

    def __missing__(self, raw: str) -> int:
        if len(self) > 200_000:
            self.clear()
        found = self[raw] = self.numbers.get(raw.strip(MARKS), 0) if raw.strip(MARKS) else -1
        return found


class ItemIndex:
    """Postings by term, in item order, with their weights; and for each term its greatest weight in each block of items.

    Blocks are aligned at item numbers for all terms, so a block's bound is the sum of its terms' block maxima, and the
    pivots of WAND are the blocks whose bound reaches the threshold; the postings of other blocks are never added up.
    """

    def __init__(self, items: list[tuple[int, str]], frequency: dict[str, int], n_items: int, mean_words: float) -> None:
        self.ids = [i for i, _ in items]
        vocabulary = sorted({w for _, t in items for w in words_of(t)})
        self.numbers = {w: k + 1 for k, w in enumerate(vocabulary)}
        postings: list[list[tuple[int, float]]] = [[] for _ in range(len(vocabulary) + 1)]
        self.parts, self.words = [], []
        for at, (_, text) in enumerate(items):
            words = words_of(text)
            impact = {}
            for w, tf in Counter(words).items():
                idf = math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5))
                impact[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            total = sum(impact.values())
            for w, x in impact.items():
                postings[self.numbers[w]].append((at, x / total))
            self.words.append(tuple([self.numbers[w] for w in words_of(p)] for p in question_and_answer(text)))
            self.parts.append(tuple(map(shingles, self.words[-1])))
        self.first = np.cumsum([0, *map(len, postings)])
        self.items = np.array([i for p in postings for i, _ in p], dtype=np.int64)
        self.weights = np.array([w for p in postings for _, w in p])
        # The block maxima of a term: those of block_of and block_max from block_first[term] on.
        self.n_terms, self.n_blocks = len(postings), max(1, -(-len(items) // POSTINGS_BLOCK))
        at = np.repeat(np.arange(self.n_terms), np.diff(self.first)) * self.n_blocks + self.items // POSTINGS_BLOCK
        at, of = np.unique(at, return_inverse=True)
        self.block_max = np.zeros(len(at))
        np.maximum.at(self.block_max, of, self.weights)
        self.block_of, self.block_first = at % self.n_blocks, np.searchsorted(at // self.n_blocks, np.arange(self.n_terms + 1))
        self.longest = max((len(words_of(t)) for _, t in items), default=0)
        self.term_max, self.item_list, self.weight_list = np.zeros(self.n_terms), self.items.tolist(), self.weights.tolist()
        np.maximum.at(self.term_max, at // self.n_blocks, self.block_max)
        self._terms = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_terms": None}

    def encode(self, text: str) -> np.ndarray:
        if self._terms is None:
            self._terms = Terms(self.numbers)
        raw = text.lower().split()
        ids = np.fromiter(map(self._terms.__getitem__, raw), dtype=np.int64, count=len(raw))
        return ids[ids >= 0]

    def bounds(self, rows: np.ndarray, terms: np.ndarray, n: int) -> np.ndarray:
        """Of n rows and each block of items, the sum of the block maxima of the terms that are paired with the row."""
        counts = self.block_first[terms + 1] - self.block_first[terms]
        at = np.arange(counts.sum()) + np.repeat(self.block_first[terms] - np.cumsum(counts) + counts, counts)
        return np.bincount(np.repeat(rows, counts) * self.n_blocks + self.block_of[at], weights=self.block_max[at], minlength=n * self.n_blocks).reshape(n, self.n_blocks)

    def retrieve(self, terms: np.ndarray, threshold: float = THRESHOLD) -> list[tuple[int, float]]:
        """All (item position, score) with a score of threshold or more for a passage of these distinct terms, by block-max WAND.

        Each term has a cursor in its postings. By their item, the first cursors whose greatest weights add up to the threshold
        give the pivot, as no item before it can reach it. The pivot is scored if its block can; else all cursors skip the block."""
        reach = (self.bounds(np.zeros(len(terms), dtype=np.int64), terms, 1)[0] >= threshold - SLACK).tolist()
        if not any(reach):
            return []
        # (item, place in the postings, their end, greatest weight) of each term
        cursors = [[self.item_list[a], a, b, w] for a, b, w in zip(self.first[terms].tolist(), self.first[terms + 1].tolist(), self.term_max[terms].tolist(), strict=True) if a < b]
        found = []

        def advance(cursor: list, item: int) -> None:
            cursor[1] = at = bisect_left(self.item_list, item, cursor[1], cursor[2])
            cursor[0] = self.item_list[at] if at < cursor[2] else FAR

        while True:
            cursors.sort()
            bound, pivot = 0.0, FAR
            for cursor in cursors:
                bound += cursor[3]
                if bound >= threshold - SLACK:
                    pivot = cursor[0]
                    break
            if pivot == FAR:
                return found
            block = pivot // POSTINGS_BLOCK
            if not reach[block]:
                # The next block that can; items before the pivot cannot, nor can those of the blocks between.
                block = next((k for k in range(block + 1, len(reach)) if reach[k]), None)
                if block is None:
                    return found
                target = block * POSTINGS_BLOCK
            elif cursors[0][0] < pivot:
                target = pivot
            else:
                score = sum(self.weight_list[c[1]] for c in cursors if c[0] == pivot)
                if score >= threshold - 1e-9:
                    found.append((pivot, score))
                target = pivot + 1
            for cursor in cursors:
                if cursor[0] >= target:
                    break
                advance(cursor, target)

    def passages(self, ids: np.ndarray, stride: int, threshold: float) -> np.ndarray:
        """Starts of the windows of two strides in which some block may reach the threshold. A stride's bound counts each of
        its terms once, a window's bound adds those of its strides. Of a long text, AT_ONCE strides are in work at a time."""
        out, step = [], AT_ONCE * stride
        for start in range(0, len(ids), step):
            part = ids[start : start + step + stride]  # its last window needs the next stride
            n = -(-len(part) // stride)
            at = np.unique(np.arange(len(part)) // stride * self.n_terms + part)
            bounds = self.bounds(at // self.n_terms, at % self.n_terms, n)
            bounds[:-1] += bounds[1:]
            out.append(start + np.flatnonzero((bounds[:AT_ONCE] >= threshold - SLACK).any(axis=1)) * stride)
        return np.concatenate(out)

    def leaks(self, text: str, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> list[tuple[int, float, float, float, int]]:
        """(item id, score, overlap of question, of answer, first word of the window) of each verified item, best window."""
        ids = self.encode(text) if self.longest and text else np.empty(0, np.int64)
        if not len(ids):
            return []
        stride = max(self.longest, 2 * SHINGLE)
        best: dict[int, tuple[float, float, float, int]] = {}
        for start in self.passages(ids, stride, threshold).tolist():
            window = ids[start : start + 2 * stride]
            found = self.retrieve(np.unique(window[window > 0]), threshold)
            if not found:
                continue
            window, there = window.tolist(), {}
            for item, score in found:
                shares = []
                for part in self.parts[item]:
                    n = len(next(iter(part), ()))
                    if n and n not in there:
                        there[n] = {tuple(window[k : k + n]) for k in range(len(window) - n + 1)}
                    shares.append(len(part & there[n]) / len(part) if n else 1.0)
                if min(shares) < overlap:
                    shares = aligned(*self.words[item], window, overlap)
                if shares and (item not in best or score > best[item][0]):
                    best[item] = (score, *shares, start)
        return [(self.ids[item], *found) for item, found in sorted(best.items())]


def cut_items(items: list[tuple[int, str]], lengths: list[int], block_items: int = BLOCK_ITEMS, block_words: int = BLOCK_WORDS) -> list[list[tuple[int, str]]]:
    """Blocks of items by length, in their order where lengths are alike enough."""
    limits: list[int] = []
    for n in sorted(lengths):
        if not limits or n > limits[-1]:
            limits.append(max(WIDEST * n, SHORT_WORDS))
    order = sorted(range(len(items)), key=lambda k: bisect_left(limits, lengths[k]))
    out: list[list[tuple[int, str]]] = []
    words, group = 0, -1
    for k in order:
        at = bisect_left(limits, lengths[k])
        if not out or at != group or len(out[-1]) == block_items or words + lengths[k] > block_words:
            out.append([])
            words, group = 0, at
        out[-1].append(items[k])
        words += lengths[k]
    return out


def build_indexes(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", block_items: int = BLOCK_ITEMS, block_words: int = BLOCK_WORDS) -> list[ItemIndex]:
    """One index for each block of items; almost always one."""
    chosen = benchmark.select(F.col(item_id).cast("long").alias("item_id"), whole(text).alias("text"))
    n, chars = chosen.agg(F.count("*"), F.coalesce(F.sum(F.length("text").cast("long")), F.lit(0))).first()
    if n > MOST_ITEMS or chars > MOST_CHARS:
        raise ValueError(f"{n} items of {chars} characters are too many for an index on the driver; give them in parts")
    rows = chosen.collect()
    items = sorted(((r["item_id"], r["text"]) for r in rows if words_of(r["text"])), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    frequency = Counter(w for _, t in items for w in set(words_of(t)))
    lengths = [len(words_of(t)) for _, t in items]
    mean_words = sum(lengths) / max(1, len(items))
    return [ItemIndex(block, frequency, len(items), mean_words) for block in cut_items(items, lengths, block_items, block_words)]


LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, first_word long"


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """(doc_id, item_id, score, question_overlap, answer_overlap, first_word): verified items of each document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    out = None
    for index in build_indexes(benchmark) or [ItemIndex([], {}, 0, 0.0)]:

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [(d.as_py(), *leak) for d, t in zip(batch.column(0), batch.column(1), strict=True) for leak in index.leaks(t.as_py(), threshold, overlap)]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"])

        part = rows.mapInArrow(run, LEAKS)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaking(docs: DataFrame, benchmark: DataFrame, text: str = "text", threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """The rows of docs that no item leaks into, with all their columns."""
    at = docs.columns.index(text)
    for index in build_indexes(benchmark):

        def run(batches: Iterator[pa.RecordBatch], index: ItemIndex = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not index.leaks(t.as_py() or "", threshold, overlap) for t in batch.column(at)], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
