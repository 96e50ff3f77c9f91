"""Quality by compression: text is compressed with a zstandard dictionary of good texts and with one of bad texts.

A text is cut into blocks of a few hundred bytes, each compressed by itself, so that what the dictionaries hold weighs as
much in a long text as in a short one. Its feature is (bytes with the bad dictionary - bytes with the good one) over their
sum and a steadying constant; beside it stands by how much the text compresses better than good texts do, as endless
repetition looks alike to both dictionaries. Platt scaling on labelled texts that the dictionaries have not seen makes the
two a probability of being good.

Learning reads a sample of at most `per_class` labelled texts of each class, the ones of least hash, whole texts that fit into
`sample_chars` characters together (a longer one is left out by itself); of the two classes' texts for the dictionaries as
many characters are used as the smaller class has, so that neither dictionary is better for its size. Scoring reads every whole text. Labels, language, source and id are no inputs of a score, only
the text is.

Defined results: a null text is empty; a very long text is compressed block by block; repeated rows and ties are each scored
alike; an empty table gives an empty table; an empty text has feature 0, so the calibrated prior; labels that are null, of ids
that no document has, or contradictory for one id (the larger counts) do no harm; without texts of both classes every
score is the share of good labels (0.5 without labels); further columns are ignored or passed through.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import whole

PER_CLASS, SAMPLE_CHARS, DICT_BYTES, BLOCK_BYTES, STEADY_BYTES, LEVEL = 1500, 12_000_000, 64 << 10, 384, 128, 1


class QualityModel:
    """good, bad: the dictionaries; usual: a ratio of raw to compressed size that good texts seldom exceed (as a logarithm);
    weights: of the two features and the constant."""

    def __init__(self, good: bytes = b"", bad: bytes = b"", usual: float = 0.0, weights: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> None:
        self.good, self.bad, self.usual, self.weights, self._tools = good, bad, usual, weights, None

    def __getstate__(self) -> tuple:
        return self.good, self.bad, self.usual, self.weights

    def __setstate__(self, state: tuple) -> None:
        self.__init__(*state)

    def sizes(self, text: str) -> tuple[int, int, int]:
        """Bytes of the text: raw, with the good dictionary, with the bad one."""
        if not self.good or not text:
            return 0, 0, 0
        if self._tools is None:
            self._tools = [_compressor(d) for d in (self.good, self.bad)]
        good, bad = self._tools
        data, a, b = text.encode(), 0, 0
        for k in range(0, len(data), BLOCK_BYTES):
            block = data[k : k + BLOCK_BYTES]
            a += len(good.compress(block))
            b += len(bad.compress(block))
        return len(data), a, b

    def features(self, text: str) -> tuple[float, float]:
        raw, a, b = self.sizes(text)
        return (b - a) / (a + b + STEADY_BYTES), max(0.0, math.log((raw + STEADY_BYTES) / (a + STEADY_BYTES)) - self.usual)

    def score(self, text: str) -> float:
        x, y = self.features(text)
        u, v, w = self.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, u * x + v * y + w))))


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    held = zstandard.ZstdCompressionDict(dictionary)
    held.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=held, write_content_size=False, write_checksum=False, write_dict_id=False)


def dictionary(texts: list[str], size: int = DICT_BYTES) -> bytes:
    """A trained dictionary; of too few texts for training, their beginning blocks in turn as raw content."""
    blocks = [data[k : k + BLOCK_BYTES] for t in texts for data in (t.encode(),) for k in range(0, len(data), BLOCK_BYTES)]
    try:
        return zstandard.train_dictionary(size, blocks, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(blocks)[-size:]


def balanced(texts: list[str], total: int) -> list[str]:
    """Texts up to `total` characters in all."""
    out, n = [], 0
    for t in texts:
        if n >= total:
            break
        out.append(t)
        n += len(t)
    return out


def fit(texts: list[str], labels: list[int]) -> QualityModel:
    """Dictionaries from two thirds of the texts of each class, scaling from the other third."""
    by = {y: [t for t, label in zip(texts, labels, strict=True) if label == y and t] for y in (0, 1)}
    share = (len(by[1]) + 1) / (len(by[0]) + len(by[1]) + 2)
    if min(len(by[0]), len(by[1])) < 3:
        return QualityModel(weights=(0.0, 0.0, math.log(share / (1 - share))))
    learn = {y: [t for k, t in enumerate(by[y]) if k % 3] for y in by}
    total = min(sum(map(len, learn[y])) for y in learn)
    dicts = {y: dictionary(balanced(learn[y], total)) for y in learn}
    model = QualityModel(dicts[1], dicts[0])
    rest = [(t, y) for y in by for t in by[y][::3]]
    model.usual = float(np.quantile([model.features(t)[1] for t, y in rest if y], 0.98))
    x, y = np.array([model.features(t) for t, _ in rest]), np.array([y for _, y in rest], dtype=float)
    model.weights = platt(x, y)
    if model.weights[1] > 0:  # chance: repetition speaks for no text
        model.weights = platt(x * [1, 0], y)
    return model


def platt(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, ...]:
    """Logistic regression by Newton's method with smoothed targets: the weights of x's columns, then the constant."""
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    scale = np.where(x.std(axis=0) > 0, x.std(axis=0), 1.0)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(curve, z.T @ (p - target) + 1e-2 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return (*(w[:-1] / scale).tolist(), float(w[-1]))


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column | None, per_class: int, sample_chars: int = SAMPLE_CHARS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, y): labelled rows of each class by least hash of the id, up to per_class rows. In that order each whole text
    is taken that fits into what is left of the class's sample_chars; one that does not fit is left out by itself, and those
    behind it still count. So what the driver reads is bounded. A class of which no text fits gives a warning. `learn` says
    of an id whether its label may be learnt from. Of several texts of one id the one of least hash counts."""
    ids = labels.groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y")).filter("doc_id is not null and y in (0, 1)")
    ids = ids if learn is None else ids.filter(learn)
    chosen = [ids.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text"))
    rows = rows.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id").withColumn("h", F.xxhash64("text"))  # at most 2 per_class rows
    sizes = rows.groupBy("doc_id", "y").agg(F.min(F.struct("h", F.length("text").alias("n"))).alias("t")).orderBy("y", F.xxhash64("doc_id"), "doc_id").collect()
    kept, left = [], {0: sample_chars, 1: sample_chars}
    for r in sizes:
        if r["t"]["n"] <= left[r["y"]]:
            left[r["y"]] -= r["t"]["n"]
            kept.append((r["doc_id"], r["t"]["h"]))
    for y in {r["y"] for r in sizes} - {r["y"] for r in sizes if (r["doc_id"], r["t"]["h"]) in set(kept)}:
        warnings.warn(f"no labelled text of {label} = {y} fits in {sample_chars} characters; nothing is learnt of this class", stacklevel=2)
    picked = docs.sparkSession.createDataFrame(kept, "doc_id long, h long")
    return rows.join(F.broadcast(picked), ["doc_id", "h"]).dropDuplicates(["doc_id"]).select("doc_id", "text", "y")


def learnable(doc_id: str = "doc_id", parts: int = 3, held_out: int = 1) -> Column:
    return F.crc32(F.col(doc_id).cast("string")) % parts != held_out


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = PER_CLASS, sample_chars: int = SAMPLE_CHARS) -> QualityModel:
    rows = sorted(map(tuple, sample_labelled(docs, labels, "quality", learn, per_class, sample_chars).collect()))
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score_quality(docs: DataFrame, model: QualityModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.score(t.as_py()) for t in batch.column(1)], pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: QualityModel, text: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of docs whose text scores `least` or more, with all their columns."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array([model.score(t.as_py() or "") >= least for t in batch.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
