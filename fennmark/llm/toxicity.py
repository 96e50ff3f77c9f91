"""Toxicity by a convolutional text classifier: hashed word embeddings, filters of widths 1 to 3, max pooling over the text.

The network is trained in numpy by Adam; the gradient of max pooling goes to the winning windows alone. One embedding
dimension starts as the z-score of a word's document frequency among toxic texts, which a width-1 filter reads. A word's
vector is the sum of its own and of its first five letters', for inflected words. Words and beginnings seen in fewer than `LEAST_DOCS` training texts have a zero vector, so rare words cannot be learnt by heart. The logit becomes a
score by a scale and a threshold of greatest F1 for each language; the language is guessed from the text's own function words.

Learning reads at most `per_class` labelled texts of each class, the ones of least hash, whole texts that fit into `sample_chars`
characters together (a longer one is left out by itself); scoring reads every whole text.
Labels, language, source and id are no inputs of a score. For scoring, each filter is folded into a table of its
embeddings, so that a window costs a few look-ups.

Defined results: a null text is empty; a very long text is scored a stretch of words at a time; repeated rows and ties are each
scored alike; an empty table gives an empty table; an empty text has a logit of no words, so the scaled prior; null or contradictory
labels as in quality.sample_labelled; without texts of both classes every score is the share of toxic labels (0 without
labels); further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fennmark.llm.common import whole
from fennmark.llm.quality import SAMPLE_CHARS, platt, sample_labelled

BUCKETS, DIM, FILTERS, WIDTHS = 1 << 16, 8, 8, (1, 2, 3)
PREFIX, PER_CLASS, LEAST_DOCS, EPOCHS, BATCH, RATE = 5, 2000, 3, 8, 64, 0.01
PAD = max(WIDTHS) - 1
#: Words in work at once when scoring, and about as many in a training step.
AT_ONCE, BATCH_WORDS = 50_000, 50_000
#: Function words by which a text's language is guessed. Fixed values.
FUNCTION_WORDS = {
    "en": "the of and to in a is that it for was on are as with his they at be this from have or by not but what all were when".split(),
    "fr": "le la les de des du et un une est que qui dans pour pas sur au avec ce il elle ne se par plus".split(),
    "de": "der die das und ist von zu den mit nicht ein eine im für auf dem des sich als auch es an".split(),
    "es": "el los las del que y en un una es por con para no se su al lo como más pero sus".split(),
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
EDGES = ".,;:!?\"'()[]{}<>*#%&$|-_…«»„“”"


class WordIds(dict):
    """Word -> its bucket (1 to BUCKETS - 1) and, BUCKETS times, the bucket of its beginning; marks around the word do not
    count. Forgets all when it has grown large."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        bare = word.strip(EDGES)
        bucket = lambda s: 1 + zlib.crc32(s.encode()) % (BUCKETS - 1)
        found = self[word] = bucket(bare) + BUCKETS * bucket(f"{bare[:PREFIX]}-")
        return found


_ids = WordIds()


def word_ids(text: str) -> np.ndarray:
    words = text.lower().split()
    return np.fromiter(map(_ids.__getitem__, words), dtype=np.int64, count=len(words))


def vectors(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """A word's vector: its own plus its beginning's."""
    return table[ids % BUCKETS] + table[ids // BUCKETS]


def _language_table() -> np.ndarray:
    """Bucket -> index of the language that alone has the word, else of "other"."""
    table, seen = np.full(BUCKETS, len(FUNCTION_WORDS), dtype=np.int8), {}
    for k, words in enumerate(FUNCTION_WORDS.values()):
        for w in words:
            seen.setdefault(int(word_ids(w)[0]) % BUCKETS, set()).add(k)
    for bucket, of in seen.items():
        if len(of) == 1:
            table[bucket] = of.pop()
    return table


LANGUAGE_OF = _language_table()


def language(ids: np.ndarray) -> int:
    hits = np.bincount(LANGUAGE_OF[ids % BUCKETS], minlength=len(LANGUAGES))[:-1]
    return int(hits.argmax()) if hits.any() else len(LANGUAGES) - 1


def _layout(parts: list[np.ndarray], tails: list[int] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parts of texts one after another, each with PAD zeros behind it (an empty one has one more): ids, starts, which row
    may begin a window. The last tails[k] words of part k begin none, as the next part of the text has them too."""
    laid, open_at = [], []
    for k, d in enumerate(parts):
        d = d if len(d) else np.zeros(1, np.int64)
        laid += [d, np.zeros(PAD, np.int64)]
        tail = tails[k] if tails else 0
        open_at += [np.ones(len(d) - tail, bool), np.zeros(PAD + tail, bool)]
    sizes = [max(1, len(d)) + PAD for d in parts]
    return np.concatenate([*laid, np.zeros(PAD, np.int64)]), np.cumsum([0, *sizes[:-1]]), np.concatenate(open_at)


class ToxicityModel:
    def __init__(self, table: np.ndarray | None = None, filters: list[np.ndarray] | None = None, bias: np.ndarray | None = None, out: np.ndarray | None = None, base: float = 0.0) -> None:
        self.table, self.filters, self.bias, self.out, self.base = table, filters, bias, out, base
        self.scaling = [(1.0, 0.0)] * len(LANGUAGES)
        self._folded = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_folded": None}

    def pooled(self, starts: np.ndarray, may: np.ndarray, look: list[list[np.ndarray]]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Greatest response of each filter in each text, and the responses by width; look[k][j] is what the word j of a
        window adds to the filters of width k, for each word."""
        n, responses = len(may), []
        for of_width in look:
            r = of_width[0][:n].copy()
            for j in range(1, len(of_width)):
                r += of_width[j][j : n + j]
            r[~may] = -np.inf
            responses.append(r)
        return np.concatenate([np.maximum.reduceat(r, starts, axis=0) for r in responses], axis=1), responses

    def folded(self) -> list[list[np.ndarray]]:
        if self._folded is None:
            self._folded = [[np.ascontiguousarray(self.table @ w[j]) for j in range(len(w))] for w in self.filters]
        return self._folded

    def _best(self, docs: list[np.ndarray]) -> np.ndarray:
        """Greatest response of each filter in each text; a few ten thousand words are in work at once, however long a text."""
        best = np.full((len(docs), len(self.bias)), -np.inf)
        parts, tails, of, held = [], [], [], 0

        def work() -> None:
            if parts:
                ids, starts, may = _layout(parts, tails)
                found, _ = self.pooled(starts, may, [[vectors(t, ids) for t in of_width] for of_width in self.folded()])
                np.maximum.at(best, of, found)
            parts.clear(), tails.clear(), of.clear()

        for k, d in enumerate(docs):
            for a in range(0, max(1, len(d)), AT_ONCE):
                part = d[a : a + AT_ONCE + PAD]
                parts.append(part)
                tails.append(max(0, len(part) - AT_ONCE))
                of.append(k)
                held += len(part)
                if held >= AT_ONCE:
                    work()
                    held = 0
        work()
        return best

    def logits(self, docs: list[np.ndarray]) -> np.ndarray:
        if self.table is None or not docs:
            return np.full(len(docs), self.base)
        return np.maximum(self._best(docs) + self.bias, 0) @ self.out + self.base

    def scores(self, texts: list[str]) -> np.ndarray:
        docs = [word_ids(t) for t in texts]
        scaling = np.array([self.scaling[language(d)] for d in docs]).reshape(-1, 2)
        return 1 / (1 + np.exp(-np.clip(self.logits(docs) * scaling[:, 0] + scaling[:, 1], -30, 30)))


def train(docs: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, seed: int = 7) -> ToxicityModel:
    rng = np.random.default_rng(seed)
    seen, toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for d, label in zip(docs, y, strict=True):
        u = np.unique(np.concatenate([d % BUCKETS, d // BUCKETS]))
        seen[u] += 1
        toxic[u] += label
    p = y.mean()
    z = (toxic - seen * p) / np.sqrt(seen * p * (1 - p) + 1)
    table = rng.normal(0, 0.1, (BUCKETS, DIM))
    table[:, 0] = z / 6
    table[seen < LEAST_DOCS] = 0
    table[0] = 0
    live = ((seen >= LEAST_DOCS) & (np.arange(BUCKETS) > 0))[:, None]
    filters = [rng.normal(0, 0.3, (k, DIM, FILTERS)) for k in WIDTHS]
    filters[0][0, :, 0] = np.eye(DIM)[0]
    bias, out = np.zeros(FILTERS * len(WIDTHS)), np.full(FILTERS * len(WIDTHS), 0.1)
    out[0] = 1.0
    model = ToxicityModel(table, filters, bias, out, float(np.log(p / (1 - p))) - 1.0)
    weight = np.where(y == 1, 0.5 / p, 0.5 / (1 - p))
    params = [table, *filters, bias, out]
    m, v, t = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params], 0
    for epoch in range(epochs):
        order = rng.permutation(len(docs))
        words_before = np.cumsum([0, *(len(docs[k]) for k in order[:-1])])
        for rows in np.split(order, np.flatnonzero(np.diff((words_before // BATCH_WORDS) * len(order) + np.arange(len(order)) // BATCH)) + 1):
            ids, starts, may = _layout([docs[k] for k in rows])
            words = vectors(table, ids)
            best, responses = model.pooled(starts, may, [[words @ w[j] for j in range(len(w))] for w in filters])
            hidden = np.maximum(best + bias, 0)
            q = 1 / (1 + np.exp(-np.clip(hidden @ out + model.base, -30, 30)))
            g = (q - y[rows]) * weight[rows] / len(rows)
            of = np.repeat(np.arange(len(rows)), np.diff(np.append(starts, len(may))))
            back = g[:, None] * out[None, :] * (hidden > 0)
            grads = [np.zeros_like(x) for x in filters]
            touched, gains = [], []
            for k, r in enumerate(responses):
                at_doc, col = of, slice(k * FILTERS, (k + 1) * FILTERS)
                pos, f = np.nonzero(r == best[:, col][at_doc])
                _, first = np.unique(at_doc[pos] * FILTERS + f, return_index=True)
                pos, f = pos[first], f[first]
                gain = back[:, col][at_doc[pos], f]
                for j in range(WIDTHS[k]):
                    np.add.at(grads[k][j].T, f, gain[:, None] * words[pos + j])
                    for part in (ids[pos + j] % BUCKETS, ids[pos + j] // BUCKETS):
                        touched.append(part)
                        gains.append(gain[:, None] * filters[k][j][:, f].T)
            at, where = np.unique(np.concatenate(touched), return_inverse=True)
            g_table = np.zeros((len(at), DIM))
            np.add.at(g_table, where, np.concatenate(gains))
            t += 1
            rate = RATE * (1 - epoch / epochs)
            for k, (x, dx) in enumerate(zip(params, [g_table, *grads, back.sum(axis=0), hidden.T @ g + 1e-4 * out], strict=True)):
                if k == 0:  # only rows with a gradient move
                    m[0][at] = 0.9 * m[0][at] + 0.1 * dx
                    v[0][at] = 0.999 * v[0][at] + 0.001 * dx**2
                    x[at] -= rate * (m[0][at] / (1 - 0.9**t)) / (np.sqrt(v[0][at] / (1 - 0.999**t)) + 1e-8) * live[at]
                else:
                    m[k] = 0.9 * m[k] + 0.1 * dx
                    v[k] = 0.999 * v[k] + 0.001 * dx**2
                    x -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
            model.base -= rate * float(g.sum())
    table[0] = 0
    model.table = table.astype(np.float32)
    model.filters = [w.astype(np.float32) for w in filters]
    return model


def fit(texts: list[str], labels: list[int]) -> ToxicityModel:
    """Network from three quarters of the texts, scaling by language from the other quarter."""
    y = np.array(labels, dtype=float)
    if len(y) < 8 or not 2 <= y.sum() <= len(y) - 2:
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 1e-9
        return ToxicityModel(base=float(np.log(share / (1 - share))))
    docs = [word_ids(t) for t in texts]
    rank = np.zeros(len(y), dtype=int)
    for label in (0, 1):
        rank[y == label] = np.arange((y == label).sum())
    aside = rank % 4 == 3
    model = train([d for d, a in zip(docs, aside, strict=True) if not a], y[~aside])
    held = [d for d, a in zip(docs, aside, strict=True) if a]
    x, target, of = model.logits(held), y[aside], np.array([language(d) for d in held])
    whole_scale = scale(x, target)
    model.scaling = [scale(x[of == k], target[of == k]) if min(target[of == k].sum(), (1 - target[of == k]).sum()) >= 8 else whole_scale for k in range(len(LANGUAGES))]
    return model


def scale(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, constant): Platt's slope, and the constant that puts score 0.5 where F1 is greatest, midway between logits."""
    slope = max(platt(x[:, None], y)[0], 0.05)
    order = np.argsort(-x, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(x) + 1) + y.sum())
    f1[:-1][x[order][:-1] == x[order][1:]] = 0
    k = int(np.argmax(f1))
    cut = x[order][k] - 0.5 if k + 1 == len(x) else (x[order][k] + x[order][k + 1]) / 2
    return slope, -slope * float(cut)


def fit_toxicity(docs: DataFrame, labels: DataFrame, learn: Column | None = None, per_class: int = PER_CLASS, sample_chars: int = SAMPLE_CHARS) -> ToxicityModel:
    rows = sorted(map(tuple, sample_labelled(docs, labels, "toxic", learn, per_class, sample_chars).collect()))
    return fit([r[1] for r in rows], [r[2] for r in rows])


def score_toxicity(docs: DataFrame, model: ToxicityModel, doc_id: str = "doc_id", text: str = "text", at_once: int = 64) -> DataFrame:
    """(doc_id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, at_once):
                part = batch.slice(a, at_once)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.scores(part.column(1).to_pylist()), pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole(text).alias("text")).mapInArrow(run, "doc_id long, score double")
