"""A quality classifier on random-indexing word vectors.

Every word has a key for its letters and a key for its shape (case, length, the marks at its ends, whether it repeats the word
before). The corpus' most frequent words, counted over all texts, have a row each; rarer words and shapes are hashed to a fixed
number of further rows. Over the whole corpus each row sums the sparse random index
vectors of the keys two places to either side: its random-indexing vector. A text is the mean vector of its words
and of its shapes, with its length; a two-layer network learns quality from a bounded sample of labelled texts, a
temperature fitted on rows it has not seen calibrates it, and all texts are scored.

Sums are of whole numbers, so the vectors do not depend on the order of tasks. Edge cases: null, empty and blank texts
are the zero vector with length 0 and are scored like others; without labels, or with one kind only, the score is the
share of label 1, or 0.5 when there is none; repeated label rows count once, good if any is; repeated rows keep
their rows; very long texts are read in full; an empty table gives an empty result; other columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pelagia.llm.arrays import _LOWER, mix, text_blocks, word_bounds, word_hashes
from pelagia.llm.common import materialize, release

#: Words that have a row of their own, rows that the other words share, rows of shapes.
VOCABULARY = 16_384
WORD_ROWS = 4096
SHAPE_ROWS = 512
DIMS = 32
NONZERO = 2
REACH = 2
#: The labelled rows the network learns from, at most.
MAX_LABELS = 12_000
HIDDEN = 24
_U = np.uint64
_ROWS = VOCABULARY + WORD_ROWS + SHAPE_ROWS
#: Bytes of text a task sums at once, and words it counts before it hands them on.
_SUM_BYTES = 2_000_000
_COUNTED = 2_000_000

#: Classes of a byte at a word's end: the byte itself for ASCII marks, else lower, upper, digit, or the rest.
_CLASS = np.arange(256, dtype=np.uint64)
_CLASS[ord("a") : ord("z") + 1] = 256
_CLASS[ord("A") : ord("Z") + 1] = 257
_CLASS[ord("0") : ord("9") + 1] = 258
_CLASS[128:] = 259


def keys(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word row, shape row and text row of every word of a block. vocabulary: ascending hashes of the words with a row of their own."""
    starts, ends, rows = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    n = len(h)
    size = ends - starts
    cls = _CLASS[data] if n else np.zeros(0, np.uint64)
    upper = np.concatenate([[0], np.cumsum(_LOWER[data] != data)]) if n else np.zeros(1, int)
    shout = np.minimum(3, (upper[ends] - upper[starts]) if n else np.zeros(0, int)).astype(np.uint64)
    again = np.zeros(n, np.uint64)
    again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
    length = np.minimum(4, np.log2(np.maximum(size, 1)).astype(int)).astype(np.uint64)
    code = cls[starts] if n else cls
    for part in (cls[ends - 1], cls[np.maximum(ends - 2, starts)], shout, again, length) if n else ():
        code = code * _U(1009) + part
    place = np.minimum(np.searchsorted(vocabulary, h), max(0, len(vocabulary) - 1))
    shared = (h % _U(WORD_ROWS)).astype(np.int64) + VOCABULARY
    words = np.where(vocabulary[place] == h, place, shared) if len(vocabulary) else shared
    return words, (mix(code) % _U(SHAPE_ROWS)).astype(np.int64) + VOCABULARY + WORD_ROWS, rows


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash and number of a task's words, mostly once a word."""
    words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def out() -> pa.RecordBatch:
        return pa.record_batch([pa.array(words.view(np.int64)), pa.array(counts)], names=["word", "n"])

    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column(0), _SUM_BYTES):
            starts, ends, _ = word_bounds(data, offsets)
            new, n = np.unique(word_hashes(data, starts, ends), return_counts=True)
            words, at = np.unique(np.concatenate([words, new]), return_inverse=True)
            counts = np.bincount(at, np.concatenate([counts, n]), len(words)).astype(np.int64)
            if len(words) > _COUNTED:
                yield out()
                words, counts = words[:0], counts[:0]
    if len(words):
        yield out()


def frequent_words(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The ascending hashes of the corpus' most frequent words, by counts over all texts."""
    counted = docs.select(text).mapInArrow(_word_counts, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(VOCABULARY).select("word").toArrow()  # a bounded list
    return np.sort(top.column("word").to_numpy().view(np.uint64))


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of every row's sparse random index vector."""
    h = mix(np.arange(_ROWS * NONZERO, dtype=np.uint64) + _U(0xC0FFEE)).reshape(_ROWS, NONZERO)
    return (h % _U(DIMS)).astype(np.int64), np.where(h >> _U(63), 1.0, -1.0)


def _context_sums(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """One table of summed index vectors a task: its size is fixed."""
    place, sign = index_vectors()
    total, count = np.zeros(_ROWS * DIMS), np.zeros(_ROWS)
    for batch in batches:
        for _, _, data, offsets in text_blocks(batch.column(0), _SUM_BYTES):
            *both, rows = keys(data, offsets, vocabulary.value)
            for k in both:
                count += np.bincount(k, minlength=_ROWS)
                for step in range(1, REACH + 1):
                    same = rows[step:] == rows[:-step] if len(rows) > step else np.zeros(0, bool)
                    a, b = k[:-step][same] if len(same) else k[:0], k[step:][same] if len(same) else k[:0]
                    for me, other in ((a, b), (b, a)):
                        for z in range(NONZERO):
                            total += np.bincount(me * DIMS + place[other, z], weights=sign[other, z], minlength=_ROWS * DIMS)
    used = np.flatnonzero(count)
    for i in range(0, len(used), 1000):
        at = used[i : i + 1000]
        flat = total.reshape(_ROWS, DIMS)[at].astype(np.int64)
        columns = [pa.array(at), *(pa.array(np.ascontiguousarray(flat[:, d])) for d in range(DIMS))]
        yield pa.record_batch(columns, names=["row", *(f"v{d}" for d in range(DIMS))])


@dataclass
class Vectors:
    """The words with a row of their own, and all rows' vectors (fixed size), each of length 1 or zero plus half its own index vector."""

    vocabulary: np.ndarray
    table: np.ndarray


def word_vectors(docs: DataFrame, text: str = "text") -> Vectors:
    """From every word of every text."""
    vocabulary = frequent_words(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = "row long, " + ", ".join(f"v{d} long" for d in range(DIMS))
    parts = docs.select(text).mapInArrow(partial(_context_sums, vocabulary=shared), schema)
    summed = parts.groupBy("row").agg(*(F.sum(f"v{d}").alias(f"v{d}") for d in range(DIMS))).toArrow()  # at most _ROWS rows
    out = np.zeros((_ROWS, DIMS))
    out[summed.column("row").to_numpy()] = np.stack([summed.column(f"v{d}").to_numpy() for d in range(DIMS)], axis=1)
    place, sign = index_vectors()
    length = np.linalg.norm(out, axis=1, keepdims=True)
    out = np.divide(out, length, out=np.zeros_like(out), where=length > 0)
    for z in range(NONZERO):  # a row's own index vector tells rows with like company apart
        np.add.at(out, (np.arange(_ROWS), place[:, z]), sign[:, z] * 0.5)
    return Vectors(vocabulary, out.astype(np.float32))


def pool(data: np.ndarray, offsets: np.ndarray, vectors: Vectors) -> np.ndarray:
    """The features of each text of a block: mean word vector, mean shape vector, log length."""
    n = len(offsets) - 1
    words, shapes, rows = keys(data, offsets, vectors.vocabulary)
    at = np.searchsorted(rows, np.arange(n + 1))
    count = np.diff(at)
    out = np.zeros((n, 2 * DIMS + 1), np.float32)
    full = np.flatnonzero(count)
    if len(full):
        for part, k in enumerate((words, shapes)):
            sums = np.add.reduceat(vectors.table[k], at[full], axis=0, dtype=np.float32)
            out[full, part * DIMS : (part + 1) * DIMS] = sums / count[full, None]
    out[:, -1] = np.log1p(count)
    return out


@dataclass
class Network:
    """Two layers over standardised features; p = sigmoid(z / temperature)."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.w1 + self.b1) @ self.w2 + self.b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def train_network(x: np.ndarray, y: np.ndarray, seed: int = 5, epochs: int = 60, batch: int = 256) -> Network:
    """Adam on four rows of five; the fifth fits the temperature."""
    rng = np.random.default_rng(seed)
    x, y = x.astype(float), y.astype(float)
    order = rng.permutation(len(x))
    hold, rows = order[: len(x) // 5], order[len(x) // 5 :]
    if len(set(y[rows])) < 2:
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6))
        return Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1], 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    mean, scale = x[rows].mean(0), x[rows].std(0) + 1e-4
    z = (x - mean) / scale
    p = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    epochs = max(epochs, 40 * batch * 30 // max(1, len(rows)))
    for _ in range(min(epochs, 400)):
        for at in np.array_split(rng.permutation(rows), max(1, len(rows) // batch)):
            hidden = np.tanh(z[at] @ p[0] + p[1])
            gap = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -40, 40))) - y[at]) / len(at)
            back = np.outer(gap, p[2]) * (1 - hidden**2)
            g = [z[at].T @ back + 1e-4 * p[0], back.sum(0), hidden.T @ gap + 1e-4 * p[2], np.array([gap.sum()])]
            t += 1
            for i, d in enumerate(g):
                m[i] = 0.9 * m[i] + 0.1 * d
                v[i] = 0.999 * v[i] + 0.001 * d * d
                p[i] = p[i] - 0.003 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    net = Network(mean, scale, p[0], p[1], p[2], float(p[3][0]))
    logits, want = net.logits(x[hold]), y[hold]
    loss = lambda t: np.logaddexp(0, np.where(want > 0, -1, 1) * logits / t).mean() if len(want) else abs(t - 1)
    net.temperature = float(min(np.geomspace(0.25, 8, 41), key=loss))
    return net


def _pooled(vectors) -> callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                x = pool(data, offsets, vectors.value)
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)), pa.array(x.ravel()))
                yield pa.record_batch([batch.column(0).slice(first, last - first), values], names=["quality", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame, max_labels: int = MAX_LABELS) -> tuple[Vectors, Network]:
    """Vectors from all of docs (doc_id, text), the network from labels (doc_id, quality) the caller allows."""
    vectors = word_vectors(docs)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality"))
    sample = materialize(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels))
    rows = docs.join(F.broadcast(sample), "doc_id").select("quality", "text")
    shared = docs.sparkSession.sparkContext.broadcast(vectors)
    found = rows.mapInArrow(_pooled(shared), "quality int, x array<float>").orderBy(F.xxhash64("x"), "quality").limit(2 * max_labels).collect()
    release(sample)
    x = np.array([r["x"] for r in found], np.float32).reshape(len(found), 2 * DIMS + 1)
    return vectors, train_network(x, np.array([r["quality"] for r in found], float))


def score(docs: DataFrame, vectors: Vectors, network: Network, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key and score for every row of docs."""
    shared = docs.sparkSession.sparkContext.broadcast((vectors, network))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, net = shared.value
        for batch in batches:
            for first, last, data, offsets in text_blocks(batch.column(1)):
                p = net.probabilities(pool(data, offsets, table).astype(float))
                yield pa.record_batch([batch.column(0).slice(first, last - first), pa.array(p)], names=[key, "score"])

    return docs.select(F.col(key).cast("long").alias(key), text).mapInArrow(run, f"{key} long, score double")
