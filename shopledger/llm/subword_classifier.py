"""Text classifier with learned subword embeddings.

Every whitespace-separated word and every run of 3, 4 and 5 bytes of the text is hashed to one of `buckets` vectors; a
word that repeats the one before it adds the vector of the word pair "same again", whichever word it is. A document is the mean of its vectors; a softmax layer turns it into class probabilities. Vectors and layer are trained
together by stochastic gradient descent in numpy, on a bounded sample of labelled rows. With two classes a document's
log odds are the mean of one number per bucket, so scoring looks up numbers instead of vectors.

Defined cases: a text without features (null, empty) gets the probability that the bias alone gives; without any labelled
row every probability is 0.5, with one class only that class is certain; rows whose label is null, or neither 0 nor 1, are
not learned from; a document labelled twice is learned from twice; equal rows each get their result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm import text as T

GRAM_SIZES = (3, 4, 5)
SAMPLE_ROWS = 2000
SAMPLE_CHARS = 20_000
SAMPLE_BYTES = 16 << 20

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_REPEATED = np.uint64(0x5EED)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h * _FACTOR) >> np.uint64(64 - (buckets - 1).bit_length())).astype(np.int64)


def features(data: np.ndarray, bounds: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """By kind of feature: bucket of each, and for each text the number of features before it."""
    space = _SPACE[data]
    begins = ~space
    begins[1:] &= space[:-1]
    stops = ~space
    stops[:-1] &= space[1:]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    begins[inner] = ~space[inner]
    stops[inner - 1] = ~space[inner - 1]
    starts = np.flatnonzero(begins)
    words, before = T.span_hashes(data, starts, np.flatnonzero(stops) + 1), np.searchsorted(starts, bounds)
    yield _bucket(words, buckets), before
    again = words[1:] == words[:-1]
    first = before[(before > 0) & (before < len(words))]
    again[first - 1] = False
    at = np.flatnonzero(again) + 1
    yield _bucket(np.full(len(at), _REPEATED), buckets), np.searchsorted(at, before)
    packed = data.astype(np.uint64)
    for size in range(2, max(GRAM_SIZES) + 1):
        if len(data) < size:
            return
        packed = packed[:-1] | (data[size - 1 :].astype(np.uint64) << np.uint64(8 * (size - 1)))
        if size in GRAM_SIZES:
            inside = np.ones(len(packed), bool)  # not over the end of a text
            for back in range(1, size):
                at = inner - back
                inside[at[(at >= 0) & (at < len(packed))]] = False
            at = np.flatnonzero(inside)
            yield _bucket(packed[at] + np.uint64(size), buckets), np.searchsorted(at, bounds)


@dataclass
class Model:
    """Log odds by bucket, and those of a text without features."""

    odds: np.ndarray
    bias: float

    def score(self, part: T.Slice) -> np.ndarray:
        total, count = np.zeros(part.rows), np.zeros(part.rows)
        if len(part.data):
            for bucket, before in features(part.data, part.bounds, len(self.odds)):
                running = np.zeros(len(bucket) + 1)
                np.cumsum(self.odds[bucket], out=running[1:])
                total += np.diff(running[before])
                count += np.diff(before)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.bias + total / np.maximum(count, 1))))


def _counted(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text with their shares, as views of a few large arrays."""
    out = []
    for part in T.slices(pa.array(texts, pa.string())):
        if not len(part.data):
            out += [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * part.rows
            continue
        keys = np.concatenate([
            np.repeat(np.arange(part.rows), np.diff(before)) * buckets + bucket
            for bucket, before in features(part.data, part.bounds, buckets)
        ])
        keys, n = np.unique(keys, return_counts=True)
        row = keys // buckets
        share = (n / np.bincount(row, n, part.rows)[row]).astype(np.float32)
        bucket, ends = (keys % buckets).astype(np.int32), np.searchsorted(row, np.arange(part.rows + 1))
        out += [(bucket[x:y], share[x:y]) for x, y in zip(ends, ends[1:])]
    return out


def train(texts: list[str], labels: list[int], *, buckets: int = 1 << 18, size: int = 12, epochs: int = 6,
          rate: float = 4.0, seed: int = 7) -> Model:
    """Stochastic gradient descent on the softmax loss, one document a step, with a falling rate."""
    if (buckets & (buckets - 1)) or buckets < 2:
        raise ValueError("buckets must be a power of two")
    if len(set(labels)) < 2:
        return Model(np.zeros(buckets, np.float32), 40.0 * (2 * labels[0] - 1) if labels else 0.0)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    layer = np.zeros((2, size), np.float32)
    share = np.mean(labels)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    rows = _counted(texts, buckets)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            now = rate * (1 - step / steps)
            step += 1
            bucket, weight = rows[i]
            mean = weight @ vectors[bucket]
            z = layer @ mean + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = error @ layer
            layer -= now * np.outer(error, mean)
            bias -= 0.05 * now * error
            vectors[bucket] -= (now * weight)[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(documents: DataFrame, labels: DataFrame, *, text_column: str = "text", label_column: str = "label",
        key_column: str = "doc_id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, **settings) -> Model:
    """A model from at most `rows` labelled texts of at most `chars` characters, the first labels by a hash of the key.

    Texts behind the first `SAMPLE_BYTES` of them aren't learned from. The bounded list of labels is sent to the tasks;
    texts without a label in it aren't moved. One task trains, so the sample and what is made of it never lie in the
    driver, which gets one number per bucket.
    """
    picked = labels.where(F.col(label_column).isin(0, 1)).select(
        F.col(key_column).alias("key"), F.col(label_column).cast("int").alias("label"), F.xxhash64(key_column).alias("a")
    ).orderBy("a", "key", "label").limit(rows)
    sample = (
        documents.where(F.length(text_column) <= chars)
        .select(F.col(key_column).alias("key"), F.col(text_column).alias("text"))
        .join(F.broadcast(picked), "key")
        .orderBy("a", "key", "label", F.xxhash64("text")).limit(rows).select("text", "label")
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, known, size = [], [], 0
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                size += len(text.encode("utf-8", "replace"))
                if size <= SAMPLE_BYTES:
                    texts.append(text)
                    known.append(label)
        model = train(texts, known, **settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([model.odds.tobytes()], pa.binary()), pa.array([model.bias], pa.float64())], ["odds", "bias"])

    row = sample.coalesce(1).mapInArrow(learn, "odds binary, bias double").first()
    if row is None:
        return train([], [], **settings)
    return Model(np.frombuffer(row.odds, np.float32), row.bias)


def score(self, part: T.Slice) -> np.ndarray:
        total, count = np.zeros(part.rows), np.zeros(part.rows)
        if len(part.data):
            for bucket, before in features(part.data, part.bounds, len(self.odds)):
                running = np.zeros(len(bucket) + 1)
                np.cumsum(self.odds[bucket], out=running[1:])
                total += np.diff(running[before])
                count += np.diff(before)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-(self.bias + total / np.maximum(count, 1))))


def _counted(texts: list[str], buckets: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of each text with their shares, as views of a few large arrays."""
    out = []
    for part in T.slices(pa.array(texts, pa.string())):
        if not len(part.data):
            out += [(np.zeros(0, np.int32), np.zeros(0, np.float32))] * part.rows
            continue
        keys = np.concatenate([
            np.repeat(np.arange(part.rows), np.diff(before)) * buckets + bucket
            for bucket, before in features(part.data, part.bounds, buckets)
        ])
        keys, n = np.unique(keys, return_counts=True)
        row = keys // buckets
        share = (n / np.bincount(row, n, part.rows)[row]).astype(np.float32)
        bucket, ends = (keys % buckets).astype(np.int32), np.searchsorted(row, np.arange(part.rows + 1))
        out += [(bucket[x:y], share[x:y]) for x, y in zip(ends, ends[1:])]
    return out


def train(texts: list[str], labels: list[int], *, buckets: int = 1 << 18, size: int = 12, epochs: int = 6,
          rate: float = 4.0, seed: int = 7) -> Model:
    """Stochastic gradient descent on the softmax loss, one document a step, with a falling rate."""
    if (buckets & (buckets - 1)) or buckets < 2:
        raise ValueError("buckets must be a power of two")
    if len(set(labels)) < 2:
        return Model(np.zeros(buckets, np.float32), 40.0 * (2 * labels[0] - 1) if labels else 0.0)
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / size, 1 / size, (buckets, size)).astype(np.float32)
    layer = np.zeros((2, size), np.float32)
    share = np.mean(labels)
    bias = np.array([np.log(1 - share), np.log(share)], np.float32)
    rows = _counted(texts, buckets)
    steps, step = epochs * len(rows), 0
    for _ in range(epochs):
        for i in random.permutation(len(rows)):
            now = rate * (1 - step / steps)
            step += 1
            bucket, weight = rows[i]
            mean = weight @ vectors[bucket]
            z = layer @ mean + bias
            error = np.exp(z - z.max())
            error /= error.sum()
            error[labels[i]] -= 1
            back = error @ layer
            layer -= now * np.outer(error, mean)
            bias -= 0.05 * now * error
            vectors[bucket] -= (now * weight)[:, None] * back
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))


def fit(documents: DataFrame, labels: DataFrame, *, text_column: str = "text", label_column: str = "label",
        key_column: str = "doc_id", rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS, **settings) -> Model:
    """A model from at most `rows` labelled texts of at most `chars` characters, the first labels by a hash of the key.

    The bounded list of labels is sent to the tasks; texts without a label in it aren't moved.
    """
    picked = labels.where(F.col(label_column).isin(0, 1)).select(
        F.col(key_column).alias("key"), F.col(label_column).cast("int").alias("label"), F.xxhash64(key_column).alias("a")
    ).orderBy("a", "key", "label").limit(rows)
    sample = (
        documents.where(F.length(text_column) <= chars)
        .select(F.col(key_column).alias("key"), F.col(text_column).alias("text"))
        .join(F.broadcast(picked), "key")
        .orderBy("a", "key", "label", F.xxhash64("text")).limit(rows).collect()
    )
    return train([r.text for r in sample], [r.label for r in sample], **settings)


def score(documents: DataFrame, model: Model, *, text_column: str = "text", score_column: str = "score") -> DataFrame:
    """`documents` with the probability of label 1 for the whole of every text. The model has a fixed size.

    An existing column of the name of the score is replaced.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index(text_column)
    kept = [i for i, c in enumerate(documents.columns) if c != score_column]
    schema = documents.drop(score_column).schema.add(score_column, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            scores = [model.score(part) for part in T.slices(batch.column(at))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in kept] + [pa.array(np.concatenate(scores) if scores else [], pa.float64())],
                [batch.schema.names[i] for i in kept] + [score_column],
            )

    return documents.mapInArrow(run, schema)
