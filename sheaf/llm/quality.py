"""Quality classifier from supervised subword embeddings.

A document is the average of the vectors of its features: words, pairs of neighbouring words,
and character n-grams of the raw bytes, all hashed into one table. A softmax layer on the
average gives the class. Vectors and layer are learned together by stochastic gradient descent on
a bounded sample. After training only each feature's contribution to the log-odds is kept, so
scoring is one look-up a feature.

Cases: a null or empty text has no features and scores the sample's share of label 1; null
ids stay; every row gives one row, repeated ones too; an empty table gives none; without labelled
rows every score is 0.5; a score at the threshold is predicted 1. Further columns are not read.
Whole texts are scored in time linear in their length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.llm import grams, sampling
from sheaf.llm.arrays import Block, Rolling, blocks, mix, words

BITS = 18
GRAMS = (2, 4)
DIM = 8
EPOCHS = 8
# steps of the layer, and of the vectors, whose gradients are shares of a document's average
RATE = 0.1
VECTOR_RATE = 20.0
SAMPLE_PER_LABEL = 1000
THRESHOLD = 0.7
_WORDS = Rolling(11)


def features(block: Block) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature ids, offsets of each document in them) of every kind of feature. The kinds
    have a quarter of the table each."""
    for kind, width in enumerate(GRAMS):
        own, inside = grams.within(block.data, block.offsets, width, BITS - 2)
        yield own + (kind << BITS - 2), inside
    starts, ends, first = words(block)
    name = _WORDS.of_bytes(block.data, starts, ends)
    yield (name >> np.uint64(64 - BITS + 2)).astype(np.int32) + (2 << BITS - 2), first
    count = np.maximum(np.diff(first) - 1, 0)
    doc = np.repeat(np.arange(len(block)), np.diff(first))
    left = np.flatnonzero(doc[1:] == doc[:-1])
    pair = mix(name[left] * np.uint64(0x9E3779B97F4A7C15) + name[left + 1])
    yield (pair >> np.uint64(64 - BITS + 2)).astype(np.int32) + (3 << BITS - 2), np.concatenate([[0], np.cumsum(count)])


@dataclass
class Model:
    """Log-odds of each feature, and of no features at all."""

    odds: np.ndarray
    prior: float


def train(
    sample: pa.Table, dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, vector_rate: float = VECTOR_RATE, seed: int = 3
) -> Model:
    label = np.array(sample["label"].to_pylist())
    docs: list[tuple[np.ndarray, np.ndarray]] = []  # distinct features and their weights
    for block in blocks(sample.to_batches(), "doc_id", "text"):
        kinds = list(features(block))
        for i in range(len(block)):
            own, weight = [], []
            for ids, off in kinds:
                at, n = np.unique(ids[off[i]:off[i + 1]], return_counts=True)
                own.append(at)
                weight.append(n / max(n.sum(), 1) / len(kinds))
            docs.append((np.concatenate(own), np.concatenate(weight).astype(np.float32)))
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    layer = np.zeros((2, dim), np.float32)
    share = float(np.clip(label.mean(), 0.01, 0.99))
    bias = np.log(np.array([1 - share, share], np.float32))
    balance = np.array([0.5 / (1 - share), 0.5 / share])
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, weight = docs[i]
            hidden = weight @ table[at]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label[i]] -= 1
            p *= balance[label[i]] * (1 - done / steps)
            done += 1
            back = p @ layer
            layer -= rate * np.outer(p, hidden)
            table[at] -= vector_rate * np.outer(weight, back)
    odds = table @ (layer[1] - layer[0])
    return Model(odds.astype(np.float32), float(bias[1] - bias[0]))


def fit(docs: DataFrame, labels: DataFrame, usable: Column, per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """A model from at most ``per_label`` documents of either label (whole texts), of the
    ``usable`` rows of ``docs`` that ``labels`` (doc_id, label 0 or 1) covers. Rows with
    different labels for one document do not count."""
    own = (
        labels.filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_other"))
        .filter(F.col("label") == F.col("_other")).drop("_other")
    )
    own = own.filter(usable)
    chosen = sampling.per_label(own, "label", "doc_id", per_label)
    # the chosen rows are 2 * per_label at most
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return sampling.fit(rows.select("doc_id", "text", F.col("label").cast("int")), train)


def _scores(model: Model | None, block: Block) -> np.ndarray:
    if model is None:
        return np.full(len(block), 0.5)
    total, kinds = np.zeros(len(block)), 0
    for ids, off in features(block):
        total += grams.per_document(model.odds[ids], off) / np.maximum(np.diff(off), 1)
        kinds += 1
    return 1 / (1 + np.exp(-np.clip(total / kinds + model.prior, -500, 500)))


def score(docs: DataFrame, model: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` (doc_id, text) as doc_id, score and predicted (1 from ``threshold`` on)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "doc_id", "text"):
            yield pa.record_batch({"doc_id": block.key, "score": _scores(shared.value, block)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = rows.mapInArrow(task, "doc_id long, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
