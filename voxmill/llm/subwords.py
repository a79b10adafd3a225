"""Quality classifier on supervised subword embeddings (operator 5).

A text's features are its words (maximal runs without white space, lower-cased) and the runs of 3 to 5 characters of each word with a
mark at either end, and its pairs of adjacent words; a word that repeats the one before it also counts as one feature that all repeats
share, so that repetition shows in words never seen. All are hashed into BUCKETS vectors. The text is the mean of its features' vectors; a softmax layer gives the
class. Vectors and layer are learned together by mini-batch stochastic gradient descent in numpy on a bounded sample of labelled
rows. As the output is linear before the softmax, a feature's part in it is one number: scoring ships one vector of BUCKETS numbers
and sums it over every feature of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import textvec as tv
from voxmill.llm.common import fold, label_sample, small_batches, spread, table, texts_of

BITS = 16
BUCKETS = 1 << BITS
#: Bucket of repeated words.
REPEAT = 0
GRAMS = (3, 4, 5)
DIMENSION = 12
EPOCHS = 5
#: Steps of small samples, which take more epochs for them, at least.
STEPS = 400
BATCH = 64
RATE = 0.5
#: Labelled rows that the model is fitted on, at most.
TRAIN_ROWS = 4_000


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each feature and the index of its text, in no order."""
    points, starts = tv.code_points([f" {t.lower()}" for t in texts])
    inside = ~tv.is_space_point(points)
    points = np.where(inside, points, 0x20)  # all white space marks a word's end alike
    first, end, doc = tv.word_spans(points, starts, inside)
    hashed = tv.Hasher(points)
    shift = np.uint64(64 - BITS)
    words = hashed(first, end)
    ids, docs = [words >> shift], [doc]
    if len(words) > 1:
        inner = np.flatnonzero(doc[1:] == doc[:-1])
        before, after = words[inner], words[inner + 1]
        same = before == after
        ids += [tv.mix(before * np.uint64(3) + after) >> shift, np.full(int(same.sum()), REPEAT, dtype=np.uint64)]
        docs += [doc[inner], doc[inner][same]]
    # a run may begin with the space before a word and end with the one after it, but holds none between
    gap = np.concatenate(([0], np.cumsum(~inside)))
    owner = np.repeat(np.arange(len(texts)), np.diff(starts))
    for n in GRAMS:
        at = np.arange(max(len(points) - n + 1, 0))
        at = at[gap[at + n - 1] == gap[at + 1]]  # no space within
        ids.append(hashed(at, at + n) >> shift)
        docs.append(owner[at])
    return np.concatenate(ids).astype(np.int64), np.concatenate(docs)


@dataclass
class Model:
    """logit = mean of weight over features + bias: of label 1 against label 0."""

    weight: np.ndarray
    bias: float

    def scores(self, texts: list[str]) -> np.ndarray:
        ids, doc = features(texts)
        total = np.bincount(doc, weights=self.weight[ids], minlength=len(texts))
        n = np.bincount(doc, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(n, 1) + self.bias, -50, 50)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, seed: int = 5) -> Model:
    """Fit on bags (distinct buckets, counts) with labels 0 and 1. With one class alone every score is that class's share, smoothed."""
    n = len(bags)
    positive = float(labels.sum())
    prior = np.log((positive + 1) / (n - positive + 1))
    if not 0 < positive < n:
        return Model(np.zeros(BUCKETS, dtype=np.float32), float(prior))
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    layer, bias = np.zeros((DIMENSION, 2), dtype=np.float32), np.array([0.0, prior], dtype=np.float32)
    share = [(c / max(c.sum(), 1)).astype(np.float32) for _, c in bags]
    epochs = max(EPOCHS, -(-STEPS * BATCH // n))
    steps, step = epochs * -(-n // BATCH), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for a in range(0, n, BATCH):
            rows = order[a : a + BATCH]
            ids = np.concatenate([bags[i][0] for i in rows])
            weight = np.concatenate([share[i] for i in rows])
            size = np.array([len(bags[i][0]) for i in rows])
            owner = np.repeat(np.arange(len(rows)), size)
            parts = vectors[ids] * weight[:, None]
            mean = np.zeros((len(rows), DIMENSION), dtype=np.float32)
            some = size > 0
            edges = np.cumsum(size) - size
            if some.any():
                mean[some] = np.add.reduceat(parts, edges[some], axis=0)
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(rows)), labels[rows]] -= 1
            rate = RATE * (1 - step / steps)
            step += 1
            back = p @ layer.T
            layer -= rate * (mean.T @ p) / len(rows) * 4
            bias -= rate * p.mean(axis=0) * 0.1
            # each bucket's gradient, summed over the texts that hold it
            grad = back[owner] * weight[:, None]
            order_ids = np.argsort(ids, kind="stable")
            sorted_ids = ids[order_ids]
            new = np.flatnonzero(np.concatenate(([True], sorted_ids[1:] != sorted_ids[:-1]))) if len(ids) else order_ids
            if len(new):
                vectors[sorted_ids[new]] -= rate * np.add.reduceat(grad[order_ids], new, axis=0) * 4
    weight = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(weight.astype(np.float32), float(bias[1] - bias[0]))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches, "text"):
        ids, doc = features(texts_of(batch))
        key, n = np.unique(doc << BITS | ids, return_counts=True)
        edges = np.searchsorted(key, np.arange(batch.num_rows + 1) << BITS)
        own = [key[a:b] & (BUCKETS - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        yield pa.RecordBatch.from_pydict({"label": pa.array(batch.column("label").to_pylist(), pa.int32()), "ids": pa.array([x.astype(np.uint16).tobytes() for x in own], pa.binary()), "counts": pa.array([n[a:b].astype(np.float32).tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from at most TRAIN_ROWS labelled documents outside the held-out fold; a repeated id trains with each of its texts."""
    chosen = label_sample(labels, "quality", fold("doc_id", 5) != 0, TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label")
    # order the bags, so that the same rows give the same model whatever the partitions
    got = rows.mapInArrow(_bags, "label int, ids binary, counts binary").toArrow()
    found = sorted(zip(got["ids"].to_pylist(), got["counts"].to_pylist(), got["label"].to_pylist(), strict=True))
    bags = [(np.frombuffer(i, dtype=np.uint16).astype(np.int32), np.frombuffer(c, dtype=np.float32)) for i, c, _ in found]
    return train(bags, np.array([int(x > 0) for _, _, x in found], dtype=np.int64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of each row of docs (doc_id, text); null and empty texts have no features and get the bias alone."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # 256 KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": shipped.value.scores(texts_of(batch))})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    out = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return out.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"))


QUERIES = {"op5_quality": op5}
