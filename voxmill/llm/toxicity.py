"""Toxicity by maximum-scoring segments (operator 6).

Tokens are lower-cased runs of letters and digits. Each gets a log-odds score from labelled counts under a
two-level Dirichlet prior: the class shares of a word shrink to those of its first characters, and those shrink to
the shares of all tokens. Counts live in hashed tables of a fixed size, so the model that is shipped to the executors has a
proven bound; a document counts once for each of its buckets, so that repeats in one text don't make a word toxic. A linear scan (Ruzzo and Tompa's) finds every maximal scoring segment of a text; Karlin and Altschul's
extreme-value statistics turn the scores into probabilities of chance, their sum statistics join the segments of a text, and
a one-variable logistic curve over a floor, fitted with each training text's own counts left out, turns that into a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import textvec as tv
from voxmill.llm.common import cut, fold, label_sample, small_batches, spread, table, texts_of

BITS = 20
PREFIX = 5
WORD_WEIGHT = 3.0
PREFIX_WEIGHT = 6.0
DRIFT = 2.0
TOP = 8.0
#: Labelled rows that a model is fitted on, at most.
TRAIN_ROWS = 60_000
#: Widths of the bins of token scores and of evidence.
BIN, FINE = 0.25, 0.05
#: Evidence of a text without any segment.
NONE = -4.0


def tokens(texts: list[str]):
    """Bucket of each token's word and of its first characters, the token's text index, and its span in that text."""
    points, starts = tv.code_points([t.lower() for t in texts])
    first, end, doc = tv.word_spans(points, starts, tv.is_word_point(points))
    hashed = tv.Hasher(points)
    shift = np.uint64(64 - BITS)
    word = (hashed(first, end) >> shift).astype(np.int64)
    stem = (hashed(first, np.minimum(end, first + PREFIX)) >> shift).astype(np.int64)
    return word, stem, doc, first - starts[doc], end - starts[doc]


def shares(y1, y0, p1, p0, rate):
    """Posterior log-odds of the toxic class for words with counts (y1, y0) and prefixes with (p1, p0), against the base rate."""
    stem = (p1 + PREFIX_WEIGHT * rate) / (p1 + p0 + PREFIX_WEIGHT)
    word = (y1 + WORD_WEIGHT * stem) / (y1 + y0 + WORD_WEIGHT)
    return np.log(word / (1 - word)) - np.log(rate / (1 - rate))


def segments(scores: np.ndarray) -> list[tuple[float, int, int]]:
    """All maximal scoring segments of a sequence as (score, first, end), by Ruzzo and Tompa's scan in linear time.

    Runs of non-positive scores between two positive ones only move the running sum, so the scan visits positive scores alone.
    """
    hot = np.flatnonzero(scores > 0)
    if not len(hot):
        return []
    total = np.concatenate(([0.0], np.cumsum(scores)))
    found: list[list] = []  # first, end, sum left of it, sum at its end
    for i in hot.tolist():
        item = [i, i + 1, float(total[i]), float(total[i + 1])]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j -= 1
            if j < 0 or found[j][3] >= item[3]:
                found.append(item)
                break
            item = [found[j][0], item[1], found[j][2], item[3]]
            del found[j:]
    return [(x[3] - x[2], x[0], x[1]) for x in found]


@dataclass
class Model:
    """score: of each word bucket given its prefix bucket's; all arrays have a fixed size."""

    y1: np.ndarray
    y0: np.ndarray
    p1: np.ndarray
    p0: np.ndarray
    rate: float
    lam: float = 1.0
    k: float = 0.1
    slope: float = 1.0
    offset: float = 0.0
    floor: float = 0.0

    def odds(self, word, stem, toxic=None) -> np.ndarray:
        y1, y0, p1, p0 = self.y1[word], self.y0[word], self.p1[stem], self.p0[stem]
        if toxic is not None:  # leave the text's own counts out
            if toxic:
                y1, p1 = y1 - 1, p1 - 1
            else:
                y0, p0 = y0 - 1, p0 - 1
        return np.minimum(shares(y1, y0, p1, p0, self.rate), TOP) - DRIFT

    def evidence(self, found: list, n: int) -> tuple[float, int]:
        """Surprise of the segments that chance makes less than once in n tokens, and their number.

        With T the sum of the r best normalised scores, chance reaches T with probability e^-T T^(r-1) / (r! (r-1)!). The result is
        log(1 + x) with x the negative logarithm of the least of these; without such segments -log(1 - the best score), NONE at least.
        """
        if not found:
            return NONE, 0
        normal = self.lam * np.sort([s for s, _, _ in found])[::-1] - np.log(self.k * max(n, 1))
        best = normal[normal > 0]
        if not len(best):
            return float(max(NONE, -np.log1p(-normal[0]))), 0
        r = np.arange(1, len(best) + 1)
        total = np.cumsum(best)
        log_factorial = np.cumsum(np.log(r))
        x = total - (r - 1) * np.log(total) + log_factorial + log_factorial - np.log(r)
        return float(np.log1p(max(x.max(), 0.0))), len(best)

    def score(self, x):
        return self.floor + (1 - self.floor) / (1 + np.exp(-np.clip(self.slope * x + self.offset, -50, 50)))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    size = 1 << BITS
    sums = np.zeros((2, 2, size), dtype=np.int64)  # word or prefix; label
    for batch in small_batches(batches, "text"):
        word, stem, doc, _, _ = tokens(texts_of(batch))
        labels = np.asarray(batch.column("label").to_pylist(), dtype=np.int64) > 0
        for kind, ids in enumerate((word, stem)):
            once = np.unique(doc << BITS | ids)
            for label in (0, 1):
                sums[kind, label] += np.bincount(once[labels[once >> BITS] == bool(label)] & (size - 1), minlength=size)
    for kind in (0, 1):
        rows = np.flatnonzero(sums[kind].sum(axis=0))
        yield pa.RecordBatch.from_pydict({"kind": pa.array([kind] * len(rows), pa.int32()), "bucket": rows, "n0": sums[kind, 0, rows], "n1": sums[kind, 1, rows]})


def _calibration(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Binned counts over training texts: scores of tokens and of segments in clean ones, and the evidence of each."""
        out: dict[tuple[str, int, int], int] = {}

        def add(kind, b, label, n=1):
            out[kind, b, label] = out.get((kind, b, label), 0) + n

        for batch in small_batches(batches, "text"):
            word, stem, doc, _, _ = tokens(texts_of(batch))
            edges = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            for i, label in enumerate(batch.column("label").to_pylist()):
                a, b = edges[i], edges[i + 1]
                if a == b:
                    add("x", round(NONE / FINE), int(label > 0))
                    continue
                w, s = word[a:b], stem[a:b]
                odds = model.odds(w, s, label > 0)
                found = segments(odds)
                if label <= 0:
                    bins, n = np.unique(np.floor(odds / BIN).astype(np.int64), return_counts=True)
                    for q, c in zip(bins.tolist(), n.tolist(), strict=True):
                        add("token", q, 0, c)
                    for x, _, _ in found:
                        add("segment", int(x // BIN), 0)
                add("x", int(round(model.evidence(found, b - a)[0] / FINE)), int(label > 0))
        keys = sorted(out)
        yield pa.RecordBatch.from_pydict({"kind": [k for k, _, _ in keys], "bin": pa.array([b for _, b, _ in keys], pa.int64()), "label": pa.array([c for _, _, c in keys], pa.int64()), "n": pa.array([out[k] for k in keys], pa.int64())})

    return run


def _histogram(train: DataFrame, model: Model) -> dict:
    rows = (
        train.mapInArrow(_calibration(model), "kind string, bin long, label long, n long")
        .groupBy("kind", "bin", "label").agg(F.sum("n").alias("n")).collect()
    )
    return {(r["kind"], r["bin"], r["label"]): r["n"] for r in rows}


def karlin_lambda(values: np.ndarray, p: np.ndarray) -> float:
    """The positive root of sum p exp(lambda s) = 1; 1 if the scores have none."""
    if not len(values) or (p * values).sum() >= 0 or values.max() <= 0:
        return 1.0
    low, high = 1e-6, 1e-3
    while (p * np.exp(np.minimum(high * values, 700))).sum() < 1 and high < 50:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (p * np.exp(np.minimum(mid * values, 700))).sum() < 1 else (low, mid)
    return high


def logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, floor: float = 0.0) -> tuple[float, float]:
    """Weighted fit of floor + (1 - floor) / (1 + exp(-(a x + b))), by Fisher scoring with Platt's softened targets and a small ridge.

    floor is the share of label 1 where there is no evidence: labels that no word bears out would flatten the curve otherwise.
    """
    if not n[y == 1].sum() or not n[y == 0].sum():
        return 1.0, 0.0
    pos, neg = n[y == 1].sum(), n[y == 0].sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    centre, spread = (x * n).sum() / n.sum(), max(1e-9, np.sqrt((n * (x - (x * n).sum() / n.sum()) ** 2).sum() / n.sum()))
    z, w = (x - centre) / spread, np.zeros(2)
    f = np.stack([z, np.ones_like(z)])
    for _ in range(200):
        s = 1 / (1 + np.exp(-np.clip(w @ f, -40, 40)))
        p, slope = floor + (1 - floor) * s, (1 - floor) * s * (1 - s)
        var = np.maximum(p * (1 - p), 1e-12)
        grad = f @ (n * (target - p) * slope / var) - 1e-3 * w
        hess = (f * (n * slope**2 / var)) @ f.T + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w += step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return max(w[0], 0.0) / spread, w[1] - max(w[0], 0.0) * centre / spread


def fit(train: DataFrame) -> Model:
    """Fit on (text, label) rows; without both classes the model scores every text by the base rate of one half at most."""
    size = 1 << BITS
    arrays = np.zeros((2, 2, size))
    rows = train.mapInArrow(_counts, "kind int, bucket long, n0 long, n1 long").groupBy("kind", "bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    pdf = rows.toArrow()  # at most two rows a bucket
    kind, bucket = pdf["kind"].to_numpy(), pdf["bucket"].to_numpy()
    for c in (0, 1):
        arrays[kind, c, bucket] = pdf[f"n{c}"].to_numpy()
    (y0, y1), (p0, p1) = arrays
    rate = float((y1.sum() + 1) / (y1.sum() + y0.sum() + 2))
    model = Model(*(x.astype(np.float32) for x in (y1, y0, p1, p0)), rate)
    first = _histogram(train, model)
    bins = sorted((b, n) for (kind, b, _), n in first.items() if kind == "token")
    values, weight = (np.array([b for b, _ in bins]) + 0.5) * BIN, np.array([n for _, n in bins], dtype=float)
    if len(bins):
        model.lam = min(karlin_lambda(values, weight / weight.sum()), 5.0)
        cuts = sorted(((b * BIN, n) for (kind, b, _), n in first.items() if kind == "segment"), reverse=True)
        seen, tail = 0, []
        for s, n in cuts:
            seen += n
            tail.append((s, seen))
        # the level that a hundredth of the chance segments reach
        at = next(((s, c) for s, c in tail if c >= max(1, 0.01 * seen)), (0.0, 1))
        model.k = float(np.clip(at[1] / (weight.sum() * np.exp(-model.lam * at[0])), 1e-6, 10.0))
    second = sorted((b, c, n) for (kind, b, c), n in _histogram(train, model).items() if kind == "x")
    if second:
        x, y, n = (np.array(v, dtype=float) for v in zip(*second, strict=True))
        bare = x <= round(NONE / FINE)
        model.floor = float(n[bare & (y == 1)].sum() / (n[bare].sum() + 1))
        model.slope, model.offset = logistic(x * FINE, y, n, model.floor)
    return model


def evidences(model: Model, texts: list[str]):
    """Of each text: its score, its number of significant passages, and the best one's span in code points (or a pair of nulls)."""
    word, stem, doc, first, end = tokens(texts)
    odds = model.odds(word, stem)
    edges = np.searchsorted(doc, np.arange(len(texts) + 1))
    x, n, at = [], [], []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        found = segments(odds[a:b])
        e, r = model.evidence(found, b - a)
        x.append(e)
        n.append(r)
        best = max(found, default=None)
        at.append((first[a + best[1]], end[a + best[2] - 1]) if best and r else (None, None))
    return model.score(np.array(x)), n, at


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id of every row, its score, the number of significant passages and the best one's span (code points).

    A null or empty text has no passage and gets the score of no evidence; repeated rows are scored each.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # four arrays of 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            scores, n, at = evidences(shipped.value, texts_of(batch))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "score": scores, "n_segments": pa.array(n, pa.int64()), "best_start": pa.array([p for p, _ in at], pa.int64()), "best_end": pa.array([q for _, q in at], pa.int64())})

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, n_segments long, best_start long, best_end long")


def train_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of at most TRAIN_ROWS labelled documents outside the held-out fold, written down for the passes of a fit."""
    chosen = label_sample(labels, "toxic", fold("doc_id", 3) != 1, TRAIN_ROWS)
    return cut(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "label"))


def without_toxic(docs: DataFrame, labels: DataFrame, at_least: float = 0.7) -> DataFrame:
    """docs without the rows whose score reaches at_least, with all columns; the model is fitted on docs and labels first."""
    shipped = docs.sparkSession.sparkContext.broadcast(fit(train_rows(docs, labels)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield batch.filter(pa.array(evidences(shipped.value, texts_of(batch))[0] < at_least))

    return docs.mapInArrow(run, docs.schema)


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"))
    model = fit(train_rows(docs, table(spark, sf_dir, "labels")))
    out = score(docs, model)
    return out.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"), "n_segments", "best_start", "best_end")


QUERIES = {"op6_toxicity": op6}
