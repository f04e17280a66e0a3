"""Quality classifier: a support vector machine on naive Bayes features.

Features are indicators of hashed one- and two-token n-grams (tokens are words cut at punctuation). Over all labelled
documents that may be learned from, the log ratio of a feature's smoothed frequencies in the two classes is
counted; it scales the feature's indicator, and a document's vector is scaled to length one. A linear hinge-loss model
is fitted by dual coordinate descent in numpy, and a logistic curve turns its margins into scores.

The ratios are counted over all learnable rows. The linear model is fitted on a sample of them whose bound is the
parameter `sample` (drawn by a hash of the id, four fifths for the model and one for the curve), in one task. What
comes to the driver is a row per feature bucket, whatever the input.

Defined results: null text is empty and gets the score of a document without features; repeated rows each get a
row; a null id is not held out and never learned from; with one class or none among the labels every score is the
smoothed share of class 1 (0.5 without labels); of several labels of one id the largest holds; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .lookup import labelled
from .tables import stored

BUCKETS, SAMPLE, SMOOTHING, COST, EPOCHS, CUT = 1 << 18, 8000, 1.0, 1.0, 12, 0.3


def features(block: W.Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of each distinct n-gram bucket, in the order of both."""
    spans = W.tokens(block)
    hashed = W.hashes(W.prefix(block), spans.start, spans.end)
    first, pairs = W.windows(spans.doc, hashed, 2)
    mask = np.uint64(buckets - 1)
    both = np.unique(np.concatenate([spans.doc * buckets + (hashed & mask).astype(np.int64),
                                     spans.doc[first] * buckets + (pairs & mask).astype(np.int64)]))
    return both // buckets, both % buckets


def class_ratios(train: DataFrame, buckets: int, smoothing: float) -> tuple[np.ndarray, int, int]:
    """Log ratio of each feature's share among the documents of class 1 and of class 0, and their numbers."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, buckets + 1), np.int64)
        for batch, block in W.blocks(batches):
            label = (batch.column(1).to_numpy() == 1).astype(np.int64)
            doc, bucket = features(block, buckets)
            for c in (0, 1):
                n[c] += np.bincount(bucket[label[doc] == c], minlength=buckets + 1)
                n[c, buckets] += (label == c).sum()
        some = np.flatnonzero(n.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[0, some]), pa.array(n[1, some])], ["bucket", "n0", "n1"])

    got = (train.select("text", F.col("quality").cast("long").alias("quality")).mapInArrow(count, "bucket long, n0 long, n1 long")
           .groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toPandas())
    n = np.zeros((2, buckets + 1))
    n[0, got["bucket"]], n[1, got["bucket"]] = got["n0"], got["n1"]
    share = n[:, :-1] + smoothing
    return np.log(share[1] / share[1].sum()) - np.log(share[0] / share[0].sum()), int(n[0, -1]), int(n[1, -1])


def vectors(doc: np.ndarray, bucket: np.ndarray, n: int, ratio: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scaled values of the given indicators, and where each document's begin."""
    value = ratio[bucket]
    norm = np.sqrt(np.bincount(doc, value * value, n))
    return value / np.maximum(norm, 1e-12)[doc], np.searchsorted(doc, np.arange(n + 1))


def hinge_descent(bucket: np.ndarray, value: np.ndarray, edges: np.ndarray, sign: np.ndarray, buckets: int, cost: float, epochs: int) -> np.ndarray:
    """Weights (the last is the bias) of a linear model with squared norm and hinge loss, by dual coordinate descent."""
    w, alpha = np.zeros(buckets + 1), np.zeros(len(sign))
    weight = np.where(sign > 0, cost, cost * max(1.0, (sign > 0).sum() / max(1, (sign < 0).sum())))
    order = np.random.default_rng(1)
    square = np.array([value[a:b] @ value[a:b] + 1 for a, b in zip(edges[:-1], edges[1:], strict=True)])
    for _ in range(epochs):
        for i in order.permutation(len(sign)):
            a, b = edges[i], edges[i + 1]
            own = bucket[a:b]
            gradient = sign[i] * (w[own] @ value[a:b] + w[-1]) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), weight[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * sign[i]
                w[own] += step * value[a:b]
                w[-1] += step
                alpha[i] = new
    return w


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the curve from margins to the share of class 1, by Newton steps on smoothed targets."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum()])
        q = p * (1 - p)
        h = np.array([[(q * margin * margin).sum() + 1e-3, (q * margin).sum()], [(q * margin).sum(), q.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -5, 5), b - np.clip(step[1], -5, 5)
    return float(a), float(b)


def fit(train: DataFrame, ratio: np.ndarray, share: float, sample: int, cost: float, epochs: int) -> np.ndarray:
    """Weights, bias, slope and offset, fitted in one task on about `sample` rows."""
    buckets = len(ratio)
    shared = train.sparkSession.sparkContext.broadcast(ratio)
    place = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 40))
    some = train.where(place < int(share * (1 << 40))).orderBy(place, "doc_id").limit(2 * sample)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, places, labels, n = [], [], [], 0
        for batch, block in W.blocks(batches):
            doc, bucket = features(block, buckets)
            docs.append(doc + n)
            places.append(bucket)
            labels.append(batch.column(1).to_numpy())
            n += block.n
        if n:
            doc, bucket, label = np.concatenate(docs), np.concatenate(places), np.concatenate(labels)
            value, edges = vectors(doc, bucket, n, shared.value)
            to = max(1, n * 4 // 5)
            w = hinge_descent(bucket, value, edges[:to + 1], np.where(label[:to] == 1, 1.0, -1.0), buckets, cost, epochs)
            margin = np.bincount(doc, w[bucket] * value, n) + w[-1]
            curve = logistic(margin[to:], label[to:]) if 0 < label[to:].sum() < n - to else (4.0, 0.0)
            yield pa.RecordBatch.from_arrays([pa.array([np.append(w, curve).astype("<f8").tobytes()], pa.binary())], ["model"])

    got = some.select("text", F.col("quality").cast("long").alias("quality")).coalesce(1).mapInArrow(learn, "model binary").collect()
    return np.frombuffer(got[0]["model"], "<f8") if got else np.zeros(buckets + 3)


def score(documents: DataFrame, keep: list[str], ratio: np.ndarray, model: np.ndarray, cut: float = CUT) -> DataFrame:
    """The columns `keep`, score and predicted of every document."""
    buckets = len(ratio)
    shared = documents.sparkSession.sparkContext.broadcast((ratio, model))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio, model = shared.value
        for batch, block in W.blocks(batches, "__text"):
            doc, bucket = features(block, buckets)
            value, _ = vectors(doc, bucket, block.n, ratio)
            margin = np.bincount(doc, model[bucket] * value, block.n) + model[buckets]
            out = 1 / (1 + np.exp(-np.clip(model[-2] * margin + model[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(out), pa.array((out >= cut).astype(np.int32))],
                                             [*keep, "score", "predicted"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema])
    return documents.select(*keep, F.col("text").alias("__text")).mapInArrow(rate, f"{schema}, score double, predicted int")


def classify(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS, sample: int = SAMPLE, smoothing: float = SMOOTHING,
             cost: float = COST, epochs: int = EPOCHS) -> DataFrame:
    """doc_id, held_out, score and predicted; learned from labels of ids whose crc32 mod 5 is not 0."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    train = stored(labelled(documents, labels.where(fold != 0), "quality"), "labelled")
    ratio, n0, n1 = class_ratios(train, buckets, smoothing)
    if n0 and n1:
        model = fit(train, ratio, sample / (n0 + n1), sample, cost, epochs)
    else:
        model = np.append(np.zeros(buckets + 2), np.log((n1 + 1) / (n0 + 1)))
    marked = documents.select("doc_id", "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    return score(marked, ["doc_id", "held_out"], ratio.astype(np.float32), model)
