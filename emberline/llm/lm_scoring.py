"""LM scoring by masked pseudo-likelihood.

Every word is predicted from the four words on either side of it by a small network: hashed word embeddings,
averaged on each side, a tanh layer, and a softmax over word classes. The most frequent word buckets are classes of
their own, the others share classes by hash; within a class a word has its share of the corpus's counts. A
document's score is the sum over its words of log p(word | both sides), and the same per word.

Counts of word buckets come from all words of all documents. Training goes in rounds: every task starts from the
same weights, masks every `stride`-th word of its own texts (another offset in each round) and takes Adagrad steps
in numpy; the tasks' weights are then averaged, weighted by the words they masked. There are as many rounds as offsets,
so every word of every text is masked once. So what training gathers grows
with the input, one row per weight and task before the partial sums, and what reaches the driver is one row per
weight. Texts are read whole where they lie. A task that is run again starts from the same weights and reads
the same rows.

Defined results: null or blank texts have 0 words, log_prob 0 and mean_log_prob 0; repeated rows each get a row; a
corpus without words leaves the weights as they were drawn; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

BUCKETS, EMBEDDED, WIDTH, HIDDEN, CLASSES, OWN_CLASSES = 1 << 16, 1 << 13, 16, 32, 128, 64
SIDE, STRIDE, ROUNDS, STEP, BATCH = 4, 2, 2, 0.1, 2048

_SHAPES = {"embedding": (EMBEDDED + 1, WIDTH), "w1": (2 * WIDTH, HIDDEN), "b1": (HIDDEN,), "w2": (HIDDEN, CLASSES), "b2": (CLASSES,)}


def word_buckets(block: W.Block) -> tuple[W.Spans, np.ndarray]:
    low = W.lowered(block)
    spans = W.words(low)
    return spans, (W.hashes(W.prefix(low), spans.start, spans.end) & W.U(BUCKETS - 1)).astype(np.int64)


def count_words(documents: DataFrame) -> np.ndarray:
    """How often each word bucket occurs in all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(BUCKETS, np.int64)
        for _, block in W.blocks(batches):
            n += np.bincount(word_buckets(block)[1], minlength=BUCKETS)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["bucket", "n"])

    got = documents.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    n = np.zeros(BUCKETS)
    n[got["bucket"]] = got["n"]
    return n


def classes(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class of each bucket and the log-probability of the bucket within it."""
    of = OWN_CLASSES + np.arange(BUCKETS) % (CLASSES - OWN_CLASSES)
    top = np.argsort(-counts, kind="stable")[:OWN_CLASSES]
    of[top] = np.arange(OWN_CLASSES)
    smooth = counts + 1
    return of, (np.log(smooth) - np.log(np.bincount(of, smooth, CLASSES))[of]).astype(np.float32)


def drawn(counts: np.ndarray, of: np.ndarray) -> dict[str, np.ndarray]:
    """The weights before training; the offsets of the classes are their frequencies."""
    random = np.random.default_rng(7)
    weights = {k: (random.standard_normal(s) * 0.1).astype(np.float32) for k, s in _SHAPES.items()}
    weights["embedding"][-1] = 0
    weights["b1"][:] = 0
    share = np.bincount(of, counts + 1, CLASSES)
    weights["b2"] = np.log(share / share.sum()).astype(np.float32)
    return weights


def padded(doc: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding rows of the words with empty words between texts, and where each word stands there."""
    at = np.arange(len(doc)) + SIDE * (doc + 1)
    rows = np.full(int(at[-1]) + 1 + SIDE if len(at) else SIDE, EMBEDDED, np.int64)
    rows[at] = bucket % EMBEDDED
    return rows, at


def hidden(weights: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and outputs less the largest, at the given places in ascending order."""
    low, high = int(at[0]) - SIDE, int(at[-1]) + SIDE + 1
    e = weights["embedding"][rows[low:high]]
    n, place = len(e), at - low
    # Sums of the words beside every place, by slices, then those of the given places.
    left, right = e[SIDE - 1:n - 1].copy(), e[1:n - SIDE + 1].copy()
    for j in range(2, SIDE + 1):
        left += e[SIDE - j:n - j]
        right += e[j:n - SIDE + j]
    x = np.concatenate([left[place - SIDE], right[place]], 1)
    x /= SIDE
    h = x @ weights["w1"]
    h += weights["b1"]
    np.tanh(h, out=h)
    z = h @ weights["w2"]
    z += weights["b2"]
    z -= z.max(1, keepdims=True)
    return x, h, z


def forward(weights: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Inputs, hidden values and log-probabilities of the classes at the given places."""
    x, h, z = hidden(weights, rows, at)
    z -= np.log(np.exp(z).sum(1, keepdims=True))
    return x, h, z


def log_likelihood(weights: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log-probability of the given class at each place."""
    _, _, z = hidden(weights, rows, at)
    own = z[np.arange(len(at)), target]
    np.exp(z, out=z)
    return own - np.log(z.sum(1))


def step(weights: dict[str, np.ndarray], squares: dict[str, np.ndarray], rows: np.ndarray, at: np.ndarray, target: np.ndarray, rate: float) -> None:
    """One Adagrad step on the mean log-loss of the words at the given places, which ascend."""
    x, h, z = forward(weights, rows, at)
    d = np.exp(z, out=z)
    d[np.arange(len(at)), target] -= 1
    d /= len(at)
    back = (d @ weights["w2"].T) * (1 - h * h)
    inner = back @ weights["w1"].T / SIDE
    gradient = {"w2": h.T @ d, "b2": d.sum(0), "w1": x.T @ back, "b1": back.sum(0)}
    # By place in the text first, by slices, then once by embedding row; rows that don't occur stay as they are.
    low = int(at[0]) - SIDE
    n = int(at[-1]) + SIDE + 1 - low
    by_place = np.zeros((n, WIDTH), np.float32)
    for side, sign in ((0, -1), (1, 1)):
        own = np.zeros((n - 2 * SIDE, WIDTH), np.float32)
        own[at - (low + SIDE)] = inner[:, side * WIDTH:(side + 1) * WIDTH]
        for j in range(1, SIDE + 1):
            by_place[SIDE + sign * j:n - SIDE + sign * j] += own
    near = rows[low:low + n]
    used = np.flatnonzero(np.bincount(near, minlength=EMBEDDED + 1))
    number = np.empty(EMBEDDED + 1, np.int64)
    number[used] = np.arange(len(used))
    cell = (number[near] * WIDTH)[:, None] + np.arange(WIDTH)
    g = np.bincount(cell.ravel(), by_place.ravel(), len(used) * WIDTH).reshape(-1, WIDTH).astype(weights["embedding"].dtype)
    g[used == EMBEDDED] = 0
    total = squares["embedding"][used] + g * g
    squares["embedding"][used] = total
    weights["embedding"][used] -= (rate * g / np.sqrt(total + 1e-8)).astype(np.float32)
    for k, g in gradient.items():
        squares[k] += g * g
        weights[k] -= (rate * g / np.sqrt(squares[k] + 1e-8)).astype(np.float32)


def train_round(documents: DataFrame, weights: dict[str, np.ndarray], of: np.ndarray, offset: int, stride: int, rate: float) -> dict[str, np.ndarray]:
    """The weights after one pass: each task's own, averaged by the words it masked."""
    shared = documents.sparkSession.sparkContext.broadcast((weights, of))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start, of = shared.value
        own = {k: v.copy() for k, v in start.items()}
        squares = {k: np.zeros(v.shape, np.float32) for k, v in own.items()}
        n = 0
        for _, block in W.blocks(batches):
            spans, bucket = word_buckets(block)
            rows, at = padded(spans.doc, bucket)
            masked = np.arange(offset, len(at), stride)
            for a in range(0, len(masked), BATCH):
                some = masked[a:a + BATCH]
                step(own, squares, rows, at[some], of[bucket[some]], rate)
            n += len(masked)
        if n:
            flat = np.concatenate([own[k].ravel() for k in _SHAPES]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * n), pa.array(np.full(len(flat), float(n)))], ["place", "v", "n"])

    got = (documents.select("text").mapInArrow(learn, "place long, v double, n double").groupBy("place")
           .agg((F.sum("v") / F.sum("n")).alias("v")).toPandas())
    flat = np.concatenate([weights[k].ravel() for k in _SHAPES])
    flat[got["place"]] = got["v"]
    edges = np.cumsum([0, *[int(np.prod(s)) for s in _SHAPES.values()]])
    return {k: flat[a:b].reshape(s).astype(np.float32) for (k, s), a, b in zip(_SHAPES.items(), edges[:-1], edges[1:], strict=True)}


def score(documents: DataFrame, keep: list[str], weights: dict[str, np.ndarray], of: np.ndarray, within: np.ndarray) -> DataFrame:
    """The columns `keep`, n_tokens, log_prob and mean_log_prob of every document."""
    shared = documents.sparkSession.sparkContext.broadcast((weights, of, within))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, of, within = shared.value
        for batch, block in W.blocks(batches, "__text"):
            spans, bucket = word_buckets(block)
            rows, at = padded(spans.doc, bucket)
            log = np.zeros(len(at))
            for a in range(0, len(at), BATCH):
                own = bucket[a:a + BATCH]
                log[a:a + BATCH] = log_likelihood(weights, rows, at[a:a + BATCH], of[own]) + within[own]
            n, total = spans.per_doc(block.n), np.bincount(spans.doc, log, block.n)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(n), pa.array(total), pa.array(total / np.maximum(n, 1))],
                                             [*keep, "n_tokens", "log_prob", "mean_log_prob"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema])
    return documents.select(*keep, F.col("text").alias("__text")).mapInArrow(rate, f"{schema}, n_tokens long, log_prob double, mean_log_prob double")


def train(documents: DataFrame, rounds: int = ROUNDS, stride: int = STRIDE, rate: float = STEP) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Weights, class of each bucket, and log-probability within the class. Every word is a target once."""
    if rounds != stride:
        raise ValueError("there must be a round for every offset, or words would be left out")
    counts = count_words(documents)
    of, within = classes(counts)
    weights = drawn(counts, of)
    for i in range(rounds):
        weights = train_round(documents, weights, of, i, stride, rate / (i + 1))
    return weights, of, within


def pseudo_likelihood(documents: DataFrame, keep: list[str]) -> DataFrame:
    return score(documents, keep, *train(documents))
