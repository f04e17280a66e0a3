"""Quality rules: log-likelihood ratio of hashed n-grams between trusted documents and the whole corpus.

Tokens are words cut at punctuation. One- and two-token n-grams are hashed into a fixed number of
buckets; two smoothed multinomials over the buckets are counted from all documents (raw) and from
those that the trusted ids name (target). A document's score is the mean over its n-grams of
log(target) - log(raw), and it is kept if the score reaches a threshold and the base rules hold.

All passes stream over whole texts. What is gathered is one row per bucket, whatever the input.
Counts and scores don't depend on partitioning, so a lost task gives the same rows again.

Defined results: null text is empty; an empty text has no words, score 0 and fails the base rules;
repeated rows each get a row; null ids are never trusted; without trusted documents (or with an
empty labels table) all scores are 0 and the base rules alone decide; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .lookup import labelled
from .tables import bounded_batches

BUCKETS = 1 << 16
THRESHOLD = -0.7
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
MIN_WORDS, MAX_REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5

_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[SYMBOLS] = True


def ngrams(block: W.Block, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every one- and two-token n-gram."""
    spans = W.tokens(block)
    hashed = W.hashes(W.prefix(block), spans.start, spans.end)
    first, pairs = W.windows(spans.doc, hashed, 2)
    mask = np.uint64(buckets - 1)
    return (np.concatenate([spans.doc, spans.doc[first]]),
            np.concatenate([hashed & mask, pairs & mask]).astype(np.int64))


def count_ngrams(documents: DataFrame, buckets: int) -> DataFrame:
    """bucket, n: n-gram counts over all documents given."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, block in W.blocks(batches):
            total += np.bincount(ngrams(block, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    return documents.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def log_ratios(raw: DataFrame, target: DataFrame, buckets: int, smoothing: float) -> np.ndarray:
    """log(target) - log(raw) per bucket; each table has at most one row per bucket."""
    share = []
    for counts in (raw, target):
        got, n = counts.toPandas(), np.zeros(buckets)
        n[got["bucket"]] = got["n"]
        share.append((n + smoothing) / (n.sum() + smoothing * buckets))
        if not n.sum():
            return np.zeros(buckets)
    return np.log(share[1]) - np.log(share[0])


def measures(block: W.Block) -> dict[str, np.ndarray]:
    """The base counts of each text."""
    n, data = block.n, block.data
    spans, sums = W.words(block), W.prefix(block)
    hashed = W.hashes(sums, spans.start, spans.end)
    outside = ~W.is_space(data)
    rows = W.lines(block)
    has_word = np.zeros(len(rows.doc), bool)
    has_word[np.searchsorted(rows.start, spans.start, "right") - 1] = True
    rows = W.Spans(rows.doc[has_word], rows.start[has_word], rows.end[has_word])
    _, dup_line = W.repeated(rows.doc, W.hashes(sums, rows.start, rows.end))
    first, runs = W.windows(spans.doc, hashed, REPEAT_WINDOW)
    twice, _ = W.repeated(spans.doc[first], runs)
    in_repeat = W.covered(len(spans.doc), first[twice], REPEAT_WINDOW)
    return {
        "n_words": spans.per_doc(n),
        "word_chars": W.count_in(block, outside & ((data & 0xC0) != 0x80)),
        "n_symbols": W.count_in(block, _IS_SYMBOL[data]),
        "n_dup_lines": np.bincount(rows.doc[dup_line], minlength=n),
        "n_repeat_words": np.bincount(spans.doc[in_repeat], minlength=n),
    }


COLUMNS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, llr double, kept boolean"


def rate(documents: DataFrame, labels: DataFrame, keep: list[str], buckets: int = BUCKETS, smoothing: float = 1.0,
         threshold: float = THRESHOLD) -> DataFrame:
    """The columns `keep` of every document, its base counts, score and verdict."""
    bounded_batches(documents.sparkSession)
    trusted = labelled(documents, labels.where("quality = 1"), "quality")
    ratio = log_ratios(count_ngrams(documents, buckets), count_ngrams(trusted, buckets), buckets, smoothing).astype(np.float32)
    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(ratio)
    names = [x.split()[0] for x in COLUMNS.split(", ")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch, block in W.blocks(batches, "__text"):
            out = measures(block)
            doc, bucket = ngrams(block, buckets)
            total = np.bincount(doc, weights=ratio[bucket], minlength=block.n)
            out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEAT_PERCENT * out["n_words"])
            out["llr"] = total / np.maximum(np.bincount(doc, minlength=block.n), 1)
            out["kept"] = ~out["base_failed"] & (out["llr"] >= threshold)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(keep))] + [pa.array(out[x]) for x in names],
                                             keep + names)

    given = documents.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema] + [COLUMNS])
    return given.mapInArrow(score, schema)
