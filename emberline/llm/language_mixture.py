"""Language of documents by multilingual mixture inference.

Each language is a multinomial over hashed byte n-grams of words (one to four bytes, with the word's edges),
counted from the texts and languages of the training documents. A new document is a mixture: each of its words
was written in one language, with proportions that expectation-maximisation estimates from the words' n-gram
likelihoods. The set of languages grows greedily, each time by the one that raises the likelihood most, as
long as it raises the likelihood by more than a penalty for its additional parameter (half the logarithm of
the number of words, and a constant per language). The language with the largest proportion is the prediction.

Every language of the training rows is learned. What is gathered is one row per language and bucket that occurs in
it. Up to `DENSE` languages the log-probabilities are one array of buckets x languages, above that sparse rows of
the counted pairs alone, and blocks of texts get smaller as languages get more. Texts are read whole and stay where
they are.

Defined results: null text or a text without a letter gets `und` and score 0, as does every text if nothing
was learned; repeated rows each get a row; a null id is held out like an id whose checksum says so is not (its
remainder is null: it is neither learned from nor held out); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W

BUCKETS, DENSE, SMOOTHING, PENALTY, ROUNDS, ORDERS = 1 << 16, 200, 0.5, 3.0, 12, (1, 2, 3, 4)
_LETTER = regex.compile(r"\p{L}")


def _folded(block: W.Block) -> W.Block:
    """Lower case for ASCII, and anything but letters (and all above ASCII) as white space."""
    data = W.lowered(block).data.copy()
    data[~(((data >= 97) & (data <= 122)) | (data >= 128))] = 32
    return W.Block(data, block.offsets)


def ngrams(block: W.Block, buckets: int) -> tuple[W.Spans, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of the folded texts, and for each order the word and bucket of every n-gram, in order of words."""
    folded = _folded(block)
    spans = W.words(folded)
    # Words with a space before and after, so that n-grams see their edges.
    text, start, end = W.joined(folded, spans)
    data = np.frombuffer(b" " + text, np.uint8)
    word_of = np.repeat(np.arange(len(start)), end - start + 1) if len(start) else np.zeros(0, np.int64)
    out = []
    value = np.zeros(len(data), W.U)
    for n in range(1, max(ORDERS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        value = value[:size] * W.U(257) + data[n - 1:n - 1 + size] + W.U(1)
        if n in ORDERS:
            # An n-gram belongs to the word at whose preceding space or byte it begins, and ends at the space after it.
            first = np.arange(min(size, len(word_of)))
            word = word_of[first]
            inside = first + n - 1 <= end[word] + 1
            bucket = (W.mix(value[first[inside]] + W.U(n) * W.U(0x9E3779B97F4A7C15)) & W.U(buckets - 1)).astype(np.int64)
            out.append((word[inside], bucket))
    return spans, out


@dataclass
class Sparse:
    """Log-probabilities of buckets in languages: `base` of a language for what it hasn't, and what a counted pair has above that."""

    base: np.ndarray
    begin: np.ndarray
    language: np.ndarray
    above: np.ndarray

    def __len__(self) -> int:
        return len(self.begin) - 1

    def add(self, out: np.ndarray, word: np.ndarray, bucket: np.ndarray) -> None:
        """Adds the log-probabilities of each word's n-grams to its row of `out`, some n-grams at a time."""
        out += np.bincount(word, minlength=len(out))[:, None] * self.base
        ends = np.cumsum(self.begin[bucket + 1] - self.begin[bucket])
        at = 0
        while at < len(bucket):
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + (1 << 22), "right")))
            first, size = self.begin[bucket[at:to]], self.begin[bucket[at:to] + 1] - self.begin[bucket[at:to]]
            pair = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
            low, high = word[at:to].min(), word[at:to].max() + 1
            place = (np.repeat(word[at:to], size) - low) * len(self.base) + self.language[pair]
            out[low:high] += np.bincount(place, self.above[pair], (high - low) * len(self.base)).reshape(high - low, -1)
            at = to


def learn(documents: DataFrame, buckets: int = BUCKETS, dense: int = DENSE, smoothing: float = SMOOTHING) -> tuple[list[str], np.ndarray | Sparse]:
    """All languages and the log-probability of each bucket in each, from rows with text and lang."""
    known = documents.where("text is not null and lang is not null")
    # One row per language comes back.
    place = {x: i for i, x in enumerate(sorted(r["lang"] for r in known.select("lang").distinct().collect()))}
    if not place:
        return [], np.zeros((buckets, 0), np.float32)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(place) * buckets if len(place) <= dense else 0, np.int64)
        for batch, block in W.blocks(batches):
            language = np.array([place[x] for x in batch.column(1).to_pylist()])
            spans, grams = ngrams(block, buckets)
            for word, bucket in grams:
                pair = language[spans.doc[word]] * buckets + bucket
                if len(total):
                    total += np.bincount(pair, minlength=len(total))
                else:
                    some, n = np.unique(pair, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n)], ["place", "n"])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["place", "n"])

    got = known.select("text", "lang").mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    if len(place) > dense:
        language, bucket = np.divmod(got["place"].to_numpy(), buckets)
        n = got["n"].to_numpy()
        order = np.lexsort((language, bucket))
        base = np.log(smoothing / (np.bincount(language, n, len(place)) + smoothing * buckets))
        begin = np.concatenate([[0], np.cumsum(np.bincount(bucket, minlength=buckets))])
        return sorted(place), Sparse(base, begin, language[order].astype(np.int32), np.log1p(n[order] / smoothing).astype(np.float32))
    n = np.zeros(len(place) * buckets)
    n[got["place"]] = got["n"]
    n = n.reshape(len(place), buckets).T
    return sorted(place), np.log((n + smoothing) / (n.sum(0) + smoothing * buckets)).astype(np.float32)


def word_likelihoods(block: W.Block, table: np.ndarray | Sparse) -> tuple[W.Spans, np.ndarray]:
    """Words and the mean log-likelihood over orders of each in each language."""
    spans, grams = ngrams(block, len(table))
    sparse = not isinstance(table, np.ndarray)
    out = np.zeros((len(spans.doc), len(table.base) if sparse else table.shape[1]))
    for word, bucket in grams:
        if sparse:
            table.add(out, word, bucket)
        else:
            for j in range(table.shape[1]):
                out[:, j] += np.bincount(word, table[bucket, j], len(spans.doc))
    return spans, out / len(ORDERS)


def _fit(likelihood: np.ndarray, begin: np.ndarray, size: np.ndarray, active: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each document over its active languages. likelihood: words x languages,
    scaled so that each word's best is 1."""
    share = active / active.sum(1, keepdims=True)
    for _ in range(rounds):
        weighted = likelihood * np.repeat(share, size, 0)
        total = weighted.sum(1, keepdims=True)
        share = np.add.reduceat(weighted / np.maximum(total, 1e-300), begin, 0) / size[:, None]
    total = (likelihood * np.repeat(share, size, 0)).sum(1)
    return share, np.add.reduceat(np.log(np.maximum(total, 1e-300)), begin)


def _best_addition(likelihood, begin, size, active, share, value, cost, growing, rounds):
    """For each growing document the language outside its set that raises the likelihood most: proportions with
    it, log-likelihood and its place, or -1 where none raises it by more than the cost.

    No language is left out unseen: the likelihood is concave in the proportions, so with language j it rises by at most
    the largest sum over words of p_i / p_mixture - 1, i being j or in the set. Languages are tried by falling bound, until
    no bound is above the best rise found (or the cost)."""
    own = _rows_of(begin[growing], size[growing])
    inner = np.concatenate([[0], np.cumsum(size[growing])[:-1]])
    part = likelihood[own]
    mixed = (part * np.repeat(share[growing], size[growing], 0)).sum(1, keepdims=True)
    bound = np.add.reduceat(part / np.maximum(mixed, 1e-300), inner, 0) - size[growing, None]
    bound = np.maximum(bound, np.where(active[growing], bound, -np.inf).max(1, keepdims=True))
    bound[active[growing]] = -np.inf
    order = np.argsort(-bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, 1)
    # Only the columns of a document's set and the language tried take part.
    widest = int(active[growing].sum(1).max())
    members = np.argsort(~active[growing], axis=1, kind="stable")[:, :widest]
    is_member = np.take_along_axis(active[growing], members, 1)
    best, language, proportions = cost[growing].astype(float), np.full(len(growing), -1), share[growing].copy()
    for step in range(part.shape[1]):
        open_ = np.flatnonzero(bound[:, step] > best)
        if not len(open_):
            break
        new = order[open_, step]
        columns = np.column_stack([members[open_], new])
        allowed = np.column_stack([is_member[open_], np.ones(len(open_), bool)])
        words, n = _rows_of(inner[open_], size[growing[open_]]), size[growing[open_]]
        some = part[words[:, None], np.repeat(columns, n, 0)]
        fitted, reached = _fit(some, np.concatenate([[0], np.cumsum(n)[:-1]]), n, allowed.astype(float), rounds)
        rise = reached - value[growing[open_]]
        better = rise > best[open_]
        at = open_[better]
        best[at], language[at] = rise[better], new[better]
        proportions[at] = 0
        for column in range(columns.shape[1]):
            use = allowed[better, column]
            proportions[at[use], columns[better][use, column]] = fitted[better][use, column]
    return proportions, value[growing] + best, language


def _rows_of(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all rows of the given runs."""
    return np.arange(int(size.sum())) + np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size)


def infer(spans: W.Spans, logs: np.ndarray, n: int, penalty: float = PENALTY, rounds: int = ROUNDS) -> np.ndarray:
    """Proportions of the chosen languages in each of n documents; zeros for documents without words."""
    out = np.zeros((n, logs.shape[1]))
    docs = np.unique(spans.doc)
    if not len(docs) or not logs.shape[1]:
        return out
    likelihood = np.exp(np.maximum(logs - logs.max(1, keepdims=True), -60))
    begin = np.searchsorted(spans.doc, docs)
    size = np.diff(np.append(begin, len(spans.doc)))
    single = np.add.reduceat(np.log(likelihood), begin, 0)
    best = single.argmax(1)
    active = np.zeros((len(docs), logs.shape[1]), bool)
    active[np.arange(len(docs)), best] = True
    share, value = active.astype(float), single[np.arange(len(docs)), best]
    cost = penalty + 0.5 * np.log(size + 1.0)
    growing = np.arange(len(docs))
    while len(growing):
        found, reached, language = _best_addition(likelihood, begin, size, active, share, value, cost, growing, rounds)
        won = growing[language >= 0]
        active[won, language[language >= 0]] = True
        share[won], value[won] = found[language >= 0], reached[language >= 0]
        growing = won
    out[docs] = share
    return out


def predict(documents: DataFrame, keep: list[str], languages: list[str], table: np.ndarray | Sparse, penalty: float = PENALTY, rounds: int = ROUNDS) -> DataFrame:
    """The columns `keep`, lang_pred, score (the share of that language) and lang_set, all chosen languages."""
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, names = shared.value, np.array([*languages, "und"])
        # A block's array of words x languages stays as large as it is for `DENSE` languages.
        for batch, block in W.blocks(batches, "__text", (1 << 19) * DENSE // max(DENSE, len(languages))):
            spans, logs = word_likelihoods(block, table)
            share = infer(spans, logs, block.n, penalty, rounds)
            lettered = np.array([bool(x and _LETTER.search(x)) for x in batch.column(len(keep)).to_pylist()])
            known = lettered & (share.sum(1) > 0)
            if len(languages):  # letters, but none that the model's alphabet of bytes has seen in a word
                best = np.where(known, share.argmax(1), np.where(lettered, 0, len(languages)))
                score = np.where(known, share.max(1), 0.0)
            else:
                best, score = np.zeros(block.n, np.int64), np.zeros(block.n)
            chosen = [[languages[j] for j in np.flatnonzero(x > 0)] if y else [] for x, y in zip(share, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))] + [pa.array(names[best].tolist(), pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(chosen, pa.list_(pa.string()))],
                [*keep, "lang_pred", "score", "lang_set"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema])
    return documents.select(*keep, F.col("text").alias("__text")).mapInArrow(label, f"{schema}, lang_pred string, score double, lang_set array<string>")


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and lang_set; learned from documents whose crc32(doc_id) mod 4 is not 2."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    languages, table = learn(documents.where(fold != 2).select("text", "lang"))
    marked = documents.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return predict(marked, ["doc_id", "held_out"], languages, table)
