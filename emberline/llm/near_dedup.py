"""Near-duplicate documents by b-bit MinHash: links at a Jaccard similarity of 0.85 on 3-word shingles.

1. Each document's shingle set gives 128 minima. 25 bands of 5 minima name the buckets it falls in;
   the low 4 bits of all minima are packed into 64 bytes. Documents of one and the same set are one
   class, which its smallest id stands for; only classes go on.
2. In each bucket, similarities are estimated from the share of equal 4-bit fields, corrected for the
   1/16 that agree by chance; a pair under 0.65 is dropped. At a similarity of 0.85 a pair misses all
   bands with a probability of 4e-7, and the estimate is six standard deviations above the bound.
   A bucket hands on a spanning forest of its candidate pairs, never the pairs themselves.
3. The connected candidates form clusters. All texts of a cluster meet once more, and every pair is
   decided on its full shingle sets (64-bit hashes) by counting common shingles through an index; again only
   a spanning forest of the true links leaves the task. Components of these links are the result.

Skew. Exact copies shrink to one class by a partial aggregate. Larger buckets and clusters are cut into
blocks, and a task gets two blocks; so no task gets more than 2 x `block` members, whatever the
group's size, and no link between blocks is lost. The work in one cluster of different, similar texts
grows with the square of its size, spread over such tasks.

Defined results: null or blank texts have no shingles, are linked with nothing and are kept; a null id
stays null, is linked with nothing and is kept; rows that share an id follow each its own text, and
links of one hold for the other; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .lookup import named
from .tables import bounded_batches, stored

WORDS, PERCENT = 3, 85
MINIMA, BANDS, ROWS, BITS = 128, 25, 5, 4
LEAST_ESTIMATE, BLOCK, TEXT_BLOCK = 0.65, 1024, 256

_MULTIPLY = W.mix(np.arange(1, MINIMA + 1, dtype=W.U)) | W.U(1)
_ADD = W.mix(np.arange(1001, MINIMA + 1001, dtype=W.U))


def shingle_sets(block: W.Block, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Text and hash of each distinct shingle, in the order of both; a shorter text is one shingle."""
    low = W.lowered(block)
    spans = W.words(low)
    hashed = W.hashes(W.prefix(low), spans.start, spans.end)
    first, value = W.windows(spans.doc, hashed, k)
    doc = spans.doc[first]
    size = spans.per_doc(block.n)
    short = np.flatnonzero((size > 0) & (size < k))
    edges = W.doc_edges(spans, block.n)
    for j in range(1, k):
        own = short[size[short] == j]
        whole = np.full(len(own), j, W.U)
        for i in range(j):
            whole = W.mix(whole + hashed[edges[own] + i])
        doc, value = np.append(doc, own), np.append(value, whole)
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def minima(doc: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """The least of each of the hash functions over each text's shingles; texts without shingles get zeros."""
    out = np.zeros((n, MINIMA), W.U)
    begin = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    if len(begin):
        for i in range(MINIMA):
            out[doc[begin], i] = np.minimum.reduceat(value * _MULTIPLY[i] + _ADD[i], begin)
    return out


def packed(least: np.ndarray) -> np.ndarray:
    """The low bits of the mixed minima, two fields a byte."""
    low = (W.mix(least) & W.U((1 << BITS) - 1)).astype(np.uint8)
    return low[:, ::2] << 4 | low[:, 1::2]


def estimate(one: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Similarity of one packed signature to others, corrected for fields that agree by chance."""
    apart = others ^ one
    equal = ((apart & 0xF0) == 0).sum(1) + ((apart & 0x0F) == 0).sum(1)
    chance = 1 / (1 << BITS)
    return (equal / MINIMA - chance) / (1 - chance)


_PROFILE = "doc_id long, n long, s1 long, s2 long, bands array<long>, signature binary"


def profiles(documents: DataFrame, k: int) -> DataFrame:
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in W.blocks(batches):
            doc, value = shingle_sets(block, k)
            least = minima(doc, value, block.n)
            bands = np.zeros((block.n, BANDS), W.U)
            for b in range(BANDS):
                for r in range(ROWS):
                    bands[:, b] = W.mix(bands[:, b] + least[:, b * ROWS + r] + W.U(b + 1))
            sums = []
            for salt in (11, 12):
                total = np.zeros(len(value) + 1, W.U)
                np.cumsum(W.mix(value + W.U(salt)), out=total[1:])
                edges = np.searchsorted(doc, np.arange(block.n + 1))
                sums.append((total[edges[1:]] - total[edges[:-1]]).view(np.int64))
            signature = packed(least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.bincount(doc, minlength=block.n)), pa.array(sums[0]), pa.array(sums[1]),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, block.n * BANDS + 1, BANDS, dtype=np.int32)), pa.array(bands.ravel().view(np.int64))),
                 pa.array([x.tobytes() for x in signature], pa.binary())],
                ["doc_id", "n", "s1", "s2", "bands", "signature"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(profile, _PROFILE)


def in_blocks(members: DataFrame, key: str, size: int) -> DataFrame:
    """Rows of groups of two members or more, cut into blocks; a row goes to each pair of blocks that has its
    own. Adds lo, hi, the pair's blocks."""
    counted = members.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").withColumn("__m", F.ceil(F.col("__n") / size))
    block = F.pmod(F.xxhash64("id"), F.col("__m"))
    return (members.join(counted.withColumnRenamed(key, "__key"), F.col(key) == F.col("__key"))
            .withColumn("__own", block).withColumn("__with", F.explode(F.expr("sequence(0L, __m - 1)")))
            .withColumn("lo", F.least("__own", "__with")).withColumn("hi", F.greatest("__own", "__with"))
            .drop("__key", "__n", "__m", "__own", "__with"))


def groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.RecordBatch]:
    """Sorted batches cut anew where the first columns change; a group may come from several batches."""
    rest: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, bool)
        for x in keys:
            change[1:] |= x[1:] != x[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        if rest and last != tuple(x[0] for x in keys):
            yield pa.concat_batches(rest)
            rest = []
        for a, b in zip(edges[:-2], edges[1:-1], strict=True):
            yield pa.concat_batches([*rest, batch.slice(a, b - a)]) if rest else batch.slice(a, b - a)
            rest = []
        rest.append(batch.slice(edges[-2], edges[-1] - edges[-2]))
        last = tuple(x[-1] for x in keys)
    if rest:
        yield pa.concat_batches(rest)


class _Forest:
    """Union-find over 0 .. n-1 that notes the pairs which joined two trees."""

    def __init__(self, n: int) -> None:
        self.up, self.pairs = list(range(n)), []

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x: int, others: np.ndarray) -> None:
        for y in others.tolist():
            a, b = self.root(x), self.root(y)
            if a != b:
                self.up[b] = a
                self.pairs.append((x, y))


EDGES = "a long, b long"


def _edges(found: list[tuple[np.ndarray, list]]) -> pa.RecordBatch:
    a = [int(ids[x]) for ids, pairs in found for x, _ in pairs]
    b = [int(ids[y]) for ids, pairs in found for _, y in pairs]
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def candidate_forest(least: float):
    """Links members of a bucket whose estimated similarity is `least` or more."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n_found = [], 0
        for group in groups(batches, 3):
            ids = group.column(3).to_numpy()
            signatures = np.stack([np.frombuffer(x, np.uint8) for x in group.column(4).to_pylist()])
            forest, left, near = _Forest(len(ids)), np.arange(len(ids)), []
            while len(left):
                x, left = (near.pop(), left) if near else (int(left[0]), left[1:])
                close = estimate(signatures[x], signatures[left]) >= least
                forest.pairs += [(x, y) for y in left[close].tolist()]
                near += left[close].tolist()
                left = left[~close]
            found.append((ids, forest.pairs))
            n_found += len(forest.pairs)
            if n_found > 20_000:
                yield _edges(found)
                found, n_found = [], 0
        yield _edges(found)
    return link


def link_sets(doc: np.ndarray, value: np.ndarray, n: int, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the pairs of sets with 100 * intersection >= percent * union."""
    size = np.bincount(doc, minlength=n)
    order = np.argsort(value, kind="stable")
    owner, v = doc[order], value[order]
    new = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
    times = np.diff(np.append(new, len(v)))
    group = np.empty(len(v), np.int64)
    group[order] = np.repeat(np.arange(len(new)), times)
    edges = np.searchsorted(doc, np.arange(n + 1))
    forest = _Forest(n)
    for x in range(n - 1):
        own = group[edges[x]:edges[x + 1]]
        own = own[times[own] > 1]
        if len(own):
            length = times[own]
            at = np.arange(int(length.sum())) + np.repeat(new[own] - (np.cumsum(length) - length), length)
            common = np.bincount(owner[at], minlength=n)
            common[:x + 1] = 0
            linked = 100 * common >= percent * (size[x] + size - common)
            forest.link(x, np.flatnonzero(linked & (common > 0)))
    return forest.pairs


def link_forest(k: int, percent: int):
    """Links texts of a cluster whose full sets are similar enough."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in groups(batches, 3):
            docs, values, before = [np.zeros(0, np.int64)], [np.zeros(0, W.U)], 0
            for part, block in W.blocks(iter([group])):
                doc, value = shingle_sets(block, k)
                docs.append(doc + before)
                values.append(value)
                before += part.num_rows
            found.append((group.column(3).to_numpy(), link_sets(np.concatenate(docs), np.concatenate(values), before, percent)))
            if len(found) > 500:
                yield _edges(found)
                found = []
        yield _edges(found)
    return link


def near_duplicates(documents: DataFrame, words: int = WORDS, percent: int = PERCENT, least_estimate: float = LEAST_ESTIMATE,
                    block: int = BLOCK, text_block: int = TEXT_BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every document."""
    bounded_batches(documents.sparkSession)
    every = stored(profiles(documents, words), "profiles")
    # One row per class, the one with the smallest id; its bands and signature are those of the whole class.
    real = every.where("n > 0 and doc_id is not null")
    classes = stored(real.groupBy("s1", "s2", "n").agg(F.min(F.struct("doc_id", "bands", "signature")).alias("x"))
                     .select("s1", "s2", "n", F.col("x.doc_id").alias("id"), "x.bands", "x.signature"), "classes")
    shared = in_blocks(classes.select("id", F.explode("bands").alias("bucket")), "bucket", block)
    candidates = (shared.join(classes.select(F.col("id").alias("__id"), "signature"), F.col("id") == F.col("__id"))
                  .select("bucket", "lo", "hi", "id", "signature")
                  .repartition("bucket", "lo", "hi").sortWithinPartitions("bucket", "lo", "hi")
                  .mapInArrow(candidate_forest(least_estimate), EDGES))
    clusters = stored(components(candidates), "clusters")
    placed = in_blocks(clusters.select(F.col("node").alias("id"), "root"), "root", text_block)
    texts = named(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                  clusters.select(F.col("node").alias("doc_id"))).withColumnRenamed("doc_id", "__id")
    links = (placed.join(texts, F.col("id") == F.col("__id")).select("root", "lo", "hi", "id", "text")
             .repartition("root", "lo", "hi").sortWithinPartitions("root", "lo", "hi")
             .mapInArrow(link_forest(words, percent), EDGES))
    roots = components(links)
    mine = every.select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.col("s1")).alias("__s1"), "s2")
    named_classes = classes.select("s1", F.col("s2").alias("__s2"), F.col("n").alias("__n"), "id")
    component = F.coalesce("root", "id", "doc_id")
    return (mine.join(named_classes, (F.col("__s1") == F.col("s1")) & (F.col("s2") == F.col("__s2")) & (F.col("n") == F.col("__n")), "left")
            .join(roots, F.col("id") == F.col("node"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                    component.eqNullSafe(F.col("doc_id")).alias("kept")))
