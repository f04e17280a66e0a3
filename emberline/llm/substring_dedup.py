"""Substring dedup: every run of 35 words that occurs again anywhere is removed, counted by super-k-mers.

A window is `length` consecutive words of one document. Its minimiser is the smallest hash among its
runs of `minimiser` words. Consecutive windows that share a minimiser travel together as one packed
string (their words joined by a space) to the bucket that the minimiser names; equal windows have
equal minimisers, so they meet there. Sorting a bucket's windows by hash brings equal ones together,
and their bytes are compared, so counts are exact. Runs of repeated windows go back by document.

Skew. Windows whose minimiser has more than `hot` super-k-mers go by a second one, of `second` words, and
still travel packed; where that is frequent, too, a window goes by its own hash. Which values are frequent
is told by bitmaps of a fixed size, so that nothing grows with the corpus; a value that shares the bit of a
frequent one is only dealt otherwise. Equal strings of one map task travel once, marked as repeated; the other
places where they occur need no answer and are handed on as they are, so a bucket gets at most one copy per map task.
Buckets hold about `per_bucket` windows, whatever the input's size, and are counted a piece at a time: only
their strings, and a hash and a place per window, are held together.

Defined results: null text is empty; texts shorter than a window are left as they are; repeated rows
are documents of their own, so both lose what they share; a null id is an id like any other; other
columns are handed through under their own names.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .lookup import parted
from .tables import bounded_batches, stored

LENGTH, MINIMISER, SECOND, HOT, PER_BUCKET = 35, 5, 20, 8192, 150_000
FLUSH_BYTES, PIECE_BYTES, BITS = 12 << 20, 1 << 18, 22
_KEYS = ("__k1", "__k2")


def _least(doc: np.ndarray, hashed: np.ndarray, at: np.ndarray, k: int, m: int) -> np.ndarray:
    """For the windows of k words that begin at `at`, the smallest hash among their runs of m words."""
    first, small = W.windows(doc, hashed, m)
    low = np.full(len(doc), np.iinfo(np.uint64).max, W.U)
    low[first] = small
    reach = 1
    while 2 * reach <= k - m + 1:
        low[:-reach] = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    return np.minimum(low[at], low[at + k - m + 1 - reach])


def _runs(at: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window and number of windows of each run of consecutive windows with one key."""
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (key[1:] != key[:-1])
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(at)))


def _windows(block: W.Block, k: int) -> tuple[W.Spans, np.ndarray, np.ndarray]:
    """Words of a block, their hashes, and the first word of each window."""
    spans = W.words(block)
    n = max(0, len(spans.doc) - k + 1)
    return spans, W.hashes(W.prefix(block), spans.start, spans.end), np.flatnonzero(spans.doc[:n] == spans.doc[len(spans.doc) - n:])


def _bit(value: np.ndarray) -> np.ndarray:
    return (W.mix(value) >> W.U(64 - BITS)).astype(np.int64)


def _keyed(documents: DataFrame) -> DataFrame:
    """A 128-bit key of each row's id and text; equal rows share it and get equal answers."""
    return documents.withColumns({_KEYS[0]: F.xxhash64("doc_id", "text"), _KEYS[1]: F.xxhash64(F.lit(7), "text", "doc_id")})


def frequent(documents: DataFrame, k: int, m: int, second: int, hot: int) -> tuple[int, list[np.ndarray]]:
    """Number of windows, and for either kind of minimiser a bitmap of 2^22 bits with those of more than `hot` super-k-mers."""
    def counted(found: list[list], sizes: int) -> Iterator[pa.RecordBatch]:
        for kind, values in enumerate(found):
            value, times = np.unique(np.concatenate([np.zeros(0, W.U), *values]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), kind, np.int32)), pa.array(value.view(np.int64)), pa.array(_bit(value)), pa.array(times)], names)
        yield pa.RecordBatch.from_arrays([pa.array([2], pa.int32()), pa.array([0]), pa.array([0]), pa.array([sizes])], names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, sizes, held = [[], []], 0, 0
        for _, block in W.blocks(batches):
            spans, hashed, at = _windows(block, k)
            sizes += len(at)
            if len(at):
                for kind, size in enumerate((m, second)):
                    least = _least(spans.doc, hashed, at, k, size)
                    found[kind].append(least[_runs(at, least)[0]])
                    held += len(found[kind][-1])
            if held > 1 << 20:
                yield from counted(found, sizes)
                found, sizes, held = [[], []], 0, 0
        yield from counted(found, sizes)

    names = ["kind", "minimiser", "bit", "n"]
    known = (documents.select("text").mapInArrow(count, "kind int, minimiser long, bit long, n long").groupBy("kind", "minimiser", "bit").agg(F.sum("n").alias("n"))
             .where((F.col("n") > hot) | (F.col("kind") == 2)))
    rows = (known.select("kind", (F.col("bit") + 1).alias("p"), "n").groupBy("kind", F.bitmap_bucket_number("p").alias("k"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"), F.max("n").alias("n")).collect())
    maps = [np.zeros(1 << BITS, bool), np.zeros(1 << BITS, bool)]
    for r in rows:
        if r["kind"] < 2:
            bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
            maps[r["kind"]][(r["k"] - 1) * len(bits):r["k"] * len(bits)] = bits
    return sum(r["n"] for r in rows if r["kind"] == 2), maps


PACKED = ("bucket int, packed binary, k1 array<long>, k2 array<long>, first array<int>, twice array<boolean>, "
          "same_k1 array<long>, same_k2 array<long>, same_first array<int>, same_n array<int>")


class _Packer:
    """Distinct strings of a map task by bucket, each with one place where it occurs."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}
        self.buckets: list[int] = []
        self.places: list[tuple[int, int, int]] = []
        self.twice: list[bool] = []
        self.same: list[tuple[int, int, int, int]] = []
        self.bytes = 0

    def add(self, text: bytes, bucket: int, place: tuple[int, int, int], n: int) -> None:
        at = self.known.setdefault(text, len(self.buckets))
        if at < len(self.buckets):
            self.twice[at] = True
            self.same.append((*place, n))
            self.bytes += 200
        else:
            self.buckets.append(bucket)
            self.places.append(place)
            self.twice.append(False)
            self.bytes += len(text) + 150

    def batches(self, n_buckets: int) -> Iterator[pa.RecordBatch]:
        order = np.argsort(np.array(self.buckets, np.int64), kind="stable")
        buckets, texts = np.array(self.buckets, np.int64)[order], list(self.known)
        edges = [*np.flatnonzero(np.append(True, buckets[1:] != buckets[:-1])[:len(buckets)]).tolist(), len(buckets)]
        pack = zstandard.ZstdCompressor(level=6)
        rows = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = order[a:b]
            k1, k2, first = zip(*[self.places[i] for i in own], strict=True)
            rows.append((int(buckets[a]), pack.compress(b"\n".join([texts[i] for i in own])), k1, k2, first,
                         [self.twice[i] for i in own], [], [], [], []))
        for a in range(0, len(self.same), 4096):  # no answer is needed: any bucket hands them on
            some = self.same[a:a + 4096]
            rows.append((int(some[0][0] % n_buckets), None, [], [], [], [], *map(list, zip(*some, strict=True))))
        for a in range(0, len(rows), 64):
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[a:a + 64], strict=True), _PACKED_TYPES, strict=True)],
                                             _PACKED_NAMES)


_PACKED_NAMES = [x.split()[0] for x in PACKED.split(", ")]
_PACKED_TYPES = [pa.int32(), pa.binary(), *[pa.list_(x) for x in (pa.int64(), pa.int64(), pa.int32(), pa.bool_(),
                                                                  pa.int64(), pa.int64(), pa.int32(), pa.int32())]]


def super_kmers(block: W.Block, k: int, m: int, second: int, maps: list[np.ndarray]):
    """Words of a block; first word, number of windows and key of each super-k-mer."""
    spans, hashed, at = _windows(block, k)
    if not len(at):
        return spans, at, at, at.astype(W.U)
    key = _least(spans.doc, hashed, at, k, m)
    many = maps[0][_bit(key)]
    if many.any():
        longer = _least(spans.doc, hashed, at, k, second)
        key[many] = W.mix(longer[many] + W.U(1))
        many &= maps[1][_bit(longer)]
        if many.any():
            key[many] = W.mix(W.windows(spans.doc, hashed, k)[1][many] + W.U(2))
    begin, n = _runs(at, key)
    return spans, at[begin], n, key[begin]


def pack(keyed: DataFrame, k: int, m: int, second: int, maps: list[np.ndarray], n_buckets: int) -> DataFrame:
    """Each document's super-k-mers as packed strings, gathered by bucket within a map task."""
    shared = keyed.sparkSession.sparkContext.broadcast([np.packbits(x) for x in maps])

    def to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer, bits = _Packer(), [np.unpackbits(x).astype(bool) for x in shared.value]
        for batch, block in W.blocks(batches):
            spans, first, size, key = super_kmers(block, k, m, second, bits)
            bucket = key % W.U(n_buckets)
            text, start, end = W.joined(block, spans)
            edges = W.doc_edges(spans, block.n)
            doc = spans.doc[first]
            k1, k2 = (batch.column(i).to_numpy()[doc].tolist() for i in (1, 2))
            add = packer.add
            for a, b, to, x, y, f, c in zip(start[first].tolist(), end[first + size + k - 2].tolist(), bucket.tolist(), k1, k2,
                                            (first - edges[doc]).tolist(), size.tolist(), strict=True):
                add(text[a:b], to, (x, y, f), c)
            if packer.bytes > FLUSH_BYTES:
                yield from packer.batches(n_buckets)
                packer = _Packer()
        yield from packer.batches(n_buckets)

    return keyed.select("text", *_KEYS).mapInArrow(to_buckets, PACKED)


def _pieces(texts: list[bytes], most: int) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    yield begin, len(texts)


def repeated_windows(texts: list[bytes], weight: np.ndarray, k: int, piece: int = PIECE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """String and first word of every window that occurs more than once among the strings, in order."""
    found = []
    for begin, end in _pieces(texts, piece):
        block = W.Block(np.frombuffer(b"".join(texts[begin:end]), np.uint8), np.cumsum([0, *map(len, texts[begin:end])]))
        spans = W.words(block)
        first, value = W.windows(spans.doc, W.hashes(W.prefix(block), spans.start, spans.end), k)
        doc = spans.doc[first]
        found.append((value, doc + begin, first - W.doc_edges(spans, block.n)[doc], spans.start[first] - block.offsets[doc], spans.end[first + k - 1] - block.offsets[doc]))
    hashed, doc, first, start, end = (np.concatenate(x) for x in zip(*found, strict=True))
    del found
    order = np.argsort(hashed, kind="stable")
    h = hashed[order]
    edges = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    times = np.diff(np.append(edges, len(h)))
    some = order[np.repeat(times > 1, times)]
    out = weight[doc] > 1

    def windows(places: np.ndarray) -> Iterator[bytes]:
        for i, a, b in zip(doc[places].tolist(), start[places].tolist(), end[places].tolist(), strict=True):
            yield texts[i][a:b]

    for a in range(0, len(some), 4096):
        part = some[a:a + 4097]  # one more, so that each is compared with its successor
        value, last = hashed[part], None
        for same, window in zip(np.append(False, value[1:] == value[:-1]).tolist(), windows(part), strict=True):
            if same and window != last:
                break
            last = window
        else:
            continue
        break
    else:
        out[some] = True
        return doc[out], first[out]
    counts: Counter = Counter()  # two different windows with one hash
    for w, window in zip(weight[doc[some]].tolist(), windows(some), strict=True):
        counts[window] += w
    out[some] |= np.array([counts[window] > 1 for window in windows(some)])
    return doc[out], first[out]


RUNS = "k1 long, k2 long, first int, n int"


def count_bucket(k: int):
    def count(bucket: pa.Table) -> pa.Table:
        unpack, texts = zstandard.ZstdDecompressor(), []
        for packed in bucket.column("packed"):
            if packed.is_valid:
                texts += unpack.decompress(packed.as_buffer()).split(b"\n")
        k1, k2, base, twice = (pc.list_flatten(bucket.column(x)).to_numpy() for x in ("k1", "k2", "first", "twice"))
        # Strings that several map tasks sent are one string here.
        at, first = repeated_windows(texts, twice.astype(np.int64) + 1, k)
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (first[1:] != first[:-1] + 1)
        begin = np.flatnonzero(new)
        own = at[begin]
        runs = [k1[own], k2[own], base[own] + first[begin],
                np.diff(np.append(begin, len(at)))]
        handed = [pc.list_flatten(bucket.column(x)).to_numpy() for x in ("same_k1", "same_k2", "same_first", "same_n")]
        return pa.table([pa.array(np.concatenate(x), t) for x, t in zip(zip(runs, handed, strict=True),
                                                                        (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)],
                        names=["k1", "k2", "first", "n"])
    return count


RESULT = "__words long, __removed long, __sha256 string, __kept string"


def remove_repeats(documents: DataFrame, keep: list[str], with_text: bool, length: int = LENGTH, minimiser: int = MINIMISER,
                   second: int = SECOND, hot: int = HOT, per_bucket: int = PER_BUCKET) -> DataFrame:
    """The columns `keep` of every document and n_words, n_removed, kept_sha256; `kept_text` (the words
    left, joined by one space) only where `with_text` asks for it."""
    k = length
    bounded_batches(documents.sparkSession)
    second = min(second, k)
    total, maps = frequent(documents, k, minimiser, second, hot)
    n_buckets = max(1, -(-total // per_bucket))
    keyed = _keyed(documents)
    runs = stored(pack(keyed, k, minimiser, second, maps, n_buckets).groupBy("bucket").applyInArrow(count_bucket(k), RUNS)
                  .groupBy("k1", "k2").agg(F.collect_list(F.struct("first", "n")).alias("__runs")), "runs")
    # Documents without a repeated window stay where they are read.
    whole, some = parted(keyed.select(*keep, F.col("text").alias("__text"), *_KEYS), runs.select(F.col("k1").alias(_KEYS[0])), _KEYS[0])
    cut_ones = some.join(runs, (F.col(_KEYS[0]) == F.col("k1")) & (F.col(_KEYS[1]) == F.col("k2")), "left").select(*keep, "__text", "__runs")
    given = whole.select(*keep, "__text", F.lit(None).cast(runs.schema["__runs"].dataType).alias("__runs")).unionByName(cut_ones)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in W.blocks(batches, "__text"):
            spans = W.words(block)
            edges = W.doc_edges(spans, block.n)
            lists = batch.column(len(keep) + 1)
            runs, which = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
            step = np.zeros(len(spans.doc) + 1, np.int64)
            if len(which):
                begin = edges[which] + pc.struct_field(runs, "first").to_numpy()
                np.add.at(step, begin, 1)
                np.add.at(step, begin + pc.struct_field(runs, "n").to_numpy() + k - 1, -1)
            stay = np.cumsum(step[:-1]) == 0
            left = W.Spans(spans.doc[stay], spans.start[stay], spans.end[stay])
            text, start, end = W.joined(block, left)
            at = W.doc_edges(left, block.n)
            kept = [text[start[a]:end[b - 1]] if b > a else b"" for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
            n = np.diff(edges)
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(n), pa.array(n - np.diff(at)), pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
                   pa.array([x.decode() if with_text else None for x in kept], pa.string())],
                [*keep, "__words", "__removed", "__sha256", "__kept"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema] + [RESULT])
    out = given.mapInArrow(cut, schema)
    named = [F.col("__words").alias("n_words"), F.col("__removed").alias("n_removed"), F.col("__sha256").alias("kept_sha256")]
    return out.select(*keep, *named, *([F.col("__kept").alias("kept_text")] if with_text else []))
