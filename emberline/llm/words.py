"""Whole texts of an Arrow batch as flat arrays: words, tokens, lines and their 64-bit hashes.

Texts of a batch lie one behind another in one byte array; words are ranges of it, and hashes of
ranges come from prefix sums, so no Python code runs per word. Null counts as empty text.
Words are maximal runs of bytes other than space and 0x09-0x0D, which are the same in UTF-8 as in
code points. A range's hash is a polynomial over its bytes modulo 2^64, mixed.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_WORD_BASE = 0xD1342543DE82EF95 | 1
_KEPT_POWERS = 1 << 19


def _process_wide(name: str) -> dict:
    """A dict of this process. Functions travel by value, so what a module keeps in itself would be kept again by every task."""
    return sys.modules.setdefault(f"_emberline_{name}", types.ModuleType(name)).__dict__


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose output bits all depend on all input bits."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U) * U(_BASE)) | U(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, at least; up to 2^19 of them are kept for the next call."""
    kept = _process_wide("powers")
    have = kept.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, U)
        have[0] = 1
        have = np.cumprod(have, dtype=U)
        if len(have) <= _KEPT_POWERS:
            kept[base] = have
    return have


@dataclass
class Block:
    """Consecutive rows of a batch: bytes of their texts and where each begins."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Spans:
    """Ranges [start, end) of a block's bytes, in order, with the row that each belongs to."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def per_doc(self, n: int) -> np.ndarray:
        return np.bincount(self.doc, minlength=n)


def block_of(texts: pa.Array) -> Block:
    """No copy of the bytes, unless there are nulls."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not (pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type)):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        return Block(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind, len(texts) + 1, texts.offset * np.dtype(kind).itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Block(data[offsets[0]:offsets[-1]], offsets - offsets[0])


def blocks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 1 << 18) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Cuts batches into runs of whole rows of about `limit` bytes; a longer text is a run of its own."""
    for batch in batches:
        whole = block_of(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < whole.n:
            to = max(at + 1, int(np.searchsorted(whole.offsets, whole.offsets[at] + limit, "right")) - 1)
            a, b = whole.offsets[at], whole.offsets[to]
            yield batch.slice(at, to - at), Block(whole.data[a:b], whole.offsets[at:to + 1] - a)
            at = to


def lowered(block: Block) -> Block:
    """A-Z to a-z, nothing else."""
    upper = (block.data >= 65) & (block.data <= 90)
    return Block(block.data + (upper * 32).astype(np.uint8), block.offsets)


def is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _spans(block: Block, kind: np.ndarray) -> Spans:
    """Maximal runs of one non-zero kind inside one text."""
    if not len(kind):
        none = np.zeros(0, np.int64)
        return Spans(none, none, none)
    change = np.ones(len(kind) + 1, bool)
    change[1:-1] = kind[1:] != kind[:-1]
    change[block.offsets] = True
    edges = np.flatnonzero(change)
    start, end = edges[:-1], edges[1:]
    real = kind[start] != 0
    start, end = start[real], end[real]
    return Spans(np.searchsorted(block.offsets, start, "right") - 1, start, end)


def words(block: Block) -> Spans:
    return _spans(block, (~is_space(block.data)).view(np.uint8))


#: Kind of each byte: 0 white space, 1 letters, digits and all above ASCII, 2 the rest.
_KIND = np.full(256, 2, np.uint8)
_KIND[128:] = 1
for _low, _high in ((48, 58), (65, 91), (97, 123)):
    _KIND[_low:_high] = 1
_KIND[9:14] = _KIND[32] = 0


def tokens(block: Block) -> Spans:
    """Words cut where letters or digits meet punctuation."""
    return _spans(block, _KIND[block.data])


def lines(block: Block) -> Spans:
    """Texts cut at newlines; empty lines are left out."""
    return _spans(block, (block.data != 10).view(np.uint8))


def prefix(block: Block) -> np.ndarray:
    """Prefix sums from which `hashes` takes the hash of any range."""
    out = np.zeros(len(block.data) + 1, U)
    np.cumsum(_BYTES[block.data] * _powers(_BASE, len(block.data) + 1)[:len(block.data)], out=out[1:])
    return out


_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD_INVERSE = pow(_WORD_BASE, -1, 1 << 64)


def hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((sums[end] - sums[start]) * _powers(_BASE_INVERSE, len(sums))[start] + (end - start).astype(U))


def windows(doc: np.ndarray, hashed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of k consecutive words inside one text."""
    n = len(doc) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    first = np.flatnonzero(doc[:n] == doc[k - 1:])
    if k <= 8:
        value = np.zeros(n, U)
        for j in range(k):
            value = value * U(_WORD_BASE) + hashed[j:j + n]
        return first, mix(value[first])
    sums = np.zeros(len(doc) + 1, U)
    np.cumsum(hashed * _powers(_WORD_BASE, len(doc) + 1)[:len(doc)], out=sums[1:])
    return first, mix((sums[first + k] - sums[first]) * _powers(_WORD_INVERSE, len(doc) + 1)[first])


def count_in(block: Block, mask: np.ndarray) -> np.ndarray:
    """True values of a mask over the block's bytes, per text."""
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[block.offsets[1:]] - sums[block.offsets[:-1]]


def repeated(doc: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For (text, value) pairs: whether the pair occurs more than once, and whether it occurred earlier."""
    order = np.lexsort((value, doc))  # stable: equal pairs stay in order
    d, v = doc[order], value[order]
    same = np.zeros(len(d), bool)
    same[1:] = (d[1:] == d[:-1]) & (v[1:] == v[:-1])
    twice = same.copy()
    twice[:-1] |= same[1:]
    out, earlier = np.zeros(len(d), bool), np.zeros(len(d), bool)
    out[order], earlier[order] = twice, same
    return out, earlier


def covered(n: int, first: np.ndarray, k: int) -> np.ndarray:
    """Which of n words lie in a run of k words that begins at one of `first`."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, first, 1)
    np.add.at(step, first + k, -1)
    return np.cumsum(step[:-1]) > 0


def joined(block: Block, spans: Spans) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The given ranges one behind another with a space after each, and where each begins and ends there."""
    size = spans.end - spans.start
    end = np.cumsum(size + 1) - 1
    start = end - size
    out = np.full(int(end[-1]) + 1 if len(end) else 0, 32, np.uint8)
    step = np.arange(int(size.sum()))
    before = np.cumsum(size) - size
    out[step + np.repeat(start - before, size)] = block.data[step + np.repeat(spans.start - before, size)]
    return out.tobytes(), start, end


def doc_edges(spans: Spans, n: int) -> np.ndarray:
    """For n texts, the index of each one's first range, and at the end the number of ranges."""
    return np.searchsorted(spans.doc, np.arange(n + 1))
