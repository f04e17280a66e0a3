"""Line dedup: lines that many documents share are dropped, but for one document that keeps them.

A line's key is the line stripped of white space at both ends, with A-Z lower-cased. Lines explode to 128-bit
hashes of their keys; the distinct documents of a hash are counted; a key of at least `min_chars` code points found
in at least `min_docs` documents loses all its lines but those of the largest doc_id that holds it. What is left of
a text is put together by position.

Skew. A map task sends a key once for each 262,144 lines, with the ids that hold it there, so a line that is found in a
third of all documents is one narrow row for as many. Distinct documents are counted by (key, id) first, which spreads
such a line evenly, and combined before the second shuffle. Only documents that lose a line are moved.

Defined results: a null or empty text is one empty line; a null id counts for no key and loses no line; rows that
repeat an id are one document, and each of them loses the same keys; other columns are handed through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .lookup import parted
from .tables import bounded_batches, stored

MIN_CHARS, MIN_DOCS = 20, 3
KEYS = "h1 long, h2 long, ids array<long>"
RESULT = "__lines long, __dropped long, __sha256 string, __kept string"


@dataclass
class Lines:
    """The lines of a block in order, empty ones included: their text, their bytes, and the key's length and hashes."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    chars: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


def keyed_lines(block: W.Block) -> Lines:
    newline = np.flatnonzero(block.data == 10)
    start = np.sort(np.concatenate([block.offsets[:-1], newline + 1]))
    end = np.sort(np.concatenate([block.offsets[1:], newline]))
    doc = np.repeat(np.arange(block.n), W.count_in(block, block.data == 10) + 1)
    solid = np.flatnonzero(~W.is_space(block.data))
    edge = np.append(solid, len(block.data))
    a, b = np.searchsorted(solid, start), np.searchsorted(solid, end)
    first, last = edge[a], edge[np.maximum(b, 1) - 1] + 1
    first, last = np.where(b > a, first, start), np.where(b > a, last, start)
    points = np.zeros(len(block.data) + 1, np.int64)
    np.cumsum((block.data & 0xC0) != 0x80, out=points[1:])
    low = W.lowered(block)
    h1 = W.hashes(W.prefix(low), first, last)
    h2 = W.hashes(W.prefix(W.Block(low.data ^ np.uint8(0x5A), low.offsets)), first, last)
    return Lines(doc, start, end, points[last] - points[first], h1, h2)


def line_keys(documents: DataFrame, min_chars: int) -> DataFrame:
    """h1, h2, ids: the keys of a run of lines and the distinct ids that hold them there."""
    def gathered(found: list[tuple]) -> pa.RecordBatch:
        x, y, z = (np.concatenate(values) for values in zip((np.zeros(0, W.U), np.zeros(0, W.U), np.zeros(0, np.int64)), *found, strict=True))
        order = np.lexsort((z, y, x))
        x, y, z = x[order], y[order], z[order]
        other = np.ones(len(x), bool)
        other[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        new = other.copy()
        new[1:] |= z[1:] != z[:-1]
        x, y, z, other = x[new], y[new], z[new], other[new]
        begin = np.flatnonzero(other)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(z)), pa.int32()), pa.array(z))
        return pa.RecordBatch.from_arrays([pa.array(x[begin].view(np.int64)), pa.array(y[begin].view(np.int64)), lists], ["h1", "h2", "ids"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for part, block in W.blocks(batches):
            lines = keyed_lines(block)
            long = lines.chars >= min_chars
            found.append((lines.h1[long], lines.h2[long], part.column(0).to_numpy()[lines.doc[long]]))
            held += len(found[-1][0])
            if held > 1 << 18:
                yield gathered(found)
                found, held = [], 0
        yield gathered(found)

    return documents.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(explode, KEYS)


def shared_keys(keys: DataFrame, min_docs: int) -> DataFrame:
    """h1, h2, keeper: keys of at least `min_docs` documents, and the largest id that holds each."""
    return (keys.select("h1", "h2", F.explode("ids").alias("id")).distinct()
            .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("id").alias("keeper"))
            .where(F.col("n") >= min_docs).drop("n"))


def _mark(doc: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    return W.mix(h1 + W.mix(h2 + W.mix(doc.astype(W.U) + W.U(1))))


def drop_shared_lines(documents: DataFrame, keep: list[str], with_text: bool, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns `keep` of every document and n_lines, n_dropped, kept_sha256; `kept_text` only where `with_text` asks for it."""
    bounded_batches(documents.sparkSession)
    keys = stored(line_keys(documents, min_chars), "line-keys")
    gone = stored(keys.join(shared_keys(keys, min_docs), ["h1", "h2"]).select("h1", "h2", "keeper", F.explode("ids").alias("__id"))
                  .where("__id <> keeper").groupBy("__id").agg(F.collect_set(F.struct("h1", "h2")).alias("__gone")), "gone-lines")
    given = documents.select(*keep, F.coalesce("text", F.lit("")).alias("__text"), F.col("doc_id").cast("long").alias("__id"))
    # Documents that lose nothing stay where they are read.
    whole, some = parted(given, gone, "__id")
    untouched = whole.select(*keep, (F.length("__text") - F.length(F.replace("__text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("__lines"),
                             F.lit(0).cast("long").alias("__dropped"), F.sha2("__text", 256).alias("__sha256"),
                             (F.col("__text") if with_text else F.lit(None).cast("string")).alias("__kept"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, block in W.blocks(batches, "__text"):
            found = keyed_lines(block)
            lists = batch.column(len(keep) + 1)
            pairs, which = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
            named = [pc.struct_field(pairs, x).to_numpy().view(W.U) for x in ("h1", "h2")]
            dropped = (found.chars >= min_chars) & np.isin(_mark(found.doc, found.h1, found.h2), _mark(which, *named))
            n, lost = np.bincount(found.doc, minlength=block.n), np.bincount(found.doc[dropped], minlength=block.n)
            text, edges = block.data.tobytes(), np.append(0, np.cumsum(n))
            stay = [[text[a:b] for a, b in zip(found.start[x:y][~dropped[x:y]].tolist(), found.end[x:y][~dropped[x:y]].tolist(), strict=True)]
                    for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
            kept = [b"\n".join(x) for x in stay]
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(keep))]
                + [pa.array(n), pa.array(lost), pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()),
                   pa.array([x.decode() if with_text else None for x in kept], pa.string())],
                [*keep, "__lines", "__dropped", "__sha256", "__kept"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema] + [RESULT])
    changed = some.join(gone, "__id", "left").select(*keep, "__text", "__gone").mapInArrow(cut, schema)
    out = untouched.unionByName(changed)
    named = [F.col("__lines").alias("n_lines"), F.col("__dropped").alias("n_dropped"), F.col("__sha256").alias("kept_sha256")]
    return out.select(*keep, *named, *([F.col("__kept").alias("kept_text")] if with_text else []))
