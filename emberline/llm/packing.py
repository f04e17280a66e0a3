"""Packing along a space-filling curve: similar documents share training sequences.

A document's hashed word counts, scaled to length one, are projected to four dimensions by fixed random
signs and quantised; the cell's place on the Hilbert curve orders the documents. The tokens of
all documents in that order form one line, cut into sequences of `length` tokens. So only the very
last sequence is padded, and neighbours on the curve share sequences.

Tokenised documents are stored once (two bytes a token). The range sort, with ties (copies share a
cell) broken by row, and the running total of lengths move narrow rows only: no partition depends on how
many documents share a cell, and no task sees the whole order.

Defined results: null text is empty; every document ends with the end token, so an empty one is one
piece of one token; repeated rows and null ids are packed like any other; other columns are not read.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .ordering import running_total
from .tables import stored

LENGTH, END_ID, DIMENSIONS, CELL_BITS = 2048, 1, 4, 12

#: Fixed value: the public pre-tokenizer pattern of byte-level vocabularies.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(path: str):
    """Encodes with the vocabulary of a `tokenizers` file of the byte-level kind, whose ids are its merge order.

    The ids are those of `tokenizers`, special tokens in a text included; tiktoken finds them in a third of
    the time."""
    import tiktoken

    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    if stated["model"]["type"] != "BPE" or stated["pre_tokenizer"] != {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True} or stated["normalizer"]:
        raise ValueError(f"{path} isn't a byte-level BPE without a normalizer")
    # A visible byte stands for itself, the others for the code points from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in set(visible))}
    special = {x["content"]: x["id"] for x in stated["added_tokens"]}
    ranks = {bytes(byte_of[c] for c in token): i for token, i in stated["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding(path, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each cell (rows of coordinates below 2^bits) on the Hilbert curve.

    Coordinates are first undone level by level from the highest bit: where a bit is set the lower bits
    of the first axis are flipped, else they are swapped with those of the first axis; a Gray code over the
    axes then gives the digits of the key."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for i in range(axes):
            set_ = (x[i] & level) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(set_, low, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        flip ^= np.where((x[-1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = key << 1 | ((x[i] >> b) & 1)
    return key


def cells(block: W.Block, dimensions: int, bits: int) -> np.ndarray:
    """Quantised projections of each text's scaled word counts."""
    low = W.lowered(block)
    spans = W.words(low)
    hashed = W.hashes(W.prefix(low), spans.start, spans.end)
    order = np.lexsort((hashed, spans.doc))
    doc, value = spans.doc[order], hashed[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (value[1:] != value[:-1]))) if len(doc) else np.zeros(0, np.int64)
    times, doc, value = np.diff(np.append(new, len(doc))).astype(float), doc[new], value[new]
    norm = np.sqrt(np.bincount(doc, times * times, block.n))
    out = np.zeros((block.n, dimensions), np.int64)
    for i in range(dimensions):
        sign = 1.0 - 2.0 * ((W.mix(value + W.U(i + 1)) >> W.U(63)).astype(float))
        y = np.bincount(doc, sign * times, block.n) / np.maximum(norm, 1)
        out[:, i] = np.clip((y / 6 + 0.5) * (1 << bits), 0, (1 << bits) - 1)
    return out


def tokenised(documents: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, ids (packed), doc_tokens and the place on the curve of every document."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        size = 2 if max(own.max_token_value, end_id) < 1 << 16 else 4
        for batch, block in W.blocks(batches):
            ids = [np.append(own.encode_to_numpy(x or "", allowed_special="all"), end_id).astype(f"<u{size}") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([size] * len(ids), pa.int32()),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array(hilbert(cells(block, DIMENSIONS, CELL_BITS), CELL_BITS))],
                ["doc_id", "ids", "id_bytes", "doc_tokens", "place"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(encode, f"doc_id {kind}, ids binary, id_bytes int, doc_tokens long, place long")


def pack(documents: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    tokens = stored(tokenised(documents, path, end_id).withColumn("row", F.monotonically_increasing_id()), "tokens")
    begins = running_total(tokens.select("row", "place", "doc_tokens"), [F.asc("place"), F.asc("row")], F.col("doc_tokens"), "begin", "curve")
    placed = tokens.join(begins.select(F.col("row").alias("__row"), "begin"), F.col("row") == F.col("__row")).select(
        "doc_id", "ids", "id_bytes", "doc_tokens", "begin")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, out = [], []
            for i, (ids, size, n, begin) in enumerate(zip(*(batch.column(j).to_pylist() for j in (1, 2, 3, 4)), strict=True)):
                wide = np.frombuffer(ids, f"<u{size}").astype("<u4").tobytes()
                a = 0
                while a < n:
                    sequence, offset = divmod(begin + a, length)
                    m = min(n - a, length - offset)
                    at.append(i)
                    out.append((a, m, zlib.crc32(wide[4 * a:4 * (a + m)]), n, sequence, offset))
                    a += m
            columns = zip(*out, strict=True) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *[pa.array(x, pa.int64()) for x in columns]],
                                             ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(cut, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
