"""Vector codes by Lloyd's rounds over cover trees: subtrees go to an entry as a whole where the triangle inequality allows.

Vectors of whole numbers are cut into equal parts, and each part position has a codebook that rounds of assignment and
floored means improve. Each task builds, once, a cover tree for each part of a chunk of its vectors: a node is a point
and a radius that holds all points below it, its children lie within half its reach, and points are laid out so that a
subtree is a range. Cumulative sums over that order give the sum of any subtree. A round walks a tree from its top:
where the nearest entry of a node's point is nearer than the next one by more than two radii, it is the nearest of the
whole subtree; only the other nodes descend, and leaves compare their points exactly. Distances are whole numbers, so
ties go to the lower index; the test on radii has a margin for square roots, so rounding only makes it descend.

Scale. Trees are written once and read in each round; a task adds up its chunks, so a round shuffles at most one row
per part, entry and task, and returns parts x entries rows to the driver, whatever the number of vectors. Equal
vectors are one node of radius zero. Errors by label are summed before the shuffle and joined back with salted keys.

Defined results: vectors that are null or hold null or non-finite components are dropped, as are those whose length
isn't that of the kept vector with the smallest id, or not a positive multiple of the number of parts. The first
entries are those of the smallest ids (null ids last, repeated ids by vector); with fewer kept vectors there are fewer
entries. Components beyond `bound` (92,681 at 8 components a part) count as that bound: sums of squares stay whole numbers
of 64 bits. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
CHUNK, LEAF = 2048, 8
SALTS = 16
_MARGIN = 1e-9


def bound(width: int) -> int:
    """Largest magnitude of a whole component, so that `width` squared differences add up to 2^62 at most."""
    return int(2 ** 30 / math.sqrt(max(1, width)))


@dataclass
class CoverTree:
    """Points in the order of the tree; node i holds the points [start, end), its children are nodes [child, child + n_child)."""

    order: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    start: np.ndarray
    end: np.ndarray
    child: np.ndarray
    n_child: np.ndarray


def _distance(points: np.ndarray, one: np.ndarray) -> np.ndarray:
    step = points - one
    return np.sqrt(np.einsum("ij,ij->i", step, step).astype(np.float64))


def cover_tree(points: np.ndarray, leaf: int = LEAF) -> CoverTree:
    """Level by level: a node's points are covered by balls of half its reach around some of them, the node's own first."""
    order = np.arange(len(points))
    center, radius, start, end, child, n_child = [0], [0.0], [0], [len(points)], [0], [0]
    at = 0
    far = [_distance(points, points[0])] if len(points) else [np.zeros(0)]  # of each node's points from its center
    while at < len(center):
        a, b, away = start[at], end[at], far[at]
        far[at] = None
        radius[at] = float(away.max()) if b > a else 0.0
        if b - a > leaf and radius[at] > 0:
            own, reach = order[a:b], radius[at] / 2
            left = away > reach
            groups = [(center[at], own[~left], away[~left])]
            own = own[left]
            while len(own):
                d = _distance(points[own], points[own[0]])
                near = d <= reach
                groups.append((int(own[0]), own[near], d[near]))
                own = own[~near]
            child[at], n_child[at] = len(center), len(groups)
            for c, members, d in groups:
                order[a:a + len(members)] = members
                center.append(c)
                start.append(a)
                end.append(a + len(members))
                far.append(d)
                radius.append(0.0)
                child.append(0)
                n_child.append(0)
                a += len(members)
        at += 1
    return CoverTree(order, np.array(center, np.int64), np.array(radius), np.array(start, np.int64), np.array(end, np.int64),
                     np.array(child, np.int64), np.array(n_child, np.int64))


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole numbers, points x entries."""
    out = np.zeros((len(points), len(entries)), np.int64)
    for j in range(points.shape[1]):
        step = points[:, j, None] - entries[None, :, j]
        out += step * step
    return out


def assign(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray, np.ndarray]:
    """Ranges (start, end, entry) of subtrees that go as a whole, and the places (in the tree's order) and entries of the other points."""
    ranges, places, chosen = [], [], []
    nodes = np.zeros(min(1, len(points)), np.int64)
    while len(nodes):
        d = _squares(points[tree.center[nodes]], entries)
        best = d.argmin(1)
        root = np.sqrt(d.astype(np.float64))
        nearest = root[np.arange(len(nodes)), best]
        root[np.arange(len(nodes)), best] = np.inf
        sure = root.min(1) * (1 - _MARGIN) > nearest * (1 + _MARGIN) + 2 * tree.radius[nodes] * (1 + _MARGIN)
        sure |= tree.radius[nodes] == 0  # equal points have the answer of their center
        ranges.append((tree.start[nodes[sure]], tree.end[nodes[sure]], best[sure]))
        rest = nodes[~sure]
        leaves, inner = rest[tree.n_child[rest] == 0], rest[tree.n_child[rest] > 0]
        if len(leaves):
            place = _spread(tree.start[leaves], tree.end[leaves] - tree.start[leaves])
            places.append(place)
            chosen.append(_squares(points[tree.order[place]], entries).argmin(1))
        nodes = _spread(tree.child[inner], tree.n_child[inner])
    none = np.zeros(0, np.int64)
    return ranges, np.concatenate([none, *places]), np.concatenate([none, *chosen])


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[i], first[i] + 1, ... n[i] values of each."""
    before = np.cumsum(n) - n
    return np.arange(int(n.sum())) + np.repeat(first - before, n)


def sums(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Count and componentwise sum of the points of each entry; whole subtrees by cumulative sums."""
    below = np.zeros((len(points) + 1, points.shape[1]), np.int64)
    np.cumsum(points[tree.order], axis=0, out=below[1:])
    count, total = np.zeros(len(entries), np.int64), np.zeros((len(entries), points.shape[1]), np.int64)
    ranges, places, chosen = assign(tree, points, entries)
    for a, b, entry in ranges:
        np.add.at(count, entry, b - a)
        np.add.at(total, entry, below[b] - below[a])
    np.add.at(count, chosen, 1)
    np.add.at(total, chosen, points[tree.order[places]])
    return count, total


def codes(tree: CoverTree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry of each point and its squared distance."""
    out = np.zeros(len(points), np.int64)
    ranges, places, chosen = assign(tree, points, entries)
    for a, b, entry in ranges:
        out[tree.order[_spread(a, b - a)]] = np.repeat(entry, b - a)
    out[tree.order[places]] = chosen
    step = points - entries[out]
    return out, (step * step).sum(1)


def whole_vectors(vectors: DataFrame, parts: int, scale: int) -> DataFrame:
    """vec_id, label, v: the kept vectors as whole numbers."""
    kept = (vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
            .where("v is not null and not exists(v, x -> x is null or isnan(x) or abs(x) = double('inf'))"))
    smallest = kept.select(F.col("vec_id").isNull().alias("last"), "vec_id", "v").orderBy("last", "vec_id", "v").limit(1).select(F.size("v").alias("n")).collect()
    length = smallest[0]["n"] if smallest else 0
    if length == 0 or length % parts:
        return kept.where("false").select("vec_id", "label", F.col("v").cast("array<long>").alias("v"))
    most = bound(length // parts)
    held = F.transform("v", lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), F.floor(F.greatest(F.lit(-2.0 ** 40), F.least(F.lit(2.0 ** 40), x)) * scale))))
    return kept.where(F.size("v") == length).select("vec_id", "label", held.alias("v"))


TREES = "ids array<long>, labels array<long>, points binary, trees array<binary>"
_FIELDS = (("order", np.int32), ("center", np.int32), ("radius", np.float64), ("start", np.int32), ("end", np.int32), ("child", np.int32), ("n_child", np.int32))


def _packed(tree: CoverTree) -> bytes:
    head = np.array([len(tree.order), len(tree.center)], np.int64).tobytes()
    return head + b"".join(getattr(tree, name).astype(kind).tobytes() for name, kind in _FIELDS)


def _unpacked(data: bytes) -> CoverTree:
    n, m = np.frombuffer(data, np.int64, 2).tolist()
    at, fields = 16, []
    for name, kind in _FIELDS:
        size = n if name == "order" else m
        fields.append(np.frombuffer(data, kind, size, at).astype(np.float64 if kind is np.float64 else np.int64))
        at += size * np.dtype(kind).itemsize
    return CoverTree(*fields)


def plant(whole: DataFrame, parts: int, chunk: int) -> DataFrame:
    """A row per chunk of a task's vectors: ids, labels, points and the cover tree of each part."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, chunk):
                some = batch.slice(at, chunk)
                points = some.column(2).flatten().to_numpy().reshape(some.num_rows, -1)
                trees = [_packed(cover_tree(np.ascontiguousarray(x))) for x in np.split(points, parts, axis=1)]
                yield pa.RecordBatch.from_arrays([
                    pa.array([some.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([some.column(1).to_pylist()], pa.list_(pa.int64())),
                    pa.array([points.astype(np.int32).tobytes()], pa.binary()), pa.array([trees], pa.list_(pa.binary()))], ["ids", "labels", "points", "trees"])

    return whole.select("vec_id", F.col("label").cast("long"), "v").mapInArrow(build, TREES)


def _chunks(batches: Iterator[pa.RecordBatch], parts: int):
    """ids, labels and for each part its tree and points, a chunk at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            ids, labels, points, trees = (batch.column(j)[i] for j in range(4))
            n = len(ids)
            whole = np.frombuffer(points.as_py(), np.int32).reshape(n, -1).astype(np.int64)
            yield ids.values, labels.values, [(_unpacked(t), np.ascontiguousarray(x)) for t, x in zip(trees.as_py(), np.split(whole, parts, axis=1), strict=True)]


def improve(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: entries become the floored means of their parts; unused ones stay. At most parts x entries rows come back."""
    parts, entries, width = books.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, _, own in _chunks(batches, parts):
            for p, (tree, points) in enumerate(own):
                n, s = sums(tree, points, books[p])
                count[p] += n
                total[p] += s
        p, e, j = (x.ravel() for x in np.indices(total.shape))
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in ((p, pa.int32()), (e, pa.int32()), (j, pa.int32()), (total.ravel(), pa.int64()), (count[p, e], pa.int64()))],
                                         ["p", "e", "j", "total", "n"])

    rows = (trees.mapInArrow(add, "p int, e int, j int, total long, n long").where("n > 0").groupBy("p", "e", "j")
            .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")).collect())
    new = books.copy()
    for r in rows:
        new[r["p"], r["e"], r["j"]] = int(r["total"]) // r["n"]
    return new


def digest(books: np.ndarray) -> str:
    """All components in decimal, by part, entry and place, joined by commas; as lowercase hex of SHA-256."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


CODES = "vec_id long, label long, code string, error long"


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code, error of every kept vector, and the codebooks (parts x entries x components)."""
    whole = whole_vectors(vectors, parts, scale)
    # The first entries: `entries` rows, by a top-n per task.
    first = [r["v"] for r in whole.select(F.col("vec_id").isNull().alias("last"), "vec_id", "v").orderBy("last", "vec_id", "v").limit(entries).collect()]
    if not first:
        return whole.sparkSession.createDataFrame([], CODES), np.zeros((parts, 0, 0), np.int64)
    books = np.array(first, np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)
    trees = stored(plant(whole, parts, chunk), "cover-trees")
    for _ in range(rounds):
        books = improve(trees, books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, labels, own in _chunks(batches, parts):
            found = [codes(tree, points, books[p]) for p, (tree, points) in enumerate(own)]
            code = np.stack([c for c, _ in found], axis=1).astype(np.uint8)
            error = sum(e for _, e in found)
            yield pa.RecordBatch.from_arrays([ids, labels, pa.array([x.tobytes().hex() for x in code], pa.string()), pa.array(error)],
                                             ["vec_id", "label", "code", "error"])

    return stored(trees.mapInArrow(encode, CODES), "codes"), books


def with_label_errors(coded: DataFrame, salts: int = SALTS) -> DataFrame:
    """Adds label_error, the sum over equal labels (nulls are one label). A frequent label's rows are spread over `salts` keys."""
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors")
    right = totals.select(F.col("label").alias("__label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("__salt"))
    left = coded.withColumn("__own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(salts)).cast("int"))
    return left.join(right, F.col("label").eqNullSafe(F.col("__label")) & (F.col("__own") == F.col("__salt"))).drop("__label", "__own", "__salt")


def vector_codes(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the codebooks."""
    coded, books = compress(vectors)
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
