"""Gradient boosting on binned features: leaf-wise trees from gradient histograms, kept as a table of nodes.

Features become at most 63 bins by quantiles, once; bin 0 is a missing value. A pass over the binned blocks gives
sums of gradients, curvatures and rows per (tree node, feature, bin); a task's sums are bounded by leaves x features x
bins, and of more than `GATHERED` tasks they are merged before they reach the driver. A tree grows best split first up to
`num_leaves` and `max_depth`; every pass evaluates all nodes that may still be chosen, so a tree takes one pass per
level rather than one per split, and of two children only the smaller is counted. Gradients are whole multiples of
2^-20, so sums don't depend on the order of tasks and reruns give the same trees.

Objectives: `l1` (sign gradients, leaves take the median of their residuals, to 1/128), `binary` (logistic) and
`softmax` (one tree per class and round).

Blocks are a table in the shared folder. Between passes they are kept by the executors with the scores of the newest
round; every `STORE_ROUNDS` rounds these are written to the shared folder, too, so a lost executor costs the rounds since. Where
all blocks fit one task (`LOCAL_BYTES`, checked), a merge has nothing to merge: the same grower runs next to the data,
for `LOCAL_ROUNDS` rounds a job.
"""

from __future__ import annotations

import math
import pickle
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emberline.session import new_folder, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BINS, SCALE, CELLS = 63, 1 << 20, 128
WIDTH = BINS + 2  # missing, the bins, and what lies above all of them
LOCAL_BYTES, LOCAL_ROUNDS, STORE_ROUNDS, MOST = 32 << 20, 100, 50, 1e9
TASK_BYTES, GATHERED, SCORED = 32 << 20, 32, 1 << 16


@dataclass(frozen=True)
class Settings:
    objective: str
    rounds: int
    learning_rate: float
    max_depth: int
    num_leaves: int
    min_child_samples: int
    reg_alpha: float
    reg_lambda: float


@dataclass
class Tree:
    """Node i tests bins[feature[i]] <= cut[i]; feature -1 is a leaf. Missing values go left where `missing_left`."""
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Leaf of every row of a (features, rows) array of bins."""
        at = np.zeros(bins.shape[1], np.int64)
        while True:
            rows = np.flatnonzero(self.feature[at] >= 0)
            if not len(rows):
                return at
            node = at[rows]
            b = bins[self.feature[node], rows]
            left = np.where(b == 0, self.missing_left[node], b <= self.cut[node])
            at[rows] = np.where(left, self.left[node], self.right[node])


@dataclass
class Growing(Tree):
    """A tree under growth, with the splits made since it was last shown and the nodes to count, by the grower's own numbers."""
    splits: list[tuple[int, int, int, bool, int, int]]
    nodes: list[int]


def gradients(objective: str, y: np.ndarray, w: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss, (trees, rows), as whole numbers."""
    if objective == "l1":
        g, h = np.sign(score - y) * w, np.broadcast_to(w, score.shape)
    elif objective == "binary":
        p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        g, h = (p - y) * w, p * (1 - p) * w
    else:
        p = np.exp(score - score.max(0))
        p /= p.sum(0)
        k = len(score)
        g, h = (p - (np.arange(k)[:, None] == y)) * w, k / (k - 1) * p * (1 - p) * w
    return np.rint(g * SCALE), np.rint(h * SCALE)


def histograms(bins: np.ndarray, slot: np.ndarray, n_slots: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Sums of g, h and rows by (slot, feature, bin); rows of slot -1 count nowhere."""
    rows = np.flatnonzero(slot >= 0)
    n = n_slots * len(bins) * WIDTH
    key = ((slot[rows] * len(bins))[None] + np.arange(len(bins))[:, None]) * WIDTH + bins[:, rows]
    flat = key.ravel()
    return np.stack([np.bincount(flat, np.tile(x, len(bins)), n) for x in (g[rows], h[rows], np.ones(len(rows)))], -1).reshape(n_slots, len(bins), WIDTH, 3)


def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return g if not alpha else np.sign(g) * np.maximum(np.abs(g) - alpha * SCALE, 0)


def _worth(g: np.ndarray, h: np.ndarray, s: Settings) -> np.ndarray:
    return _shrunk(g, s.reg_alpha) ** 2 / np.maximum(h + s.reg_lambda * SCALE, 1e-9)


def best_split(hist: np.ndarray, s: Settings) -> tuple[float, int, int, bool, np.ndarray] | None:
    """Gain, feature, cut, side of missing values and sums of the left side; None where nothing is gained. Ties go to the first."""
    total = hist[0].sum(0)
    # A feature with all rows in one bin has nothing to split.
    spread = np.flatnonzero((hist[..., 2] > 0).sum(1) > 1)
    if not len(spread):
        return None
    hist = hist[spread]
    left = np.cumsum(hist[:, 1:], axis=1)
    both = np.stack([left, left + hist[:, :1]])  # missing values right, left
    other = total - both
    gain = _worth(both[..., 0], both[..., 1], s) + _worth(other[..., 0], other[..., 1], s) - _worth(total[0], total[1], s)
    gain[np.minimum(both[..., 2], other[..., 2]) < max(1, s.min_child_samples)] = -np.inf
    best = int(gain.argmax())
    side, feature, cut = np.unravel_index(best, gain.shape)
    if not gain[side, feature, cut] > 1e-6 * SCALE:
        return None
    return float(gain[side, feature, cut]), int(spread[feature]), int(cut) + 1, bool(side), both[side, feature, cut]


class _Node:
    def __init__(self, depth: int, sums: np.ndarray, hist: np.ndarray | None, s: Settings) -> None:
        self.depth, self.sums, self.hist, self.kids = depth, sums, hist, None
        self.split = best_split(hist, s) if hist is not None and depth < s.max_depth else None


def _chosen(nodes: list[_Node], s: Settings) -> list[int]:
    """The splits that best-first growth makes, as far as the nodes are known; the first of equal gains is the older node."""
    open_, out = [0], []
    while open_ and len(out) < s.num_leaves - 1:
        open_.sort(key=lambda i: (-nodes[i].split[0] if nodes[i].split else np.inf, i))
        i = open_.pop(0)
        if not nodes[i].split:
            break
        out.append(i)
        open_ += nodes[i].kids or []
    return out


def _as_tree(nodes: list[_Node], inner: list[int], s: Settings) -> Tree:
    """The tree of the given splits; nodes that they leave out are gone."""
    order, place, inner = [0], {}, set(inner)
    for i in order:
        place[i] = len(place)
        order += nodes[i].kids if i in inner else []
    cells = [(*((nodes[i].split[1], nodes[i].split[2], nodes[i].split[3], place[nodes[i].kids[0]], place[nodes[i].kids[1]]) if i in inner else (-1, 0, False, 0, 0)),
              -float(_shrunk(nodes[i].sums[0], s.reg_alpha)) / max(nodes[i].sums[1] + s.reg_lambda * SCALE, 1e-9) * s.learning_rate) for i in order]
    return Tree(*(np.array(x) for x in zip(*cells, strict=True)))


def grow(s: Settings):
    """Yields (tree so far, nodes to count), takes the histograms of these nodes, and returns the tree."""
    hist = (yield Growing(*(np.array([x]) for x in (-1, 0, False, 0, 0, 0.0)), [], [0]), [0])[0]
    nodes, splits = [_Node(0, hist[0].sum(0), hist, s)], []
    while True:
        picked = _chosen(nodes, s)
        fresh = [i for i in picked if nodes[i].kids is None]
        if not fresh:
            return _as_tree(nodes, picked, s)
        count = []
        for i in fresh:
            left = nodes[i].split[4]
            sides = (left, nodes[i].sums - left)
            nodes[i].kids = [len(nodes), len(nodes) + 1]
            nodes += [_Node(nodes[i].depth + 1, x, None, s) for x in sides]
            splits.append((i, *nodes[i].split[1:4], *nodes[i].kids))
            if nodes[i].depth + 1 < s.max_depth:
                count.append((i, 0 if sides[0][2] <= sides[1][2] else 1))
        if count:
            inner = [i for i, x in enumerate(nodes) if x.kids]
            tree = Growing(*vars(_as_tree(nodes, inner, s)).values(), splits, [nodes[i].kids[side] for i, side in count])
            splits = []
            # In the tree so far nodes are numbered anew, breadth first from the root.
            order = [0]
            for i in order:
                order += nodes[i].kids or []
            found = yield tree, [order.index(nodes[i].kids[side]) for i, side in count]
            for (i, side), hist in zip(count, found, strict=True):
                small, large = nodes[i].kids[side], nodes[i].kids[1 - side]
                for at, x in ((small, hist), (large, nodes[i].hist - hist)):
                    nodes[at].hist = x
                    nodes[at].split = best_split(x, s)
                nodes[i].hist = None


class Shard:
    """Binned rows with labels, weights and scores."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray) -> None:
        self.bins, self.y, self.w, self.score = bins, y, w, score

    def add(self, trees: list[Tree]) -> None:
        for k, tree in enumerate(trees):
            self.score[k] += tree.value[tree.leaves(self.bins)]

    def count(self, s: Settings, asked: dict[int, tuple[Tree, list[int]]]) -> dict[int, np.ndarray]:
        g, h = gradients(s.objective, self.y, self.w, self.score)
        out = {}
        for k, (tree, wanted) in asked.items():
            slot = np.full(len(tree.feature), -1, np.int64)
            slot[wanted] = np.arange(len(wanted))
            out[k] = histograms(self.bins, slot[tree.leaves(self.bins)], len(wanted), g[k], h[k])
        return out

    def cells(self, tree: Tree) -> list[tuple[int, int, float, float]]:
        """Leaf, cell of the residual, weight and sum of the residuals there."""
        r = np.clip(self.y - self.score[0], -MOST, MOST)
        cell = (np.sign(r) * np.floor(np.log1p(np.abs(r)) * CELLS)).astype(np.int64)
        keys, at = np.unique(np.stack([tree.leaves(self.bins), cell]), axis=1, return_inverse=True)
        at = at.ravel()
        return list(zip(keys[0].tolist(), keys[1].tolist(), np.bincount(at, np.rint(self.w * SCALE)).tolist(), np.bincount(at, np.rint(r * self.w * SCALE)).tolist(), strict=True))


class Near(Shard):
    """Rows that stay with their grower: a round's gradients are taken once, and each node keeps its rows, so a pass
    splits and counts those of its nodes only."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray) -> None:
        super().__init__(bins, y, w, score)
        self.rows: dict[int, dict[int, np.ndarray]] = {}
        # The bin that most rows of a feature are in, if most are: its sums are what the others leave of the node's.
        self.usual = [int(n.argmax()) if 4 * n.max() > 3 * len(y) else -1 for n in (np.bincount(b, minlength=WIDTH) for b in bins)]

    def add(self, trees: list[Tree]) -> None:
        for k, tree in enumerate(trees):
            for leaf, rows in parted(tree, self.bins, np.flatnonzero(tree.feature < 0).tolist()).items():
                self.score[k][rows] += tree.value[leaf]
        self.rows = {}

    def count(self, s: Settings, asked: dict[int, tuple[Tree, list[int]]]) -> dict[int, np.ndarray]:
        if not self.rows:
            self.g, self.h = gradients(s.objective, self.y, self.w, self.score)
            self.rows = {k: {0: np.arange(len(self.y))} for k in asked}
        out = {}
        for k, (tree, _) in asked.items():
            rows = self.rows[k]
            for i, feature, cut, missing_left, *kids in tree.splits:
                own = rows.pop(i)
                b = self.bins[feature][own]
                left = (b <= cut) & (b > 0) | (b == 0) if missing_left else (b <= cut) & (b > 0)
                rows[kids[0]], rows[kids[1]] = own[left], own[~left]
            out[k] = np.stack([self._sums(rows[i], self.g[k], self.h[k]) for i in tree.nodes])
        return out

    def _sums(self, rows: np.ndarray, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        """`histograms` of one node. All sums are of whole numbers, so what is left of a total is exact."""
        if len(rows) < 2048:
            return histograms(self.bins[:, rows], np.zeros(len(rows), np.int64), 1, g[rows], h[rows])[0]
        every = len(rows) == len(g)
        g, h = (g, h) if every else (g[rows], h[rows])
        out, total = np.zeros((len(self.bins), WIDTH, 3)), (g.sum(), h.sum(), len(rows))
        # Rows are counted above the bits that the sum of curvatures needs, where a double has room for both.
        unit = 2.0 ** math.ceil(math.log2(total[1] + 1))
        packed = h + unit if unit * (len(rows) + 1) <= 1 << 53 else None
        for f, usual in enumerate(self.usual):
            b = self.bins[f] if every else self.bins[f][rows]
            other = np.flatnonzero(b != usual) if usual >= 0 else b
            if 4 * len(other) < len(b):
                b, own = b[other].astype(np.intp), [x if x is None else x[other] for x in (g, h, packed)]
            else:
                b, own, other = b.astype(np.intp), (g, h, packed), None
            out[f, :, 0] = np.bincount(b, own[0], WIDTH)
            if packed is None:
                out[f, :, 1], out[f, :, 2] = np.bincount(b, own[1], WIDTH), np.bincount(b, minlength=WIDTH)
            else:
                both = np.bincount(b, own[2], WIDTH)
                out[f, :, 2] = np.floor(both / unit)
                out[f, :, 1] = both - out[f, :, 2] * unit
            if other is not None:
                out[f, usual] = total - out[f].sum(0)
        return out


def parted(tree: Tree, bins: np.ndarray, wanted: list[int]) -> dict[int, np.ndarray]:
    """Rows of the wanted nodes, ascending; only branches that lead to one are followed. Children come after their parents."""
    towards, rows = set(wanted), {0: np.arange(bins.shape[1])}
    for i in reversed(range(len(tree.feature))):
        if tree.feature[i] >= 0 and not towards.isdisjoint((tree.left[i], tree.right[i])):
            towards.add(i)
    for i in range(len(tree.feature)):
        if i in towards and tree.feature[i] >= 0:
            own = rows.pop(i)
            b = bins[tree.feature[i]] if len(own) == bins.shape[1] else bins[tree.feature[i]][own]
            left = (b <= tree.cut[i]) & (b > 0) | (b == 0) if tree.missing_left[i] else (b <= tree.cut[i]) & (b > 0)
            for kid, side in ((tree.left[i], left), (tree.right[i], ~left)):
                if kid in towards:
                    rows[kid] = own[side]
    return rows


class Live(Near):
    """Rows as they are kept between passes, with the scores of the newest round; a pass looks up the rows of its nodes."""

    def __init__(self, bins: np.ndarray, y: np.ndarray, w: np.ndarray, score: np.ndarray, usual: list[int]) -> None:
        Shard.__init__(self, bins, y, w, score)
        self.usual = usual

    def kept(self) -> tuple:
        return self.bins, self.y, self.w, self.score, self.usual

    def count(self, s: Settings, asked: dict[int, tuple[Tree, list[int]]]) -> dict[int, np.ndarray]:
        g, h = gradients(s.objective, self.y, self.w, self.score)
        out = {}
        for k, (tree, wanted) in asked.items():
            rows = parted(tree, self.bins, wanted)
            out[k] = np.stack([self._sums(rows[i], g[k], h[k]) for i in wanted])
        return out


def _medians(tree: Tree, cells: list[tuple[int, int, float, float]], s: Settings) -> None:
    by_leaf: dict[int, list] = {}
    for leaf, cell, n, total in sorted(cells):
        by_leaf.setdefault(leaf, []).append((n, total))
    for leaf, rows in by_leaf.items():
        reached, half = 0.0, sum(n for n, _ in rows) / 2
        for n, total in rows:
            reached += n
            if reached >= half and n:
                tree.value[leaf] = total / n * s.learning_rate
                break


def one_round(data, s: Settings, k: int) -> list[Tree]:
    """The trees of a round, grown side by side: each pass counts what all of them ask for."""
    growers, trees = {i: grow(s) for i in range(k)}, [None] * k
    asked = {i: next(x) for i, x in growers.items()}
    while asked:
        found = data.count(s, asked)
        asked = {}
        for i, hist in found.items():
            try:
                asked[i] = growers[i].send(hist)
            except StopIteration as end:
                trees[i] = end.value
    if s.objective == "l1":
        _medians(trees[0], data.cells(trees[0]), s)
    data.add(trees)
    return trees


def _shard(batch: pa.RecordBatch, i: int, f: int, k: int) -> Shard:
    bins, y, w, score = (np.frombuffer(batch.column(j)[i].as_py(), t) for j, t in enumerate((np.uint8, np.float64, np.float64, np.float64)))
    return Shard(bins.reshape(f, -1), y, w, score.reshape(k, -1).copy())


def _row(x: Shard) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (x.bins, x.y, x.w, x.score)], ["bins", "y", "w", "score"])


BLOCKS = "bins binary, y binary, w binary, score binary"


def bin_edges(df: DataFrame, features: list[str], most: int = BINS) -> list[np.ndarray]:
    """Upper edges of each feature's bins: distinct quantiles, in one pass."""
    probs = [i / most for i in range(1, most + 1)]
    row = df.agg(*[F.percentile_approx(f, probs, 20_000).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [np.unique(np.array(x, np.float64)) if x else np.zeros(0) for x in row]


def binned(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """(features, rows) of raw values to bins: 0 where missing, else 1 + the edges below the value."""
    return np.stack([np.where(np.isnan(v), 0, 1 + np.searchsorted(e, v, "left")) for v, e in zip(values, edges, strict=True)]).astype(np.uint8)


class Blocks:
    """The binned rows as a table in the shared folder, to which `beside` adds the scores of its rounds on the fly. A pass of
    many tasks reads them as the executors keep them, one `Live` a task."""

    def __init__(self, df: DataFrame, features: list[str], edges: list[np.ndarray], base: np.ndarray, size: int = 0) -> None:
        self.spark, self.f, self.k, self.recent, self.size = df.sparkSession, len(features), len(base), [], size
        self.live, self.past, self.rounds = None, [], 0
        n = len(features)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    raw = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.float64) for i in range(n + 2)])
                    yield _row(Shard(binned(raw[:n], edges), raw[n], raw[n + 1], np.repeat(base[:, None], batch.num_rows, 1)))

        self.table = self._stored(df.mapInArrow(pack, BLOCKS))

    def _stored(self, df: DataFrame) -> DataFrame:
        folder = new_folder(self.spark, "boost-blocks")
        df.write.parquet(folder)
        return self.spark.read.schema(BLOCKS).parquet(folder)

    def _shards(self):
        recent, f, k = list(self.recent), self.f, self.k

        def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
            for batch in batches:
                for i in range(batch.num_rows):
                    x = _shard(batch, i, f, k)
                    for trees in recent:
                        x.add(trees)
                    yield x
        return shards

    def _live(self) -> RDD:
        if self.live is None:
            shards, sc = self._shards(), self.spark.sparkContext

            def whole(rows: Iterator) -> Iterator[tuple]:
                own = [x for row in rows for x in shards([pa.RecordBatch.from_pylist([row.asDict()])])]
                if own:
                    near = Near(*(np.concatenate([getattr(x, a) for x in own], axis=-1) for a in ("bins", "y", "w", "score")))
                    yield near.bins, near.y, near.w, near.score, near.usual

            if not sc.getCheckpointDir():
                sc.setCheckpointDir(shared_folder(self.spark))
            tasks = max(sc.defaultParallelism, -(-self.size // TASK_BYTES))
            self.live = self.table.repartition(tasks).rdd.mapPartitions(whole).persist(StorageLevel.MEMORY_AND_DISK)
        return self.live

    def _passed(self) -> None:
        """After a pass the newest scores are there, and those before them can go."""
        for x in self.past:
            x.unpersist()
        self.past = []

    def count(self, s: Settings, asked: dict[int, tuple[Tree, list[int]]]) -> dict[int, np.ndarray]:
        def partial(rows: Iterator[tuple]) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
            for x in rows:
                flat = {k: hist.reshape(-1, 3) for k, hist in Live(*x).count(s, asked).items()}
                yield {k: (used := np.flatnonzero(v[:, 2]), v[used].astype(np.int64)) for k, v in flat.items()}

        def merged(a: dict, b: dict) -> dict:
            out = {}
            for k in a:
                cells = np.union1d(a[k][0], b[k][0])
                sums = np.zeros((len(cells), 3), np.int64)
                for own, part in (a[k], b[k]):
                    sums[np.searchsorted(cells, own)] += part
                out[k] = cells, sums
            return out

        parts = self._live().mapPartitions(partial)
        found = [parts.treeReduce(merged)] if parts.getNumPartitions() > GATHERED else parts.collect()
        self._passed()
        out = {}
        for k, (_, wanted) in asked.items():
            hist = np.zeros((len(wanted) * self.f * WIDTH, 3), np.int64)
            for part in found:
                hist[part[k][0]] += part[k][1]
            out[k] = hist.reshape(len(wanted), self.f, WIDTH, 3).astype(np.float64)
        return out

    def cells(self, tree: Tree) -> list[tuple[int, int, float, float]]:
        def partial(rows: Iterator[tuple]) -> Iterator[tuple]:
            for x in rows:
                yield from (((leaf, cell), (int(n), int(total))) for leaf, cell, n, total in Live(*x).cells(tree))

        found = self._live().mapPartitions(partial).reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).collect()
        self._passed()
        return [(leaf, cell, float(n), float(total)) for (leaf, cell), (n, total) in found]

    def add(self, trees: list[Tree]) -> None:
        def added(x: tuple) -> tuple:
            rows = Live(*x)
            rows.add(trees)
            return rows.kept()

        self.past.append(self._live())
        self.live, self.rounds = self.live.map(added).persist(StorageLevel.MEMORY_AND_DISK), self.rounds + 1
        if self.rounds % STORE_ROUNDS == 0:
            self.live.checkpoint()

    def done(self) -> None:
        for x in [*self.past, self.live] if self.live else []:
            x.unpersist()

    def beside(self, s: Settings, rounds: int) -> list[list[Tree]]:
        """Some rounds in the one task that holds all blocks."""
        shards, k = self._shards(), self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = list(shards(batches))
            whole = Near(*(np.concatenate([getattr(x, a) for x in own], axis=-1) for a in ("bins", "y", "w", "score")))
            for _ in range(rounds):
                yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps([tuple(vars(x).values()) for x in one_round(whole, s, k)])], pa.binary())], ["trees"])

        return [[Tree(*x) for x in pickle.loads(r["trees"])] for r in self.table.coalesce(1).mapInArrow(run, "trees binary").collect()]


NODES = "tree int, output int, node int, feature string, threshold double, missing_left boolean, left int, right int, value double"


def fit(df: DataFrame, features: list[str], label: str, weight: str | None, s: Settings, base: np.ndarray, local_bytes: int = LOCAL_BYTES) -> DataFrame:
    """The node table of a model. Tree -1 holds each output's start value. Rows with a null label are left out.

    Thresholds are raw feature values, so the table needs no bins to be evaluated."""
    def number(name: str):
        return F.when(~F.isnan(F.col(name).cast("double")), F.col(name).cast("double"))

    rows = df.where(F.col(label).isNotNull()).select(*[number(f).alias(f"f{i}") for i, f in enumerate(features)], F.col(label).cast("double").alias("y"),
                                                     (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("w"))
    names, folder = [f"f{i}" for i in range(len(features))], new_folder(df.sparkSession, "boost-rows")
    rows.write.parquet(folder)  # read three times
    rows = df.sparkSession.read.schema(rows.schema).parquet(folder)
    edges = bin_edges(rows, names)
    size = rows.count() * (len(features) + 16 + 8 * len(base))
    blocks = Blocks(rows, names, edges, base, size)
    done: list[list[Tree]] = []
    while len(done) < s.rounds:
        if size <= local_bytes:
            new = blocks.beside(s, min(LOCAL_ROUNDS, s.rounds - len(done)))
            done += new
            blocks.recent += new
        else:
            done.append(one_round(blocks, s, len(base)))
    blocks.done()
    out = [(-1, k, 0, None, None, None, None, None, float(v)) for k, v in enumerate(base)]
    for t, trees in enumerate(done):
        for k, x in enumerate(trees):
            for i in range(len(x.feature)):
                j = int(x.feature[i])
                # Above the last edge only values unseen in training are found; they go with the last bin.
                out.append((t, k, i, features[j], float(edges[j][min(int(x.cut[i]), len(edges[j])) - 1]) if len(edges[j]) else 0.0, bool(x.missing_left[i]),
                            int(x.left[i]), int(x.right[i]), None) if j >= 0 else (t, k, i, None, None, None, None, None, float(x.value[i])))
    return df.sparkSession.createDataFrame(out, NODES)


def scores(df: DataFrame, model: DataFrame, into: str = "scores") -> DataFrame:
    """Adds the model's raw outputs, an array of double. The node table is bounded by rounds, outputs and leaves, and is broadcast."""
    nodes = model.select(*[x.split()[0] for x in NODES.split(", ")]).toPandas()
    used = sorted(nodes["feature"].dropna().unique())
    start = nodes[nodes["tree"] < 0].sort_values("output")["value"].to_numpy()
    trees = []
    for (_, k), x in nodes[nodes["tree"] >= 0].sort_values(["tree", "output", "node"]).groupby(["tree", "output"]):
        feature = np.array([-1 if v is None or v != v else used.index(v) for v in x["feature"]])
        leaf = feature < 0
        trees.append((int(k), feature, x["threshold"].fillna(0).to_numpy(np.float64), np.array([v is True or v == 1 for v in x["missing_left"]]),
                      x["left"].fillna(0).to_numpy(np.int64), x["right"].fillna(0).to_numpy(np.int64), np.where(leaf, x["value"].fillna(0).to_numpy(np.float64), 0.0)))
    shared = df.sparkSession.sparkContext.broadcast((start, trees))

    def evaluate(values: np.ndarray) -> np.ndarray:
        start, trees = shared.value
        out, missing = np.repeat(start[:, None], values.shape[1], 1), np.isnan(values)
        for k, feature, threshold, missing_left, left, right, value in trees:
            rows = {0: np.arange(values.shape[1])}  # of each node; children come after their parents
            for i, f in enumerate(feature):
                own = rows.pop(i)
                if f < 0:
                    out[k][own] += value[i]
                else:
                    side = values[f][own] <= threshold[i]
                    if missing_left[i]:
                        side |= missing[f][own]
                    rows[left[i]], rows[right[i]] = own[side], own[~side]
        return out

    def together(frames: list[pd.DataFrame]) -> Iterator[pd.Series]:
        values = np.concatenate([x[used].to_numpy(np.float64, na_value=np.nan).T if used else np.zeros((0, len(x))) for x in frames], axis=1)
        done = list(evaluate(np.ascontiguousarray(values)).T)
        for x in frames:
            yield pd.Series(done[:len(x)])
            done = done[len(x):]

    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        frames: list[pd.DataFrame] = []
        for batch in batches:
            frames.append(batch)
            if sum(map(len, frames)) >= SCORED:
                yield from together(frames)
                frames = []
        if frames:
            yield from together(frames)

    given = F.struct(*[F.col(f).cast("double").alias(f) for f in used]) if used else F.struct(F.lit(0.0).alias("none"))
    return df.withColumn(into, run(given))
