"""Boosted trees against plain versions of each step."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.operators import boosting as B
from emberline.operators import learning as N

SETTINGS = B.Settings("l1", 6, 0.3, 4, 7, 3, 0.1, 0.1)


def rows(n=400, seed=1, features=3):
    draw = np.random.default_rng(seed)
    x = np.round(draw.normal(size=(features, n)), 1)
    x[1, draw.random(n) < 0.2] = np.nan
    y = np.where(np.isnan(x[1]), 5, np.where(x[0] > 0.3, 3.0, 0.0)) + np.round(draw.normal(size=n), 1)
    return x, y


def frame(spark, x, y, parts=3):
    data = [(*[None if np.isnan(v) else float(v) for v in c], float(t)) for *c, t in zip(*x, y)]
    return spark.createDataFrame(data, ", ".join(f"x{i} double" for i in range(len(x))) + ", y double").repartition(parts)


def by_hand(bins, g, h, s):
    """Best-first growth, one split at a time, each node counted anew. Returns the rows of each leaf."""
    def split(own):
        best = None
        for side in (False, True):
            for f in range(len(bins)):
                for cut in range(1, B.WIDTH):
                    b = bins[f, own]
                    left = np.where(b == 0, side, b <= cut)
                    if min(left.sum(), (~left).sum()) < s.min_child_samples:
                        continue
                    gain = sum(float(B._worth(g[m].sum(), h[m].sum(), s)) for m in (own[left], own[~left])) - float(B._worth(g[own].sum(), h[own].sum(), s))
                    if gain > 1e-6 * B.SCALE and (best is None or gain > best[0] * (1 + 1e-12)):
                        best = (gain, own[left], own[~left])
        return best

    leaves = [(0, np.arange(bins.shape[1]))]
    while len(leaves) < s.num_leaves:
        found = [(x[0], i, x) for i, (d, own) in enumerate(leaves) if d < s.max_depth and (x := split(own))]
        if not found:
            break
        _, i, (_, left, right) = max(found, key=lambda x: x[0])
        d = leaves.pop(i)[0]
        leaves += [(d + 1, left), (d + 1, right)]
    return sorted(tuple(own.tolist()) for _, own in leaves)


@pytest.mark.parametrize(("seed", "depth", "leaves"), [(1, 4, 7), (2, 3, 31), (3, 6, 4), (4, 1, 31)])
def test_a_tree_grows_best_split_first(seed, depth, leaves):
    x, y = rows(200, seed)
    bins = B.binned(x, [np.unique(v[~np.isnan(v)])[::3] for v in x])
    s = B.Settings("l1", 1, 1.0, depth, leaves, 5, 0.1, 0.1)
    data = B.Shard(bins, y, np.ones(200), np.full((1, 200), np.median(y)))
    g, h = B.gradients("l1", data.y, data.w, data.score)
    tree = B.one_round(data, s, 1)[0]
    at = tree.leaves(bins)
    assert sorted(tuple(np.flatnonzero(at == i).tolist()) for i in np.unique(at)) == by_hand(bins, g[0], h[0], s)
    for i in np.unique(at):  # leaves hold medians of residuals, to a cell
        left = np.sort(y[at == i] - np.median(y))
        assert left[(len(left) - 1) // 2] - 0.05 <= tree.value[i] <= left[len(left) // 2] + 0.05


def test_gradients_are_slopes_of_the_losses():
    draw = np.random.default_rng(5)
    y, w, score = np.array([0, 1, 2, 1.0]), np.array([1, 2, 0.5, 1.0]), draw.normal(size=(3, 4))

    def softmax_loss(score):
        return float((-w * np.log(np.exp(score)[y.astype(int), np.arange(4)] / np.exp(score).sum(0))).sum())

    g, _ = B.gradients("softmax", y, w, score)
    for k in range(3):
        for i in range(4):
            step = np.zeros((3, 4))
            step[k, i] = 1e-5
            assert abs((softmax_loss(score + step) - softmax_loss(score - step)) / 2e-5 - g[k, i] / B.SCALE) < 1e-4
    one, z = score[:1], np.array([0, 1, 1, 0.0])
    g, h = B.gradients("binary", z, w, one)
    p = 1 / (1 + np.exp(-one[0]))
    assert np.allclose(g[0] / B.SCALE, w * (p - z), atol=1e-5) and np.allclose(h[0] / B.SCALE, w * p * (1 - p), atol=1e-5)


@pytest.mark.parametrize("objective", ["l1", "binary", "softmax"])
def test_one_task_and_many_give_the_same_trees(spark, monkeypatch, objective):
    monkeypatch.setattr(B, "STORE_ROUNDS", 2)
    x, y = rows()
    k = 3 if objective == "softmax" else 1
    label = y if objective == "l1" else (y > 2).astype(float) + (y > 4) * (k > 1)
    s = B.Settings(objective, 5, 0.3, 4, 7, 3, 0.1, 0.1)
    df = frame(spark, x, label)
    one, many = (sorted(map(tuple, B.fit(df, ["x0", "x1", "x2"], "y", None, s, np.zeros(k), size).collect()), key=str) for size in (1 << 30, 0))
    assert one == many and max(r[0] for r in one) == 4


def test_node_table_scores_as_the_trees_do(spark):
    x, y = rows(300)
    df = frame(spark, x, y, 1)
    model = B.fit(df, ["x0", "x1", "x2"], "y", None, SETTINGS, np.array([1.5]))
    edges = B.bin_edges(df.select(*[F.col(c).alias(c) for c in ("x0", "x1", "x2")]), ["x0", "x1", "x2"])
    data = B.Shard(B.binned(x, edges), y, np.ones(300), np.full((1, 300), 1.5))
    for _ in range(SETTINGS.rounds):
        B.one_round(data, SETTINGS, 1)
    got = [r["scores"][0] for r in B.scores(df, model).collect()]
    assert np.allclose(sorted(got), sorted(data.score[0]), atol=1e-9)
    assert np.abs(data.y - data.score[0]).mean() < 0.5 * np.abs(data.y - 1.5).mean()
    # Values never seen and missing everywhere are scored, too.
    odd = spark.createDataFrame([(1e9, None, -1e9), (None, None, None), (float("nan"), 2.0, 0.0)], "x0 double, x1 double, x2 double")
    assert all(np.isfinite(r["scores"][0]) for r in B.scores(odd, model).collect())


def test_models_are_stored_and_chosen_by_stage(spark, tmp_path):
    x, y = rows(200)
    df = frame(spark, x, y).withColumnsRenamed({"y": "hotspot_count_tomorrow"}).withColumn("risk_level", F.when(F.col("hotspot_count_tomorrow") > 2, 2).otherwise(1))
    params = N.TrainParams(n_estimators=8, learning_rate=0.3, min_child_samples=5)
    folder = str(tmp_path / "models")
    regressor, classifier = N.train_regressor(df, params, ["x0", "x1", "x2"]), N.train_classifier(df, params, ["x0", "x1", "x2"])
    N.save_model(regressor, folder, "a")
    N.save_model(classifier, folder, "b")
    assert classifier.objective == "binary" and classifier.classes == (1, 2)
    models = spark.read.parquet(folder)
    versions = spark.createDataFrame([("m", 1, "Production", "b"), ("m", 9, "Production", "a"), ("m", 10, "Staging", "b"), ("c", 1, "Production", "b")],
                                     "name string, version int, stage string, run_id string")
    chosen = N.staged_model(models, versions, "m")
    assert chosen.objective == "l1" and sorted(map(tuple, chosen.nodes.collect()), key=str) == sorted(map(tuple, regressor.nodes.collect()), key=str)
    rated = N.score(N.staged_model(models, versions, "c"), df)
    assert {r["prediction"] for r in rated.collect()} == {1.0, 2.0} and rated.where("prediction = risk_level").count() > 180
    for name, stage in (("m", "Archived"), ("x", "Production")):
        with pytest.raises(ValueError, match="no version"):
            N.staged_model(models, versions, name, stage)


@pytest.mark.parametrize(("objective", "k"), [("softmax", 3), ("binary", 1), ("l1", 1)])
def test_rows_kept_by_node_give_the_same_trees_from_fewer_rows(objective, k, monkeypatch):
    """train_classifier beside its data: a pass works on the rows of its nodes, and a round takes its gradients once."""
    r = np.random.default_rng(5)
    bins = r.integers(0, 64, (6, 5000)).astype(np.uint8)
    bins[:3][r.random((3, 5000)) < 0.97] = 0  # mostly missing
    base = bins[3].astype(int) + bins[4] + r.integers(0, 60, 5000)
    y = {"softmax": (base > 70) + (base > 110) * 1.0, "binary": (base > 80) * 1.0, "l1": base / 7}[objective]
    w = np.where(y == 0, 0.7, 1.9)
    s = B.Settings(objective, 4, 0.1, 6, 12, 20, 0.0, 0.0)
    taken, gradients = [], B.gradients
    monkeypatch.setattr(B, "gradients", lambda *a: taken.append(1) or gradients(*a))
    plain, near = (kind(bins, y, w, np.zeros((k, 5000))) for kind in (B.Shard, B.Near))
    want = [B.one_round(plain, s, k) for _ in range(4)]
    taken.clear()
    got = [B.one_round(near, s, k) for _ in range(4)]
    assert len(taken) == 4 and any(len(t.feature) > 9 for x in got for t in x)
    for a, b in zip((t for x in want for t in x), (t for x in got for t in x), strict=True):
        assert all(np.array_equal(p, q) for p, q in zip(vars(a).values(), vars(b).values(), strict=True))
    assert np.array_equal(plain.score, near.score)


@pytest.mark.parametrize(("objective", "k"), [("softmax", 3), ("binary", 1), ("l1", 1)])
def test_rows_kept_between_passes_give_the_same_trees(objective, k):
    """train_classifier by many tasks: a pass looks up the rows of its nodes only and works on the newest scores."""
    r = np.random.default_rng(6)
    bins = r.integers(0, 64, (6, 9000)).astype(np.uint8)
    bins[:2][r.random((2, 9000)) < 0.95] = 0  # mostly missing
    bins[2] = 7
    base = bins[3].astype(int) + bins[4] + r.integers(0, 60, 9000)
    y = {"softmax": (base > 70) + (base > 110) * 1.0, "binary": (base > 80) * 1.0, "l1": base / 7}[objective]
    w = np.where(y == 0, 0.7, 190.0)
    s = B.Settings(objective, 4, 0.1, 6, 12, 20, 0.0, 0.0)
    plain = B.Shard(bins, y, w, np.zeros((k, 9000)))
    kept = B.Live(bins, y, w, np.zeros((k, 9000)), B.Near(bins, y, w, np.zeros((k, 9000))).usual)
    for _ in range(4):
        for a, b in zip(B.one_round(plain, s, k), B.one_round(kept, s, k), strict=True):
            assert all(np.array_equal(p, q) for p, q in zip(vars(a).values(), vars(b).values(), strict=True))
        kept = B.Live(*kept.kept())
    assert np.array_equal(plain.score, kept.score)


def test_a_pass_of_many_tasks_is_one_job(spark, monkeypatch):
    """train_classifier: each pass was a query with a shuffle of its own."""
    x, y = rows(600)
    df, names = frame(spark, x, (y > 2) * 1.0), ["x0", "x1", "x2"]
    s = B.Settings("binary", 3, 0.3, 4, 7, 3, 0.0, 0.0)
    one = sorted(map(tuple, B.fit(df, names, "y", None, s, np.zeros(1)).collect()), key=str)
    passes, count, sc = [], B.Blocks.count, spark.sparkContext

    def counted(self, *a):
        sc.setJobGroup(f"pass-{id(passes)}-{len(passes)}", "")
        out = count(self, *a)
        passes.append(len(sc.statusTracker().getJobIdsForGroup(f"pass-{id(passes)}-{len(passes)}")))
        sc.setLocalProperty("spark.jobGroup.id", None)
        return out

    monkeypatch.setattr(B.Blocks, "count", counted)
    many = sorted(map(tuple, B.fit(df, names, "y", None, s, np.zeros(1), 0).collect()), key=str)
    assert one == many and len(passes) > 3
    assert set(passes[1:]) == {1}, passes  # the first one also puts the rows in place
    monkeypatch.setattr(B, "GATHERED", 0)  # as of many tasks: merged before they reach the driver
    assert one == sorted(map(tuple, B.fit(df, names, "y", None, s, np.zeros(1), 0).collect()), key=str)


def test_scores_do_not_depend_on_batches(spark, monkeypatch):
    x, y = rows(300)
    df = frame(spark, x, y, 1)
    model = B.fit(df, ["x0", "x1", "x2"], "y", None, SETTINGS, np.array([1.5]))
    want = [r["scores"] for r in B.scores(df, model).collect()]
    monkeypatch.setattr(B, "SCORED", 50)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        assert want == [r["scores"] for r in B.scores(df, model).collect()] and len(want) == 300
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
