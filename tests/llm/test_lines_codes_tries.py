"""Line dedup, vector codes and the prefix trie against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import line_dedup, prefix_trie, vector_codes

from .conftest import prose

SPACE = " \t\n\v\f\r"


def lines_by_hand(rows, min_chars=20, min_docs=3):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))

    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if doc is not None and len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if doc is None or len(holders.get(key(x), ())) < min_docs or max(holders[key(x)]) == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest(), "\n".join(kept)))
    return sorted(out, key=str)


def line_rows():
    draw = random.Random(3)
    shared = [prose(i, 9) for i in range(6)] + ["x" * 19, "x" * 20, "ÄÖÜ äöü " * 3, "你好，世界" * 5, "Ünïcode line of text \U0001f600"]
    rows = [(None, "\n".join(shared)), (1, None), (2, ""), (3, "\n"), (4, "\n\n" + shared[0]), (5, shared[0] + "\n"), (6, "\t " + shared[0].upper() + "\r\n")]
    for i in range(60):
        own = [draw.choice(shared) if draw.random() < 0.5 else prose(100 + i * 9 + j, 8) for j in range(draw.randint(0, 9))]
        rows.append((10 + i, "\n".join(draw.choice(["", " ", "\v"]) + x + draw.choice(["", "\r", "\f "]) for x in own)))
    rows += [rows[20], (rows[20][0], rows[21][1]), (200, "\n".join([shared[1]] * 4)), (201, "\n".join(prose(900 + i, 30) for i in range(3000)) + "\n" + shared[2])]
    return rows


def test_lines_as_by_hand(spark):
    rows = line_rows()
    docs = spark.createDataFrame([(d, t, "h1", 1, "g") for d, t in rows], "doc_id long, text string, h1 string, ids int, __x string").repartition(3)
    got = line_dedup.drop_shared_lines(docs, ["doc_id", "h1", "ids"], with_text=True)
    assert got.columns == ["doc_id", "h1", "ids", "n_lines", "n_dropped", "kept_sha256", "kept_text"]
    assert sorted([tuple(r) for r in got.drop("h1", "ids").collect()], key=str) == lines_by_hand(rows)
    some = line_dedup.drop_shared_lines(docs, ["doc_id"], with_text=True, min_chars=1, min_docs=2)
    assert sorted([tuple(r) for r in some.collect()], key=str) == lines_by_hand(rows, 1, 2)


def test_lines_of_odd_and_no_rows(odd, empty):
    got = line_dedup.drop_shared_lines(odd, ["doc_id"], with_text=True)
    want = lines_by_hand([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert sorted([tuple(r) for r in got.collect()], key=str) == want
    assert line_dedup.drop_shared_lines(empty, ["doc_id"], with_text=False).count() == 0


def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    kept = [(i, x, v) for i, x, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept or not len(kept[0][2]) or len(kept[0][2]) % parts:
        return [], None
    kept = [(i, x, [int(np.floor(4096 * c)) for c in v]) for i, x, v in kept if len(v) == len(kept[0][2])]
    w = len(kept[0][2]) // parts
    points = [np.array([v[p * w:(p + 1) * w] for _, _, v in kept], dtype=object) for p in range(parts)]
    books, found = [x[:entries].copy() for x in points], None
    for i in range(rounds + 1):
        far = [((x[:, None] - b[None]) ** 2).sum(2) for x, b in zip(points, books)]
        found = [np.array([min(range(len(r)), key=lambda e: (r[e], e)) for r in d]) for d in far]
        if i < rounds:
            for x, b, f in zip(points, books, found):
                for e in range(len(b)):
                    if (f == e).any():
                        b[e] = x[f == e].sum(0) // int((f == e).sum())
    error = [sum(int(d[i, f[i]]) for d, f in zip(far, found)) for i in range(len(kept))]
    totals = {}
    for (_, label, _), e in zip(kept, error):
        totals[label] = totals.get(label, 0) + e
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted([(r[0], "".join(f"{int(f[i]):02x}" for f in found), error[i], totals[r[1]], digest) for i, r in enumerate(kept)], key=str), digest


def vector_rows(n, width=2, seed=1):
    draw = random.Random(seed)
    rows = [(i, draw.choice([None, 1, 2]), [draw.gauss(0, 0.2) for _ in range(8 * width)]) for i in range(n)]
    rows += [(n + i, 2, rows[5][2]) for i in range(40)]  # copies
    rows += [(n + 50, 1, None), (n + 51, 1, [None] + [0.0] * (8 * width - 1)), (n + 52, 1, [float("nan")] * 8 * width), (n + 53, 1, [float("inf")] * 8 * width),
             (n + 54, 1, []), (n + 55, 1, [1.0] * 8), (None, 1, [0.5] * 8 * width), (3, 1, [0.25] * 8 * width), (n + 56, None, [-0.0001] * 8 * width)]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>"


def in_floats(rows):
    return [(i, x, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, x, v in rows]


@pytest.mark.parametrize("n", [9, 300])
def test_codes_as_by_hand(spark, n):
    rows = in_floats(vector_rows(n))
    table = spark.createDataFrame(rows, VECTORS).withColumn("error", F.lit("x")).repartition(3)
    got = vector_codes.vector_codes(table)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == codes_by_hand(rows)[0]


def test_codes_of_small_chunks(spark):
    rows = in_floats(vector_rows(200, width=3, seed=2))
    coded, books = vector_codes.compress(spark.createDataFrame(rows, VECTORS).repartition(2), chunk=37)
    want, digest = codes_by_hand(rows)
    assert vector_codes.digest(books) == digest and coded.count() == len(want)
    assert sorted([r["error"] for r in coded.collect()]) == sorted(x[2] for x in want)


def test_codes_without_vectors(spark):
    for rows in ([], [(1, 1, None)], [(1, 1, [])], [(1, 1, [1.0, 2.0])]):
        assert vector_codes.vector_codes(spark.createDataFrame(rows, VECTORS)).count() == 0
    one = vector_codes.vector_codes(spark.createDataFrame([(7, None, [3e38] * 8)], VECTORS)).collect()
    assert [(r["code"], r["error"], r["label_error"]) for r in one] == [("00" * 8, 0, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_cover_tree_holds_its_points_and_whole_subtrees_go_right(seed):
    draw = np.random.default_rng(seed)
    centers = draw.integers(-4000, 4000, (6, 4))
    points = centers[draw.integers(0, 6, 500)] + draw.integers(-30, 30, (500, 4)) * (seed > 0)
    tree = vector_codes.cover_tree(points, leaf=4)
    assert sorted(tree.order) == list(range(500))
    for i in range(len(tree.center)):
        inside = points[tree.order[tree.start[i]:tree.end[i]]]
        assert np.sqrt(((inside - points[tree.center[i]]) ** 2).sum(1)).max() <= tree.radius[i] * (1 + 1e-12)
        if tree.n_child[i]:
            kids = range(tree.child[i], tree.child[i] + tree.n_child[i])
            assert sum(tree.end[k] - tree.start[k] for k in kids) == tree.end[i] - tree.start[i]
            assert all(tree.radius[k] <= tree.radius[i] / 2 * (1 + 1e-12) for k in kids)
    entries = points[draw.integers(0, 500, 16)]
    want = ((points[:, None] - entries[None]) ** 2).sum(2)
    code, error = vector_codes.codes(tree, points, entries)
    assert (code == want.argmin(1)).all() and (error == want.min(1)).all()
    count, total = vector_codes.sums(tree, points, entries)
    assert (count == np.bincount(code, minlength=16)).all()
    assert all((total[e] == points[code == e].sum(0)).all() for e in range(16))
    ranges, places, _ = vector_codes.assign(tree, points, entries)
    assert sum(int((b - a).sum()) for a, b, _ in ranges) + len(places) == 500 and len(places) < 500


def trie_by_hand(rows, group=100, shared=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    members, ends = {}, {}
    for c in own:
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % shared
        seq = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children, out = {}, []
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        kids = children.get(p, [])
        leaves[p] = sum(leaves[k] for k in kids) or 1
        saved[p] = sum(saved[k] for k in kids) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids), leaves[p], saved[p], digest))
    return sorted(out, key=str)


def conversation_rows(seed):
    draw = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 220), -5, -100, -130]:
        for turn in range(draw.randint(1, 8)):
            common = draw.random() < 0.8
            rows.append((c, turn, draw.choice(["user", "assistant"]) if not common else "user", f"turn {turn} {draw.randint(0, 1)}" if common else prose(draw.randint(0, 999), 4)))
    for c in range(300, 340):  # equal conversations
        rows += [(c, t, "user", "same é" * t) for t in range(7)]
    rows += [(5, None, None, None), (5, None, None, None), (6, 1, None, ""), (6, 1, "", None), (7, 1, "user", None), (None, 1, "user", "x"), (8, 2, "b", "y"), (8, 2, "b", "x")]
    rows += [(100, 50 + t, "user", f"long {t}") for t in range(300)]
    return rows


@pytest.mark.parametrize(("seed", "burst"), [(1, 2), (2, 5), (3, 1000)])
def test_trie_as_by_hand(spark, seed, burst):
    rows = conversation_rows(seed)
    table = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, c int, p1 string").repartition(3)
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # so that conversations cross the edges of range partitions
    try:
        got = prefix_trie.trie(table, burst=burst, salts=2, segment=3)
        assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
        assert sorted([tuple(r) for r in got.collect()], key=str) == trie_by_hand(rows)
    finally:
        spark.conf.unset(merge)


def test_trie_of_few_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "user", "x")], schema)).count() == 0
    turnless = [(c, 1, "user", "x") for c in range(1, 20) if zlib.crc32(str(c).encode()) % 6]
    assert sorted([tuple(r) for r in prefix_trie.trie(spark.createDataFrame(turnless, schema)).collect()], key=str) == trie_by_hand(turnless)
