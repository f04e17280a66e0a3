"""Quality rules, substring dedup, near dedup and packing against brute force."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from emberline.llm import near_dedup, packing, quality_rules, substring_dedup
from emberline.llm import words as W
from emberline.llm.queries import vocabulary
from tests.llm.conftest import odd_rows, prose

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def split(text):
    return SPLIT.findall(text or "")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_words_and_windows_are_those_of_the_texts():
    texts = ["a bb  c\n", None, "", "é ñ x \x0b y", " lead", "trail ", "a bb c d"]
    block = W.block_of(pa.array(texts))
    spans = W.words(block)
    found = [[] for _ in texts]
    for d, a, b in zip(spans.doc, spans.start, spans.end, strict=True):
        found[d].append(block.data[a:b].tobytes().decode())
    assert found == [split(t) for t in texts]
    hashed = W.hashes(W.prefix(block), spans.start, spans.end)
    flat = list(itertools.chain(*found))
    assert len(set(hashed.tolist())) == len(set(flat))
    for k in (2, 3, 9):
        first, value = W.windows(spans.doc, hashed, k)
        want = [tuple(flat[i:i + k]) for i in range(len(flat) - k + 1) if spans.doc[i] == spans.doc[i + k - 1]]
        assert [tuple(flat[i:i + k]) for i in first] == want
        assert len(set(value.tolist())) == len(set(want))


def brute_measures(text):
    words, text = split(text), text or ""
    seen, dup = set(), 0
    for line in text.split("\n"):
        if split(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    repeat = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeat)


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality long, toxic long")


def test_quality_rules_against_brute_force(spark, odd):
    rows = odd_rows() + [(300 + i, " ### ".join(prose(90 + i, 40).split()) + "\nsame line\nsame line", "en", "a", 1) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bucket string, llr string, n long").repartition(4)
    trusted = [r[0] for r in rows if r[0] is not None and r[0] < 300]
    labels = labels_of(spark, [(i, 1, 0) for i in trusted] + [(300, 0, 0), (None, 1, 0)])
    got = quality_rules.rate(docs, labels, ["doc_id", "text"]).collect()
    assert len(got) == len(rows)
    of = lambda t: np.bincount(quality_rules.ngrams(W.block_of(pa.array([t])), quality_rules.BUCKETS)[1], minlength=quality_rules.BUCKETS)
    raw = sum(of(r[1]) for r in rows) + 1.0
    target = sum(of(r[1]) for r in rows if r[0] in trusted) + 1.0
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    for r in got:
        n, chars, symbols, dup, repeat = brute_measures(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert r["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        own = of(r["text"])
        assert r["llr"] == pytest.approx(float(own @ ratio) / max(1, own.sum()), abs=1e-4)
        assert r["kept"] == (not r["base_failed"] and r["llr"] >= quality_rules.THRESHOLD)
    assert all(r["kept"] for r in got if r["doc_id"] == 7)
    # Without labels the base rules alone decide.
    plain = quality_rules.rate(docs, labels_of(spark, []), ["doc_id"]).collect()
    assert all(r["llr"] == 0 and r["kept"] == (not r["base_failed"]) for r in plain)


def brute_substring(rows, k):
    docs = [split(r[1]) for r in rows]
    times = Counter(tuple(w[i:i + k]) for w in docs for i in range(len(w) - k + 1))
    out = []
    for r, w in zip(rows, docs, strict=True):
        gone = {i + j for i in range(len(w) - k + 1) if times[tuple(w[i:i + k])] > 1 for j in range(k)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=str)


@pytest.mark.parametrize(("k", "m", "hot", "per_bucket"), [(35, 5, 8192, 200_000), (35, 5, 1, 40), (6, 2, 3, 25), (5, 5, 0, 7)])
def test_substring_dedup_against_brute_force(spark, odd, k, m, hot, per_bucket):
    passage = prose(70, 60)
    rows = odd_rows() + [(400 + i, f"{prose(500 + i, 20)} {passage} {prose(600 + i, 20 + i)}", "en", "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string, bucket string, n long").repartition(4)
    got = substring_dedup.remove_repeats(docs, ["doc_id"], True, length=k, minimiser=m, hot=hot, per_bucket=per_bucket)
    assert rows_of(got) == brute_substring(rows, k)


def test_windows_that_share_a_hash_are_told_apart(monkeypatch):
    texts = [b"a b c d", b"e f g h", b"a b c x"]
    monkeypatch.setattr(W, "mix", lambda x: x * np.uint64(0))
    at, first = substring_dedup.repeated_windows(texts, np.ones(3, np.int64), 3)
    assert list(zip(at.tolist(), first.tolist(), strict=True)) == [(0, 0), (2, 0)]


def brute_near(rows):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for r in rows:
        w = split((r[1] or "").translate(low))
        sets.append({tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, j in itertools.combinations(range(len(rows)), 2):
        if rows[i][0] is None or rows[j][0] is None or not sets[i]:
            continue
        common = len(sets[i] & sets[j])
        if common and 100 * common >= 85 * len(sets[i] | sets[j]):
            root[find(j)] = find(i)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    out = []
    for i, r in enumerate(rows):
        component = None if r[0] is None else least[find(i)]
        out.append((r[0], len(sets[i]), component, component == r[0]))
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "text_block"), [(1024, 256), (3, 4)])
def test_near_duplicates_against_brute_force(spark, odd, block, text_block):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, root string, id string, bucket long").repartition(3)
    assert rows_of(near_dedup.near_duplicates(docs, block=block, text_block=text_block)) == brute_near(rows)


def test_estimates_follow_the_similarity():
    block = W.block_of(pa.array([" ".join(f"w{i}" for i in range(a, a + 400)) for a in (0, 20, 80, 1000)]))
    doc, value = near_dedup.shingle_sets(block, 3)
    signatures = near_dedup.packed(near_dedup.minima(doc, value, 4))
    got = near_dedup.estimate(signatures[0], signatures)
    assert got[0] == 1 and abs(got[1] - 378 / 418) < 0.12 and abs(got[2] - 318 / 478) < 0.15 and abs(got[3]) < 0.12


def test_curve_visits_each_cell_next_to_the_last():
    for axes, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        keys = packing.hilbert(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1) == 1).all()


def test_packing_round_trip(spark, odd):
    tokenizers = pytest.importorskip("tokenizers")
    real = tokenizers.Tokenizer.from_file(vocabulary())
    texts = ["a\n\n b", "  x \n", "a  b \n c", "<|endoftext|> x<|endoftext|>.", "it's. he'll, 'S a1.2,3", "\t\t\n a", "x" * 3000]
    rows = odd_rows() + [(500 + i, t, "en", "a", 1) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, begin string, ids long").repartition(3)
    got = packing.pack(docs, vocabulary(), length=64).collect()
    want = Counter()
    for r in rows:
        ids = np.array(real.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want[r[0], len(ids), zlib.crc32(ids.tobytes())] += 1
    pieces = {}
    at = Counter()
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == at[r["sequence_id"]] and r["length"] > 0
        at[r["sequence_id"]] += r["length"]
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    full = [at[i] for i in range(len(at))]
    assert full[:-1] == [64] * (len(full) - 1) and 0 < full[-1] <= 64
    ids_of = {}
    for r in rows:
        ids = np.array(real.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        ids_of.setdefault((r[0], len(ids)), []).append(ids)
    for key, some in pieces.items():
        options = ids_of[key]
        assert sum(p["length"] for p in some) == sum(map(len, options))
        assert all(any(zlib.crc32(o[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for o in options) for p in some)
    assert set(pieces) == set(ids_of)


def test_empty_tables(spark, empty):
    labels = labels_of(spark, [])
    assert quality_rules.rate(empty, labels, ["doc_id"]).count() == 0
    assert substring_dedup.remove_repeats(empty, ["doc_id"], True).count() == 0
    assert near_dedup.near_duplicates(empty).count() == 0
    assert packing.pack(empty, vocabulary()).count() == 0


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    """Each stage on its predecessor's rows; the last one's pieces hold the texts that the mix left."""
    import duckdb

    import corpus_pipeline
    from emberline.llm.queries import ORACLE

    docs, stages = spark.read.parquet(f"{SMALL}/documents.parquet"), dict(corpus_pipeline.STAGES)
    kept = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if i < len(stages) - 1:
            assert out.columns == docs.columns
            out.write.parquet(f"{tmp_path}/{i}/documents.parquet")
            docs = spark.read.parquet(f"{tmp_path}/{i}/documents.parquet")
            kept.append(sorted((tuple(r) for r in docs.collect()), key=str))
    base = {r[0] for r in kept[0]}
    every = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    for r in every:
        n, _, _, _, repeat = brute_measures(r["text"])
        assert not (r["doc_id"] in base and (n < 10 or 100 * repeat > 20 * n))
    near = brute_near(kept[0])
    assert {r[0] for r in kept[1]} == {r[0] for r in near if r[3]}
    cut = {r[0]: r for r in brute_substring(kept[1], 35)}
    before = {r[0]: r[1] for r in kept[1]}
    assert {r[0]: r[1] for r in kept[2]} == {i: (x[4] if x[2] else before[i]) for i, x in cut.items()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/2/documents.parquet/*.parquet'")
    taken = {r[0]: r[4] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({ORACLE['op9_source_mixing']})").fetchall() if r[4]}
    assert {r[0]: len(split(r[1])) for r in kept[3]} == taken
    assert out.agg(F.sum("length")).first()[0] == out.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    assert {r[0] for r in out.select("doc_id").distinct().collect()} == set(taken)
