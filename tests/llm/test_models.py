"""Classifier, page text, language model, fingerprints, mixing and language mixture."""

from __future__ import annotations

import random
import re
import sys
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from emberline.llm import html_text, language_mixture, lm_scoring, mixing, multiset_hash, quality_classifier
from emberline.llm import words as W
from emberline.llm.queries import ORACLE, QUERIES
from tests.llm.conftest import SCHEMA, odd_rows, prose

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
from tools.check import compare, connect  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_duckdb(spark, name):
    cur = connect(SMALL).execute(ORACLE[name])
    columns, types = [d[0] for d in cur.description], [d[1] for d in cur.description]
    assert compare(QUERIES[name](spark, SMALL), columns, types, cur.fetchall()) == []


# Quality classifier

def graded(n):
    rows = [(i, prose(i, 40 + i % 50), "en", "a", 1) for i in range(n)]
    return [(i, t if i % 4 else " ".join(w + "***" if j % 3 else w.upper() + "!!" for j, w in enumerate(t.split())), *r) for i, t, *r in rows]


def test_classifier_on_held_out_rows(spark):
    rows = graded(320) + [(None, "x y", "en", "a", 1), (1001, None, None, None, None), (1002, "", "en", "a", 0), (5, prose(5, 45), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string, score string, model long").repartition(3)
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(320)] + [(None, 1, 0), (6, None, 0)], "doc_id long, quality long, toxic long")
    got = quality_classifier.classify(docs, labels, sample=120).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 320]
    assert len(held) > 40 and np.mean([r["predicted"] == int(r["doc_id"] % 4 > 0) for r in held]) > 0.95
    from zlib import crc32
    assert all(r["held_out"] == (r["doc_id"] is not None and crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)


def test_class_ratios_are_those_of_all_rows(spark):
    rows = graded(60)
    train = spark.createDataFrame([(r[1], int(i % 4 > 0)) for i, r in enumerate(rows)], "text string, quality long").repartition(5)
    ratio, n0, n1 = quality_classifier.class_ratios(train, 1 << 12, 1.0)
    n = np.ones((2, 1 << 12))
    for i, r in enumerate(rows):
        n[int(i % 4 > 0), quality_classifier.features(W.block_of(pa.array([r[1]])), 1 << 12)[1]] += 1
    assert (n0, n1) == (15, 45)
    np.testing.assert_allclose(ratio, np.log(n[1] / n[1].sum()) - np.log(n[0] / n[0].sum()))


def test_hinge_descent_separates():
    x = np.random.default_rng(1).standard_normal((80, 3))
    y = np.where(x[:, 0] + 0.5 * x[:, 1] > 0.1, 1.0, -1.0)
    w = quality_classifier.hinge_descent(np.tile(np.arange(3), 80), x.ravel(), np.arange(0, 241, 3), y, 3, 10.0, 60)
    assert np.mean(np.sign(x @ w[:3] + w[3]) == y) > 0.95


@pytest.mark.parametrize("given", [[], [(1, 1, 0), (2, 1, 0)]])
def test_classifier_without_two_classes(spark, given, odd):
    labels = spark.createDataFrame(given, "doc_id long, quality long, toxic long")
    got = quality_classifier.classify(odd, labels).collect()
    assert len(got) == len(odd_rows()) and len({r["score"] for r in got}) == 1 and (given or got[0]["score"] == 0.5)


# Page text

def test_page_text():
    page = """<!doctype html><html><head><title>T</title><style>p{}</style></head><body><header>Site name</header>
      <nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies</div><article><h1>Title &amp; more</h1>
      <p>First <b>bo</b>ld paragraph that is quite long,\n with&nbsp;white   space.<br>Next line.</p><script>var x = "</p>";</script>
      <p>Ok.</p><div class="ad">Buy this</div><aside>See also</aside><form>Name <input> <button>Go</button></form>
      <section id="comments"><p>A reader writes a rather long comment here, longer than most paragraphs of the article.</p></section>
      </article><footer>&copy; us</footer></body></html>"""
    assert html_text.main_text(page) == "Title & more First bold paragraph that is quite long, with white space. Next line. Ok."


def test_page_without_an_article_element():
    page = """<body><div id="menu"><a>One</a><a>Two</a></div><div class="content"><h2>Head</h2><p>A long paragraph of text that says something.</p>
      <p>No.</p><p>Another long paragraph of text that says something else.</p></div><div class="sidebar"><p>Long text in a sidebar, not to be taken.</p></div></body>"""
    assert html_text.main_text(page) == ("Head A long paragraph of text that says something. No. "
                                         "Another long paragraph of text that says something else.")


def test_pages_that_are_odd(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>just <i>text"), (4, "u", "<script>x"), (5, "u", "plain &lt;b&gt;"), (5, "u", "plain &lt;b&gt;"),
            (6, "u", "<article>" + "<p>word</p>" * 3000), (7, "u", "</div></p><<>>&#xZZ; a"), (8, "u", "<nav>menu only</nav>")]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(3))
    got = {(r["page_id"], r["url"]): r["text"] for r in html_text.extract(docs).collect()}
    assert got[1, "u"] == got[2, None] == got[4, "u"] == got[8, "u"] == ""
    assert got[None, "u"] == "just text" and got[5, "u"] == "plain <b>" and got[6, "u"] == " ".join(["word"] * 3000)
    assert html_text.extract(docs).count() == len(rows)
    assert html_text.extract(docs.limit(0)).count() == 0


def test_articles_of_the_test_pages(spark):
    """Against the article element cut out by pattern, for pages that have one."""
    import html as h
    got = {r["page_id"]: r["text"] for r in QUERIES["op5_html_text"](spark, SMALL).collect()}
    for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r["html"] or "", re.S)
        if article:
            lines = re.split(r"</?(?:p|br|h1|article)>", re.sub(r"</?b>", "", article[1]))
            assert got[r["page_id"]] == " ".join(" ".join(h.unescape(x).split()) for x in lines if h.unescape(x).strip())


# Language model

def test_gradient_steps_are_those_of_the_loss():
    counts = np.random.default_rng(2).integers(0, 50, lm_scoring.BUCKETS).astype(float)
    of, within = lm_scoring.classes(counts)
    assert np.bincount(of, np.exp(within), lm_scoring.CLASSES) == pytest.approx(np.ones(lm_scoring.CLASSES), abs=1e-3)
    weights = lm_scoring.drawn(counts, of)
    spans, bucket = lm_scoring.word_buckets(W.block_of(pa.array([prose(1, 60), "one two", "", "three"])))
    rows, at = lm_scoring.padded(spans.doc, bucket)
    target = of[bucket]
    loss = lambda w: -lm_scoring.forward(w, rows, at)[2][np.arange(len(at)), target].mean()
    exact = {k: v.astype(np.float64) for k, v in weights.items()}
    for key, place in (("w2", (3, 5)), ("b1", (4,)), ("w1", (7, 2)), ("embedding", (int(rows[at[10]]), 3))):
        up, down = ({k: v.copy() for k, v in exact.items()} for _ in range(2))
        up[key][place] += 1e-4
        down[key][place] -= 1e-4
        want = (loss(up) - loss(down)) / 2e-4
        squares = {k: np.zeros(v.shape) for k, v in exact.items()}
        lm_scoring.step({k: v.copy() for k, v in exact.items()}, squares, rows, at, target, 0.0)
        assert np.sqrt(squares[key][place]) == pytest.approx(abs(want), rel=1e-2, abs=1e-7)


def test_scores_prefer_text_like_the_corpus(spark):
    phrase = "the quick brown fox jumps over the lazy dog and runs home again".split()
    draw = random.Random(3)
    rows = [(i, " ".join(phrase[j % 13] for j in range(i, i + 60)), "en", "a", 1) for i in range(120)]
    mixed = [(900 + i, " ".join(draw.choice(phrase) for _ in range(60)), "en", "a", 1) for i in range(5)]
    docs = spark.createDataFrame(rows + mixed + [(1, None, None, None, None), (2, " ", "en", "a", 1)], SCHEMA).repartition(3)
    weights, of, within = lm_scoring.train(docs, rounds=4, stride=4, rate=0.2)
    got = lm_scoring.score(docs, ["doc_id"], weights, of, within).collect()
    good = np.mean([r["mean_log_prob"] for r in got if r["n_tokens"] and r["doc_id"] < 900])
    bad = np.mean([r["mean_log_prob"] for r in got if r["n_tokens"] and r["doc_id"] >= 900])
    assert good > bad + 0.3
    assert sorted((r["log_prob"], r["mean_log_prob"]) for r in got if not r["n_tokens"]) == [(0.0, 0.0)] * 2
    spans, bucket = lm_scoring.word_buckets(W.block_of(pa.array([rows[7][1]])))
    places, at = lm_scoring.padded(spans.doc, bucket)
    _, _, z = lm_scoring.forward(weights, places, at)
    want = float((z[np.arange(60), of[bucket]] + within[bucket]).sum())
    assert [r["log_prob"] for r in got if r["doc_id"] == 7] == [pytest.approx(want, rel=1e-4)]


def test_registered_training_masks_every_word_once(spark, odd, monkeypatch):
    places = []

    def one_round(documents, weights, of, offset, stride, rate):
        places.extend(range(offset, 64, stride))
        return weights

    monkeypatch.setattr(lm_scoring, "train_round", one_round)
    lm_scoring.train(odd)
    assert sorted(places) == list(range(64))
    with pytest.raises(ValueError, match="every offset"):
        lm_scoring.train(odd, rounds=2, stride=16)


def test_registered_training_prefers_text_like_the_corpus(spark):
    phrase = "the quick brown fox jumps over the lazy dog and runs home again".split()
    draw = random.Random(5)
    rows = [(i, " ".join(phrase[j % 13] for j in range(i, i + 400)), "en", "a", 1) for i in range(120)]
    rows += [(900 + i, " ".join(draw.choice(phrase) for _ in range(400)), "en", "a", 1) for i in range(5)]
    got = lm_scoring.pseudo_likelihood(spark.createDataFrame(rows, SCHEMA).repartition(3), ["doc_id"]).collect()
    assert np.mean([r["mean_log_prob"] for r in got if r["doc_id"] < 900]) > np.mean([r["mean_log_prob"] for r in got if r["doc_id"] >= 900]) + 0.3


def test_language_model_on_odd_and_empty_tables(spark, odd, empty):
    assert lm_scoring.pseudo_likelihood(odd, ["doc_id"]).count() == len(odd_rows())
    assert lm_scoring.pseudo_likelihood(empty, ["doc_id"]).count() == 0


# Fingerprints

def test_fingerprints_of_odd_rows(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, k1 string, signs string, n_chars long").repartition(3)
    got = multiset_hash.fingerprint_documents(docs).collect()
    assert len(got) == len(rows)
    of = defaultdict(set)
    lengths = sorted(((r[0], len(r[1] or "")) for r in rows), key=str)
    assert sorted(((r["doc_id"], r["n_chars"]) for r in got), key=str) == lengths
    by_id = defaultdict(list)
    for r in rows:
        by_id[r[0]].append(r[1] or "")
    for r in got:
        if len(set(by_id[r["doc_id"]])) == 1:
            of[by_id[r["doc_id"]][0]].add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in of.values()) and len({next(iter(x)) for x in of.values()}) == len(of)
    ids = [r for r in got if r["doc_id"] is not None and r["doc_id"] >= 200]
    assert np.mean([r["near_edited"] for r in ids]) > np.mean([r["near_next"] for r in ids]) + 0.2
    # The edited text, by hand, for ids that are there once with a next one that is there once.
    import hashlib
    order = sorted({r[0] for r in rows if r[0] is not None})
    shas = {r["doc_id"]: r["edited_sha256"] for r in got}
    for a, b in zip(order, order[1:], strict=False):
        if len(set(by_id[a])) == len(set(by_id[b])) == 1:
            t, half = by_id[a][0], len(by_id[a][0]) // 2
            assert shas[a] == hashlib.sha256((t[:len(t) - half] + by_id[b][0][:half]).encode()).hexdigest()


def test_fingerprints_do_not_depend_on_order_and_can_be_edited(spark):
    lines = [prose(i, 30).replace("\n", " ") for i in range(4)]
    texts = spark.createDataFrame([("all", "\n".join(lines)), ("turned", "\n".join(lines[::-1])), ("less", "\n".join(lines[:3])), ("last", lines[3])], "k string, text string")
    signs = {r["k"]: r["s0"] for r in multiset_hash.phrase_signs(texts.withColumn("kind", F.lit(0)), ["k"]).collect()}
    numbers = {r["k"]: r["x"] for r in texts.select("k", multiset_hash.paragraph_numbers(F.col("text")).alias("x")).collect()}
    assert signs["all"] == signs["turned"] and numbers["all"] == numbers["turned"]
    frame = spark.createDataFrame([tuple(x[k] for x in (numbers, signs) for k in ("less", "last", "all"))],
                                  "a array<long>, b array<long>, c array<long>, d array<smallint>, e array<smallint>, f array<smallint>")
    both = multiset_hash.combined((F.col("a"), F.col("d")), (F.col("b"), F.col("e")))
    less = multiset_hash.combined((F.col("c"), F.col("f")), (F.col("b"), F.col("e")), -1)
    got = frame.select(*both, *less).first()
    assert list(got) == [numbers["all"], signs["all"], numbers["less"], signs["less"]]


def test_long_texts_are_summed_in_pieces(spark, monkeypatch):
    texts = spark.createDataFrame([("k", prose(9, 900), 0)], "k string, text string, kind int")
    whole = multiset_hash.phrase_signs(texts, ["k"]).first()["s0"]
    monkeypatch.setattr(multiset_hash, "PIECE", 17)
    assert multiset_hash.phrase_signs(texts, ["k"]).first()["s0"] == whole


def test_fingerprints_of_an_empty_table_and_one_row(spark, empty):
    assert multiset_hash.fingerprint_documents(empty).count() == 0
    one = multiset_hash.fingerprint_documents(spark.createDataFrame([(3, "abcd", "en", "a", 4)], SCHEMA)).first()
    import hashlib
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0


# Mixing

@pytest.mark.parametrize(("block", "shard_words"), [(64, 1 << 18), (16, 300), (1, 50)])
def test_mix_meets_targets(spark, odd, block, shard_words):
    rows = mixing.mix(odd, block=block, shard_words=shard_words).collect()
    assert len(rows) == len(odd_rows()) and all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    sources = sorted({r[3] for r in odd_rows() if r[3] is not None}) + [None]
    size = {s: sum(len(WORD.findall(r[1] or "")) for r in odd_rows() if r[3] == s) for s in sources}
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    capped: set = set()
    while True:
        share = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(w for s, w in weight.items() if s not in capped)
        new = {s for s in sources if weight[s] * share > 3 * size[s]} | capped
        if new == capped:
            break
        capped = new
    target = {s: 3.0 * size[s] if s in capped else weight[s] * share for s in sources}
    by_size = defaultdict(int)
    for r in rows:
        by_size[r["source_size"], round(r["target"], 6)] += r["taken"]
    shards = lambda s: size[s] // shard_words + 1
    for s in sources:
        assert abs(by_size[size[s], round(target[s], 6)] - target[s]) <= block * (shards(s) + 1)
    again = mixing.mix(odd.repartition(5), block=block, shard_words=shard_words).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, again), key=str)


def test_seats_are_the_highest_quotients(spark):
    draw = random.Random(4)
    for total in (7, 100, 1000):
        claims = [(i, float(draw.randint(0, 3000) if i else 90_000)) for i in range(25)]
        frame = spark.createDataFrame(claims, "rank long, claim double")
        got = {r["rank"]: r["blocks"] for r in mixing.quotas(frame, [], "claim", F.lit(total), F.asc("rank"), "t").collect()}
        tried = sorted(((-c / (2 * k + 1), i) for i, c in claims if c for k in range(total)))[:total]
        assert got == {i: sum(1 for _, j in tried if j == i) for i, _ in claims}


def test_seats_in_groups_are_the_highest_quotients_of_each(spark):
    draw = random.Random(6)
    house = {None: 40, 0: 1000, 1: 0, 2: 7, 3: 55}
    claims = [(g, i, float(draw.choice([0, 1, 1, 50, 3000]) if g != 3 else 5)) for g in house for i in range(30 if g else 1)]
    claims += [(4, i, 0.0) for i in range(3)]
    house[4] = 9
    frame = spark.createDataFrame([(*c, house[c[0]]) for c in claims], "g long, rank long, claim double, seats long").repartition(5)
    seats = mixing.quotas(frame, ["g"], "claim", F.col("seats"), F.asc("rank"), "t")
    assert seats.columns == ["g", "rank", "claim", "seats", "blocks"]
    got = {(r["g"], r["rank"]): r["blocks"] for r in seats.collect()}
    assert len(got) == len(claims)
    for g in house:
        own = [(i, c) for h, i, c in claims if h == g]
        tried = sorted((-c / (2 * k + 1), i, k) for i, c in own if c for k in range(house[g]))[:house[g]]
        assert {i: got[g, i] for i, _ in own} == {i: sum(1 for _, j, _ in tried if j == i) for i, _ in own}


def test_applied_mix_has_the_words_that_it_takes(spark, odd):
    docs = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).withColumn("size", F.lit("clash")).withColumn("__row", F.lit(1))
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs, block=8, shard_words=100).collect() if r["taken"]}
    out = mixing.apply(docs, block=8, shard_words=100)
    assert out.columns == docs.columns
    assert {r["doc_id"]: len(WORD.findall(r["text"])) for r in out.collect()} == taken
    assert all(r["n_chars"] == len(r["text"]) and r["size"] == "clash" for r in out.collect())


def test_mix_of_an_empty_table(spark, empty):
    assert mixing.mix(empty).count() == 0 and mixing.apply(empty).count() == 0


# Languages

STOCKS = {"xx": "bla blub blim blom bleb", "yy": "kori kara kuru kero kiri", "zz": "öst äst üst öss ärt"}


def spoken(language, seed, n):
    draw = random.Random(seed)
    return " ".join(draw.choice(STOCKS[language].split()) + draw.choice(["", "n", "s", "t"]) for _ in range(n))


def test_languages_on_held_out_rows(spark):
    names = sorted(STOCKS)
    rows = [(i, spoken(names[i % 3], i, 25), names[i % 3], "a", 1) for i in range(150)]
    rows += [(500, spoken("xx", 1, 40) + " " + spoken("yy", 2, 20), None, "a", 1), (501, None, "xx", "a", 1), (502, "123 ... \n", "yy", "a", 1), (503, "", None, None, None),
             (None, spoken("zz", 5, 30), "xx", "a", 1), (504, "中文", None, "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = language_mixture.identify(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 150]
    assert len(held) > 20 and all(r["lang_pred"] == names[r["doc_id"] % 3] for r in held)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[500]["lang_set"] == ["xx", "yy"] and by_id[500]["lang_pred"] == "xx" and by_id[500]["score"] == pytest.approx(2 / 3, abs=0.05)
    assert [by_id[i]["lang_pred"] for i in (501, 502, 503)] == ["und"] * 3 and by_id[504]["lang_pred"] in names


def test_expectation_maximisation_finds_the_best_shares():
    random_ = np.random.default_rng(5)
    logs = np.log(random_.random((300, 2)))
    spans = W.Spans(np.zeros(300, np.int64), np.arange(300), np.arange(300))
    share = language_mixture.infer(spans, logs, 1, penalty=-1e9, rounds=300)[0]
    grid = np.linspace(0.001, 0.999, 999)
    value = [np.log(np.exp(logs) @ [p, 1 - p]).sum() for p in grid]
    assert share[0] == pytest.approx(grid[int(np.argmax(value))], abs=0.01)


def test_languages_without_training_rows(spark, odd, empty):
    none = language_mixture.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == len(odd_rows()) and all(r["lang_pred"] == "und" and r["score"] == 0 for r in none)
    assert language_mixture.identify(empty).count() == 0


def test_lm_step_touches_only_rows_of_words_that_occur_and_scores_pick_the_class():
    """op7_masked_lm_scores: the embedding's other rows are neither read nor written, and a plain loop gives the same step."""
    import numpy as np

    from emberline.llm import lm_scoring as L
    counts = np.ones(L.BUCKETS)
    of, _ = L.classes(counts)
    weights = L.drawn(counts, of)
    bucket = np.random.default_rng(1).integers(0, 40, 60)
    rows, at = L.padded(np.repeat([0, 1, 2], 20), bucket)
    some, target = at[::2], of[bucket[::2]]
    x, h, z = L.forward(weights, rows, some)
    for i, a in enumerate(some):
        sides = [np.mean([weights["embedding"][rows[a + s * j]] for j in range(1, L.SIDE + 1)], axis=0) for s in (-1, 1)]
        assert np.allclose(x[i], np.concatenate(sides), atol=1e-6)
    assert np.array_equal(L.log_likelihood(weights, rows, some, target), z[np.arange(len(some)), target])
    d = np.exp(z)
    d[np.arange(len(some)), target] -= 1
    inner = (d / len(some) @ weights["w2"].T * (1 - h * h)) @ weights["w1"].T / L.SIDE
    want = np.zeros_like(weights["embedding"])
    for i, a in enumerate(some):
        for side, s in ((0, -1), (1, 1)):
            for j in range(1, L.SIDE + 1):
                want[rows[a + s * j]] += inner[i, side * L.WIDTH:(side + 1) * L.WIDTH]
    want[-1] = 0
    squares = {k: np.zeros(v.shape, np.float32) for k, v in weights.items()}
    squares["embedding"][40:-1] = np.nan  # would spread to weights that are worked on
    before = weights["embedding"].copy()
    L.step(weights, squares, rows, some, target, 0.1)
    assert np.allclose(squares["embedding"][:40], want[:40] ** 2, rtol=1e-3, atol=1e-12)
    assert np.array_equal(weights["embedding"][40:], before[40:]) and not np.array_equal(weights["embedding"][:40], before[:40])
