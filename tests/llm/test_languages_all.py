"""No language of the training rows is left out."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from emberline.llm import language_mixture
from emberline.llm import words as W


def told(i, seed, n=12):
    draw = random.Random(i)
    stock = ["".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(6)]
    draw = random.Random(seed)
    return " ".join(draw.choice(stock) for _ in range(n))


def test_more_languages_than_a_dense_array_holds(spark):
    rows = [(4000 + j, told(j % 230, j), f"l{j % 230:03d}", "a", 1) for j in range(1150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    got = language_mixture.identify(docs).collect()
    assert len(got) == 1150 and len({r["lang_pred"] for r in got}) == 230
    want = {r[0]: r[2] for r in rows}
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in got]) > 0.99


def test_sparse_rows_are_those_of_the_dense_array(spark):
    rows = [(told(j % 5, j), f"l{j % 5}") for j in range(40)]
    train = spark.createDataFrame(rows, "text string, lang string")
    block = W.block_of(pa.array([told(2, 99), "", told(7, 3), "zzz"]))
    (a, dense), (b, sparse) = language_mixture.learn(train), language_mixture.learn(train, dense=2)
    assert a == b and isinstance(sparse, language_mixture.Sparse)
    np.testing.assert_allclose(language_mixture.word_likelihoods(block, dense)[1], language_mixture.word_likelihoods(block, sparse)[1], rtol=1e-5)


def by_trying_all(likelihood, penalty, rounds):
    """Proportions of one document: every language is fitted in every step."""
    n, width = likelihood.shape

    def fit(chosen):
        share = np.zeros(width)
        share[chosen] = 1 / len(chosen)
        for _ in range(rounds):
            weighted = likelihood * share
            share = (weighted / weighted.sum(1, keepdims=True)).sum(0) / n
        return np.log((likelihood * share).sum(1)).sum(), share
    singles = [np.log(likelihood[:, j]).sum() for j in range(width)]
    chosen = [int(np.argmax(singles))]
    value, share = singles[chosen[0]], np.eye(width)[chosen[0]]
    while len(chosen) < width:
        tried = [(*fit([*chosen, j]), j) for j in range(width) if j not in chosen]
        best = max(tried, key=lambda x: x[0])
        if best[0] - value <= penalty + 0.5 * np.log(n + 1):
            break
        value, share = best[:2]
        chosen.append(best[2])
    return share


def test_languages_are_those_that_raise_the_likelihood_most():
    draw = np.random.default_rng(11)
    several = 0
    for _ in range(60):
        width, docs = int(draw.integers(1, 9)), int(draw.integers(1, 7))
        sizes = draw.integers(0, 60, docs)
        doc = np.repeat(np.arange(docs), sizes)
        logs = draw.normal(0, draw.choice([0.5, 2, 6]), (len(doc), width))
        spoken = [draw.choice(width, min(width, int(draw.integers(1, 5))), replace=False) for _ in range(docs)]
        for i, d in enumerate(doc):
            logs[i, draw.choice(spoken[d])] += 3
        got = language_mixture.infer(W.Spans(doc, np.arange(len(doc)), np.arange(len(doc))), logs, docs, 3.0, 12)
        for d in range(docs):
            if sizes[d]:
                own = logs[doc == d]
                want = by_trying_all(np.exp(np.maximum(own - own.max(1, keepdims=True), -60)), 3.0, 12)
                np.testing.assert_allclose(got[d], want, atol=1e-6)
                several += (want > 0).sum() > 2
            else:
                assert not got[d].any()
    assert several > 20
