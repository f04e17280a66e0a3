"""The training queries train with the default parameters, and scoring loads what was trained."""

from __future__ import annotations

import pytest
from conftest import SMALL

from emberline.operators import boosting as B
from emberline.operators import learning as N
from emberline.workload import learning
from emberline.workload.registry import QUERIES


class Asked(Exception):
    pass


@pytest.mark.parametrize(("name", "objective"), [("train_regressor", "l1"), ("score_latest", "l1"), ("train_classifier", "softmax")])
def test_queries_train_in_full(spark, monkeypatch, name, objective):
    given = []

    def asked(df, features, label, weight, settings, *_):
        given.append(settings)
        raise Asked

    monkeypatch.setattr(B, "fit", asked)
    monkeypatch.setattr(learning, "_REGISTERED", {})
    with pytest.raises(Asked):
        QUERIES[name](spark, SMALL)
    assert (given[0].rounds, given[0].max_depth, given[0].num_leaves, given[0].learning_rate) == (600, 8, 31, 0.05)
    assert given[0].objective in (objective, "binary")


def test_scoring_loads_the_model_in_production(spark, monkeypatch):
    learning.registered(spark, SMALL)
    monkeypatch.setattr(B, "fit", None)
    rows = QUERIES["score_latest"](spark, SMALL)
    assert rows.count() > 0 and rows.where("not scored or not classed").isEmpty()
    assert N.TrainParams().reg_alpha == N.TrainParams().reg_lambda == 0.1
