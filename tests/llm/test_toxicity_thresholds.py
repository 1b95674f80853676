"""Thresholds of the classifier cover every labelled row outside training."""

import random

import numpy as np
import pytest

from periodgrid.llm import toxicity


def test_every_labelled_row_outside_training_sets_thresholds(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "TRAIN_PER_CLASS", 20)
    monkeypatch.setattr(toxicity, "STEPS", 60)
    seen = []
    plain = toxicity.thresholds
    monkeypatch.setattr(toxicity, "thresholds", lambda langs, *a, **b: seen.append((langs, *a, b.get("weight"))) or plain(langs, *a, **b))
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(900):
        bad, lang = i % 3 == 0, "b" if i % 16 < 1 else ("a" if i % 50 else None)
        docs.append((i, " ".join(rng.choice("ka lo mi nu pe".split()) for _ in range(9)) + (" vextar" if bad else " sol"), lang))
        labels.append((i, 1, int(bad)))
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    _, limits, _ = toxicity.fit(frame, table)
    assert set(limits) == {None, "a", "b"}  # a fifth of the labelled rows holds fewer than ten toxic ones of b
    (langs, score, label, weight), = seen
    free = frame.join(table, "doc_id").where(toxicity.fold() != 1).count()
    assert weight.sum() == free - 40
    assert sum(w for x, y, w in zip(langs, label, weight) if x == "b" and y == 1) >= 10


def test_weights_stand_for_rows():
    rng = np.random.default_rng(1)
    score, label, weight = rng.random(50).round(2), rng.integers(0, 2, 50), rng.integers(1, 9, 50)
    langs = rng.choice(["a", "b"], 50).tolist()
    whole = toxicity.thresholds(np.repeat(np.array(langs, object), weight).tolist(), score.repeat(weight), label.repeat(weight))
    assert toxicity.thresholds(langs, score, label, weight=weight) == pytest.approx(whole)


def test_few_rows_still_set_the_common_threshold():
    assert toxicity.thresholds(["a"] * 4, np.array([0.6, 0.58, 0.4, 0.2]), np.array([1, 1, 0, 0])) == {None: pytest.approx(0.49)}
