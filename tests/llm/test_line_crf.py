import itertools

import numpy as np
from pyspark.sql import functions as F

from siltline.llm import line_crf


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    for n in (1, 2, 5, 8):
        x, field = r.normal(size=(n, 4)), line_crf.Field(r.normal(size=4), r.normal(size=(2, 2)))
        total, good = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            weight = sum(x[k] @ field.weights for k in range(n) if states[k])
            weight = np.exp(weight + sum(field.steps[a, b] for a, b in zip(states, states[1:])))
            total += weight
            good += weight * np.array(states)
        assert np.allclose(field.marginals(x), good / total)
        held = np.ones((1, n), bool)
        got, steps = line_crf._expected(np.exp(x @ field.weights)[None], held, np.array([n]), np.exp(field.steps))
        assert np.allclose(got[0], good / total) and np.isclose(steps.sum(), n - 1)


def test_features_of_lines_and_neighbours():
    x, size = line_crf.features("Ab cd.\n\nAb cd.\nXX ## 12\n")
    own = line_crf.OWN
    assert len(x) == 3 and size.tolist() == [6, 6, 8] and (x[:, 0] == 1).all()
    assert x[:, 12].tolist() == [0, 1, 0]  # said before
    assert np.allclose(x[1, own : 2 * own - 1], x[0, 1:own]) and np.allclose(x[1, 2 * own - 1 :], x[2, 1:own])
    empty, one = line_crf.features(" \n\t")
    assert empty.shape == (1, 3 * own - 2) and empty.sum() == 1 and one.tolist() == [1]
    long, _ = line_crf.features("w😀 " * 100_000)
    assert len(long) == 1 and np.isfinite(long).all()


def test_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    kept = line_crf.held_out(F.col("doc_id"))
    field = line_crf.train(docs, labels.where(~kept))
    score = line_crf.scorer(field)
    tested = labels.where(kept).join(docs, "doc_id").select("quality", score(F.col("text")).alias("s")).collect()
    right = sum((r.s >= 0.5) == (r.quality == 1) for r in tested)
    assert len(tested) > 50 and right / len(tested) > 0.95
    again = line_crf.train(docs.repartition(3), labels.where(~kept).repartition(2))
    assert np.allclose(field.weights, again.weights)


def test_sample_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(line_crf, "TRAIN_DOCS", 5)
    monkeypatch.setattr(line_crf, "TRAIN_LINES", 2)
    seen = []
    monkeypatch.setattr(line_crf, "fit", lambda runs: seen.extend(runs))
    docs = spark.createDataFrame([(i, "a b\nc d\ne f\ng h") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    line_crf.train(docs, labels)
    assert len(seen) == 5 and all(len(x) == 2 for x, _ in seen)


def test_edge_cases(spark):
    rows = [(1, "fine words here", "x"), (2, None, "y"), (None, "text", "z"), (1, "fine words here", "x"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (9, 1)], "doc_id long, quality int")
    for some in (labels, labels.where("false")):
        score = line_crf.scorer(line_crf.train(docs, some))
        got = docs.select(score(F.col("text")).alias("s")).collect()
        assert len(got) == 5 and all(0 <= r.s <= 1 for r in got)
    got = docs.select(line_crf.held_out(F.col("doc_id")).alias("h")).collect()
    assert all(r.h is not None for r in got)
    assert docs.where("false").select(score(F.col("text"))).count() == 0
