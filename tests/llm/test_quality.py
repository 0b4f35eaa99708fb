"""The quality classifier's bounds, fit and edges."""

import numpy as np
import pytest

from tickloom.llm import quality

SCHEMA = "doc_id long, text string, score string"


def test_repeated_identifiers_keep_the_sample_bounded(spark, monkeypatch):
    seen = []
    plain = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y, *a, **k: (seen.append((len(x), len(y))), plain(x, y, *a, **k))[1])
    docs = spark.createDataFrame([(0, f"text {k} of one identifier", "x") for k in range(3000)] + [(k, f"another text {k}", "x") for k in range(60)], SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(0, 0, 0), (0, 1, 0)], "doc_id long, quality int, toxic int")
    quality.train(docs, labels, sample=10)
    assert seen[0][0] == seen[0][1] <= 10
    quality.train(docs.union(docs), labels)
    quality.train(docs, labels)
    assert seen[1] == seen[2]  # repeated rows change nothing


def test_fit_against_gradient_descent():
    """The same penalised logistic loss on the same feature differences, minimised by plain descent."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(80, 3))
    y = (x @ np.array([1.0, -2.0, 0.5]) + rng.normal(size=80) > 0).astype(int)
    model = quality.fit(x, y, pairs=500, ridge=0.05, seed=9)
    z = np.clip((x - model["centre"]) / model["scale"], -8, 8)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    draw = np.random.default_rng(9)
    k = min(500, len(good) * len(bad))
    diff = z[draw.choice(good, k)] - z[draw.choice(bad, k)]
    w = np.zeros(3)
    for _ in range(20_000):
        w += 0.5 * (diff.T @ (1 / (1 + np.exp(diff @ w))) / k - 0.05 * w)
    assert np.allclose(w, model["w"], atol=1e-5)
    s = z @ w  # the threshold: each label weighs the same in all
    errors = lambda at: (s[y == 1] < at).mean() + (s[y == 0] >= at).mean()
    assert errors(model["at"]) <= min(errors(at) for at in s) + 1e-9


@pytest.mark.parametrize("labelled", [True, False])
def test_edge_rows(spark, labelled):
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (4, "same"), (4, "same"), (5, "\n\t "), (6, "é" * 100_000), (7, "word " * 60_000)]
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(9)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int").where("true" if labelled else "false")
    got = quality.query(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.doc_id in (3, 4)}) == 1
