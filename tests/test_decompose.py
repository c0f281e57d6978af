"""Singular values against numpy, curves against a walk over sorted scores."""

import random

import numpy as np
import pytest

from lodestead.operators import decompose, evaluate


def test_svd_against_numpy(spark):
    rng = np.random.default_rng(3)
    x = (rng.random((400, 60)) < 0.1) * rng.gamma(2.0, size=(400, 60))
    x[:, 5] += 3
    x[17] = 0
    rows = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)]
    entries = spark.createDataFrame(rows, "id long, index int, value double").repartition(6)
    u, s, vt = np.linalg.svd(x, full_matrices=False)
    got = decompose.truncated_svd(entries, 60, 5)
    values = [r["value"] for r in got.values.orderBy("component").collect()]
    assert values == pytest.approx(s[:5].tolist(), rel=1e-6)
    components = np.zeros((60, 5))
    for r in got.components.collect():
        components[r["index"], r["component"]] = r["weight"]
    assert np.abs(np.abs(components.T @ vt[:5].T) - np.eye(5)).max() < 1e-3 and all(components[np.abs(components[:, k]).argmax(), k] > 0 for k in range(5))
    scores = {r["id"]: r["coordinates"] for r in got.scores.collect()}
    assert len(scores) == 399 and np.allclose([scores[i] for i in sorted(scores)], (x @ components)[[i for i in range(400) if i != 17]])
    # Fewer components than asked for where the rank is less, none without entries.
    few = decompose.truncated_svd(spark.createDataFrame([(1, 0, 3.0), (2, 0, 4.0), (2, 3, 0.0)], "id long, index int, value double"), 4, 3)
    assert [r["value"] for r in few.values.collect()] == pytest.approx([5.0]) and sorted(r["coordinates"][0] for r in few.scores.collect()) == pytest.approx([3.0, 4.0])
    assert decompose.truncated_svd(entries.limit(0), 4, 3).values.count() == 0


def test_roc_against_sorted_scores(spark):
    rng = random.Random(6)
    rows = [(k, c, rng.choice([0.1, 0.5, 0.5, rng.random(), None]), rng.choice("aab")) for k in range(300) for c in "abz"]
    points = evaluate.roc_points(spark.createDataFrame(rows, "id int, class string, score double, label string")).cache()
    areas = {r["class"]: r["auc"] for r in evaluate.roc_areas(points).collect()}
    assert set(areas) == {"a", "b", "macro"}  # nobody is labelled z
    curves = {}
    for c in "ab":
        own = [(s, label == c) for _, k, s, label in rows if k == c and s is not None]
        pos, neg = sum(y for _, y in own), sum(not y for _, y in own)
        want = [(t, sum(y for s, y in own if s >= t) / pos, sum(not y for s, y in own if s >= t) / neg) for t in sorted({s for s, _ in own}, reverse=True)]
        got = [(r["threshold"], r["tpr"], r["fpr"]) for r in points.where(f"class = '{c}'").collect()]
        assert [x for p in sorted(got, reverse=True) for x in p] == pytest.approx([x for p in want for x in p])
        assert areas[c] == pytest.approx(sum((x > y) + 0.5 * (x == y) for x, i in own if i for y, j in own if not j) / (pos * neg))
        curves[c] = [(0.0, 0.0)] + [(f, t) for _, t, f in want]
    assert areas["macro"] == pytest.approx((areas["a"] + areas["b"]) / 2)

    def height(curve, at):
        return max(t0 + ((at - f0) / (f1 - f0) if f1 > f0 else 1) * (t1 - t0) for (f0, t0), (f1, t1) in zip(curve, curve[1:], strict=False) if f0 <= at + 1e-9 and f1 >= at - 1e-9)

    for r in evaluate.macro_curve(points, 20).collect():
        assert r["tpr"] == pytest.approx((height(curves["a"], r["fpr"]) + height(curves["b"], r["fpr"])) / 2)
    assert evaluate.macro_curve(points, 20).count() == 21


def test_entries_are_moved_once(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(decompose, "written", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or df)
    entries = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 2.0), ("b", 1, 1.0)], "id string, index int, value double")
    decompose.truncated_svd(entries, 2, 1, passes=1)
    assert [p.count("Exchange hashpartitioning(id") for p in plans] == [1] and "Join" not in plans[0]
