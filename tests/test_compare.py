"""Histogram trees against exhaustive splits, naive Bayes against plain sums, learners on shared folds."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestead.operators import compare, forest, linear


@pytest.fixture(scope="module")
def data(spark):
    rng, n = np.random.default_rng(8), 360
    x = np.round(rng.normal(size=(n, 12)), 1)
    x[rng.random((n, 12)) < 0.4] = 0
    at = (x[:, 0] > 0.2).astype(int) + (x[:, 3] * 1.0 > 0.5)
    words = (rng.random((n, 30)) < 0.15).astype(float)
    words[np.arange(n), at * 3] = 1
    x = np.c_[x, words]
    entries = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "id long, index int, value double").cache()
    labelled = spark.createDataFrame([(i, "abc"[at[i]], 1.0 + i % 2) for i in range(n)], "id long, label string, weight double").cache()
    return x, at, entries, labelled


def test_a_split_is_the_best_of_all(spark, data):
    x, at, entries, labelled = data
    numbers = entries.where("index < 12")
    rows = linear.packed(numbers, labelled.withColumns({"label_at": F.ascii("label") - 97, "key": F.col("id"), "fold": F.lit(0)})).cache()
    cuts = forest.bin_cuts(numbers, 12)
    assert all(0.0 in c and (np.diff(c) > 0).all() and len(c) < forest.BINS for c in cuts)
    grown = forest.grow_forest(rows, cuts, 3, trees=3, depth=1, tried=12, least=1.0)
    draws = forest._draws(rows.select("key").toArrow().column("key").combine_chunks(), 3, forest._SEED)
    keys = [r["key"] for r in rows.select("key").collect()]
    assert 0.9 < draws.mean() < 1.1 and draws.max() >= 3
    bins = np.stack([np.searchsorted(c, x[:, k], side="left") for k, c in enumerate(cuts)], axis=1)
    for t in range(3):
        w = np.zeros(len(x))
        w[keys] = draws[:, t]
        w *= 1.0 + np.arange(len(x)) % 2

        def gini(mask):
            mass = [w[mask & (at == k)].sum() for k in range(3)]
            return sum(mass) - sum(m * m for m in mass) / sum(mass) if sum(mass) else 0.0

        gains = {(f, c): gini(np.ones(len(x), bool)) - gini(bins[:, f] <= c) - gini(bins[:, f] > c) for f in range(12) for c in range(forest.BINS - 1)}
        assert gains[grown.feature[t, 0], grown.cut[t, 0]] == pytest.approx(max(gains.values()))
        inside = bins[:, grown.feature[t, 0]] <= grown.cut[t, 0]
        shares = np.array([w[inside & (at == k)].sum() for k in range(3)])
        assert grown.shares[t, 1].tolist() == pytest.approx((shares / shares.sum()).tolist())
    deep = forest.grow_forest(rows, cuts, 3, trees=15, depth=5, tried=6)
    told = forest.forest_shares(rows, deep, list("abc"), by_fold=False).collect()
    assert np.mean([r["predicted"] == "abc"[r["label_at"]] for r in told]) > 0.95
    again = forest.grow_forest(rows.repartition(3), cuts, 3, trees=15, depth=5, tried=6)
    assert (again.feature == deep.feature).all() and (again.cut == deep.cut).all()


def test_naive_bayes_against_sums(spark, data):
    x, at, entries, labelled = data
    rows = labelled.withColumn("fold", F.pmod(F.col("id"), F.lit(3)).cast("int"))
    got = {r["id"]: r["predicted"] for r in compare.naive_bayes(entries.where("index >= 12"), rows, alpha=0.5, size=30).collect()}
    words, weight, fold = x[:, 12:], 1.0 + np.arange(len(x)) % 2, np.arange(len(x)) % 3
    for i in range(len(x)):
        kept = fold != fold[i]
        scores = []
        for k in range(3):
            own = kept & (at == k)
            sums = (words[own] * weight[own][:, None]).sum(axis=0)
            scores.append(math.log(weight[own].sum()) + (words[i] * np.log((sums + 0.5) / (sums.sum() + 15))).sum())
        assert got[i] == "abc"[int(np.argmax(np.round(scores, 9)))]


def test_four_learners_in_one_table(spark, data):
    x, at, entries, labelled = data
    candidates = compare.drawn({"svm": 1, "forest": 1, "naive_bayes": 1, "logistic": 1})
    assert candidates == compare.drawn({"svm": 1, "forest": 1, "naive_bayes": 1, "logistic": 1}) and len({c.text for c in candidates}) == 4
    confusions = compare.compared(entries, (0, 12), labelled, 42, candidates)
    assert {tuple(r) for r in confusions.groupBy("learner").agg(F.sum("n")).collect()} == {(c.learner, len(x)) for c in candidates}
    ranks = compare.ranked(confusions).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == [1, 2, 3, 4] and ranks[0]["macro_f1"] > 0.9 and all(a["macro_f1"] >= b["macro_f1"] for a, b in zip(ranks, ranks[1:], strict=False))
    cells = defaultdict(Counter)
    for r in confusions.collect():
        cells[r["learner"]][r["label"], r["predicted"]] += r["n"]
    for r in ranks:
        own = cells[r["learner"]]
        f1 = [2 * own[c, c] / (sum(own[c, p] for p in "abc") + sum(own[t, c] for t in "abc")) for c in "abc"]
        assert r["macro_f1"] == pytest.approx(sum(f1) / 3) and r["accuracy"] == pytest.approx(sum(own[c, c] for c in "abc") / len(x))
