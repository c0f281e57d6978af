"""Feature blocks, the classifier and two-pass scoring on a small labelled set."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestead.operators import evaluate, features, linear, training
from lodestead.sources import shared


def grams_of(spark, text, fn):
    return spark.createDataFrame([(text,)], "t string").select(fn(F.col("t"))).first()[0]


def test_grams(spark):
    assert grams_of(spark, "abcd x", training.char_grams) == [" ab", "abc", "bcd", "cd ", " abc", "abcd", "bcd ", " abcd", "abcd ", " x "]
    assert grams_of(spark, "tax number a code tax", training.word_grams) == ["tax", "code", "tax", "tax code", "code tax"]
    assert grams_of(spark, "", training.char_grams) == grams_of(spark, "a", training.word_grams) == []


def test_text_block(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "c"), (3, "b")]
    grams = spark.createDataFrame(rows, "id int, token string")
    words = training.vocabulary(grams, min_df=2, most=5)
    idf = math.log(4 / 3) + 1
    assert [(r["token"], r["df"], r["at"]) for r in words.orderBy("at").collect()] == [("a", 2, 0), ("b", 2, 1)] and words.first()["idf"] == pytest.approx(idf)
    got = {(r["id"], r["at"]): r["value"] for r in training.text_entries(grams, words).collect()}
    a, norm = 1 + math.log(2), math.sqrt((1 + math.log(2)) ** 2 + 1)
    assert got == {(1, 0): pytest.approx(a / norm), (1, 1): pytest.approx(1 / norm), (2, 0): pytest.approx(1.0), (3, 1): pytest.approx(1.0)}
    assert training.vocabulary(grams, min_df=1, most=1).first()["token"] == "a"


@pytest.fixture(scope="module")
def assets(spark):
    rng = random.Random(3)
    words = {"Stock": ["bin", "pallet", "shelf", "crate"], "People": ["shift", "team", "badge", "leave"], "Money": ["coin", "bank", "bond", "cash"]}
    rows = []
    for k in range(240):
        label = rng.choice(list(words))
        columns = " | ".join(f"{rng.choice(words[label])}_{rng.choice('ab')}".upper() for _ in range(5))
        rows.append((k, label, "sys", "t" if k % 2 else None, f"T{k}", "ref", columns, "X:status"))
    df = spark.createDataFrame(rows, "id long, label string, source_system string, asset_type string, technical_name string, source_ref string, column_names_text string, column_value_semantics_text string")
    return df.withColumns({c: F.lit(float(5)) for c in features.RAW}).cache()


SIZES = {"min_df": 2, "most_chars": 500, "most_words": 500}


def plain_svm(x, y, s, c=1.0):
    """Newton's method with the whole curvature."""
    x = np.c_[x, np.ones(len(x))]

    def loss(w):
        return 0.5 * w @ w + c * (s * np.maximum(0, 1 - y * (x @ w)) ** 2).sum()

    w = np.zeros(x.shape[1])
    for _ in range(100):
        slack = np.maximum(0, 1 - y * (x @ w))
        curve = np.eye(len(w)) + 2 * c * (x.T * (s * (slack > 0))) @ x
        step, far = -np.linalg.solve(curve, w - 2 * c * x.T @ (s * y * slack)), 1.0
        while far > 1e-6 and loss(w + far * step) > loss(w) + 1e-12:
            far /= 2
        w = w + far * step
    return w, loss(w)


def test_svm_and_calibration_against_numpy(spark):
    rng, n, size = np.random.default_rng(0), 300, 40
    x = (rng.random((n, size)) < 0.2) * rng.normal(size=(n, size))
    x[7] = 0  # a row without entries
    at = (x @ rng.normal(size=(size, 3)) + rng.normal(size=(n, 3))).argmax(axis=1)
    x[:, 3] = 20 + rng.normal(size=n)  # dense and far from 0
    s = rng.choice([0.7, 1.0, 5.0], n)
    entries = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)] + [(999, 1, 1.0)], "id long, index int, value double")
    labelled = spark.createDataFrame([(i, "abc"[at[i]], float(s[i])) for i in range(n)], "id long, label string, weight double")
    fitted = linear.fit_svm(entries, labelled, size=size, folds=2, settled=1e-5)
    objective = {r["class"]: r["objective"] for r in fitted.objective.collect()}
    weights = {(r["class"], r["index"]): r["weight"] for r in fitted.coefficients.collect()}
    fold = {r["id"]: r["f"] for r in labelled.select("id", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(2)).alias("f")).collect()}
    unseen = {(r["id"], r["class"]): r["margin"] for r in fitted.unseen.collect()}
    assert len(unseen) == 3 * n
    for k, name in enumerate("abc"):
        y = np.where(at == k, 1.0, -1.0)
        w, loss = plain_svm(x, y, s)
        assert objective[name] == pytest.approx(loss, rel=1e-7)
        assert [weights.get((name, j), 0.0) for j in [*range(size), -1]] == pytest.approx(w.tolist(), abs=1e-3)
        for f in range(2):
            kept = np.array([fold[i] != f for i in range(n)])
            w, _ = plain_svm(x, y, s * kept)
            own = np.flatnonzero(~kept)
            assert [unseen[i, name] for i in own.tolist()] == pytest.approx((np.c_[x, np.ones(n)] @ w)[own].tolist(), abs=1e-3)
    for r in linear.platt(fitted.unseen).collect():
        own = at == "abc".index(r["class"])
        m = np.array([unseen[i, r["class"]] for i in range(n)])
        t = np.where(own, (s[own].sum() + 1) / (s[own].sum() + 2), 1 / (s[~own].sum() + 2))
        p = 1 / (1 + np.exp(-(r["a"] * m + r["b"])))
        assert abs((s * (p - t) * m).sum()) < 1e-4 and abs((s * (p - t)).sum()) < 1e-4  # no slope is left
    nothing = linear.fit_svm(entries.limit(0), labelled.where("id < 4"), size=size)
    assert nothing.objective.count() == labelled.where("id < 4").select("label").distinct().count()


def test_training_and_two_passes(spark, assets):
    labelled = training.split_held_out(assets.select("id", "label", F.lit(1.0).alias("weight")), share=0.25, fixed=assets.where("id = 1").select("id"))
    split = {r["id"]: r["held_out"] for r in labelled.collect()}
    assert split[1] and 55 <= sum(split.values()) <= 65
    model = training.train_domain_model(assets, labelled.where("not held_out").drop("held_out"), version="v9", folds=2, settled=1e-2, use=("char", "word", "category"), **SIZES)
    ledger = assets.where("id = 0").withColumns({"id": F.lit(900), "column_names_text": F.lit("LEDGER | TAX | INVOICE")})
    scored = training.two_pass_scores(assets.unionByName(ledger).drop("label"), model).cache()
    by = {r["id"]: r for r in scored.collect()}
    assert len(by) == 241 and (by[900]["domain"], by[900]["model_version"]) == ("Finance & Contrôle", "keyword_rule/v9") and by[0]["model_version"] == "v9"
    assert all(0 <= r["confidence"] <= 1 and r["review_required"] == (r["review_reason"] != "") and r["domain_alt"] != r["domain"] for r in by.values())
    told = scored.join(assets.select("id", "label"), "id").join(labelled.where("held_out").select("id"), "id").withColumnRenamed("domain", "predicted").withColumnRenamed("label", "human_label")
    assert evaluate.overall_scores(evaluate.confusion(told)).first()["accuracy"] >= 0.9
    weights = {r["block"]: r["importance"] for r in training.block_importance(model).collect()}
    assert sum(weights.values()) == pytest.approx(1.0) and weights["word"] == max(weights.values())
    plain = training.two_pass_scores(assets.limit(20), training.DomainModel(model.blocks, model.coefficients, None, model.objective, "v9", model.use))
    assert plain.count() == 20


def test_comparisons(spark, assets):
    labelled = assets.select("id", "label", F.lit(1.0).alias("weight"))
    uses = {"all": ("char", "word", "category"), "numbers": ("category",)}
    right = {r["blocks"]: r["share"] for r in training.ablation(assets, labelled, uses, settled=1e-2, **SIZES).groupBy("blocks").agg((F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)) / F.sum("n")).alias("share")).collect()}
    assert right["all"] >= 0.9 > right["numbers"]
    curve = training.learning_curve(assets, labelled, (0.2, 1.0), settled=1e-2, **SIZES).groupBy("fraction").agg(F.sum("n").alias("n")).collect()
    assert {r["fraction"] for r in curve} == {0.2, 1.0} and len({r["n"] for r in curve}) == 1
    blocks = training.fit_blocks(assets, **SIZES)
    train = training.vectors(training.entries(assets, blocks, use=("word",)), blocks.offsets[-1], labelled)
    tried = training.cross_validated(train, regularisations=(0.01, 100.0), folds=2, iterations=4).collect()
    assert [r["regularisation"] for r in tried] == [0.01, 100.0]
    texts = assets.select("id", F.col("column_names_text").alias("text"), F.when(F.col("id") % 9 > 0, F.col("label")).alias("label"), F.when(F.col("id") % 5 > 0, F.col("id")).alias("size"))
    got = training.text_baseline(texts, numbers=("size",), buckets=256, iterations=8).where("held_out and label is not null").collect()
    assert sum(r["label"] == r["predicted"] for r in got) >= 0.8 * len(got)


def test_gold_and_auc(spark):
    consensus = spark.createDataFrame([(1, "A", 0.7), (2, "B", 0.69), (3, "A", 1.0)], "id int, label string, consensus double")
    human = spark.createDataFrame([(3, "B")], "id int, label string")
    assert sorted(map(tuple, training.gold_labels(consensus, human).collect())) == [(1, "A", 0.7), (3, "B", 10.0)]
    rng = random.Random(5)
    rows = [(k, c, rng.choice([0.1, 0.5, rng.random()]), "ab"[k % 2]) for k in range(80) for c in "ab"]
    got = {r["class"]: r["auc"] for r in training.class_auc(spark.createDataFrame(rows, "id int, class string, score double, label string")).collect()}
    for c in "ab":
        own, other = [r[2] for r in rows if r[1] == c == r[3]], [r[2] for r in rows if r[1] == c != r[3]]
        assert got[c] == pytest.approx(sum((x > y) + 0.5 * (x == y) for x in own for y in other) / (len(own) * len(other)))


def test_text_vocabulary_is_that_of_all_tokens(spark):
    """Ids that occur twice, equal texts and texts without a token; no token is moved with a row's id."""
    rows = [("a", "PS_JOB_DATA", "job", "EMPLID | JOB"), ("a", "PS_JOB", "job", ""), ("b", "PS_JOB_DATA", "job", "EMPLID | JOB"), ("c", "ps", None, None), ("d", None, None, None), ("e", "x y", "job job", "JOB")]
    assets = spark.createDataFrame(rows, "id string, technical_name string, source_ref string, column_names_text string")
    for kind in ("char", "word"):
        for most in (4, 1000):
            own = training.text_vocabulary(assets, kind, min_df=1, most=most)
            plain = training.vocabulary(training._grams(assets, kind), min_df=1, most=most)
            assert own.dtypes == plain.dtypes and sorted(map(tuple, own.collect())) == sorted(map(tuple, plain.collect()))
    words = training.text_vocabulary(assets, "word", min_df=1)
    words = spark.createDataFrame(words.collect(), words.schema)
    plan = training.text_entries(training._grams(assets, "word"), words)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1 and "SortMergeJoin" not in plan


def test_passes_over_laid_out_rows(spark, monkeypatch):
    """Products with slices are those with the rows, rows without entries and frequent and rare indices included; a step moves the columns that are open."""
    rng, n, size = np.random.default_rng(2), 90, 70
    x = (rng.random((n, size)) < np.linspace(0.01, 0.9, size)) * rng.normal(size=(n, size))
    x[11] = 0
    entries = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "id long, index int, value double")
    rows = spark.createDataFrame([(i, i % 3, 1.0 + i % 2, i % 2) for i in range(n)], "id long, label_at int, weight double, fold int")
    monkeypatch.setattr(linear, "LAID_OUT", 400)
    monkeypatch.setattr(linear, "DENSE", 0.3)
    solver = linear.SquaredHinge(linear.laid_out(linear.packed(entries, rows).coalesce(2)).cache(), linear.Columns(np.arange(3), np.array([-1, 0, 1])), 0.5, size)
    w, p, i = rng.normal(size=(size + 1, 3)) / 9, rng.normal(size=(size + 1, 3)), np.arange(n)
    full, y = np.c_[x, np.ones(n)], np.where(i[:, None] % 3 == np.arange(3), 1.0, -1.0)
    s = (1.0 + i % 2)[:, None] * (i[:, None] % 2 != np.array([-1, 0, 1]))
    slack = np.maximum(1 - y * (full @ w), 0)
    loss, slope = solver.loss_and_slope(w)
    assert loss == pytest.approx(0.5 * (w * w).sum(axis=0) + 0.5 * (s * slack**2).sum(axis=0)) and slope == pytest.approx(w - full.T @ (s * y * slack))
    assert solver.curved(w, p) == pytest.approx(p + full.T @ (s * (slack > 0) * (full @ p)))
    widths, summed = [], linear.Passes._summed
    monkeypatch.setattr(linear.Passes, "_summed", lambda self, work, width: (widths.append(width), summed(self, work, width))[1])
    step = solver._solved(w, slope, lambda v: v, np.array([False, True, False]), 2, np.full(3, 1e-9))
    assert widths == [1, 1] and step[:, 1].any() and not step[:, [0, 2]].any()


def test_indices_alike_are_one_column(spark, monkeypatch):
    """Indices with the same values in the same rows are fitted as one, and their weights are those of the model of all of them."""
    rng, n, size = np.random.default_rng(4), 120, 14
    x = (rng.random((n, size)) < 0.4) * rng.normal(size=(n, size))
    x[:, 5] = x[:, 9] = x[:, 2]
    x[:, 11], x[:, 12] = x[:, 3], 0
    x[:, 13] = np.where(np.arange(n) == 50, 2.0, x[:, 4])  # alike but for one row
    at = (x[:, :4] @ rng.normal(size=(4, 2)) + rng.normal(size=(n, 2))).argmax(axis=1)
    entries = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)] + [(999, 5, 1.0)], "id long, index int, value double")
    labelled = spark.createDataFrame([(i, "ab"[at[i]], 1.0 + i % 3) for i in range(n)], "id long, label string, weight double")
    sizes, summed = [], linear.Passes._summed
    monkeypatch.setattr(linear.Passes, "_summed", lambda self, work, width, *more: (sizes.append((self.size, width)), summed(self, work, width, *more))[1])
    fitted = linear.fit_svm(entries, labelled, size=size, settled=1e-6)
    assert {s for s, _ in sizes} == {10} and max(w for _, w in sizes[2:]) == 2  # losses need no columns of their own
    weights = {(r["class"], r["index"]): r["weight"] for r in fitted.coefficients.collect()}
    for k, name in enumerate("ab"):
        w, loss = plain_svm(x, np.where(at == k, 1.0, -1.0), 1.0 + np.arange(n) % 3)
        assert {r["class"]: r["objective"] for r in fitted.objective.collect()}[name] == pytest.approx(loss, rel=1e-7)
        assert [weights.get((name, j), 0.0) for j in [*range(size), -1]] == pytest.approx(w.tolist(), abs=1e-3)


def test_scoring_searches_texts_once(spark, assets, monkeypatch):
    """The keyword pass is written once for what reads it, and margins meet each entry once, with all classes."""
    coefficients = spark.createDataFrame([("a", 0, 2.0), ("b", 0, -1.0), ("a", 2, 0.5), ("a", -1, 0.25), ("b", -1, -0.5)], "class string, index int, weight double")
    rows = spark.createDataFrame([(1, 0, 3.0), (1, 2, 2.0), (2, 7, 1.0), (3, 2, -4.0)], "id long, index int, value double")
    found = training.margins(rows, coefficients)
    assert {(r["id"], r["class"]): r["margin"] for r in found.collect()} == {(1, "a"): 7.25, (1, "b"): -3.5, (2, "a"): 0.25, (2, "b"): -0.5, (3, "a"): -1.75, (3, "b"): -0.5}
    blocks = training.fit_blocks(assets, **SIZES)
    model = training.DomainModel(blocks, coefficients, None, None, "v1", ("char", "category"))
    tables = []
    monkeypatch.setattr(training, "written", lambda df, name: (tables.append(name), shared.written(df, name))[1])
    scored = training.two_pass_scores(assets.drop("label"), model)
    assert tables == ["told"] and scored.count() == assets.count()


def test_ablation_makes_entries_once(spark, assets, monkeypatch):
    """All fits of an ablation read the same written entries, each those of its blocks."""
    made, seen, entries = [], {}, training.entries
    monkeypatch.setattr(training, "entries", lambda rows, blocks, use: (made.append((use, blocks)), entries(rows, blocks, use=use))[1])

    def fitted(rows, labelled, size, settled):
        seen[len(seen)] = {r["index"] for r in rows.select("index").distinct().collect()}
        return linear.Fitted(spark.createDataFrame([("Stock", -1, 1.0)], "class string, index int, weight double"), None, None)

    monkeypatch.setattr(linear, "fit_svm", fitted)
    found = training.ablation(assets, assets.select("id", "label", F.lit(1.0).alias("weight")), {"words": ("word", "category"), "categories": ("category",)}, **SIZES)
    (use, blocks), (_, word, number, category, end) = made[0], made[0][1].offsets
    assert len(made) == 1 and use == ("word", "category")
    assert seen[0] == {*range(word, number), *range(category, end)} and seen[1] == set(range(category, end))
    assert {r["blocks"]: r["n"] for r in found.groupBy("blocks").agg(F.sum("n").alias("n")).collect()}.keys() == {"words", "categories"}


def test_entries_are_packed_where_they_are_cut(spark, assets):
    """The packed entries of all blocks are those of tokens, counts and norms one by one, repeated ids and empty texts included; no token is moved."""
    rows = assets.drop("label").unionByName(assets.drop("label").where("id < 3").withColumn("column_names_text", F.lit("COIN_A | COIN_A | NEW"))).withColumn("source_ref", F.when(F.col("id") != 5, F.col("source_ref")))
    blocks = training.fit_blocks(assets, **SIZES)
    table = training.entries(rows, blocks)
    packed = linear.packed_rows(table)
    assert packed._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1 and "Generate" not in packed._jdf.queryExecution().executedPlan().toString()
    got = {}
    for r in packed.collect():
        assert list(r["indices"]) == sorted(r["indices"])
        got[r["id"]] = sorted((i, round(v, 9)) for i, v in zip(r["indices"], r["values"], strict=True))
    char, word, number, category, _ = blocks.offsets
    want = {}
    for kind, words, offset in (("char", blocks.chars, char), ("word", blocks.words, word)):
        for r in training.text_entries(training._grams(rows, kind), words).collect():
            want.setdefault(r["id"], []).append((r["at"] + offset, round(r["value"], 9)))
    scale = {r["name"]: (r["at"], r["scale"]) for r in blocks.scales.collect()}
    for r in features.with_numeric_features(rows.withColumns({"run_id": F.lit(0), "asset_id": F.col("id")})).collect():
        want[r["asset_id"]] += [(number + scale[n][0], round(r[n] / scale[n][1], 9)) for n in features.FEATURE_NAMES if r[n]]
    classes = {r["name"]: r["at"] for r in blocks.classes.collect()}
    for r in training._categories(rows).collect():
        want[r["id"]].append((category + classes[r["name"]], 1.0))
    assert got == {k: sorted(v) for k, v in want.items()} and table.count() == sum(map(len, got.values()))
    spread = features.with_numeric_features(assets.withColumns({"run_id": F.lit(0), "asset_id": F.col("id")})).agg(*[F.stddev_pop(n).alias(n) for n in features.FEATURE_NAMES]).first()
    assert all(r["scale"] == pytest.approx(spread[r["name"]] if spread[r["name"]] > 1e-9 else 1.0) for r in blocks.scales.collect()) and len(scale) == len(features.FEATURE_NAMES)
    coefficients = spark.createDataFrame([("a", 0, 2.0), ("b", word, -1.0), ("b", number + 3, 0.5), ("a", -1, 0.25), ("b", -1, -0.5)], "class string, index int, weight double")
    plain = {(r["id"], r["class"]): r["margin"] for r in training.margins(spark.createDataFrame(table.collect(), table.schema), coefficients).collect()}
    assert {(r["id"], r["class"]): r["margin"] for r in training.margins(table, coefficients).collect()} == pytest.approx(plain)


def test_a_fit_takes_few_passes(spark, monkeypatch):
    """A fit that need not be exact steps without products with the curvature, a pass for each step, and ends at the objective."""
    rng, n, size = np.random.default_rng(6), 400, 60
    x = (rng.random((n, size)) < np.linspace(0.01, 0.9, size)) * rng.normal(size=(n, size)) * np.geomspace(0.3, 3, size)
    at = (x @ rng.normal(size=(size, 2)) + 9 * rng.normal(size=(n, 2))).argmax(axis=1)
    entries = spark.createDataFrame([(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "id long, index int, value double")
    labelled = spark.createDataFrame([(i, "ab"[at[i]], 1.0) for i in range(n)], "id long, label string, weight double")
    monkeypatch.setattr(linear.SquaredHinge, "curved", lambda *_: pytest.fail("a product with the curvature"))
    fitted = linear.fit_svm(entries, labelled, size=size, rank=16, settled=1e-3)
    assert fitted.jobs < 100
    for r in fitted.objective.collect():
        assert r["objective"] == pytest.approx(plain_svm(x, np.where(at == "ab".index(r["class"]), 1.0, -1.0), np.ones(n))[1], rel=1e-2)
