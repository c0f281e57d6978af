"""Comparing learners on the same folds, with parameters drawn at random.

Every candidate predicts each labelled row by a model that has not seen the row's fold; the
candidates' confusions are one table, from which scores and ranks follow.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestead.operators import forest, linear
from lodestead.sources.shared import written

FOLDS = 3


@dataclass(frozen=True)
class Candidate:
    learner: str
    parameters: tuple[tuple[str, float], ...]

    @property
    def text(self) -> str:
        return ", ".join(f"{k}={v:g}" for k, v in self.parameters)


def drawn(draws: dict[str, int], seed: int = 7) -> list[Candidate]:
    """So many candidates of each learner, with parameters from its ranges; the same for the same seed."""
    random, out = np.random.default_rng(seed), []
    for learner, n in draws.items():
        for _ in range(n):
            if learner == "svm":
                own = (("c", round(float(10 ** random.uniform(-2, 0.5)), 4)),)
            elif learner == "forest":
                own = (("trees", int(random.integers(10, 30))), ("depth", int(random.integers(4, 8))), ("tried", int(random.integers(8, 40))))
            elif learner == "naive_bayes":
                own = (("alpha", round(float(10 ** random.uniform(-2, 0.5)), 4)),)
            elif learner == "logistic":
                own = (("regularisation", round(float(10 ** random.uniform(-3, -1)), 5)),)
            else:
                raise ValueError(f"no learner is named {learner}")
            out.append(Candidate(learner, own))
    return out


def naive_bayes(entries: DataFrame, rows: DataFrame, *, alpha: float, size: int) -> DataFrame:
    """``(id, label, predicted)``: multinomial naive Bayes of ``rows(id, label, weight, fold)``, without the row's fold.

    A fold's sums are those of all rows without its own.  What a class has of an index that it was never seen with
    depends on the class only, so the join meets the pairs that occur.
    """
    known = entries.join(rows, "id")
    own = written(known.groupBy("fold", "label", "index").agg(F.sum(F.col("weight") * F.col("value")).alias("s")), "sums")
    folds = rows.select("fold").distinct()
    models = own.withColumnRenamed("fold", "_of").crossJoin(F.broadcast(folds)).where("_of <> fold").groupBy("fold", "label", "index").agg(F.sum("s").alias("s"))
    totals = models.groupBy("fold", "label").agg(F.sum("s").alias("total"))
    priors = rows.groupBy("label", F.col("fold").alias("_of")).agg(F.sum("weight").alias("w")).crossJoin(F.broadcast(folds)).where("_of <> fold").groupBy("fold", "label").agg(F.sum("w").alias("w"))
    base = priors.join(totals, ["fold", "label"], "left").select("fold", "label", F.log("w").alias("prior"), (F.log(F.lit(alpha)) - F.log(F.coalesce("total", F.lit(0.0)) + alpha * size)).alias("unseen"))
    seen = known.select("id", "fold", "index", "value").join(models, ["fold", "index"]).groupBy("id", "label").agg(F.sum(F.col("value") * (F.log(F.col("s") + alpha) - F.log(F.lit(alpha)))).alias("seen"))
    mass = known.groupBy("id").agg(F.sum("value").alias("mass"))
    truth = rows.select("id", "fold", F.col("label").alias("truth")).join(mass, "id", "left")
    each = truth.join(F.broadcast(base), "fold").join(seen, ["id", "label"], "left")
    score = F.col("prior") + F.coalesce("mass", F.lit(0.0)) * F.col("unseen") + F.coalesce("seen", F.lit(0.0))
    best = each.groupBy("id", "truth").agg(F.min_by("label", F.struct((-F.round(score, 9)).alias("minus"), "label")).alias("predicted"))
    return best.select("id", F.col("truth").alias("label"), "predicted")


def _svm(entries: DataFrame, rows: DataFrame, c: float, size: int, settled: float) -> DataFrame:
    unseen = linear.fit_svm(entries, rows.select("id", "label", "weight"), size=size, c=c, folds=FOLDS, settled=settled).unseen
    return unseen.groupBy("id", "label").agg(F.min_by("class", F.struct((-F.col("margin")).alias("minus"), "class")).alias("predicted"))


def _logistic(train: DataFrame, regularisation: float) -> DataFrame:
    """Spark's multinomial logistic model of ``train(id, label, weight, features, fold)``, a fit for each fold."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import IndexToString, StringIndexer

    coded = StringIndexer(inputCol="label", outputCol="at").fit(train)
    out = None
    for k in range(FOLDS):
        fitted = LogisticRegression(labelCol="at", weightCol="weight", regParam=regularisation, maxIter=30).fit(coded.transform(train.where(F.col("fold") != k)))
        own = IndexToString(inputCol="prediction", outputCol="predicted", labels=coded.labels).transform(fitted.transform(coded.transform(train.where(F.col("fold") == k)))).select("id", "label", "predicted")
        out = own if out is None else out.unionByName(own)
    return out


def compared(entries: DataFrame, numbers: tuple[int, int], labelled: DataFrame, size: int, candidates: list[Candidate], *, settled: float = 1e-2) -> DataFrame:
    """``(learner, parameters, label, predicted, n)``: confusions of all candidates on the same folds of ``labelled(id, label, weight)``.

    Folds go by a hash of the id, as in `linear.fit_svm`.  Forests see the indices in
    ``numbers``, naive Bayes those outside it, linear models all.
    """
    from lodestead.operators.training import vectors

    spark = entries.sparkSession
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    rows = written(labelled.select("id", "label", F.col("weight").cast("double").alias("weight"), fold.alias("fold")), "folded")
    classes = sorted(r["label"] for r in rows.select("label").distinct().collect())
    places = spark.createDataFrame(list(enumerate(classes)), "label_at int, label string")
    low, high = numbers
    binned = written(linear.packed(entries.where((F.col("index") >= low) & (F.col("index") < high)).withColumn("index", (F.col("index") - low).cast("int")), rows.join(F.broadcast(places), "label").withColumn("key", F.xxhash64("id"))), "binned") if any(c.learner == "forest" for c in candidates) else None
    cuts = forest.bin_cuts(binned.select(F.explode(F.arrays_zip("indices", "values")).alias("e")).select("e.indices", "e.values").toDF("index", "value"), high - low) if binned is not None else []
    train = None
    out = None
    for c in candidates:
        p = dict(c.parameters)
        if c.learner == "svm":
            own = _svm(entries, rows, p["c"], size, settled)
        elif c.learner == "naive_bayes":
            own = naive_bayes(entries.where((F.col("index") < low) | (F.col("index") >= high)), rows, alpha=p["alpha"], size=size - (high - low))
        elif c.learner == "forest":
            grown = forest.grow_forest(binned, cuts, len(classes), folds=FOLDS, trees=p["trees"], depth=p["depth"], tried=p["tried"])
            own = forest.forest_shares(binned, grown, classes, by_fold=True).join(F.broadcast(places), "label_at").select("label", "predicted")
        else:
            train = train if train is not None else vectors(entries, size, rows.select("id", "label", "weight")).withColumn("fold", fold)
            own = _logistic(train, p["regularisation"])
        table = own.groupBy("label", "predicted").agg(F.count("*").alias("n")).select(F.lit(c.learner).alias("learner"), F.lit(c.text).alias("parameters"), "label", "predicted", "n")
        out = table if out is None else out.unionByName(table)
    return written(out, "comparison")


def ranked(confusions: DataFrame) -> DataFrame:
    """``(rank, learner, parameters, accuracy, macro_f1)``, best macro F1 first, ties by accuracy, then names; a row per candidate is ordered."""
    key = ["learner", "parameters"]
    hit = F.sum(F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0))
    truth = confusions.groupBy(*key, F.col("label").alias("c")).agg(F.sum("n").alias("support"), hit.alias("hit"))
    made = confusions.groupBy(*key, F.col("predicted").alias("c")).agg(F.sum("n").alias("made"))
    f1 = truth.join(made, [*key, "c"], "left").withColumn("f1", 2 * F.col("hit") / (F.col("support") + F.coalesce("made", F.lit(0))))
    scores = f1.groupBy(*key).agg((F.sum("hit") / F.sum("support")).alias("accuracy"), F.avg("f1").alias("macro_f1"))
    order = Window.orderBy(F.desc(F.round("macro_f1", 9)), F.desc("accuracy"), *key)
    return scores.select(F.row_number().over(order).alias("rank"), *key, "accuracy", "macro_f1")
