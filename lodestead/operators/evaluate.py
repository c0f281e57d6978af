"""Classifier evaluation and monitoring from tables of predictions and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.ranks import bucketed

#: Recall that each regulated domain has to reach.
RECALL_SLA = (("Finance", 0.90), ("HR", 0.90), ("Procurement", 0.90), ("Sales", 0.90))


def distribution(df: DataFrame, label: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """Share of each class (within the keys)."""
    counts = df.groupBy(*keys, F.col(label).alias("label")).agg(F.count("*").alias("n"))
    total = counts.groupBy(*keys).agg(F.sum("n").alias("total")) if keys else counts.agg(F.sum("n").alias("total"))
    joined = counts.join(F.broadcast(total), list(keys)) if keys else counts.crossJoin(F.broadcast(total))
    return joined.select(*keys, "label", "n", (F.col("n") / F.col("total")).alias("share"))


def js_divergence(p: DataFrame, q: DataFrame, epsilon: float = 1e-10) -> DataFrame:
    """One row: Jensen-Shannon divergence (natural logarithm) of two ``(label, share)`` tables."""
    both = p.select("label", F.col("share").alias("p")).join(q.select("label", F.col("share").alias("q")), "label", "full")
    raised = both.select((F.coalesce("p", F.lit(0.0)) + epsilon).alias("p"), (F.coalesce("q", F.lit(0.0)) + epsilon).alias("q"))
    total = F.broadcast(raised.agg(F.sum("p").alias("sp"), F.sum("q").alias("sq")))
    scaled = raised.crossJoin(total).select((F.col("p") / F.col("sp")).alias("p"), (F.col("q") / F.col("sq")).alias("q")).withColumn("m", (F.col("p") + F.col("q")) / 2)
    return scaled.agg((F.sum(F.col("p") * F.log(F.col("p") / F.col("m")) + F.col("q") * F.log(F.col("q") / F.col("m"))) / 2).alias("divergence"))


def run_divergence(predictions: DataFrame, label: str) -> DataFrame:
    """Divergence of every run's class distribution from the run before it."""
    shares = distribution(predictions, label, ("run_id",))
    labels = predictions.select(F.col(label).alias("label")).distinct()
    runs = predictions.select("run_id").distinct()
    full = runs.crossJoin(F.broadcast(labels)).join(shares, ["run_id", "label"], "left").select("run_id", "label", (F.coalesce("share", F.lit(0.0)) + 1e-10).alias("share"))
    w = Window.partitionBy("label").orderBy("run_id")
    pairs = full.select("run_id", F.col("share").alias("p"), F.lag("share").over(w).alias("q")).where("q is not null").withColumn("m", (F.col("p") + F.col("q")) / 2)
    term = F.col("p") * F.log(F.col("p") / F.col("m")) + F.col("q") * F.log(F.col("q") / F.col("m"))
    return pairs.groupBy("run_id").agg((F.sum(term) / 2).alias("divergence")).withColumn("alert", F.col("divergence") > 0.05)


def confidence_bins(df: DataFrame, band: Column, confidence: str = "confidence") -> DataFrame:
    return df.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.avg(confidence).alias("mean_confidence"))


def usable_labels(df: DataFrame, label: str = "human_label", ambiguous: str = "ambiguous") -> DataFrame:
    """Rows with a label that is neither empty nor ambiguous."""
    return df.where((F.trim(F.coalesce(F.col(label), F.lit(""))) != "") & (F.lower(F.trim(F.col(label))) != ambiguous))


def calibration(df: DataFrame, band: Column, predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    right = (F.col(predicted) == F.col(label)).cast("double")
    out = df.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg(right).alias("accuracy"))
    return out.withColumn("gap", F.col("accuracy") - F.col("mean_confidence"))


def expected_calibration_error(bands: DataFrame) -> DataFrame:
    """One row: mean distance of accuracy and confidence by band, and its status; no band gives 0."""
    ece = F.coalesce(F.try_divide(F.sum(F.col("n") * F.abs(F.col("accuracy") - F.col("mean_confidence"))), F.sum("n")), F.lit(0.0))
    return bands.agg(ece.alias("ece")).withColumn("status", F.when(F.col("ece") <= 0.05, "OK").when(F.col("ece") <= 0.15, "WARNING").otherwise("CRITICAL"))


def recall_by_domain(df: DataFrame, sla: DataFrame, predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    right = (F.col(predicted) == F.col(label)).cast("double")
    recall = df.groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"), F.avg(right).alias("recall"))
    return recall.join(F.broadcast(sla), "label", "left").withColumn("violation", F.coalesce(F.col("recall") < F.col("target"), F.lit(False)))


def confusion(df: DataFrame, predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(predicted).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, labels: list[str], predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).pivot(predicted, labels).count().fillna(0)


def class_scores(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of every class that is a label or a prediction."""
    right = F.when(F.col("label") == F.col("predicted"), F.col("n")).otherwise(0)
    by_label = counts.groupBy("label").agg(F.sum("n").alias("support"), F.sum(right).alias("hit"))
    by_predicted = counts.groupBy(F.col("predicted").alias("label")).agg(F.sum("n").alias("made"))
    zero = F.lit(0).cast("long")
    both = by_label.join(by_predicted, "label", "full").select("label", *[F.coalesce(c, zero).alias(c) for c in ("support", "hit", "made")])
    p, r = F.coalesce(F.try_divide("hit", "made"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    return both.select("label", "support", "made", "hit", p.alias("precision"), r.alias("recall"), F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0)).alias("f1"))


def overall_scores(counts: DataFrame) -> DataFrame:
    """One row: accuracy, macro and weighted F1, Cohen's kappa."""
    scores = class_scores(counts)
    n = F.sum("support")
    accuracy, chance = F.sum("hit") / n, F.sum(F.col("support") * F.col("made")) / (n * n)
    return scores.agg(
        n.alias("n"), accuracy.alias("accuracy"), F.avg("f1").alias("macro_f1"), (F.sum(F.col("f1") * F.col("support")) / n).alias("weighted_f1"),
        F.try_divide(accuracy - chance, 1 - chance).alias("kappa"),
    )


def top_confusions(counts: DataFrame, limit: int = 10) -> DataFrame:
    return counts.where("label <> predicted").orderBy(F.desc("n"), "label", "predicted").limit(limit)


def accuracy_by(df: DataFrame, *slices: str, predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    return df.groupBy(*slices).agg(F.count("*").alias("n"), F.avg((F.col(predicted) == F.col(label)).cast("double")).alias("accuracy"))


def coverage_report(df: DataFrame, predicted: str = "predicted", label: str = "human_label") -> DataFrame:
    """Confidence and agreement by predicted class, with its share of all."""
    own = df.groupBy(F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.min("confidence").alias("min_confidence"),
        F.avg((F.col("confidence") >= 0.85).cast("double")).alias("share_high"), F.avg((F.col(predicted) == F.col(label)).cast("double")).alias("agreement"),
    )
    return own.crossJoin(F.broadcast(own.agg(F.sum("n").alias("total")))).select("*", (F.col("n") / F.col("total")).alias("share")).drop("total")


def softmax(scores: Column) -> Column:
    """Probabilities of an array of scores, shifted by their maximum."""
    shifted = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
    return F.transform(shifted, lambda e: e / F.aggregate(shifted, F.lit(0.0), lambda a, b: a + b))


def top_two(scores: Column, labels: list[str] | None = None) -> Column:
    """Struct of the two best classes with their scores; ties keep the order of the classes.

    Classes without labels are ``class_0`` and so on.
    """
    order = F.array_sort(F.transform(scores, lambda s, i: F.struct((-s).alias("s"), i.alias("i"))))

    def name(k: int) -> Column:
        at = order[k]["i"]
        return F.concat(F.lit("class_"), at.cast("string")) if labels is None else F.array(*[F.lit(x) for x in labels])[at]

    return F.struct(name(0).alias("top1"), (-order[0]["s"]).alias("p1"), name(1).alias("top2"), (-order[1]["s"]).alias("p2"))


def review_flags(predicted: Column, band: Column, p1: Column, p2: Column, margin: float = 0.05) -> Column:
    """Comma-joined reasons for a review; empty for none."""
    reasons = [F.when(band == "low", "low_model_confidence"), F.when(predicted == "Other", "predicted_other"), F.when(p1 - p2 <= margin + 1e-12, "close_top2_scores")]
    return F.array_join(F.array_compact(F.array(*reasons)), ",")


def share_drift(shares: DataFrame, limit: float = 0.10) -> DataFrame:
    """Change of every class's share from run to run, with an alert beyond the limit."""
    runs, classes = shares.select("run_id").distinct(), shares.select("label").distinct()
    full = runs.crossJoin(F.broadcast(classes)).join(shares.select("run_id", "label", "share"), ["run_id", "label"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    change = F.col("share") - F.lag("share").over(Window.partitionBy("label").orderBy("run_id"))
    return full.withColumn("change", change).where("change is not null").withColumn("alert", F.abs("change") > limit)


def regression_gate(candidate: DataFrame, production: DataFrame, *, slack: float = 0.01, least_f1: float = 0.80, least_accuracy: float = 0.85) -> DataFrame:
    """One row: does a candidate stay within the slack of production, and does it reach the floors?

    Both inputs are one-row results of `overall_scores`.
    """
    a = candidate.select(F.col("macro_f1").alias("candidate_f1"), F.col("accuracy").alias("candidate_accuracy"))
    b = production.select(F.col("macro_f1").alias("production_f1"))
    both = a.crossJoin(F.broadcast(b))
    return both.withColumns({
        "no_regression": F.col("candidate_f1") - F.col("production_f1") >= -slack,
        "above_floors": (F.col("candidate_f1") >= least_f1) & (F.col("candidate_accuracy") >= least_accuracy),
    })


def compared(new: DataFrame, baseline: DataFrame) -> DataFrame:
    """One row: two one-row results of `overall_scores` side by side."""
    a = new.select(F.col("accuracy").alias("a"), F.col("macro_f1").alias("f"))
    b = baseline.select(F.col("accuracy").alias("b"), F.col("macro_f1").alias("g"))
    return a.crossJoin(F.broadcast(b)).select(F.round("a", 6).alias("new_accuracy"), F.round("b", 6).alias("baseline_accuracy"), F.round(F.col("f") - F.col("g"), 6).alias("macro_f1_gain"))


def roc_points(scores: DataFrame, label: str = "label") -> DataFrame:
    """``(class, threshold, tpr, fpr, area)`` of ``scores(id, class, score, label)``, each class against the rest.

    A point for each distinct score, which stands for all rows of at least that score;
    ``area`` is what the step to it adds to the area under the curve, by the trapezoid.  Rows
    are counted by score first, then summed over ranges of scores, and only within a range are
    scores ordered.  Classes without rows of their own, or without others, have no curve; null scores are
    left out.
    """
    own = F.col(label) == F.col("class")
    counted = scores.where("score is not null").groupBy("class", "score").agg(F.count_if(own).alias("_pos"), F.count_if(F.coalesce(~own, F.lit(True))).alias("_neg"))
    placed = bucketed(counted, ("class",), "score")
    ranges = placed.groupBy("class", "_bucket").agg(F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n"))
    above, whole = Window.partitionBy("class").orderBy(F.desc("_bucket")).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("class")
    ranges = ranges.select("class", "_bucket", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"{c}_above") for c in ("_p", "_n")), *(F.sum(c).over(whole).alias(f"{c}_all") for c in ("_p", "_n")))
    inside = Window.partitionBy("class", "_bucket").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    points = placed.join(ranges.where("_p_all > 0 and _n_all > 0"), ["class", "_bucket"])
    tp, fp = F.col("_p_above") + F.sum("_pos").over(inside), F.col("_n_above") + F.sum("_neg").over(inside)
    points = points.withColumns({"tpr": tp / F.col("_p_all"), "fpr": fp / F.col("_n_all")})
    before = F.col("tpr") - F.col("_pos") / F.col("_p_all")
    return points.select("class", F.col("score").alias("threshold"), "tpr", "fpr", (F.col("_neg") / F.col("_n_all") * (F.col("tpr") + before) / 2).alias("area"), before.alias("tpr_before"), (F.col("fpr") - F.col("_neg") / F.col("_n_all")).alias("fpr_before"))


def roc_areas(points: DataFrame) -> DataFrame:
    """``(class, auc)`` of `roc_points`, and their mean as class ``macro``."""
    by_class = points.groupBy("class").agg(F.sum("area").alias("auc"))
    return by_class.unionByName(by_class.agg(F.lit("macro").alias("class"), F.avg("auc").alias("auc")))


def macro_curve(points: DataFrame, steps: int = 100) -> DataFrame:
    """``(fpr, tpr)``: the mean of all classes' curves at ``steps + 1`` false positive rates, between points by a straight line, at a jump its top."""
    low, high = F.ceil(F.round(F.col("fpr_before") * steps, 9)), F.floor(F.round(F.col("fpr") * steps, 9))
    own = points.where(low <= high).withColumn("at", F.explode(F.sequence(low, high)))
    share = F.coalesce(F.try_divide(F.col("at") / steps - F.col("fpr_before"), F.col("fpr") - F.col("fpr_before")), F.lit(1.0))
    height = F.col("tpr_before") + share * (F.col("tpr") - F.col("tpr_before"))
    by_class = own.groupBy("class", "at").agg(F.max(height).alias("tpr"))
    return by_class.groupBy((F.col("at") / steps).alias("fpr")).agg(F.avg("tpr").alias("tpr"))
