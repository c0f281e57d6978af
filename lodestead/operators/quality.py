"""Quality and drift of a run's predictions: reports with alerts, rule audits, distribution shifts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.rules import Rules, first_match
from lodestead.functions.terms import counts
from lodestead.operators.classify import TERM_LABELS, TERMS, keyword_domain
from lodestead.operators.evaluate import distribution, recall_by_domain, run_divergence

#: Confidence bands of the report, in order.
REPORT_BANDS: Rules = (("very_low", "confidence < 0.40"), ("low", "confidence < 0.60"), ("medium", "confidence < 0.85"), ("high", "confidence >= 0.85"))
#: Limits beyond which an alert is raised.
LOW_SHARE, DIVERGENCE, SHARE_CHANGE, CONFIDENCE_DROP, MEAN_SHIFT = 0.15, 0.05, 0.10, 0.05, 0.30
#: Confidence of the audit, domains it is about, and terms that are shown.
AUDIT_CONFIDENCE, FOCUS, SHOWN_TERMS = 0.95, ("supply_chain", "procurement", "risk", "marketing"), 10


def quality_report(predictions: DataFrame, recalls: DataFrame) -> DataFrame:
    """A row per run: predictions, share of low confidence, certification, divergence from the run before, alerts.

    ``predictions(run_id, domain, confidence)``; ``recalls(label, recall, target, violation)``
    of a reference evaluation, without which nothing is certified.
    """
    bands = predictions.withColumn("band", first_match(REPORT_BANDS))
    own = bands.groupBy("run_id").agg(
        F.count("*").alias("n_scored"),
        F.round(F.count_if(F.col("band").isin("very_low", "low")) / F.count("*"), 4).alias("low_share"),
        *[F.count_if(F.col("band") == b).alias(f"n_{b}") for b, _ in REPORT_BANDS],
    )
    sla = recalls.where("target is not null").agg(
        F.count("*").alias("_n"), F.array_sort(F.collect_list(F.when(F.col("violation"), F.concat(F.lit("sla_violation:"), "label")))).alias("_violations")
    )
    drift = run_divergence(predictions, "domain").select("run_id", F.round("divergence", 8).alias("divergence"))
    joined = own.join(drift, "run_id", "left").crossJoin(F.broadcast(sla))
    alerts = F.concat(
        F.array_compact(F.array(F.when(F.col("low_share") > LOW_SHARE, "low_confidence"))),
        F.col("_violations"),
        F.array_compact(F.array(F.when(F.col("_n") == 0, "no_reference"), F.when(F.col("divergence") > DIVERGENCE, "drift"))),
    )
    return joined.select(
        "run_id", "n_scored", "low_share", *[f"n_{b}" for b, _ in REPORT_BANDS], ((F.col("_n") > 0) & (F.size("_violations") == 0)).alias("sla_ok"), "divergence",
        F.coalesce(F.col("divergence") > DIVERGENCE, F.lit(False)).alias("drift_alert"), F.array_join(alerts, ",").alias("alerts"),
    )


def certified(scored: DataFrame, sla: DataFrame) -> DataFrame:
    """One row: whether every class with a recall target reaches it; without any such class nothing is certified."""
    own = recall_by_domain(scored, sla).where("target is not null")
    return own.agg(F.count("*").alias("classes"), F.count_if("violation").alias("violations"), (F.count_if(~F.col("violation")) == F.count("*")).alias("_all")).select(
        "classes", "violations", ((F.col("classes") > 0) & F.col("_all")).alias("certified")
    )


def latest_report(reports: DataFrame) -> DataFrame:
    """The report of the greatest run."""
    return reports.groupBy().agg(F.max_by(F.struct(*reports.columns), "run_id").alias("r")).select("r.*")


def previous_snapshot(snapshots: DataFrame, run_id: int) -> DataFrame:
    """The rows of the latest run before the given one."""
    before = snapshots.where(F.col("run_id") < run_id)
    return before.join(F.broadcast(before.agg(F.max("run_id").alias("run_id"))), "run_id", "left_semi")


def drift_report(rows: DataFrame, *, label: str = "domain", structure: tuple[str, ...] = ()) -> DataFrame:
    """A row per run with the alerts against the run before: class shares, mean confidence,
    share of low confidence, means of the structural columns."""
    means = rows.groupBy("run_id").agg(
        F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence"), F.avg((F.col("confidence") < 0.60).cast("double")).alias("low_share"), *[F.avg(c).alias(f"mean_{c}") for c in structure]
    )
    w = Window.orderBy("run_id")
    shares = distribution(rows, label, ("run_id",))
    runs, classes = shares.select("run_id").distinct(), shares.select("label").distinct()
    full = runs.crossJoin(F.broadcast(classes)).join(shares.select("run_id", "label", "share"), ["run_id", "label"], "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    moved = full.withColumn("change", F.col("share") - F.lag("share").over(Window.partitionBy("label").orderBy("run_id")))
    classes_moved = moved.where(F.abs("change") > SHARE_CHANGE).groupBy("run_id").agg(F.array_sort(F.collect_list(F.concat(F.lit("class:"), "label"))).alias("_classes"))
    # A row per run is ordered here.
    means = means.withColumn("_confidence", F.lag("mean_confidence").over(w))
    shifts: list[Column] = []
    for c in structure:
        before = F.lag(f"mean_{c}").over(w)
        shifts.append(F.when(F.abs(F.col(f"mean_{c}") - before) / F.greatest(before, F.lit(1.0)) > MEAN_SHIFT, f"mean:{c}"))
    means = means.withColumn("_shifts", F.array_compact(F.array(*shifts)) if shifts else F.array().cast("array<string>"))
    own = F.array_compact(F.array(F.when(F.col("mean_confidence") < F.col("_confidence") - CONFIDENCE_DROP, "confidence"), F.when(F.col("low_share") > LOW_SHARE, "low_confidence")))
    out = means.join(classes_moved, "run_id", "left").withColumn("alerts", F.concat(F.coalesce("_classes", F.array().cast("array<string>")), own, "_shifts"))
    return out.select("run_id", "n", F.round("mean_confidence", 6).alias("mean_confidence"), F.round("low_share", 6).alias("low_share"), F.array_join("alerts", ",").alias("alerts"), (F.size("alerts") == 0).alias("ok"))


def distribution_shift(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: the greatest change of a class's share between two ``(label, share)`` tables."""
    both = a.select("label", F.col("share").alias("p")).join(b.select("label", F.col("share").alias("q")), "label", "full")
    return both.agg(F.coalesce(F.max(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))), F.lit(0.0)).alias("max_change"))


def term_audit(dataset: DataFrame, text: Column, terms: dict[str, tuple[str, ...]] = TERMS) -> DataFrame:
    """Every asset classified by terms alone, with hits by domain and the terms that were found for the winner."""
    told = keyword_domain(dataset, text, terms, labels=None, keep=True)
    hits = {f"hits_{d}": n for d, n in counts(F.col("_matches"), terms).items()}
    winner = F.array_position(F.array(*map(F.lit, terms)), F.col("domain")) - 1
    found = F.transform(F.filter("_matches", lambda m: m["list"] == winner), lambda m: m["term"])
    shown = F.array_join(F.slice(F.array_sort(F.array_distinct(found)), 1, SHOWN_TERMS), ", ")
    label = F.create_map(*[F.lit(x) for pair in TERM_LABELS.items() for x in pair])[F.col("domain")]
    return told.select(
        "run_id", "asset_id", F.col("domain").alias("kw_domain"), F.coalesce(label, F.lit("Inconnu")).alias("kw_label"), F.when(F.col("domain").isNotNull(), F.lit(AUDIT_CONFIDENCE)).alias("kw_confidence"),
        F.col("domain").isNotNull().alias("classified"), F.coalesce(F.col("domain").isin(*FOCUS), F.lit(False)).alias("is_focus_domain"), F.coalesce(shown, F.lit("")).alias("matched_terms"),
        *[sql.alias(n) for n, sql in hits.items()],
    )


def audit_summary(audit: DataFrame) -> DataFrame:
    """Assets by domain of the audit, and how many of the whole are in focus."""
    return audit.groupBy(F.coalesce("kw_domain", F.lit("unclassified")).alias("kw_domain")).agg(F.count("*").alias("assets"), F.count_if("is_focus_domain").alias("focus"))
