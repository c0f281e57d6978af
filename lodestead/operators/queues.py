"""Queues of what people should look at: review, relabelling, uncertainty, error slices, weighted samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.operators.labels import first_of_strata, first_wins

#: Points of an uncertain prediction.
POINTS = {"is_other": 60, "is_borderline": 35, "is_rare_predicted": 25, "is_rare_label": 20, "is_error": 15}


def merged_queues(keys: tuple[str, ...], *queues: tuple[str, DataFrame]) -> DataFrame:
    """Queues under their reasons as one; a key that several have keeps the first reason."""
    out = None
    for place, (reason, df) in enumerate(queues):
        own = df.withColumns({"reason": F.lit(reason), "_place": F.lit(place)})
        out = own if out is None else out.unionByName(own, allowMissingColumns=True)
    return first_wins(out, keys, F.col("_place")).drop("_place")


def label_review_queue(consensus: DataFrame, votes: DataFrame, pair: tuple[str, str], *, gold: float = 0.7, floor: float = 0.5) -> DataFrame:
    """Low consensus, coin flips, and assets with votes for both labels of ``pair``, once each."""
    flip = (F.col("consensus") == floor) & (F.col("valid_votes") == 2)
    low = (F.col("consensus") >= floor) & (F.col("consensus") < gold) & ~flip
    both = votes.where(F.col("label").isin(*pair)).groupBy("asset_id").agg(F.countDistinct("label").alias("n")).where("n = 2").select("asset_id")
    return merged_queues(
        ("asset_id",),
        ("low_consensus", consensus.where(low)),
        ("coin_flip_reject", consensus.where(flip)),
        ("label_pair_confusion", consensus.join(both, "asset_id", "left_semi")),
    )


def normalised_entropy(scores: Column) -> Column:
    """Entropy of an array of probabilities, between 0 and 1."""
    terms = F.transform(scores, lambda p: -p * F.log(F.greatest(p, F.lit(1e-12))))
    return F.aggregate(terms, F.lit(0.0), lambda a, b: a + b) / F.log(F.greatest(F.size(scores), F.lit(2)).cast("double"))


def uncertainty_queue(scored: DataFrame, rare: DataFrame, *, margin: float = 0.10, top: int = 500) -> DataFrame:
    """The predictions that most deserve a look, by points and then low confidence.

    ``scored(id, label, predicted, p1, p2)``; ``rare(label)`` names the rare classes, a
    row per class.
    """
    names = F.broadcast(rare.select("label").distinct())
    told = scored.join(names.select(F.col("label").alias("predicted"), F.lit(True).alias("_rp")), "predicted", "left").join(names.select("label", F.lit(True).alias("_rl")), "label", "left")
    flags = {
        "is_other": F.lower("predicted") == "other", "is_borderline": F.col("p1") - F.col("p2") <= margin, "is_rare_predicted": F.coalesce("_rp", F.lit(False)),
        "is_rare_label": F.coalesce("_rl", F.lit(False)), "is_error": ~F.col("label").eqNullSafe(F.col("predicted")),
    }
    told = told.withColumns(flags).drop("_rp", "_rl")
    priority = F.round((1 - F.col("p1")) * 100, 2)
    for name, points in POINTS.items():
        priority = priority + F.when(F.col(name), points).otherwise(0)
    wanted = F.col("is_other") | F.col("is_borderline") | F.col("is_rare_predicted") | F.col("is_rare_label")
    return told.where(wanted).withColumn("review_priority", priority).orderBy(F.desc("review_priority"), "p1", *[c for c in scored.columns if c not in ("p1", "p2")]).limit(top)


def relabelling_set(predictions: DataFrame, key: str, confused: tuple[tuple[str, str], ...], right: tuple[str, ...], rare: tuple[str, ...]) -> DataFrame:
    """Confused pairs and rare classes first, right answers of some classes after; each key once."""
    label, predicted = F.col("label"), F.col("predicted")
    wrong = F.lit(False)
    for a, b in confused:
        wrong = wrong | ((label == a) & (predicted == b))
    high = predictions.where(wrong | label.isin(*rare)).withColumn("review_priority", F.lit("high"))
    medium = predictions.where(label.isin(*right) & (label == predicted)).withColumn("review_priority", F.lit("medium"))
    return first_wins(high.unionByName(medium).where(F.col(key).isNotNull()), (key,), F.when(F.col("review_priority") == "high", 0).otherwise(1), label, predicted)


def error_slices(predictions: DataFrame, pairs: tuple[tuple[str, str], ...], right: str) -> DataFrame:
    """Rows under the name of each slice they belong to: all errors, two-class confusions, right answers of one class."""
    label, predicted = F.col("label"), F.col("predicted")
    slices = [F.when(label != predicted, "all_errors")]
    slices += [F.when((label == a) & (predicted == b), f"{a}_as_{b}") for a, b in pairs]
    slices.append(F.when((label == right) & (predicted == right), f"{right}_right"))
    return predictions.withColumn("slice", F.explode(F.array_compact(F.array(*slices))))


def contested(scored: DataFrame, annotated: DataFrame, disagreement: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows nobody has annotated yet on which two models differ."""
    return scored.join(annotated.select(*keys).distinct(), list(keys), "left_anti").join(disagreement.select(*keys).distinct(), list(keys), "left_semi")


def review_weighted_sample(scored: DataFrame, stratum: str, size: int, *, review: str, key: str, ratio: float = 0.6) -> DataFrame:
    """About ``size`` rows, equally from each stratum, ``ratio`` of them flagged for review;
    where one kind has too few, the other fills up.  The order is that of a digest."""
    flagged = F.coalesce(F.col(review), F.lit(False))
    kinds = scored.withColumn("_flagged", flagged)
    counts = kinds.groupBy(stratum).agg(F.count_if("_flagged").alias("flagged"), F.count_if(~F.col("_flagged")).alias("plain"))
    each = F.greatest(F.floor(F.lit(size) / F.count("*").over(Window.partitionBy())), F.lit(1))
    take = F.least(each, F.col("flagged") + F.col("plain"))
    first = F.least(F.col("flagged"), F.bround(take * ratio).cast("long"))
    quotas = counts.withColumns({"take": take, "first": first}).select(
        stratum,
        F.when((F.col("take") - F.col("first")) > F.col("plain"), F.least(F.col("flagged"), F.col("take") - F.col("plain"))).otherwise(F.col("first")).alias("_f"),
        F.least(F.col("take") - F.col("first"), F.col("plain")).alias("_p"),
    )
    by_kind = quotas.select(stratum, F.lit(True).alias("_flagged"), F.col("_f").alias("target")).unionByName(quotas.select(stratum, F.lit(False).alias("_flagged"), F.col("_p").alias("target")))
    return first_of_strata(kinds, (stratum, "_flagged"), by_kind, key=key).drop("_flagged").orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit("shuffle"))), key)


def reattached(rows: DataFrame, source: DataFrame, content: tuple[str, ...], ident: str) -> DataFrame:
    """Rows with the ident of the source row of equal content, the least one where several are equal; nulls are equal."""
    ids = source.groupBy(*content).agg(F.min(ident).alias(ident))
    left, right = rows.alias("l"), ids.alias("r")
    same = F.lit(True)
    for c in content:
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return left.join(right, same, "left").select("l.*", F.col(f"r.{ident}").alias(ident))


def new_names(assets: DataFrame, name: str, *known: DataFrame) -> DataFrame:
    """Assets whose name none of the other tables has."""
    seen = known[0].select(name)
    for df in known[1:]:
        seen = seen.union(df.select(name))
    return assets.join(seen.distinct(), name, "left_anti")


def united_labels(*sources: DataFrame, key: str = "asset_id", ambiguous: str = "ambiguous") -> DataFrame:
    """Usable labels of several sources; the first source that has one for a key wins."""
    out = None
    for rank, df in enumerate(sources):
        own = df.select(key, "label", F.lit(rank).alias("rank")).where((F.trim(F.coalesce("label", F.lit(""))) != "") & (F.lower(F.trim("label")) != ambiguous))
        out = own if out is None else out.unionByName(own)
    return out.groupBy(key).agg(F.min_by("label", F.struct("rank", "label")).alias("label"), F.min("rank").alias("source_rank"))


def physical_objects(assets: DataFrame, tables: DataFrame) -> DataFrame:
    """Assets with the owner and table that each can be read from, if its name and a known table allow it."""
    named = assets.withColumn("_name", F.upper(F.trim(F.coalesce("source_ref", "technical_name"))))
    known = tables.select("run_id", "owner", "table_name", F.upper("table_name").alias("_name"))
    safe = F.col("table_name").rlike("^[A-Za-z0-9_$#]+$")
    found = named.join(known, ["run_id", "_name"], "left")
    return found.select(*assets.columns, F.when(safe, F.col("owner")).alias("object_owner"), F.when(safe, F.col("table_name")).alias("object_table"))
