"""Label lifecycle: votes, tiers, queues and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.text import SPARK, module_prefix


def vote_consensus(votes: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Winner of each asset's valid votes; the first seen (then by name) wins a tie, which needs adjudication."""
    valid = votes.where(F.col("label").isin(*allowed))
    counts = valid.groupBy("asset_id", "label").agg(F.count("*").alias("n"), F.min("vote_no").alias("seen"))
    best = counts.groupBy("asset_id").agg(
        F.min_by(F.struct("label", "n"), F.struct((-F.col("n")).alias("n"), "seen", "label")).alias("w"), F.sum("n").alias("valid_votes"), F.array_sort(F.collect_list("n")).alias("all")
    )
    tied = F.size(F.filter("all", lambda n: n == F.col("w.n"))) > 1
    score = F.col("w.n") / F.col("valid_votes")
    return best.select("asset_id", F.col("w.label").alias("label"), F.col("w.n").alias("votes"), "valid_votes", score.alias("consensus"), (tied | (score < 0.5)).alias("needs_adjudication"))


def vote_disagreement(votes: DataFrame, allowed: tuple[str, ...]) -> DataFrame:
    """Unordered pairs of labels that assets with just two different votes got."""
    sets = votes.where(F.col("label").isin(*allowed)).groupBy("asset_id").agg(F.array_sort(F.collect_set("label")).alias("labels")).where("size(labels) = 2")
    return sets.groupBy(F.col("labels")[0].alias("label_a"), F.col("labels")[1].alias("label_b")).agg(F.count("*").alias("n"))


def consensus_histogram(consensus: DataFrame) -> DataFrame:
    return consensus.groupBy("label").agg(
        F.count("*").alias("n"), F.avg("consensus").alias("mean"), F.median("consensus").alias("median"), F.min("consensus").alias("least"),
        *[F.count_if((F.col("consensus") > low) & (F.col("consensus") <= high)).alias(f"bin_{round(high * 100)}") for low, high in ((0.0, 0.5), (0.5, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 1.0))],
    )


def quality_tiers(consensus: DataFrame, gold: float = 0.7, floor: float = 0.5) -> DataFrame:
    """gold, review, or reject for a coin flip of two votes."""
    flip = (F.col("consensus") == floor) & (F.col("valid_votes") == 2)
    return consensus.withColumn("tier", F.when(flip, "reject").when(F.col("consensus") >= gold, "gold").otherwise("review"))


def first_of_strata(df: DataFrame, strata: tuple[str, ...], targets: DataFrame, *, key: str, prefer: str | None = None, digits: int = 3) -> DataFrame:
    """The first ``target`` rows of each stratum, preferred ones before others, then in the
    order of a digest of the key.

    ``targets`` has a row per stratum.  A stratum may hold most rows, so its rows are
    counted in cells of equal first digits of the digest; whole cells are taken below the
    target, and only what stands in the cell at the cut is ordered.
    """
    digest = F.md5(F.col(key).cast("string"))
    first = F.lit("0") if prefer is None else F.when(F.col(prefer), "0").otherwise("1")
    placed = df.withColumn("_digest", digest).withColumn("_cell", F.concat(first, F.substring("_digest", 1, digits)))
    cells = placed.groupBy(*strata, "_cell").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*strata).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).join(targets, list(strata)).where("_before < target")
    order = Window.partitionBy(*strata, "_cell").orderBy("_digest", key)
    wanted = placed.join(cells, [*strata, "_cell"]).withColumn("_place", F.row_number().over(order))
    return wanted.where("_before + _place <= target").select(*df.columns)


def equal_allocation_sample(df: DataFrame, strata: tuple[str, ...], size: int, *, prefer: str, key: str) -> DataFrame:
    """About equally many rows of each stratum, preferred ones first, then in the order of a digest.

    ``size`` is divided by the number of strata and the remainder goes to the first ones;
    a stratum gives no more than it has.
    """
    sizes = df.groupBy(*strata).agg(F.count("*").alias("rows"))
    # One row for each stratum is numbered and counted.
    number, count = F.row_number().over(Window.orderBy(*strata)), F.count("*").over(Window.partitionBy())
    target = F.floor(F.lit(size) / F.col("strata_count")) + F.when(F.col("at") <= F.lit(size) % F.col("strata_count"), 1).otherwise(0)
    targets = sizes.withColumns({"at": number, "strata_count": count}).select(*strata, F.least(target, F.col("rows")).alias("target"))
    return first_of_strata(df, strata, targets, key=key, prefer=prefer)


def proportional_sample(df: DataFrame, strata: tuple[str, ...], fraction: float, *, key: str, most: int | None = None) -> DataFrame:
    """A share of each stratum, one row at least, in the order of a digest; then at most ``most`` rows in that order."""
    targets = df.groupBy(*strata).agg(F.greatest(F.lit(1), F.round(F.count("*") * fraction)).alias("target"))
    sample = first_of_strata(df, strata, targets, key=key)
    return sample if most is None else sample.orderBy(F.md5(F.col(key).cast("string")), *sample.columns).limit(most)


def first_wins(df: DataFrame, key: tuple[str, ...], *order) -> DataFrame:
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def model_disagreement(a: DataFrame, b: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """Keys on which two models' labels differ; no label, or no row, is a value of its own."""
    left, right = a.withColumnRenamed("label", "deployed"), b.withColumnRenamed("label", "baseline")
    return left.join(right, list(key), "full").where(~F.col("deployed").eqNullSafe(F.col("baseline")))


def business_review_queue(df: DataFrame, *, rare: float = 0.05, sure: float = 0.8, certain: float = 0.85) -> DataFrame:
    """Low confidence, confident disagreement and unsure rare classes, the first reason winning."""
    counts = df.groupBy("predicted").agg(F.count("*").alias("n"))
    rare_classes = counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total")))).where(F.col("n") < rare * F.col("total")).select("predicted", F.lit(True).alias("rare"))
    reason = F.when(F.col("confidence") < 0.60, "low_confidence").when((F.col("confidence") >= sure) & (F.col("human_label") != F.col("predicted")), "confident_disagreement").when(F.coalesce("rare", F.lit(False)) & (F.col("confidence") < certain), "rare_class")
    return df.join(F.broadcast(rare_classes), "predicted", "left").withColumn("reason", reason).where("reason is not null").drop("rare")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys of a declared primary key that occur more than once."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def missing_runs(loads: DataFrame, ledger: DataFrame) -> DataFrame:
    """Runs seen in the data but absent from the ledger, with first and last load."""
    absent = loads.join(ledger.select("run_id").distinct(), "run_id", "left_anti")
    return absent.groupBy("run_id").agg(F.min("loaded_at").alias("first_load"), F.max("loaded_at").alias("last_load"), F.count("*").alias("n"))


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Rows of each layer."""
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("layer"), "n") for name, df in layers.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def missing_values(df: DataFrame, *keys: str) -> DataFrame:
    """One row: how many rows lack each key column that has to be there."""
    return df.agg(*[F.count_if(F.col(k).isNull()).alias(k) for k in keys])


def resolved_labels(assets: DataFrame, consensus: DataFrame, prefixes: DataFrame, *, name: str = "technical_name", default: str = "Other") -> DataFrame:
    """``(asset_id, label, source, review)``: the consensus, else the domain of the name's module, else the default.

    A consensus that contradicts the module, or that needs adjudication, is to be reviewed,
    as is a label that nobody voted for.  ``prefixes(prefix, target)`` has a row per module.
    """
    named = assets.select("asset_id", F.expr(module_prefix(name, SPARK)).alias("prefix"))
    known = named.join(prefixes.select("prefix", F.col("target").alias("module")), "prefix", "left").join(consensus.select("asset_id", "label", "needs_adjudication"), "asset_id", "left")
    voted = F.col("label").isNotNull()
    against = F.col("module").isNotNull() & (F.col("module") != F.col("label"))
    return known.select(
        "asset_id", F.coalesce("label", "module", F.lit(default)).alias("label"), F.when(voted, "votes").when(F.col("module").isNotNull(), "prefix").otherwise("default").alias("source"),
        F.when(voted, against | F.col("needs_adjudication")).otherwise(F.lit(True)).alias("review"),
    )
