"""Domain profiles, shared-key graph and rankings of the latest run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

KEY = ["run_id", "asset_id"]


def latest_run(df: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """Rows of the greatest run_id (of ``of`` where given)."""
    return df.join(F.broadcast((df if of is None else of).agg(F.max("run_id").alias("run_id"))), "run_id", "left_semi")


def archivability_ranking(assets: DataFrame, features: DataFrame) -> DataFrame:
    """Dense rank of each asset in its run, by score downwards and then id.

    The id makes ranks unique, so a rank is a row's place.  One run may hold most rows, and
    many scores are equal, so places are counted in cells of (whole score, first two digits
    of the id): the rows of earlier cells, from a table of cells, and a running count inside.
    """
    scored = assets.select(*KEY, "technical_name", "asset_type").join(features.select(*KEY, "archival_candidate_score", "size_mb"), KEY)
    # In the order of the ranking: higher scores first, unknown ones last.
    scored = scored.withColumn("level", F.coalesce(-F.floor("archival_candidate_score"), F.lit(2**31).cast("long")))
    exact = F.coalesce(F.col("archival_candidate_score") == F.floor("archival_candidate_score"), F.lit(True))
    # Only equal scores are ordered by id alone, so only whole scores are cut further by it.
    scored = scored.withColumn("cell", F.when(exact, F.concat(F.lit("1"), F.substring("asset_id", 1, 2))).otherwise(F.lit("0")))
    cells = scored.groupBy("run_id", "level", "cell").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("run_id").orderBy("level", "cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select("run_id", "level", "cell", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("run_id", "level", "cell").orderBy(F.desc_nulls_last("archival_candidate_score"), "asset_id")
    ranked = scored.withColumn("place", F.row_number().over(inside)).join(starts, ["run_id", "level", "cell"])
    return ranked.select(*KEY, "technical_name", "asset_type", "size_mb", "archival_candidate_score", (F.col("before") + F.col("place")).alias("archival_rank"))


def roi_summary(assets: DataFrame, features: DataFrame) -> DataFrame:
    joined = assets.select(*KEY, "source_system", "asset_type").join(features, KEY, "left")
    return joined.groupBy("run_id", "source_system", "asset_type").agg(
        F.count("*").alias("asset_count"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("total_rows"),
        F.round(F.coalesce(F.sum("size_mb"), F.lit(0.0)), 4).alias("total_size_mb"),
        F.coalesce(F.sum("total_purged_rows"), F.lit(0)).alias("total_purged_rows"),
        F.round(F.coalesce(F.avg("roi_score"), F.lit(0.0)), 6).alias("avg_roi_score"),
        F.round(F.coalesce(F.max("roi_score"), F.lit(0.0)), 6).alias("max_roi_score"),
    )


def domain_profile(assets: DataFrame, predictions: DataFrame, features: DataFrame, dataset: DataFrame) -> DataFrame:
    """Size, scores, lineage and documentation of each domain in the latest run."""
    base = (
        latest_run(assets).select(*KEY, "description")
        .join(predictions.select(*KEY, F.col("domain").alias("domain_label")), KEY)
        .join(features.select(*KEY, "size_mb", "archival_candidate_score", "roi_score", "lineage_out_count"), KEY, "left")
        .join(dataset.select(*KEY, "field_count", "nullable_field_count"), KEY, "left")
    )
    out, high = F.avg("lineage_out_count"), F.col("archival_candidate_score") > 60
    return base.groupBy("domain_label").agg(
        F.count("*").alias("asset_count"),
        F.round(F.coalesce(F.sum("size_mb"), F.lit(0.0)), 4).alias("total_size_mb"),
        F.count_if(high).alias("archival_candidates"),
        F.round(F.coalesce(F.sum(F.when(high, F.col("size_mb"))), F.lit(0.0)), 4).alias("estimated_gain_mb"),
        F.round(F.avg("archival_candidate_score"), 2).alias("avg_archival_score"),
        F.round(F.avg("roi_score"), 2).alias("avg_roi_score"),
        F.round(out, 2).alias("avg_lineage_out"),
        F.round(F.avg(F.when(F.col("field_count") > 0, F.col("nullable_field_count") / F.col("field_count"))), 4).alias("avg_nullable_ratio"),
        F.count_if(F.coalesce(F.trim("description"), F.lit("")) == "").alias("assets_without_description"),
        F.when(out >= 10, "HIGH").when(out >= 3, "MEDIUM").otherwise("LOW").alias("risk_level"),
    )


def shared_keys(index_catalog: DataFrame, assets: DataFrame, predictions: DataFrame, *, least_domains: int = 2, least_records: int = 10) -> DataFrame:
    """Pairs of domains whose records use the same primary-key field.

    Records are counted by field and domain before the pairing, so the self join has at
    most the square of the number of domains for each field.
    """
    keys = latest_run(index_catalog.where("indexid = '0'"), assets).select("run_id", F.upper("recname").alias("name"), F.upper("fieldname").alias("bridge_field")).distinct()
    records = latest_run(assets).where("asset_type = 'ps_record'").select(*KEY, F.upper("technical_name").alias("name"))
    labelled = records.join(predictions.select(*KEY, F.col("domain").alias("domain_label")), KEY)
    counts = keys.join(labelled, ["run_id", "name"]).groupBy("bridge_field", "domain_label").agg(F.countDistinct("name").alias("records"))
    wide = counts.groupBy("bridge_field").agg(F.count("*").alias("domains"), F.sum("records").alias("total")).where((F.col("domains") >= least_domains) & (F.col("total") >= least_records))
    kept = counts.join(wide.select("bridge_field"), "bridge_field", "left_semi")
    a = kept.select("bridge_field", F.col("domain_label").alias("source_domain"), F.col("records").alias("r1"))
    b = kept.select("bridge_field", F.col("domain_label").alias("target_domain"), F.col("records").alias("r2"))
    return a.join(b, "bridge_field").where("target_domain > source_domain").select("source_domain", "target_domain", "bridge_field", (F.col("r1") + F.col("r2")).alias("shared_asset_count"))


def pair_totals(pairs: DataFrame, limit: int = 20) -> DataFrame:
    """The domain pairs that share most, with their fields in order."""
    return (
        pairs.groupBy("source_domain", "target_domain")
        .agg(F.sum("shared_asset_count").alias("shared_assets"), F.countDistinct("bridge_field").alias("fields"), F.array_join(F.array_sort(F.collect_set("bridge_field")), ", ").alias("field_list"))
        .orderBy(F.desc("shared_assets"), "source_domain", "target_domain")
        .limit(limit)
    )


def top_candidates(assets: DataFrame, predictions: DataFrame, features: DataFrame, top: int = 20) -> DataFrame:
    """Physical assets of the latest run ranked in their domain, ties kept."""
    base = (
        latest_run(assets).select(*KEY, "technical_name")
        .join(predictions.select(*KEY, F.col("domain").alias("domain_label")), KEY)
        .join(features.select(*KEY, "size_mb", "row_count", "archival_candidate_score"), KEY, "left")
        .where("coalesce(size_mb, 0) > 0 or coalesce(row_count, 0) > 0")
    )
    w = Window.partitionBy("domain_label").orderBy(F.desc_nulls_last("archival_candidate_score"))
    return base.withColumn("domain_rank", F.rank().over(w)).where(F.col("domain_rank") <= top).select(
        "domain_label", "technical_name", "domain_rank", F.round("archival_candidate_score", 6).alias("archival_candidate_score")
    )
