"""Archiving recommendation: bands, decision, written reasons, approval queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestead.functions.rules import Parts, Rules, first_match, holds_any, joined_parts
from lodestead.operators.domain import KEY, latest_run

#: Label, years to keep by law or use, whether regulated, jurisdiction.
RETENTION = (
    ("Finance", 10, True, "FR"),
    ("Sales", 10, True, "FR"),
    ("Procurement", 10, True, "FR"),
    ("HR", 5, True, "FR"),
    ("Supply", 3, False, "FR"),
    ("IT", 1, False, "FR"),
    ("Other", 3, False, "FR"),
)
#: Strategy, handling, years, order.
POLICIES = (
    ("CONSERVATION_CRITIQUE", "keep", None, 1),
    ("CONSERVATION_REGLEMENTAIRE", "keep", 10, 2),
    ("CONSERVATION_SECURISEE", "keep", 5, 3),
    ("ARCHIVAGE_CHIFFRE", "encrypt", 10, 4),
    ("ARCHIVAGE_FROID", "cold", 5, 5),
    ("COMPRESSION", "compress", 3, 6),
    ("A_EVALUER", "review", None, 7),
    ("CONSERVATION", "keep", None, 8),
    ("NON_APPLICABLE", "none", None, 9),
)
#: Semantic labels of personal and of financial data.
PERSONAL = ("person_identifier", "email_address", "phone_number", "person_first_name", "person_last_name", "person_full_name")
FINANCIAL = ("financial_amount", "user_identifier")
#: Bands and the conditions for them, in order.
AGE_BANDS: Rules = (
    ("inconnu", "age_days IS NULL"),
    ("tres_ancien", "age_days > 1095"),
    ("ancien", "age_days > 365"),
    ("moyen", "age_days > 90"),
    ("recent", "true"),
)
SENSITIVITY: Rules = (
    ("HAUTE", holds_any("column_value_semantics_text", PERSONAL)),
    ("MOYENNE", holds_any("column_value_semantics_text", FINANCIAL)),
    ("FAIBLE", "column_value_semantics_text <> ''"),
    ("AUCUNE", "true"),
)
ACCESS_BANDS: Rules = (
    ("inconnu", "access_reads IS NULL"),
    ("froid", "access_reads = 0"),
    ("actif", "true"),
)
#: Under this an asset's label is not trusted.
UNSURE = "coalesce(confidence, 0) < 0.60"
FLAGGED = "coalesce(review_required, false)"
#: Strategies and the conditions for them, in order; ``held`` is a legal retention that still runs.
STRATEGIES: Rules = (
    ("NON_APPLICABLE", "size_mb = 0 AND row_count = 0"),
    ("CONSERVATION_CRITIQUE", "lineage_out_count >= 10"),
    ("CONSERVATION_CRITIQUE", "referenced_by_count >= 20"),
    ("ARCHIVAGE_CHIFFRE", "sensitivity_level = 'HAUTE' AND age_band IN ('ancien', 'tres_ancien')"),
    ("CONSERVATION_SECURISEE", "sensitivity_level = 'HAUTE'"),
    ("CONSERVATION_REGLEMENTAIRE", "held"),
    ("CONSERVATION", "access_band = 'actif'"),
    ("A_EVALUER", f"{UNSURE} OR {FLAGGED}"),
    ("ARCHIVAGE_FROID", "age_band = 'tres_ancien'"),
    ("ARCHIVAGE_FROID", "is_orphan AND age_band IN ('ancien', 'moyen') AND size_mb > 0"),
    ("A_EVALUER", "age_band = 'inconnu' AND size_mb >= 50"),
    ("COMPRESSION", "age_band = 'ancien'"),
    ("COMPRESSION", "age_band = 'moyen' AND size_mb >= 10"),
    ("CONSERVATION", "true"),
)
#: Reasons that are written down, in order.
REASONS: Parts = (
    ("size_mb >= 100", "volume_eleve(", "CAST(round(size_mb, 0) AS BIGINT)", "Mo)"),
    ("size_mb = 0 AND row_count = 0", "aucune_donnee_physique", "", ""),
    ("age_band = 'tres_ancien'", "inactif_>3ans", "", ""),
    ("age_band = 'ancien'", "inactif_>1an", "", ""),
    ("is_orphan", "orpheline(0_objet_dependant)", "", ""),
    ("referenced_by_count >= 20", "tres_reference(", "referenced_by_count", "_objets)"),
    ("sensitivity_level = 'HAUTE'", "donnees_personnelles", "", ""),
    ("sensitivity_level = 'MOYENNE'", "donnees_financieres", "", ""),
    ("held", "retention_legale_", "min_retention_years", "ans"),
    ("access_band = 'actif'", "lu_depuis_demarrage(", "access_reads", ")"),
    ("access_band = 'froid'", "jamais_lu_depuis_demarrage", "", ""),
    ("lineage_out_count >= 10", "fortement_reference(", "lineage_out_count", "_dependants)"),
    ("lineage_out_count = 0 AND size_mb > 0", "aucune_dependance_sortante", "", ""),
    (UNSURE, "fail_safe:confiance_faible(", "CAST(coalesce(confidence, 0) AS DECIMAL(5,2))", ")"),
    (FLAGGED, "fail_safe:revue_requise", "", ""),
)
#: A regulated domain that is not simply kept, and what a reviewer is told, in order.
ARCHIVED = "(regulated AND recommended_strategy NOT LIKE 'CONSERVATION%')"
REVIEW_PARTS = (
    (ARCHIVED, "domaine_reglemente+strategie_archivage", "", ""),
    (f"NOT {ARCHIVED} AND {UNSURE}", "confiance_faible(", "CAST(coalesce(confidence, 0) AS DECIMAL(5,2))", ")"),
    (f"NOT {ARCHIVED} AND NOT {UNSURE} AND {FLAGGED}", "review_required_par_scoreur", "", ""),
)
PRIORITIES: Rules = (("1", ARCHIVED), ("2", UNSURE), ("3", "true"))


def confidence_rules(confidence: str, high: float = 0.85, medium: float = 0.60) -> Rules:
    """Confidence bands of the SQL expression, in order."""
    return (("unknown", f"{confidence} IS NULL"), ("high", f"{confidence} >= {high}"), ("medium", f"{confidence} >= {medium}"), ("low", "true"))


def age_days(analyzed: Column, modified: Column, as_of: Column) -> Column:
    """Days since the later of the two; unknown only if both are."""
    return F.datediff(as_of, F.greatest(analyzed, modified))


def confidence_band(confidence: Column, high: float = 0.85, medium: float = 0.60) -> Column:
    return F.when(confidence.isNull(), "unknown").when(confidence >= high, "high").when(confidence >= medium, "medium").otherwise("low")


def segment_access(statistics: DataFrame) -> DataFrame:
    """Reads of each table, summed over its partitions."""
    def total(name: str) -> Column:
        return F.sum(F.when(F.col("statistic_name") == name, F.col("value")).otherwise(0))

    return statistics.where("object_type like 'TABLE%'").groupBy("run_id", "owner", F.col("object_name").alias("table_name")).agg(total("logical reads").alias("logical_reads"), total("physical reads").alias("physical_reads"))


def recommendations(
    assets: DataFrame, predictions: DataFrame, features: DataFrame, dataset: DataFrame, profile: DataFrame, table_catalog: DataFrame,
    retention: DataFrame, access: DataFrame, *, as_of: str, jurisdiction: str = "FR", latest: bool = True,
) -> DataFrame:
    """Decision and reasons for every physical asset (of the latest run).

    ``retention`` has a row per domain and jurisdiction; only the given one counts.
    """
    analyzed = profile.groupBy(KEY).agg(F.max("last_analyzed").alias("last_analyzed"))
    where = ["run_id", "owner_name", "source_ref"]
    tables = table_catalog.select("run_id", F.col("owner").alias("owner_name"), F.col("table_name").alias("source_ref"), "last_modified", "referenced_by_count")
    reads = access.select("run_id", F.col("owner").alias("owner_name"), F.col("table_name").alias("source_ref"), F.col("logical_reads").alias("access_reads"))
    floors = retention.where(F.col("jurisdiction") == jurisdiction).select("domain_label", "min_retention_years", "regulated")
    sized = features.select(*KEY, "size_mb", "row_count", "lineage_out_count", "archival_candidate_score").where("size_mb > 0 or row_count > 0")
    labels = predictions.select(*KEY, F.col("domain").alias("domain_label"), "confidence", "review_required", "model_version")
    named = (latest_run(assets) if latest else assets).select(*KEY, "technical_name", "asset_type", "owner_name", "source_ref")
    facts = named.join(sized, KEY).join(labels, KEY).join(dataset.select(*KEY, "column_value_semantics_text"), KEY, "left").join(analyzed, KEY, "left")
    # A row per domain, by its key.
    facts = facts.join(tables, where, "left").join(reads, where, "left").join(F.broadcast(floors), "domain_label", "left")
    facts = facts.withColumns({
        **{c: F.coalesce(c, F.lit(0)) for c in ("size_mb", "row_count", "lineage_out_count")},
        "min_retention_years": F.coalesce("min_retention_years", F.lit(3)), "regulated": F.coalesce("regulated", F.lit(False)),
        "age_days": age_days(F.col("last_analyzed"), F.col("last_modified"), F.lit(as_of).cast("date")), "is_orphan": F.col("referenced_by_count") == 0,
    })
    return decided(facts)


def decided(facts: DataFrame) -> DataFrame:
    """Bands, strategy and reasons of each row of facts, by the rules above."""
    held = F.col("regulated") & (F.col("age_days").isNull() | (F.col("age_days") < F.col("min_retention_years") * 365))
    banded = facts.withColumns({"age_band": first_match(AGE_BANDS), "sensitivity_level": first_match(SENSITIVITY), "access_band": first_match(ACCESS_BANDS), "held": held})
    return banded.withColumns({"recommended_strategy": first_match(STRATEGIES), "rationale": joined_parts(REASONS)})


def policy_summary(decisions: DataFrame, policies: DataFrame) -> DataFrame:
    own = decisions.groupBy("domain_label", "recommended_strategy").agg(
        F.max("min_retention_years").alias("floor"), F.bool_or("regulated").alias("regulated_domain"), F.count("*").alias("asset_count"), F.round(F.sum("size_mb"), 1).alias("total_size_mb")
    )
    named = own.join(F.broadcast(policies), own["recommended_strategy"] == policies["strategy_code"], "left")
    return named.select(
        "domain_label", "recommended_strategy", "handling", "retention_years",
        F.greatest(F.coalesce("retention_years", F.lit(0)), F.col("floor")).alias("effective_retention_years"), "regulated_domain", "asset_count", "total_size_mb",
    )


def approval_queue(decisions: DataFrame, queued: DataFrame | None = None) -> DataFrame:
    """Assets that a person has to look at, with the reason and a priority; queued ones are left out."""
    if queued is not None:
        decisions = decisions.join(queued.select(*KEY), KEY, "left_anti")
    return decisions.where(f"{ARCHIVED} OR {UNSURE} OR {FLAGGED}").select(
        *KEY, "technical_name", "domain_label", "recommended_strategy", "confidence", confidence_band(F.coalesce("confidence", F.lit(0.0))).alias("confidence_band"),
        "model_version", joined_parts(REVIEW_PARTS).alias("review_reason"), first_match(PRIORITIES).cast("int").alias("priority_rank"),
    )


def search_assets(decisions: DataFrame, pattern: str, bands: tuple[str, ...], review: bool | None = None, limit: int = 200) -> DataFrame:
    found = decisions.where(F.col("technical_name").ilike(pattern) & confidence_band(F.col("confidence")).isin(*bands))
    if review is not None:
        found = found.where(F.col("review_required") == review)
    return found.orderBy("technical_name", "asset_id").limit(limit)


def explore(decisions: DataFrame, domain: str | None = None, strategy: str | None = None, limit: int = 300) -> DataFrame:
    found = decisions.where("size_mb > 0")
    if domain is not None:
        found = found.where(F.col("domain_label") == domain)
    if strategy is not None:
        found = found.where(F.col("recommended_strategy") == strategy)
    return found.orderBy(F.desc("size_mb"), "asset_id").limit(limit)


def strategy_totals(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("recommended_strategy").agg(F.count("*").alias("asset_count"), F.round(F.sum("size_mb"), 2).alias("total_size_mb"))


def annotation_export(queue: DataFrame, dataset: DataFrame, limit: int = 500) -> DataFrame:
    """The queued assets that matter most, with what an annotator reads."""
    texts = dataset.select(*KEY, "column_names_text", "column_value_semantics_text")
    return queue.join(texts, KEY).orderBy("priority_rank", F.asc_nulls_last("confidence"), "asset_id").limit(limit)


def actionable(decisions: DataFrame, strategies: tuple[str, ...] = ("ARCHIVAGE_FROID", "ARCHIVAGE_CHIFFRE", "COMPRESSION"), *, most: int = 1000) -> DataFrame:
    """The largest assets whose strategy moves or shrinks them, ties by id: a list for people."""
    return decisions.where(F.col("recommended_strategy").isin(*strategies)).orderBy(F.desc_nulls_last("size_mb"), "asset_id", "run_id").limit(most)
