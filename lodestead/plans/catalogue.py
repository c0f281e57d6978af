"""Registered queries of the governance operators and their SQL twins.

A query is named by the inventory's id and what it computes; most ids that only occur
inside a larger operator (a band, a join, a helper) are covered by that operator's query.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.operators import archive, catalog, cost, domain
from lodestead.plans.twins import twin
from lodestead.sources.bindings import AS_OF, BY_RUN, TABLES, latest_run_id, relation
from lodestead.sources.shared import file_stamp, written


class Run:
    """The relations of one input folder: raw catalogues and the processed layer.

    Each is written once, by run, into the shared folder, and read by all queries of the
    session as long as the input files stay the same; so a query reads each raw table at
    most once, and partitions of other runs are pruned.
    """

    _stored: ClassVar[dict[tuple[str, str, str], DataFrame]] = {}

    def __init__(self, spark: SparkSession, sf_dir: str, only: int | None = None):
        self.spark, self.sf_dir, self.only = spark, sf_dir, only

    @cached_property
    def _stamp(self) -> str:
        return file_stamp(self.spark, *(f"{self.sf_dir}/{t}.parquet" for t in TABLES))

    def _once(self, name: str, build: Callable[[], DataFrame], *, by_run: bool = True) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self._stamp, name)
        if self.only is not None and by_run:
            if key in self._stored:
                return self._stored[key].where(F.col("run_id") == self.only)
            key = (*key[:2], f"{name}-{self.only}")
        if key not in self._stored:
            # Rows of one run are written by few tasks, so that a run has few files.
            self._stored[key] = written(build(), key[2], *["run_id"] * by_run)
        return self._stored[key]

    @cached_property
    def latest(self) -> Run:
        """The same of the latest run alone: what asks for no other run does not build the others, and reads them where they are built."""
        if self.only is not None:
            return self
        key = (self.spark.sparkContext.applicationId, self._stamp)
        if key not in self._latest:
            self._latest[key] = latest_run_id(self.spark, self.sf_dir)
        return self if self._latest[key] is None else Run(self.spark, self.sf_dir, self._latest[key])

    _latest: ClassVar[dict[tuple[str, str], int | None]] = {}

    def raw(self, name: str) -> DataFrame:
        by_run = name in BY_RUN
        return self._once(name, lambda: relation(self.spark, self.sf_dir, name, self.only if by_run else None), by_run=by_run)

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def assets(self) -> DataFrame:
        return self._once("dim_asset", lambda: catalog.dim_asset(self.raw("table_catalog"), self.raw("record_catalog")))

    @cached_property
    def fields(self) -> DataFrame:
        return self._once("dim_field", lambda: catalog.dim_field(self.assets, self.raw("table_catalog"), self.raw("column_catalog")))

    @cached_property
    def profile(self) -> DataFrame:
        raw = ("table_catalog", "record_catalog", "column_catalog", "index_catalog")
        return self._once("fact_profile", lambda: catalog.asset_profile(self.assets, *map(self.raw, raw)))

    @cached_property
    def sizes(self) -> DataFrame:
        """The sizes of `features`, without the counts of columns, indexes and links that need the other catalogues."""
        if "features" in self.__dict__ or (self.spark.sparkContext.applicationId, self._stamp, "features") in self._stored:
            return self.features.select("run_id", "asset_id", "size_mb")
        return self._once("sizes", lambda: catalog.asset_sizes(self.assets, self.raw("table_catalog")))

    @cached_property
    def lineage(self) -> DataFrame:
        return self._once("lineage", lambda: catalog.lineage_edges(self.assets, self.raw("record_catalog")))

    @cached_property
    def features(self) -> DataFrame:
        return self._once("features", lambda: catalog.features_asset(self.assets, self.profile, self.lineage))

    @cached_property
    def unwritten_features(self) -> DataFrame:
        """`features` as a plan where they are not written yet: who only counts them needs none of their values."""
        if "features" in self.__dict__ or (self.spark.sparkContext.applicationId, self._stamp, "features") in self._stored:
            return self.features
        more = (relation(self.spark, self.sf_dir, name) for name in ("column_catalog", "index_catalog"))
        profile = catalog.asset_profile(self.assets, self.raw("table_catalog"), self.raw("record_catalog"), *more)
        return catalog.features_asset(self.assets, profile, catalog.lineage_edges(self.assets, self.raw("record_catalog")))

    @cached_property
    def scores(self) -> DataFrame:
        """The sizes, links out and scores of `features`, without the counts of columns and indexes that need the other catalogues."""
        if "features" in self.__dict__ or (self.spark.sparkContext.applicationId, self._stamp, "features") in self._stored:
            return self.features
        return catalog.features_asset(self.assets, self.sizes.select("*", *[F.lit(None).cast("long").alias(c) for c in ("row_count", "column_count", "index_count")]), self.lineage)

    @cached_property
    def dataset(self) -> DataFrame:
        return self._once("dataset", lambda: catalog.dataset_of_summary(self.assets, catalog.field_summary(self.assets, self.raw("table_catalog"), self.raw("column_catalog")), self.profile))

    @cached_property
    def texts(self) -> DataFrame:
        """The names and texts of `dataset`, read from it where it is written; else without the profile and the catalogues that only it needs."""
        if "dataset" in self.__dict__ or (self.spark.sparkContext.applicationId, self._stamp, "dataset") in self._stored:
            return self.dataset
        return catalog.dataset_texts(self.assets, catalog.field_summary(self.assets, self.raw("table_catalog"), self.raw("column_catalog")))

    @cached_property
    def predictions(self) -> DataFrame:
        """Each prediction holds for the record and for its table."""

        def build() -> DataFrame:
            p = self.raw("prediction")
            values = ["run_id", "domain", "domain_alt", "confidence", "review_required", "model_version"]
            record = p.select(catalog.asset_key(F.col("run_id"), F.lit("peoplesoft"), F.col("recname")).alias("asset_id"), *values)
            table = p.select(catalog.asset_key(F.col("run_id"), F.lit("oracle"), F.concat("owner", F.lit("."), "table_name")).alias("asset_id"), *values)
            return record.unionByName(table)

        return self._once("predictions", build)

    @cached_property
    def retention(self) -> DataFrame:
        return self.spark.createDataFrame(archive.RETENTION, "domain_label string, min_retention_years int, regulated boolean, jurisdiction string")

    @cached_property
    def policies(self) -> DataFrame:
        return self.spark.createDataFrame(archive.POLICIES, "strategy_code string, handling string, retention_years int, priority int")

    @cached_property
    def decisions(self) -> DataFrame:
        def build() -> DataFrame:
            last = self.latest
            access = archive.segment_access(last.raw("segment_statistics"))
            return archive.recommendations(last.assets, last.predictions, last.features, last.dataset, last.profile, last.raw("table_catalog"), self.retention, access, as_of=AS_OF)

        return self._once("decisions", build)

    @cached_property
    def costs(self) -> DataFrame:
        return cost.cost_by_domain(self.decisions, cost.PARAMS)

    @cached_property
    def snapshots(self) -> DataFrame:
        return cost.cost_snapshots(self.sizes, self.predictions, cost.PARAMS)

    @cached_property
    def shared(self) -> DataFrame:
        last = self.latest
        return domain.shared_keys(last.raw("index_catalog"), last.assets, last.predictions)


_QUERIES: dict[str, Callable[[Run], DataFrame]] = {}
_TWINS: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of a `Run`, and its twin where SQL has one."""

    def add(build: Callable[[Run], DataFrame]) -> Callable[[Run], DataFrame]:
        _QUERIES[name] = build
        if sql is not None:
            _TWINS[name] = sql
        return build

    return add


def queries_of_run(name: str, run: Run) -> DataFrame:
    """A registered query over a run that is at hand."""
    return _QUERIES[name](run)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: (lambda spark, sf_dir, build=build: build(Run(spark, sf_dir))) for name, build in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(_TWINS)


DECISION = ["run_id", "asset_id", "technical_name", "domain_label", "size_mb", "age_band", "sensitivity_level", "access_band", "is_orphan", "recommended_strategy", "rationale"]


def _decision_sql(size: str = "round(size_mb, 6) AS size_mb") -> str:
    return ", ".join(size if c == "size_mb" else c for c in DECISION)


query("p2_dim_asset", twin("SELECT * FROM dim_asset"))(lambda r: r.assets)
query("s5_segment_access", twin("SELECT run_id, owner, table_name, CAST(logical_reads AS BIGINT) AS logical_reads, CAST(physical_reads AS BIGINT) AS physical_reads FROM access"))(
    lambda r: archive.segment_access(r.raw("segment_statistics"))
)
query("j1_j2_dim_field", twin("SELECT * FROM dim_field"))(lambda r: r.fields)
query("j3_j4_asset_profile", twin("SELECT * REPLACE (round(size_mb, 6) AS size_mb) FROM fact_profile"))(lambda r: r.profile.withColumn("size_mb", F.round("size_mb", 6)))
query("j5_lineage", twin("SELECT * FROM lineage"))(lambda r: r.lineage)
_SCORES = {"size_mb": 6, "archival_candidate_score": 6, "roi_score": 6}
query("j6_features_asset", twin("SELECT * REPLACE (" + ", ".join(f"round({c}, {d}) AS {c}" for c, d in _SCORES.items()) + ") FROM features"))(
    lambda r: r.features.withColumns({c: F.round(c, d) for c, d in _SCORES.items()})
)
query("w1_latest_profile", twin("SELECT run_id, asset_id, row_count FROM fact_profile QUALIFY row_number() OVER (PARTITION BY run_id, asset_id ORDER BY row_count DESC NULLS LAST, size_mb DESC NULLS LAST) = 1"))(
    lambda r: catalog.latest_profile(r.profile, F.desc_nulls_last("row_count"), F.desc_nulls_last("size_mb")).select("run_id", "asset_id", "row_count")
)
query("a1_field_counts", twin("SELECT * REPLACE (round(avg_data_length, 6) AS avg_data_length) FROM field_counts"))(lambda r: catalog.field_counts(r.fields).withColumn("avg_data_length", F.round("avg_data_length", 6)))
query("a2_p8_field_texts", twin("SELECT * FROM field_texts"))(
    lambda r: catalog.field_summary(r.assets, r.raw("table_catalog"), r.raw("column_catalog")).select("run_id", "asset_id", "column_names_text", "column_type_signature_text", "column_value_semantics_text")
)
query("j7_dataset_asset_ml", twin("SELECT * REPLACE (round(avg_data_length, 6) AS avg_data_length, round(size_mb, 6) AS size_mb) FROM dataset"))(
    lambda r: r.dataset.withColumns({"avg_data_length": F.round("avg_data_length", 6), "size_mb": F.round("size_mb", 6)})
)
query("j8_asset_inventory", twin("SELECT a.run_id, a.asset_id, a.technical_name, a.asset_type, f.row_count, f.column_count, f.index_count, f.lineage_in_count, f.lineage_out_count FROM dim_asset a LEFT JOIN features f ON f.run_id = a.run_id AND f.asset_id = a.asset_id"))(
    lambda r: r.assets.join(r.features, ["run_id", "asset_id"], "left").select("run_id", "asset_id", "technical_name", "asset_type", "row_count", "column_count", "index_count", "lineage_in_count", "lineage_out_count")
)
query("j9_scored_assets", twin("SELECT d.run_id, d.asset_id, d.technical_name, p.domain, p.domain_alt, p.confidence, p.review_required, p.model_version FROM dataset d JOIN predictions p ON p.run_id = d.run_id AND p.asset_id = d.asset_id"))(
    # The dataset has a row for each row of the assets.
    lambda r: r.assets.select("run_id", "asset_id", "technical_name").join(r.predictions, ["run_id", "asset_id"])
)
query("a6_roi_summary", twin("SELECT a.run_id, a.source_system, a.asset_type, count(*) AS asset_count, CAST(coalesce(sum(row_count), 0) AS BIGINT) AS total_rows, round(coalesce(sum(size_mb), 0), 4) AS total_size_mb, CAST(0 AS BIGINT) AS total_purged_rows, round(coalesce(avg(roi_score), 0), 6) AS avg_roi_score, round(coalesce(max(roi_score), 0), 6) AS max_roi_score FROM dim_asset a LEFT JOIN features f ON f.run_id = a.run_id AND f.asset_id = a.asset_id GROUP BY ALL"))(
    lambda r: domain.roi_summary(r.assets, r.features)
)
query("w2_archival_ranking", twin("SELECT f.run_id, f.asset_id, a.technical_name, a.asset_type, round(f.size_mb, 6) AS size_mb, round(f.archival_candidate_score, 6) AS archival_candidate_score, dense_rank() OVER (PARTITION BY f.run_id ORDER BY f.archival_candidate_score DESC NULLS LAST, f.asset_id) AS archival_rank FROM features f JOIN dim_asset a ON a.run_id = f.run_id AND a.asset_id = f.asset_id"))(
    lambda r: domain.archivability_ranking(r.assets, r.scores).withColumns({"size_mb": F.round("size_mb", 6), "archival_candidate_score": F.round("archival_candidate_score", 6)})
)
query("a7_domain_profile", twin("""SELECT p.domain AS domain_label, count(*) AS asset_count, round(coalesce(sum(f.size_mb), 0), 4) AS total_size_mb, count(*) FILTER (WHERE f.archival_candidate_score > 60) AS archival_candidates,
  round(coalesce(sum(f.size_mb) FILTER (WHERE f.archival_candidate_score > 60), 0), 4) AS estimated_gain_mb, round(avg(f.archival_candidate_score), 2) AS avg_archival_score, round(avg(f.roi_score), 2) AS avg_roi_score,
  round(avg(f.lineage_out_count), 2) AS avg_lineage_out, round(avg(CASE WHEN d.field_count > 0 THEN d.nullable_field_count::DOUBLE / d.field_count END), 4) AS avg_nullable_ratio,
  count(*) FILTER (WHERE a.description IS NULL OR trim(a.description) = '') AS assets_without_description,
  CASE WHEN avg(f.lineage_out_count) >= 10 THEN 'HIGH' WHEN avg(f.lineage_out_count) >= 3 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM current_assets a JOIN predictions p ON p.run_id = a.run_id AND p.asset_id = a.asset_id
  LEFT JOIN features f ON f.run_id = a.run_id AND f.asset_id = a.asset_id LEFT JOIN dataset d ON d.run_id = a.run_id AND d.asset_id = a.asset_id GROUP BY p.domain"""))(
    lambda r: domain.domain_profile(r.latest.assets, r.latest.predictions, r.latest.features, r.latest.dataset)
)
query("a8_shared_keys", twin("SELECT * FROM shared"))(lambda r: r.shared)
query("a17_pair_totals", twin("SELECT source_domain, target_domain, CAST(sum(shared_asset_count) AS BIGINT) AS shared_assets, count(DISTINCT bridge_field) AS fields, string_agg(DISTINCT bridge_field, ', ' ORDER BY bridge_field) AS field_list FROM shared GROUP BY ALL ORDER BY shared_assets DESC, source_domain, target_domain LIMIT 20"))(
    lambda r: domain.pair_totals(r.shared)
)
query("w3_top_candidates", twin("SELECT domain_label, technical_name, domain_rank, round(archival_candidate_score, 6) AS archival_candidate_score FROM (SELECT *, rank() OVER (PARTITION BY domain_label ORDER BY archival_candidate_score DESC NULLS LAST) AS domain_rank FROM decision_facts) WHERE domain_rank <= 20"))(
    lambda r: domain.top_candidates(r.latest.assets, r.latest.predictions, r.latest.features)
)
query("p22_p23_recommendation", twin(f"SELECT {_decision_sql()} FROM decisions"))(lambda r: r.decisions.withColumn("size_mb", F.round("size_mb", 6)).select(*DECISION))
query("a9_policy_summary", twin("SELECT r.domain_label, r.recommended_strategy, p.handling, p.retention_years, greatest(coalesce(p.retention_years, 0), max(r.min_retention_years)) AS effective_retention_years, bool_or(r.regulated) AS regulated_domain, count(*) AS asset_count, round(sum(r.size_mb), 1) AS total_size_mb FROM decisions r LEFT JOIN policies p ON p.strategy_code = r.recommended_strategy GROUP BY r.domain_label, r.recommended_strategy, p.handling, p.retention_years"))(
    lambda r: archive.policy_summary(r.decisions, r.policies)
)
query("c39_approval_queue", twin("SELECT * FROM queue"))(lambda r: archive.approval_queue(r.decisions))
query("j17_queue_without_queued", twin("SELECT run_id, asset_id, priority_rank FROM queue WHERE technical_name NOT LIKE 'Brand%'"))(
    lambda r: archive.approval_queue(r.decisions, r.decisions.where("technical_name like 'Brand%'")).select("run_id", "asset_id", "priority_rank")
)
query("p15_search_assets", twin("SELECT asset_id, technical_name, domain_label, confidence FROM decisions WHERE technical_name ILIKE '%1%' AND confidence < 0.60 AND NOT review_required ORDER BY technical_name, asset_id LIMIT 200"))(
    lambda r: archive.search_assets(r.decisions, "%1%", ("low",), False).select("asset_id", "technical_name", "domain_label", "confidence")
)
query("p16_explore_recommendations", twin("SELECT asset_id, technical_name, recommended_strategy FROM decisions WHERE size_mb > 0 AND domain_label = 'Finance' ORDER BY size_mb DESC, asset_id LIMIT 300"))(
    lambda r: archive.explore(r.decisions, "Finance").select("asset_id", "technical_name", "recommended_strategy")
)
query("a16_strategy_totals", twin("SELECT recommended_strategy, count(*) AS asset_count, round(sum(size_mb), 2) AS total_size_mb FROM decisions GROUP BY ALL"))(lambda r: archive.strategy_totals(r.decisions))
query("a11_cost_by_domain", twin("SELECT * FROM costs"))(lambda r: r.costs)
query("a12_storage_impact", twin("SELECT round(sum(total_size_gb), 4) AS total_gb, round(sum(archivable_size_gb), 4) AS archivable_gb, round(sum(current_cost_usd_year), 2) AS current_cost_usd_year, round(sum(cost_after_archiving_usd_year), 2) AS cost_after_usd_year, round(sum(annual_savings_usd), 2) AS annual_savings_usd, round(sum(annual_savings_usd) * 100 / nullif(sum(current_cost_usd_year), 0), 1) AS reduction_pct, 233.47::DOUBLE AS savings_usd_per_tb FROM costs"))(
    lambda r: cost.storage_impact(r.costs, cost.PARAMS)
)
query("a13_cost_snapshots", twin("SELECT * FROM snapshots"))(lambda r: r.snapshots)
query("a13_cost_snapshot_backfill", twin("SELECT * FROM snapshots WHERE run_id NOT IN (SELECT max(run_id) FROM snapshots)"))(
    lambda r: cost.cost_snapshots(r.sizes, r.predictions, cost.PARAMS, domain.latest_run(r.assets))
)
query("w4_j16_year_on_year", twin("""SELECT c.domain_label, c.run_id AS run_n, p.run_id AS run_n1, c.total_size_gb AS size_gb_n, p.total_size_gb AS size_gb_n1, round(c.total_size_gb - p.total_size_gb, 4) AS growth_gb,
  round(c.current_cost_usd_year - p.current_cost_usd_year, 2) AS cost_increase_usd, round(100 * (c.total_size_gb - p.total_size_gb) / nullif(p.total_size_gb, 0), 1) AS growth_rate_pct
  FROM (SELECT *, row_number() OVER (PARTITION BY domain_label ORDER BY run_id DESC) AS rn FROM snapshots) c LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY domain_label ORDER BY run_id DESC) AS rn FROM snapshots) p
  ON p.domain_label = c.domain_label AND p.rn = 2 WHERE c.rn = 1"""))(lambda r: cost.year_on_year(r.snapshots))
query("w5_w7_cost_shares", twin("""SELECT domain_label, total_size_gb, current_cost_usd_year, savings_pct, round(total_size_gb * 100 / sum(total_size_gb) OVER (), 2) AS volume_share_pct,
  round(current_cost_usd_year * 100 / sum(current_cost_usd_year) OVER (), 2) AS cost_share_pct, round(annual_savings_usd * 100 / nullif(sum(annual_savings_usd) OVER (), 0), 2) AS savings_share_pct,
  dense_rank() OVER (ORDER BY current_cost_usd_year DESC) AS cost_rank,
  round(sum(current_cost_usd_year) OVER (ORDER BY current_cost_usd_year DESC, domain_label ROWS UNBOUNDED PRECEDING) * 100 / sum(current_cost_usd_year) OVER (), 1) AS cumulative_cost_pct,
  CASE WHEN savings_pct >= 40 THEN 'very high' WHEN savings_pct >= 20 THEN 'high' WHEN savings_pct >= 10 THEN 'moderate' ELSE 'low' END AS optimization_potential FROM costs"""))(lambda r: cost.cost_shares(r.costs))
query("w14_growth_ratios", twin("SELECT * FROM (SELECT domain_label, run_id, round(total_size_gb / nullif(lag(total_size_gb) OVER (PARTITION BY domain_label ORDER BY run_id), 0) - 1, 6) AS growth FROM snapshots) WHERE growth IS NOT NULL"))(
    lambda r: cost.growth_ratios(r.snapshots)
)
query("a14_growth_estimate", twin("""SELECT round(CASE WHEN rate > 0 THEN rate ELSE 0.15 END, 8) AS growth_mean, round(CASE WHEN rate > 0 AND n >= 3 THEN greatest(dev, 0.01) ELSE 0.05 END, 8) AS growth_std, CASE WHEN rate > 0 THEN 'observed' ELSE 'assumption' END AS growth_source
  FROM (SELECT count(*) AS n, stddev_pop(ratio) AS dev, CASE WHEN count(*) >= 2 THEN pow(arg_max(total_size_gb, run_id) / arg_min(total_size_gb, run_id), 1.0 / (count(*) - 1)) - 1 END AS rate
        FROM (SELECT *, total_size_gb / lag(total_size_gb) OVER (ORDER BY run_id) - 1 AS ratio FROM snapshots WHERE domain_label = 'TOTAL' AND total_size_gb > 0))"""))(
    lambda r: cost.growth_estimate(r.snapshots, cost.PARAMS).withColumns({"growth_mean": F.round("growth_mean", 8), "growth_std": F.round("growth_std", 8)})
)

# Further modules register their queries when they are imported.
from lodestead.plans import labelling as _labelling  # noqa: E402, F401
from lodestead.plans import lifecycle as _lifecycle  # noqa: E402, F401
from lodestead.plans import sources as _sources  # noqa: E402, F401
from lodestead.plans import training as _training  # noqa: E402, F401
