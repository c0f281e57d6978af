"""Storage cost, year-on-year comparison and savings projections."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.ranks import quantiles
from lodestead.operators.domain import KEY
from lodestead.sources.shared import written

#: Default parameters.
PARAMS = {
    "storage_cost_per_gb_per_year": 0.276,
    "cold_storage_cost_per_gb_year": 0.048,
    "compression_ratio": 0.4,
    "data_growth_rate_pct_per_year": 15.0,
    "data_growth_std_pct_per_year": 5.0,
    "implementation_cost_one_shot": 0.0,
}
#: Strategies that change what a GB costs: cold storage, or active storage of the compressed size.
COLD, COMPRESSED = ("ARCHIVAGE_FROID", "ARCHIVAGE_CHIFFRE"), ("COMPRESSION",)


def yearly_rates(params: dict[str, float]) -> tuple[tuple[str, float], ...]:
    """Cost of a GB and year under each strategy that has one of its own."""
    cold, less = params["cold_storage_cost_per_gb_year"], params["compression_ratio"] * params["storage_cost_per_gb_per_year"]
    return tuple((s, cold) for s in COLD) + tuple((s, less) for s in COMPRESSED)


def _round(x: Column, digits: int) -> Column:
    return F.round(x, digits)


def cost_by_domain(decisions: DataFrame, params: dict[str, float]) -> DataFrame:
    """Cost now and after the recommended strategies, by domain."""
    active, gb, strategy = F.lit(params["storage_cost_per_gb_per_year"]), F.col("size_mb") / 1024, F.col("recommended_strategy")
    rate = F.coalesce(*[F.when(strategy == s, F.lit(r)) for s, r in yearly_rates(params)], active)
    own = decisions.where("size_mb > 0").select("domain_label", strategy, gb.alias("gb"), (gb * active).alias("now"), (gb * rate).alias("after"))
    saved = F.sum(F.col("now") - F.col("after"))
    return own.groupBy("domain_label").agg(
        _round(F.sum("gb"), 4).alias("total_size_gb"),
        _round(F.sum(F.when(F.col("recommended_strategy").isin(*COLD, *COMPRESSED), F.col("gb"))), 4).alias("archivable_size_gb"),
        _round(F.sum("now"), 2).alias("current_cost_usd_year"),
        _round(F.sum("after"), 2).alias("cost_after_archiving_usd_year"),
        _round(saved, 2).alias("annual_savings_usd"),
        _round(F.try_divide(saved * 100, F.sum("now")), 1).alias("savings_pct"),
    )


def storage_impact(costs: DataFrame, params: dict[str, float]) -> DataFrame:
    """One row: the domains' costs together."""
    now, saved = F.sum("current_cost_usd_year"), F.sum("annual_savings_usd")
    return costs.agg(
        _round(F.sum("total_size_gb"), 4).alias("total_gb"),
        _round(F.sum("archivable_size_gb"), 4).alias("archivable_gb"),
        _round(now, 2).alias("current_cost_usd_year"),
        _round(F.sum("cost_after_archiving_usd_year"), 2).alias("cost_after_usd_year"),
        _round(saved, 2).alias("annual_savings_usd"),
        _round(F.try_divide(saved * 100, now), 1).alias("reduction_pct"),
        F.lit(round((params["storage_cost_per_gb_per_year"] - params["cold_storage_cost_per_gb_year"]) * 1024, 2)).alias("savings_usd_per_tb"),
    )


def cost_shares(costs: DataFrame) -> DataFrame:
    """Shares, rank, cumulated share and potential of each domain; a row per domain is ordered here."""
    everything = Window.partitionBy()
    by_cost = Window.orderBy(F.desc("current_cost_usd_year"), "domain_label")

    def share(c: str) -> Column:
        return F.try_divide(F.col(c) * 100, F.sum(c).over(everything))

    cumulated = F.try_divide(F.sum("current_cost_usd_year").over(by_cost.rowsBetween(Window.unboundedPreceding, 0)) * 100, F.sum("current_cost_usd_year").over(everything))
    pct = F.col("savings_pct")
    return costs.select(
        "domain_label", "total_size_gb", "current_cost_usd_year", "savings_pct",
        _round(share("total_size_gb"), 2).alias("volume_share_pct"), _round(share("current_cost_usd_year"), 2).alias("cost_share_pct"), _round(share("annual_savings_usd"), 2).alias("savings_share_pct"),
        F.dense_rank().over(Window.orderBy(F.desc("current_cost_usd_year"))).alias("cost_rank"), _round(cumulated, 1).alias("cumulative_cost_pct"),
        F.when(pct >= 40, "very high").when(pct >= 20, "high").when(pct >= 10, "moderate").otherwise("low").alias("optimization_potential"),
    )


def cost_snapshots(features: DataFrame, predictions: DataFrame, params: dict[str, float], existing: DataFrame | None = None) -> DataFrame:
    """Volume and cost of each run by domain, and in total over all assets, classified or not.

    Runs that ``existing(run_id)`` has are left alone.
    """
    sized = features.where("coalesce(size_mb, 0) > 0")
    if existing is not None:
        sized = sized.join(existing.select("run_id").distinct(), "run_id", "left_anti")
    gb = F.sum("size_mb") / 1024
    own = sized.join(predictions.select(*KEY, F.col("domain").alias("domain_label")), KEY).groupBy("run_id", "domain_label").agg(gb.alias("gb"))
    total = sized.groupBy("run_id").agg(gb.alias("gb")).select("run_id", F.lit("TOTAL").alias("domain_label"), "gb")
    return own.unionByName(total).select("run_id", "domain_label", _round(F.col("gb"), 6).alias("total_size_gb"), _round(F.col("gb") * params["storage_cost_per_gb_per_year"], 4).alias("current_cost_usd_year"))


def year_on_year(snapshots: DataFrame) -> DataFrame:
    """Latest run against the one before it, by domain."""
    w = Window.partitionBy("domain_label").orderBy("run_id")
    before = {f"{c}_n1": F.lag(c).over(w) for c in ("run_id", "total_size_gb", "current_cost_usd_year")}
    last = snapshots.withColumns({**before, "rn": F.row_number().over(Window.partitionBy("domain_label").orderBy(F.desc("run_id")))}).where("rn = 1")
    grown = F.col("total_size_gb") - F.col("total_size_gb_n1")
    return last.select(
        "domain_label", F.col("run_id").alias("run_n"), F.col("run_id_n1").alias("run_n1"), F.col("total_size_gb").alias("size_gb_n"), F.col("total_size_gb_n1").alias("size_gb_n1"),
        _round(grown, 4).alias("growth_gb"), _round(F.col("current_cost_usd_year") - F.col("current_cost_usd_year_n1"), 2).alias("cost_increase_usd"),
        _round(F.try_divide(grown * 100, F.col("total_size_gb_n1")), 1).alias("growth_rate_pct"),
    )


def growth_ratios(snapshots: DataFrame) -> DataFrame:
    """Growth of every domain from run to run."""
    w = Window.partitionBy("domain_label").orderBy("run_id")
    return snapshots.select("domain_label", "run_id", _round(F.try_divide(F.col("total_size_gb"), F.lag("total_size_gb").over(w)) - 1, 6).alias("growth")).where("growth is not null")


def growth_estimate(snapshots: DataFrame, params: dict[str, float]) -> DataFrame:
    """One row: mean and deviation of yearly growth, observed where the TOTAL series grows.

    The series has a row per run.
    """
    total = snapshots.where("domain_label = 'TOTAL' and total_size_gb > 0")
    w = Window.orderBy("run_id")
    series = total.withColumn("ratio", F.col("total_size_gb") / F.lag("total_size_gb").over(w) - 1)
    one = series.agg(
        F.count("*").alias("n"), F.min_by("total_size_gb", "run_id").alias("first"), F.max_by("total_size_gb", "run_id").alias("last"), F.stddev_pop("ratio").alias("deviation")
    )
    rate = F.when(F.col("n") >= 2, F.pow(F.col("last") / F.col("first"), 1 / (F.col("n") - 1).cast("double")) - 1)
    mean, std = params["data_growth_rate_pct_per_year"] / 100, params["data_growth_std_pct_per_year"] / 100
    seen = F.coalesce(F.col("rate") > 0, F.lit(False))
    return one.withColumn("rate", rate).select(
        F.when(seen, F.col("rate")).otherwise(mean).alias("growth_mean"),
        F.when(seen & (F.col("n") >= 3), F.greatest("deviation", F.lit(0.01))).otherwise(std).alias("growth_std"),
        F.when(seen, "observed").otherwise("assumption").alias("growth_source"),
    )


def project_savings(scenarios: DataFrame, volumes: DataFrame, params: dict[str, float], years: int = 5) -> DataFrame:
    """Percentiles of the net savings of each year over ``scenarios(scenario_id, growth)``.

    ``volumes(total, archivable)`` has one row, in GB.  What-if questions are the same job
    with other ``params``.
    """
    active, cold = params["storage_cost_per_gb_per_year"], params["cold_storage_cost_per_gb_year"]
    known = F.broadcast(volumes.select(F.coalesce("total", F.lit(0.0)).alias("total"), F.coalesce("archivable", F.lit(0.0)).alias("archivable")))
    # A scenario is its growth, so equal ones are one row with their number, written once: all that follows reads it several times.
    kinds = scenarios.select(F.greatest("growth", F.lit(-0.9)).alias("g")).groupBy("g").agg(F.count("*").alias("n"))
    kinds = written(kinds.crossJoin(known), "growths")
    keep = F.greatest(F.col("total") - F.col("archivable"), F.lit(0.0))

    def without(y: Column) -> Column:
        return F.col("total") * F.pow(1 + F.col("g"), y) * active

    def with_archiving(y: Column) -> Column:
        return keep * F.pow(1 + F.col("g"), y) * active + F.col("archivable") * F.pow(1 + F.col("g") / 2, y) * cold

    def until(k: Column, cost: Callable[[Column], Column]) -> Column:
        return F.aggregate(F.sequence(F.lit(0), k), F.lit(0.0), lambda s, y: s + cost(y))

    k = F.col("year_offset")
    yearly = kinds.withColumn("year_offset", F.explode(F.sequence(F.lit(0), F.lit(years))))
    sums = yearly.select("n", "year_offset", (F.col("total") * F.pow(1 + F.col("g"), k)).alias("volume"), until(k, without).alias("without"), (until(k, with_archiving) + params["implementation_cost_one_shot"]).alias("with"))
    net = sums.withColumn("net", F.col("without") - F.col("with"))
    # Each measure's quantiles come from ordered buckets, so that a year's scenarios need not fit into one task.
    long = net.unpivot(["year_offset", "n"], ["volume", "without", "with", "net"], "measure", "value")
    found = quantiles(long, ("year_offset", "measure"), "value", (0.1, 0.5, 0.9), weight="n")
    wide = found.groupBy("year_offset").agg(*[
        F.max(F.when((F.col("measure") == m) & (F.col("share") == s), F.col("quantile"))).alias(f"{m}_{s}") for m, s in (("volume", 0.5), ("without", 0.5), ("with", 0.5), ("net", 0.1), ("net", 0.5), ("net", 0.9))
    ])
    chances = net.groupBy("year_offset").agg((F.sum(F.when(F.col("net") > 0, F.col("n")).otherwise(0)) / F.sum("n")).alias("b"), F.sum("n").alias("n_scenarios"))
    return wide.join(chances, "year_offset").select(
        "year_offset", _round(F.col("`volume_0.5`"), 4).alias("volume_no_action_gb"), _round(F.col("`without_0.5`"), 2).alias("cumul_cost_no_action_usd"), _round(F.col("`with_0.5`"), 2).alias("cumul_cost_with_archiving_usd"),
        *[_round(F.col(f"`net_{s}`"), 2).alias(f"net_savings_p{round(100 * s)}_usd") for s in (0.1, 0.5, 0.9)], _round(F.col("b"), 3).alias("breakeven_probability"), "n_scenarios",
    )


def parameters(table: DataFrame, defaults: dict[str, float] = PARAMS) -> DataFrame:
    """One row with a column per parameter, from ``table(param_name, param_value)``; absent ones take their default."""
    return table.agg(*[F.coalesce(F.max(F.when(F.col("param_name") == n, F.col("param_value"))), F.lit(v)).alias(n) for n, v in defaults.items()])


def overridden(table: DataFrame, defaults: dict[str, float] = PARAMS) -> dict[str, float]:
    """The parameters as a dictionary, for a what-if run; the table and the defaults stay as they are."""
    return parameters(table, defaults).first().asDict()


def latest_projection(projections: DataFrame, computed_at: str = "computed_at") -> DataFrame:
    """The rows of the latest computation."""
    last = projections.agg(F.max(computed_at).alias(computed_at))
    return projections.join(F.broadcast(last), computed_at, "left_semi")
