"""Exact ranks and quantiles without putting a group into one task.

Values are dealt into buckets between approximate quantiles; buckets are counted, and only
inside a bucket are rows ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestead.functions.special import chi_square_tail, normal_tail, student_two_sided

#: Buckets of a group, and the precision of the quantiles between them.
BUCKETS, PRECISION = 200, 10_000


def _bucketed(df: DataFrame, keys: tuple[str, ...], value: str, buckets: int, weight: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows with their bucket, and a row per group and bucket with its rows, the rows before it and all rows of the group; a row counts ``weight`` times."""
    cuts = df.groupBy(*keys).agg(F.percentile_approx(value, [k / buckets for k in range(1, buckets)], PRECISION).alias("_cuts"))
    joined = df.join(cuts, list(keys)) if keys else df.crossJoin(F.broadcast(cuts))
    placed = joined.withColumn("_bucket", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")
    counts = placed.groupBy(*keys, "_bucket").agg((F.count("*") if weight is None else F.sum(weight)).alias("_rows"))
    own = Window.partitionBy(*keys)
    before = own.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    return placed, counts.withColumns({"_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_all": F.sum("_rows").over(own)})


def bucketed(df: DataFrame, keys: tuple[str, ...], value: str, *, buckets: int = BUCKETS) -> DataFrame:
    """The rows with ``_bucket``, a range of values of their keys' rows; later ranges have greater values."""
    return _bucketed(df, keys, value, buckets)[0]


def average_ranks(df: DataFrame, value: str, rank: str = "rank", *, keys: tuple[str, ...] = (), buckets: int = BUCKETS) -> DataFrame:
    """Adds each row's rank by value (within its keys), from 1; equal values share the mean of their ranks, nulls are left out."""
    placed, counts = _bucketed(df.where(F.col(value).isNotNull()), keys, value, buckets)
    # Equal values always share a bucket.
    joined = placed.join(counts.select(*keys, "_bucket", "_before"), [*keys, "_bucket"])
    place = F.rank().over(Window.partitionBy(*keys, "_bucket").orderBy(value))
    ties = F.count("*").over(Window.partitionBy(*keys, "_bucket", value))
    return joined.withColumn(rank, F.col("_before") + place + (ties - 1) / 2).drop("_bucket", "_before")


def quantiles(df: DataFrame, keys: tuple[str, ...], value: str, shares: tuple[float, ...], *, weight: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``(keys, share, quantile)``, interpolated between neighbours as ``percentile`` does; nulls are left out.

    With ``weight``, a positive whole number, a row stands for so many equal ones.
    """
    times = F.lit(1) if weight is None else F.col(weight)
    rows = df.where(F.col(value).isNotNull()).select(*keys, value, times.cast("long").alias("_times"))
    placed, counts = _bucketed(rows, keys, value, buckets, F.col("_times"))
    rank = F.col("share") * (F.col("_all") - 1)
    wanted = counts.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares])))
    # The buckets that hold the neighbours of a wanted rank, counted from 0.
    wanted = wanted.withColumn("_rank", rank).where("_before <= ceil(_rank) and _before + _rows > floor(_rank)")
    held = placed.join(wanted.select(*keys, "_bucket", "_before").distinct(), [*keys, "_bucket"])
    # A row holds the places from _end - _times to _end - 1.
    sorted_ = Window.partitionBy(*keys, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    numbered = held.withColumn("_end", F.col("_before") + F.sum("_times").over(sorted_))
    near = numbered.join(wanted.select(*keys, "_bucket", "share", "_rank"), [*keys, "_bucket"]).where("_end > floor(_rank) and _end - _times <= ceil(_rank)")
    low, high = F.min(value), F.max(value)
    part = F.first("_rank") - F.floor(F.first("_rank"))
    return near.groupBy(*keys, "share").agg((low + (high - low) * part).alias("quantile"))


def kruskal_wallis(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: H corrected for ties, groups, and epsilon squared."""
    ranked = average_ranks(df.select(group, value), value)
    own = ranked.groupBy(group).agg(F.count("*").alias("n"), F.sum("rank").alias("r"))
    ties = ranked.groupBy(value).agg(F.count("*").alias("t")).agg(F.sum(F.pow("t", F.lit(3.0)) - F.col("t")).alias("ties"))
    total = own.agg(F.sum("n").cast("double").alias("n"), F.count("*").alias("groups"), F.sum(F.col("r") * F.col("r") / F.col("n")).alias("s")).crossJoin(F.broadcast(ties))
    n = F.col("n")
    h = F.try_divide(12 / (n * (n + 1)) * F.col("s") - 3 * (n + 1), 1 - F.col("ties") / (n * n * n - n))
    return total.select(h.alias("h"), "groups", F.try_divide(h, n - 1).alias("epsilon_squared"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: correlation of the ranks of two columns over the rows that have both."""
    both = df.select(x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return average_ranks(average_ranks(both, x, "rx"), y, "ry").agg(F.corr("rx", "ry").alias("rho"), F.count("*").alias("n"))


def chi_square(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: chi squared of two columns, its degrees of freedom, and Cramer's V; cells without rows count."""
    cells = df.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    rows, columns = cells.groupBy("a").agg(F.sum("n").alias("ra")), cells.groupBy("b").agg(F.sum("n").alias("cb"))
    total = cells.agg(F.sum("n").cast("double").alias("total"))
    # As many rows as there are pairs of classes.
    full = rows.crossJoin(F.broadcast(columns)).crossJoin(F.broadcast(total)).join(cells, ["a", "b"], "left")
    expected = F.col("ra") * F.col("cb") / F.col("total")
    gap = F.coalesce("n", F.lit(0)) - expected
    out = full.agg(F.sum(gap * gap / expected).alias("chi2"), F.countDistinct("a").alias("r"), F.countDistinct("b").alias("c"), F.first("total").alias("total"))
    return out.select("chi2", ((F.col("r") - 1) * (F.col("c") - 1)).alias("dof"), F.sqrt(F.try_divide("chi2", F.col("total") * F.least(F.col("r") - 1, F.col("c") - 1))).alias("cramers_v"))


def mann_whitney(df: DataFrame, value: str, first: Column) -> DataFrame:
    """One row: U of the rows for which ``first`` holds against the others, and the rank-biserial correlation."""
    ranked = average_ranks(df.withColumn("_first", first), value)
    n1, n2 = F.count_if("_first"), F.count_if(~F.col("_first"))
    u = F.sum(F.when(F.col("_first"), F.col("rank"))) - n1 * (n1 + 1) / 2
    return ranked.agg(u.alias("u"), n1.alias("n1"), n2.alias("n2")).withColumn("rank_biserial", F.try_divide(2 * F.col("u"), F.col("n1") * F.col("n2")) - 1)


def kruskal_wallis_p(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: H and the chance of an H of at least that among groups that don't differ."""
    return kruskal_wallis(df, group, value).select(F.col("h").alias("statistic"), chi_square_tail(F.col("h"), F.col("groups") - 1).alias("p"))


def chi_square_p(df: DataFrame, a: str, b: str) -> DataFrame:
    """One row: chi squared and the chance of at least that for independent columns."""
    return chi_square(df, a, b).select(F.col("chi2").alias("statistic"), chi_square_tail(F.col("chi2"), F.col("dof")).alias("p"))


def spearman_p(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row: the rank correlation and its two-sided chance by Student's t; a perfect one has none."""
    rho, n = F.col("rho"), F.col("n")
    t = rho * F.sqrt(F.try_divide(n - 2, (1 - rho) * (1 + rho)))
    return spearman(df, x, y).select(rho.alias("statistic"), F.when(F.abs(rho) >= 1, 0.0).otherwise(student_two_sided(t, n - 2)).alias("p"))


def mann_whitney_p(df: DataFrame, value: str, first: Column) -> DataFrame:
    """One row: U and its two-sided chance by the normal law, corrected for ties and by half a step."""
    ties = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").cast("double").alias("t")).agg(F.sum(F.pow("t", F.lit(3.0)) - F.col("t")).alias("ties"))
    both = mann_whitney(df, value, first).crossJoin(F.broadcast(ties))  # one row each
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    n = n1 + n2
    spread = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1))))
    z = F.try_divide(F.abs(F.col("u") - n1 * n2 / 2) - 0.5, spread)
    return both.select(F.col("u").alias("statistic"), F.least(F.lit(1.0), 2 * normal_tail(z)).alias("p"))
