"""Ranks, quantiles and tests of hypotheses against plain versions."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from lodestead.functions import ranks
from lodestead.operators import cost, labels


def test_quantiles(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([rng.gauss(0, 1), 0.0, 5.0])) for g in "abc" for _ in range({"a": 1, "b": 2, "c": 900}[g])] + [("c", None)]
    for buckets in (2, 7, 200):
        got = {(r["g"], r["share"]): r["quantile"] for r in ranks.quantiles(spark.createDataFrame(rows, "g string, v double"), ("g",), "v", (0.0, 0.1, 0.5, 1.0), buckets=buckets).collect()}
        for g in "abc":
            own = sorted(v for k, v in rows if k == g and v is not None)
            for share in (0.0, 0.1, 0.5, 1.0):
                at = share * (len(own) - 1)
                low = own[int(at)]
                assert got[g, share] == pytest.approx(low + (own[min(int(at) + 1, len(own) - 1)] - low) * (at - int(at)))


def test_ranks_and_tests(spark):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), float(rng.randint(0, 12)), rng.choice("pq"), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(rows, "g string, v double, h string, w double")
    values = sorted(r[1] for r in rows)
    rank = {v: statistics.mean(k + 1 for k, x in enumerate(values) if x == v) for v in set(values)}
    for buckets in (3, 200):
        assert {(r["v"], r["rank"]) for r in ranks.average_ranks(df, "v", buckets=buckets).collect()} == set(rank.items())
    u = sum((a[1] > b[1]) + 0.5 * (a[1] == b[1]) for a in rows if a[2] == "p" for b in rows if b[2] == "q")
    got = ranks.mann_whitney(df, "v", F.col("h") == "p").first()
    assert got["u"] == pytest.approx(u) and got["rank_biserial"] == pytest.approx(2 * u / (got["n1"] * got["n2"]) - 1)
    n = len(rows)
    groups = {g: [rank[r[1]] for r in rows if r[0] == g] for g in "xyz"}
    h = 12 / (n * (n + 1)) * sum(sum(x) ** 2 / len(x) for x in groups.values()) - 3 * (n + 1)
    h /= 1 - sum(c**3 - c for c in (values.count(v) for v in rank)) / (n**3 - n)
    assert ranks.kruskal_wallis(df, "g", "v").first()["h"] == pytest.approx(h)
    assert ranks.spearman(df, "v", "v").first()["rho"] == pytest.approx(1.0)


def test_samples_take_what_plain_ranking_takes(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).alias("good"), F.when(F.col("id") % 3 > 0, "big").otherwise("small").alias("s"))
    targets = spark.createDataFrame([("big", 800), ("small", 3)], "s string, target int")
    for digits in (1, 3):
        got = {(r["s"], r["k"]) for r in labels.first_of_strata(df, ("s",), targets, key="k", prefer="good", digits=digits).collect()}
        plain = df.selectExpr("*", "row_number() over (partition by s order by good desc, md5(cast(k as string)), k) as rn").join(targets, "s").where("rn <= target")
        assert got == {(r["s"], r["k"]) for r in plain.collect()}


def test_weighted_quantiles_are_those_of_repeated_rows(spark):
    rng = random.Random(5)
    rows = [("a", rng.randrange(40) / 8, rng.randrange(1, 9)) for _ in range(60)] + [("b", 2.0, 1), ("b", 3.0, 2)]
    df = spark.createDataFrame(rows, "k string, v double, n long")
    repeated = df.selectExpr("k", "v", "explode(sequence(1, n)) as i")
    shares = (0.0, 0.1, 0.5, 0.9, 1.0)
    for buckets in (2, 7, 200):
        got = {(r["k"], r["share"]): r["quantile"] for r in ranks.quantiles(df, ("k",), "v", shares, weight="n", buckets=buckets).collect()}
        plain = repeated.groupBy("k").agg(F.percentile("v", F.array(*map(F.lit, shares))).alias("q")).collect()
        assert got == {(r["k"], s): pytest.approx(q) for r in plain for s, q in zip(shares, r["q"], strict=True)}


def test_projection_orders_growths_not_scenarios(spark):
    scenarios = spark.range(900).selectExpr("id as scenario_id", "(id % 9) / 100D as growth")
    volumes = spark.createDataFrame([(100.0, 40.0)], "total double, archivable double")
    out = cost.project_savings(scenarios, volumes, cost.PARAMS)
    assert "scenario_id" not in out._jdf.queryExecution().toString()
    rows = {r["year_offset"]: r for r in out.collect()}
    assert {r["n_scenarios"] for r in rows.values()} == {900}
    g, done, kept = 0.04, 0.0, 0.0
    for y in range(6):
        done, kept = done + 100 * (1 + g) ** y * 0.276, kept + 60 * (1 + g) ** y * 0.276 + 40 * (1 + g / 2) ** y * 0.048
        assert rows[y]["cumul_cost_no_action_usd"] == pytest.approx(done, abs=0.006) and rows[y]["cumul_cost_with_archiving_usd"] == pytest.approx(kept, abs=0.006)
        assert rows[y]["net_savings_p50_usd"] == pytest.approx(done - kept, abs=0.006) and rows[y]["breakeven_probability"] == 1.0
