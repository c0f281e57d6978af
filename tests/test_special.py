"""Tails against closed forms, signals of columns against a plain count."""

import math

import pytest
from pyspark.sql import functions as F

from lodestead.functions import ranks, special
from lodestead.operators import salience


def test_tails_against_closed_forms(spark):
    def chi(x, k):  # even: a sum; odd: the normal tail and a sum
        if k % 2 == 0:
            return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))
        return math.erfc(math.sqrt(x / 2)) + math.exp(-x / 2) * sum((x / 2) ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (k + 1) // 2))

    cases = [(x, k) for x in (0.0, 1e-6, 0.3, 1.0, 2.9, 3.1, 10.0, 60.0, 400.0) for k in (1, 2, 3, 7, 40, 101)]
    rows = spark.createDataFrame(cases, "x double, k int").select("x", "k", special.chi_square_tail(F.col("x"), F.col("k")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(chi(r["x"], r["k"]), abs=1e-10, rel=1e-8) for r in rows) and len(rows) == len(cases)
    for r in spark.createDataFrame([(z,) for z in (-3.0, -0.1, 0.0, 0.5, 1.96, 6.0, 30.0)], "z double").select("z", special.normal_tail(F.col("z")).alias("p")).collect():
        assert r["p"] == pytest.approx(math.erfc(r["z"] / math.sqrt(2)) / 2, rel=1e-9, abs=1e-14)
    student = {1: lambda t: 1 - 2 / math.pi * math.atan(t), 2: lambda t: 1 - t / math.sqrt(2 + t * t), 4: lambda t: 1 - t / math.sqrt(4 + t * t) * (1 + 2 / (4 + t * t))}
    for r in spark.createDataFrame([(t, k) for t in (0.0, 0.2, 1.0, 2.0, 9.0, 50.0) for k in student], "t double, k int").select("t", "k", special.student_two_sided(F.col("t"), F.col("k")).alias("p")).collect():
        assert r["p"] == pytest.approx(student[r["k"]](r["t"]), rel=1e-8, abs=1e-12)
    # Known values: two-sided t with 30 and 100,000 degrees of freedom at their 5 % points, and the logarithm of gamma.
    got = spark.range(1).select(special.student_two_sided(F.lit(2.0422724563012373), F.lit(30)), special.student_two_sided(F.lit(1.9599876707), F.lit(100_000)), special.log_gamma(F.lit(0.5)), special.log_gamma(F.lit(171.0))).first()
    assert tuple(got) == (pytest.approx(0.05, abs=1e-9), pytest.approx(0.05, abs=1e-6), pytest.approx(math.lgamma(0.5), abs=1e-11), pytest.approx(math.lgamma(171), rel=1e-13))


def test_p_values_on_small_tables(spark):
    df = spark.createDataFrame([(g, float(v)) for g, vs in {"a": (1, 2, 3, 4), "b": (2, 5, 6, 7), "c": (8, 9, 9, 10)}.items() for v in vs], "g string, v double")
    h = ranks.kruskal_wallis(df, "g", "v").first()["h"]
    assert ranks.kruskal_wallis_p(df, "g", "v").first()["p"] == pytest.approx(math.exp(-h / 2))
    same = ranks.mann_whitney_p(df.where("g = 'a'").unionAll(df.where("g = 'a'").withColumn("g", F.lit("b"))), "v", F.col("g") == "a").first()
    assert same["p"] == 1.0
    assert ranks.spearman_p(df.withColumn("w", -F.col("v")), "v", "w").first()["p"] == 0.0


def test_signals_and_profiles(spark):
    names = spark.createDataFrame([("PO_ID",), ("empl_STATUS",), ("dueDate",), ("a_x1_x1_gl",), (None,), ("one.two-three/four_five",)], "n string")
    words = {r["n"]: sorted(r["w"]) for r in names.select("n", salience.telling_words(F.col("n")).alias("w")).collect()}
    assert words == {"PO_ID": ["po", "purchase_order"], "empl_STATUS": ["empl", "employee"], "dueDate": ["due"], "a_x1_x1_gl": ["general_ledger", "gl", "x1"], None: [], "one.two-three/four_five": ["five", "four", "one", "three", "two"]}
    signal = spark.createDataFrame([("SETID", "NUMBER(5)", "identifier", ""), ("one_two_three_four_five", "TIMESTAMP(6)", "unheard", "x"), ("NOTE", "long text", "comment_text", None)], "n string, t string, s string, x string")
    got = [r[0] for r in signal.select(salience.column_signal(*map(F.col, "ntsx"))).collect()]
    assert got == pytest.approx([1.1 + 0.3 - 0.6, 0.8 + 1.8 + 0.4 + 1.1, 1.8 + 0.45 + 0.5])
    # One asset with far more columns than are shown, in many partitions.
    many = spark.range(0, 3_000, 1, 12).select(F.lit(1).alias("run_id"), F.lit("wide").alias("asset_id"), F.format_string("c%04d_%s", "id", F.when(F.col("id") % 700 == 0, "amount_paid").otherwise("id")).alias("technical_name"), F.format_string("T%d(9)", F.col("id") % 20).alias("data_type"))
    few = spark.createDataFrame([(1, "few", "EMPLID", "VARCHAR2"), (1, "few", "EMPLID", "NUMBER"), (1, "few", None, "NUMBER"), (2, "few", "", None)], "run_id int, asset_id string, technical_name string, data_type string")
    columns = salience.asset_columns(many.unionByName(few))
    context = {(r["run_id"], r["asset_id"]): r for r in salience.asset_context(columns).collect()}
    assert set(context) == {(1, "wide"), (1, "few")}
    wide = context[1, "wide"]
    assert wide["salient"][:6] == [f"c{k:04d}_amount_paid" for k in range(0, 3_000, 700)] + ["c0001_id"] and len(wide["salient"]) == 24
    assert wide["semantic_profile"] == ["identifier:2995", "financial_amount:5"] and wide["type_profile"] == [f"T{k}:150" for k in sorted(range(20), key=str)[:8]]
    assert context[1, "few"]["salient"] == ["EMPLID"] and context[1, "few"]["type_profile"] == ["VARCHAR2:1"]
    samples = spark.createDataFrame([(1, "wide", "c0005_id", "v")], "run_id int, asset_id string, name string, sample string")
    first = {v: salience.salient_columns(salience.asset_columns(many, samples), v, shown=1).first()["salient"] for v in salience.VARIANTS}
    assert first == {"salient_first": ["c0000_amount_paid"], "semantic_first": ["c0000_amount_paid"], "samples_first": ["c0005_id"]}
