"""Counts of features and terms come from one search of a text, and are those of the twins' expressions."""

import duckdb
import pytest
from pyspark.sql import functions as F

from lodestead.functions.terms import term_matches
from lodestead.functions.text import DUCKDB
from lodestead.operators import classify, features, taxonomy

ODD = ["", None, "status", "a:status", "a: Status |b:status", "a:b:status | x", "a::status:|:status", "|:|status|", "n:\tother \n| :flag||c:flag|d: flag x", "a:status|status:a|:status"]


def test_features_are_those_of_the_expressions(spark):
    names = ["PS_GL_AP.AP_cust po_ ledger", "  ", None, "T99 9x ID dt", "PS_JOB_payroll-User", "é ap tax_invoice"]
    rows = [(1, f"{i}/{j}", n, names[(i + j) % len(names)], names[(i + 2 * j + 1) % len(names)], s) for i, n in enumerate(names) for j, s in enumerate(ODD)]
    raw = {c: F.lit(float(k)) for k, c in enumerate(features.RAW)}
    df = spark.createDataFrame(rows, "run_id int, asset_id string, technical_name string, source_ref string, column_names_text string, column_value_semantics_text string").withColumns(raw)
    made = features.with_numeric_features(df)
    got = {r["asset_id"]: tuple(r)[2:] for r in made.collect()}
    con = duckdb.connect()
    con.register("dataset", df.toArrow())
    helped = ", ".join(f"{sql} AS {n}" for n, sql in features.helper_columns(DUCKDB).items())
    wanted = ", ".join(f"{sql} AS {n}" for n, sql in features.numeric_features(DUCKDB).items())
    for row in con.sql(f"SELECT asset_id, {wanted} FROM (SELECT asset_id, {helped} FROM dataset)").fetchall():
        assert got[row[0]] == pytest.approx(row[1:])
    # One expression for each of 31 labels, 33 modules and 8 domains was searched for before.
    assert made._jdf.queryExecution().optimizedPlan().toString().lower().count("regexp") < 30


def test_words_that_begin_no_term_are_passed_over(spark):
    df = spark.createDataFrame([("zz tax zz tax",)], "text string").select(term_matches(F.col("text"), classify.TERMS).alias("m"))
    assert [m["term"] for m in df.first()["m"]] == ["tax", "tax"]
    assert " INSET " in df._jdf.queryExecution().optimizedPlan().toString()


def test_modules_of_a_hint_are_worked_out_once(spark):
    df = spark.createDataFrame([(1, "a", "PS_GL_X", "T1", "LEDGER", "", "")], "run_id int, asset_id string, technical_name string, source_ref string, column_names_text string, column_type_signature_text string, column_value_semantics_text string")
    plan = taxonomy.metadata_hint(df)._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("split_part") + plan.count("splitpart") <= 2
