"""Queries against their SQL twins on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from lodestead.plans import catalogue

DATA = "/root/testdata/sf0.001"
NAMES = ["p2_dim_asset", "s5_segment_access", "j5_lineage", "w2_archival_ranking", "a8_shared_keys", "p22_p23_recommendation", "a20_calibration", "a27_class_scores", "a30_vote_consensus", "w9_proportional_sample",
         "s1_record_catalog", "s3_column_catalog", "p11_observed_patterns", "c4_c5_numeric_features", "c38_quality_report", "c3_term_audit", "c27_remapped", "w10_review_weighted_sample", "c39_approval_queue", "a11_cost_by_domain", "x1_savings_projection", "a39_kruskal_wallis"]


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.8g}")
    return v.replace(tzinfo=None).isoformat() if hasattr(v, "isoformat") and hasattr(v, "tzinfo") else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, duck, name):
    df = catalogue.queries()[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    twin = duck.sql(catalogue.oracle_sql()[name])
    assert sorted(twin.columns) == columns
    at = [list(twin.columns).index(c) for c in columns]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in twin.fetchall()), key=repr)


def test_every_twin_has_a_query():
    assert set(catalogue.oracle_sql()) <= set(catalogue.queries())


def test_plans_of_headline_queries(spark):
    """No Python, no Cartesian product, and each raw or processed table read a few times at most."""
    for name in ("p22_p23_recommendation", "a11_cost_by_domain", "a7_domain_profile", "j7_dataset_asset_ml"):
        df = catalogue.queries()[name](spark, DATA)
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 8
