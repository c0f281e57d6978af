"""The layer builds no more than what is asked for."""

from pyspark.sql import functions as F

from lodestead.functions.semantics import SEMANTIC_RULES, column_semantics
from lodestead.operators import catalog, features
from lodestead.plans import catalogue
from lodestead.plans.catalogue import Run
from lodestead.sources.bindings import relation

DATA = "/root/testdata/sf0.001"


def test_latest_run_is_built_alone(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    for name in ("a7_domain_profile", "w3_top_candidates", "k8_archiving_actions", "c39_approval_queue", "w5_w7_cost_shares", "a8_shared_keys"):
        catalogue.queries()[name](spark, DATA)
    assert {k[2] for k in Run._stored} & {"table_catalog", "column_catalog", "dim_asset", "fact_profile", "features", "dataset"} == set()
    run = Run(spark, DATA)
    alone = {n: sorted(map(tuple, getattr(run.latest, n).collect()), key=repr) for n in ("features", "dataset")}
    last = run.assets.agg(F.max("run_id")).first()[0]
    assert alone == {n: sorted(map(tuple, getattr(run, n).where(F.col("run_id") == last).select(*getattr(run.latest, n).columns).collect()), key=repr) for n in alone}


def test_snapshots_need_no_columns_or_indexes(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    run = Run(spark, DATA)
    sizes = sorted(map(tuple, run.sizes.collect()))
    assert not {k[2] for k in Run._stored} & {"column_catalog", "index_catalog", "fact_profile", "features"}
    assert sizes == sorted(map(tuple, catalog.features_asset(run.assets, run.profile, run.lineage).select("run_id", "asset_id", "size_mb").collect()))


def test_ranking_needs_no_columns_or_indexes(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    catalogue.queries()["w2_archival_ranking"](spark, DATA)
    assert not {k[2] for k in Run._stored} & {"column_catalog", "index_catalog", "fact_profile", "features"}
    # Rows of lineitem are moved once: distinct suppliers are counted where they arrive.
    plan = relation(spark, DATA, "table_catalog")._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "RepartitionByExpression" in plan


def test_counting_a_layer_joins_nothing(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    counts = catalogue.queries()["a40_layer_counts"](spark, DATA)
    assert not {k[2] for k in Run._stored} & {"column_catalog", "index_catalog", "fact_profile", "features"}
    assert "Join" not in counts._jdf.queryExecution().optimizedPlan().toString()
    run = Run(spark, DATA)
    assert {r["layer"]: r["n"] for r in counts.collect()}["features"] == run.features.count()


def test_field_texts_write_no_rows_of_fields(spark, monkeypatch):
    monkeypatch.setattr(Run, "_stored", {})
    texts = catalogue.queries()["a2_p8_field_texts"](spark, DATA)
    assert "dim_field" not in {k[2] for k in Run._stored}
    plain = catalog.field_texts(Run(spark, DATA).fields)
    assert texts.dtypes == plain.dtypes and sorted(map(tuple, texts.collect())) == sorted(map(tuple, plain.collect()))


def test_semantics_are_no_single_method(spark):
    plain = {n: next((label for label, patterns in SEMANTIC_RULES if any(_like(n.lower(), p) for p in patterns)), "other") for n in ("EMPLID", "id_x", "id_", "X_ID", "_id", "Given Name", "BUSINESSXUNIT", "ZZ", "PRICE", "note", "fax_dt")}
    df = spark.createDataFrame([(n, None) for n in plain] + [("zz", "TIMESTAMP(6)"), (None, None)], "n string, t string").withColumn("s", column_semantics(F.col("n"), F.col("t")))
    assert {(r["n"], r["t"]): r["s"] for r in df.collect()} == {**{(n, None): s for n, s in plain.items()}, ("zz", "TIMESTAMP(6)"): "date_or_timestamp", (None, None): "other"}
    assert "transform(" in df._jdf.queryExecution().executedPlan().toString()


def _like(text, pattern):
    import re

    return re.fullmatch(pattern.replace("%", ".*").replace("_", "."), text) is not None


def test_input_texts_need_no_profile(spark, monkeypatch):
    """The texts are those of the dataset, but neither it nor the profile and the indexes are built for them."""
    monkeypatch.setattr(Run, "_stored", {})
    texts = catalogue.queries()["p33_p34_input_text"](spark, DATA)
    assert not {name for _, _, name in Run._stored} & {"dataset", "fact_profile", "index_catalog"}
    own = sorted(map(tuple, texts.collect()))
    assert own == sorted(map(tuple, features.model_input_text(Run(spark, DATA).dataset).collect())) and len(own) > 1000


def test_names_and_texts_need_no_dataset(spark, monkeypatch):
    """Who reads names only builds the assets, who reads texts only no profile; the rows are those of the dataset."""
    needs = {"j9_scored_assets": {"column_catalog"}, "c7_char_vocabulary": {"column_catalog"}, "c8_word_vocabulary": set(), "c28_metadata_hint": set()}
    found = {}
    for name, more in needs.items():
        monkeypatch.setattr(Run, "_stored", {})
        rows = catalogue.queries()[name](spark, DATA)
        assert not {k[2] for k in Run._stored} & ({"dataset", "fact_profile", "index_catalog"} | more)
        found[name] = sorted(map(tuple, rows.collect()), key=repr)
    run = Run(spark, DATA)
    texts = run.dataset
    assert sorted(map(tuple, run.assets.select("run_id", "asset_id", "technical_name").collect())) == sorted(map(tuple, texts.select("run_id", "asset_id", "technical_name").collect()))
    for name in ("c8_word_vocabulary", "c28_metadata_hint"):
        assert sorted(map(tuple, catalogue.queries()[name](spark, DATA).collect()), key=repr) == found[name]
