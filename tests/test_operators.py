"""Exact cases of single operators."""

import pytest
from pyspark.sql import functions as F

from lodestead.functions.semantics import column_semantics
from lodestead.operators import archive, catalog, cost, evaluate, labels


def one(df):
    return df.first().asDict()


def test_confidence_bands(spark):
    df = spark.createDataFrame([(1.0,), (0.85,), (0.8499,), (0.60,), (0.5999,), (0.0,), (None,)], "c double")
    assert [r[0] for r in df.select(archive.confidence_band(F.col("c"))).collect()] == ["high", "high", "medium", "medium", "low", "low", "unknown"]


def test_review_flags(spark):
    df = spark.createDataFrame([("HR", "low", 0.55, 0.2), ("Other", "medium", 0.7, 0.64), ("IT", "high", 0.91, 0.05), ("Sales", "medium", 0.6, 0.55), ("Other", "low", 0.3, 0.3)], "d string, b string, p double, q double")
    got = [r[0] for r in df.select(evaluate.review_flags(*map(F.col, "dbpq"))).collect()]
    assert got == ["low_model_confidence", "predicted_other", "", "close_top2_scores", "low_model_confidence,predicted_other,close_top2_scores"]


@pytest.mark.parametrize(
    ("sizes", "mean", "std", "source"),
    [([50, 60, 90], 1.8**0.5 - 1, 0.15, "observed"), ([40], 0.15, 0.05, "assumption"), ([], 0.15, 0.05, "assumption"), ([90, 60, 50], 0.15, 0.05, "assumption"), ([80, 100], 0.25, 0.05, "observed"), ([10, 11, 12.1], 0.1, 0.01, "observed")],
)
def test_growth(spark, sizes, mean, std, source):
    df = spark.createDataFrame([(k, "TOTAL", float(s)) for k, s in enumerate(sizes)], "run_id int, domain_label string, total_size_gb double")
    got = one(cost.growth_estimate(df, cost.PARAMS))
    assert got["growth_mean"] == pytest.approx(mean) and got["growth_source"] == source and (std is None or got["growth_std"] == pytest.approx(std))


def test_projection(spark):
    scenarios = spark.range(300).select(F.col("id").alias("scenario_id"), (0.15 + (F.col("id") % 21 - 10) / 200).alias("growth"))
    params = {**cost.PARAMS, "storage_cost_per_gb_per_year": 0.41, "cold_storage_cost_per_gb_year": 0.07, "implementation_cost_one_shot": 90.0}
    rows = sorted(cost.project_savings(scenarios, spark.createDataFrame([(700.0, 250.0)], "total double, archivable double"), params).collect())
    assert [r["year_offset"] for r in rows] == list(range(6)) and rows[-1]["net_savings_p50_usd"] > rows[0]["net_savings_p50_usd"]
    assert all(r["net_savings_p10_usd"] <= r["net_savings_p50_usd"] <= r["net_savings_p90_usd"] and 0 <= r["breakeven_probability"] <= 1 for r in rows)
    assert all(a["cumul_cost_no_action_usd"] <= b["cumul_cost_no_action_usd"] for a, b in zip(rows, rows[1:]))


@pytest.mark.parametrize(("bands", "ece"), [([(7, 0.65, 0.65)], 0.0), ([(50, 0.5, 0.75)], 0.25), ([(10, 0.9, 0.5), (30, 0.7, 0.8)], 0.175), ([(1, 0.2, 0.3), (1, 0.3, 0.2)], 0.1), ([], 0.0)])
def test_calibration_error(spark, bands, ece):
    df = spark.createDataFrame(bands, "n long, mean_confidence double, accuracy double")
    assert one(evaluate.expected_calibration_error(df))["ece"] == pytest.approx(ece)


def test_divergence(spark):
    def shares(**s):
        return spark.createDataFrame(list(s.items()), "label string, share double")

    def d(p, q):
        return one(evaluate.js_divergence(p, q))["divergence"]

    a, b = shares(A=0.7, B=0.3), shares(A=0.4, B=0.6)
    assert d(a, a) < 1e-6 and d(a, b) == pytest.approx(d(b, a)) and 0 < d(shares(A=1.0), shares(B=1.0)) < 0.7


def test_scores(spark):
    df = spark.createDataFrame([("F", "F"), ("F", "F"), ("R", "R"), ("F", "R"), ("R", "ambiguous"), ("R", "")], "predicted string, human_label string")
    used = evaluate.usable_labels(df)
    got = one(evaluate.overall_scores(evaluate.confusion(used)))
    assert got["n"] == 4 and got["accuracy"] == 0.75


def test_semantics_order(spark):
    names = ["VENDOR_ID", "EMPLID", "SETID", "EFFDT", "id1", "zz", None]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(column_semantics(F.col("n"), F.lit(None).cast("string"))).collect()]
    assert got == ["date_interval_boundary", "person_identifier", "identifier", "date_or_timestamp", "identifier", "other", "other"]


FACTS = {"size_mb": 60.0, "row_count": 1, "lineage_out_count": 0, "referenced_by_count": 0, "column_value_semantics_text": "A:label", "age_days": 2000, "access_reads": None, "confidence": 0.9, "review_required": False, "is_orphan": True, "regulated": False, "min_retention_years": 10}
FACTS_SCHEMA = "size_mb double, row_count int, lineage_out_count int, referenced_by_count int, column_value_semantics_text string, age_days int, access_reads long, confidence double, review_required boolean, is_orphan boolean, regulated boolean, min_retention_years int, want string"


def test_every_strategy_comes_before_the_next(spark):
    personal, kept = {"column_value_semantics_text": "B:phone_number"}, {"regulated": True, "age_days": 800}
    cases = [
        ({"size_mb": 0.0, "row_count": 0, "lineage_out_count": 99}, "NON_APPLICABLE"), ({"lineage_out_count": 10, **personal}, "CONSERVATION_CRITIQUE"), ({"lineage_out_count": 9}, "ARCHIVAGE_FROID"),
        ({"referenced_by_count": 20, **kept}, "CONSERVATION_CRITIQUE"), ({"referenced_by_count": 19, "is_orphan": False}, "ARCHIVAGE_FROID"), ({**personal, "age_days": 366}, "ARCHIVAGE_CHIFFRE"),
        ({**personal, "age_days": 365}, "CONSERVATION_SECURISEE"), ({**kept, "access_reads": 3}, "CONSERVATION_REGLEMENTAIRE"), ({"regulated": True, "age_days": 3650}, "ARCHIVAGE_FROID"),
        ({"regulated": True, "age_days": None}, "CONSERVATION_REGLEMENTAIRE"), ({"access_reads": 1, "confidence": 0.1}, "CONSERVATION"), ({"access_reads": 0, "confidence": 0.59}, "A_EVALUER"),
        ({"confidence": None}, "A_EVALUER"), ({"review_required": True}, "A_EVALUER"), ({"age_days": 1096}, "ARCHIVAGE_FROID"), ({"age_days": 91}, "ARCHIVAGE_FROID"), ({"age_days": None, "size_mb": 50.0}, "A_EVALUER"),
        ({"age_days": None, "size_mb": 49.0}, "CONSERVATION"), ({"age_days": 400, "is_orphan": False}, "COMPRESSION"), ({"age_days": 100, "is_orphan": None, "size_mb": 10.0}, "COMPRESSION"),
        ({"age_days": 100, "is_orphan": None, "size_mb": 9.0}, "CONSERVATION"), ({"age_days": 90}, "CONSERVATION"),
    ]
    df = spark.createDataFrame([tuple({**FACTS, **change}.values()) + (want,) for change, want in cases], FACTS_SCHEMA)
    wrong = archive.decided(df).where("recommended_strategy <> want").collect()
    assert not wrong, wrong


def test_reasons(spark):
    df = spark.createDataFrame([tuple({**FACTS, "size_mb": 123.4, "access_reads": 7, "confidence": 0.314}.values()) + ("",), tuple({**FACTS, "regulated": True, "age_days": None, "is_orphan": False, "lineage_out_count": 12}.values()) + ("",)], FACTS_SCHEMA)
    got = [r["rationale"] for r in archive.decided(df).collect()]
    assert got == [
        "volume_eleve(123Mo); inactif_>3ans; orpheline(0_objet_dependant); lu_depuis_demarrage(7); aucune_dependance_sortante; fail_safe:confiance_faible(0.31)",
        "retention_legale_10ans; fortement_reference(12_dependants)",
    ]


def test_retention_of_one_jurisdiction(spark):
    key = "run_id int, asset_id string"
    floors = spark.createDataFrame([("Finance", 9, True, "FR"), ("Finance", 2, False, "BE")], "domain_label string, min_retention_years int, regulated boolean, jurisdiction string")
    frames = {
        "assets": spark.createDataFrame([(1, "a", "o.t", "oracle_table", "o", "t")], f"{key}, technical_name string, asset_type string, owner_name string, source_ref string"),
        "predictions": spark.createDataFrame([(1, "a", "Finance", 0.9, False, "v")], f"{key}, domain string, confidence double, review_required boolean, model_version string"),
        "features": spark.createDataFrame([(1, "a", 5.0, 9, 0, 1.0)], f"{key}, size_mb double, row_count long, lineage_out_count long, archival_candidate_score double"),
        "dataset": spark.createDataFrame([(1, "a", "x:label")], f"{key}, column_value_semantics_text string"),
        "profile": spark.createDataFrame([], f"{key}, last_analyzed date"),
        "table_catalog": spark.createDataFrame([], "run_id int, owner string, table_name string, last_modified date, referenced_by_count long"),
        "access": spark.createDataFrame([], "run_id int, owner string, table_name string, logical_reads long"),
    }
    for place, years in (("FR", 9), ("BE", 2)):
        rows = archive.recommendations(**frames, retention=floors, as_of="2002-01-01", jurisdiction=place).collect()
        assert [(r["min_retention_years"], r["regulated"]) for r in rows] == [(years, place == "FR")]


def test_nullable_flag(spark):
    df = spark.createDataFrame([("Y",), ("n",), (None,), ("?",)], "f string")
    assert [r[0] for r in df.select(catalog.nullable_flag(F.col("f"))).collect()] == [True, False, True, None]


def test_votes(spark):
    df = spark.createDataFrame([(1, 1, "A"), (1, 2, "B"), (2, 1, "A"), (2, 2, "A"), (2, 3, "B"), (3, 1, "")], "asset_id long, vote_no int, label string")
    got = {r["asset_id"]: (r["label"], r["needs_adjudication"]) for r in labels.vote_consensus(df, ("A", "B")).collect()}
    assert got == {1: ("A", True), 2: ("A", False)}
