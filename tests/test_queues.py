"""Queues, taxonomy and quality reports on small tables of their own."""

import pytest
from pyspark.sql import functions as F

from lodestead.operators import evaluate, labels, quality, queues, taxonomy


def test_queues_hold_a_key_once_under_its_first_reason(spark):
    consensus = spark.createDataFrame([(1, "A", 0.5, 2), (2, "A", 0.6, 5), (3, "A", 0.9, 10), (4, "B", 1.0, 3), (5, "A", 0.7, 10)], "asset_id int, label string, consensus double, valid_votes int")
    votes = spark.createDataFrame([(2, "A"), (2, "B"), (3, "A"), (3, "B"), (4, "B"), (5, "A"), (5, "C")], "asset_id int, label string")
    got = {r["asset_id"]: r["reason"] for r in queues.label_review_queue(consensus, votes, ("A", "B")).collect()}
    assert got == {1: "coin_flip_reject", 2: "low_consensus", 3: "label_pair_confusion"}


def test_relabelling_prefers_high(spark):
    rows = [(1, "T", "F"), (1, "T", "T"), (2, "T", "T"), (3, "R", "R"), (4, "X", "F"), (None, "R", "R")]
    df = spark.createDataFrame(rows, "id int, label string, predicted string")
    got = {r["id"]: r["review_priority"] for r in queues.relabelling_set(df, "id", (("T", "F"),), ("T",), ("R",)).collect()}
    assert got == {1: "high", 2: "medium", 3: "high"}


def test_weighted_sample_fills_up(spark):
    rows = [(f"a{k}", "A", k < 2) for k in range(40)] + [(f"b{k}", "B", k < 38) for k in range(40)] + [("c0", "C", None)]
    df = spark.createDataFrame(rows, "id string, domain string, review boolean")
    got = queues.review_weighted_sample(df, "domain", 30, review="review", key="id").groupBy("domain").agg(F.count("*").alias("n"), F.count_if("review").alias("r")).collect()
    assert {r["domain"]: (r["n"], r["r"]) for r in got} == {"A": (10, 2), "B": (8, 6), "C": (1, 0)} or {r["domain"]: (r["n"], r["r"]) for r in got} == {"A": (10, 2), "B": (10, 8), "C": (1, 0)}


def test_ids_and_names(spark):
    source = spark.createDataFrame([(7, "x", None), (3, "x", None), (9, "y", 1)], "id int, a string, b int")
    got = {(r["a"], r["b"]): r["id"] for r in queues.reattached(source.select("a", "b").distinct().union(spark.createDataFrame([("z", 1)], "a string, b int")), source, ("a", "b"), "id").collect()}
    assert got == {("x", None): 3, ("y", 1): 9, ("z", 1): None}
    united = queues.united_labels(spark.createDataFrame([(1, "Ambiguous"), (2, "A")], "asset_id int, label string"), spark.createDataFrame([(1, "B"), (2, "C"), (3, " ")], "asset_id int, label string"))
    assert {tuple(r) for r in united.collect()} == {(1, "B", 1), (2, "A", 0)}
    entropy = spark.createDataFrame([([0.5, 0.5],), ([1.0, 0.0],)], "p array<double>").select(queues.normalised_entropy(F.col("p"))).collect()
    assert [r[0] for r in entropy] == pytest.approx([1.0, 0.0])


@pytest.mark.parametrize(("raw", "label"), [("Ressource humaine", "RH"), ("La Paie", "Paie"), ("TRÉSORERIE", "Finance"), ("Approvisionnement", "Achats"), ("Sécurité", "Technique"), ("???", "Inconnu"), (None, "Inconnu")])
def test_labels_of_other_hands(spark, raw, label):
    assert spark.createDataFrame([(raw,)], "x string").select(F.expr(taxonomy.normalised_label("x"))).first()[0] == label


def test_remapping(spark):
    rows = [("PS_BIG_A", "rh"), ("X_1", "R.H"), ("X_1", "RH"), ("X_1", "le pôle finance-achats"), ("COLD_9", "?"), ("X_1", None)]
    df = spark.createDataFrame(rows, "technical_name string, label_raw string")
    maps = [spark.createDataFrame(m, "alias string, target string") for m in ([("rh", "HR"), ("finance", "F"), ("finance achats", "P")],)] + [spark.createDataFrame(m, "prefix string, target string") for m in ([("COLD", "S")], [("BIG", "IT")])]
    got = [(r["target"], r["status"], r["review"]) for r in taxonomy.remapped(df, *maps).orderBy("technical_name", F.col("label_raw").desc()).collect()]
    assert sorted(got, key=str) == sorted([("IT", "known_module", False), ("HR", "alias", False), ("P", "contains_alias", True), ("S", "prefix", True), (None, "unresolved", True), (None, "unresolved", True)], key=str)


def test_replies(spark):
    replies = ['{"business_domain": "HR", "confidence": 2, "reason": "x"}', 'well {"business_domain": " IT ", "confidence": "0.25"} ok', '{"business_domain": "Else", "confidence": "high"}', "{broken", None, '{"business_domain": "HR", "confidence": "NaN", "reason": "' + "y" * 900 + '"}']
    got = spark.createDataFrame([(r,) for r in replies], "r string").select(taxonomy.repaired_reply(F.col("r"), ("HR", "IT")).alias("x")).select("x.*").collect()
    assert [(r["label"], r["confidence"]) for r in got] == [("HR", 1.0), ("IT", 0.25), ("Other", 0.0), ("Other", 0.0), ("Other", 0.0), ("HR", 0.0)] and len(got[5]["reason"]) == 500
    weak = spark.createDataFrame([("Other", 0.1, "HR"), ("Other", 0.9, None), ("IT", 0.2, "HR")], "label string, confidence double, hint string")
    assert [(r["label"], r["confidence"]) for r in taxonomy.raised_fallback(weak).collect()] == [("HR", 0.45), ("Other", 0.9), ("IT", 0.2)]


def test_resolved_labels(spark):
    assets = spark.createDataFrame([(1, "HR_A"), (2, "HR_B"), (3, "HR_C"), (4, "ZZ_D"), (5, "ZZ_E")], "asset_id int, technical_name string")
    consensus = spark.createDataFrame([(1, "HR", False), (2, "IT", False), (5, "IT", True)], "asset_id int, label string, needs_adjudication boolean")
    got = {r["asset_id"]: (r["label"], r["source"], r["review"]) for r in labels.resolved_labels(assets, consensus, spark.createDataFrame([("HR", "HR")], "prefix string, target string")).collect()}
    assert got == {1: ("HR", "votes", False), 2: ("IT", "votes", True), 3: ("HR", "prefix", True), 4: ("Other", "default", True), 5: ("IT", "votes", True)}


def test_quality_report_without_reference(spark):
    predictions = spark.createDataFrame([(1, "A", 0.9)] * 9 + [(1, "B", 0.1)] + [(2, "B", 0.3)] * 4 + [(2, "A", 0.7)], "run_id int, domain string, confidence double")
    none = spark.createDataFrame([], "label string, recall double, target double, violation boolean")
    got = {r["run_id"]: r for r in quality.quality_report(predictions, none).collect()}
    assert not got[1]["sla_ok"] and got[1]["alerts"] == "no_reference" and got[1]["low_share"] == 0.1 and got[1]["divergence"] is None
    assert got[2]["alerts"] == "low_confidence,no_reference,drift" and got[2]["n_very_low"] == 4 and quality.latest_report(quality.quality_report(predictions, none)).first()["run_id"] == 2
    sla = spark.createDataFrame([("A", 0.9)], "label string, target double")
    judged = spark.createDataFrame([("A", "A")] * 9 + [("A", "B")], "human_label string, predicted string")
    assert quality.certified(judged, sla).first().asDict() == {"classes": 1, "violations": 0, "certified": True}
    assert not quality.certified(judged.limit(0), sla).first()["certified"] and evaluate.recall_by_domain(judged, sla).first()["recall"] == 0.9
