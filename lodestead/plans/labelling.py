"""Queries of evaluation, monitoring and the label lifecycle."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestead.functions.rules import first_match_sql
from lodestead.operators import archive, classify, cost, evaluate, labels
from lodestead.plans.catalogue import Run, query
from lodestead.plans.twins import twin

BAND = first_match_sql(archive.confidence_rules("confidence"))
SCORED = "scored AS (SELECT * FROM gold WHERE trim(coalesce(human_label, '')) <> '' AND lower(trim(human_label)) <> 'ambiguous')"
CONFUSION = "confusion AS (SELECT human_label AS label, predicted, count(*) AS n FROM scored GROUP BY ALL)"
CLASSES = """classes AS (SELECT label, support, made, hit, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1 FROM (
  SELECT coalesce(a.label, b.label) AS label, coalesce(support, 0) AS support, coalesce(made, 0) AS made, coalesce(hit, 0) AS hit,
         CASE WHEN coalesce(made, 0) > 0 THEN coalesce(hit, 0) / made ELSE 0 END AS p, CASE WHEN coalesce(support, 0) > 0 THEN coalesce(hit, 0) / support ELSE 0 END AS r
  FROM (SELECT label, sum(n)::DOUBLE AS support, sum(CASE WHEN label = predicted THEN n ELSE 0 END)::DOUBLE AS hit FROM confusion GROUP BY label) a
  FULL JOIN (SELECT predicted AS label, sum(n)::DOUBLE AS made FROM confusion GROUP BY predicted) b ON a.label = b.label))"""
VOTES = ("Finance", "IT", "Other")
#: What the terms are looked for in.
TEXTS = ("technical_name", "source_ref", "column_names_text", "column_value_semantics_text")
CONSENSUS = """consensus AS (
  SELECT asset_id, label, n AS votes, valid_votes, n::DOUBLE / valid_votes AS consensus, (ties > 1 OR n::DOUBLE / valid_votes < 0.5) AS needs_adjudication FROM (
    SELECT *, sum(n) OVER (PARTITION BY asset_id) AS valid_votes, row_number() OVER (PARTITION BY asset_id ORDER BY n DESC, seen, label) AS rn, count(*) OVER (PARTITION BY asset_id, n) AS ties
    FROM (SELECT asset_id, label, count(*) AS n, min(vote_no) AS seen FROM votes WHERE label IN ('Finance', 'IT', 'Other') GROUP BY ALL)) WHERE rn = 1)"""


def _rounded(df, *columns: str, digits: int = 6):
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _scored(r: Run):
    return evaluate.usable_labels(r.raw("gold"))


def _band():
    return archive.confidence_band(F.col("confidence"))


def _consensus(r: Run):
    return labels.vote_consensus(r.raw("votes"), VOTES)


query("a18_class_distribution", twin(" SELECT run_id, domain AS label, count(*) AS n, round(count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY run_id), 6) AS share FROM prediction GROUP BY run_id, domain"))(
    lambda r: _rounded(evaluate.distribution(r.raw("prediction"), "domain", ("run_id",)), "share")
)
query("a19_confidence_bands", twin(f" SELECT {BAND} AS band, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM prediction GROUP BY 1"))(lambda r: _rounded(evaluate.confidence_bins(r.raw("prediction"), _band()), "mean_confidence"))
query("a20_calibration", twin(f" SELECT {BAND} AS band, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, round(avg((predicted = human_label)::INT), 6) AS accuracy, round(avg((predicted = human_label)::INT) - avg(confidence), 6) AS gap FROM scored GROUP BY 1", SCORED))(
    lambda r: _rounded(evaluate.calibration(_scored(r), _band()), "mean_confidence", "accuracy", "gap")
)
query("a20_calibration_error", twin(f" SELECT round(e, 6) AS ece, CASE WHEN e <= 0.05 THEN 'OK' WHEN e <= 0.15 THEN 'WARNING' ELSE 'CRITICAL' END AS status FROM (SELECT sum(n * abs(a - c)) / sum(n) AS e FROM (SELECT {BAND} AS band, count(*) AS n, avg(confidence) AS c, avg((predicted = human_label)::INT) AS a FROM scored GROUP BY 1))", SCORED))(
    lambda r: _rounded(evaluate.expected_calibration_error(evaluate.calibration(_scored(r), _band())), "ece")
)
query("a21_recall_sla", twin(" SELECT human_label AS label, count(*) AS n, round(avg((predicted = human_label)::INT), 6) AS recall, CASE WHEN human_label IN ('Finance', 'HR', 'Procurement', 'Sales') THEN 0.9::DOUBLE END AS target, coalesce(avg((predicted = human_label)::INT) < CASE WHEN human_label IN ('Finance', 'HR', 'Procurement', 'Sales') THEN 0.9 END, false) AS violation FROM scored GROUP BY human_label", SCORED))(
    lambda r: _rounded(evaluate.recall_by_domain(_scored(r), r.spark.createDataFrame(evaluate.RECALL_SLA, "label string, target double")), "recall")
)
query("a22_run_divergence", twin(""" SELECT run_id, round(sum(p * ln(p / m) + q * ln(q / m)) / 2, 8) AS divergence, sum(p * ln(p / m) + q * ln(q / m)) / 2 > 0.05 AS alert FROM (
  SELECT *, (p + q) / 2 AS m FROM (SELECT run_id, label, share AS p, lag(share) OVER (PARTITION BY label ORDER BY run_id) AS q FROM (
    SELECT r.run_id, l.label, coalesce(s.share, 0) + 1e-10 AS share FROM (SELECT DISTINCT run_id FROM gold) r CROSS JOIN (SELECT DISTINCT human_label AS label FROM gold) l
    LEFT JOIN (SELECT run_id, human_label AS label, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY run_id) AS share FROM gold GROUP BY run_id, human_label) s ON s.run_id = r.run_id AND s.label = l.label)) WHERE q IS NOT NULL) GROUP BY run_id"""))(
    lambda r: _rounded(evaluate.run_divergence(r.raw("gold"), "human_label"), "divergence", digits=8)
)
query("a25_top_confusions", twin(" SELECT * FROM confusion WHERE label <> predicted ORDER BY n DESC, label, predicted LIMIT 10", SCORED, CONFUSION))(lambda r: evaluate.top_confusions(evaluate.confusion(_scored(r))))
_NAMES = ["Finance", "HR", "IT", "Procurement", "Sales", "Supply"]
query("a26_confusion_matrix", twin(" SELECT human_label AS label, " + ", ".join(f"count(*) FILTER (WHERE predicted = '{n}') AS \"{n}\"" for n in _NAMES) + " FROM scored GROUP BY human_label", SCORED))(lambda r: evaluate.confusion_matrix(_scored(r), _NAMES))
query("a27_class_scores", twin(" SELECT label, CAST(support AS BIGINT) AS support, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM classes", SCORED, CONFUSION, CLASSES))(
    lambda r: _rounded(evaluate.class_scores(evaluate.confusion(_scored(r))).drop("made", "hit"), "precision", "recall", "f1")
)
query("a27_a28_overall_scores", twin(" SELECT n, round(acc, 6) AS accuracy, round(m, 6) AS macro_f1, round(w, 6) AS weighted_f1, round((acc - pe) / (1 - pe), 6) AS kappa FROM (SELECT CAST(sum(support) AS BIGINT) AS n, sum(hit) / sum(support) AS acc, avg(f1) AS m, sum(f1 * support) / sum(support) AS w, sum(support * made) / (sum(support) * sum(support)) AS pe FROM classes)", SCORED, CONFUSION, CLASSES))(
    lambda r: _rounded(evaluate.overall_scores(evaluate.confusion(_scored(r))), "accuracy", "macro_f1", "weighted_f1", "kappa")
)
query("a29_accuracy_by_slice", twin(f" SELECT run_id, {BAND} AS band, count(*) AS n, round(avg((predicted = human_label)::INT), 6) AS accuracy FROM scored GROUP BY ALL", SCORED))(
    lambda r: _rounded(evaluate.accuracy_by(_scored(r).withColumn("band", _band()), "run_id", "band"), "accuracy")
)
query("a24_coverage_report", twin(" SELECT predicted, count(*) AS n, round(avg(confidence), 6) AS mean_confidence, min(confidence) AS min_confidence, round(avg((confidence >= 0.85)::INT), 6) AS share_high, round(avg((predicted = human_label)::INT), 6) AS agreement, round(count(*)::DOUBLE / sum(count(*)) OVER (), 6) AS share FROM scored GROUP BY predicted", SCORED))(
    lambda r: _rounded(evaluate.coverage_report(_scored(r)), "mean_confidence", "share_high", "agreement", "share")
)
query("a30_vote_consensus", twin(" SELECT asset_id, label, CAST(votes AS BIGINT) AS votes, CAST(valid_votes AS BIGINT) AS valid_votes, round(consensus, 6) AS consensus, needs_adjudication FROM consensus", CONSENSUS))(lambda r: _rounded(_consensus(r), "consensus"))
query("a31_vote_disagreement", twin(" SELECT a AS label_a, b AS label_b, count(*) AS n FROM (SELECT asset_id, min(label) AS a, max(label) AS b FROM votes WHERE label IN ('Finance', 'IT', 'Other') GROUP BY asset_id HAVING count(DISTINCT label) = 2) GROUP BY ALL"))(
    lambda r: labels.vote_disagreement(r.raw("votes"), VOTES)
)
_BINS = ", ".join(f"count(*) FILTER (WHERE consensus > {a} AND consensus <= {b}) AS bin_{round(b * 100)}" for a, b in ((0.0, 0.5), (0.5, 0.6), (0.6, 0.7), (0.7, 0.8), (0.8, 0.9), (0.9, 1.0)))
query("a32_consensus_histogram", twin(f" SELECT label, count(*) AS n, round(avg(consensus), 6) AS mean, round(median(consensus), 6) AS median, round(min(consensus), 6) AS least, {_BINS} FROM consensus GROUP BY label", CONSENSUS))(
    lambda r: _rounded(labels.consensus_histogram(_consensus(r)), "mean", "median", "least")
)
query("c31_quality_tiers", twin(" SELECT tier, count(*) AS n FROM (SELECT CASE WHEN consensus = 0.5 AND valid_votes = 2 THEN 'reject' WHEN consensus >= 0.7 THEN 'gold' ELSE 'review' END AS tier FROM consensus) GROUP BY tier", CONSENSUS))(
    lambda r: labels.quality_tiers(_consensus(r)).groupBy("tier").agg(F.count("*").alias("n"))
)
query("c33_business_review_queue", twin(" SELECT run_id, recname, predicted, confidence, human_label, CASE WHEN confidence < 0.60 THEN 'low_confidence' WHEN confidence >= 0.8 AND human_label <> predicted THEN 'confident_disagreement' WHEN share < 0.05 AND confidence < 0.85 THEN 'rare_class' END AS reason FROM (SELECT *, count(*) OVER (PARTITION BY predicted)::DOUBLE / count(*) OVER () AS share FROM scored) WHERE confidence < 0.60 OR (confidence >= 0.8 AND human_label <> predicted) OR (share < 0.05 AND confidence < 0.85)", SCORED))(
    lambda r: labels.business_review_queue(_scored(r))
)
query("w8_equal_allocation_sample", twin(" SELECT run_id, asset_id, asset_type FROM (SELECT d.run_id, d.asset_id, d.asset_type, row_number() OVER (PARTITION BY d.run_id, d.asset_type ORDER BY has_profile_data DESC, md5(d.asset_id), d.asset_id) AS rn, t.target FROM dataset d JOIN (SELECT run_id, asset_type, least(floor(500 / count(*) OVER ()) + CASE WHEN row_number() OVER (ORDER BY run_id, asset_type) <= 500 % count(*) OVER () THEN 1 ELSE 0 END, n) AS target FROM (SELECT run_id, asset_type, count(*) AS n FROM dataset GROUP BY ALL)) t ON t.run_id = d.run_id AND t.asset_type = d.asset_type) WHERE rn <= target"))(
    lambda r: labels.equal_allocation_sample(r.dataset.select("run_id", "asset_id", "asset_type", "has_profile_data"), ("run_id", "asset_type"), 500, prefer="has_profile_data", key="asset_id").select("run_id", "asset_id", "asset_type")
)
query("w9_proportional_sample", twin(" SELECT recname, predicted, run_id FROM (SELECT *, row_number() OVER (PARTITION BY run_id, predicted ORDER BY md5(recname), recname) AS rn, greatest(1, round(count(*) OVER (PARTITION BY run_id, predicted) * 0.1)) AS target FROM gold) WHERE rn <= target ORDER BY md5(recname), recname, predicted, run_id LIMIT 1000"))(
    lambda r: labels.proportional_sample(r.raw("gold").select("recname", "predicted", "run_id"), ("run_id", "predicted"), 0.1, key="recname", most=1000)
)
query("j22_model_disagreement", twin(" SELECT run_id, recname, predicted AS deployed, human_label AS baseline FROM gold WHERE predicted IS DISTINCT FROM human_label"))(
    lambda r: labels.model_disagreement(r.raw("gold").select("run_id", "recname", F.col("predicted").alias("label")), r.raw("gold").select("run_id", "recname", F.col("human_label").alias("label")), ("run_id", "recname"))
)
query("k13_duplicate_keys", twin(" SELECT run_id, upper(physical_table_name) AS table_name, column_name, count(*) AS n FROM column_catalog GROUP BY ALL HAVING count(*) > 1"))(
    lambda r: labels.duplicate_keys(r.raw("column_catalog").withColumn("table_name", F.upper("physical_table_name")), "run_id", "table_name", "column_name")
)
query("k12_missing_runs", twin(" SELECT month(o_orderdate) AS run_id, min(o_orderdate) AS first_load, max(o_orderdate) AS last_load, count(*) AS n FROM orders WHERE month(o_orderdate) NOT IN (SELECT run_id FROM runs) GROUP BY 1"))(
    lambda r: labels.missing_runs(r.table("orders").select(F.month("o_orderdate").alias("run_id"), F.col("o_orderdate").alias("loaded_at")), r.raw("runs"))
)
query("a40_layer_counts", twin(" SELECT 'raw_tables' AS layer, count(*) AS n FROM table_catalog UNION ALL SELECT 'raw_records', count(*) FROM record_catalog UNION ALL SELECT 'assets', count(*) FROM dim_asset UNION ALL SELECT 'features', count(*) FROM features"))(
    lambda r: labels.layer_counts(raw_tables=r.raw("table_catalog"), raw_records=r.raw("record_catalog"), assets=r.assets, features=r.unwritten_features)
)
query("s7_prefixes", twin(" SELECT DISTINCT substr(recname, 1, 2) AS prefix FROM record_catalog"))(lambda r: r.raw("record_catalog").select(F.substring("recname", 1, 2).alias("prefix")).distinct())
#: The values of an embedding stand for the scores of as many classes.
_SCORES = "list_transform(embedding, lambda x: x::DOUBLE)"
query("w12_top_two", f"""SELECT vec_id, 'class_' || a[1].i AS top1, 'class_' || a[2].i AS top2, round(-a[1].s, 6) AS p1, round(-a[2].s, 6) AS p2 FROM (
  SELECT vec_id, list_sort([{{'s': -v, 'i': i - 1}} FOR v, i IN {_SCORES}]) AS a FROM embeddings)""")(
    lambda r: _rounded(r.table("embeddings").select("vec_id", evaluate.top_two(F.col("embedding").cast("array<double>")).alias("t")).select("vec_id", "t.top1", "t.top2", "t.p1", "t.p2"), "p1", "p2")
)
query("c12_softmax", f"SELECT vec_id, list_transform(e, lambda x: round(exp(x) / list_sum(list_transform(e, lambda y: exp(y))), 6))::VARCHAR AS p, round(list_sum(e), 6) AS total FROM (SELECT vec_id, {_SCORES} AS e FROM embeddings)")(
    lambda r: r.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e")).select(
        "vec_id", F.concat(F.lit("["), F.array_join(F.transform(evaluate.softmax(F.col("e")), lambda x: F.round(x, 6).cast("string")), ", "), F.lit("]")).alias("p"), F.round(F.aggregate("e", F.lit(0.0), lambda a, b: a + b), 6).alias("total")
    )
)
_PATTERNS = {name: classify.term_pattern(t) for name, t in classify.TERMS.items()}
_TERM_LISTS = "[" + ", ".join(f"{{'m': -len(regexp_extract_all(x, '{p}')), 'o': {k}, 'd': '{classify.TERM_LABELS[n]}'}}" for k, (n, p) in enumerate(_PATTERNS.items())) + "]"
query("c1_c2_keyword_domain", twin(f""" SELECT run_id, asset_id, CASE WHEN sure THEN h[1].d END AS domain, CASE WHEN sure AND s > 0 THEN h[2].d END AS domain_alt,
  CASE WHEN sure THEN round(least(0.7::DOUBLE + least(0.03::DOUBLE * (t - 2), 0.12::DOUBLE) + CASE WHEN s = 0 THEN 0.08::DOUBLE ELSE least(greatest(0.02::DOUBLE * (t::DOUBLE / greatest(s, 1) - 3), 0), 0.08::DOUBLE) END, 0.9::DOUBLE), 4) END AS confidence, t AS top_hits
  FROM (SELECT *, t >= 2 AND t >= 3 * s AS sure FROM (SELECT *, -h[1].m AS t, -h[2].m AS s FROM (SELECT run_id, asset_id, list_sort({_TERM_LISTS}) AS h FROM (
    SELECT *, lower(technical_name || ' ' || source_ref || ' ' || column_names_text || ' ' || column_value_semantics_text) AS x FROM dataset))))"""))(
    lambda r: classify.keyword_domain(r.dataset.select("run_id", "asset_id", *TEXTS), F.concat_ws(" ", *TEXTS)).drop(*TEXTS)
)
query("c24_calibrated_decision", f"""SELECT vec_id, 'class_' || (k - 1) AS label, round(exp(e[k] / (0.8::DOUBLE + 0.1::DOUBLE * ((k - 1) % 5))) / list_sum(list_transform(e, lambda x: exp(x / (0.8::DOUBLE + 0.1::DOUBLE * ((k - 1) % 5))))), 6) AS confidence,
  (k - 1) % 4 = 0 AND exp(e[k] / (0.8::DOUBLE + 0.1::DOUBLE * ((k - 1) % 5))) / list_sum(list_transform(e, lambda x: exp(x / (0.8::DOUBLE + 0.1::DOUBLE * ((k - 1) % 5))))) < 0.6 AS review
  FROM (SELECT vec_id, e, list_position(s, list_max(s)) AS k FROM (SELECT vec_id, e, [v + 0.05::DOUBLE * ((i - 1) % 3) FOR v, i IN e] AS s FROM (SELECT vec_id, {_SCORES} AS e FROM embeddings)))""")(
    lambda r: _rounded(
        r.table("embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e")).select("vec_id", classify.calibrated_decision(
            F.col("e"), lambda i: F.concat(F.lit("class_"), i.cast("string")), lambda i: 0.05 * (i % 3), lambda i: 0.8 + 0.1 * (i % 5), regulated=lambda i: i % 4 == 0).alias("d")).select("vec_id", "d.*"), "confidence")
)
query("p1_row_hash", twin(""" SELECT run_id, recname, sha256('{"recdescr":' || coalesce('"' || recdescr || '"', 'null') || ',"recname":"' || recname || '","run_id":' || run_id || '}') AS row_hash FROM record_catalog"""))(
    lambda r: (lambda d: d.select("run_id", "recname", classify.row_hash(d, "run_id", "recname", "recdescr").alias("row_hash")))(r.raw("record_catalog"))
)
query("p32_encrypted_names", "SELECT c_custkey, c_name AS opened, CAST(NULL AS VARCHAR) AS wrong_key FROM customer")(
    lambda r: r.table("customer").select("c_custkey", classify.encrypt(F.col("c_name"), F.lit("0123456789abcdef")).alias("e"))
    .select("c_custkey", classify.decrypt(F.col("e"), F.lit("0123456789abcdef")).alias("opened"), classify.decrypt(F.col("e"), F.lit("fedcba9876543210")).alias("wrong_key"))
)
query("a37_most_shared_fields", twin(" SELECT column_name, count(DISTINCT recname) AS records FROM column_catalog GROUP BY column_name"))(lambda r: r.raw("column_catalog").groupBy("column_name").agg(F.countDistinct("recname").alias("records")))
query("a37_records_by_owner", twin(" SELECT oracle_owner, rectype, count(*) AS records, sum(table_exists_flag) AS existing FROM record_catalog GROUP BY ALL"))(
    lambda r: r.raw("record_catalog").groupBy("oracle_owner", "rectype").agg(F.count("*").alias("records"), F.sum("table_exists_flag").alias("existing"))
)
_NET = "SELECT scenario_id, y, g, sum(total * pow(1 + g, y) * 0.276::DOUBLE) OVER w AS c, sum((total - arch) * pow(1 + g, y) * 0.276::DOUBLE + arch * pow(1 + g / 2, y) * 0.048::DOUBLE) OVER w AS k, total * pow(1 + g, y) AS v"
query("x1_savings_projection", twin(f""" SELECT y AS year_offset, round(median(v), 4) AS volume_no_action_gb, round(median(c), 2) AS cumul_cost_no_action_usd, round(median(k), 2) AS cumul_cost_with_archiving_usd,
  round(quantile_cont(c - k, 0.1), 2) AS net_savings_p10_usd, round(quantile_cont(c - k, 0.5), 2) AS net_savings_p50_usd, round(quantile_cont(c - k, 0.9), 2) AS net_savings_p90_usd, round(avg((c - k > 0)::INT), 3) AS breakeven_probability, count(*) AS n_scenarios
  FROM ({_NET} FROM (SELECT l_orderkey AS scenario_id, max(l_tax) * 3 AS g FROM lineitem GROUP BY l_orderkey) s
    CROSS JOIN (SELECT sum(total_size_gb) AS total, sum(archivable_size_gb) AS arch FROM costs) t CROSS JOIN (SELECT unnest(range(6)) AS y) WINDOW w AS (PARTITION BY scenario_id ORDER BY y ROWS UNBOUNDED PRECEDING)) GROUP BY y"""))(
    lambda r: cost.project_savings(_scenarios(r), _volumes(r), cost.PARAMS)
)


def _scenarios(r: Run):
    return r.table("lineitem").groupBy(F.col("l_orderkey").alias("scenario_id")).agg((F.max("l_tax") * 3).alias("growth"))


def _volumes(r: Run):
    return r.costs.agg(F.sum("total_size_gb").alias("total"), F.sum("archivable_size_gb").alias("archivable"))


query("w11_first_wins", twin(" SELECT asset_id, vote_no, variant, label FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY CASE variant WHEN 'semantic_first' THEN 0 ELSE 1 END, vote_no, label) AS rn FROM votes) WHERE rn = 1"))(
    lambda r: labels.first_wins(r.raw("votes"), ("asset_id",), F.when(F.col("variant") == "semantic_first", 0).otherwise(1), F.col("vote_no"), F.col("label"))
)
query("a23_share_drift", twin(""" SELECT run_id, label, round(share, 6) AS share, round(change, 6) AS change, abs(change) > 0.1 AS alert FROM (SELECT *, share - lag(share) OVER (PARTITION BY label ORDER BY run_id) AS change FROM (
  SELECT r.run_id, l.label, coalesce(s.share, 0) AS share FROM (SELECT DISTINCT run_id FROM gold) r CROSS JOIN (SELECT DISTINCT human_label AS label FROM gold) l
  LEFT JOIN (SELECT run_id, human_label AS label, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY run_id) AS share FROM gold GROUP BY run_id, human_label) s ON s.run_id = r.run_id AND s.label = l.label)) WHERE change IS NOT NULL"""))(
    lambda r: _rounded(evaluate.share_drift(evaluate.distribution(r.raw("gold"), "human_label", ("run_id",))), "share", "change")
)
query("j24_annotation_export", twin(" SELECT q.*, d.column_names_text, d.column_value_semantics_text FROM queue q JOIN dataset d ON d.run_id = q.run_id AND d.asset_id = q.asset_id ORDER BY priority_rank, confidence NULLS LAST, q.asset_id LIMIT 500"))(
    lambda r: archive.annotation_export(archive.approval_queue(r.decisions), r.dataset)
)
_SIDE = """SELECT sum(hit) / sum(support) AS accuracy, avg(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) AS macro_f1 FROM (
  SELECT coalesce(hit, 0) AS hit, coalesce(support, 0) AS support, coalesce(coalesce(hit, 0) / made, 0) AS p, coalesce(coalesce(hit, 0) / support, 0) AS r
  FROM (SELECT human_label AS label, count(*)::DOUBLE AS support, count(*) FILTER (WHERE human_label = predicted)::DOUBLE AS hit FROM scored WHERE {0} GROUP BY 1) FULL JOIN (SELECT predicted AS label, count(*)::DOUBLE AS made FROM scored WHERE {0} GROUP BY 1) USING (label))"""
query("c22_regression_gate", twin(f" SELECT round(a.macro_f1, 8) AS candidate_f1, round(a.accuracy, 8) AS candidate_accuracy, round(b.macro_f1, 8) AS production_f1, a.macro_f1 - b.macro_f1 >= -0.01 AS no_regression, a.macro_f1 >= 0.8 AND a.accuracy >= 0.85 AS above_floors FROM ({_SIDE.format('run_id = 7')}) a CROSS JOIN ({_SIDE.format('run_id < 7')}) b", SCORED))(
    lambda r: _rounded(
        evaluate.regression_gate(evaluate.overall_scores(evaluate.confusion(_scored(r).where("run_id = 7"))), evaluate.overall_scores(evaluate.confusion(_scored(r).where("run_id < 7")))),
        "candidate_f1", "candidate_accuracy", "production_f1", digits=8,
    )
)
