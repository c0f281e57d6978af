"""Queries of quality reports, queues, label repair, statistics and table maintenance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.functions import ranks
from lodestead.functions.rules import first_match_sql
from lodestead.functions.semantics import semantics_sql
from lodestead.functions.text import DUCKDB, SPARK, folded
from lodestead.operators import archive, catalog, classify, cost, evaluate, labels, profiling, quality, queues, salience, taxonomy
from lodestead.plans.catalogue import Run, oracle_sql, queries_of_run, query
from lodestead.plans.labelling import _NET, CONFUSION, CONSENSUS, SCORED, TEXTS, VOTES, _rounded, _scored
from lodestead.plans.twins import _values, twin
from lodestead.sources import sinks

RECALLS = """recalls AS (SELECT human_label AS label, avg((predicted = human_label)::INT) AS recall FROM scored WHERE human_label IN ('Finance', 'HR', 'Procurement', 'Sales') GROUP BY human_label)"""
SHARES = """shares AS (SELECT run_id, label, coalesce(n, 0)::DOUBLE / total AS share FROM (SELECT run_id, count(*) AS total FROM prediction GROUP BY run_id) CROSS JOIN (SELECT DISTINCT domain AS label FROM prediction)
  LEFT JOIN (SELECT run_id, domain AS label, count(*) AS n FROM prediction GROUP BY ALL) USING (run_id, label))"""
DIVERGENCES = """divergences AS (SELECT run_id, sum(p * ln(p / m) + q * ln(q / m)) / 2 AS divergence FROM (SELECT *, (p + q) / 2 AS m FROM (
  SELECT run_id, share + 1e-10 AS p, lag(share) OVER (PARTITION BY label ORDER BY run_id) + 1e-10 AS q FROM shares)) WHERE q IS NOT NULL GROUP BY run_id)"""


def _sla(r: Run):
    return r.spark.createDataFrame(evaluate.RECALL_SLA, "label string, target double")


def _reports(r: Run):
    return quality.quality_report(r.raw("prediction").select("run_id", "domain", "confidence"), evaluate.recall_by_domain(_scored(r), _sla(r)))


_BANDS = ", ".join(f"count(*) FILTER (WHERE band = '{b}') AS n_{b}" for b, _ in quality.REPORT_BANDS)
REPORTS = f"""reports AS (SELECT run_id, n_scored, low_share, {', '.join(f'n_{b}' for b, _ in quality.REPORT_BANDS)}, (SELECT count(*) > 0 AND bool_and(recall >= 0.9) FROM recalls) AS sla_ok, round(divergence, 8) AS divergence,
    coalesce(divergence > 0.05, false) AS drift_alert,
    concat_ws(',', CASE WHEN low_share > 0.15 THEN 'low_confidence' END, (SELECT string_agg('sla_violation:' || label, ',' ORDER BY label) FROM recalls WHERE recall < 0.9), CASE WHEN divergence > 0.05 THEN 'drift' END) AS alerts
  FROM (SELECT run_id, count(*) AS n_scored, round(avg((band IN ('very_low', 'low'))::INT), 4) AS low_share, {_BANDS} FROM (SELECT *, {first_match_sql(quality.REPORT_BANDS)} AS band FROM prediction) GROUP BY run_id)
  LEFT JOIN divergences USING (run_id))"""
query("c38_quality_report", twin(" SELECT * FROM reports", SCORED, RECALLS, SHARES, DIVERGENCES, REPORTS))(_reports)
query("k9_latest_report", twin(" SELECT * FROM reports WHERE run_id = (SELECT max(run_id) FROM reports)", SCORED, RECALLS, SHARES, DIVERGENCES, REPORTS))(lambda r: quality.latest_report(_reports(r)))
query("a21_certification", twin(" SELECT count(*) AS classes, count(*) FILTER (WHERE recall < 0.9) AS violations, count(*) > 0 AND bool_and(recall >= 0.9) AS certified FROM recalls", SCORED, RECALLS))(lambda r: quality.certified(_scored(r), _sla(r)))
query("a22_label_divergence", twin(""" SELECT round(sum(p * ln(p / m) + q * ln(q / m)) / 2, 8) AS divergence FROM (SELECT *, (p + q) / 2 AS m FROM (
  SELECT (coalesce(a, 0) + 1e-10) / (1 + 1e-10 * count(*) OVER ()) AS p, (coalesce(b, 0) + 1e-10) / (1 + 1e-10 * count(*) OVER ()) AS q
  FROM (SELECT predicted AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS a FROM scored GROUP BY predicted) FULL JOIN (SELECT human_label AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS b FROM scored GROUP BY human_label) USING (label)))""", SCORED))(
    lambda r: _rounded(evaluate.js_divergence(evaluate.distribution(_scored(r), "predicted"), evaluate.distribution(_scored(r), "human_label")), "divergence", digits=8)
)
query("a36_distribution_shift", twin(" SELECT round(max(abs(coalesce(a, 0) - coalesce(b, 0))), 6) AS max_change FROM (SELECT predicted AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS a FROM gold GROUP BY predicted) FULL JOIN (SELECT human_label AS label, count(*)::DOUBLE / sum(count(*)) OVER () AS b FROM scored GROUP BY human_label) USING (label)", SCORED))(
    lambda r: _rounded(quality.distribution_shift(evaluate.distribution(r.raw("gold"), "predicted"), evaluate.distribution(_scored(r), "human_label")), "max_change")
)
query("a23_drift_report", twin(""" SELECT run_id, n, round(c, 6) AS mean_confidence, round(low, 6) AS low_share, coalesce(alerts, '') AS alerts, alerts IS NULL AS ok FROM (
  SELECT *, nullif(concat_ws(',', (SELECT string_agg('class:' || label, ',' ORDER BY label) FROM moved WHERE moved.run_id = m.run_id AND abs(change) > 0.1), CASE WHEN c < lag(c) OVER w - 0.05 THEN 'confidence' END, CASE WHEN low > 0.15 THEN 'low_confidence' END,
    CASE WHEN abs(len - lag(len) OVER w) / greatest(lag(len) OVER w, 1) > 0.3 THEN 'mean:name_length' END), '') AS alerts
  FROM (SELECT run_id, count(*) AS n, avg(confidence) AS c, avg((confidence < 0.6)::INT) AS low, avg(length(recname) * CASE WHEN run_id % 3 = 0 THEN 2 ELSE 1 END) AS len FROM prediction GROUP BY run_id) m WINDOW w AS (ORDER BY run_id))""", SHARES, "moved AS (SELECT run_id, label, share - lag(share) OVER (PARTITION BY label ORDER BY run_id) AS change FROM shares)"))(
    lambda r: quality.drift_report(r.raw("prediction").withColumn("name_length", F.length("recname") * F.when(F.col("run_id") % 3 == 0, 2).otherwise(1)), structure=("name_length",))
)
query("s14_previous_snapshot", twin(" SELECT * FROM snapshots WHERE run_id = (SELECT max(run_id) FROM snapshots WHERE run_id < 5)"))(lambda r: quality.previous_snapshot(r.snapshots, 5))

# Term audit.
_AUDIT_TEXT = " || ' ' || ".join(TEXTS)
_TERM_HITS = ", ".join(f"len(regexp_extract_all(x, '{classify.term_pattern(t)}')) AS hits_{d}" for d, t in classify.TERMS.items())
_TERM_LIST = "[" + ", ".join(f"{{'m': -hits_{d}, 'o': {k}, 'd': '{d}'}}" for k, d in enumerate(classify.TERMS)) + "]"
_FOUND = "CASE kw_domain " + " ".join(f"WHEN '{d}' THEN regexp_extract_all(x, '{classify.term_pattern(t)}')" for d, t in classify.TERMS.items()) + " END"
_LABELLED = "CASE kw_domain " + " ".join(f"WHEN '{d}' THEN '{name}'" for d, name in classify.TERM_LABELS.items()) + " ELSE 'Inconnu' END"
AUDIT = f"""audit AS (SELECT run_id, asset_id, kw_domain, {_LABELLED} AS kw_label, CASE WHEN kw_domain IS NOT NULL THEN 0.95::DOUBLE END AS kw_confidence, kw_domain IS NOT NULL AS classified,
  coalesce(kw_domain IN ('supply_chain', 'procurement', 'risk', 'marketing'), false) AS is_focus_domain, coalesce(array_to_string(list_sort(list_distinct({_FOUND}))[1:10], ', '), '') AS matched_terms, {', '.join(f'hits_{d}' for d in classify.TERMS)}
  FROM (SELECT *, CASE WHEN -h[1].m >= 2 AND -h[1].m >= -3 * h[2].m THEN h[1].d END AS kw_domain FROM (SELECT *, list_sort({_TERM_LIST}) AS h FROM (SELECT *, {_TERM_HITS} FROM (SELECT *, lower({_AUDIT_TEXT}) AS x FROM dataset)))))"""


def _audit(r: Run):
    return quality.term_audit(r.dataset, F.concat_ws(" ", *TEXTS))


query("c3_term_audit", twin(" SELECT * FROM audit", AUDIT))(_audit)
query("a33_audit_summary", twin(" SELECT coalesce(kw_domain, 'unclassified') AS kw_domain, count(*) AS assets, count(*) FILTER (WHERE is_focus_domain) AS focus FROM audit GROUP BY 1", AUDIT))(lambda r: quality.audit_summary(_audit(r)))

# Queues.
query("p29_review_flags", twin(" SELECT run_id, recname, concat_ws(',', CASE WHEN confidence < 0.6 THEN 'low_model_confidence' END, CASE WHEN domain = 'IT' AND run_id = 7 THEN 'predicted_other' END, CASE WHEN confidence - confidence * 0.95 <= 0.05 + 1e-12 THEN 'close_top2_scores' END) AS reasons FROM prediction"))(
    lambda r: r.raw("prediction").select("run_id", "recname", evaluate.review_flags(F.when((F.col("domain") == "IT") & (F.col("run_id") == 7), "Other").otherwise(F.col("domain")), archive.confidence_band(F.col("confidence")), F.col("confidence"), F.col("confidence") * 0.95).alias("reasons"))
)
query("c32_label_review_queue", twin(""" SELECT asset_id, label, consensus, reason FROM (SELECT *, CASE WHEN consensus < 0.7 AND consensus >= 0.5 AND NOT (consensus = 0.5 AND valid_votes = 2) THEN 'low_consensus' WHEN consensus = 0.5 AND valid_votes = 2 THEN 'coin_flip_reject'
  WHEN asset_id IN (SELECT asset_id FROM votes WHERE label IN ('IT', 'Other') GROUP BY asset_id HAVING count(DISTINCT label) = 2) THEN 'label_pair_confusion' END AS reason FROM consensus) WHERE reason IS NOT NULL""", CONSENSUS))(
    lambda r: queues.label_review_queue(labels.vote_consensus(r.raw("votes"), VOTES), r.raw("votes"), ("IT", "Other")).select("asset_id", "label", "consensus", "reason")
)
_SCORES = "SELECT vec_id, 'class_' || label AS label, 'class_' || a[1].i AS predicted, round(-a[1].s, 6) AS p1, round(-a[2].s, 6) AS p2 FROM (SELECT vec_id, label, list_sort([{'s': -exp(v::DOUBLE) / t, 'i': i - 1} FOR v, i IN embedding]) AS a FROM (SELECT *, list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE))) AS t FROM embeddings))"


def _vector_scores(r: Run):
    best = evaluate.top_two(evaluate.softmax(F.col("embedding").cast("array<double>")))
    scored = r.table("embeddings").select("vec_id", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label"), best.alias("t"))
    return scored.select("vec_id", "label", F.col("t.top1").alias("predicted"), F.round("t.p1", 6).alias("p1"), F.round("t.p2", 6).alias("p2"))


query("c34_l4_uncertainty_queue", f"""SELECT vec_id, review_priority FROM (SELECT *, round((1 - p1) * 100, 2) + 35 * (p1 - p2 <= 0.001)::INT + 25 * (predicted IN ('class_1', 'class_3'))::INT + 20 * (label IN ('class_1', 'class_3'))::INT + 15 * (label <> predicted)::INT AS review_priority
  FROM ({_SCORES}) WHERE p1 - p2 <= 0.001 OR predicted IN ('class_1', 'class_3') OR label IN ('class_1', 'class_3')) ORDER BY review_priority DESC, p1, vec_id LIMIT 200""")(
    lambda r: queues.uncertainty_queue(_vector_scores(r), r.spark.createDataFrame([("class_1",), ("class_3",)], "label string"), margin=0.001, top=200).select("vec_id", "review_priority")
)
query("c34_normalised_entropy", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: -exp(x::DOUBLE) / t * ln(exp(x::DOUBLE) / t))) / ln(len(embedding)), 6) AS entropy FROM (SELECT *, list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE))) AS t FROM embeddings)")(
    lambda r: _rounded(r.table("embeddings").select("vec_id", queues.normalised_entropy(evaluate.softmax(F.col("embedding").cast("array<double>"))).alias("entropy")), "entropy")
)


def _judged(r: Run):
    return r.raw("gold").where("run_id < 7").select(F.concat_ws("/", F.col("run_id").cast("string"), "recname").alias("id"), F.col("human_label").alias("label"), "predicted", "confidence")


_JUDGED = "judged AS (SELECT run_id || '/' || recname AS id, human_label AS label, predicted, confidence FROM gold WHERE run_id < 7)"
query("c35_relabelling_set", twin(" SELECT id, label, predicted, CASE WHEN (label = 'Finance' AND predicted IN ('HR', 'IT')) OR label = 'IT' THEN 'high' ELSE 'medium' END AS review_priority FROM judged WHERE (label = 'Finance' AND predicted IN ('HR', 'IT')) OR label = 'IT' OR (label = 'Sales' AND predicted = 'Sales')", _JUDGED))(
    lambda r: queues.relabelling_set(_judged(r), "id", (("Finance", "HR"), ("Finance", "IT")), ("Sales",), ("IT",)).select("id", "label", "predicted", "review_priority")
)
query("c36_error_slices", twin(" SELECT slice, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM (SELECT *, unnest([CASE WHEN label <> predicted THEN 'all_errors' END, CASE WHEN label = 'Finance' AND predicted = 'HR' THEN 'Finance_as_HR' END, CASE WHEN label = 'IT' AND predicted = 'Finance' THEN 'IT_as_Finance' END, CASE WHEN label = 'IT' AND predicted = 'IT' THEN 'IT_right' END]) AS slice FROM judged) WHERE slice IS NOT NULL GROUP BY slice", _JUDGED))(
    lambda r: _rounded(queues.error_slices(_judged(r), (("Finance", "HR"), ("IT", "Finance")), "IT").groupBy("slice").agg(F.count("*").alias("n"), F.avg("confidence").alias("mean_confidence")), "mean_confidence")
)
query("c37_contested", twin(" SELECT run_id, recname, predicted FROM gold WHERE predicted IS DISTINCT FROM human_label AND recname NOT IN (SELECT recname FROM record_catalog WHERE recdescr IS NULL)"))(
    lambda r: (lambda g: queues.contested(
        g.select("run_id", "recname", "predicted"), r.raw("record_catalog").where("recdescr is null").select("run_id", "recname"),
        labels.model_disagreement(g.select("run_id", "recname", F.col("predicted").alias("label")), g.select("run_id", "recname", F.col("human_label").alias("label")), ("run_id", "recname")), ("run_id", "recname"),
    ).select("run_id", "recname", "predicted"))(r.raw("gold"))
)
_QUOTA = "least(each, n) AS take, least(f, CAST(round_even(least(each, n) * 0.6, 0) AS BIGINT)) AS first"
query("w10_review_weighted_sample", twin(f""" SELECT id, domain, review_required FROM (SELECT p.*, row_number() OVER (PARTITION BY p.domain, p.review_required ORDER BY md5(p.id), p.id) AS rn, CASE WHEN p.review_required THEN qf ELSE qp END AS quota
  FROM named p JOIN (SELECT domain, CASE WHEN take - first > n - f THEN least(f, take - (n - f)) ELSE first END AS qf, least(take - first, n - f) AS qp FROM (
    SELECT *, {_QUOTA} FROM (SELECT domain, count(*) AS n, count(*) FILTER (WHERE review_required) AS f, greatest(floor(300 / count(*) OVER ()), 1) AS each FROM named GROUP BY domain))) q USING (domain)) WHERE rn <= quota""", "named AS (SELECT run_id || '/' || recname AS id, domain, review_required FROM prediction)"))(
    lambda r: queues.review_weighted_sample(r.raw("prediction").select(F.concat_ws("/", F.col("run_id").cast("string"), "recname").alias("id"), "domain", "review_required"), "domain", 300, review="review_required", key="id")
)
query("j20_reattached_ids", twin(" SELECT g.run_id, g.recname, g.predicted, r.id FROM gold g LEFT JOIN (SELECT recname, domain, min(run_id || ':' || table_name) AS id FROM prediction WHERE run_id > 2 GROUP BY ALL) r ON r.recname = g.recname AND r.domain IS NOT DISTINCT FROM g.predicted"))(
    lambda r: queues.reattached(
        r.raw("gold").select("run_id", "recname", "predicted"),
        r.raw("prediction").where("run_id > 2").select("recname", F.col("domain").alias("predicted"), F.concat_ws(":", F.col("run_id").cast("string"), "table_name").alias("id")), ("recname", "predicted"), "id")
)
query("j21_new_names", twin(" SELECT run_id, asset_id, technical_name FROM dim_asset WHERE technical_name NOT IN (SELECT recname FROM gold WHERE predicted = 'IT') AND technical_name NOT IN (SELECT recname FROM record_catalog WHERE recdescr IS NULL)"))(
    lambda r: queues.new_names(r.assets.select("run_id", "asset_id", "technical_name"), "technical_name", r.raw("gold").where("predicted = 'IT'").select(F.col("recname").alias("technical_name")), r.raw("record_catalog").where("recdescr is null").select(F.col("recname").alias("technical_name")))
)
query("j23_physical_objects", twin(" SELECT a.run_id, a.asset_id, t.owner AS object_owner, t.table_name AS object_table FROM dim_asset a LEFT JOIN table_catalog t ON t.run_id = a.run_id AND upper(t.table_name) = upper(trim(coalesce(a.source_ref, a.technical_name)))"))(
    lambda r: queues.physical_objects(r.assets.select("run_id", "asset_id", "source_ref", "technical_name"), r.raw("table_catalog")).select("run_id", "asset_id", "object_owner", "object_table")
)
query("j25_united_labels", twin(" SELECT asset_id, label, source_rank FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY source_rank, label) AS rn FROM (SELECT asset_id, label, CASE variant WHEN 'semantic_first' THEN 0 ELSE 1 END AS source_rank FROM votes WHERE label <> '')) WHERE rn = 1"))(
    lambda r: queues.united_labels(*[r.raw("votes").where(F.col("variant") == v).select("asset_id", "label") for v in ("semantic_first", "salient_first")])
)
query("j26_labelled_features", twin(" SELECT run_id, asset_id, field_count FROM dataset WHERE technical_name IN (SELECT recname FROM gold WHERE human_label = 'HR')"))(
    lambda r: r.dataset.join(r.raw("gold").where("human_label = 'HR'").select(F.col("recname").alias("technical_name")).distinct(), "technical_name", "left_semi").select("run_id", "asset_id", "field_count")
)

# Labels of other hands.
_RAW_LABEL = "concat(CASE WHEN o_orderkey % 6 = 0 THEN 'Ressources Humaines' WHEN o_orderkey % 6 = 1 THEN 'COMPTABILITÉ' WHEN o_orderkey % 6 = 2 THEN 'achats-groupe' WHEN o_orderkey % 6 = 3 THEN 'Rémunération' WHEN o_orderkey % 6 = 4 THEN 'Systèmes' ELSE 'autre' END, CASE WHEN o_orderkey % 5 = 0 THEN ' ' ELSE '' END)"
query("c26_a35_label_report", f"SELECT label, count(*) AS rows, label <> 'Inconnu' AS kept FROM (SELECT {taxonomy.normalised_label('label_raw', DUCKDB)} AS label FROM (SELECT {_RAW_LABEL} AS label_raw FROM orders)) GROUP BY label")(
    lambda r: taxonomy.label_report(r.table("orders").selectExpr(f"{_RAW_LABEL} AS label_raw"))
)
_CANDIDATES = {"run_id": 0, "recname": 0, "predicted": 0, "confidence": 0, "human_label": 1}
query("c25_label_column", twin(" UNION ALL".join(f" SELECT '{c}' AS \"column\", count({c}) AS filled, round({2 * hints} + count({c}) / count(*)::DOUBLE + CASE WHEN count(DISTINCT {c}) BETWEEN 2 AND 50 THEN 1 ELSE 0 END, 6) AS points FROM gold" for c, hints in _CANDIDATES.items())))(lambda r: taxonomy.label_column(r.raw("gold")))
ALIASES = (("finance", "Finance"), ("rh", "HR"), ("ressources humaines", "HR"), ("achats", "Procurement"), ("achats groupe", "Procurement"), ("comptabilite", "Finance"), ("groupe", "Other"))
PREFIXES, KNOWN = (("COLD", "Supply"), ("RED", "Sales")), (("BIG", "IT"),)
_NAMES = "CASE WHEN o_orderkey % 4 = 0 THEN 'COLD_X' WHEN o_orderkey % 4 = 1 THEN 'PS_BIG_Y' WHEN o_orderkey % 4 = 2 THEN 'OWN.RED_Z' ELSE 'OTHERS' END"
query("c27_remapped", f"""SELECT o_orderkey, coalesce(known, whole, inside, module) AS target, CASE WHEN known IS NOT NULL THEN 'known_module' WHEN whole IS NOT NULL THEN 'alias' WHEN inside IS NOT NULL THEN 'contains_alias' WHEN module IS NOT NULL THEN 'prefix' ELSE 'unresolved' END AS status
  FROM (SELECT o_orderkey, CASE n WHEN 'PS_BIG_Y' THEN 'IT' END AS known, CASE n WHEN 'COLD_X' THEN 'Supply' WHEN 'OWN.RED_Z' THEN 'Sales' END AS module, (SELECT target FROM aliases WHERE alias = f) AS whole,
         (SELECT arg_max(target, (length(alias), alias)) FROM aliases WHERE contains(f, alias)) AS inside
        FROM (SELECT o_orderkey, {_NAMES} AS n, {folded(_RAW_LABEL, DUCKDB)} AS f FROM orders), (SELECT 1))""".replace("aliases", _values(ALIASES, "alias, target")))(
    lambda r: taxonomy.remapped(
        r.table("orders").selectExpr("o_orderkey", f"{_NAMES} AS technical_name", f"{_RAW_LABEL} AS label_raw"), r.spark.createDataFrame(ALIASES, "alias string, target string"),
        r.spark.createDataFrame(PREFIXES, "prefix string, target string"), r.spark.createDataFrame(KNOWN, "prefix string, target string"),
    ).select("o_orderkey", "target", "status")
)
_HINT_TEXT = "lower(concat_ws(' ', technical_name, source_ref, column_names_text, column_type_signature_text, column_value_semantics_text))"
_HINT_LIST = "[" + ", ".join(f"{{'m': -({sql}), 'o': {k}, 'd': '{d}'}}" for k, (d, sql) in enumerate(taxonomy.hint_scores_sql("_text", ("technical_name", "source_ref"), DUCKDB).items())) + "]"
query("c28_metadata_hint", twin(f" SELECT run_id, asset_id, CASE WHEN sure THEN s[1].d END AS hint, CASE WHEN sure THEN 'top_score=' || (-s[1].m) END AS evidence FROM (SELECT *, -s[1].m >= 2 AND -s[1].m > -s[2].m AS sure FROM (SELECT *, list_sort({_HINT_LIST}) AS s FROM (SELECT *, {_HINT_TEXT} AS _text FROM dataset)))"))(
    lambda r: taxonomy.metadata_hint(r.texts)
)
_REPLY = "concat('Sure: ', CASE WHEN turn % 3 = 0 THEN concat('{\"business_domain\": \"', CASE WHEN conv_id % 2 = 0 THEN 'HR' ELSE 'Nonsense' END, '\", \"confidence\": ', conv_id % 30, '.5, \"reason\": \" seen ', conv_id, ' \"}') WHEN turn % 3 = 1 THEN concat('{\"business_domain\": \"IT\", \"confidence\": \"0.', conv_id % 10, '\"} thanks') ELSE 'no block' END)"
query("c29_repaired_replies", f"""SELECT conv_id, turn, CASE WHEN json_valid(j) AND trim(j ->> '$.business_domain') IN ('HR', 'IT') THEN trim(j ->> '$.business_domain') ELSE 'Other' END AS label,
  CASE WHEN json_valid(j) THEN least(greatest(coalesce(try_cast(j ->> '$.confidence' AS DOUBLE), 0), 0), 1) ELSE 0 END::DOUBLE AS confidence, CASE WHEN json_valid(j) THEN trim(coalesce(j ->> '$.reason', '')) ELSE '' END AS reason
  FROM (SELECT conv_id, turn, nullif(regexp_extract({_REPLY}, '(?s)(\\{{.*\\}})', 1), '') AS j FROM conversations WHERE role = 'assistant')""")(
    lambda r: r.table("conversations").where("role = 'assistant'").select("conv_id", "turn", taxonomy.repaired_reply(F.expr(_REPLY), ("HR", "IT")).alias("x")).select("conv_id", "turn", "x.*")
)
query("c30_to_annotate", twin(" SELECT recname FROM record_catalog WHERE run_id = 7 AND recname NOT IN (SELECT recname FROM gold WHERE run_id = 7 AND trim(human_label) <> '' AND human_label <> 'IT')"))(
    lambda r: taxonomy.to_annotate(r.raw("record_catalog").where("run_id = 7").select("recname"), r.raw("gold").where("run_id = 7").select("recname", F.col("human_label").alias("label")), "recname", legacy="IT")
)

query("a30_resolved_labels", twin(f""" SELECT o_orderkey AS asset_id, coalesce(label, module, 'Other') AS label, CASE WHEN label IS NOT NULL THEN 'votes' WHEN module IS NOT NULL THEN 'prefix' ELSE 'default' END AS source,
  CASE WHEN label IS NULL THEN true ELSE needs_adjudication OR coalesce(module <> label, false) END AS review
  FROM (SELECT o_orderkey, CASE {_NAMES} WHEN 'COLD_X' THEN 'Finance' WHEN 'OWN.RED_Z' THEN 'IT' END AS module FROM orders) LEFT JOIN consensus ON asset_id = o_orderkey""", CONSENSUS))(
    lambda r: labels.resolved_labels(
        r.table("orders").selectExpr("o_orderkey AS asset_id", f"{_NAMES} AS technical_name"), labels.vote_consensus(r.raw("votes"), VOTES), r.spark.createDataFrame([("COLD", "Finance"), ("RED", "IT")], "prefix string, target string")
    )
)

# Scores with terms and purges, parameters, maintenance.
_PURGES = "purges AS (SELECT md5('7|peoplesoft|' || p.recname) AS asset_id, 7 AS run_id, CAST(floor(e.value * 100) AS BIGINT) AS rows_affected FROM events e JOIN src_part p ON p.p_partkey = e.user_id WHERE e.event_type = 'error')"
_TERMS = "terms AS (SELECT md5(run_id || '|peoplesoft|' || recname) AS asset_id, run_id FROM (SELECT DISTINCT run_id, recname, fieldname FROM index_catalog))"


def _with_events(r: Run):
    events = r.table("events").where("event_type = 'error'").join(r.table("part"), F.col("user_id") == F.col("p_partkey"))
    name = F.upper(F.concat_ws("_", F.regexp_replace("p_name", " ", "_"), F.col("p_partkey").cast("string")))
    purges = events.select(F.lit(7).alias("run_id"), catalog.asset_key(F.lit(7), F.lit("peoplesoft"), name).alias("asset_id"), F.floor(F.col("value") * 100).alias("rows_affected"))
    terms = r.raw("index_catalog").select("run_id", "recname", "fieldname").distinct().select("run_id", catalog.asset_key(F.col("run_id"), F.lit("peoplesoft"), F.col("recname")).alias("asset_id"))
    return catalog.features_asset(r.assets, r.profile, r.lineage, terms, purges)


query("p24_p25_a5_scores_with_events", twin(""" SELECT run_id, asset_id, term_count, purge_event_count, total_purged_rows,
  round(least(coalesce(size_mb, 0) / 100, 30) + least(5 * purge_event_count, 25) + greatest(20 - 2 * lineage_out_count, 0) + greatest(25 - 3 * term_count, 0), 6) AS archival_candidate_score,
  round(least(coalesce(size_mb, 0) / 100, 40) + least(total_purged_rows / 100000::DOUBLE, 30) + greatest(30 - 2 * lineage_out_count, 0), 6) AS roi_score
  FROM (SELECT run_id, asset_id, size_mb, lineage_out_count, coalesce(t, 0) AS term_count, coalesce(e, 0) AS purge_event_count, CAST(coalesce(rows, 0) AS BIGINT) AS total_purged_rows FROM features
    LEFT JOIN (SELECT run_id, asset_id, count(*) AS t FROM terms GROUP BY ALL) USING (run_id, asset_id) LEFT JOIN (SELECT run_id, asset_id, count(*) AS e, sum(rows_affected) AS rows FROM purges GROUP BY ALL) USING (run_id, asset_id))""", _PURGES, _TERMS))(
    lambda r: _rounded(_with_events(r), "archival_candidate_score", "roi_score").select("run_id", "asset_id", "term_count", "purge_event_count", "total_purged_rows", "archival_candidate_score", "roi_score")
)
_PARAM_TABLE = "SELECT 'compression_ratio' AS param_name, round(avg(l_discount), 4) * 10 AS param_value FROM lineitem UNION ALL SELECT 'implementation_cost_one_shot', count(*) / 10.0E0 FROM orders"
query("a10_parameters", f"SELECT {', '.join(f'coalesce(max(param_value) FILTER (WHERE param_name = {chr(39)}{n}{chr(39)}), {v}::DOUBLE) AS {n}' for n, v in cost.PARAMS.items())} FROM ({_PARAM_TABLE})")(
    lambda r: cost.parameters(_param_table(r))
)


def _param_table(r: Run):
    ratio = r.table("lineitem").agg((F.round(F.avg("l_discount"), 4) * 10).alias("param_value")).select(F.lit("compression_ratio").alias("param_name"), "param_value")
    once = r.table("orders").agg((F.count("*") / 10.0).alias("param_value")).select(F.lit("implementation_cost_one_shot").alias("param_name"), "param_value")
    return ratio.unionByName(once)


_ONCE = _NET.replace(" AS k,", " + (SELECT count(*) / 10.0::DOUBLE FROM orders) AS k,")
query("x2_what_if_projection", twin(f""" SELECT y AS year_offset, round(median(v), 4) AS volume_no_action_gb, round(median(c), 2) AS cumul_cost_no_action_usd, round(median(k), 2) AS cumul_cost_with_archiving_usd,
  round(quantile_cont(c - k, 0.1), 2) AS net_savings_p10_usd, round(quantile_cont(c - k, 0.5), 2) AS net_savings_p50_usd, round(quantile_cont(c - k, 0.9), 2) AS net_savings_p90_usd, round(avg((c - k > 0)::INT), 3) AS breakeven_probability, count(*) AS n_scenarios
  FROM ({_ONCE} FROM (SELECT l_orderkey AS scenario_id, max(l_tax) * 3 AS g FROM lineitem GROUP BY l_orderkey) s
    CROSS JOIN (SELECT sum(total_size_gb) AS total, sum(archivable_size_gb) AS arch FROM costs) t CROSS JOIN (SELECT unnest(range(6)) AS y) WINDOW w AS (PARTITION BY scenario_id ORDER BY y ROWS UNBOUNDED PRECEDING)) GROUP BY y"""))(lambda r: cost.project_savings(r.table("lineitem").groupBy(F.col("l_orderkey").alias("scenario_id")).agg((F.max("l_tax") * 3).alias("growth")), r.costs.agg(F.sum("total_size_gb").alias("total"), F.sum("archivable_size_gb").alias("archivable")), cost.overridden(_param_table(r))))
query("x3_latest_projection", twin(" SELECT run_id, domain_label, total_size_gb FROM snapshots WHERE run_id = (SELECT max(run_id) FROM snapshots)"))(lambda r: cost.latest_projection(r.snapshots, "run_id").select("run_id", "domain_label", "total_size_gb"))
query("k14_cascaded_predictions", twin(" SELECT run_id, asset_id, domain FROM predictions WHERE (run_id, asset_id) IN (SELECT (run_id, asset_id) FROM dim_asset WHERE description IS NOT NULL)"))(
    lambda r: sinks.cascaded(r.predictions, r.assets.where("description is not null"), "run_id", "asset_id").select("run_id", "asset_id", "domain")
)
query("k11_run_ledger", twin(" SELECT run_id, CASE WHEN run_id % 3 = 0 THEN 'failed' WHEN run_id % 3 = 1 THEN 'success' ELSE 'running' END AS status, CASE WHEN run_id % 3 = 0 THEN 'x' END AS message FROM (SELECT DISTINCT run_id FROM runs)"))(
    lambda r: sinks.run_status(_ledger(r)).select("run_id", "status", "message")
)


def _ledger(r: Run):
    runs = r.raw("runs")
    opened = runs.select("run_id", F.lit("running").alias("status"), F.lit(1).alias("at"), F.lit(None).cast("string").alias("message"))
    closed = runs.where("run_id % 3 <> 2").select("run_id", F.when(F.col("run_id") % 3 == 0, "failed").otherwise("success").alias("status"), F.lit(2).alias("at"), F.when(F.col("run_id") % 3 == 0, "x").alias("message"))
    return opened.unionByName(closed)


query("k8_export_counts", twin(" SELECT 'costs' AS result, count(*) AS n FROM costs UNION ALL SELECT 'shared_keys', count(*) FROM shared UNION ALL SELECT 'snapshots', count(*) FROM snapshots"))(lambda r: labels.layer_counts(costs=r.costs, shared_keys=r.shared, snapshots=r.snapshots).withColumnRenamed("layer", "result"))


def export_sets(r: Run) -> dict[str, DataFrame]:
    """The result sets of the domain model's export, by name; `sinks.export_pack` or `versions.publish` writes them."""
    return {
        "domain_profile": queries_of_run("a7_domain_profile", r),
        "domain_dependencies": queries_of_run("a8_shared_keys", r),
        "archival_candidates": queries_of_run("w3_top_candidates", r),
        "archiving_policies": r.policies,
        "archiving_by_domain": queries_of_run("a9_policy_summary", r),
        "archiving_actions": archive.actionable(r.decisions),
        "cost_parameters": r.spark.createDataFrame(list(cost.PARAMS.items()), "param_name string, param_value double"),
        "cost_by_domain": queries_of_run("w5_w7_cost_shares", r),
        "year_on_year": queries_of_run("w4_j16_year_on_year", r),
        "savings_projection": queries_of_run("x1_savings_projection", r),
        "archiving_by_strategy": queries_of_run("a16_strategy_totals", r),
    }


_ACTIONS = twin(" SELECT run_id, asset_id, technical_name, recommended_strategy FROM decisions WHERE recommended_strategy IN ('ARCHIVAGE_FROID', 'ARCHIVAGE_CHIFFRE', 'COMPRESSION') ORDER BY size_mb DESC NULLS LAST, asset_id, run_id LIMIT 1000")
_SETS = {
    "domain_profile": "a7_domain_profile", "domain_dependencies": "a8_shared_keys", "archival_candidates": "w3_top_candidates", "archiving_by_domain": "a9_policy_summary", "cost_by_domain": "w5_w7_cost_shares",
    "year_on_year": "w4_j16_year_on_year", "savings_projection": "x1_savings_projection", "archiving_by_strategy": "a16_strategy_totals",
}
query("k8_archiving_actions", _ACTIONS)(lambda r: archive.actionable(r.decisions).select("run_id", "asset_id", "technical_name", "recommended_strategy"))
query(
    "k8_export_sets",
    " UNION ALL ".join([f"SELECT '{name}' AS result, count(*) AS n FROM ({oracle_sql()[q]})" for name, q in _SETS.items()] + [f"SELECT 'archiving_actions', count(*) FROM ({_ACTIONS})", f"SELECT 'archiving_policies', {len(archive.POLICIES)}", f"SELECT 'cost_parameters', {len(cost.PARAMS)}"]),
)(lambda r: labels.layer_counts(**export_sets(r)).withColumnRenamed("layer", "result"))
query("k13_missing_keys", twin(" SELECT count(*) FILTER (WHERE parentrecname IS NULL) AS parentrecname, count(*) FILTER (WHERE recname IS NULL) AS recname FROM record_catalog"))(lambda r: labels.missing_values(r.raw("record_catalog"), "recname", "parentrecname"))
query("a34_salient_columns", twin(""" SELECT run_id, asset_id, string_agg(c, ', ' ORDER BY points DESC, c) AS salient FROM (SELECT *, row_number() OVER (PARTITION BY run_id, asset_id ORDER BY points DESC, c) AS rn FROM (
    SELECT run_id, asset_id, technical_name AS c, sum(CASE data_type WHEN 'NUMBER' THEN 3 ELSE 1 END) AS points FROM dim_field GROUP BY ALL)) WHERE rn <= 3 GROUP BY run_id, asset_id"""))(
    lambda r: profiling.salient_columns(r.fields, {"NUMBER": 3}, top=3)
)

_LIST = "[" + ", ".join(f"'{w}'" for w in salience.COMMON_WORDS) + "]"
_SHORT = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in salience.SHORT_WORDS.items()) + "}"
_POINTS = "MAP {" + ", ".join(f"'{k}': {v}::DOUBLE" for k, v in salience.SEMANTIC_POINTS.items()) + "}"
_SIGNALS = f"""fields AS (SELECT run_id, asset_id, technical_name AS name, max(data_type) AS data_type FROM dim_field WHERE technical_name <> '' GROUP BY ALL),
  named AS (SELECT *, {semantics_sql("name", "data_type")} AS semantic, list_filter(string_split_regex(lower(regexp_replace(name, '([a-z])([A-Z])', '\\1_\\2', 'g')), '[^a-z0-9]+'), lambda w: w <> '') AS words FROM fields),
  signals AS (SELECT run_id, asset_id, name, data_type, semantic, round(coalesce({_POINTS}[semantic], 0.8) + 0.45::DOUBLE * least(4, len(list_distinct(list_filter(list_concat(words, list_transform(words, lambda w: {_SHORT}[w])), lambda w: w IS NOT NULL AND length(w) > 1 AND NOT list_contains({_LIST}, w)))))
    + CASE WHEN upper(data_type) LIKE 'DATE%' OR upper(data_type) LIKE 'TIMESTAMP%' THEN 0.4 WHEN upper(data_type) LIKE '%CLOB%' OR upper(data_type) LIKE '%TEXT%' THEN 0.5 WHEN upper(data_type) LIKE '%NUMBER%' OR upper(data_type) LIKE '%DECIMAL%' THEN 0.3 ELSE 0 END::DOUBLE
    - CASE WHEN upper(name) IN ('PROCESS_INSTANCE', 'LANGUAGE_CD', 'SETID', 'ROW_ADDED_DTTM', 'ROW_LASTMANT_DTTM') THEN 0.6 ELSE 0 END::DOUBLE, 3) AS signal FROM named)"""
query("a34_column_signals", twin(" SELECT run_id, asset_id, name, semantic, signal FROM signals", _SIGNALS))(lambda r: salience.asset_columns(r.fields).select("run_id", "asset_id", "name", "semantic", "signal"))
query("a34_asset_context", twin(""", best AS (SELECT run_id, asset_id, string_agg(name, ', ' ORDER BY signal DESC, name) AS salient FROM (SELECT * FROM signals QUALIFY row_number() OVER (PARTITION BY run_id, asset_id ORDER BY signal DESC, name) <= 24) GROUP BY ALL),
  kinds AS (SELECT run_id, asset_id, 's' AS k, semantic AS v FROM signals UNION ALL SELECT run_id, asset_id, 't', string_split(upper(data_type), '(')[1] FROM signals),
  counted AS (SELECT *, row_number() OVER (PARTITION BY run_id, asset_id, k ORDER BY n DESC, v) AS rn FROM (SELECT run_id, asset_id, k, v, count(*) AS n FROM kinds WHERE v <> '' GROUP BY ALL)),
  packed AS (SELECT run_id, asset_id, k, string_agg(v || ':' || n, ', ' ORDER BY rn) AS p FROM counted WHERE rn <= CASE k WHEN 's' THEN 12 ELSE 8 END GROUP BY ALL)
  SELECT b.*, s.p AS semantic_profile, t.p AS type_profile FROM best b LEFT JOIN packed s ON s.run_id = b.run_id AND s.asset_id = b.asset_id AND s.k = 's' LEFT JOIN packed t ON t.run_id = b.run_id AND t.asset_id = b.asset_id AND t.k = 't'""", _SIGNALS))(
    lambda r: salience.asset_context(salience.asset_columns(r.fields)).withColumns({c: F.array_join(c, ", ") for c in ("salient", "semantic_profile", "type_profile")})
)

# Statistics.
query("a39_kruskal_wallis", """WITH r AS (SELECT l_returnflag AS g, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2::DOUBLE AS k, l_quantity AS v FROM lineitem),
  h AS (SELECT (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - (SELECT sum(t * t * t - t) FROM (SELECT count(*)::DOUBLE AS t FROM r GROUP BY v)) / (n * n * n - n)) AS h, n, groups FROM (SELECT sum(n)::DOUBLE AS n, count(*) AS groups, sum(k * k / n) AS s FROM (SELECT g, count(*) AS n, sum(k) AS k FROM r GROUP BY g)))
  SELECT round(h, 5) AS h, groups, round(h / (n - 1), 8) AS epsilon_squared FROM h""")(lambda r: _rounded(ranks.kruskal_wallis(r.table("lineitem"), "l_returnflag", "l_quantity").withColumn("epsilon_squared", F.round("epsilon_squared", 8)), "h", digits=5))
query("a39_spearman", "SELECT round(corr(x, y), 8) AS rho, count(*) AS n FROM (SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2::DOUBLE AS x, rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2::DOUBLE AS y FROM lineitem)")(
    lambda r: _rounded(ranks.spearman(r.table("lineitem"), "l_quantity", "l_extendedprice"), "rho", digits=8)
)
query("a39_chi_square", """WITH c AS (SELECT l_returnflag AS a, l_linestatus AS b, count(*) AS n FROM lineitem GROUP BY ALL), t AS (SELECT x.a, y.b, x.n * y.n / (SELECT sum(n) FROM c)::DOUBLE AS e FROM (SELECT a, sum(n)::DOUBLE AS n FROM c GROUP BY a) x CROSS JOIN (SELECT b, sum(n)::DOUBLE AS n FROM c GROUP BY b) y),
  s AS (SELECT sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e) AS chi2, count(DISTINCT t.a) AS r, count(DISTINCT t.b) AS k FROM t LEFT JOIN c ON c.a = t.a AND c.b = t.b)
  SELECT round(chi2, 5) AS chi2, (r - 1) * (k - 1) AS dof, round(sqrt(chi2 / ((SELECT sum(n) FROM c) * least(r - 1, k - 1))), 8) AS cramers_v FROM s""")(lambda r: _rounded(ranks.chi_square(r.table("lineitem"), "l_returnflag", "l_linestatus").withColumn("cramers_v", F.round("cramers_v", 8)), "chi2", digits=5))
query("a39_mann_whitney", "SELECT u, n1, n2, round(2 * u / (n1 * n2) - 1, 8) AS rank_biserial FROM (SELECT sum(k) FILTER (WHERE f) - count(*) FILTER (WHERE f) * (count(*) FILTER (WHERE f) + 1) / 2::DOUBLE AS u, count(*) FILTER (WHERE f) AS n1, count(*) FILTER (WHERE NOT f) AS n2 FROM (SELECT l_linestatus = 'F' AS f, rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2::DOUBLE AS k FROM lineitem))")(
    lambda r: ranks.mann_whitney(r.table("lineitem"), "l_quantity", F.col("l_linestatus") == "F").withColumn("rank_biserial", F.round("rank_biserial", 8))
)


def _simpson(density: str, low: str, width: float, panels: int = 20_000) -> str:
    """SQL of an integral by Simpson's rule: a tail, by another way than the library's."""
    at = f"({low} + i * {width / panels}::DOUBLE)"
    return f"(SELECT sum({density.replace('@', at)} * CASE WHEN i IN (0, {panels}) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * {width / panels / 3}::DOUBLE FROM range(0, {panels + 1}) AS g(i))"


_CHI2 = "exp(({dof} / 2::DOUBLE - 1) * ln(@) - @ / 2 - {dof} / 2::DOUBLE * ln(2::DOUBLE) - lgamma({dof} / 2::DOUBLE))"
_NORMAL = "exp(-@ * @ / 2) / sqrt(2 * pi())"
_STUDENT = "exp(lgamma(({dof} + 1) / 2::DOUBLE) - lgamma({dof} / 2::DOUBLE) - ({dof} + 1) / 2::DOUBLE * ln(1 + @ * @ / {dof})) / sqrt({dof} * pi())"
_SAMPLE = "sample AS (SELECT p_partkey, p_size::DOUBLE AS size, p_retailprice AS price, p_brand AS brand, p_type AS kind FROM part)"
_RANK = "rank() OVER (ORDER BY {0}) + (count(*) OVER (PARTITION BY {0}) - 1) / 2::DOUBLE"
query("a39_p_values", f"""WITH {_SAMPLE},
  kw0 AS (SELECT brand, {_RANK.format("size")} AS k, size FROM sample),
  kw AS (SELECT (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - (SELECT sum(t * t * t - t) FROM (SELECT count(*)::DOUBLE AS t FROM kw0 GROUP BY size)) / (n * n * n - n)) AS x, g - 1 AS dof
         FROM (SELECT sum(n)::DOUBLE AS n, count(*) AS g, sum(k * k / n) AS s FROM (SELECT brand, count(*) AS n, sum(k) AS k FROM kw0 GROUP BY brand))),
  cs0 AS (SELECT kind, brand, count(*) AS n FROM sample GROUP BY ALL),
  cs AS (SELECT sum((coalesce(n, 0) - e) * (coalesce(n, 0) - e) / e) AS x, (count(DISTINCT kind) - 1) * (count(DISTINCT brand) - 1) AS dof FROM (
         SELECT a.kind, b.brand, a.n * b.n / (SELECT sum(n) FROM cs0)::DOUBLE AS e FROM (SELECT kind, sum(n)::DOUBLE AS n FROM cs0 GROUP BY kind) a CROSS JOIN (SELECT brand, sum(n)::DOUBLE AS n FROM cs0 GROUP BY brand) b) LEFT JOIN cs0 USING (kind, brand)),
  sp0 AS (SELECT corr(a, b) AS x, count(*) - 2 AS dof FROM (SELECT {_RANK.format("size")} AS a, {_RANK.format("price")} AS b FROM sample)),
  sp AS (SELECT x, dof, abs(x) * sqrt(dof / (1 - x * x)) AS t FROM sp0),
  mw0 AS (SELECT {_RANK.format("size")} AS k, kind = 'ECONOMY' AS f, size FROM sample),
  mw1 AS (SELECT count(*) FILTER (WHERE f)::DOUBLE AS a, count(*) FILTER (WHERE NOT f)::DOUBLE AS b, sum(k) FILTER (WHERE f) AS k FROM mw0),
  mw AS (SELECT k - a * (a + 1) / 2 AS x, (abs(k - a * (a + 1) / 2 - a * b / 2) - 0.5::DOUBLE) / sqrt(a * b / 12 * (a + b + 1 - (SELECT sum(t * t * t - t) FROM (SELECT count(*)::DOUBLE AS t FROM mw0 GROUP BY size)) / ((a + b) * (a + b - 1)))) AS z FROM mw1)
  SELECT 'kruskal_wallis' AS test, round(x, 6) AS statistic, round({_simpson(_CHI2.format(dof="dof"), "x", 400.0)}, 8) AS p FROM kw UNION ALL
  SELECT 'chi_square', round(x, 6), round({_simpson(_CHI2.format(dof="dof"), "x", 400.0)}, 8) FROM cs UNION ALL
  SELECT 'spearman', round(x, 6), round(2 * {_simpson(_STUDENT.format(dof="dof"), "t", 60.0)}, 8) FROM sp UNION ALL
  SELECT 'mann_whitney', round(x, 6), round(least(1, 2 * {_simpson(_NORMAL, "z", 60.0)}), 8) FROM mw""")(
    lambda r: _rounded(_rounded(_p_values(r), "statistic"), "p", digits=8)
)


def _p_values(r: Run):
    own = r.table("part").selectExpr("cast(p_size as double) as size", "p_retailprice as price", "p_brand as brand", "p_type as kind")
    tests = {"kruskal_wallis": ranks.kruskal_wallis_p(own, "brand", "size"), "chi_square": ranks.chi_square_p(own, "kind", "brand"), "spearman": ranks.spearman_p(own, "size", "price"), "mann_whitney": ranks.mann_whitney_p(own, "size", F.col("kind") == "ECONOMY")}
    out = None
    for name, one in tests.items():
        named = one.select(F.lit(name).alias("test"), "statistic", "p")
        out = named if out is None else out.unionByName(named)
    return out
