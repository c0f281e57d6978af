"""Queries of the classifier's training, scoring and comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.functions.text import DUCKDB, composed
from lodestead.operators import compare, decompose, evaluate, features, labels, linear, training
from lodestead.plans.catalogue import Run, query
from lodestead.plans.labelling import CLASSES, CONFUSION, CONSENSUS, SCORED, VOTES, _rounded, _scored
from lodestead.plans.twins import twin
from lodestead.sources.shared import written


def _with_id(r: Run, table: DataFrame | None = None):
    return (r.dataset if table is None else table).withColumn("id", F.concat_ws("/", F.col("run_id").cast("string"), "asset_id"))


_TEXT = composed(("technical_name", "source_ref"), DUCKDB)
_CHARS = f"""grams AS (SELECT id, substr(p, i, n) AS token FROM (SELECT id, p, n, unnest(range(1, length(p) - n + 2)) AS i FROM (SELECT id, p, unnest(range(3, least(5, length(p)) + 1)) AS n FROM (
  SELECT id, ' ' || w || ' ' AS p FROM (SELECT run_id || '/' || asset_id AS id, unnest(string_split({_TEXT}, ' ')) AS w FROM dataset) WHERE w <> ''))))"""
_WORDS = f"""grams AS (SELECT id, array_to_string(ws[i:i + n - 1], ' ') AS token FROM (SELECT id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM (SELECT id, ws, unnest([1, 2]) AS n FROM (
  SELECT run_id || '/' || asset_id AS id, list_filter(regexp_extract_all({composed(features.TEXTS, DUCKDB)}, '\\w\\w+'), lambda w: w NOT IN ({', '.join(f"'{w}'" for w in training.STOP_WORDS)})) AS ws FROM dataset))))"""
_VOCABULARY = " SELECT token, df, round(ln((1 + (SELECT count(DISTINCT id) FROM grams)) / (1 + df)::DOUBLE) + 1, 8) AS idf, row_number() OVER (ORDER BY token) - 1 AS at FROM (SELECT token, count(*) AS df, sum(tf) AS total FROM (SELECT id, token, count(*) AS tf FROM grams GROUP BY ALL) GROUP BY token HAVING count(*) >= 3 ORDER BY total DESC, token LIMIT {})"
query("c7_char_vocabulary", twin(_VOCABULARY.format(50_000), _CHARS))(lambda r: training.text_vocabulary(_with_id(r, r.assets), "char", most=50_000).withColumn("idf", F.round("idf", 8)))
query("c8_word_vocabulary", twin(_VOCABULARY.format(80_000), _WORDS))(lambda r: training.text_vocabulary(_with_id(r, r.texts), "word", most=training.MOST_WORDS).withColumn("idf", F.round("idf", 8)))
_HELPED = ", ".join(f"{sql} AS {n}" for n, sql in features.helper_columns(DUCKDB).items())
_FEATURES = ", ".join(f"{sql} AS {n}" for n, sql in features.numeric_features(DUCKDB).items())
query("c9_feature_scales", twin(f" SELECT name, round(CASE WHEN stddev_pop(value) > 1e-9 THEN stddev_pop(value) ELSE 1 END, 6) AS scale FROM (UNPIVOT (SELECT {_FEATURES} FROM (SELECT {_HELPED} FROM dataset)) ON COLUMNS(*) INTO NAME name VALUE value) GROUP BY name"))(
    lambda r: _rounded(training.feature_scales(_with_id(r)), "scale")
)


def _labelled(r: Run):
    human = r.raw("votes").where("vote_no = 7 and label <> ''").select(F.col("asset_id").alias("id"), "label")
    return training.gold_labels(labels.vote_consensus(r.raw("votes"), VOTES).withColumnRenamed("asset_id", "id"), human)


_LABELLED = """human AS (SELECT asset_id AS id, min(label) AS label, 10.0::DOUBLE AS weight FROM votes WHERE vote_no = 7 AND label <> '' GROUP BY asset_id),
  labelled AS (SELECT asset_id AS id, label, consensus::DOUBLE AS weight FROM consensus WHERE consensus >= 0.7 AND asset_id NOT IN (SELECT id FROM human) UNION ALL SELECT * FROM human)"""
query("c14_c15_training_split", twin(" SELECT id, label, round(weight, 6) AS weight, row_number() OVER (PARTITION BY label ORDER BY md5(CAST(id AS VARCHAR)), id) <= round(count(*) OVER (PARTITION BY label)::DOUBLE * 0.15::DOUBLE) OR id % 1000 = 5 AS held_out FROM labelled", CONSENSUS, _LABELLED))(
    lambda r: _rounded(training.split_held_out(_labelled(r), fixed=r.table("orders").where("o_orderkey % 1000 = 5").select(F.col("o_orderkey").alias("id"))), "weight")
)
query("c19_class_auc", """WITH s AS (SELECT vec_id, 'class_' || label AS label, 'class_' || (i - 1) AS class, v::DOUBLE AS score FROM (SELECT vec_id, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)),
  k AS (SELECT *, rank() OVER (PARTITION BY class ORDER BY score) + (count(*) OVER (PARTITION BY class, score) - 1) / 2::DOUBLE AS k FROM s)
  SELECT class, round((sum(k) FILTER (WHERE label = class) - n1 * (n1 + 1) / 2::DOUBLE) / nullif(n1 * (n - n1), 0), 8) AS auc FROM (SELECT *, count(*) FILTER (WHERE label = class) OVER (PARTITION BY class) AS n1, count(*) OVER (PARTITION BY class) AS n FROM k) GROUP BY class, n1, n""")(
    lambda r: _rounded(training.class_auc(_class_scores(r)), "auc", digits=8)
)


def _class_scores(r: Run):
    """The values of an embedding stand for the scores of as many classes."""
    long = r.table("embeddings").select("vec_id", "label", F.posexplode("embedding").alias("at", "score"))
    return long.select("vec_id", F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label"), F.concat(F.lit("class_"), F.col("at").cast("string")).alias("class"), F.col("score").cast("double").alias("score"))


_CURVE = """s AS (SELECT 'class_' || label AS label, 'class_' || (i - 1) AS class, v::DOUBLE AS score FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings)),
  c AS (SELECT class, score, count(*) FILTER (WHERE label = class) AS p, count(*) FILTER (WHERE label <> class) AS n FROM s GROUP BY ALL),
  k AS (SELECT class, score AS threshold, sum(p) OVER w / sum(p) OVER (PARTITION BY class)::DOUBLE AS tpr, sum(n) OVER w / sum(n) OVER (PARTITION BY class)::DOUBLE AS fpr, p / sum(p) OVER (PARTITION BY class)::DOUBLE AS dp, n / sum(n) OVER (PARTITION BY class)::DOUBLE AS dn
    FROM c WINDOW w AS (PARTITION BY class ORDER BY score DESC) QUALIFY sum(p) OVER (PARTITION BY class) > 0 AND sum(n) OVER (PARTITION BY class) > 0)"""
query("c19_roc_points", f"WITH {_CURVE} SELECT class, round(threshold, 8) AS threshold, round(tpr, 8) AS tpr, round(fpr, 8) AS fpr FROM k")(
    lambda r: _rounded(evaluate.roc_points(_class_scores(r)).select("class", "threshold", "tpr", "fpr"), "threshold", "tpr", "fpr", digits=8)
)
query("c19_roc_areas", f"WITH {_CURVE}, a AS (SELECT class, sum(dn * (tpr - dp / 2)) AS auc FROM k GROUP BY class) SELECT class, round(auc, 8) AS auc FROM (SELECT * FROM a UNION ALL SELECT 'macro', avg(auc) FROM a)")(
    lambda r: _rounded(evaluate.roc_areas(evaluate.roc_points(_class_scores(r))), "auc", digits=8)
)
query("c19_macro_curve", f"""WITH {_CURVE}, g AS (SELECT class, pt, max(tpr - dp + CASE WHEN dn > 0 THEN (pt / 100::DOUBLE - fpr + dn) / dn ELSE 1 END * dp) AS tpr
  FROM (SELECT *, unnest(range(ceil(round((fpr - dn) * 100, 9))::BIGINT, floor(round(fpr * 100, 9))::BIGINT + 1)) AS pt FROM k) GROUP BY ALL) SELECT round(pt / 100::DOUBLE, 8) AS fpr, round(avg(tpr), 6) AS tpr FROM g GROUP BY pt""")(
    lambda r: _rounded(_rounded(evaluate.macro_curve(evaluate.roc_points(_class_scores(r))), "fpr", digits=8), "tpr", digits=6)
)


def _svd(r: Run):
    """The word block of all assets, as a decomposition needs it: no labels, and every row."""
    words = written(training.text_vocabulary(_with_id(r), "word", most=training.MOST_WORDS), "words")
    rows = training.text_entries(training._grams(_with_id(r), "word"), words).select("id", F.col("at").cast("int").alias("index"), "value")
    return decompose.truncated_svd(rows, words.count(), 12)


query("c20_singular_values")(lambda r: _rounded(_svd(r).values, "value", digits=5))
query("c20_text_coordinates")(lambda r: _svd(r).scores.withColumn("coordinates", F.transform("coordinates", lambda x: F.round(x, 4))))
_OVERALL = "(SELECT sum(hit) / sum(support) AS accuracy, avg(f1) AS macro_f1 FROM classes)"
_OTHER = """other AS (SELECT label, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1, hit, support FROM (SELECT coalesce(a.label, b.label) AS label, coalesce(hit, 0) AS hit, coalesce(support, 0) AS support, CASE WHEN coalesce(made, 0) > 0 THEN coalesce(hit, 0) / made ELSE 0 END AS p, CASE WHEN coalesce(support, 0) > 0 THEN coalesce(hit, 0) / support ELSE 0 END AS r
  FROM (SELECT human_label AS label, count(*)::DOUBLE AS support, count(*) FILTER (WHERE human_label = 'Finance')::DOUBLE AS hit FROM scored GROUP BY 1) a FULL JOIN (SELECT 'Finance' AS label, count(*)::DOUBLE AS made FROM scored) b ON a.label = b.label))"""
query("c23_new_against_baseline", twin(f" SELECT round(n.accuracy, 6) AS new_accuracy, round(o.accuracy, 6) AS baseline_accuracy, round(n.macro_f1 - o.macro_f1, 6) AS macro_f1_gain FROM {_OVERALL} n CROSS JOIN (SELECT sum(hit) / sum(support) AS accuracy, avg(f1) AS macro_f1 FROM other) o", SCORED, CONFUSION, CLASSES, _OTHER))(
    lambda r: evaluate.compared(evaluate.overall_scores(evaluate.confusion(_scored(r))), evaluate.overall_scores(evaluate.confusion(_scored(r).withColumn("predicted", F.lit("Finance")))))
)


def _gold(r: Run):
    """Records with their human labels, which are not empty; a digest of the id holds out a share of every class."""
    records = _with_id(r).where("asset_type = 'ps_record'").select("run_id", "technical_name", "id")
    named = r.raw("gold").where("human_label <> ''").select("run_id", F.col("recname").alias("technical_name"), F.col("human_label").alias("label"))
    return training.split_held_out(records.join(named, ["run_id", "technical_name"]).select("id", "label", F.lit(1.0).alias("weight")))


def _model(r: Run) -> tuple[training.DomainModel, DataFrame]:
    """The trained model of a session's input and the split, fitted once for all queries that use it."""
    key = (r.spark.sparkContext.applicationId, r._stamp)
    if key not in _MODELS:
        split = written(_gold(r), "split")
        _MODELS[key] = training.train_domain_model(_with_id(r), split.where("not held_out").drop("held_out"), settled=3e-3), split
    return _MODELS[key]


_MODELS: dict[tuple[str, str], tuple[training.DomainModel, DataFrame]] = {}
query("c10_svm_objectives")(lambda r: _model(r)[0].objective.withColumn("objective", F.round("objective", 0)))
query("c11_calibration")(lambda r: _rounded(_model(r)[0].calibration, "a", "b", digits=4))
query("a38_block_importance")(lambda r: _rounded(training.block_importance(_model(r)[0]), "importance", digits=4))


#: The lists of terms by the labels of the gold set.
GOLD_NAMES = {"finance": "Finance", "hr": "HR", "it": "IT", "procurement": "Procurement", "sales": "Sales", "marketing": "Sales", "risk": "Finance", "supply_chain": "Supply"}
def _scored_assets(r: Run):
    """Every asset with its two-pass score, and whether the model has seen its label, was kept from it, or there is none."""
    return r._once("scored_assets", lambda: _two_passes(r), by_run=False)


def _two_passes(r: Run) -> DataFrame:
    model, split = _model(r)
    seen = split.select("id", F.when(F.col("held_out"), "held_out").otherwise("training").alias("label_use"))
    scores = training.two_pass_scores(_with_id(r), model, labels=GOLD_NAMES).join(seen, "id", "left")
    return scores.withColumns({"label_use": F.coalesce("label_use", F.lit("none")), "confidence": F.round("confidence", 4)})


query("c13_two_pass_scores")(_scored_assets)
query("c13_held_out_confusion")(
    lambda r: _scored_assets(r).where("label_use = 'held_out'").join(_model(r)[1].select("id", "label"), "id").groupBy("label", F.col("domain").alias("predicted"), F.col("model_version").startswith("keyword").alias("by_terms")).agg(F.count("*").alias("n"))
)
USES = {"all": training.USE, "no_text": ("number", "category"), "no_numbers": ("char", "word", "category"), "text": ("char", "word"), "numbers": ("number",)}
query("c17_ablation")(lambda r: training.ablation(_with_id(r), _gold(r).drop("held_out"), USES, settled=1e-2))
query("c18_learning_curve")(lambda r: training.learning_curve(_with_id(r), _gold(r).drop("held_out"), (0.1, 0.3, 1.0), settled=1e-2))


#: Candidates of each learner in the comparison.
DRAWS = {"svm": 2, "forest": 2, "naive_bayes": 2, "logistic": 1}


def _comparison(r: Run):
    labelled = written(_gold(r).drop("held_out"), "labelled")
    known = written(training.with_numbers(_with_id(r).join(labelled.select("id"), "id", "left_semi")), "known")
    blocks = training.fit_blocks(known)
    return compare.compared(linear.unpacked(written(training.packed_entries(known, blocks), "entries")), blocks.offsets[2:4], labelled, blocks.offsets[-1], compare.drawn(DRAWS))


query("c16_model_comparison")(lambda r: _rounded(compare.ranked(_comparison(r)), "accuracy", "macro_f1", digits=3))


def _baseline(r: Run):
    quality = r.table("labels").groupBy("doc_id").agg(F.max("quality").cast("string").alias("label"))
    docs = r.table("documents").dropDuplicates(["doc_id"]).join(quality, "doc_id", "left")
    return training.text_baseline(docs.select(F.col("doc_id").alias("id"), "text", "label", "n_chars"), numbers=("n_chars",))


query("c21_text_baseline")(_baseline)
