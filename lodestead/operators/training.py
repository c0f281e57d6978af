"""Training and applying the domain classifier: TF-IDF blocks, linear SVM, calibration, two-pass scoring.

A feature matrix is a table of entries ``(id, index, value)``; what a block needs - a
vocabulary, scales, classes - is a table as well.  Models are fitted by `linear` and applied
as a join of entries with coefficients.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lodestead.functions.ranks import average_ranks
from lodestead.functions.text import SPARK, composed
from lodestead.operators import features, linear
from lodestead.operators.archive import confidence_band
from lodestead.operators.classify import TERM_LABELS, keyword_domain
from lodestead.operators.evaluate import review_flags
from lodestead.operators.labels import first_of_strata
from lodestead.sources.shared import written

#: Sizes of the text blocks, and words that tell nothing.
CHAR_GRAMS, WORD_GRAMS, MIN_DF, MOST_CHARS, MOST_WORDS = (3, 5), (1, 2), 3, 50_000, 80_000
STOP_WORDS = ("varchar2", "number", "date", "timestamp", "clob", "blob", "long", "char", "raw", "xmltype", "float", "integer", "nvarchar2", "nclob", "sysadm", "ps")
#: Consensus that makes a label gold, weight of a person's label, held-out share.
GOLD_FLOOR, HUMAN_WEIGHT, HELD_OUT = 0.7, 10.0, 0.15
CATEGORIES = ("source_system", "asset_type")
USE = ("char", "word", "number", "category")
#: A deviation below this is that of a constant feature.
LEAST_SPREAD = 1e-9


def char_grams(text: Column, low: int = CHAR_GRAMS[0], high: int = CHAR_GRAMS[1]) -> Column:
    """Grams of ``low`` to ``high`` characters of each word with a space on both sides; a shorter word counts once."""
    words = F.filter(F.split(text, " +"), lambda w: w != "")

    def of_word(w: Column) -> Column:
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        n = F.length(padded)
        sizes = F.sequence(F.lit(low), F.least(F.lit(high), n))
        return F.flatten(F.transform(sizes, lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(padded, i, k))))

    return F.flatten(F.transform(words, of_word))


def word_grams(text: Column, high: int = WORD_GRAMS[1], stop: tuple[str, ...] = STOP_WORDS) -> Column:
    """Words of two characters and more that are no stop words, and runs of up to ``high`` of them."""
    words = F.filter(F.regexp_extract_all(text, F.lit(r"\w\w+"), F.lit(0)), lambda w: ~w.isin(*stop))

    def runs_of(ws: Column, n: int) -> Column:
        # A lambda of one parameter: a second one would be the element's place.
        return F.when(F.size(ws) >= n, F.transform(F.sequence(F.lit(1), F.size(ws) - n + 1), lambda i: F.array_join(F.slice(ws, i, n), " "))).otherwise(F.array().cast("array<string>"))

    def runs(ws: Column) -> Column:
        return F.flatten(F.array(*[runs_of(ws, n) for n in range(1, high + 1)]))

    return F.transform(F.array(words), runs)[0]


def vocabulary(grams: DataFrame, *, min_df: int = MIN_DF, most: int = MOST_CHARS) -> DataFrame:
    """``(token, df, idf, at)`` of ``grams(id, token)``: tokens of at least ``min_df`` rows, the ``most`` frequent of them.

    ``idf`` is ``ln((1 + n) / (1 + df)) + 1`` over the n rows that have any token; ``at``
    numbers the tokens in their order.  At most ``most`` rows are numbered in one place.
    """
    counts = grams.groupBy("id", "token").agg(F.count("*").alias("tf"))
    own = counts.groupBy("token").agg(F.count("*").alias("df"), F.sum("tf").alias("total")).where(F.col("df") >= min_df)
    return _most_frequent(own, grams.agg(F.countDistinct("id").alias("n")), most)


def _most_frequent(counts: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    top = counts.orderBy(F.desc("total"), "token").limit(most).crossJoin(F.broadcast(rows))
    return top.select("token", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"), (F.row_number().over(Window.orderBy("token")) - 1).alias("at"))


def text_vocabulary(assets: DataFrame, kind: str, *, min_df: int = MIN_DF, most: int = MOST_CHARS) -> DataFrame:
    """The `vocabulary` of the texts of ``assets(id, ...)``: what is moved is a text once and then tokens, never a token for each row.

    Rows of one id are one text; equal texts, such as names that many runs have, are cut up once.
    """
    texts = assets.select("id", _text(kind).alias("text")).groupBy("id").agg(F.sort_array(F.collect_list("text")).alias("texts")).groupBy("texts").agg(F.count("*").alias("n"))
    cut = texts.select("n", F.flatten(F.transform("texts", lambda t: GRAMS[kind](t))).alias("grams"))
    n, none = F.col("n"), F.lit(0).cast("long")
    each = F.transform("grams", lambda t: F.struct(t.alias("token"), n.alias("total"), none.alias("df")))
    once = F.transform(F.array_distinct("grams"), lambda t: F.struct(t.alias("token"), none.alias("total"), n.alias("df")))
    counts = cut.select(F.inline(F.concat(each, once))).groupBy("token").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))
    return _most_frequent(counts.where(F.col("df") >= min_df), cut.where(F.size("grams") > 0).agg(F.coalesce(F.sum("n"), none).alias("n")), most)


def text_entries(grams: DataFrame, words: DataFrame) -> DataFrame:
    """``(id, at, value)``: ``(1 + ln tf) * idf`` of each known token, scaled so that a row's squares sum to 1.

    The vocabulary, whose size is a parameter, goes to the tokens; those of a row are brought together once, for their
    counts and their norm.
    """
    known = grams.join(F.broadcast(words.select("token", "idf", "at")), "token").select("id", "at", "idf")
    weights = known.repartition("id").groupBy("id", "at").agg(((1 + F.log(F.count("*"))) * F.first("idf")).alias("value"))
    norm = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("id")))
    return weights.select("id", "at", (F.col("value") / norm).alias("value"))


@dataclass
class Blocks:
    """What the feature blocks learned from training rows; each block starts at its offset."""

    chars: DataFrame
    words: DataFrame
    scales: DataFrame
    classes: DataFrame
    offsets: tuple[int, int, int, int, int]


#: How the text of a block is cut.
GRAMS = {"char": char_grams, "word": word_grams}


def _text(kind: str) -> Column:
    return F.expr(composed(("technical_name", "source_ref") if kind == "char" else features.TEXTS, SPARK))


def _grams(assets: DataFrame, kind: str) -> DataFrame:
    return assets.select("id", F.explode(GRAMS[kind](_text(kind))).alias("token"))


def with_numbers(assets: DataFrame) -> DataFrame:
    """``assets`` with ``numbers``, the numeric features in their order; worked out once where scales and entries are both read from it."""
    if "numbers" in assets.columns:
        return assets
    first, second, numbers = features.numeric_array()
    return assets.withColumns(first).withColumns(second).withColumn("numbers", numbers).drop(*first, *second)


def feature_scales(assets: DataFrame) -> DataFrame:
    """``(name, scale)``: the deviation of each feature over all assets, 1 for a constant one.

    A task gives the numbers, means and squares about them of its rows, which are put together about the mean of all.
    """
    spark, width = assets.sparkSession, len(features.FEATURE_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, squares = 0, np.zeros(width), np.zeros(width)
        for batch in batches:
            own = batch.column("numbers").flatten().to_numpy().reshape(-1, width)
            if len(own):
                middle = own.mean(axis=0)
                away, total = middle - mean, n + len(own)
                squares += ((own - middle) ** 2).sum(axis=0) + away**2 * (n * len(own) / total)
                mean, n = mean + away * (len(own) / total), total
        if n:
            yield pa.record_batch([pa.array(np.arange(width)), pa.array(np.full(width, float(n))), pa.array(mean), pa.array(squares)], names=["at", "n", "mean", "squares"])

    parts = with_numbers(assets).select("numbers").mapInArrow(run, "at long, n double, mean double, squares double")
    alike = Window.partitionBy("at")
    about = F.sum(F.col("n") * F.col("mean")).over(alike) / F.sum("n").over(alike)
    spread = parts.select("at", "n", (F.col("squares") + F.col("n") * F.pow(F.col("mean") - about, 2)).alias("squares")).groupBy("at").agg(F.sqrt(F.sum("squares") / F.sum("n")).alias("s"))
    names = spark.createDataFrame(list(enumerate(features.FEATURE_NAMES)), "at long, name string")
    return names.join(spread, "at", "left").select("name", F.when(F.col("s") > LEAST_SPREAD, F.col("s")).otherwise(1.0).alias("scale"))


def _category_names() -> Column:
    return F.array(*[F.concat(F.lit(f"{c}="), F.coalesce(F.col(c).cast("string"), F.lit("missing"))) for c in CATEGORIES])


def _categories(assets: DataFrame) -> DataFrame:
    return assets.select("id", F.explode(_category_names()).alias("name"))


def fit_blocks(assets: DataFrame, *, min_df: int = MIN_DF, most_chars: int = MOST_CHARS, most_words: int = MOST_WORDS) -> Blocks:
    """Vocabularies, scales and categories of ``assets(id, ...)``, each as a small written table."""
    chars = written(text_vocabulary(assets, "char", min_df=min_df, most=most_chars), "chars")
    words = written(text_vocabulary(assets, "word", min_df=min_df, most=most_words), "words")
    place = F.array_position(F.array(*[F.lit(n) for n in features.FEATURE_NAMES]), F.col("name")) - 1
    scales = written(feature_scales(assets).select("name", "scale", place.alias("at")), "scales")
    classes = written(_categories(assets).select("name").distinct().select("name", (F.row_number().over(Window.orderBy("name")) - 1).alias("at")), "categories")
    ends = [0]
    for n in (chars.count(), words.count(), len(features.FEATURE_NAMES), classes.count()):
        ends.append(ends[-1] + n)
    return Blocks(chars, words, scales, classes, tuple(ends))


def entries(assets: DataFrame, blocks: Blocks, *, use: tuple[str, ...] = USE) -> DataFrame:
    """``(id, index, value)`` of all blocks in ``use``, zeros left out; unknown tokens and categories give nothing."""
    return linear.unpacked(packed_entries(assets, blocks, use=use))


def packed_entries(assets: DataFrame, blocks: Blocks, *, use: tuple[str, ...] = USE) -> DataFrame:
    """``(id, indices, values)``: the `entries` of each id that has a row, in the order of their indices.

    What is moved is a row's texts and numbers, to the rows of its id; its tokens meet the vocabularies, whose sizes are parameters, where they are cut.
    """
    spark, wanted = assets.sparkSession, [b for b in USE if b in use]
    sources = {"char": _text("char"), "word": _text("word"), "number": F.col("numbers"), "category": _category_names()}
    rows = (with_numbers(assets) if "number" in use else assets).select("id", *[sources[b].alias(b) for b in wanted])
    by_id = rows.groupBy("id").agg(*[F.collect_list(b).alias(b) for b in wanted])
    cut = {"number": F.flatten("number"), "category": F.flatten("category"), "char": F.flatten(F.transform("char", lambda t: char_grams(t))), "word": F.flatten(F.transform("word", lambda t: word_grams(t)))}
    known = {}
    for b, table, columns in (("char", blocks.chars, ("token", "idf")), ("word", blocks.words, ("token", "idf")), ("number", blocks.scales, ("name", "scale")), ("category", blocks.classes, ("name",))):
        if b in use:
            own = table.select("at", *columns).toArrow().combine_chunks().sort_by("at")
            known[b] = own.column(columns[0]).combine_chunks(), own.column(columns[-1]).to_numpy() if len(columns) > 1 else np.ones(len(own))
    sent, offsets, features_of = spark.sparkContext.broadcast(known), dict(zip(USE, blocks.offsets, strict=False)), len(features.FEATURE_NAMES)

    def of_block(b: str, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, places and values of a block's entries."""
        names, scale = sent.value[b]
        owner, flat = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten()
        if b == "number":
            value = flat.to_numpy()
            at = np.arange(len(value)) % features_of
            inside = value != 0
            return owner[inside], at[inside], value[inside] / scale[at[inside]]
        at = pc.index_in(flat, value_set=names).fill_null(-1).to_numpy()
        inside = at >= 0
        owner, at = owner[inside], at[inside]
        if b == "category":
            return owner, at, scale[at]
        each, tf = np.unique(owner * max(len(names), 1) + at, return_counts=True)
        owner, at = np.divmod(each, max(len(names), 1))
        value = (1 + np.log(tf)) * scale[at]
        return owner, at, value / np.sqrt(np.bincount(owner, weights=value * value, minlength=len(lists)))[owner]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [(o, a + offsets[b], v) for b in wanted for o, a, v in [of_block(b, batch.column(b))]]
            owner, index, value = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((index, owner))
            sizes = np.bincount(owner, minlength=batch.num_rows)
            yield pa.record_batch([batch.column("id"), linear.lists(index[order].astype(np.int32), sizes), linear.lists(value[order].astype(float), sizes)], names=["id", "indices", "values"])

    return by_id.select("id", *[cut[b].alias(b) for b in wanted]).mapInArrow(run, f"id {dict(rows.dtypes)['id']}, indices array<int>, values array<double>")


def vectors(rows: DataFrame, size: int, labelled: DataFrame) -> DataFrame:
    """``labelled(id, label, weight)`` with the sparse vector of each row's entries.

    The vector type is how a table of these structs is read.
    """
    struct = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), "indices", "values")
    table = written(linear.packed(rows, labelled).where(F.size("indices") > 0).select(F.col("id").cast("string").alias("id"), "label", F.col("weight").cast("double").alias("weight"), struct.alias("features")), "vectors")
    schema = StructType([StructField("id", StringType()), StructField("label", StringType()), StructField("weight", DoubleType()), StructField("features", VectorUDT())])
    return table.sparkSession.read.schema(schema).parquet(table.written_to)


def balanced(labelled: DataFrame) -> DataFrame:
    """Weights times rows / (classes * rows of the class); a row per class is counted."""
    counts = labelled.groupBy("label").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    share = counts.crossJoin(F.broadcast(total)).select("label", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("balance"))
    return labelled.join(F.broadcast(share), "label").withColumn("weight", F.col("weight") * F.col("balance")).drop("balance")


def margins(rows: DataFrame, coefficients: DataFrame) -> DataFrame:
    """``(id, class, margin)`` of every row of entries and every class.

    The coefficients of an index, whose numbers are parameters, go to its entries as one row; a row's sums for all classes are added up together.
    Rows that are packed meet them as they are.
    """
    biases = sorted((r["class"], r["weight"]) for r in coefficients.where("index = -1").select("class", "weight").collect())
    if linear.packed_rows(rows) is not None:
        return _packed_margins(linear.packed_rows(rows), coefficients, biases)
    wide = coefficients.where("index >= 0").groupBy("index").agg(*[F.sum(F.when(F.col("class") == k, F.col("weight")).otherwise(0.0)).alias(f"w{i}") for i, (k, _) in enumerate(biases)] or [F.lit(0.0).alias("w")])
    joined = rows.join(F.broadcast(wide), "index", "left")
    sums = joined.groupBy("id").agg(*[F.coalesce(F.sum(F.col("value") * F.col(f"w{i}")), F.lit(0.0)).alias(f"s{i}") for i in range(len(biases))] or [F.count("*").alias("n")])
    each = F.array(*[F.struct(F.lit(k).alias("class"), (F.col(f"s{i}") + b).alias("margin")) for i, (k, b) in enumerate(biases)]) if biases else F.array().cast("array<struct<class:string,margin:double>>")
    return sums.select("id", F.inline(each))


def _packed_margins(rows: DataFrame, coefficients: DataFrame, biases: list[tuple[str, float]]) -> DataFrame:
    places = {k: i for i, (k, _) in enumerate(biases)}
    table = coefficients.where("index >= 0").select("class", "index", "weight").toArrow()
    at, index = np.array([places.get(k, -1) for k in table.column("class").to_pylist()], int), table.column("index").to_numpy()
    inside, size = at >= 0, int(index.max()) + 1 if len(index) else 0
    matrix = np.zeros((size + 1, len(biases)))
    np.add.at(matrix, (index[inside], at[inside]), table.column("weight").to_numpy()[inside])
    matrix[-1] = [b for _, b in biases]
    sent, n = rows.sparkSession.sparkContext.broadcast(matrix), len(biases)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in linear._slices(batch):
                own = linear._Rows(part)
                own.value = np.where(own.index < size, own.value, 0.0)
                own.index = np.minimum(own.index, size)
                margins = own.times(sent.value)
                yield pa.record_batch([part.column("id"), linear.lists(margins.ravel(), np.full(own.n, n))], names=["id", "margins"])

    made = rows.select("id", "indices", "values").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, margins array<double>")
    each = F.array(*[F.struct(F.lit(k).alias("class"), F.col("margins")[i].alias("margin")) for i, (k, _) in enumerate(biases)]) if biases else F.array().cast("array<struct<class:string,margin:double>>")
    return made.select("id", F.inline(each))


def probabilities(scored: DataFrame, calibration: DataFrame | None = None) -> DataFrame:
    """``(id, scores)`` with ``scores`` an array of (p, class), best first: calibrated and scaled
    to a sum of 1, or the softmax of the margins where there is no calibration."""
    if calibration is None:
        best = F.max("margin").over(Window.partitionBy("id"))
        raw = scored.withColumn("p", F.exp(F.col("margin") - best))
    else:
        raw = scored.join(F.broadcast(calibration), "class").withColumn("p", 1 / (1 + F.exp(-(F.col("a") * F.col("margin") + F.col("b")))))
    total = F.sum("p").over(Window.partitionBy("id"))
    shares = raw.withColumn("p", F.try_divide("p", total))
    return shares.groupBy("id").agg(F.array_sort(F.collect_list(F.struct((-F.col("p")).alias("minus"), F.col("class").alias("class")))).alias("s")).select(
        "id", F.transform("s", lambda x: F.struct((-x["minus"]).alias("p"), x["class"].alias("class"))).alias("scores")
    )


def gold_labels(consensus: DataFrame, human: DataFrame, *, floor: float = GOLD_FLOOR, human_weight: float = HUMAN_WEIGHT) -> DataFrame:
    """``(id, label, weight)``: labels of enough consensus, weighted by it, and people's labels, which win, at a weight of their own; of several for one id the least by name counts."""
    sure = consensus.where(F.col("consensus") >= floor).select("id", "label", F.col("consensus").cast("double").alias("weight"))
    own = human.groupBy("id").agg(F.min("label").alias("label")).withColumn("weight", F.lit(human_weight))
    return sure.join(own.select("id"), "id", "left_anti").unionByName(own)


def split_held_out(labelled: DataFrame, *, share: float = HELD_OUT, fixed: DataFrame | None = None) -> DataFrame:
    """Adds ``held_out``: a share of every class in the order of a digest of the id; ids in ``fixed`` are held out as well."""
    targets = labelled.groupBy("label").agg(F.round(F.count("*") * share).cast("long").alias("target"))
    chosen = first_of_strata(labelled, ("label",), targets, key="id").select("id")
    if fixed is not None:
        chosen = chosen.union(fixed.select("id")).distinct()
    return labelled.join(chosen.withColumn("held_out", F.lit(True)), "id", "left").withColumn("held_out", F.coalesce("held_out", F.lit(False)))


@dataclass
class DomainModel:
    blocks: Blocks
    coefficients: DataFrame
    calibration: DataFrame | None
    objective: DataFrame
    version: str
    use: tuple[str, ...] = USE


def train_domain_model(assets: DataFrame, labelled: DataFrame, *, version: str = "v1", folds: int = 5, settled: float = linear.SETTLED, use: tuple[str, ...] = USE, **sizes: int) -> DomainModel:
    """The model of ``labelled(id, label, weight)`` over ``assets(id, ...)``.

    The calibration is fitted on margins of rows that the margin's model has not seen, in
    ``folds`` folds by a hash of the id, which are fitted along with the model; without folds
    there is none.
    """
    known = written(with_numbers(assets.join(labelled.select("id"), "id", "left_semi")), "labelled")
    blocks = fit_blocks(known, **sizes)
    fitted = linear.fit_svm(entries(known, blocks, use=use), balanced(labelled), size=blocks.offsets[-1], folds=folds, settled=settled)
    calibration = linear.platt(fitted.unseen) if folds else None
    return DomainModel(blocks, fitted.coefficients, calibration, fitted.objective, version, use)


def two_pass_scores(assets: DataFrame, model: DomainModel, *, labels: dict[str, str] | None = None) -> DataFrame:
    """``(id, domain, domain_alt, confidence, confidence_band, review_required, review_reason, model_version)`` of every asset.

    Assets that terms decide are not scored by the model; their version says so.
    """
    text = F.concat_ws(" ", *features.TEXTS, "column_value_semantics_text")
    # The blocks read what terms leave undecided once each, so the texts are searched before that.
    told = written(keyword_domain(assets, text, labels=labels or TERM_LABELS), "told")
    by_terms = told.where("domain is not null").select("id", "domain", "domain_alt", "confidence", F.lit(None).cast("double").alias("second"), F.lit(f"keyword_rule/{model.version}").alias("model_version"))
    rest = told.where("domain is null").drop("domain", "domain_alt", "confidence", "top_hits")
    scores = probabilities(margins(entries(rest, model.blocks, use=model.use), model.coefficients), model.calibration)
    s = F.col("scores")
    by_model = scores.select("id", s[0]["class"].alias("domain"), F.get(s, F.lit(1))["class"].alias("domain_alt"), s[0]["p"].alias("confidence"), F.get(s, F.lit(1))["p"].alias("second"), F.lit(model.version).alias("model_version"))
    out = by_terms.unionByName(by_model)
    band = confidence_band(F.col("confidence"))
    reasons = review_flags(F.col("domain"), band, F.col("confidence"), F.col("second"))
    return out.select("id", "domain", "domain_alt", "confidence", band.alias("confidence_band"), (reasons != "").alias("review_required"), reasons.alias("review_reason"), "model_version")


def class_auc(scores: DataFrame, label: str = "label") -> DataFrame:
    """``(class, auc)`` of ``scores(id, class, score, label)``, each class against the rest, ties counting half; null for a class without rows of its own."""
    ranked = average_ranks(scores.withColumn("_own", F.col(label) == F.col("class")), "score", keys=("class",))
    n1, n0 = F.count_if("_own"), F.count_if(~F.col("_own"))
    return ranked.groupBy("class").agg(F.try_divide(F.sum(F.when(F.col("_own"), F.col("rank"))) - n1 * (n1 + 1) / 2, n1 * n0).alias("auc"))


def ablation(assets: DataFrame, labelled: DataFrame, uses: dict[str, tuple[str, ...]], *, settled: float = linear.SETTLED, **sizes: int) -> DataFrame:
    """``(blocks, label, predicted, n)``: confusion on held-out rows of models on some of the blocks, all fitted on the same rows."""
    split = written(split_held_out(labelled), "split")
    train = split.where("not held_out").drop("held_out")
    known = written(with_numbers(assets.join(split.select("id"), "id", "left_semi")), "labelled")
    blocks = fit_blocks(known.join(train.select("id"), "id", "left_semi"), **sizes)
    # A block's entries don't depend on the others, so those of all blocks are made once.
    every = written(linear.packed_rows(entries(known, blocks, use=tuple(b for b in USE if any(b in use for use in uses.values())))), "entries")
    held, place = every.join(split.where("held_out").select("id"), "id", "left_semi"), dict(zip(USE, zip(blocks.offsets, blocks.offsets[1:], strict=False), strict=True))
    out = None
    for name, use in uses.items():
        ranges = [place[b] for b in use]
        model = linear.fit_svm(linear.unpacked(linear.ranged(every, ranges)), balanced(train), size=blocks.offsets[-1], settled=settled).coefficients
        scored = probabilities(margins(linear.unpacked(linear.ranged(held, ranges)), model))
        own = scored.select("id", F.col("scores")[0]["class"].alias("predicted")).join(split.select("id", "label"), "id").groupBy("label", "predicted").agg(F.count("*").alias("n"))
        own = own.select(F.lit(name).alias("blocks"), "label", "predicted", "n")
        out = own if out is None else out.unionByName(own)
    return out


def learning_curve(assets: DataFrame, labelled: DataFrame, fractions: tuple[float, ...], *, settled: float = linear.SETTLED, **sizes: int) -> DataFrame:
    """``(fraction, label, predicted, n)``: confusion on held-out rows of models fitted on growing shares of the rest, each within the next."""
    split = split_held_out(labelled).withColumn("draw", F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(1_000_000)) / 1_000_000)
    split = written(split, "split")
    known = written(with_numbers(assets.join(split.select("id"), "id", "left_semi")), "labelled")
    blocks = fit_blocks(known.join(split.where("not held_out").select("id"), "id", "left_semi"), **sizes)
    packed = written(packed_entries(known, blocks), "entries")
    rows, held = linear.unpacked(packed), linear.unpacked(packed.join(split.where("held_out").select("id"), "id", "left_semi"))
    out = None
    for f in fractions:
        train = split.where(~F.col("held_out") & (F.col("draw") < f)).select("id", "label", "weight")
        scored = probabilities(margins(held, linear.fit_svm(rows, balanced(train), size=blocks.offsets[-1], settled=settled).coefficients))
        own = scored.select("id", F.col("scores")[0]["class"].alias("predicted")).join(split.select("id", "label"), "id").groupBy("label", "predicted").agg(F.count("*").alias("n"))
        own = own.select(F.lit(f).alias("fraction"), "label", "predicted", "n")
        out = own if out is None else out.unionByName(own)
    return out


def cross_validated(train: DataFrame, *, regularisations: tuple[float, ...] = (0.001, 0.01, 0.1), folds: int = 3, iterations: int = 20) -> DataFrame:
    """``(regularisation, macro_f1)`` of logistic models of ``train(id, label, features)`` in folds by a hash of the id, best first."""
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    coded = StringIndexer(inputCol="label", outputCol="at").fit(train).transform(train)
    coded = coded.withColumn("fold", F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int"))
    model = LogisticRegression(labelCol="at", weightCol="weight", maxIter=iterations)
    grid = ParamGridBuilder().addGrid(model.regParam, list(regularisations)).build()
    judge = MulticlassClassificationEvaluator(labelCol="at", metricName="f1")
    fitted = CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=judge, numFolds=folds, foldCol="fold").fit(coded)
    rows = sorted(zip(map(float, fitted.avgMetrics), regularisations, strict=True), reverse=True)
    return train.sparkSession.createDataFrame([(r, f) for f, r in rows], "regularisation double, f1 double")


def text_baseline(texts: DataFrame, *, numbers: tuple[str, ...] = (), buckets: int = 1 << 14, iterations: int = 20) -> DataFrame:
    """``(id, label, predicted, held_out)`` of a logistic model of hashed words and imputed numbers; ``texts(id, text, label, numbers..)``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, Imputer, IndexToString, StringIndexer

    split = split_held_out(texts.withColumn("weight", F.lit(1.0)))
    words = split.withColumn("words", word_grams(F.lower(F.coalesce("text", F.lit("")))))
    wide = words.withColumns({n: F.col(n).cast("double") for n in numbers})
    train = wide.where(~F.col("held_out") & F.col("label").isNotNull())
    labels = StringIndexer(inputCol="label", outputCol="at", handleInvalid="skip").fit(train)
    filled = [Imputer(strategy="median", inputCols=list(numbers), outputCols=[f"_{n}" for n in numbers])] if numbers else []
    stages = [*filled, HashingTF(inputCol="words", outputCol="tf", numFeatures=buckets), IDF(inputCol="tf", outputCol="tfidf"), VectorAssembler(inputCols=["tfidf", *(f"_{n}" for n in numbers)], outputCol="features"), LogisticRegression(labelCol="at", maxIter=iterations)]
    fitted = Pipeline(stages=stages).fit(labels.transform(train))
    named = IndexToString(inputCol="prediction", outputCol="predicted", labels=labels.labels).transform(fitted.transform(wide))
    return named.select("id", "label", "predicted", "held_out")


def block_importance(model: DomainModel) -> DataFrame:
    """``(block, importance)``: share of each feature block in the absolute coefficients of all classes."""
    starts = list(zip(("char", "word", "number", "category"), model.blocks.offsets, model.blocks.offsets[1:], strict=False))
    block = F.coalesce(*[F.when((F.col("index") >= a) & (F.col("index") < b), name) for name, a, b in starts])
    own = model.coefficients.where("index >= 0").groupBy(block.alias("block")).agg(F.sum(F.abs("weight")).alias("w"))
    return own.crossJoin(F.broadcast(own.agg(F.sum("w").alias("total")))).select("block", F.try_divide("w", "total").alias("importance"))
