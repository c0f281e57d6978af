"""A training corpus from raw documents, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept and
returns a DataFrame, which is written as Parquet and read again as the next one's docs.
All but the last return the columns of ``documents``.  Rows without a doc_id go in the
first stage, and null texts with them.  Rows that repeat a doc_id and text are one
document; rows of one doc_id with other texts are each judged by their own text, only near
copies are told by doc_id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestead.llm.common import table, written
from lodestead.llm.decontaminate import benchmark_hits
from lodestead.llm.language import identify_languages
from lodestead.llm.mixing import mix_to_weights
from lodestead.llm.near_dedup import near_duplicates
from lodestead.llm.suffix_dedup import remove_repeats

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter; ``lang`` becomes the prediction.

    No text goes for its score: that of a few rare words is no greater than chance.
    """
    told = identify_languages(docs, carry=("text", "source", "n_chars"))
    return told.where("doc_id is not null and lang_pred <> 'und'").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies, each text of it once."""
    kept = near_duplicates(docs).where("kept").select("doc_id").distinct()
    rest = [c for c in COLUMNS if c not in ("doc_id", "text")]
    return docs.join(kept, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(*rest)).alias("rest")).select("doc_id", "text", "rest.*").select(*COLUMNS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated passages out; a character that a cut parts goes as well, and so do texts left empty."""
    cut = remove_repeats(docs, carry=("lang", "source"), as_text=True).withColumnRenamed("kept", "text").where("text <> ''")
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    return benchmark_hits(docs, table(spark, sf_dir, "benchmark"), carry=COLUMNS).where("not contaminated").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: the documents that it takes, with how many of their words, repeats counted, and their texts."""
    # A doc_id may have several texts by now, but each of them once.
    keyed = docs.withColumn("text_key", F.xxhash64("text"))
    taken = mix_to_weights(keyed, carry=("text_key",)).where("taken > 0")
    return taken.join(keyed.select("doc_id", "text_key", "text"), ["doc_id", "text_key"]).drop("text_key")


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_sources", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs


#: Language profiles and near-duplicate components are out of SQL's reach.
ORACLE_SQL = None
