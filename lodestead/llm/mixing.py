"""Mixing sources to target weights with DataFrame operations only.

Targets come from the sources' sizes in closed form.  Documents get a hash-random key;
the top bits of the key cut every source into ranges, as many as the number of rows
asks for, so that a source with a third of all rows is summed in pieces of bounded size.  The prefix sum
of a document is the sum of the ranges before its own plus a running sum inside it, and
the budget that remains after whole epochs cuts each source at that sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
#: A target stops at this many times the source's size.
EPOCHS = 3
#: Rows of a key range, about, in the largest source; ranges are named by the first bits of the key.
RANGE_ROWS = 100_000


def word_count(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    spaced = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    return F.when(F.coalesce(F.length(spaced), F.lit(0)) == 0, F.lit(0)).otherwise(F.size(F.split(spaced, " +"))).cast("long")


def source_targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, target)`` from ``sized(source, size)``.

    The sum of all sizes is shared by weight; no target passes ``epochs`` times its
    source's size, and what is cut off is shared among the others by weight again until
    nobody is above.  That end state gives every uncapped source the same amount per
    weight, and the sources in order of ``epochs * size / weight`` are capped first.
    One row per source is ordered here; documents are summed before.
    """
    names = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    named = names.withColumn("weight", weight).withColumn("cap", (epochs * F.col("source_size")).cast("double"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(from_here)
    leveled = named.withColumn("level", level)
    # The first source whose cap reaches the level fixes it for all after it.
    share = F.min(F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    return leveled.withColumn("share", share).select("source", "source_size", F.least("cap", F.col("share") * F.col("weight")).alias("target"))


def mix_to_weights(
    documents: DataFrame,
    *,
    weights: tuple[float, ...] = WEIGHTS,
    epochs: int = EPOCHS,
    seed: str = "",
    range_rows: int = RANGE_ROWS,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """``documents(doc_id, text, source, ...)`` -> ``(doc_id, source, size, source_size, target, taken)``
    and the columns named in ``carry`` behind them.

    ``taken`` counts the words that the mix takes of a document, repeats counted: every
    whole epoch takes all of it, and the last, partial one takes documents in the order
    of ``md5(seed + doc_id)`` until the source's budget is spent; the document at the cut
    is taken in part, so that a source's sum is its target rounded down.  A null source
    is a source of its own, ordered last; a null text has size 0 and is never taken from;
    a null doc_id is keyed as the empty string.  Rows that share a doc_id are separate
    rows, ordered by size and then by the columns in ``carry``.  Other columns are not looked at; an empty table gives no rows.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = documents.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"), *carry).withColumn("key", key)
    # Words are counted once; what follows reads a few numbers for each row.
    sized = written(sized, "sizes")
    digits = 2
    rows = sized.count()
    while 16**digits * range_rows < rows:
        digits += 1
    sized = sized.withColumn("range", F.substring("key", 1, digits))
    # Null sources are joined as well: a marker before the name makes the key never null.
    tag = F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))
    sized = sized.withColumn("tag", tag)
    ranges = sized.groupBy("tag", "source", "range").agg(F.sum("size").alias("size"))
    targets = source_targets(ranges, weights, epochs).withColumn("tag", tag).drop("source")
    earlier = Window.partitionBy("tag").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("tag", "range", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")).join(targets, "tag")
    inside = Window.partitionBy("tag", "range").orderBy("key", "doc_id", "size", *carry).rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["tag", "range"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    budget = F.floor(F.col("target")).cast("long") - whole * F.col("source_size")
    partial = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), budget - F.col("offset") - F.col("inside")))
    return placed.select("doc_id", "source", "size", "source_size", "target", (whole * F.col("size") + partial).cast("long").alias("taken"), *carry)


#: DuckDB's form of `mix_to_weights` over `documents`, with the default parameters.
ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
names AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighted AS (
  SELECT source, source_size, 3.0::DOUBLE * source_size AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM names),
leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
targets AS (
  SELECT source, source_size, least(cap, weight * (SELECT arg_min(level, cap / weight) FROM leveled WHERE cap >= level * weight)) AS target
  FROM leveled),
placed AS (
  SELECT s.*, t.source_size, t.target,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM placed)
SELECT doc_id, source, size, source_size, target,
       CAST(whole * size + greatest(0, least(size, CAST(floor(target) AS BIGINT) - whole * source_size - before)) AS BIGINT) AS taken
FROM epochs
"""
