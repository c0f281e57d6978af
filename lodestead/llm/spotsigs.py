"""SpotSigs document fingerprints with DataFrame functions only.

A signature is a chain of content words that begins right after a common word (an
anchor); anchors inside the chain are skipped.  The set of a document's signatures is
its fingerprint.  Two fingerprints are compared by Jaccard; a search first splits them by
set size, so that only sizes that can reach the threshold meet, and then joins them on
the rarest signatures that a similar pair cannot avoid sharing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Frequent function words of English, French, German and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this", "to", "was", "with",
    "au", "avec", "dans", "de", "des", "du", "en", "est", "et", "la", "le", "les", "par", "pas", "pour", "que", "qui", "sur", "un", "une",
    "auf", "das", "dem", "den", "der", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "como", "con", "del", "el", "las", "los", "más", "para", "por", "se", "su", "una", "y",
)
#: Content words in a chain.
CHAIN = 2


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Column:
    """Sorted distinct 32-bit signatures of a text, as whole numbers.

    Words are runs of letters and digits, lower-cased.  A text without anchor has every
    chain of its words as a signature, and chains at its end are shorter, so any text
    with a word has one; a null, empty or wordless text has none.
    """
    common = "|".join(sorted(anchors))

    def once(value: Column, use: Callable[[Column], Column]) -> Column:
        """``use(value)`` with the value computed one time."""
        return F.transform(F.array(value), use)[0]

    def mark(words: Column) -> Column:
        # Anchors become marks on the content word they stand before.
        marked = F.regexp_replace(F.regexp_replace(words, rf"(?<![^ ])(?:{common}) ", "\u0001"), rf"(?<![^ \u0001])(?:{common})$", "")
        every = F.regexp_replace(words, r"(?<![^ ])(?=[^ ])", "\u0001")
        return once(marked, lambda m: F.when(m.rlike("\u0001[^ \u0001]"), m).otherwise(every))

    def chains(parts: Column, plain: Column) -> Column:
        joined = plain
        for k in range(1, chain):
            joined = F.zip_with(joined, F.slice(plain, F.lit(k + 1), F.size(plain)), lambda a, b: F.concat_ws(" ", a, b))
        return F.filter(F.zip_with(parts, joined, lambda w, c: F.when(w.startswith("\u0001"), c)), lambda c: c.isNotNull())

    words = F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    parts = F.filter(F.split(once(words, mark), " "), lambda w: F.ltrim(w, F.lit("\u0001")) != "")
    found = once(parts, lambda p: once(F.transform(p, lambda w: F.ltrim(w, F.lit("\u0001"))), lambda q: chains(p, q)))
    return F.array_sort(F.array_distinct(F.transform(found, lambda c: F.crc32(c))))


def fingerprint(signature_set: Column) -> Column:
    """The signatures as hexadecimal digits in one string; the empty string for none."""
    return F.array_join(F.transform(signature_set, lambda c: F.lpad(F.lower(F.hex(c)), 8, "0")), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard of two signature sets; two empty sets are alike, an empty and a full one are not."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


#: Quantiles of the ids that cut them into ranges.
CUTS = 1024
ROWS_PER_RANGE = 2000


def _ranges(documents: DataFrame, rows_per_range: int, most_cuts: int) -> Column:
    """Number of a row's range of ids, counted from the greatest ids; null ids come last.

    Ranges have about ``rows_per_range`` rows each: at most ``most_cuts`` quantiles are
    looked up (in two steps, among every sixteenth and then between two of those), and
    what lies between two of them is divided evenly by the value of the id.  Equal ids
    always get the same number.
    """
    rows, least, most = documents.agg(F.count("*"), F.min("doc_id"), F.max("doc_id")).first()
    ranges = max(16, rows // rows_per_range)
    cuts = min(ranges, most_cuts)
    found = documents.agg(F.percentile_approx("doc_id", [k / cuts for k in range(1, cuts)], 20 * cuts)).first()[0] or []
    high = sorted(set(found), reverse=True)
    parts = [high[i : i + 16] for i in range(0, len(high), 16)]
    heads = F.array(*[F.lit(p[-1]) for p in parts]).cast("array<long>")
    nested = F.array(*[F.array(*[F.lit(c) for c in p]).cast("array<long>") for p in [*parts, []]])
    full = F.size(F.filter(heads, lambda c: c > F.col("doc_id")))
    number = F.least(F.lit(len(high)), 16 * full + F.size(F.filter(F.element_at(nested, full + 1), lambda c: c > F.col("doc_id"))))
    each = -(-ranges // cuts)
    if each > 1:
        bounds = F.array(*[F.lit(c) for c in [(most or 0) + 1, *high, least or 0]]).cast("array<long>")
        upper, lower = F.element_at(bounds, number + 1).cast("double"), F.element_at(bounds, number + 2).cast("double")
        inside = F.floor(F.try_divide((upper - F.col("doc_id")) * each, upper - lower))
        number = number.cast("long") * each + F.greatest(F.lit(0), F.least(F.coalesce(inside, F.lit(0)), F.lit(each - 1)))
    return F.when(F.col("doc_id").isNull(), F.lit((len(high) + 1) * each)).otherwise(number).cast("long")


def with_next(documents: DataFrame, more: dict[str, Column] | None = None, *, rows_per_range: int = ROWS_PER_RANGE, most_cuts: int = CUTS) -> DataFrame:
    """``documents(doc_id, text)`` with the columns ``more`` and a struct ``next`` of text and
    ``more`` of the row that follows in descending doc_id; the first follows the last.

    ``more`` is worked out once for each row, before it is moved.  Each range of ids is ordered by itself, and its last row takes the first row of the
    next range that has any.  Null ids come last; rows that share an id are ordered by text.
    """
    more = more or {}
    values = ["text", *more]
    placed = documents.select("doc_id", "text", _ranges(documents, rows_per_range, most_cuts).alias("range"))
    order = Window.partitionBy("range").orderBy(F.desc_nulls_last("doc_id"), F.col("text").asc_nulls_first())
    led = placed.withColumns(more).withColumn("after", F.lead(F.struct(*values)).over(order))
    # A number for each range is ordered in one place, and a row for each range joined.
    tops = written(placed.groupBy("range").agg(F.max("doc_id").alias("top")), "ranges")
    whole = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = tops.select("range", "top", F.coalesce(F.lag("range").over(Window.orderBy("range")), F.last("range").over(whole)).alias("before"))
    heads = documents.join(before, F.col("doc_id").eqNullSafe(F.col("top"))).groupBy(F.col("before").alias("range")).agg(F.min("text").alias("text"))
    openings = written(heads.withColumns(more).select("range", F.struct(*values).alias("opening")), "openings")
    return led.join(openings, "range", "left").select("doc_id", *values, F.coalesce("after", "opening").alias("next"))


def fingerprint_documents(documents: DataFrame, *, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness.

    ``documents(doc_id, text, ...)`` gives ``(doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next)``, a row per row.  The edited text has its
    last ``n_chars // 2`` characters replaced by the first as many (or all) of the next
    document in descending doc_id, the first following the last.  Null texts count as
    empty; an only document follows itself; other columns are not looked at; an empty
    table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.left("text", (n - half).cast("int")), F.left("next.text", half))
    found = with_next(docs, {"own": signatures(F.col("text"), anchors, chain)}).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "own", F.col("next.own").alias("following"))
    found = found.withColumn("changed", signatures(F.col("edited"), anchors, chain))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )


def near_pairs(documents: DataFrame, *, threshold: float = 0.8, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``(a, b, near)``: pairs of different fingerprints with a Jaccard of ``threshold`` or more.

    Documents with equal fingerprints are one class, named by its least doc_id.  Classes
    are banded by set size so that a similar set lies in the same or the next band; pairs
    meet in a band under the rarest signatures that a similar pair cannot avoid sharing,
    and are dropped by size before their sets are compared.
    """
    sets = documents.select("doc_id", signatures(F.col("text").cast("string"), anchors, chain).alias("signatures")).where("doc_id is not null and size(signatures) > 0")
    classes = written(sets.groupBy("signatures").agg(F.min("doc_id").alias("doc_id")).withColumn("n", F.size("signatures")), "classes")
    posted = classes.select("doc_id", "n", F.explode("signatures").alias("s"))
    counts = written(posted.groupBy("s").agg(F.count("*").alias("lists")), "counts")
    spare = (F.col("n") - F.ceil(F.col("n") * threshold) + 1).cast("int")
    prefix = posted.join(counts, "s").groupBy("doc_id", "n").agg(F.array_sort(F.collect_list(F.struct("lists", "s"))).alias("ranked"))
    prefix = prefix.select("doc_id", "n", F.explode(F.slice("ranked", F.lit(1), spare)["s"]).alias("s"))
    band = F.floor(F.log(F.col("n").cast("double")) / -F.log(F.lit(threshold))).cast("int")
    prefix = written(prefix.withColumn("band", band), "prefixes")
    near_bands = prefix.withColumn("band", F.explode(F.array("band", F.col("band") + 1)))
    x, y = near_bands.alias("x"), prefix.alias("y")
    fits = (F.col("x.n") >= threshold * F.col("y.n")) & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.doc_id") < F.col("y.doc_id"))))
    pairs = x.join(y, (F.col("x.s") == F.col("y.s")) & (F.col("x.band") == F.col("y.band")) & fits).select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b")).distinct()
    left, right = classes.select(F.col("doc_id").alias("a"), F.col("signatures").alias("p")), classes.select(F.col("doc_id").alias("b"), F.col("signatures").alias("q"))
    near = pairs.join(left, "a").join(right, "b").withColumn("near", likeness(F.col("p"), F.col("q"))).where(F.col("near") >= threshold)
    return near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "near")
