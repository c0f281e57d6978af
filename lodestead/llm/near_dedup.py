"""MinHash near-duplicate detection by an inverted join on signature coordinates.

1. One pass over the texts gives each document the size of its set of distinct word
   shingles, a 128-bit key of that set and a signature of ``COORDINATES`` minima.
2. Documents with the same key are one class with a number of its own; from here on only
   classes are compared.  Classes that one doc_id has texts of are linked.
3. Classes are posted under every (coordinate, value) pair.  Pairs that one class alone
   has are dropped.  Two classes that are to agree in ``MATCHES`` coordinates must meet
   under one of the rarest ``shared - MATCHES + 1`` pairs of either (prefix filter).
4. A leader round: each posting list offers its members to one leader only, so a list
   of n classes makes n pairs.  What passes the size bound and the match threshold is
   confirmed on the full shingle sets, and confirmed links are merged into components.
5. Members of lists that still hold several components are compared exactly: posted
   under the rarest of their full set's shingles (as many as a similar set cannot avoid),
   offered to leaders in further rounds, and at last joined in full.  Pairs inside one
   component are skipped throughout, as they could not change any component.

Texts, sets and signatures are only moved for classes that share enough coordinates.
Step 3 is the only one that can lose a link, with the chance given at ``MATCHES``;
``exact=True`` leaves it out and sends every class through step 5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, written
from .components import components
from .hashing import mix, text_shingles

COORDINATES = 40
#: Coordinates that a pair has to agree in.  At a similarity of 0.85 the agreements are
#: binomial with mean 34 and deviation 2.26, and fewer than 20 of 40 have a chance of 4e-8.
MATCHES = 20
LEADER_ROUNDS = 1
#: Bits of a set's parity sketch: two sketches differ in no more bits than the sets in elements.
PARITY_BITS = 1024


def _factors(coordinates: int) -> np.ndarray:
    return np.random.default_rng(5).integers(1, 2**62, coordinates, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def _keys(hashes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Two 64-bit sums over each set; zeros for an empty one."""
    keys, full = np.zeros((len(begin) - 1, 2), np.uint64), np.flatnonzero(np.diff(begin))
    if len(full):
        keys[full, 0] = np.add.reduceat(mix(hashes), begin[:-1][full])
        keys[full, 1] = np.add.reduceat(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin[:-1][full])
    return keys


def _packed(keys: np.ndarray) -> pa.Array:
    return pa.array([k.tobytes() for k in keys], pa.binary())


def _sketches(shingle: int, coordinates: int):
    factors = _factors(coordinates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            hashes, begin = text_shingles(part.column("text"), shingle)
            sizes = np.diff(begin)
            full = np.flatnonzero(sizes)
            keys = _keys(hashes, begin)
            tokens = np.zeros((len(full), coordinates), np.uint64)
            if len(full):
                at = begin[:-1][full]
                for j, factor in enumerate(factors):
                    tokens[:, j] = np.minimum.reduceat(mix(hashes * factor), at) ^ mix(np.array([j], np.uint64))
            sized = np.zeros(len(sizes) + 1, np.int32)
            sized[1:] = np.cumsum((sizes > 0) * coordinates)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(sizes.astype(np.int64)),
                    _packed(keys),
                    pa.ListArray.from_arrays(pa.array(sized), pa.array(tokens.ravel().view(np.int64))),
                ],
                ["doc_id", "n_shingles", "key", "tokens"],
            )

    return run


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            hashes, begin = text_shingles(part.column("text"), shingle)
            n = len(begin) - 1
            cells = np.repeat(np.arange(n), np.diff(begin)) * PARITY_BITS + (hashes % np.uint64(PARITY_BITS)).astype(np.int64)
            odd = (np.bincount(cells, minlength=n * PARITY_BITS) % 2).astype(np.uint8)
            words = np.packbits(odd, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    _packed(_keys(hashes, begin)),
                    pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(hashes.view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (PARITY_BITS // 64)), pa.array(words)),
                ],
                ["key", "shingles", "parity"],
            )

    return run


def near_duplicates(
    documents: DataFrame,
    *,
    shingle: int = 5,
    percent: int = 85,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    leader_rounds: int = LEADER_ROUNDS,
    exact: bool = False,
) -> DataFrame:
    """``documents(doc_id, text, ...)`` -> ``(doc_id, n_shingles, component_id, kept)``, a row per row.

    Two documents are linked when ``100 * shared shingles >= percent * union``;
    ``component_id`` is the least doc_id reachable over links, and ``kept`` marks it.
    Texts of one doc_id are one document.  A text without words (or null) has no shingles
    and is linked with nothing, and its component is its doc_id.  A null
    doc_id joins the class of its text but names no component: where no other id is in
    the component, ``component_id`` is null, and such a row is never kept.  Repeated rows
    are all returned, with equal values.  Other columns are not looked at.  ``matches``
    must be tuned to ``percent``, or ``exact`` be set; an empty table gives no rows.
    """
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = written(
        docs.mapInArrow(_sketches(shingle, coordinates), "doc_id long, n_shingles long, key binary, tokens array<long>"),
        "sketches",
    )
    known = sketch.where("n_shingles > 0 and doc_id is not null")
    # Numbers are given once, as the table is written.
    classes = known.groupBy("key").agg(F.min("doc_id").alias("least"), F.first("n_shingles").alias("n"), F.first("tokens").alias("tokens"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    prefixes = classes.select("rep") if exact else _prefix_postings(classes, matches)
    sets = _class_sets(docs, classes.join(prefixes.select("rep").distinct(), "rep", "left_semi"), shingle)
    found = _links(prefixes, sets, _same_document(known, classes), percent, matches, leader_rounds, exact)
    # Components are named by the least doc_id of their classes.
    merged = found.withColumnRenamed("id", "rep").join(classes.select("rep", "key", "least"), "rep")
    names = merged.groupBy("component").agg(F.min("least").alias("name"))
    renamed = merged.join(names, "component").select("key", "name")
    labelled = classes.join(renamed, "key", "left").select("key", F.coalesce("name", "least").alias("component"))
    out = sketch.join(written(labelled, "components"), "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def _same_document(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between the classes that one doc_id has texts of."""
    several = known.groupBy("doc_id").agg(F.min(F.xxhash64("key")).alias("low"), F.max(F.xxhash64("key")).alias("high")).where("low < high")
    reps = known.join(several, "doc_id", "left_semi").select("doc_id", "key").distinct().join(classes.select("key", "rep"), "key")
    first = reps.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return written(reps.join(first, "doc_id").where("a < rep").select("a", F.col("rep").alias("b")), "links")


def _prefix_postings(classes: DataFrame, matches: int) -> DataFrame:
    """``(token, rep, n, tokens)``: the postings under which a match can first be seen."""
    posted = classes.select("rep", F.explode("tokens").alias("token"))
    shared = written(posted.groupBy("token").agg(F.count("*").alias("lists")).where("lists > 1"), "shared")
    ranked = (
        posted.join(shared, "token")
        .groupBy("rep")
        .agg(F.array_sort(F.collect_list(F.struct("lists", "token"))).alias("ranked"))
        .where(F.size("ranked") >= matches)
        .select("rep", F.slice("ranked", F.lit(1), F.size("ranked") - (matches - 1)).alias("prefix"))
    )
    prefix = ranked.join(classes.select("rep", "n", "tokens"), "rep").select("rep", "n", "tokens", F.explode("prefix.token").alias("token"))
    return written(prefix, "prefixes")


def _class_sets(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """Full shingle set of each of the classes, from a text of its least doc_id."""
    texts = docs.join(classes.select(F.col("least").alias("doc_id")).distinct(), "doc_id", "left_semi").select("text")
    sets = texts.mapInArrow(_sets(shingle), "key binary, shingles array<long>, parity array<long>")
    return written(sets.dropDuplicates(["key"]).join(classes.select("key", "rep"), "key").drop("key"), "sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    common = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("left")), "a")
        .join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("right")), "b")
        .where(100 * common >= percent * (F.size("left") + F.size("right") - common))
        .select("a", "b")
    )


def _set_postings(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(token, rep, n, rest)``: each set's rarest shingles, one of which any similar set has too.

    Sets of n shingles that are similar enough share at least ``percent`` of either, so
    the ``n - needed + 1`` rarest of each suffice; shingles of one set alone are left out.
    ``rest`` counts the shingles of the set from this one on.
    """
    shingles = sets.join(classes, "rep", "left_semi").select("rep", F.size("shingles").alias("n"), F.explode("shingles").alias("token"))
    shared = written(shingles.groupBy("token").agg(F.count("*").alias("lists")).where("lists > 1"), "shared")
    spare = F.col("n") - F.ceil(F.col("n") * percent / 100)
    prefix = (
        shingles.join(shared, "token")
        .groupBy("rep", "n")
        .agg(F.array_sort(F.collect_list(F.struct("lists", "token"))).alias("ranked"))
        # The shingles that no other set has are the rarest and come first.
        .withColumn("length", (spare + 1 - (F.col("n") - F.size("ranked"))).cast("int"))
        .where("length > 0")
        .select("rep", "n", (F.col("n") - F.size("ranked")).alias("before"), F.posexplode(F.slice("ranked", F.lit(1), F.col("length"))["token"]).alias("at", "token"))
        .select("rep", "n", (F.col("n") - F.col("before") - F.col("at")).alias("rest"), "token")
    )
    return written(prefix, "prefixes")


def _leader_round(postings: DataFrame, labels: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Postings with their components, and the lists that hold several components with
    one leader each."""
    posted = postings.join(labels.withColumnRenamed("id", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    carried = ["rep", "component", "n", *(c for c in ("tokens", "rest") if c in postings.columns)]
    lists = posted.groupBy("token").agg(
        F.min(F.struct(F.xxhash64("rep", F.lit(turn)).alias("draw"), *carried)).alias("leader"),
        F.min("component").alias("least"),
        F.max("component").alias("most"),
    )
    return posted, written(lists.where("least < most").select("token", "leader"), "lists")


def _links(prefixes: DataFrame, sets: DataFrame, edges: DataFrame, percent: int, matches: int, leader_rounds: int, exact: bool) -> DataFrame:
    """``(id, component)`` of every class that a link touches, a confirmed one or one of ``edges``."""
    labels = prefixes.sparkSession.createDataFrame([], "id long, component long")
    near = (F.col("x.component") != F.col("y.component")) & (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n"))
    ends = [F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")]
    same = F.col("x.token") == F.col("y.token")

    def offered(posted: DataFrame, lists: DataFrame, close: Column) -> DataFrame:
        return posted.alias("x").join(lists.select("token", "leader.*").alias("y"), same & close).select(*ends).distinct()

    if exact:
        undecided, labels = prefixes, components(edges)
    else:
        posted, lists = _leader_round(prefixes, labels, 0)
        agree = F.size(F.array_intersect("x.tokens", "y.tokens")) >= matches
        edges = written(edges.union(_confirmed(offered(posted, lists, near & agree), sets, percent)), "links")
        labels = components(edges)
        posted, lists = _leader_round(prefixes, labels, 1)
        undecided = written(posted.join(lists.select("token"), "token", "left_semi").select("rep").distinct(), "undecided")
    postings = _set_postings(undecided, sets, percent)
    for turn in range(leader_rounds):
        posted, lists = _leader_round(postings, labels, turn)
        more = written(_confirmed(offered(posted, lists, near), sets, percent), "links")
        if more.isEmpty():
            break
        edges = edges.union(more)
        labels = components(edges)
    posted, lists = _leader_round(postings, labels, leader_rounds)
    members = written(posted.join(lists.select("token"), "token", "left_semi").join(sets.select("rep", "parity"), "rep"), "members")
    # At the first shingle that two sets share, enough of either set must still follow.
    enough = (100 + percent) * F.least("x.rest", "y.rest") >= percent * (F.col("x.n") + F.col("y.n"))
    # Sets that are similar enough differ in few elements, which the parity sketches bound from below.
    apart = F.aggregate(F.zip_with("x.parity", "y.parity", lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda n, k: n + k)
    enough = enough & ((100 + percent) * apart <= (100 - percent) * (F.col("x.n") + F.col("y.n")))
    pairs = members.alias("x").join(members.alias("y"), same & (F.col("x.rep") < F.col("y.rep")) & enough & near).select(*ends).distinct()
    more = written(_confirmed(pairs, sets, percent), "links")
    return labels if more.isEmpty() else components(edges.union(more))


#: DuckDB's form of `near_duplicates` over `documents`, with the default parameters.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT rid, doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT rid, doc_id, count(*) AS n FROM shingles GROUP BY ALL),
pairs AS (SELECT a.rid AS ra, b.rid AS rb, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM pairs p JOIN sizes x ON x.rid = p.ra JOIN sizes y ON y.rid = p.rb WHERE 100 * p.n >= 85 * (x.n + y.n - p.n)),
paired AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS id, a AS far FROM paired UNION SELECT r.id, e.b FROM reach r JOIN paired e ON e.a = r.far),
least AS (SELECT id, min(far) AS component_id FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id, coalesce(l.component_id, w.doc_id) = w.doc_id AS kept
FROM words w LEFT JOIN sizes s ON s.rid = w.rid LEFT JOIN least l ON l.id = w.doc_id
"""
