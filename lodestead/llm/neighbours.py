"""Approximate nearest neighbours by a forest of random-projection trees.

The levels of all trees have mutually orthogonal random directions (as far as the
dimension allows); a node splits at the median of a sample.  So a tree is one direction
for each level and one threshold for each node, whatever the number of vectors.

1. The forest is fitted on at most ``sample_rows`` vectors, chosen by a hash.
2. Every vector is routed to a leaf of every tree; leaves are counted.
3. A query searches all trees with one priority queue: the node with the least cost, the
   sum of squared distances to the splits crossed, comes first, until the leaves visited
   hold ``share`` of all vectors (``least`` at least).
4. Vectors and queries meet by bough, a subtree of about ``bough_rows`` vectors.  A bough
   is dealt out in blocks of vectors and of queries, so copies of one vector don't meet in
   one task.  Every candidate of a visited leaf is ranked by its exact cosine; the best
   of all boughs are merged.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_sampled

TREES = 4
SAMPLE_ROWS = 32_768
LEAF_ROWS = 40
#: Sample rows that a leaf has on average at least: bounds the depth, whatever the number of vectors.
LEAF_SAMPLE = 16
BOUGH_ROWS = 1_024
BLOCK_VECTORS = 2_048
BLOCK_QUERIES = 4_096
#: Leaf entries that a query looks at, in parts of all vectors: the trees' leaves overlap, so fewer are different.
SHARE = 0.7
LEAST = 4_096
_SEED = 20240607
#: Scores closer than this are told apart by the exact sum only.
_CLOSE = 1e-9


@dataclass(frozen=True)
class Forest:
    """``directions[tree, level]`` and ``thresholds[tree, node]``; node 1 is a root, 2n and 2n+1 are below n."""

    directions: np.ndarray
    thresholds: np.ndarray

    @property
    def depth(self) -> int:
        return self.directions.shape[1]

    def projected(self, vectors: np.ndarray) -> np.ndarray:
        """Place of each vector on each tree's levels: (vector, tree, level)."""
        return np.einsum("nd,tld->ntl", vectors, self.directions, optimize=True)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """Leaf number, from 0, of each vector in each tree."""
        places, trees = self.projected(vectors), np.arange(len(self.directions))
        nodes = np.ones(places.shape[:2], np.int64)
        for level in range(self.depth):
            nodes = 2 * nodes + (places[:, :, level] >= self.thresholds[trees, nodes])
        return nodes - (1 << self.depth)

    def visited(self, places: np.ndarray, sizes: np.ndarray, wanted: int) -> list[tuple[int, int]]:
        """Leaves (tree, number) in order of cost until they hold ``wanted`` vectors; empty ones are passed over."""
        places, first, found, held = places.tolist(), 1 << self.depth, [], 0
        queue = [(0.0, t, 0, 1) for t in range(len(places))]
        while queue and held < wanted:
            cost, tree, level, node = heapq.heappop(queue)
            splits = self.thresholds[tree]
            while level < self.depth:
                beyond = places[tree][level] - splits[node]
                near = 2 * node + (beyond >= 0)
                level += 1
                heapq.heappush(queue, (cost + float(beyond * beyond), tree, level, near ^ 1))
                node = near
            if size := sizes[tree, node - first]:
                found.append((tree, node - first))
                held += int(size)
        return found


def fit_forest(sample: np.ndarray, trees: int, depth: int) -> Forest:
    """A forest on unit vectors; without any, its thresholds are 0."""
    n, dimension = sample.shape
    random = np.random.default_rng(_SEED)
    rows = random.normal(size=(trees * depth, dimension))
    # Orthogonal in groups of at most `dimension`; neighbours in a group belong to different trees.
    groups = [np.linalg.qr(rows[i : i + dimension].T)[0].T for i in range(0, len(rows), dimension)]
    directions = np.concatenate([*groups, np.zeros((0, dimension))]).reshape(depth, trees, dimension).transpose(1, 0, 2).copy()
    thresholds = np.zeros((trees, 1 << depth))
    for t in range(trees if n else 0):
        nodes = np.ones(n, np.int64)
        for level in range(depth):
            place = sample @ directions[t, level]
            order = np.lexsort((place, nodes))
            inner, start, count = np.unique(nodes[order], return_index=True, return_counts=True)
            thresholds[t, inner] = place[order][start + count // 2]
            nodes = 2 * nodes + (place >= thresholds[t, nodes])
    return Forest(directions, thresholds)


def unit(column: pa.Array | pa.ChunkedArray, dimension: int) -> np.ndarray:
    """The vectors of an Arrow list column as rows of length 1."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True, initial=0) if len(rows) else rows
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def best(queries: np.ndarray, vectors: np.ndarray, allowed: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query, vector, score)`` of the k allowed vectors with the greatest cosine for each query, ties to the lesser id.

    A first product picks the vectors near the k-th score; these are summed one pair at a
    time, so a pair's score doesn't depend on what else is in the block.
    """
    scores = np.where(allowed, queries @ vectors.T, -np.inf)
    width = min(k, scores.shape[1])
    kth = np.partition(scores, scores.shape[1] - width, axis=1)[:, scores.shape[1] - width]
    q, v = np.nonzero(allowed & (scores >= kth[:, None] - _CLOSE))
    exact = np.empty(len(q))
    for i in range(0, len(q), 65_536):
        exact[i : i + 65_536] = (queries[q[i : i + 65_536]] * vectors[v[i : i + 65_536]]).sum(axis=1)
    order = np.lexsort((ids[v], -exact, q))
    q, v, exact = q[order], v[order], exact[order]
    place = np.arange(len(q)) - np.searchsorted(q, q, side="left")
    return q[place < k], v[place < k], exact[place < k]


def nearest(
    vectors: DataFrame, k: int = 5, *, every: int = 50, id_column: str = "vec_id", vector_column: str = "embedding", trees: int = TREES, share: float = SHARE, least: int = LEAST,
    sample_rows: int = SAMPLE_ROWS, leaf_rows: int = LEAF_ROWS, bough_rows: int = BOUGH_ROWS, block_vectors: int = BLOCK_VECTORS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible by ``every``, the k nearest other rows found.

    Nearness is the cosine in double precision of the vectors as given; ties go to the
    lesser id.  Rows without an id, and vectors that are null, zero, empty or hold null or
    non-finite components, take no part.  A row repeated with the same vector counts once;
    rows of one id with different vectors are rows of their own.  Vectors of another
    length are another search: cosines are taken among vectors of one length only.  Other
    columns are not looked at; an empty table gives no rows.
    """
    kind = dict(vectors.dtypes)[vector_column]
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast(kind).alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists("vector", lambda x: x != 0)
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).withColumn("vector_key", F.xxhash64("vector"))
    lengths = rows.groupBy(F.size("vector").alias("dimension")).agg(F.count("*").alias("n")).collect()
    out = rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for dimension, n in sorted(map(tuple, lengths)):
        alike = rows.where(F.size("vector") == dimension) if len(lengths) > 1 else rows
        sampled = alike.where(hash_sampled(F.col("vector_key"), sample_rows, n)).select("vector").toArrow().column("vector")
        depth = max(0, min(int(np.ceil(np.log2(max(1, n / leaf_rows)))), int(np.log2(max(1, len(sampled) / LEAF_SAMPLE)))))
        forest = fit_forest(unit(sampled, dimension), trees, depth)
        found = _searched(alike, forest, dimension, kind, n, k, every, max(least, int(np.ceil(share * n))), bough_rows, block_vectors, block_queries)
        out = found if len(lengths) == 1 else out.unionByName(found)
    return out


def _searched(rows: DataFrame, forest: Forest, dimension: int, kind: str, n: int, k: int, every: int, wanted: int, bough_rows: int, block_vectors: int, block_queries: int) -> DataFrame:
    trees, leaves = len(forest.directions), 1 << forest.depth
    below = forest.depth - max(0, min(forest.depth, int(np.log2(max(1, n / bough_rows)))))  # levels of a bough

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((trees, leaves), np.int64)
        for batch in batches:
            if batch.num_rows:
                at = forest.leaves(unit(batch.column("vector"), dimension))
                for t in range(trees):
                    total[t] += np.bincount(at[:, t], minlength=leaves)
        t, leaf = np.nonzero(total)
        yield pa.record_batch([pa.array(t, pa.int32()), pa.array(leaf, pa.int32()), pa.array(total[t, leaf])], names=["tree", "leaf", "n"])

    # A row for each leaf at most, whose number the sample bounds.
    sizes = np.zeros((trees, leaves), np.int64)
    for t, leaf, size in rows.select("vector").mapInArrow(counted, "tree int, leaf int, n long").groupBy("tree", "leaf").agg(F.sum("n")).collect():
        sizes[t, leaf] = size
    boughs = sizes.reshape(trees, -1, 1 << below).sum(axis=2)
    blocks = np.maximum(1, -(-boughs // block_vectors))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = forest.leaves(unit(batch.column("vector"), dimension)) if batch.num_rows else np.zeros((0, trees), np.int64)
            place = batch.column("place").to_numpy().astype(np.uint64)
            for t in range(trees):
                bough = at[:, t] >> below
                block = (place % blocks[t, bough].astype(np.uint64)).astype(np.int32)
                yield pa.record_batch(
                    [pa.array(np.full(len(at), t, np.int32)), pa.array(bough.astype(np.int32)), pa.array(block), batch.column("vec_id"), batch.column("vector_key"), pa.array((at[:, t] & ((1 << below) - 1)).astype(np.int32)), batch.column("vector")],
                    names=["tree", "bough", "block", "vec_id", "vector_key", "leaf", "vector"],
                )

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, places in enumerate(forest.projected(unit(batch.column("vector"), dimension)) if batch.num_rows else ()):
                by_bough: dict[tuple[int, int], list[int]] = {}
                for t, leaf in forest.visited(places, sizes, wanted):
                    by_bough.setdefault((t, leaf >> below), []).append(leaf & ((1 << below) - 1))
                out = [(t, b, block, some) for (t, b), some in by_bough.items() for block in range(int(blocks[t, b]))]
                own = pa.array([i] * len(out), pa.int32())
                yield pa.record_batch(
                    [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.int32()), batch.column("vec_id").take(own), batch.column("vector_key").take(own), pa.array([o[3] for o in out], pa.list_(pa.int32())), batch.column("vector").take(own)],
                    names=["tree", "bough", "block", "query_id", "query_key", "leaves", "vector"],
                )

    placed = rows.withColumn("place", F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 1))
    index = placed.mapInArrow(dealt, f"tree int, bough int, block int, vec_id long, vector_key long, leaf int, vector {kind}")
    queries = rows.where(F.col("vec_id") % every == 0)
    # Blocks of queries: as many as all queries ask for, which bounds those of any bough.
    parts = max(1, -(-queries.count() // block_queries))
    asked_for = queries.mapInArrow(asked, f"tree int, bough int, block int, query_id long, query_key long, leaves array<int>, vector {kind}")
    asked_for = asked_for.withColumn("part", F.pmod(F.xxhash64("query_id", "query_key"), F.lit(parts)).cast("int"))
    index = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def ranked(held: pa.Table, wants: pa.Table) -> pa.Table:
        out = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        if held.num_rows and wants.num_rows:
            keys = np.stack([held.column(c).to_numpy() for c in ("vec_id", "vector_key")], axis=1)
            keys, first = np.unique(keys, axis=0, return_index=True)
            vectors, leaf = unit(held.column("vector"), dimension)[first], held.column("leaf").to_numpy()[first]
            pieces = []
            for i in range(0, wants.num_rows, 512):
                some = wants.slice(i, 512)
                asks = np.stack([some.column(c).to_numpy() for c in ("query_id", "query_key")], axis=1)
                lists = some.column("leaves").combine_chunks()
                seen = np.zeros((len(asks), 1 << below), bool)
                seen[np.repeat(np.arange(len(asks)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
                allowed = seen[:, leaf] & ((asks[:, None, 0] != keys[None, :, 0]) | (asks[:, None, 1] != keys[None, :, 1]))
                q, v, score = best(unit(some.column("vector"), dimension), vectors, allowed, keys[:, 0], k)
                pieces.append((asks[q, 0], asks[q, 1], keys[v, 0], keys[v, 1], score))
            out = [np.concatenate(c) for c in zip(*pieces, strict=True)]
        return pa.table([pa.array(c) for c in out], names=["query_id", "query_key", "vec_id", "vector_key", "score"])

    key = ["tree", "bough", "block", "part"]
    near = index.groupBy(*key).cogroup(asked_for.groupBy(*key)).applyInArrow(ranked, "query_id long, query_key long, vec_id long, vector_key long, score double")
    near = near.groupBy("query_id", "query_key", "vec_id", "vector_key").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id", "vector_key")
    return near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
