"""Random forests over binned entries, grown level by level from histograms.

A pass over the rows counts, for every tree and open node, the classes in each bin of the
features that the node may split on; tasks add up their own rows, Spark adds up tasks, and
the splits are chosen from the sums.  So a level of all trees, and of all folds, is one
job, and what the driver holds depends on trees, depth, bins and classes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.operators.linear import Passes, _Rows, _slices, mixed

BINS = 32
_SEED = 20240613


def bin_cuts(entries: DataFrame, size: int, *, bins: int = BINS) -> list[np.ndarray]:
    """Increasing cuts of each index below ``size``, between approximate quantiles of its entries; 0, which entries leave out, is a cut of its own."""
    own = entries.groupBy("index").agg(F.percentile_approx("value", [k / bins for k in range(1, bins)], 1_000).alias("cuts"))
    cuts = [np.zeros(0)] * size
    for r in own.collect():  # a row for each index
        cuts[r["index"]] = np.unique(np.append(np.array(r["cuts"]), 0.0))[: bins - 1]
    return cuts


def _binned(rows: _Rows, cuts: list[np.ndarray]) -> np.ndarray:
    """(row, index): the number of cuts below a value."""
    full = np.zeros((rows.n, len(cuts)))
    inside = rows.index < len(cuts)
    full[rows.owner[inside], rows.index[inside]] = rows.value[inside]
    return np.stack([np.searchsorted(c, full[:, k], side="left") for k, c in enumerate(cuts)], axis=1).astype(np.int64)


def _draws(ids: pa.Array, trees: int, seed: int) -> np.ndarray:
    """(row, tree): how often a row is in a tree's sample, about Poisson of 1, from a hash of its key and the tree."""
    keys = mixed(ids.to_numpy().astype(np.uint64)[:, None] ^ mixed(np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(seed)))
    return np.searchsorted(np.cumsum([0.36787944, 0.36787944, 0.18393972, 0.06131324, 0.01532831]), keys / 2.0**64, side="right").astype(float)


@dataclass
class Forest:
    """Splits and class shares by tree and node; node 0 is a root, 2n + 1 and 2n + 2 are below n; a leaf has feature -1."""

    fold: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    shares: np.ndarray
    cuts: list[np.ndarray] = field(repr=False)

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """(row, tree): the node that a row has reached after so many levels."""
        at = np.zeros((len(bins), len(self.fold)), np.int64)
        trees, rows = np.arange(len(self.fold)), np.arange(len(bins))[:, None]
        for _ in range(levels):
            f = self.feature[trees, at]
            right = bins[rows, np.maximum(f, 0)] > self.cut[trees, at]
            at = np.where(f >= 0, 2 * at + 1 + right, at)
        return at


class _Counts(Passes):
    needs = ("key", "label_at", "weight", "fold")

    def _factors(self):
        return lambda part: (*(part.column(c).to_numpy() for c in ("label_at", "weight", "fold")), part.column("key"))


def grow_forest(rows: DataFrame, cuts: list[np.ndarray], classes: int, *, folds: int = 0, trees: int = 20, depth: int = 6, tried: int | None = None, least: float = 2.0, seed: int = _SEED) -> Forest:
    """Trees for each fold (or one set without folds) over ``rows(key, label_at, weight, fold, indices, values)``; ``key`` is a long.

    A node tries ``tried`` features, the root of their number without it, and splits where
    the weighted Gini impurity falls most and both sides keep a weight of ``least``; ties go
    to the first.
    """
    sets = list(range(folds)) or [-1]
    fold = np.repeat(sets, trees)
    n, features = len(fold), len(cuts)
    tried = min(features, tried or max(1, int(np.sqrt(features))))
    random = np.random.default_rng(seed)
    forest = Forest(fold, np.full((n, (1 << (depth + 1)) - 1), -1), np.zeros((n, (1 << (depth + 1)) - 1), np.int64), np.zeros((n, (1 << (depth + 1)) - 1, classes)), cuts)
    for level in range(depth + 1):
        first, width = (1 << level) - 1, 1 << level
        chosen = np.argsort(random.random((n, width, features)), axis=2)[:, :, :tried]
        counts = _histograms(rows, forest, level, chosen, classes, seed)
        if level < depth:
            _split(forest, first, chosen, counts, least)
        own = counts[:, :, 0].sum(axis=2)
        total = own.sum(axis=2, keepdims=True)
        forest.shares[:, first : first + width] = np.divide(own, total, out=np.zeros_like(own), where=total > 0)
    return forest


def _histograms(rows: DataFrame, forest: Forest, level: int, chosen: np.ndarray, classes: int, seed: int) -> np.ndarray:
    """(tree, node of the level, tried feature, bin, class): weights of the rows of the trees' samples."""
    n, width, tried = chosen.shape
    first = (1 << level) - 1
    size = n * width * tried * BINS
    sent = rows.sparkSession.sparkContext.broadcast((forest, chosen))

    def work(part: _Rows, label_at: np.ndarray, weight: np.ndarray, fold: np.ndarray, key: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        forest, chosen = sent.value
        bins = _binned(part, forest.cuts)
        at = forest.nodes(bins, level) - first
        mass = _draws(key, n, seed) * weight[:, None] * (fold[:, None] != forest.fold)
        i, t = np.nonzero((at >= 0) & (mass > 0))
        node = at[i, t]
        own = bins[i[:, None], chosen[t, node]]
        flat = (((t * width + node)[:, None] * tried + np.arange(tried)) * BINS + own) * classes + label_at[i][:, None]
        place, where = np.unique(flat, return_inverse=True)
        sums = np.bincount(where.ravel(), weights=np.repeat(mass[i, t], tried), minlength=len(place))
        cells, row = np.unique(place // classes, return_inverse=True)
        out = np.zeros((len(cells), classes))
        out[row, place % classes] = sums
        return cells, out

    counts = _Counts(rows, size)._summed(work, classes)[:size]
    sent.destroy()
    return counts.reshape(n, width, tried, BINS, classes)


def _split(forest: Forest, first: int, chosen: np.ndarray, counts: np.ndarray, least: float) -> None:
    left = np.cumsum(counts, axis=3)[:, :, :, :-1]
    total = counts.sum(axis=3, keepdims=True)
    right = total - left

    def impurity(c: np.ndarray) -> np.ndarray:
        s = c.sum(axis=-1)
        return s - np.divide((c * c).sum(axis=-1), s, out=np.zeros_like(s), where=s > 0)

    gain = impurity(total) - impurity(left) - impurity(right)
    gain = np.where((left.sum(axis=-1) >= least) & (right.sum(axis=-1) >= least), gain, -1.0)
    n, width = gain.shape[:2]
    flat = gain.reshape(n, width, -1)
    best = flat.argmax(axis=2)
    t, node = np.nonzero(np.take_along_axis(flat, best[:, :, None], 2)[:, :, 0] > 1e-9)
    which, cut = np.divmod(best[t, node], gain.shape[3])
    forest.feature[t, first + node], forest.cut[t, first + node] = chosen[t, node, which], cut


def forest_shares(rows: DataFrame, forest: Forest, classes: list[str], *, by_fold: bool) -> DataFrame:
    """``(key, fold, label_at, predicted, share)``: the class with the greatest mean share over trees, or over those of the row's fold; ties to the first."""
    sent, depth = rows.sparkSession.sparkContext.broadcast(forest), int(np.log2(forest.feature.shape[1] + 1)) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                own = sent.value
                at = own.nodes(_binned(_Rows(part), own.cuts), depth)
                shares = own.shares[np.arange(at.shape[1]), at]
                mine = (part.column("fold").to_numpy()[:, None] == own.fold) if by_fold else np.ones(at.shape, bool)
                mean = (shares * mine[:, :, None]).sum(axis=1) / np.maximum(mine.sum(axis=1), 1)[:, None]
                best = mean.argmax(axis=1)
                yield pa.record_batch([part.column("key"), part.column("fold"), part.column("label_at"), pa.array([classes[k] for k in best], pa.string()), pa.array(mean.max(axis=1))], names=["key", "fold", "label_at", "predicted", "share"])

    return rows.select("key", "fold", "label_at", "indices", "values").mapInArrow(run, "key long, fold int, label_at int, predicted string, share double")
