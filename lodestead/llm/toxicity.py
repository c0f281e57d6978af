"""Toxicity scores from non-negative positive-unlabelled learning.

Positives are documents confirmed as toxic; everything else in the training folds, labelled
or not, is unlabelled text.  A linear model over binary features (words, and the first
bytes of words, which inflected forms share) minimises the non-negative risk

    prior * R+(positives) + max(0, R-(unlabelled) - prior * R-(positives))

with logistic losses; where the second term falls below zero, the step goes against its
gradient, which keeps the model from calling every unlabelled document negative.

Both training sets are hash samples of at most about ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
documents, whatever the number of rows, and the model has at most ``MAX_FEATURES`` features
(documented parameters of the fit).  Every document is scored, over its whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import RangeHash
from .common import chunks, hash_sampled, held_out, written
from .hashing import _LOWER, NOT_ALNUM, laid_out, word_spans

MAX_POSITIVE = 8_000
MAX_UNLABELLED = 24_000
#: Features that enough positives have, by frequency, and of those the most telling.
MAX_CANDIDATES = 60_000
MAX_FEATURES = 3_000
MIN_POSITIVES = 3
PREFIXES = (4, 5, 6)


def _features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Feature hashes (repeats included) and the text of each."""
    raw, starts = laid_out(column)
    raw = _LOWER[raw]
    first, end, owner = word_spans(raw, starts, NOT_ALNUM)
    ranged = RangeHash(raw)
    hashes, owners = [ranged(first, end)], [owner]
    for k in PREFIXES:
        longer = end - first > k
        hashes.append(ranged(first[longer], first[longer] + k) ^ np.uint64(k))
        owners.append(owner[longer])
    return np.concatenate(hashes), np.concatenate(owners), len(starts) - 1


def _distinct(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if not len(hashes):
        return hashes, owners
    new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])))
    return hashes[new], owners[new]


def _known(column: pa.Array, known: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (text, place in sorted ``known``) pairs of the known features of each text."""
    hashes, owners, n = _features(column)
    if not len(known):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), n
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    hit = known[at] == hashes
    pairs = np.unique(owners[hit] * len(known) + at[hit])
    return pairs // len(known), pairs % len(known), n


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents that have each feature, summed over the task."""
    for part in chunks(batches, "text"):
        hashes, _ = _distinct(*_features(part.column("text"))[:2])
        seen, n = np.unique(hashes, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n)], ["feature", "n"])


def _sparse_rows(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            row, column, n = _known(part.column("text"), known)
            begin = np.searchsorted(row, np.arange(n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("positive"), pa.ListArray.from_arrays(pa.array(begin), pa.array(column.astype(np.int32)))], ["positive", "features"])

    return run


def _candidate_counts(known: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(known), np.int64)
        for part in chunks(batches, "text"):
            total += np.bincount(_known(part.column("text"), known)[1], minlength=len(known))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], ["at", "n"])

    return run


@dataclass
class ToxicityModel:
    features: np.ndarray  # sorted hashes
    weights: np.ndarray
    bias: float
    prior: float

    def scores(self, column: pa.Array) -> np.ndarray:
        row, at, n = _known(column, self.features)
        return 1 / (1 + np.exp(-(self.bias + np.bincount(row, weights=self.weights[at], minlength=n))))


def pu_risk(theta: np.ndarray, bias: float, rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """The two terms of the risk, ``prior * R+`` and ``R-(unlabelled) - prior * R-(positive)``,
    and the step: the gradient of both, or against that of the second where it is negative."""
    n_pos, n_unl = max(1, positive.sum()), max(1, (~positive).sum())
    g = np.bincount(rows, weights=theta[columns], minlength=len(positive)) + bias
    p = 1 / (1 + np.exp(-g))
    first = prior * np.logaddexp(0, -g[positive]).sum() / n_pos
    second = np.logaddexp(0, g[~positive]).sum() / n_unl - prior * np.logaddexp(0, g[positive]).sum() / n_pos
    slope = np.where(positive, -prior * p / n_pos, p / n_unl)
    slope = slope + np.where(positive, prior * (p - 1) / n_pos, 0) if second >= 0 else -slope
    return first, second, np.concatenate((np.bincount(columns, weights=slope[rows], minlength=len(theta)), [slope.sum()]))


def non_negative_pu(rows: np.ndarray, columns: np.ndarray, positive: np.ndarray, n_features: int, prior: float, *, steps: int = 400, rate: float = 0.05, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear model; ``rows``/``columns`` are its sparse binary inputs."""
    theta, bias = np.zeros(n_features), float(np.log(prior / (1 - prior)))
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, steps + 1):
        grad = pu_risk(theta, bias, rows, columns, positive, prior)[2]
        grad[:-1] += decay * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta, bias = theta - move[:-1], bias - move[-1]
    return theta, float(bias)


def train_toxicity(
    documents: DataFrame,
    labels: DataFrame,
    *,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    max_candidates: int = MAX_CANDIDATES,
    max_features: int = MAX_FEATURES,
    min_positives: int = MIN_POSITIVES,
) -> ToxicityModel:
    """Model of ``labels.toxic`` from the documents that are not held out.

    Features are the ``max_features`` whose shares differ most between the two samples,
    among the ``max_candidates`` most frequent that ``min_positives`` positives have.

    The class prior is the share of toxic ones among the labelled training rows.  Labels
    of one document are merged by their maximum.  Without a positive, every score is 0.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic")).where(~held_out("doc_id"))
    n, n_toxic = marks.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not n_toxic:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -np.inf, 0.0)
    prior = min(0.9, n_toxic / n)
    chosen = marks.where("toxic = 1").where(hash_sampled(F.col("doc_id"), max_positive, n_toxic)).select("doc_id")
    texts = documents.where("text is not null and doc_id is not null").where(~held_out("doc_id")).select("doc_id", F.col("text").cast("string").alias("text"))
    # About `max_positive` ids.
    positives = texts.join(F.broadcast(chosen), "doc_id", "left_semi").select("text", F.lit(True).alias("positive"))
    unlabelled = texts.where(hash_sampled(F.col("doc_id"), max_unlabelled, documents.count())).select("text", F.lit(False).alias("positive"))
    sample = written(positives.union(unlabelled), "training")
    counts = sample.where("positive").select("text").mapInArrow(_document_counts, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    top = counts.where(F.col("n") >= min_positives).orderBy(F.desc("n"), "feature").limit(max_candidates).collect()
    order = np.argsort(np.array([r["feature"] for r in top], np.int64).view(np.uint64))
    known = np.array([r["feature"] for r in top], np.int64).view(np.uint64)[order]
    in_positive = np.array([r["n"] for r in top], float)[order]
    in_unlabelled = np.zeros(len(known))
    for r in sample.where("not positive").select("text").mapInArrow(_candidate_counts(known), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():
        in_unlabelled[r["at"]] = r["n"]
    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    n_pos, n_unl = sizes.get(True, 0), sizes.get(False, 0)
    if not n_pos or not n_unl or not len(known):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior))), prior)
    pooled = (in_positive + in_unlabelled + 1) / (n_pos + n_unl + 2)
    z = np.abs(in_positive / n_pos - in_unlabelled / n_unl) / np.sqrt(pooled * (1 - pooled) * (1 / n_pos + 1 / n_unl))
    best = np.sort(np.argsort(-z, kind="stable")[:max_features])
    features = known[best]
    rows, columns, positive = [], [], []
    for k, r in enumerate(sample.mapInArrow(_sparse_rows(features), "positive boolean, features array<int>").toLocalIterator()):
        positive.append(r["positive"])
        columns.extend(r["features"])
        rows.extend([k] * len(r["features"]))
    weights, bias = non_negative_pu(np.array(rows, np.int64), np.array(columns, np.int64), np.array(positive), len(features), prior)
    return ToxicityModel(features, weights, bias, prior)


def score_toxicity(documents: DataFrame, labels: DataFrame, **fit: int) -> DataFrame:
    """``documents(doc_id, text)``, ``labels(doc_id, toxic)`` -> ``(doc_id, held_out, score, predicted)``.

    ``fit`` are parameters of `train_toxicity`.  A row with a null doc_id is not held out,
    but nothing is learned from it.  A row per row of ``documents``, scored from its whole text alone; null and empty texts
    get the score of a text without features.  Ids without a label, labels without a
    document, null labels and repeated rows are all fine; other columns are not looked
    at; an empty table gives no rows.
    """
    model = train_toxicity(documents, labels, **fit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            score = model.scores(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = documents.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
