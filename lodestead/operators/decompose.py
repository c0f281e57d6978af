"""Truncated singular value decomposition of a table of entries.

Randomised subspace iteration: a pass multiplies the rows by an orthonormal block of
directions and sums them back by index, and only that block (indices times ``k`` and a few
columns more) is orthogonalised on the driver.  Rows stay sparse throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestead.operators.linear import Passes, _Rows, _slices, gathered
from lodestead.sources.shared import written

#: Columns beside those asked for, passes at most, and the change of a squared value between passes that ends them.
EXTRA, PASSES, SETTLED = 10, 40, 1e-9
_SEED = 20240611


@dataclass
class Decomposition:
    """``values(component, value)``, greatest first; ``components(component, index, weight)`` of length 1, the
    weight of greatest size positive; ``scores(id, coordinates)``, a row's products with the components."""

    values: DataFrame
    components: DataFrame
    scores: DataFrame


def truncated_svd(entries: DataFrame, size: int, k: int, *, extra: int = EXTRA, passes: int = PASSES, settled: float = SETTLED) -> Decomposition:
    """The ``k`` greatest singular values of ``entries(id, index, value)`` with indices below ``size``, and their directions.

    Fewer than ``k`` where the rank is less; no entries give none.
    """
    spark = entries.sparkSession
    # Every row has entries, so they are read and moved once.
    rows = written(gathered(entries).select("id", F.col("e.index").alias("indices"), F.col("e.value").alias("values")), "rows")
    work = Passes(rows, size)
    width = min(size, k + extra)
    block = np.linalg.qr(np.random.default_rng(_SEED).normal(size=(size, width)))[0]
    last = np.zeros(width)
    for _ in range(passes):
        image = _squared(work, block)
        values, turn = np.linalg.eigh(block.T @ image)
        order = np.argsort(-values)
        values, image = np.maximum(values[order], 0), image @ turn[:, order]
        directions = block @ turn[:, order]
        block = np.linalg.qr(image)[0]
        if np.abs(values - last)[:k].max(initial=0) <= settled * max(values[0] if width else 0, 1e-300):
            break
        last = values
    kept = np.flatnonzero(values[:k] > 1e-12 * max(values[0] if width else 0, 1e-300))
    directions = directions[:, kept]
    if len(kept):
        directions = directions * np.sign(directions[np.abs(directions).argmax(axis=0), np.arange(len(kept))])
    index, component = np.nonzero(directions)
    table = pa.table([pa.array(component.astype(np.int32)), pa.array(index.astype(np.int32)), pa.array(directions[index, component])], names=["component", "index", "weight"])
    found = spark.createDataFrame([(int(i), float(np.sqrt(values[i]))) for i in kept], "component int, value double")
    return Decomposition(found, spark.createDataFrame(table), _scores(rows, directions))


def _squared(work: Passes, block: np.ndarray) -> np.ndarray:
    """The entries' transpose times the entries times a block."""
    sent = work.rows.sparkSession.sparkContext.broadcast(np.vstack((block, np.zeros(block.shape[1]))))
    out = work._summed(lambda rows: rows.summed(rows.times(sent.value)), block.shape[1])
    sent.destroy()
    return out[:-1]


def _scores(rows: DataFrame, directions: np.ndarray) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(np.vstack((directions, np.zeros(directions.shape[1]))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                own = _Rows(part).times(sent.value)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1) * own.shape[1], pa.int32()), pa.array(own.ravel()))
                yield pa.record_batch([part.column("id"), lists], names=["id", "coordinates"])

    return rows.select("id", "indices", "values").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, coordinates array<double>")
