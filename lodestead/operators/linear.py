"""Linear support-vector machines over a table of entries, fitted in whole passes over the rows.

The model of a class minimises ``|w|^2 / 2 + C * sum(s * max(0, 1 - y * m)^2)`` over its
margins ``m = w . x``.  All classes, and for calibration all folds, are columns of one
solver: quasi-Newton steps, a job each, and where they are to be exact Newton steps whose systems are solved by
conjugate gradients, every product with the curvature being one job.  Rows are packed once; a task turns its rows into partial
sums by index, which Spark adds up.  What the driver holds is a few numbers for each index
and column: the vocabularies, whose sizes are parameters, times classes and folds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestead.sources.shared import written

#: Newton steps and conjugate gradients in each at most, and the gradient, against that at the start, at which a column is settled.
NEWTON, CONJUGATE, SETTLED = 30, 60, 1e-6
#: Pairs of steps and slopes that a quasi-Newton step is made of, how many such steps there are at most, and the gradient, against that at the
#: start, from which on Newton steps are better: the rows that count hardly change any more.
PAIRS, QUASI, NEAR = 6, 200, 1e-3
#: Share of a gradient that a Newton step may leave.
FORCED = 0.3
#: Directions of the preconditioner.
RANK = 64
_SEED = 20240609
#: Places behind the indices: of the biases, and of sums that belong to no index.
BIAS, ALONE = -1, -2
#: Indices whose sums of all columns travel as one value.
BLOCK = 512
#: Entries that one numpy step works on; it takes about 20 times as many bytes for each column.
ENTRIES = 20_000
#: Entries of a slice that is laid out for many passes, and the share of its rows from which on an index is a column of a matrix:
#: a product with a cell costs about a fiftieth of one with an entry.
LAID_OUT, DENSE = 60_000, 0.02


def gathered(entries: DataFrame) -> DataFrame:
    """``(id, e)``: the entries of each row that has any, in the order of their indices."""
    return entries.select("id", "index", F.col("value").cast("double").alias("value")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("e"))


def unpacked(rows: DataFrame) -> DataFrame:
    """The entries of packed ``rows(id, indices, values)``, one row for each id; what needs them packed reads ``rows`` again."""
    out = rows.select("id", F.inline(F.arrays_zip(F.col("indices").alias("index"), F.col("values").alias("value"))))
    out.packed_rows = rows
    return out


def packed_rows(entries: DataFrame) -> DataFrame | None:
    """The rows that `unpacked` made the entries of."""
    return getattr(entries, "packed_rows", None)


def packed(entries: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows(id, ...)`` with the indices and values of their entries, which are moved once; rows without entries have empty ones."""
    known = packed_rows(entries)
    if known is None:
        known = gathered(entries).select("id", F.col("e.index").alias("indices"), F.col("e.value").alias("values"))
    joined = rows.join(known, "id", "left")
    none = F.array()
    return joined.withColumns({"indices": F.coalesce("indices", none.cast("array<int>")), "values": F.coalesce("values", none.cast("array<double>"))})


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """So many of the values in each list."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values))


def ranged(rows: DataFrame, ranges: list[tuple[int, int]]) -> DataFrame:
    """Packed ``rows(id, indices, values)`` with the entries whose indices lie in one of the ranges, ends left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _Rows(batch)
            inside = np.any([(own.index >= a) & (own.index < b) for a, b in ranges], axis=0)
            sizes = np.bincount(own.owner[inside], minlength=own.n)
            yield pa.record_batch([batch.column("id"), lists(own.index[inside].astype(np.int32), sizes), lists(own.value[inside], sizes)], names=["id", "indices", "values"])

    return rows.select("id", "indices", "values").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, indices array<int>, values array<double>")


class _Rows:
    """Packed rows of a slice, sorted for products from both sides."""

    def __init__(self, part: pa.RecordBatch):
        indices = part.column("indices")
        self.n = part.num_rows
        sizes = indices.value_lengths().to_numpy()
        self.index, self.value = indices.flatten().to_numpy().astype(np.int64), part.column("values").flatten().to_numpy()
        self.owner = np.repeat(np.arange(self.n), sizes)
        self.full = np.flatnonzero(sizes > 0)
        self.starts = (np.cumsum(sizes) - sizes)[self.full]

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """(row, column): products with ``matrix(index, column)``, whose last row holds the biases."""
        out = np.broadcast_to(matrix[-1], (self.n, matrix.shape[1])).copy()
        if len(self.full):
            out[self.full] += np.add.reduceat(matrix[self.index] * self.value[:, None], self.starts, axis=0)
        return out

    def summed(self, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indices that occur, the bias as well, and the sums of the rows' entries times their factors."""
        order = np.argsort(self.index, kind="stable")
        found, first = np.unique(self.index[order], return_index=True)
        each = factors[self.owner[order]] * self.value[order][:, None]
        sums = np.add.reduceat(each, first, axis=0) if len(found) else np.zeros((0, factors.shape[1]))
        return np.append(found, BIAS), np.concatenate((sums, factors.sum(axis=0, keepdims=True)))


def _slices(batch: pa.RecordBatch, entries: int = ENTRIES) -> Iterator[pa.RecordBatch]:
    ends, start = np.cumsum(batch.column("indices").value_lengths().to_numpy()), 0
    while start < batch.num_rows:
        stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + entries, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


#: A laid-out slice: its numbers of rows and of matrix columns, the indices that occur, those of the matrix first, the cells of
#: the matrix, and the other entries by row.
_LAYOUT = {"found": np.int32, "cell": np.int32, "cell_value": np.float64, "owner": np.int32, "place": np.int32, "value": np.float64}
_OF_ROWS = {"label_at": np.int32, "weight": np.float64, "fold": np.int32}


def laid_out(rows: DataFrame) -> DataFrame:
    """Packed ``rows(label_at, weight, fold, indices, values)`` as slices that are sorted once and not in every pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch, LAID_OUT):
                own = _Rows(part)
                found, place, counts = np.unique(own.index, return_inverse=True, return_counts=True)
                many = counts >= max(DENSE * own.n, 1)
                front = np.argsort(~many, kind="stable")
                rank = np.empty(len(found), np.int64)
                rank[front] = np.arange(len(found))
                place, dense = rank[place.ravel()], int(many.sum())
                inside = place < dense
                arrays = {
                    "found": found[front], "cell": own.owner[inside] * dense + place[inside], "cell_value": own.value[inside],
                    "owner": own.owner[~inside], "place": place[~inside] - dense, "value": own.value[~inside],
                }
                arrays |= {c: part.column(c).to_numpy() for c in _OF_ROWS}
                data = [pa.array([arrays[c].astype(t).tobytes()], pa.binary()) for c, t in (_LAYOUT | _OF_ROWS).items()]
                yield pa.record_batch([pa.array([own.n], pa.int32()), pa.array([dense], pa.int32()), *data], names=["n", "dense", *_LAYOUT, *_OF_ROWS])

    schema = "n int, dense int, " + ", ".join(f"{c} binary" for c in (*_LAYOUT, *_OF_ROWS))
    return rows.select(*_OF_ROWS, "indices", "values").mapInArrow(run, schema)


class _LaidOut:
    """One slice of `laid_out`; its products are those of `_Rows`."""

    def __init__(self, batch: pa.RecordBatch, at: int):
        for c, t in (_LAYOUT | _OF_ROWS).items():
            setattr(self, c, np.frombuffer(batch.column(c)[at].as_buffer(), t))
        self.n, self.dense = batch.column("n")[at].as_py(), batch.column("dense")[at].as_py()
        self.matrix = np.bincount(self.cell, weights=self.cell_value, minlength=self.n * self.dense).reshape(self.n, self.dense)

    def _spread(self, to: np.ndarray, of: np.ndarray, factors: np.ndarray, n: int) -> np.ndarray:
        """(place, column): sums of the entries outside the matrix times their factors; a column at a time, whose numbers stay at hand."""
        return np.stack([np.bincount(to, weights=column[of] * self.value, minlength=n) for column in np.ascontiguousarray(factors.T)], axis=1)

    def times(self, matrix: np.ndarray) -> np.ndarray:
        own = matrix[self.found]
        out = self.matrix @ own[: self.dense] + matrix[-1]
        return out + self._spread(self.owner, self.place, own[self.dense :], self.n) if len(self.owner) else out

    def summed(self, factors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sums = [self.matrix.T @ factors]
        if len(self.owner):
            sums.append(self._spread(self.place, self.owner, factors, len(self.found) - self.dense))
        return np.append(self.found, BIAS), np.concatenate((*sums, factors.sum(axis=0, keepdims=True)))


@dataclass(frozen=True)
class Columns:
    """The class and the fold that is left out (-1: none) of each column."""

    at: np.ndarray
    fold: np.ndarray

    def signs_and_weights(self, part: _LaidOut) -> tuple[np.ndarray, np.ndarray]:
        y = np.where(part.label_at[:, None] == self.at, 1.0, -1.0)
        return y, part.weight[:, None] * (part.fold[:, None] != self.fold)


class Passes:
    """Sums over packed ``rows(indices, values, ...)``, a job each; indices are below ``size``."""

    needs: tuple[str, ...] = ()

    def __init__(self, rows: DataFrame, size: int):
        self.rows, self.size, self.jobs = rows, size, 0

    def _factors(self) -> Callable[[pa.RecordBatch], tuple]:
        """What a slice has beside its entries."""
        return lambda part: ()

    def _parts(self) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[tuple]]]:
        """The table that a pass reads, and what it makes of a batch: the rows of a slice and their factors."""
        factors = self._factors()
        return self.rows.select(*self.needs, "indices", "values"), lambda batch: ((_Rows(part), *factors(part)) for part in _slices(batch))

    def _summed(self, work: Callable[..., tuple[np.ndarray, np.ndarray]], width: int, more: int = 0) -> np.ndarray:
        """(index, column) sums of what ``work(rows, *factors)`` makes of each slice; the bias is the last index but for ``more``."""
        size, bias = self.size + 1 + more, self.size
        table, parts = self._parts()

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((-(-size // BLOCK) * BLOCK, width))
            seen = np.zeros(len(total) // BLOCK, bool)
            for batch in batches:
                for part in parts(batch):
                    index, sums = work(*part)
                    index = np.where(index < 0, bias + BIAS - index, index)
                    total[index] += sums
                    seen[index // BLOCK] = True
            for k in np.flatnonzero(seen):
                yield pa.record_batch([pa.array([k]), pa.array([total[k * BLOCK : (k + 1) * BLOCK].tobytes()])], names=["block", "sums"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, own in zip(batch.column("block").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    sums[k] = sums.get(k, 0.0) + np.frombuffer(own)
            if sums:
                yield pa.record_batch([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()])], names=["block", "sums"])

        self.jobs += 1
        schema = "block long, sums binary"
        # As many places as there are blocks or cores, so that no pass plans its few blocks anew.
        places = max(1, min(-(-size // BLOCK), self.rows.sparkSession.sparkContext.defaultParallelism))
        blocks = table.mapInArrow(partial, schema).repartition(places, "block")
        out = np.zeros((-(-size // BLOCK), BLOCK, width))
        for own in blocks.mapInArrow(added, schema).toArrow().to_pylist():
            out[own["block"]] = np.frombuffer(own["sums"]).reshape(BLOCK, width)
        return out.reshape(-1, width)[:size]


class SquaredHinge(Passes):
    """The objective of all columns over the slices of `laid_out` rows."""

    def __init__(self, rows: DataFrame, columns: Columns, c: float, size: int):
        super().__init__(rows, size)
        self.columns, self.c = columns, c

    def _of(self, which: np.ndarray) -> SquaredHinge:
        """The objective of some of the columns, over the same rows."""
        return SquaredHinge(self.rows, Columns(self.columns.at[which], self.columns.fold[which]), self.c, self.size)

    def _parts(self) -> tuple[DataFrame, Callable[[pa.RecordBatch], Iterator[tuple]]]:
        columns = self.columns

        def parts(batch: pa.RecordBatch) -> Iterator[tuple]:
            for at in range(batch.num_rows):
                part = _LaidOut(batch, at)
                yield part, *columns.signs_and_weights(part)

        return self.rows, parts

    def preconditioner(self, rank: int) -> Callable[[np.ndarray], np.ndarray]:
        """Solves, about, with the curvature where every row counts: its ``rank`` greatest directions, from a
        randomised sketch of two passes, and one for the rest."""
        c = self.c

        def product(matrix: np.ndarray) -> np.ndarray:
            sent = self.rows.sparkSession.sparkContext.broadcast(matrix)

            def work(rows: _LaidOut, y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
                # Of all columns alike: the weights before a fold is left out.
                return rows.summed(2 * c * s.max(axis=1, keepdims=True) * rows.times(sent.value))

            out = self._summed(work, matrix.shape[1])
            sent.destroy()
            return out

        rank = min(rank, self.size + 1)
        q = np.linalg.qr(np.random.default_rng(_SEED).normal(size=(self.size + 1, rank)))[0]
        q = np.linalg.qr(product(q))[0]
        sketch = product(q)
        shift = 1e-10 * np.linalg.norm(sketch) + 1e-300
        sketch += shift * q
        inner = q.T @ sketch
        lower = np.linalg.cholesky((inner + inner.T) / 2)
        u, root, _ = np.linalg.svd(np.linalg.solve(lower, sketch.T).T, full_matrices=False)
        values = np.maximum(root**2 - shift, 0)[:, None] + 1
        return lambda v: values[-1] * (u @ ((u.T @ v) / values)) + v - u @ (u.T @ v)

    def loss_and_slope(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The objective of each column and its gradient."""
        sent, c, n = self.rows.sparkSession.sparkContext.broadcast(w), self.c, w.shape[1]

        def work(rows: _LaidOut, y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            slack = np.maximum(1 - y * rows.times(sent.value), 0)
            index, sums = rows.summed(-2 * c * s * y * slack)
            return np.append(index, ALONE), np.concatenate((sums, c * (s * slack**2).sum(axis=0, keepdims=True)))

        both = self._summed(work, n, 1)
        sent.destroy()
        return 0.5 * (w * w).sum(axis=0) + both[-1], w + both[:-1]

    def curved(self, w: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Products of the curvature at ``w`` with the directions ``p``."""
        sent, c = self.rows.sparkSession.sparkContext.broadcast((w, p)), self.c

        def work(rows: _LaidOut, y: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            w, p = sent.value
            return rows.summed(2 * c * s * (y * rows.times(w) < 1) * rows.times(p))

        out = p + self._summed(work, w.shape[1])
        sent.destroy()
        return out

    def minimised(self, solved: Callable[[np.ndarray], np.ndarray], newton: int = NEWTON, conjugate: int = CONJUGATE, settled: float = SETTLED, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Weights and objective of each column, from ``start`` if there is one; settled is told by the gradient at 0 in either case."""
        w = np.zeros((self.size + 1, len(self.columns.at)))
        loss, slope = self.loss_and_slope(w)
        norm = np.sqrt((slope * solved(slope)).sum(axis=0))
        first = norm.copy()
        if start is not None:
            w = start.copy()
            loss, slope = self.loss_and_slope(w)
        w, loss, slope = self._near(w, loss, slope, solved, max(settled, NEAR) * first)
        norm = np.sqrt((slope * solved(slope)).sum(axis=0))
        for _ in range(newton):
            open_ = norm > settled * first
            if not open_.any():
                break
            # No more exactly than the gradient that is wanted asks for: the rows that count change with the step.
            enough = 0.5 * settled * first / np.maximum(norm, 1e-300)
            step = self._solved(w, slope, solved, open_, conjugate, np.clip(enough, FORCED, 0.9))
            for _ in range(30):  # halved where the objective doesn't fall
                tried, at = self.loss_and_slope(w + step)
                worse = open_ & ~(tried <= loss + 1e-12 * np.abs(loss))
                if not worse.any():
                    break
                step[:, worse] *= 0.5
            w, loss, slope = w + step, tried, at
            norm = np.sqrt((slope * solved(slope)).sum(axis=0))
        return w, loss

    def _near(self, w: np.ndarray, loss: np.ndarray, slope: np.ndarray, solved: Callable[[np.ndarray], np.ndarray], enough: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights, objective and gradient of each column after quasi-Newton steps down to a gradient of ``enough``, or as far as they lead.

        A step is one pass, with the columns that are not there yet, while a Newton step takes one for each product with the curvature.
        """
        w, loss, slope = w.copy(), loss.copy(), slope.copy()
        which, pairs = np.arange(w.shape[1]), []
        for _ in range(QUASI):
            g = slope[:, which]
            going = np.sqrt((g * solved(g)).sum(axis=0)) > enough[which]
            if not going.any():
                break
            if not going.all():
                which, g = which[going], g[:, going]
                pairs = [(s[:, going], y[:, going], r[going]) for s, y, r in pairs]
            step = -_quasi_newton(g, pairs, solved)
            down, share, own = (g * step).sum(axis=0), np.ones(len(which)), self._of(which)
            self.jobs += 1
            for _ in range(20):  # shortened where the objective hardly falls
                tried, at = own.loss_and_slope(w[:, which] + share * step)
                short = ~(tried <= loss[which] + 1e-4 * share * down)
                if not short.any():
                    break
                least = -down * share**2 / np.maximum(2 * (tried - loss[which] - share * down), 1e-300)
                share = np.where(short, np.clip(least, 0.1 * share, 0.5 * share), share)
                self.jobs += 1
            if short.any():
                break  # of no use any more
            move, turn = share * step, at - g
            along = (move * turn).sum(axis=0)
            pairs = [*pairs, (move, turn, np.divide(1.0, along, out=np.zeros_like(along), where=along > 1e-14))][-PAIRS:]
            w[:, which] += move
            loss[which], slope[:, which] = tried, at
        return w, loss, slope

    def _solved(self, w: np.ndarray, slope: np.ndarray, solved: Callable[[np.ndarray], np.ndarray], open_: np.ndarray, conjugate: int, wanted: np.ndarray) -> np.ndarray:
        """Newton step of each open column, up to a residual of ``wanted`` of the gradient."""
        d, r = np.zeros_like(w), np.where(open_, -slope, 0.0)
        p = solved(r)
        rz = (r * p).sum(axis=0)
        goal = wanted**2 * rz
        for _ in range(conjugate):
            going = open_ & (rz > goal)
            if not going.any():
                break
            h = np.zeros_like(p)
            h[:, going] = self._of(going).curved(w[:, going], p[:, going])
            self.jobs += 1
            alpha = np.where(going, rz / np.maximum((p * h).sum(axis=0), 1e-300), 0.0)
            d, r = d + alpha * p, r - alpha * h
            z = solved(r)
            after = (r * z).sum(axis=0)
            p = z + np.where(going, after / np.maximum(rz, 1e-300), 0.0) * p
            rz = np.where(going, after, rz)
        return d


def _quasi_newton(slope: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, np.ndarray]], solved: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The gradient of each column times about the inverse of its curvature, from (step, turn of the gradient, inverse of their product) of the steps before."""
    d, shares = slope.copy(), []
    for s, y, r in reversed(pairs):
        shares.append(r * (s * d).sum(axis=0))
        d -= shares[-1] * y
    d = solved(d)
    if pairs:
        _, y, r = pairs[-1]
        d *= np.where(r > 0, 1 / np.maximum(r * (y * solved(y)).sum(axis=0), 1e-300), 1.0)
    for (s, y, r), share in zip(pairs, reversed(shares), strict=True):
        d += s * (share - r * (y * d).sum(axis=0))
    return d


def mixed(h: np.ndarray) -> np.ndarray:
    """A hash of 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _column_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each index that occurs, its number of entries and the sums of four times 32 bits of hashes of keys and values."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []

    def added() -> None:
        index, sums = np.concatenate([i for i, _ in parts]), np.concatenate([s for _, s in parts])
        order = np.argsort(index, kind="stable")
        found, first = np.unique(index[order], return_index=True)
        parts[:] = [(found, np.add.reduceat(sums[order], first, axis=0))] if len(found) else []

    for batch in batches:
        for part in _slices(batch, 500_000):
            own = _Rows(part)
            key, bits = part.column("key").to_numpy().view(np.uint64)[own.owner], mixed(own.value.view(np.uint64) ^ np.uint64(_SEED))
            both = mixed(key ^ bits), mixed(mixed(key + np.uint64(_SEED)) ^ bits)
            sums = np.stack([np.ones(len(own.index), np.uint64), *(x for h in both for x in (h & np.uint64(0xFFFFFFFF), h >> np.uint64(32)))], axis=1)
            parts.append((own.index, sums.astype(np.int64)))
            added()
    if parts:
        yield pa.record_batch([pa.array(parts[0][0]), *(pa.array(np.ascontiguousarray(c)) for c in parts[0][1].T)], names=["index", "n", "a", "b", "c", "d"])


def merged(rows: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Packed ``rows(id, indices, values, ...)`` where indices with the same values in the same rows are one, ``(index, at, scale)`` of
    each index that occurs, and how many places ``at`` there are.

    Such indices have the same weight in the model of least ``|w|^2``.  One column that is ``scale`` times theirs, the root of how
    many they are, has the same margins and the same ``|w|^2``, with ``scale`` times their weight.  Columns are told
    apart by their numbers of entries and 128 bits of hashes of ids and values, added up: by task first, so that what is moved
    is a row for each index and task.
    """
    spark = rows.sparkSession
    sums = rows.select(F.xxhash64("id").alias("key"), "indices", "values").mapInArrow(_column_sums, "index long, n long, a long, b long, c long, d long")
    columns = sums.groupBy("index").agg(F.struct(*[F.sum(c).alias(c) for c in "nabcd"]).alias("column"))
    alike = Window.partitionBy("column")
    told = columns.select("index", F.min("index").over(alike).alias("first"), F.sqrt(F.count("*").over(alike)).alias("scale"))
    firsts = told.where("index = first").select("first", (F.row_number().over(Window.orderBy("first")) - 1).alias("at"))
    places = written(told.join(firsts, "first").select("index", "at", "scale", (F.col("index") == F.col("first")).alias("kept")), "columns")
    kept = places.where("kept").select("index", "at", "scale").toArrow()  # numbers of each index
    index, at, scale = (kept.column(c).to_numpy() for c in ("index", "at", "scale"))
    table = np.full((2, index.max() + 2 if len(index) else 1), -1.0)  # the last for all behind it
    table[:, index] = at, scale
    sent = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, (to, by) = _Rows(batch), sent.value
            at = np.minimum(own.index, len(to) - 1)
            inside = to[at] >= 0
            moved, sizes = at[inside], np.bincount(own.owner[inside], minlength=own.n)
            new = {"indices": lists(to[moved].astype(np.int32), sizes), "values": lists(own.value[inside] * by[moved], sizes)}
            yield pa.record_batch([new.get(c, batch.column(i)) for i, c in enumerate(batch.schema.names)], names=batch.schema.names)

    return rows.mapInArrow(run, rows.schema), places.select("index", "at", "scale"), len(index)


@dataclass
class Fitted:
    """``coefficients(class, index, weight)`` with the bias at index -1, ``objective(class, objective)``, and
    ``unseen(id, label, weight, class, margin)`` of models that were fitted without the row's fold."""

    coefficients: DataFrame
    objective: DataFrame
    unseen: DataFrame | None
    jobs: int = 0


def fit_svm(entries: DataFrame, labelled: DataFrame, *, size: int, c: float = 1.0, folds: int = 0, rank: int = RANK, newton: int = NEWTON, conjugate: int = CONJUGATE, settled: float = SETTLED) -> Fitted:
    """Models of all classes of ``labelled(id, label, weight)`` over ``entries(id, index, value)`` with indices below ``size``.

    Rows of a fold, by a hash of the id, have margins of models that left it out.  Rows
    without entries have a bias only; entries of other ids are not used.  Classes are
    columns, so their list is read to the driver.  Indices that are alike in all rows are `merged` for the fit and have
    weights of their own after it.  No rows give no models.
    """
    spark = entries.sparkSession
    classes = sorted(r["label"] for r in labelled.select("label").distinct().collect())
    places = spark.createDataFrame(list(enumerate(classes)), "label_at int, label string")
    fold = F.pmod(F.xxhash64("id", F.lit("fold")), F.lit(folds)).cast("int") if folds else F.lit(0)
    rows = labelled.join(F.broadcast(places), "label").select("id", "label", "label_at", F.col("weight").cast("double").alias("weight"), fold.alias("fold"))
    rows, columns, size = merged(written(packed(entries, rows), "rows"))
    slices = laid_out(rows).persist(StorageLevel.MEMORY_AND_DISK)
    at = np.arange(len(classes))
    solver = SquaredHinge(slices, Columns(at, np.full(len(at), -1)), c, size)
    solved = solver.preconditioner(rank)
    full, loss = solver.minimised(solved, newton, conjugate, settled)
    w, jobs = full, solver.jobs
    if folds:
        # Models without a fold begin at that of all rows, which is near them.
        of_folds = SquaredHinge(slices, Columns(np.tile(at, folds), np.repeat(np.arange(folds), len(at))), c, size)
        w = np.concatenate((full, of_folds.minimised(solved, newton, conjugate, settled, np.tile(full, folds))[0]), axis=1)
        jobs += of_folds.jobs
    slices.unpersist()
    index, at = np.nonzero(full)
    table = pa.table([pa.array(at), pa.array(np.where(index == size, BIAS, index)), pa.array(full[index, at])], names=["label_at", "at", "weight"])
    columns = columns.unionByName(spark.createDataFrame([(BIAS, BIAS, 1.0)], "index int, at int, scale double"))
    own = spark.createDataFrame(table).join(columns, "at").select("label_at", F.col("index").cast("int").alias("index"), (F.col("weight") / F.col("scale")).alias("weight"))
    coefficients = own.join(F.broadcast(places), "label_at").select(F.col("label").alias("class"), "index", "weight")
    objective = spark.createDataFrame([(k, float(x)) for k, x in zip(classes, loss, strict=False)], "class string, objective double")
    return Fitted(written(coefficients, "coefficients"), objective, _unseen(rows, w, classes) if folds else None, jobs)


def _unseen(rows: DataFrame, w: np.ndarray, classes: list[str]) -> DataFrame:
    sent, n = rows.sparkSession.sparkContext.broadcast(w), len(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                all_columns = _Rows(part).times(sent.value)
                at = (part.column("fold").to_numpy()[:, None] + 1) * n + np.arange(n)
                own = np.take_along_axis(all_columns, at, axis=1)
                yield pa.record_batch([part.column("id"), part.column("label"), part.column("weight"), lists(own.ravel(), np.full(len(own), n))], names=["id", "label", "weight", "margins"])

    made = rows.select("id", "label", "weight", "fold", "indices", "values").mapInArrow(run, f"id {dict(rows.dtypes)['id']}, label string, weight double, margins array<double>")
    named = F.array(*[F.struct(F.lit(k).alias("class"), F.col("margins")[i].alias("margin")) for i, k in enumerate(classes)])
    return written(made.select("id", "label", "weight", F.explode(named).alias("x")).select("id", "label", "weight", "x.class", "x.margin"), "margins")


def platt(unseen: DataFrame, *, steps: int = 25) -> DataFrame:
    """``(class, a, b)``: the sigmoid ``1 / (1 + exp(-(a * margin + b)))`` of each class that fits ``unseen`` best.

    Weighted cross-entropy against targets (n1 + 1) / (n1 + 2) and 1 / (n0 + 2), so that
    separable classes stay finite; Newton steps, halved while the loss rises.  Each step
    is one aggregate over the margins with five sums for each class.
    """
    spark = unseen.sparkSession
    own = F.col("label") == F.col("class")
    sizes = unseen.groupBy("class").agg(F.sum(F.when(own, F.col("weight")).otherwise(0.0)).alias("n1"), F.sum(F.when(own, 0.0).otherwise(F.col("weight"))).alias("n0"))
    known = {r["class"]: (float(r["n1"]), float(r["n0"])) for r in sizes.collect()}
    fits = {k: (0.0, _log_odds(n1, n0)) for k, (n1, n0) in known.items()}
    moves = dict.fromkeys(known, (0.0, 0.0))
    least: dict[str, float] = {}
    best = dict(fits)
    for _ in range(steps):
        tried = spark.createDataFrame([(k, *fits[k], (n1 + 1) / (n1 + 2), 1 / (n0 + 2)) for k, (n1, n0) in known.items()], "class string, a double, b double, high double, low double")
        x, z = F.col("margin"), F.col("a") * F.col("margin") + F.col("b")
        p, t = 1 / (1 + F.exp(-z)), F.when(own, F.col("high")).otherwise(F.col("low"))
        w, slope = F.col("weight"), F.col("weight") * (p - t)
        curve = w * p * (1 - p)
        # log(1 + exp(z)) - t z without overflow.
        loss = w * (F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - t * z)
        sums = unseen.join(F.broadcast(tried), "class").groupBy("class").agg(*[F.sum(s) for s in (loss, slope * x, slope, curve * x * x, curve * x, curve)]).collect()
        for k, f, ga, gb, haa, hab, hbb in sums:
            if k in least and not f <= least[k]:
                moves[k] = tuple(m / 2 for m in moves[k])
            else:
                least[k], best[k] = f, fits[k]
                haa, hbb = haa + 1e-12, hbb + 1e-12
                det = haa * hbb - hab * hab
                moves[k] = (-(hbb * ga - hab * gb) / det, -(haa * gb - hab * ga) / det) if det > 0 else (0.0, 0.0)
            fits[k] = tuple(b + m for b, m in zip(best[k], moves[k], strict=True))
        if all(abs(m) < 1e-7 for move in moves.values() for m in move):
            break
    return spark.createDataFrame([(k, *map(float, v)) for k, v in sorted(best.items())], "class string, a double, b double")


def _log_odds(n1: float, n0: float) -> float:
    return float(np.log((n1 + 1) / (n0 + 1)))
