"""Benchmark decontamination by a prefix-filtered join of word shingles.

A benchmark item is cut into windows of ``WINDOW`` consecutive words.  A window occurs
in a document exactly if all its shingles do, in place, so one shingle of each window is
enough to find it: the rarest, counted over all documents.  Documents are read once to
count the windows' shingles and once to look up those rarest ones; a shingle found in a
document offers the windows that need it at the only place where they could lie, which
must be inside the text and is then compared word by word.

The windows are handled in blocks of at most ``BLOCK`` windows, so what is sent to the
executors is bounded whatever the benchmark's size; every block meets every document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, written
from .hashing import _LOWER, NOT_ALNUM, laid_out, window_hashes, word_hashes, word_spans

WINDOW = 10
SHINGLE = 3
#: Windows that are sent to executors at once.
BLOCK = 200_000


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    raw, starts = laid_out(column)
    raw = _LOWER[raw]
    first, end, owner = word_spans(raw, starts, NOT_ALNUM)
    return raw, first, end, owner, len(starts) - 1


def _windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            raw, first, end, owner, n = _words(part.column("text"))
            data, begin = raw.tobytes(), np.searchsorted(owner, np.arange(n + 1))
            items, windows = [], []
            for i, item in enumerate(part.column("item_id").to_pylist()):
                words = [data[a:b] for a, b in zip(first[begin[i] : begin[i + 1]], end[begin[i] : begin[i + 1]], strict=True)]
                own = {b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()
                items += [item] * len(own)
                windows += own
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(windows, pa.binary())], ["item_id", "words"])

    return run


@dataclass
class _Block:
    """Distinct windows of a block, their shingles and, once chosen, the rarest of each."""

    items: list[list[str]]
    words: list[bytes]
    lengths: np.ndarray
    hashes: np.ndarray
    #: For each shingle size: sorted shingle hashes of the windows that use it.
    tokens: dict[int, np.ndarray]
    #: Of each window: hashes of its shingles in order.
    own: list[np.ndarray]

    def chosen(self, counts: dict[int, dict[int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each shingle size: rarest shingle, its place, and the window, by shingle."""
        picked: dict[int, list[tuple[int, int, int]]] = {}
        for k, own in enumerate(self.own):
            size = min(SHINGLE, int(self.lengths[k]))
            seen = counts.get(size, {})
            at = min(range(len(own)), key=lambda i: (seen.get(int(own[i].view(np.int64)), 0), int(own[i])))
            picked.setdefault(size, []).append((int(own[at]), at, k))
        out = {}
        for size, rows in picked.items():
            rows.sort()
            out[size] = (np.array([r[0] for r in rows], np.uint64), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
        return out


def _block(rows: list) -> _Block:
    words = [bytes(r["words"]) for r in rows]
    hashed, own, tokens = [], [], {}
    for w in words:
        raw = np.frombuffer(w, np.uint8)
        first, end, _ = word_spans(raw, np.array([0, len(raw)]), NOT_ALNUM)
        h = word_hashes(raw, first, end)
        hashed.append(window_hashes(h, len(h))[0])
        size = min(SHINGLE, len(h))
        own.append(window_hashes(h, size))
        tokens.setdefault(size, []).append(own[-1])
    lengths = np.array([w.count(b" ") + 1 for w in words])
    return _Block([sorted(r["items"]) for r in rows], words, lengths, np.array(hashed, np.uint64), {s: np.unique(np.concatenate(t)) for s, t in tokens.items()}, own)


def _shingle_counts(tokens: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {size: np.zeros(len(t), np.int64) for size, t in tokens.items()}
        for part in chunks(batches, "text"):
            raw, first, end, owner, _ = _words(part.column("text"))
            words = word_hashes(raw, first, end)
            for size, known in tokens.items():
                found = window_hashes(words, size)[owner[: max(0, len(words) - size + 1)] == owner[size - 1 :]]
                at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                total[size] += np.bincount(at[known[at] == found], minlength=len(known))
        for size, n in total.items():
            seen = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), size)), pa.array(tokens[size][seen].view(np.int64)), pa.array(n[seen])], ["size", "token", "n"])

    return run


def _hits(block: _Block, prefix: dict, answer: list[str] | None = None):
    """Adds a block's occurrences to the columns ``hits`` (word ranges) and ``items``; for the
    last block the rows become the answer, with the columns in ``answer`` first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            raw, first, end, owner, n = _words(part.column("text"))
            data, words = raw.tobytes(), word_hashes(raw, first, end)
            begin = np.searchsorted(owner, np.arange(n + 1))
            ranges: list[set] = [set(map(tuple, np.frombuffer(h, np.int64).reshape(-1, 2).tolist())) for h in part.column("hits").to_pylist()]
            items = [set(x) for x in part.column("items").to_pylist()]
            for size, (tokens, places, numbers) in prefix.items():
                found = window_hashes(words, size)
                low, high = np.searchsorted(tokens, found, "left"), np.searchsorted(tokens, found, "right")
                at = np.flatnonzero(high > low)
                many = (high - low)[at]
                entry = np.repeat(low[at], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                window, start = numbers[entry], np.repeat(at, many) - places[entry]
                length = block.lengths[window]
                fits = (start >= 0) & (start + length <= len(words))
                window, start, length = window[fits], start[fits], length[fits]
                fits = owner[start] == owner[start + length - 1]
                for w, s, k in zip(window[fits].tolist(), start[fits].tolist(), length[fits].tolist(), strict=True):
                    if block.words[w] == b" ".join([data[a:b] for a, b in zip(first[s : s + k], end[s : s + k], strict=True)]):
                        doc = int(owner[s])
                        ranges[doc].add((s - int(begin[doc]), k))
                        items[doc].update(block.items[w])
            columns = {name: part.column(name) for name in part.schema.names}
            columns["n_words"] = pa.array(np.diff(begin).astype(np.int64))
            columns["hits"] = pa.array([np.array(sorted(r), np.int64).tobytes() for r in ranges], pa.binary())
            columns["items"] = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
            found = pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
            yield found if answer is None else _digested(found, answer)

    return run


def _digested(part: pa.RecordBatch, carried: list[str]) -> pa.RecordBatch:
    covered = []
    for hits in part.column("hits").to_pylist():
        done = total = 0
        for start, length in np.frombuffer(hits, np.int64).reshape(-1, 2).tolist():
            total += max(0, start + length - max(done, start))
            done = max(done, start + length)
        covered.append(total)
    items = part.column("items").to_pylist()
    return pa.RecordBatch.from_arrays(
        [
            *(part.column(c) for c in carried),
            part.column("n_words"),
            pa.array(covered, pa.int64()),
            pa.array([len(x) for x in items], pa.int64()),
            pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
            pa.array([c > 0 for c in covered]),
            part.column("items"),
        ],
        [*carried, "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"],
    )


def benchmark_hits(documents: DataFrame, benchmark: DataFrame, *, carry: tuple[str, ...] = (), window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Words of each document inside an occurrence of a benchmark window.

    ``documents(doc_id, text)`` and ``benchmark(item_id, text)`` give ``(doc_id, n_words,
    n_hit, n_items, items_sha256, contaminated, items)``, a row per document row, with the
    columns named in ``carry`` after ``doc_id``.  Words are runs of digits, letters and non-ASCII characters with A-Z lower-cased.  An item of
    fewer words than a window is one window; null or wordless texts have no words and no
    windows, so they hit nothing.  Items with equal texts all count; a null item_id counts
    as the empty string; ``items`` and its digest are sorted by bytes, and the digest of
    no items is that of the empty string.  Repeated document rows are answered alike.
    Other columns are not looked at; empty tables are fine.
    """
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text"), *(c for c in carry if c not in ("doc_id", "text")))
    carried = [c for c in rows.columns if c != "text" or "text" in carry]
    cut = (
        benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_windows(window), "item_id string, words binary")
        .groupBy("words").agg(F.collect_set("item_id").alias("items"))
    )
    cut = written(cut, "windows")
    blocks = max(1, -(-cut.count() // block))
    kinds = {c: f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns}
    schema = f"{', '.join(kinds.values())}, n_words long, hits binary, items array<string>"
    state = rows.select("*", F.lit(0).cast("long").alias("n_words"), F.lit(b"").alias("hits"), F.array().cast("array<string>").alias("items"))
    for k in range(blocks):
        own = _block(cut.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == k).collect())
        counts: dict[int, dict[int, int]] = {}
        for r in rows.select("text").mapInArrow(_shingle_counts(own.tokens), "size long, token long, n long").groupBy("size", "token").agg(F.sum("n").alias("n")).collect():
            counts.setdefault(r["size"], {})[r["token"]] = r["n"]
        if k + 1 < blocks:
            state = written(state.mapInArrow(_hits(own, own.chosen(counts)), schema), "hits")
    answer = f"{', '.join(kinds[c] for c in carried)}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>"
    return state.mapInArrow(_hits(own, own.chosen(counts), carried), answer)


#: DuckDB's form of `benchmark_hits` over `documents` and `benchmark`, without the items.
ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
places AS (
  SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
hits AS (SELECT p.rid, p.i, p.n, x.item_id FROM places p JOIN windows x ON x.n = p.n AND x.s = p.s),
covered AS (SELECT rid, count(DISTINCT k) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT rid, i, n FROM hits)) GROUP BY rid),
items AS (SELECT rid, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS list FROM hits GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items, sha256(coalesce(i.list, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON c.rid = d.rid LEFT JOIN items i ON i.rid = d.rid
"""
