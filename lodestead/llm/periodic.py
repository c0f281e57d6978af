"""Runs of periodic words, by seeds that are extended along diagonals.

A run of period q and length n repeats its words at lag q over n - q >= max(q, 12 - q)
places.  So for lags from k to 2k - 1 (k = 12, 24, 48, ...), and for lags under 12 with
k = 6, every run holds a k-gram that occurs again at its lag.

1. Occurrences of k-grams are indexed by document; a k-gram that occurs once in its
   document leaves the index for this and all longer grams.
2. Pairs of occurrences at the level's lags are seeds.  k-grams of period k/4 or less lie
   in runs that are known by then: of those, pairs without the first gram of a run
   are left out, since a diagonal's first match has one (or stays in one run, where
   it is a multiple of that run's period).  Other k-grams have at most eight partners.
3. A table of how far each lag is covered suppresses seeds on a diagonal that has been
   extended; others are extended left and right, word by word.

Every level costs time in proportion to the words, and there are as many levels as
doublings.  A document's words become numbers in pieces, so a long text needs some
tens of bytes a word; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, crc32_sql

LEAST = 12
FIRST_GRAM = LEAST // 2
#: Bytes of a text that are cut into words at once.
PIECE = 1_000_000
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
RUN = "struct<start: bigint, length: bigint, period: bigint>"


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, a piece at a time; no word is parted."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            space = _SPACE.search(text, end)
            end = space.start() if space else len(text)
        yield text[at:end].split()
        at = end


def word_numbers(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word of all texts, different between texts, and where each text's begin."""
    numbers, starts, base = [np.zeros(0, np.int64)], [0], 0
    for text in texts:
        known: dict[bytes, int] = {}
        size = 0
        for words in _pieces(text):
            numbers.append(np.fromiter((known.setdefault(w, base + len(known)) for w in words), np.int64, len(words)))
            size += len(words)
        base += len(known)
        starts.append(starts[-1] + size)
    return np.concatenate(numbers), np.array(starts, np.int64)


def _named(first: np.ndarray, second: np.ndarray, apart: int) -> np.ndarray:
    """Numbers of the grams made of a gram and the one ``apart`` places on; -1 where it occurs once."""
    n = max(0, len(first) - apart)
    at = np.flatnonzero((first[:n] >= 0) & (second[apart : apart + n] >= 0))
    out = np.full(len(first), -1, np.int64)
    if len(at):
        _, which, count = np.unique(first[at] * (int(second.max()) + 1) + second[at + apart], return_inverse=True, return_counts=True)
        again = count[which] > 1
        out[at[again]] = which[again]
    return out


def _pairs(name: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` of all pairs of equal grams among the places whose lag is from low to high - 1."""
    order = np.argsort(name[at], kind="stable")
    name, at = name[at][order], at[order]
    places, lags = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for step in range(1, len(at)):
        lag = at[step:] - at[:-step]
        near = (name[step:] == name[:-step]) & (lag < high)
        if not near.any():
            break
        near &= lag >= low
        places.append(at[:-step][near])
        lags.append(lag[near])
    return np.concatenate(places), np.concatenate(lags)


def _head_pairs(name: np.ndarray, heads: np.ndarray, last: np.ndarray, at: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` of the pairs of a head with an equal gram before it, or after ``last``, where its run's grams end."""
    order = np.argsort(name[at], kind="stable")
    at = at[order]
    width = len(name) + 1
    key = name[at] * width + at  # sorted
    of = name[heads] * width
    places, lags = [], []
    for begin, end in ((np.maximum(heads + low, last + 1), heads + high), (np.maximum(heads - high + 1, 0), np.maximum(heads - low + 1, 0))):
        left, right = np.searchsorted(key, of + np.minimum(begin, width - 1)), np.searchsorted(key, of + np.minimum(end, width - 1))
        count = np.maximum(right - left, 0)
        other = at[np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
        head = np.repeat(heads, count)
        places.append(np.minimum(head, other))
        lags.append(np.abs(head - other))
    return np.concatenate(places), np.concatenate(lags)


def _same(words: np.ndarray, at: int, lag: int, step: int, low: int, high: int) -> int:
    """How many words from ``at`` on, in the direction of ``step``, equal those ``lag`` further."""
    total, width = 0, 16
    while True:
        n = min(width, (high - lag - at) if step > 0 else (at - low + 1))
        if n <= 0:
            return total
        a = words[at : at + n] if step > 0 else words[at - n + 1 : at + 1][::-1]
        b = words[at + lag : at + lag + n] if step > 0 else words[at + lag - n + 1 : at + lag + 1][::-1]
        unequal = a != b
        if unequal.any():
            return total + int(unequal.argmax())
        total, at, width = total + n, at + step * n, width * 2


def find_runs(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``(start, end, period)`` of all runs, by start and period, over texts laid end to end."""
    found: dict[tuple[int, int], int] = {}  # a stretch and its least period, since lags are tried in rising order of level
    n = len(words)
    name = words.copy()
    name[np.bincount(words)[words] < 2] = -1
    two = _named(name, name, 1)
    four = _named(two, two, 2)
    name, k = _named(four, two, 4), FIRST_GRAM
    while (name >= 0).any():
        low, high = (1, 2 * k) if k == FIRST_GRAM else (k, 2 * k)
        at, inner, heads = np.flatnonzero(name >= 0), np.zeros(n + 1, np.int64), {}
        for (s, e), q in found.items() if k > FIRST_GRAM else ():
            if 4 * q <= k <= e - s:
                inner[s] += 1
                inner[e - k + 1] -= 1
                if name[s] >= 0:
                    heads[s] = max(e - k, heads.get(s, 0))
        inner = np.cumsum(inner)[:n] > 0
        place, lag = _pairs(name, at[~inner[at]], low, high)
        if heads:
            more, lags = _head_pairs(name, np.array(list(heads), np.int64), np.array(list(heads.values()), np.int64), at[inner[at]], low, high)
            place, lag = np.concatenate((place, more)), np.concatenate((lag, lags))
        order = np.lexsort((place, lag))
        place, lag = place[order], lag[order]
        # The second of two neighbouring seeds on one diagonal is always covered by the first.
        first = np.ones(len(place), bool)
        first[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + 1)
        covered: dict[int, int] = {}
        for i, p in zip(place[first].tolist(), lag[first].tolist(), strict=True):
            if i < covered.get(p, 0):
                continue
            text = int(np.searchsorted(starts, i, side="right"))
            begin, end = int(starts[text - 1]), int(starts[text])
            s = i - _same(words, i - 1, p, -1, begin, end)
            e = i + k + _same(words, i + k, p, 1, begin, end)
            covered[p] = e
            if e - s >= max(p, LEAST - p):
                found[s, e + p] = min(p, found.get((s, e + p), p))
        name, k = _named(name, name, k), 2 * k
    return np.array(sorted((s, e, q) for (s, e), q in found.items()), np.int64).reshape(-1, 3)


def _collapsed(text: bytes, dropped: np.ndarray) -> bytes:
    """The words that are not dropped, joined by one space."""
    kept, at = [], 0
    for words in _pieces(text):
        mask = dropped[at : at + len(words)]
        some = [w for w, d in zip(words, mask.tolist(), strict=True) if not d] if mask.any() else words
        if some:
            kept.append(b" ".join(some))
        at += len(words)
    return b" ".join(kept)


def periodic_runs(docs: DataFrame, text: str = "text", *, carry: tuple[str, ...] = ()) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id``, ``runs`` and ``collapsed`` for each row.

    A run is a stretch of words `[^\\x20\\x09-\\x0D]+` with least period ``period``, a length
    of at least 12 and of twice the period, that no neighbouring word extends; ``start``
    counts words from 0.  ``runs`` are in order of start, then period.  ``collapsed`` is the text
    without the words that a run holds after its first period, joined by one space.

    A null or empty text has no words, no runs and an empty ``collapsed``.  Null and repeated
    doc_ids are rows like others; columns named in ``carry`` are kept, others not looked at.
    An empty table gives no rows.
    """
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    kept = ["doc_id", *carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "content"):
            texts = [t or b"" for t in part.column("content").to_pylist()]
            words, starts = word_numbers(texts)
            runs = find_runs(words, starts)
            owner = np.searchsorted(starts, runs[:, 0], side="right") - 1
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 1], -1)
            dropped = np.cumsum(change)[:-1] > 0
            collapsed = [_collapsed(t, dropped[starts[i] : starts[i + 1]]) for i, t in enumerate(texts)]
            fields = pa.StructArray.from_arrays([pa.array(runs[:, 0] - starts[owner]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)), fields)
            yield pa.record_batch([*(part.column(c) for c in kept), lists, pa.array(collapsed, pa.binary())], names=[*kept, "runs", "collapsed"])

    given = docs.select(*kept, F.col(text).cast("string").cast("binary").alias("content"))
    found = given.mapInArrow(run, f"{', '.join(f'`{c}` {kinds[c]}' for c in kept)}, runs array<{RUN}>, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted(doc_id: Column, text: Column) -> Column:
    """The text with its words from some place on replaced by repeats of the first of them, for a tenth of the ids.

    With h the crc32 of the decimal id and g = floor(h / 10): where h % 10 = 0, each word
    i >= a of n becomes word a + (i - a) % p, a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def repeated(words: Column, g: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        return F.concat(F.slice(words, F.lit(1), a), F.slice(F.flatten(F.array_repeat(F.slice(words, a + 1, p), times)), F.lit(1), n - a))

    # A one-element transform names the words, so that they are cut out once.
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, F.array_join(repeated(w, F.floor(h / 10)), " ")).otherwise(text))[0]
    return F.when(F.coalesce(h % 10 == 0, F.lit(False)), made).otherwise(text)


def run_digests(found: DataFrame) -> DataFrame:
    """The longest run of each row and digests of its runs and its collapsed text."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("size"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.size")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(F.lit(-1000) * F.col("longest.size") / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


ORACLE_SQL = rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words, {crc32_sql("doc_id")} AS h FROM documents),
sized AS (SELECT doc_id, words, h, len(words) AS n, h // 10 AS g FROM split),
cut AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a, CASE WHEN n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM sized),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN [words[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] for i in range(0, n)] ELSE words END AS words
  FROM cut),
grams AS (
  SELECT doc_id, i, array_to_string(words[i + 1 : i + 6], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(0, n - 5)) AS i FROM texts WHERE n >= 12)),
pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS lag FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.gram = y.gram AND x.i < y.i),
islands AS (SELECT doc_id, lag, i, i - row_number() OVER (PARTITION BY doc_id, lag ORDER BY i) AS island FROM pairs),
stretches AS (
  SELECT doc_id, lag, min(i) AS s, count(*) + 5 AS matched FROM islands GROUP BY doc_id, lag, island HAVING count(*) + 5 >= greatest(lag, 12 - lag)),
runs AS (SELECT doc_id, s AS start, matched + lag AS length, min(lag) AS period FROM stretches GROUP BY doc_id, s, matched + lag),
told AS (
  SELECT doc_id, count(*) AS n_runs, min((-length, start, period)) AS longest,
         string_agg(CAST(start AS VARCHAR) || ',' || CAST(length AS VARCHAR) || ',' || CAST(period AS VARCHAR) || chr(10), '' ORDER BY start, period) AS lines
  FROM runs GROUP BY doc_id),
dropped AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS collapsed
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(0, n)) AS i FROM texts) w ANTI JOIN dropped d ON d.doc_id = w.doc_id AND d.i = w.i
  GROUP BY w.doc_id)
SELECT t.doc_id, coalesce(r.n_runs, 0) AS n_runs, r.longest[2] AS start, -r.longest[1] AS length, r.longest[3] AS period,
       CAST(-1000 * r.longest[1] // r.longest[3] AS BIGINT) AS exponent_milli, sha256(coalesce(r.lines, '')) AS runs_sha256, sha256(coalesce(k.collapsed, '')) AS collapsed_sha256
FROM texts t LEFT JOIN told r ON r.doc_id = t.doc_id LEFT JOIN kept k ON k.doc_id = t.doc_id
"""
