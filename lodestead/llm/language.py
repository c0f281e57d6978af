"""Language identification with hyperdimensional profiles.

Every letter of every script has a +1/-1 vector, drawn from a seeded hash of its code
point.  A trigram is the product of its letters' vectors, each rotated by its place; a
document is the sum of its trigram vectors, and a language the sum of its training
documents.  A document gets the language whose vector has the greatest cosine with its
own.  No letters are merged: a trigram is a number of 63 bits, and vectors are made for
the trigrams at hand, a block at a time.  Language sums are linear in trigram counts, so
each training task turns its own counts into sums of whole numbers, and only those move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, held_out
from .hashing import mix

DIMENSIONS = 512
#: Bits of a code point in a trigram's number; 0 stands for what is between words.
_BITS = 21
#: Trigrams whose vectors are made at once.
BLOCK = 2_048
#: Distinct (language, trigram) counts that a training task holds before it sums them up.
HELD = 500_000
_SEED = np.uint64(0x9FB21C651E98DF25)


def _lower(c: int) -> int:
    """The lower-case code point of a letter, itself if that is not one code point; 0 for anything else."""
    ch = chr(c)
    if not ch.isalpha():
        return 0
    low = ch.lower()
    return ord(low) if len(low) == 1 else c


def letter_table() -> np.ndarray:
    """`_lower` of each code point of the basic plane."""
    return np.array([_lower(c) for c in range(0x10000)], np.uint32)


def _points(texts: list[str | None], lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, 0 for anything else, and the start of each text;
    every text ends with a 0."""
    joined = "".join(f"{t or ''}\0" for t in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.concatenate(([0], np.cumsum([len(t or "") + 1 for t in texts])))
    beyond = np.flatnonzero(points > 0xFFFF)
    out = lower[np.minimum(points, 0xFFFF)]
    if len(beyond):
        distinct, which = np.unique(points[beyond], return_inverse=True)
        out[beyond] = np.array([_lower(c) for c in distinct.tolist()], np.uint32)[which]
    return out, starts


def _trigrams(symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigram numbers in page order and the text of each.  Runs of non-letters are one
    boundary; a trigram has its middle in a word and stays inside one text."""
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    owner = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[keep]
    symbols = np.concatenate(([0], symbols[keep])).astype(np.int64)
    grams = (symbols[:-2] << 2 * _BITS) | (symbols[1:-1] << _BITS) | symbols[2:]
    inside = symbols[1:-1] != 0
    return grams[inside], owner[: len(grams)][inside]


def letter_vectors(points: np.ndarray, dimensions: int) -> np.ndarray:
    """+1/-1 vector of each code point, the same in every process."""
    words = -(-dimensions // 64)
    seeds = mix(points.astype(np.uint64) + _SEED)
    bits = mix(seeds[:, None] + np.arange(1, words + 1, dtype=np.uint64) * _SEED).astype("<u8")
    return np.unpackbits(bits.view(np.uint8), axis=1)[:, :dimensions].astype(np.int8) * np.int8(2) - np.int8(1)


def trigram_vectors(grams: np.ndarray, dimensions: int) -> np.ndarray:
    """+1/-1 vector of each trigram number: its letters' vectors rotated by 2, 1, 0 and bound."""
    mask = (1 << _BITS) - 1
    letters, at = np.unique(np.concatenate((grams >> 2 * _BITS, (grams >> _BITS) & mask, grams & mask)), return_inverse=True)
    vectors = letter_vectors(letters, dimensions)
    first, second, third = np.split(at, 3)
    out = np.roll(vectors, 2, axis=1)[first]
    out *= np.roll(vectors, 1, axis=1)[second]
    out *= vectors[third]
    return out


def _bundle(grams: np.ndarray, counts: np.ndarray, dimensions: int) -> np.ndarray:
    """Sum of the trigrams' vectors, in whole numbers."""
    out = np.zeros(dimensions, np.int64)
    for i in range(0, len(grams), BLOCK):
        # Exact below 2**53.
        out += (counts[i : i + BLOCK].astype(np.float64) @ trigram_vectors(grams[i : i + BLOCK], dimensions).astype(np.float64)).astype(np.int64)
    return out


def _language_sums(lower: np.ndarray, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def added() -> None:
            for name, (grams, counts) in held.items():
                sums[name] = sums.get(name, 0) + _bundle(grams, counts, dimensions)
            held.clear()

        for part in chunks(batches, "text"):
            langs = part.column("lang").to_pylist()
            grams, owner = _trigrams(*_points(part.column("text").to_pylist(), lower))
            names, place = np.unique(np.array(langs, object), return_inverse=True)
            for k, name in enumerate(names):
                own, counts = np.unique(grams[place[owner] == k], return_counts=True)
                if name in held:
                    own, where = np.unique(np.concatenate((held[name][0], own)), return_inverse=True)
                    counts = np.bincount(where, weights=np.concatenate((held[name][1], counts)), minlength=len(own)).astype(np.int64)
                held[name] = own, counts
            if sum(len(g) for g, _ in held.values()) > HELD:
                added()
        added()
        for name, own in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions, pa.string()), pa.array(np.arange(dimensions)), pa.array(own)], ["lang", "place", "n"])

    return run


def _predictions(lower: np.ndarray, names: list[str], prototypes: np.ndarray, unknown: str, carried: list[str]):
    dimensions = prototypes.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            n = part.num_rows
            grams, owner = _trigrams(*_points(part.column("text").to_pylist(), lower))
            has = np.bincount(owner, minlength=n) > 0
            distinct, which = np.unique(grams, return_inverse=True)
            # By block of trigrams, then text, then trigram: every block's vectors are made once.
            pairs, counts = np.unique((which // BLOCK * n + owner) * BLOCK + which % BLOCK, return_counts=True)
            runs = pairs // BLOCK
            edges = np.concatenate(([0], np.flatnonzero(np.diff(runs)) + 1, [len(pairs)])) if len(pairs) else np.zeros(1, np.int64)
            bundles, block = np.zeros((n, dimensions)), -1
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if runs[low] // n != block:
                    block = int(runs[low] // n)
                    vectors = trigram_vectors(distinct[block * BLOCK : (block + 1) * BLOCK], dimensions)
                bundles[runs[low] % n] += counts[low:high].astype(np.float32) @ vectors[pairs[low:high] % BLOCK].astype(np.float32)
            cosines = np.zeros((n, len(names)))
            for i in np.flatnonzero(has):
                cosines[i] = prototypes @ bundles[i] / max(np.linalg.norm(bundles[i]), 1e-9)
            best = cosines.argmax(axis=1) if names else np.zeros(n, int)
            yield pa.RecordBatch.from_arrays(
                [
                    *(part.column(c) for c in carried),
                    pa.array([names[b] if names and h else unknown for b, h in zip(best, has, strict=True)], pa.string()),
                    pa.array([float(min(1.0, max(0.0, c[b]))) if names and h else 0.0 for c, b, h in zip(cosines, best, has, strict=True)], pa.float64()),
                ],
                [*carried, "lang_pred", "score"],
            )

    return run


def language_profiles(training: DataFrame, dimensions: int = DIMENSIONS) -> tuple[list[str], np.ndarray]:
    """Languages and unit vector of each, from all of ``training(text, lang)``.  Only
    languages x ``dimensions`` numbers reach the driver."""
    sums = training.mapInArrow(_language_sums(letter_table(), dimensions), "lang string, place long, n long").groupBy("lang", "place").agg(F.sum("n").alias("n")).collect()
    names = sorted({r["lang"] for r in sums})
    number = {name: k for k, name in enumerate(names)}
    prototypes = np.zeros((len(names), dimensions))
    for r in sums:
        prototypes[number[r["lang"]], r["place"]] = r["n"]
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    return names, prototypes


def identify_languages(documents: DataFrame, training: DataFrame | None = None, *, carry: tuple[str, ...] = (), dimensions: int = DIMENSIONS, unknown: str = "und") -> DataFrame:
    """``documents(doc_id, text, lang)`` -> ``(doc_id, held_out, lang_pred, score)``, a row per row,
    with the columns named in ``carry`` before the answer.  A row with a null doc_id is not
    held out and is learned from.

    The profiles are learned from all of ``training`` (default: the rows of ``documents``
    that are not held out) whose ``lang`` is not null.  A null text, or one without a
    letter, gets ``unknown`` and score 0, as does every text where nothing was learned;
    the score of the others is the cosine with the language's vector, at least 0.  Equal
    texts get equal answers whatever their id; a tie goes to the first language by name.
    Other columns are not looked at; an empty table gives no rows.
    """
    learn = documents.where(~held_out("doc_id")) if training is None else training
    learn = learn.where("lang is not null and text is not null").select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    names, prototypes = language_profiles(learn, dimensions)
    rows = documents.select("doc_id", held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"), *(c for c in carry if c not in ("doc_id", "text")))
    carried = [c for c in rows.columns if c != "text" or "text" in carry]
    kinds = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in carried)
    return rows.mapInArrow(_predictions(letter_table(), names, prototypes, unknown, carried), f"{kinds}, lang_pred string, score double")
