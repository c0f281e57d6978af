"""Vectorised hashing of words and word shingles over a batch of UTF-8 texts.

A batch is laid end to end in one byte array.  The hash of a byte range comes from a
prefix sum of ``byte value * P**i`` modulo 2**64 times the inverse power of its start,
so the hashes of all words of a batch take a handful of numpy operations.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_P = 0x9E3779B97F4A7C15
_P_INVERSE = pow(_P, -1, 2**64)
#: Random value of each byte.
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
#: White space of `[^\x20\x09-\x0D]+`, and bytes outside `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_ALNUM = np.zeros(256, dtype=bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the 64 output bits."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def laid_out(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, each followed by one NUL-free separator (a space), and the
    offset at which each text starts; nulls count as empty."""
    texts = [t if t is not None else b"" for t in column.cast(pa.binary()).to_pylist()]
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))
    return np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8), starts


def word_spans(raw: np.ndarray, starts: np.ndarray, outside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and text number of each word (maximal run of bytes not ``outside``)."""
    inside = ~outside[raw]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return first, end, np.searchsorted(starts, first, side="right") - 1


def word_hashes(raw: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word with A-Z lower-cased."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[_LOWER[raw]] * powers(_P, len(raw)), dtype=np.uint64)))
    return mix((total[end] - total[first]) * powers(_P_INVERSE, len(raw) + 1)[first])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, whatever text they belong to."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * _U(0xD6E8FEB86659FD93) + words[k : k + n]
    return mix(out + _U(size))


def text_shingles(column: pa.Array, size: int, outside: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each text's begin.

    A text of fewer than ``size`` words, but at least one, has its whole word sequence as
    its only shingle; a text without words has none.
    """
    raw, starts = laid_out(column)
    first, end, owner = word_spans(raw, starts, outside)
    words = word_hashes(raw, first, end)
    n = len(starts) - 1
    counts = np.bincount(owner, minlength=n)
    begin = np.concatenate(([0], np.cumsum(counts)))
    hashes = window_hashes(words, size)
    whole = owner[: len(hashes)] == owner[size - 1 :] if len(hashes) else np.zeros(0, bool)
    hashes, owners = hashes[whole], owner[: len(whole)][whole]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        alone = np.array([window_hashes(words[begin[i] : begin[i + 1]], counts[i])[0] for i in short], np.uint64)
        hashes, owners = np.concatenate((hashes, alone)), np.concatenate((owners, short))
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    if len(hashes):
        new = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])))
        hashes, owners = hashes[new], owners[new]
    return hashes, np.concatenate(([0], np.cumsum(np.bincount(owners, minlength=n))))
