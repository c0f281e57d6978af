"""Content-chosen anchors of byte strings, vectorised over a batch of texts.

Every window of ``WINDOW`` bytes holds ``WINDOW - GRAM + 1`` grams; the one with the
least hash (the first of equals) is the window's anchor.  Equal windows have equal anchors
at equal places, so windows need only be compared under the same anchor.  Neighbouring
windows mostly share their anchor: about one position in 16 is one.

Where too many contexts have one anchor (a fixed phrase between values that differ), its
windows are told apart by the bytes around it.  The anchor stands 0 to 30 bytes behind the
start of a window; half of these places make a part whose windows have more than the anchor
in common, its core: 35 bytes in a half, 43 in a quarter, all 50 at the last level.  Equal
windows are at one place and have one core, so a part is divided on by nothing but the hash
of its core, alike in every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .common import CHUNK_BYTES
from .hashing import _BYTE, _P, _P_INVERSE, laid_out, mix, powers

_U = np.uint64
WINDOW = 50
GRAM = 20
#: Places of an anchor in its windows, as a power of two, and how often they are halved.
PLACES = 32
LEVELS = 5
#: Slots of the marks of crowded cores, a bit for each and level.
SLOTS = 1 << 20
#: Low bits of a gram's key: its place in the batch.
_PLACE = 26
_tables: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    if base not in _tables or len(_tables[base]) < n:
        _tables[base] = powers(base, max(n, 1 << 21))
    return _tables[base][:n]


def pieces(part: pa.RecordBatch, limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """``(bytes, starts, row, offset)`` of the texts of a slice of `common.chunks`, laid end to end.

    A text longer than ``limit`` comes in pieces that overlap by one byte less than a
    window, so that each of its windows starts in just one of them; ``offset`` is the
    place of a piece in its text.
    """
    column = part.column("text").cast(pa.binary())
    if part.num_rows > 1 or len(column[0].as_py() or b"") <= limit:
        yield *laid_out(column), np.arange(part.num_rows), np.zeros(part.num_rows, np.int64)
        return
    text = column[0].as_py()
    for at in range(0, len(text) - WINDOW + 1, limit):
        yield *laid_out(pa.array([text[at : at + limit + WINDOW - 1]], pa.binary())), np.zeros(1, np.int64), np.array([at])


class RangeHash:
    """Hashes of byte ranges of ``raw``."""

    def __init__(self, raw: np.ndarray):
        self.total = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * _table(_P, len(raw)), out=self.total[1:])
        self.inverse = _table(_P_INVERSE, len(raw) + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.total[end] - self.total[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def core_keys(ranged: RangeHash, anchor: np.ndarray, low: np.ndarray, level: int) -> np.ndarray:
    """Hash of what the windows of a part have in common; the part begins at place ``low``."""
    if not level:
        return ranged(anchor, anchor + GRAM)
    high = np.minimum(low + (PLACES >> level) - 1, WINDOW - GRAM)
    return mix(ranged(anchor - low, anchor - high + WINDOW) + (low + PLACES * level).astype(np.uint64))


def context_hashes(ranged: RangeHash, anchor: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(ranged(first, last + WINDOW) + (anchor - first).astype(np.uint64) * _U(0x9FB21C651E98DF25))


def halves(anchor: np.ndarray, first: np.ndarray, last: np.ndarray, low: np.ndarray, level: int) -> tuple[np.ndarray, ...]:
    """``(from which part, first, last, low)`` of the halves, on ``level``, that have windows."""
    width = PLACES >> level
    split = anchor - low - width
    part = np.tile(np.arange(len(anchor)), 2)
    first, last = np.concatenate((np.maximum(first, split + 1), first)), np.concatenate((last, np.minimum(last, split)))
    low = np.concatenate((low, low + width))
    real = first <= last
    return part[real], first[real], last[real], low[real]


def slots(keys: np.ndarray) -> np.ndarray:
    return ((keys >> _U(12)) & _U(SLOTS - 1)).astype(np.int64)


def _divided(ranged: RangeHash, anchor: np.ndarray, first: np.ndarray, last: np.ndarray, crowded: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """``(from which context, first, last, key)`` of the parts, in the order of the windows."""
    own, low, done = np.arange(len(anchor)), np.zeros(len(anchor), np.int64), []
    for level in range(LEVELS + 1):
        key = core_keys(ranged, anchor[own], low, level)
        on = crowded[level][slots(key)] if level < len(crowded) else np.zeros(len(key), bool)
        done.append((own[~on], first[~on], last[~on], key[~on]))
        if not on.any():
            break
        part, first, last, low = halves(anchor[own[on]], first[on], last[on], low[on], level + 1)
        own = own[on][part]
    own, first, last, key = map(np.concatenate, zip(*done, strict=True))
    order = np.argsort(first, kind="stable")
    return own[order], first[order], last[order], key[order]


def anchors(raw: np.ndarray, starts: np.ndarray, crowded: list[np.ndarray] = []) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(text, anchor, first, last, core hash, context hash)`` of each context or part of one.

    ``crowded`` has, for each level, the marks of the cores whose parts are halved.
    """
    text, anchor, first, last, ranged = contexts(raw, starts)
    if not len(text):
        return text, anchor, first, last, anchor.astype(np.uint64), anchor.astype(np.uint64)
    own, first, last, key = _divided(ranged, anchor, first, last, crowded)
    text, anchor = text[own], anchor[own]
    return text, anchor, first, last, key, context_hashes(ranged, anchor, first, last)


def contexts(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, RangeHash | None]:
    """``(text, anchor, first, last)`` of each anchor, and the hashes of ranges of ``raw``.

    ``first`` to ``last`` are the starts of the windows that have this anchor; the context
    is what they cover, with the anchor's place in it.  ``raw`` holds the texts with one
    separating byte after each; windows across a separator don't count.
    """
    n = len(raw)
    if n < WINDOW or n >= 1 << _PLACE:
        if n >= 1 << _PLACE:
            raise ValueError(f"a batch of {n} bytes is too long for anchors of {_PLACE} bits")
        none = np.zeros(0, np.int64)
        return none, none, none, none, None
    ranged = RangeHash(raw)
    key = (ranged.total[GRAM:] - ranged.total[:-GRAM]) * ranged.inverse[: n - GRAM + 1]
    key ^= key >> _U(32)
    key *= _U(0xD6E8FEB86659FD93)
    key >>= _U(_PLACE)
    key <<= _U(_PLACE)
    key |= np.arange(len(key), dtype=np.uint64)
    # Least key of each run of grams that a window holds, by doubling.
    span, width = WINDOW - GRAM + 1, 1
    while width * 2 <= span:
        key = np.minimum(key[:-width], key[width:])
        width *= 2
    if width < span:
        key = np.minimum(key[: width - span], key[span - width :])
    begin = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    anchor = (key[begin] & _U((1 << _PLACE) - 1)).astype(np.int64)
    text = np.searchsorted(starts, anchor, side="right") - 1
    first = np.maximum(begin, starts[text])
    last = np.minimum(np.concatenate((begin[1:], [len(key)])) - 1, starts[text + 1] - 1 - WINDOW)
    real = (first <= last) & (text < len(starts) - 1)
    text, anchor, first, last = text[real], anchor[real], first[real], last[real]
    return text, anchor, first, last, ranged
