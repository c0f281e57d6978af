"""Suffix ranking by the difference-cover algorithm (positions 1 and 2 modulo 3), vectorised; texts of fewer than ``SHORT``
bytes are ranked by names of ever longer prefixes, for which three sorts do."""

from __future__ import annotations

import numpy as np

#: Symbols of one ranking: three names of fewer than this many fit into 63 bits.
MAX_SYMBOLS = 2_500_000


def suffix_ranks(symbols: np.ndarray, depth: int, covered: int = 1) -> np.ndarray:
    """How many suffixes are smaller than each, comparing at least ``depth`` bytes.

    Suffixes that agree in ``depth`` bytes may share a rank; any others are told apart.
    Each symbol stands for ``covered`` bytes.  Triples at positions 1 and 2 modulo 3 are
    sorted and named; names that are not unique, and do not reach the depth, are ranked by
    recursion; positions 0 modulo 3 are ranked by their symbol and the rank behind it, and
    the three classes are merged by counting.
    """
    n = len(symbols)
    if n > MAX_SYMBOLS:
        raise ValueError(f"{n} symbols are more than one ranking takes")
    if covered >= depth or n < 3:
        if covered < depth:
            padded = [tuple(symbols[i:].tolist()) for i in range(n)]
            return np.array([sum(q < p for q in padded) for p in padded], np.int64)
        ordered = np.sort(symbols)
        return np.searchsorted(ordered, symbols)
    padded = np.concatenate((symbols.astype(np.int64) + 1, np.zeros(4, np.int64)))
    radix = int(padded.max()) + 1
    zero, one, two = np.arange(0, n, 3), np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    triples = (padded[sample] * radix + padded[sample + 1]) * radix + padded[sample + 2]
    names, unique = _named(triples)
    ranks = names if unique else suffix_ranks(names, depth, covered * 3)
    behind = np.zeros(n + 4, np.int64)
    behind[sample] = ranks + 1
    width = len(sample) + 2

    def pair(at: np.ndarray) -> np.ndarray:
        return padded[at] * width + behind[at + 1]

    def triple(at: np.ndarray) -> np.ndarray:
        return (padded[at] * radix + padded[at + 1]) * width + behind[at + 2]

    # Every class in its own order; the sampled ones are ranked already.
    sample = sample[np.argsort(ranks)]
    sample = sample[sample < n]
    one, two, zero = sample[sample % 3 == 1], sample[sample % 3 == 2], zero[np.argsort(pair(zero))]
    zero_pair, zero_triple, one_pair, two_triple = pair(zero), triple(zero), pair(one), triple(two)
    sampled, smaller = behind[sample], np.zeros(n, np.int64)
    smaller[zero] = np.searchsorted(zero_pair, zero_pair) + np.searchsorted(one_pair, zero_pair) + np.searchsorted(two_triple, zero_triple)
    smaller[one] = np.searchsorted(sampled, behind[one]) + np.searchsorted(zero_pair, one_pair)
    smaller[two] = np.searchsorted(sampled, behind[two]) + np.searchsorted(zero_triple, two_triple)
    return smaller


def _named(values: np.ndarray) -> tuple[np.ndarray, bool]:
    """The place of each value among the distinct ones, and whether all are distinct."""
    shift = len(values).bit_length()
    if int(values.max()).bit_length() + shift > 63:
        distinct, names = np.unique(values, return_inverse=True)
        return names, len(distinct) == len(names)
    # Value and place in one number sort faster than an index does.
    packed = np.sort((values << shift) | np.arange(len(values)))
    place, value = packed & ((1 << shift) - 1), packed >> shift
    number = np.concatenate(([0], np.cumsum(value[1:] != value[:-1])))
    names = np.empty(len(values), np.int64)
    names[place] = number
    return names, int(number[-1]) + 1 == len(values)


#: Positions of a text from here on take more than 16 bits.
SHORT = 1 << 16


def _short_prefixes(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of fewer than ``SHORT`` bytes in the order of their prefixes, and a number for each that equal ones share.

    Six bytes, and then three names of shorter prefixes that reach over the longer one, make 48 bits, which are sorted
    along with the position.  Prefixes that the end cuts off are in no order that means anything.
    """
    n, names, covered = len(data), data, 1
    while True:
        parts, bits = (6, 8) if covered == 1 else (3, 16)
        reach = min(parts * covered, length)
        padded, key = np.concatenate((names, np.zeros(length, names.dtype))).astype(np.uint64), np.zeros(n, np.uint64)
        for k in range(parts):
            at = min(k * covered, reach - covered)
            key = (key << np.uint64(bits)) | padded[at : at + n]
        packed = np.sort((key << np.uint64(16)) | np.arange(n, dtype=np.uint64))
        place, value = (packed & np.uint64(SHORT - 1)).astype(np.int64), packed >> np.uint64(16)
        number = np.concatenate(([0], np.cumsum(value[1:] != value[:-1])))
        covered = reach
        if covered >= length:
            return place, number
        names = np.empty(n, np.int64)
        names[place] = number


def equal_prefixes(data: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``starts`` in suffix order, and a number for each that equal ``length``-byte prefixes share.

    The starts differ, and each has ``length`` bytes behind it.
    """
    if 0 < len(data) < SHORT:
        place, number = _short_prefixes(data, length)
        wanted = np.zeros(len(data), bool)
        wanted[starts] = True
        own = wanted[place]
        order, number = place[own], number[own]
        new = np.ones(len(order), bool)
        new[1:] = number[1:] != number[:-1]
        return order, np.cumsum(new) - 1
    order = starts[np.argsort(suffix_ranks(data, length)[starts], kind="stable")]
    rows = np.lib.stride_tricks.sliding_window_view(data, length)
    new = np.ones(len(order), bool)
    for at in range(1, len(order), 65536):
        here = order[at : at + 65536]
        new[at : at + len(here)] = (rows[here] != rows[order[at - 1 : at - 1 + len(here)]]).any(axis=1)
    return order, np.cumsum(new) - 1
