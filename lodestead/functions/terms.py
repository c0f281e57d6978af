"""Counting terms of any number in one pass over a text, as column expressions.

A text is cut into words and what stands between them.  Terms lie in a constant hash table
under their first word, an array of small arrays, so a word finds the terms that begin with
it in constant time; only those are compared with the pieces that follow.  This finds what
the expression ``\\b(?:term|term|...)\\b``, longest terms first, finds, and costs the same for
ten terms or ten thousand.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_PIECE = r"\w+|\W+"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def term_index(terms: Mapping[str, Sequence[str]]) -> tuple[str, int]:
    """SQL of the hash table, which the optimiser folds into a constant, and its number of buckets.

    A bucket holds ``(list, pieces, term)``; a term has to begin and end with a word.
    """
    entries = [(k, t) for k, own in enumerate(terms.values()) for t in dict.fromkeys(own)]
    size = 1 << max(4, (2 * len(entries)).bit_length())
    buckets: list[list[str]] = [[] for _ in range(size)]
    for k, term in entries:
        pieces = re.findall(_PIECE, term, re.ASCII)
        if not pieces or not re.match(r"\w", pieces[0], re.ASCII) or not re.match(r"\w", pieces[-1], re.ASCII):
            raise ValueError(f"a term has to begin and end with a word: {term!r}")
        own = f"named_struct('list', {k}, 'pieces', array({', '.join(map(_quoted, pieces))}), 'term', {_quoted(term)})"
        buckets[zlib.crc32(pieces[0].encode()) % size].append(own)
    none = "cast(array() as array<struct<list: int, pieces: array<string>, term: string>>)"
    return f"array({', '.join(f'array({chr(44).join(b)})' if b else none for b in buckets)})", size


def term_matches(low: Column, terms: Mapping[str, Sequence[str]]) -> Column:
    """Array of ``(list, at, size, term)`` of what each list of terms matches in a lower-case text.

    Matches of one list don't overlap: the leftmost counts, and of several at one place the
    longest.  ``at`` is the place among the text's pieces.  Most words begin no term, so they are told by a set of
    first words before the table is asked.
    """
    sql, size = term_index(terms)
    table = F.expr(sql)
    firsts = sorted({re.match(_PIECE, t, re.ASCII).group() for own in terms.values() for t in own})

    def found(pieces: Column) -> Column:
        def at(piece: Column, i: Column) -> Column:
            bucket = table[F.pmod(F.crc32(piece.cast("binary")), F.lit(size)).cast("int")]
            same = F.filter(bucket, lambda e: (e["pieces"][0] == piece) & ((F.size(e["pieces"]) == 1) | (F.slice(pieces, i + 1, F.size(e["pieces"])) == e["pieces"])))
            return F.transform(same, lambda e: F.struct(e["list"].alias("list"), i.alias("at"), (-F.size(e["pieces"])).alias("minus"), e["term"].alias("term")))

        # In order of list, place and length; a match that begins inside the one before of its list goes.
        places = F.array_compact(F.transform(pieces, lambda piece, i: F.when(piece.isin(firsts), i)))
        all_ = F.array_sort(F.flatten(F.transform(places, lambda i: at(pieces[i], i))))
        kind = "array<struct<list: int, at: int, size: int, term: string>>"

        def kept(held: Column, m: Column) -> Column:
            last = F.try_element_at(held, F.lit(-1))
            taken = F.coalesce((last["list"] == m["list"]) & (m["at"] < last["at"] + last["size"]), F.lit(False))
            return F.when(taken, held).otherwise(F.concat(held, F.array(F.struct(m["list"].alias("list"), m["at"].alias("at"), (-m["minus"]).alias("size"), m["term"].alias("term")))))

        return F.aggregate(all_, F.array().cast(kind), kept)

    # A one-element transform names the pieces, so that the text is cut once.
    return F.transform(F.array(F.regexp_extract_all(low, F.lit(_PIECE), F.lit(0))), found)[0]


def counts(matches: Column, terms: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Matches of each list."""

    def of(k: int) -> Column:
        return F.size(F.filter(matches, lambda m: m["list"] == k))

    return {name: of(k) for k, name in enumerate(terms)}
