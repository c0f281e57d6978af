"""Ordered rules as data, for Spark columns and for SQL text alike.

A rule is a value and a condition in plain SQL over column names; the first rule whose
condition holds gives the value, and an unknown condition is passed over.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

Rules = tuple[tuple[str, str], ...]
#: Condition, text before, SQL of a value (empty for none), text after.
Parts = tuple[tuple[str, str, str, str], ...]


def holds_any(column: str, words: Iterable[str]) -> str:
    """Condition: the text of the column has one of the words in it."""
    return "(" + " OR ".join(f"{column} LIKE '%{w}%'" for w in words) + ")"


def first_match_sql(rules: Rules) -> str:
    return "CASE " + " ".join(f"WHEN {condition} THEN '{value}'" for value, condition in rules) + " END"


def first_match(rules: Rules) -> Column:
    return F.expr(first_match_sql(rules))


def _part_sql(part: tuple[str, str, str, str]) -> str:
    condition, before, value, after = part
    text = f"concat('{before}', CAST({value} AS STRING), '{after}')" if value else f"'{before}{after}'"
    return f"CASE WHEN {condition} THEN {text} END"


def joined_parts_sql(parts: Parts, separator: str = "; ") -> str:
    """The texts whose conditions hold, in order, as one text."""
    return f"concat_ws('{separator}', {', '.join(map(_part_sql, parts))})"


def joined_parts(parts: Parts, separator: str = "; ") -> Column:
    return F.expr(joined_parts_sql(parts, separator))
