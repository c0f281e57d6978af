"""URL filters: pattern rules found through their rarest literal token.

Rules are written as patterns (``*`` any text, ``^`` a separator or the end, ``||`` a
host or subdomain, ``|`` an end) or as host and path (``example.net/en/``).  A rule is
indexed under one literal token that any URL it matches must contain whole: the one that
fewest URLs of the table have.  A URL's tokens fetch its candidate rules from that index,
and only their regular expressions run.  Rules without such a token always run.

The rules are a list in the program, so their index goes to every task, and every URL is
judged where it is read, without a shuffle.  A URL's cost depends on its tokens and on
the rules that they fetch, not on the number of rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOWERED = str.maketrans(_UPPER, _LOWER)


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    kind: str = "pattern"  # or "host"

    @property
    def regex(self) -> str:
        """On ``host + path`` for host rules, on the lower-cased URL for patterns."""
        if self.kind == "host":
            host, _, path = self.text.partition("/")
            return rf"^(?:[^/]*\.)?{re.escape(host)}/{re.escape(path)}"
        body = self.text.lower()
        start = r"^[a-z0-9+.-]+://(?:[^/?#]*\.)?" if body.startswith("||") else "^" if body.startswith("|") else ""
        body = body.lstrip("|")
        end = "$" if body.endswith("|") else ""
        parts = [".*" if c == "*" else "(?:[^a-z0-9_.%-]|$)" if c == "^" else re.escape(c) for c in body.rstrip("|")]
        return start + "".join(parts) + end

    @property
    def tokens(self) -> list[str]:
        """Runs of letters and digits that any match has whole, between other characters."""
        if self.kind == "host":
            host, _, path = self.text.partition("/")
            return re.findall(r"[a-z0-9]+", host) + re.findall(r"(?<![a-z0-9])[a-z0-9]+(?=[^a-z0-9])", "/" + path.lower())
        body = ("|" if self.text.startswith("|") else "*") + self.text.strip("|").lower() + ("|" if self.text.endswith("|") else "*")
        return re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", body)


#: Rules of the query `op1`; the longest that fits decides.
HOST_RULES = (
    Rule("net/", "block", "host"),
    Rule("example.net/en/", "allow", "host"),
    Rule("example.com/de/", "block", "host"),
    Rule("org/fr/", "allow", "host"),
)
#: Patterns for what no host rule decides; a block pattern wins over an allow pattern.
PATTERNS = (
    Rule("||spam-farm.", "block"),
    Rule("||cheap-pills.", "block"),
    Rule("://ads.", "block"),
    Rule("/ads/", "block"),
    Rule("/banner/", "block"),
    Rule("^casino^", "block"),
    Rule("^porn^", "block"),
    Rule("://phishing-", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rarest_tokens(urls: DataFrame, rules: tuple[Rule, ...]) -> dict[Rule, str | None]:
    """Each rule's token that fewest rows of ``urls(url)`` have; None where it has no token.

    Only the rules' own tokens are counted and returned.
    """
    wanted = sorted({t for r in rules for t in r.tokens})
    if not wanted:
        return dict.fromkeys(rules)
    found = F.array_distinct(F.regexp_extract_all(F.translate(F.coalesce("url", F.lit("")), _UPPER, _LOWER), F.lit("[a-z0-9]+"), F.lit(0)))
    # As many rows as the rules in the program have tokens.
    known = F.broadcast(urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string"))
    counts = {r["token"]: r["count"] for r in urls.select(F.explode(found).alias("token")).join(known, "token").groupBy("token").count().collect()}
    return {r: min(r.tokens, key=lambda t: (counts.get(t, 0), t), default=None) for r in rules}


class RuleIndex:
    """Rules by their rarest token, with their expressions compiled."""

    def __init__(self, tokens: dict[Rule, str | None]):
        self.lists: dict[str | None, list[Rule]] = {}
        for rule, token in tokens.items():
            self.lists.setdefault(token, []).append(rule)
        self.compiled: dict[Rule, re.Pattern] = {}

    def candidates(self, lowered: str) -> list[Rule]:
        """The rules whose token a lower-cased URL has, and those without a token."""
        found = list(self.lists.get(None, ()))
        for token in set(re.findall("[a-z0-9]+", lowered)):
            found += self.lists.get(token, ())
        return found

    def fits(self, rule: Rule, lowered: str, place: str) -> bool:
        if rule not in self.compiled:
            self.compiled[rule] = re.compile(rule.regex.replace("$", r"\Z"), re.ASCII)
        return self.compiled[rule].search(place if rule.kind == "host" else lowered) is not None

    def judge(self, url: str, host: str, path: str) -> tuple[str | None, str, str | None]:
        """Host rule, verdict and pattern of a URL."""
        lowered, place = url.translate(_LOWERED), host + path
        # The longest first, then the least text.
        hits = sorted((r for r in self.candidates(lowered) if self.fits(r, lowered, place)), key=lambda r: (-len(r.text), r.text))
        rule = next((r for r in hits if r.kind == "host"), None)
        blocked = next((r for r in hits if r.kind != "host" and r.verdict == "block"), None)
        pattern = blocked or next((r for r in hits if r.kind != "host"), None)
        verdict = rule.verdict if rule else "block" if blocked else "allow"
        return rule and rule.text, verdict, pattern and pattern.text


def filter_urls(pages: DataFrame, host_rules: tuple[Rule, ...] = HOST_RULES, patterns: tuple[Rule, ...] = PATTERNS, *, id_column: str = "page_id") -> DataFrame:
    """``pages(page_id, url)`` -> ``(page_id, host, path, rule, verdict, pattern)``, a row per row.

    The longest host rule that fits decides (of equally long ones the first by text), and
    is returned as ``rule``.  Otherwise a matching block pattern blocks and anything else
    is allowed; ``pattern`` is the longest pattern of the winning kind that matched.
    A null url, or one without ``://``, has an empty host and path, fits no host rule and
    is still matched against the patterns (a null one as the empty string).  Repeated rows
    are judged alike; other columns are not looked at; an empty table gives no rows.
    """
    urls = pages.select(F.col(id_column), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    index = RuleIndex(rarest_tokens(urls.select("url"), (*host_rules, *patterns)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            columns = [part.column(n).to_pylist() for n in ("url", "host", "path")]
            judged = [index.judge(*row) for row in zip(*columns, strict=True)]
            texts = [pa.array([j[k] for j in judged], pa.string()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*(part.column(n) for n in (id_column, "host", "path")), *texts], [id_column, "host", "path", "rule", "verdict", "pattern"])

    out = urls.select("*", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    kind = out.schema[id_column].dataType.simpleString()
    return out.mapInArrow(run, f"`{id_column}` {kind}, host string, path string, rule string, verdict string, pattern string")


def _pattern_case(branch: str) -> str:
    """Longest block pattern of a lower-cased URL ``u``, in DuckDB's regular expressions."""
    own = sorted((r for r in PATTERNS if r.verdict == "block"), key=lambda r: (-len(r.text), r.text))
    return "CASE " + " ".join(f"WHEN regexp_matches(u, '{r.regex}') THEN {branch.format(r.text)}" for r in own) + " END"


#: DuckDB's form of `filter_urls` over `pages`, with the default rules.
ORACLE_SQL = rf"""
WITH cut AS (
  SELECT page_id, translate(coalesce(url, ''), '{_UPPER}', '{_LOWER}') AS u,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule,
    {_pattern_case("'{}'")} AS pattern
  FROM cut)
SELECT page_id, host, path, rule,
       CASE rule WHEN 'net/' THEN 'block' WHEN 'example.com/de/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
            ELSE CASE WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END END AS verdict,
       pattern
FROM ruled
"""
