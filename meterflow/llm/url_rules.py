"""URL filters: pattern rules indexed by their rarest literal token.

A rule is a pattern: literal text, ``*`` for any run of characters, ``^`` for
a separator or the end. Patterns match whole tokens (runs of letters and
digits) of the normalised URL ``host + path``; a pattern that starts with
``||`` matches at the host's start or behind one of its dots. Each rule is
filed under that of its literal tokens that the fewest URLs contain; a URL
runs only the rules filed under its own tokens. Of the host rules that match,
the longest decides; without one, a matching block pattern blocks, and all
else is allowed.

Defined cases: a null URL or one without ``://`` has empty host and path and
is allowed without a rule; repeated rows are judged each; an empty table gives
an empty result; ties of length go to the rule listed first.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): fixed values.
HOST_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]

#: What is blocked where no host rule fits.
BLOCK_PATTERNS = [
    "||casino", "casino-", "-casino", "||poker", "free-bets", "bets.", "||slots.", "-pills", "pills-", "cheap-pills",
    "viagra", "porn", "||xxx", "/xxx/", "||sex.", "escort", "ads-track", "||ads.", "/ads/", "adserver", "doubleclick",
    "/banner/", "/banners/", "popunder", "||tracker.", "/track/*pixel", "malware", "phishing", "warez", "keygen^",
    "payday-loan", "payday-loans",
]

_TOKEN = re.compile("[a-z0-9]+")
_UPPER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_SPLIT = re.compile(r".*?://([^/?#]*)([^?#]*)", re.S)


@dataclass(frozen=True)
class Rule:
    """``name`` and a positive ``length`` for host rules; neither for patterns."""

    verdict: str
    pattern: str
    name: str | None = None
    length: int = 0

    def regex(self) -> str:
        """The pattern as a regular expression over host + path, without look-around."""
        body, rest = self.pattern, ""
        head = "(?:^|[^a-z0-9])" if body[0].isalnum() else ""
        if body.startswith("||"):
            body, head = body[2:], r"^(?:[^/]*\.)?"
        if body[-1].isalnum():
            rest = "(?:[^a-z0-9]|$)"
        return head + "".join({"*": ".*", "^": "(?:[^a-z0-9]|$)"}.get(c, re.escape(c)) for c in body) + (
            "" if self.length else rest)

    def tokens(self) -> list[str]:
        """Literal tokens that are whole in every URL that matches (none beside a ``*``)."""
        body = self.pattern.removeprefix("||")
        return [m[0] for m in _TOKEN.finditer(body)
                if body[m.start() - 1:m.start()] != "*" and body[m.end():m.end() + 1] != "*"]


def rules(hosts: list[tuple[str, str, str]] | None = None, patterns: list[str] | None = None) -> list[Rule]:
    hosts = HOST_RULES if hosts is None else hosts
    patterns = BLOCK_PATTERNS if patterns is None else patterns
    return [Rule(v, f"||{h}{p}", h + p, len(h + p)) for v, h, p in hosts] + [Rule("block", p) for p in patterns]


def host_and_path(url: str | None) -> tuple[str, str]:
    m = _SPLIT.match(url or "")
    return (m[1].translate(_UPPER), m[2]) if m else ("", "")


def indexed(listed: list[Rule], seen: dict[str, int]) -> dict[str, list[int]]:
    """Rarest token -> numbers of rules. Rules without a token are filed under the empty one, which all URLs have."""
    index: dict[str, list[int]] = {}
    for k, r in enumerate(listed):
        rarest = min(r.tokens(), key=lambda t: (seen.get(t, 0), -len(t), t), default="")
        index.setdefault(rarest, []).append(k)
    return index


def token_counts(pages: DataFrame, tokens: list[str], url: str = "url") -> dict[str, int]:
    """In how many URLs each of the rules' ``tokens`` occurs: as many rows as the rules have tokens."""
    own = F.array(*[F.lit(t) for t in tokens]) if tokens else F.array().cast("array<string>")
    found = F.array_intersect(F.split(F.lower(F.coalesce(F.col(url), F.lit(""))), "[^a-z0-9]+"), own)
    rows = pages.select(F.explode(found).alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r.t: r.n for r in rows}


def judge(host: str, path: str, listed: list[Rule], compiled: list[re.Pattern], index: dict[str, list[int]]) -> tuple[str | None, str]:
    """(rule, verdict). Host rules see the path as it is, patterns see it in lower case."""
    plain = host + path
    low = plain.lower()
    best, blocked = None, False
    for k in sorted({k for t in {"", *_TOKEN.findall(low)} for k in index.get(t, ())}):
        r = listed[k]
        if r.length:
            if (best is None or r.length > best.length) and compiled[k].search(plain):
                best = r
        elif not blocked and compiled[k].search(low):
            blocked = r.verdict == "block"
    if best:
        return best.name, best.verdict
    return None, "block" if blocked else "allow"


def judged(pages: DataFrame, listed: list[Rule] | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    listed = rules() if listed is None else listed
    seen = token_counts(pages, sorted({t for r in listed for t in r.tokens()}))
    index = indexed(listed, seen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [re.compile(r.regex(), re.S) for r in listed]
        for b in batches:
            parts = [host_and_path(u) for u in b.column(1).to_pylist()]
            found = [judge(h, p, listed, compiled, index) if h or p else (None, "allow") for h, p in parts]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(c, pa.string()) for c in (
                    [h for h, _ in parts], [p for _, p in parts], [r for r, _ in found], [v for _, v in found])]],
                ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url").mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def oracle() -> str:
    """The same rows in DuckDB SQL, running every rule on every URL."""
    listed = rules()
    hosts = sorted((r for r in listed if r.length), key=lambda r: -r.length)

    def matches(r: Rule, what: str) -> str:
        return f"regexp_matches({what}, '{r.regex()}', 's')"

    named = "\n".join(f"WHEN {matches(r, 'plain')} THEN '{r.name}'" for r in hosts)
    verdicts = "\n".join(f"WHEN {matches(r, 'plain')} THEN '{r.verdict}'" for r in hosts)
    blocked = "\nOR ".join(matches(r, "lower(plain)") for r in listed if not r.length)
    return f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages
), joined AS (SELECT *, host || path AS plain FROM parts)
SELECT page_id, host, path, CASE {named} END AS rule,
       CASE {verdicts} WHEN {blocked} THEN 'block' ELSE 'allow' END AS verdict
FROM joined
"""
