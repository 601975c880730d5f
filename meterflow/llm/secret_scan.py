"""Secrets in texts: fixed patterns, and values in credential contexts that are costly to guess.

A value that follows a credential word (``password is ...``, ``Bearer ...``)
is cut into words, dates, repeats, keyboard walks, sequences and brute-force
characters so that the guesses for the parts multiply to the least (dynamic
programming over its places). Values that take at least 10 ** ``LEAST_COST``
guesses, and that no pattern covers wholly, are added as ``guess`` spans, and
so are those whose head alone a pattern finds, so that no tail is left.

Defined cases: a null or empty text has no span; repeated rows are scanned
each; texts and values of any length are scanned whole, in time linear in
their length; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import spans as S
from meterflow.llm.common import release, slices

KINDS = ["assign", "access", "hex", "guess"]

#: Powers of ten of guesses from which a value is a secret.
LEAST_COST = 10.0

#: The longest part that is looked at as one word, date, repeat or walk.
LONGEST_PART = 24


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_ASSIGN = re.compile(
    "(" + "|".join(map(_either_case, ["password", "passwd", "secret", "token"])) + "|" + _either_case("api") + "_?"
    + _either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
# A run that is long enough from its first AKIA or hex digit is found at once; shorter ones are dropped.
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("[0-9a-f]{24,}")

_WORDS = ["pass", "pwd", "secret", "token", "key", "credential", "bearer"]
_CONTEXT = re.compile(
    r"""(?i)(?:(?:pass(?:word|wd|phrase|code)|pwd|secret|token|(?:api|access|private)[ _-]?key|credentials?|bearer)"""
    r"""["'`]?[ \t]*+(?:(?P<set>=>|:=|->|[:=])|(?<=[ \t])is[ \t])|(?<![a-z])(?P<bearer>bearer[ \t]))[ \t]*+"""
    # In quotes up to the same quote (with blanks only where something is set), else up to white space or a quote.
    r"""(?:"(?P<double>(?:(?(set)[^"\\\n]|[^"\\\s])|\\.){6,}+)"|'(?P<single>(?:(?(set)[^'\\\n]|[^'\\\s])|\\.){6,}+)'|"""
    r"""`(?P<back>(?(set)[^`\n]|[^`\s]){6,}+)`|["'`]?(?P<bare>[^\s"'`]{6,}))""")

#: Rows of keys, and common passwords that a vocabulary of words lacks (fixed values).
_KEYS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"]
_COMMON = ["password", "qwerty", "letmein", "admin", "welcome", "iloveyou", "abc", "changeme", "example", "secret"]
_DATE = re.compile(r"(?:19|20)\d\d[-./]?(?:0[1-9]|1[0-2])[-./]?(?:0[1-9]|[12]\d|3[01])|"
                   r"(?:0[1-9]|[12]\d|3[01])[-./]?(?:0[1-9]|1[0-2])[-./]?(?:19|20)\d\d|(?:19|20)\d\d")


@lru_cache(maxsize=2)
def word_ranks(path: str) -> dict[str, int]:
    """Whole words of a public vocabulary by rank."""
    with open(path, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    words = [w[:-4] for w, _ in sorted(vocabulary.items(), key=lambda x: x[1]) if w.endswith("</w>")]
    ordered = dict.fromkeys([*_COMMON, *[w for w in words if len(w) > 2 and w.isalpha()]])
    return {w: i for i, w in enumerate(ordered, 1)}


def _char_cost(c: str) -> float:
    return math.log10(10 if c.isdigit() else 26 if c.isalpha() else 33)


def _walks(a: str, b: str) -> bool:
    """Whether two characters are next to each other on a row of keys or in order."""
    return any(abs(r.find(a) - r.find(b)) == 1 for r in _KEYS if a in r and b in r) or (
        a.isalnum() and b.isalnum() and abs(ord(a) - ord(b)) == 1)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """log10 of the least number of guesses over all ways to cut ``value`` into parts."""
    low, n = value.lower(), len(value)
    best = [0.0] + [math.inf] * n
    # run[j]: how many characters up to j walk over neighbouring keys; same[j]: how many are equal.
    run, same = [0] * (n + 1), [0] * (n + 1)
    for j in range(1, n + 1):
        run[j] = run[j - 1] + 1 if j > 1 and _walks(low[j - 2], low[j - 1]) else 1
        same[j] = same[j - 1] + 1 if j > 1 and low[j - 2] == low[j - 1] else 1
        cost = best[j - 1] + _char_cost(value[j - 1])
        for i in range(max(0, j - LONGEST_PART), j - 2):
            part, size = low[i:j], j - i
            found = math.inf
            if part in ranks:
                ups = sum(c.isupper() for c in value[i:j])
                found = math.log10(ranks[part]) + (math.log10(2 * math.comb(size, ups)) if ups else 0)
            if run[j] >= size:
                found = min(found, math.log10(47 * 2 * size))
            if size in (4, 8, 10) and _DATE.fullmatch(part):
                found = min(found, math.log10(200 if size == 4 else 365 * 200))
            for unit in (1, 2, 3, 4):
                if size % unit == 0 and size > unit and part == part[:unit] * (size // unit):
                    found = min(found, sum(map(_char_cost, part[:unit])) + math.log10(size // unit))
                    break
            cost = min(cost, best[i] + found)
        if same[j] > LONGEST_PART:  # a long run of one character is one part
            cost = min(cost, best[j - same[j]] + _char_cost(value[j - 1]) + math.log10(same[j]))
        best[j] = cost
    return best[n]


def base_spans(text: str) -> list[S.Span]:
    """What the fixed patterns find, leftmost and without overlap in each kind."""
    out = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span(), True) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), True) for m in _ACCESS.finditer(text)]
    return out + [("hex", *m.span(), True) for m in _HEX.finditer(text)]


def guess_spans(text: str, taken: list[S.Span], ranks: dict[str, int], least: float) -> list[S.Span]:
    low = text.lower()
    if not any(w in low for w in _WORDS):
        return []
    out, at = [], 0
    while m := _CONTEXT.search(text, at):
        start, end = m.span(m.lastgroup)
        if m.lastgroup == "bare":
            while end > start and text[end - 1] in ".,;:!?)]}>":
                end -= 1
        covered = any(s[1] <= start and end <= s[2] for s in taken)
        # What a pattern finds the head of is a secret as it stands.
        if not covered and end - start >= 6 and (
                any(s[1] <= start < s[2] for s in taken) or guess_cost(text[start:end], ranks) >= least):
            out.append(("guess", start, end, False))
            at = m.end()
        else:  # what stands behind the bare word may be a context itself
            at = start if m["bearer"] else m.end()
    return out


def finder(path: str | None = None, least: float = LEAST_COST):
    """A function that gives a task its search."""
    path = path or public_tokenizers.path("word_bpe_49k.json")

    def make():
        ranks = word_ranks(path)

        def find(text: str) -> list[S.Span]:
            base = base_spans(text)
            return S.in_order(base + guess_spans(text, base, ranks, least), KINDS)

        return find

    return make


def scanned(docs: DataFrame, text: str = "text", path: str | None = None, least: float = LEAST_COST) -> DataFrame:
    """doc_id and the spans of every row."""
    return S.found(docs, finder(path, least), text)


MASK = "[secret]"


def masked(text: str, spans: list[S.Span]) -> str:
    """The text with every stretch that spans cover replaced by MASK."""
    out, at = [], 0
    for _, start, end, _ in sorted(spans, key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, text: str = "text", length: str = "n_chars", path: str | None = None,
             least: float = LEAST_COST) -> DataFrame:
    """``docs`` with secrets masked in the text, and ``length`` (if there is one) set for changed texts.

    All rows and columns stay; clean texts and their lengths are not touched.
    """
    at, make = docs.columns.index(text), finder(path, least)
    size = docs.columns.index(length) if length in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        find = make()
        for b in slices(batches):
            old = b.column(at).to_pylist()
            new = {k: masked(x, s) for k, x in enumerate(old) if x and (s := find(x))}
            columns = list(b.columns)
            if new:
                columns[at] = pa.array([new.get(k, x) for k, x in enumerate(old)], b.schema.field(at).type)
                if size is not None:
                    columns[size] = pa.array([len(new[k]) if k in new else n for k, n in enumerate(columns[size].to_pylist())],
                                             b.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    return docs.mapInArrow(run, docs.schema)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    df = scanned(docs)
    return df.select(
        "doc_id", *[S.counted("spans", k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        S.base_digest("spans").alias("base_sha256"), S.listed(F.col("spans")).alias("spans"))
