"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field.

The field works on islands: neighbouring words that hold a digit or an ``@``.
A segmentation cuts an island into segments of up to ``LONGEST`` words, each
an entity of one type or a plain word. Features look at a whole segment (its
shape, digits, check sum, octets, the word before it); a segmentation's score
is the sum over its segments. Dynamic programming over bounded segments gives
the sums for learning (forward and backward) and the best segmentation, which
settles boundaries and types together.

Weights are learned from islands of a bounded sample of texts, with the fixed
patterns' finds as labels. Entities that the field finds with at least
``MARGIN`` over plain words, and that touch no pattern's find, are added.

Defined cases: a null or empty text has no span; with nothing to learn from,
only the patterns find; repeated rows are searched each; texts, runs of digits
and islands of any length are read whole in linear time; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.llm import spans as S

KINDS = ["email", "ip", "card", "phone"]

#: Words of an entity at most.
LONGEST = 5

#: Texts that the field is learned from, and islands of them at most.
SAMPLE_TEXTS, SAMPLE_ISLANDS = 1500, 3000

#: Passes over the islands, step size, and pull of the weights towards zero.
PASSES, STEP, PULL = 6, 0.3, 1e-4

#: How much better than plain words an added entity scores: odds of about e ** 4.
MARGIN = 4.0

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is only tried from its start: from within it, nothing else would match.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_WORD = re.compile(r"\S+")
_SIGNAL = re.compile("[0-9@]")
_EDGE = "\"'`,;:!?<>[]{}#%&*$|="


def luhn(digits: str) -> bool:
    """Whether the check sum of a row of digits is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def octet(s: str) -> bool:
    s = s.lstrip("0")
    return len(s) < 4 and int(s or "0") <= 255


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost finds, from each ``@`` to both sides: linear in the text."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    return out


def base_spans(text: str) -> list[S.Span]:
    """What the fixed patterns find, leftmost and without overlap in each kind; failing matches are dropped."""
    out = [("email", a, b, True) for a, b in emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", *m.span(), True) for m in _IP.finditer(text) if all(map(octet, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if 14 <= m.end() - m.start() <= 37:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span(), True))
    if "+" in text:
        out += [("phone", *m.span(), True) for m in _PHONE.finditer(text) if 10 <= len(_DIGIT.findall(m[0])) <= 15]
    return out


Island = list[tuple[int, int]]


def islands(text: str) -> Iterator[tuple[str, Island]]:
    """(the word before, places of the words) for each run of words with a digit or an ``@``."""
    if not _SIGNAL.search(text):
        return
    before, words = "", []
    for m in _WORD.finditer(text):
        if _SIGNAL.search(m[0]):
            words.append(m.span())
            continue
        if words:
            yield before, words
            words = []
        before = m[0]
    if words:
        yield before, words


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A segment without marks around it (and without a full stop at its end)."""
    while start < end and text[start] in _EDGE:
        start += 1
    while end > start and (text[end - 1] in _EDGE or text[end - 1] == "."):
        end -= 1
    return start, end


def features(text: str, words: Island, i: int, j: int, before: str) -> list[str]:
    """What is seen of words i to j - 1 as one segment."""
    start, end = trimmed(text, words[i][0], words[j - 1][1])
    s = text[start:end]
    if len(s) > 80:
        return ["long"]
    digits = re.sub("[^0-9]", "", s)
    shape = re.sub("9+", "9", re.sub("[A-Za-z]+", "a", re.sub("[0-9]", "9", s)))
    n = len(digits)
    size = "0" if n < 1 else "1-6" if n < 7 else "7-9" if n < 10 else "10-13" if n < 14 else "14-15" if n < 16 else "16-19" if n < 20 else "20+"
    found = ["bias", f"words={j - i}", f"digits={size}", f"shape={shape if len(shape) < 24 else 'other'}",
             f"first={'+' if s[:1] == '+' else '(' if s[:1] == '(' else 'd' if s[:1].isdigit() else 'a' if s[:1].isalpha() else '.'}",
             f"letters={any(c.isalpha() for c in s)}", f"at={s.count('@')}"]
    if 14 <= n <= 19:
        found.append(f"luhn={luhn(digits)}")
    parts = s.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        found.append(f"octets={all(map(octet, parts))}")
    if "@" in s:
        local, _, domain = s.partition("@")
        found.append(f"domain={bool(local) and bool(_DOMAIN.fullmatch(domain))}")
    cue = words[i - 1] if i else None
    cue = text[cue[0]:cue[1]] if cue else before
    found.append("cue=" + re.sub("[^a-z]", "", cue.lower())[:12] if re.match("(?i)(phone|tel|call|fax|mobile|card|visa|email|e-mail|mail|ip|host)[:.]?$", cue) else "cue=no")
    return found


Weights = dict[str, float]


def segments(text: str, words: Island, before: str, weights: Weights) -> list[tuple[int, int, int, float, list[str]]]:
    """(i, j, type, score, features) of every segment, in the order of j; type -1 is one plain word, which scores 0."""
    out = []
    for j in range(1, len(words) + 1):
        out.append((j - 1, j, -1, 0.0, []))
        for i in range(max(0, j - LONGEST), j):
            seen = features(text, words, i, j, before)
            for t, kind in enumerate(KINDS):
                out.append((i, j, t, sum(weights.get(f"{kind} {f}", 0.0) for f in seen), seen))
    return out


def _add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a if b == -math.inf else a + math.log1p(math.exp(b - a))


def marginals(n: int, segs) -> list[float]:
    """Each segment's probability, by forward and backward sums over all segmentations."""
    alpha, beta = [0.0] + [-math.inf] * n, [-math.inf] * n + [0.0]
    for i, j, _, s, _ in segs:
        alpha[j] = _add(alpha[j], alpha[i] + s)
    for i, j, _, s, _ in reversed(segs):
        beta[i] = _add(beta[i], beta[j] + s)
    return [math.exp(min(0.0, alpha[i] + s + beta[j] - alpha[n])) for i, j, _, s, _ in segs]


def best(n: int, segs) -> list[tuple[int, int, int, float]]:
    """The entities (i, j, type, score) of the best segmentation."""
    top: list[tuple[float, tuple | None]] = [(0.0, None)] + [(-math.inf, None)] * n
    for i, j, t, s, _ in segs:
        if top[i][0] + s > top[j][0]:
            top[j] = (top[i][0] + s, (i, j, t, s))
    out, j = [], n
    while j:
        i, _, t, s = top[j][1]
        if t >= 0:
            out.append((i, j, t, s))
        j = i
    return out[::-1]


def learned(examples: list[tuple[str, str, Island, set[tuple[int, int, int]]]]) -> Weights:
    """Weights that raise the likelihood of the labelled segmentations (text, word before, words, entities)."""
    weights: Weights = {f"{k} bias": -2.0 for k in KINDS}
    for turn in range(PASSES):
        step = STEP / (1 + turn)
        for text, before, words, gold in examples:
            segs = segments(text, words, before, weights)
            for (i, j, t, _, seen), p in zip(segs, marginals(len(words), segs)):
                gap = ((i, j, t) in gold) - p
                if t >= 0 and abs(gap) > 1e-4:
                    for f in seen:
                        key = f"{KINDS[t]} {f}"
                        w = weights.get(key, 0.0)
                        weights[key] = w + step * (gap - PULL * w)
    return weights


def labelled(text: str, words: Island, base: list[S.Span]) -> set[tuple[int, int, int]] | None:
    """The patterns' finds as segments of an island; None if one doesn't fit its words."""
    gold = set()
    for kind, a, b, _ in base:
        if b <= words[0][0] or a >= words[-1][1]:
            continue
        i = next((k for k, w in enumerate(words) if w[0] <= a < w[1]), None)
        j = next((k + 1 for k, w in enumerate(words) if w[0] < b <= w[1]), None)
        if i is None or j is None or j - i > LONGEST or trimmed(text, words[i][0], words[j - 1][1]) != (a, b):
            return None
        if any(i < y and x < j for x, y, _ in gold):
            return None
        gold.add((i, j, KINDS.index(kind)))
    return gold


def fit(docs: DataFrame, text: str = "text", texts: int = SAMPLE_TEXTS, most: int = SAMPLE_ISLANDS) -> Weights:
    """Learns from the islands of at most ``texts`` texts, at most ``most`` of them; that much reaches the driver."""
    # Only ids are put in order; as many as asked for are sent back to their texts.
    ids = F.broadcast(docs.where(F.col(text).rlike("[0-9@]") & F.col("doc_id").isNotNull()).select("doc_id").orderBy(
        F.xxhash64("doc_id"), "doc_id").limit(texts).distinct())
    sample = docs.select("doc_id", F.col(text).alias("_text")).join(ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for doc, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for before, words in islands(x):
                    if len(words) <= 12:
                        start = max(0, words[0][0] - 1)
                        rows.append((str(doc), start, before[:40], x[words[0][0]:words[-1][1]]))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                pa.array([r[2] for r in rows], pa.string()), pa.array([r[3] for r in rows], pa.string())],
                ["doc", "at", "before", "island"])

    found = sample.mapInArrow(run, "doc string, at long, before string, island string").where(F.length("island") < 400)
    rows = found.orderBy(F.xxhash64("doc", "at"), "island").limit(most).collect()
    examples = []
    for r in rows:
        words = [m.span() for m in _WORD.finditer(r.island)]
        gold = labelled(r.island, words, base_spans(r.island))
        if gold is not None:
            examples.append((r.island, r.before, words, gold))
    return learned(examples)


def added(text: str, base: list[S.Span], weights: Weights, margin: float = MARGIN) -> list[S.Span]:
    """The field's entities that touch no pattern's find."""
    out, taken, k = [], sorted((a, b) for _, a, b, _ in base), 0
    for before, words in islands(text):
        while k < len(taken) and taken[k][1] <= words[0][0]:
            k += 1
        segs = segments(text, words, before, weights)
        for i, j, t, score in best(len(words), segs):
            a, b = trimmed(text, words[i][0], words[j - 1][1])
            if score < margin or a >= b:
                continue
            near = k
            while near < len(taken) and taken[near][1] <= a:
                near += 1
            if near == len(taken) or taken[near][0] >= b:
                out.append((KINDS[t], a, b, False))
    return out


def found(docs: DataFrame, text: str = "text", weights: Weights | None = None) -> DataFrame:
    """doc_id and the spans of every row; learns from ``docs`` first if no weights are given."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, text) if weights is None else weights)

    def make():
        known = shared.value

        def find(x: str) -> list[S.Span]:
            base = base_spans(x)
            return S.in_order(base + added(x, base, known), KINDS)

        return find

    return S.found(docs, make, text)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    return found(docs).select(
        "doc_id", *[S.counted("spans", k).alias(f"n_{k}") for k in KINDS],
        S.base_digest("spans").alias("base_sha256"), S.listed(F.col("spans")).alias("spans"))
