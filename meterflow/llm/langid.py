"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
The probability of a word is the sum, over all ways to cut it into pieces, of
the products of their probabilities (forward algorithm); a text is its words
in turn. Piece probabilities are fitted by expectation-maximisation (forward
and backward) on a bounded sample of labelled texts.

Words are whole runs of letters, lower-cased, with a leading mark. All letter
pieces of the vocabulary take part, and runs of any length are summed whole.

Defined cases: a null text or one without a letter is ``und`` with score 0;
rows without a language or an id are not learned from; with nothing to learn
from, all is ``und``; repeated rows are predicted each; equal likelihoods give
the first language by name; texts of any length are scored whole.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import held, settled, slices

UNKNOWN = "und"

#: Texts a language is learned from (whole texts, picked by a hash of the id).
SAMPLE_TEXTS = 200

ROUNDS = 3

#: Letters, and words, whose forward sums are computed together.
CELLS, TOGETHER = 1 << 18, 1 << 13

#: A document whose language is less certain than this is not accepted.
LEAST_SCORE = 0.5

#: Probability of a letter that is no piece, and of a piece that a language has not shown.
UNSEEN = 1e-7

#: Share of the mean over all languages in each language's probabilities.
SHARED = 1e-3

#: Words whose scores are kept (a look-up table that only saves time), and words looked up at once.
KEPT_WORDS, RUN = 250_000, 1 << 17

MARK = "▁"
_LETTERS = re.compile(r"[^\W\d_]+")


def pieces_of_vocabulary(path: str) -> list[str]:
    """The vocabulary's pieces of letters, with or without the leading mark, in lower case."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {sp.id_to_piece(i).lower() for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    return sorted(p for p in found if p.removeprefix(MARK).isalpha() or p == MARK)


class Forward:
    """The forward algorithm over many words and all languages at once.

    The pieces are a trie that all words walk down together from each of their
    places, letter by letter; those that no piece goes on for drop out.
    """

    def __init__(self, table: dict[str, list[float]], longest: int, languages: int):
        # Row 0: no piece; row 1: a letter that is no piece.
        self.longest = longest
        self.rows = np.array([[0.0] * languages, [UNSEEN] * languages, *table.values()]).reshape(len(table) + 2, languages)
        self.letters = np.array(sorted({ord(c) for p in table for c in p}) or [0x10FFFF + 1], np.uint32)
        code = {chr(c): i + 1 for i, c in enumerate(self.letters) if c <= 0x10FFFF}
        self.width = len(self.letters) + 1
        # Nodes are the heads of pieces; 0 is the root, and "none" below it.
        node = {h: i for i, h in enumerate(sorted({"", *[p[:k] for p in table for k in range(1, len(p) + 1)]}))}
        steps = sorted((node[h[:-1]] * self.width + code[h[-1]], i) for h, i in node.items() if h)
        self.steps = np.array([k for k, _ in steps] or [-1], np.int64)
        self.to = np.array([i for _, i in steps] or [0], np.int64)
        self.row = np.zeros(len(node), np.int64)
        for i, p in enumerate(table):
            self.row[node[p]] = i + 2

    def down(self, nodes: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The nodes one letter further, 0 where there is none."""
        key = nodes * self.width + codes
        at = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
        return np.where(self.steps[at] == key, self.to[at], 0)

    def logs(self, words: list[str]) -> np.ndarray:
        """For each word, the logarithm of the summed probability of all its cuts, one a language."""
        out = np.empty((len(words), self.rows.shape[1]))
        order, at = sorted(range(len(words)), key=lambda k: len(words[k])), 0
        while at < len(order):
            to = at + 1
            while to < len(order) and to - at < TOGETHER and len(words[order[to]]) * (to + 1 - at) <= CELLS:
                to += 1
            out[order[at:to]] = self._together([words[k] for k in order[at:to]])
            at = to
        return out

    def _together(self, words: list[str]) -> np.ndarray:
        """``logs`` of words in the order of their lengths, place by place; sums are put at scale 1 every ``longest`` places."""
        count, sizes = len(words), np.array([len(w) for w in words])
        n, window = int(sizes[-1]), self.longest + 1
        chars = np.array(words, f"<U{n}").view(np.uint32).reshape(count, n)
        codes = np.minimum(np.searchsorted(self.letters, chars), len(self.letters) - 1)
        codes = np.where(self.letters[codes] == chars, codes + 1, 0)
        # alpha[i % window]: the sums of the cuts up to place i, where i is at most ``longest`` back.
        alpha, logs = np.zeros((window, count, self.rows.shape[1])), np.zeros((count, self.rows.shape[1]))
        alpha[0], done = 1, 0
        for i in range(n):
            here = alpha[i % window]
            ended = int(np.searchsorted(sizes, i, side="right"))
            logs[done:ended] += np.log(here[done:ended])
            done = ended
            if i and i % self.longest == 0:
                # A letter alone is always a piece, so no sum is zero.
                scale = here[done:].copy()
                logs[done:] += np.log(scale)
                alpha[:, done:] /= scale
            nodes = self.down(np.zeros(count - done, np.int64), codes[done:, i])
            alpha[(i + 1) % window, done:] += here[done:] * self.rows[np.maximum(self.row[nodes], 1)]
            live = np.flatnonzero(nodes)
            nodes, live = nodes[live], live + done
            for k in range(1, min(self.longest, n - i)):
                nodes = self.down(nodes, codes[live, i + k])
                on = np.flatnonzero(nodes)
                if not len(on):
                    break
                nodes, live = nodes[on], live[on]
                rows = self.row[nodes]
                hit = np.flatnonzero(rows)
                alpha[(i + k + 1) % window, live[hit]] += here[live[hit]] * self.rows[rows[hit]]
            alpha[i % window] = 0
        logs[done:] += np.log(alpha[n % window, done:])
        return logs


def _log_sum(x: list[float]) -> float:
    most = max(x)
    return most + math.log(sum(math.exp(v - most) for v in x)) if most > -math.inf else most


def expected(word: str, weight: float, table: dict[str, float], longest: int, into: dict[str, float]) -> None:
    """Adds each piece's expected count over all cuts of ``word`` (one language), by logarithms, so any length is whole."""
    n = len(word)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    alpha, beta = [0.0] * (n + 1), [0.0] * (n + 1)
    starts: list[list[float]] = [[] for _ in range(n + 1)]
    for j in range(1, n + 1):
        for i in range(max(0, j - longest), j):
            p = table.get(word[i:j], UNSEEN if i == j - 1 else 0.0)
            if p:
                ends[j].append((i, math.log(p)))
        alpha[j] = _log_sum([alpha[i] + p for i, p in ends[j]]) if ends[j] else -math.inf
    if alpha[n] == -math.inf:
        return
    for j in range(n, 0, -1):
        if j < n:
            beta[j] = _log_sum(starts[j]) if starts[j] else -math.inf
        for i, p in ends[j]:
            starts[i].append(beta[j] + p)
            c = math.exp(alpha[i] + p + beta[j] - alpha[n]) * weight
            if c:
                into[word[i:j]] = into.get(word[i:j], 0.0) + c


@dataclass
class Model:
    """``table``: piece -> one probability a language, in the order of ``langs``."""

    langs: list[str]
    table: dict[str, list[float]]
    longest: int


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, path: str | None = None, sample: int = SAMPLE_TEXTS, rounds: int = ROUNDS) -> Model:
    """Learns from ``docs`` (doc_id, text, lang): at most ``sample`` texts a language.

    What reaches the driver is bounded by the vocabulary and the languages;
    each round's expectations are computed by the executors.
    """
    spark = docs.sparkSession
    path = path or public_tokenizers.path("piece_bpe_32k.model")
    vocabulary = pieces_of_vocabulary(path)
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # The limit of a ranked window is applied before its shuffle, so few rows move.
    picked = docs.where("lang is not null and doc_id is not null and text is not null").select("doc_id", "lang").withColumn(
        "_rank", F.row_number().over(order)).where(F.col("_rank") <= sample).select("doc_id").distinct()
    texts = docs.where("lang is not null").select("doc_id", "lang", "text").join(F.broadcast(picked), "doc_id", "left_semi")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[str, str], int] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for w in _LETTERS.findall(text or ""):
                    r = MARK + w.lower()
                    seen[lang, r] = seen.get((lang, r), 0) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k in seen], pa.string()), pa.array([k[1] for k in seen], pa.string()),
                 pa.array(list(seen.values()), pa.int64())], ["lang", "word", "n"])

    counted = settled(texts.select("lang", "text").mapInArrow(count, "lang string, word string, n long").groupBy(
        "lang", "word").agg(F.sum("n").alias("n")))
    langs = [r.lang for r in counted.select("lang").distinct().orderBy("lang").collect()]
    longest = max(map(len, vocabulary))
    tables = {x: dict.fromkeys(vocabulary, 1 / len(vocabulary)) for x in langs}
    for _ in range(rounds if langs else 0):
        shared = spark.sparkContext.broadcast(tables)

        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            into: dict[str, dict[str, float]] = {}
            for b in batches:
                for lang, word, n in zip(*[c.to_pylist() for c in b.columns]):
                    expected(word, n, shared.value[lang], longest, into.setdefault(lang, {}))
            rows = [(x, p, c) for x, found in into.items() for p, c in found.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.float64())], ["lang", "piece", "c"])

        sums = counted.mapInArrow(expect, "lang string, piece string, c double").groupBy("lang", "piece").agg(
            F.sum("c").alias("c")).collect()
        tables = {x: {} for x in langs}
        for r in sums:
            tables[r.lang][r.piece] = r.c
        for x, t in tables.items():
            total = sum(t.values()) or 1.0
            tables[x] = {p: c / total for p, c in t.items()}
        shared.unpersist()
    known = set(vocabulary)
    table = {}
    for p in sorted(set().union(*tables.values())) if langs else []:
        if p in known or len(p) == 1:
            own = [tables[x].get(p, 0.0) for x in langs]
            mean = sum(own) / len(own)
            table[p] = [max(UNSEEN, (1 - SHARED) * q + SHARED * mean) for q in own]
    return Model(langs, table, max(map(len, table), default=1))


class WordScores:
    """Looks words of texts up: log-probabilities by language, then the number of letters."""

    def __init__(self, model: Model):
        self.forward = Forward(model.table, model.longest, len(model.langs))
        self.at: dict[str, int] = {}
        self.rows = np.zeros((0, len(model.langs) + 1))

    def learn(self, chunks: list[str]) -> None:
        """Scores chunks that aren't there yet; chunks of the same letters are scored once."""
        letters = [[MARK + w.lower() for w in _LETTERS.findall(c)] for c in chunks]
        words = list({r for found in letters for r in found})
        place = {r: i for i, r in enumerate(words)}
        score = np.zeros((len(words) + 1, self.rows.shape[1]))
        if words:
            score[:-1, :-1] = self.forward.logs(words)
            score[:-1, -1] = [len(r) for r in words]
        rows = score[[place[f[0]] if f else -1 for f in letters]]
        for k, f in enumerate(letters):
            for r in f[1:]:
                rows[k] += score[place[r]]
        self.at.update(zip(chunks, range(len(self.rows), len(self.rows) + len(chunks))))
        self.rows = np.concatenate([self.rows, rows])

    def of(self, texts: list[str]) -> np.ndarray:
        """The sums over whole texts, one row a text. Long texts are taken in parts."""
        total = np.zeros((len(texts), self.rows.shape[1]))
        held: list[tuple[int, list[str]]] = []
        words = 0
        for k, text in enumerate(texts):
            chunks = text.split()
            for i in range(0, len(chunks), RUN):
                held.append((k, chunks[i:i + RUN]))
                words += len(held[-1][1])
                if words >= RUN:
                    self.add(held, total)
                    held, words = [], 0
        self.add(held, total)
        return total

    def add(self, held: list[tuple[int, list[str]]], total: np.ndarray) -> None:
        if len(self.at) >= KEPT_WORDS:
            self.at, self.rows = {}, self.rows[:0]
        if new := list({c for _, chunks in held for c in chunks}.difference(self.at)):
            self.learn(new)
        for k, chunks in held:
            where = np.fromiter(map(self.at.__getitem__, chunks), np.int64, len(chunks))
            total[k] += self.rows[where].sum(0)


def decide(total: np.ndarray, langs: list[str]) -> tuple[str, float]:
    """The likeliest language and its posterior under equal priors."""
    if not langs or not total[-1]:
        return UNKNOWN, 0.0
    logs = total[:-1]
    best = int(logs.argmax())
    return langs[best], float(1 / np.exp(logs - logs[best]).sum())


def predicted(docs: DataFrame, model: Model, text: str = "text", keep_text: bool = True,
              names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the language and its score under ``names``, which ``docs`` must not have; the text stays if asked."""
    shared, key = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    at = docs.columns.index(text)
    back = [i for i in range(len(docs.columns)) if keep_text or i != at]
    out = T.StructType([*[docs.schema.fields[i] for i in back], T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, langs = held(key, lambda: WordScores(shared.value)), shared.value.langs
        for b in slices(batches):
            found = [decide(x, langs) for x in scores.of([x or "" for x in b.column(at).to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i) for i in back], pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                out.names)

    return docs.mapInArrow(run, out)


def identified(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from the documents that are not held out."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), path)
    return predicted(docs.select("doc_id", held_out().alias("held_out"), "text"), model, keep_text=False)


def accepted(docs: DataFrame, least: float = LEAST_SCORE, path: str | None = None) -> DataFrame:
    """``docs`` without those that have no language or one that scores below ``least``; columns as they are."""
    model = fit(docs.where(~held_out()).select("doc_id", "text", "lang"), path)
    names = ("_lang_pred", "_lang_score")
    return predicted(docs, model, names=names).where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).select(*docs.columns)
