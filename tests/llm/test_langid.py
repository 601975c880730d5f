"""Language identification: the forward algorithm against enumeration, held-out accuracy, odd rows."""

import itertools
import math
import zlib

import numpy as np
import pytest

from meterflow.llm import langid as L

TABLE = {"a": [0.2, 0.1], "b": [0.1, 0.3], "ab": [0.3, 0.01], "bab": [0.05, 0.2], L.MARK: [0.1, 0.1], L.MARK + "a": [0.2, 0.05]}


def by_enumeration(word, k):
    total = 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        p = 1.0
        for i, j in zip(at, at[1:]):
            p *= TABLE[word[i:j]][k] if word[i:j] in TABLE else L.UNSEEN if j - i == 1 else 0.0
        total += p
    return total


@pytest.mark.parametrize("word", ["a", "ab", "babab", L.MARK + "abba", "xab", "aéb"])
def test_forward_sums_all_cuts(word):
    got = L.Forward(TABLE, 3, 2).logs([word, word])
    assert np.allclose(got, [[math.log(by_enumeration(word, k)) for k in (0, 1)]] * 2)


def plain_log(word, table, k):
    """The forward sum in plain logarithms, every cut into pieces of any length allowed."""
    sums = [0.0]
    for j in range(1, len(word) + 1):
        found = [(i, table[word[i:j]][k] if word[i:j] in table else L.UNSEEN if j - i == 1 else 0.0) for i in range(max(0, j - 40), j)]
        sums.append(np.logaddexp.reduce([sums[i] + math.log(p) for i, p in found if p]))
    return sums[-1]


@pytest.mark.parametrize("n", [39, 40, 41, 400, 20_000])
def test_long_runs_are_summed_whole(n):
    """Beyond the 40 letters at which runs were cut once, and where plain products underflow."""
    word = L.MARK + ("abbab" * n)[:n]
    got = L.Forward(TABLE, 3, 2).logs([word, "zz" + word, word])
    assert np.allclose(got[0], [plain_log(word, TABLE, k) for k in (0, 1)], rtol=1e-10) and np.allclose(got[0], got[2])
    into = {}
    L.expected(word, 1.0, {p: q[0] for p, q in TABLE.items()}, 3, into)
    assert math.isclose(sum(len(p) * c for p, c in into.items()), n + 1, rel_tol=1e-8)


def test_all_letter_pieces_of_the_vocabulary_take_part():
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    every = {sp.id_to_piece(i).lower() for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))}
    got = L.pieces_of_vocabulary(path)
    assert set(got) == {p for p in every if all(c.isalpha() for c in p.removeprefix(L.MARK))}
    assert max(map(len, got)) > 12
    longest = max(got, key=len)
    table = {p: [0.5, 0.25] for p in (longest, longest[1:])}
    whole = L.Forward(table, len(longest), 2).logs([longest])
    assert np.allclose(whole, [[plain_log(longest, table, k) for k in (0, 1)]])


def test_expected_counts_are_those_of_enumeration():
    word = L.MARK + "abbab"
    want, total = {}, 0.0
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(word)]
        parts = [word[i:j] for i, j in zip(at, at[1:])]
        p = math.prod(TABLE[x][0] if x in TABLE else L.UNSEEN if len(x) == 1 else 0.0 for x in parts)
        total += p
        for x in parts:
            want[x] = want.get(x, 0.0) + p
    into = {}
    L.expected(word, 3.0, {p: q[0] for p, q in TABLE.items()}, 3, into)
    assert all(math.isclose(into.get(x, 0.0), 3 * p / total, rel_tol=1e-9, abs_tol=1e-12) for x, p in want.items())


def test_predictions_of_the_query_by_plain_sums(spark):
    """Every tenth text: the language and score again, word by word in plain logarithms, from the fitted table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = L.fit(docs.where(~L.held_out()).select("doc_id", "text", "lang"))
    got = {r.doc_id: r for r in L.predicted(docs.select("doc_id", "text"), model).collect()}
    for r in [r for r in got.values() if r.doc_id % 10 == 0]:
        counts = {}
        for w in L._LETTERS.findall(r.text or ""):
            counts[L.MARK + w.lower()] = counts.get(L.MARK + w.lower(), 0) + 1
        sums = [sum(n * plain_log(w, model.table, k) for w, n in counts.items()) for k in range(len(model.langs))]
        if not counts:
            assert r.lang_pred == "und"
            continue
        best = int(np.argmax(sums))
        assert r.lang_pred == model.langs[best]
        assert math.isclose(r.score, 1 / sum(math.exp(s - sums[best]) for s in sums), rel_tol=1e-6)


def test_expected_counts_cover_each_letter():
    into = {}
    L.expected(L.MARK + "babab", 2.0, {p: q[0] for p, q in TABLE.items()}, 3, into)
    assert math.isclose(sum(len(p) * c for p, c in into.items()), 12.0)


def test_scores_in_parts_are_the_same(monkeypatch):
    model = L.Model(["x", "y"], TABLE, 3)
    texts = ["ab Bab. abba, a1b", "", "12 !", "ab " * 500, "b" * 200]
    whole = L.WordScores(model).of(texts)
    monkeypatch.setattr(L, "RUN", 3)
    monkeypatch.setattr(L, "KEPT_WORDS", 2)
    assert np.allclose(L.WordScores(model).of(texts), whole)
    assert whole[1:3, -1].tolist() == [0, 0]


def test_nothing_to_learn_from_and_empty_table(spark):
    kind = "doc_id long, text string, lang string, score string"
    docs = spark.createDataFrame([(1, "some text", None, "x"), (None, None, "en", "x")], kind)
    assert [(r.lang_pred, r.score) for r in L.identified(docs).collect()] == [("und", 0.0)] * 2
    assert L.identified(spark.createDataFrame([], kind)).collect() == []


def test_held_out_accuracy_and_odd_rows(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    odd = spark.createDataFrame([(None, "the", "en", "s", 3), (-1, None, "en", "s", 0), (-2, "12 +", "fr", "s", 4)], docs.schema)
    rows = docs.unionByName(odd).collect()
    lang = {r.doc_id: r.lang for r in rows}
    got = L.identified(docs.unionByName(odd)).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert by[-1].lang_pred == by[-2].lang_pred == "und" and by[None].lang_pred in {"en", "de", "fr", "es"}
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if i is not None and zlib.crc32(str(i).encode()) % 4 == 2}
    right = [r.lang_pred == lang[r.doc_id] for r in held if r.lang_pred != "und"]
    assert sum(right) >= 0.95 * len(right)
    assert all(0 <= r.score <= 1 for r in got)
