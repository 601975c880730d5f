"""Packing: ids as the vocabulary gives them, every id in one piece, little padding."""

import itertools
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from meterflow.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
TABLE = P.WordIds(PATH)
PLAIN = Tokenizer.from_file(PATH)


def check(rows, texts):
    """``rows`` pack ``texts`` (a list of (doc, text))."""
    want = []
    for doc, text in texts:
        ids = np.array([*PLAIN.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc, ids))
    have = defaultdict(list)
    for r in rows:
        have[r.doc_id, r.doc_tokens].append(r)
    by_doc = defaultdict(list)
    for doc, ids in want:
        by_doc[doc, len(ids)].append(ids)
    assert set(have) == set(by_doc)
    for key, pieces in have.items():
        assert sum(p.length for p in pieces) == key[1] * len(by_doc[key])
        crcs = {zlib.crc32(ids[p.start:p.start + p.length].tobytes()) for p in pieces for ids in by_doc[key]}
        assert {p.ids_crc32 for p in pieces} <= crcs
        if len(by_doc[key]) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= P.WINDOW
        padding += 0 if at & (at - 1) == 0 else P.WINDOW - at
    return padding


@given(st.text(alphabet=st.one_of(st.characters(), st.sampled_from(" \n\t.,'<|endoftext|>sStTéÉßİΣ́\x1c\x85\xa0 0١²")), max_size=60))
@settings(max_examples=400, deadline=None)
def test_ids_by_word_are_the_ids_of_the_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert P.ids_of(text, TABLE) == P.WordIds.pack(PLAIN.encode(text, add_special_tokens=False).ids)


@given(st.lists(st.integers(1, 40), max_size=9), st.integers(1, 60))
@settings(max_examples=200, deadline=None)
def test_fill_is_the_best_subset(lengths, capacity):
    counts = {x: lengths.count(x) for x in lengths}
    found = P.fill(counts, capacity)
    assert all(found.count(x) <= counts[x] for x in found)
    best = max(s for k in range(len(lengths) + 1) for c in itertools.combinations(lengths, k) if (s := sum(c)) <= capacity)
    assert sum(found) == best


def test_nulls_repeats_long_texts_and_clashing_columns(spark):
    rows = [(1, None, 0), (2, "", 0), (3, "a b c", 0), (3, "a b c", 0), (None, "x", 0), (5, "word " * 30_000, 0),
            (6, "y" * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long")
    assert check(P.packed(docs).collect(), [r[:2] for r in rows]) == 0


def test_empty_table(spark):
    assert P.packed(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_documents(spark):
    from meterflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    assert check(QUERIES["op7_packing"](spark, d).collect(), texts) == 0


@pytest.mark.parametrize("words", [P.KEPT_WORDS])
def test_word_table_is_bounded(words):
    assert len(TABLE) <= words
