"""Secret scans: patterns against a plain reading of them, guess costs, odd rows."""

import hashlib
import itertools
import math
import re
import time

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import secret_scan as C

RANKS = C.word_ranks(public_tokenizers.path("word_bpe_49k.json"))
HEX = "0123456789abcdef" * 2


def plain(text):
    """The base rules word for word."""
    out = []
    word = "|".join("".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in w)
                    for w in ["password", "passwd", "secret", "token", "apikey", "api_key"])
    for m in re.finditer(f"({word})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, f"assign:{m.start()}:{m.end()}"))
    for i, (kind, p, n) in enumerate([("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)], 1):
        out += [(m.start(), i, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(p, text) if len(m[0]) >= n]
    return ",".join(x[2] for x in sorted(out))


PARTS = st.lists(st.sampled_from(["password", "Token", "API_KEY", "secret", "=", ": ", "\"", "'", " ", "AKIA", "ABCDEFGHIJKLMNOP", HEX,
                                  "deadbeef", "a", "é", "\n", "123456", "-", "AKIAAKIA", "ſecret="]), max_size=14)


@given(PARTS)
@settings(max_examples=500, deadline=None)
def test_base_is_the_plain_reading(parts):
    text = "".join(parts)
    got = C.S.in_order(C.base_spans(text), C.KINDS)
    assert ",".join(f"{k}:{a}:{b}" for k, a, b, _ in got) == plain(text)


def test_guess_cost_is_the_least_over_all_cuts():
    """Against all cuts, with the cost of each part taken from the same rules on the part alone."""
    for value in ["password", "aaaa", "Dragon1", "qwer7", "x9!k", "abcabc"]:
        whole = C.guess_cost(value, RANKS)
        n = len(value)
        cuts = []
        for marks in itertools.product([0, 1], repeat=n - 1):
            at = [0, *[i + 1 for i, c in enumerate(marks) if c], n]
            cuts.append(sum(C.guess_cost(value[i:j], RANKS) for i, j in zip(at, at[1:])))
        assert math.isclose(whole, min(cuts))
    assert C.guess_cost("password", RANKS) == 0
    assert C.guess_cost("aaaaaaaaaaaa", RANKS) < 4 < 10 < C.guess_cost("kT9#vQ2!xZ", RANKS)
    assert C.guess_cost("20240131", RANKS) < 5 and C.guess_cost("qwertyuiop", RANKS) < 4
    assert C.guess_cost("z" * 5000, RANKS) < 6


def test_only_costly_values_in_context_are_added(spark):
    rows = [(1, "the passphrase is kT9#vQ2!xZ88 ok"), (2, "the passphrase is correct"), (3, "kT9#vQ2!xZ88"),
            (4, 'token = "' + HEX + '"'), (5, None), (6, ""), (None, "x"), (1, "the passphrase is kT9#vQ2!xZ88 ok"),
            (7, "a" * 300_000 + " pwd: " + "Zx81!" * 2000)]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    got = sorted((r.doc_id or 0, r.spans) for r in C.report(docs).collect())
    assert got == sorted([(1, "guess:18:30"), (2, ""), (3, ""), (4, "assign:0:41,hex:9:41"), (5, ""), (6, ""), (0, ""),
                          (1, "guess:18:30"), (7, "hex:0:300000,guess:300006:310005")])
    clean = {r.doc_id: r.text for r in C.redacted(docs).collect()}
    assert clean[1] == "the passphrase is [secret] ok" and clean[4] == '[secret]"' and clean[5] is None
    assert clean[2] == rows[1][1]


@pytest.mark.parametrize("text, left", [
    ('password = "kT9abcd#vQ2!xZ88$mm" ok', '[secret]" ok'),
    ("dbPassword: kT9abcd#vQ2!xZ88$ ok", "db[secret] ok"),
    ("secret = 'welcome#1990!' ok", "[secret]' ok"),
    ('token = "correct#horse battery staple" ok', '[secret]" ok'),
    ("Authorization: Bearer kT9abcd#vQ2!xZ88 ok", "Authorization: Bearer [secret] ok"),
    ("passphrase        is        kT9#vQ2!xZ88 ok", "passphrase        is        [secret] ok"),
    ("bearer password: kT9abcd#vQ2!xZ88, ok", "bearer [secret], ok"),
    ('the secret is "never give up on your dreams"', None), ("a standard bearer without equal", None),
])
def test_no_tail_of_a_value_is_left(text, left):
    base = C.base_spans(text)
    assert C.masked(text, base + C.guess_spans(text, base, RANKS, C.LEAST_COST)) == (left or text)


def test_context_search_is_linear():
    start = time.process_time()
    for text in ["password" + " " * 200_000 + "x", "bearer " * 30_000, "token=" * 30_000, 'pwd:"' * 30_000, "bearer\t" + '"' + "\\a" * 100_000]:
        C.guess_spans(text, [], RANKS, 1e9)
    assert time.process_time() - start < 30


def test_empty_table(spark):
    assert C.report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_documents(spark):
    from meterflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = QUERIES["op6_secret_scan"](spark, d).collect()
    assert len(got) == len(texts)
    for r in got:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [want.count(k + ":") for k in ("assign", "access", "hex")]
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))
