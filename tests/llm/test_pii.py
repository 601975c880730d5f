"""Personal data: patterns against a plain reading, the field's sums against enumeration, odd rows."""

import hashlib
import itertools
import math
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from meterflow.llm import pii as P
from meterflow.llm.spans import in_order
from tests.conftest import SF_SMALL


def plain(text):
    """The base rules word for word."""
    out = []
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(d := re.sub("[^0-9]", "", m)) <= 19 and P.luhn(d)),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15)]
    for k, (kind, rule, good) in enumerate(rules):
        out += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(rule, text) if good(m[0])]
    return ",".join(x[2] for x in sorted(out))


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")


PARTS = st.lists(st.sampled_from(["a", "b.c", "@", ".", "-", "+", "1", "23", "255", "256", " ", "4111111111111111", "4111 1111", "(414)", "555-1791",
                                  "+1 ", "00", "x@y.z", "\n", "é", "٣", "192.168.0.1", "%", "_"]), max_size=16)


@given(PARTS)
@settings(max_examples=800, deadline=None)
def test_base_is_the_plain_reading(parts):
    text = "".join(parts)
    assert ",".join(f"{k}:{a}:{b}" for k, a, b, _ in in_order(P.base_spans(text), P.KINDS)) == plain(text)


def all_segmentations(n, segs):
    by_start = {}
    for k, s in enumerate(segs):
        by_start.setdefault(s[0], []).append(k)

    def rest(i):
        if i == n:
            yield []
        for k in by_start.get(i, []):
            for r in rest(segs[k][1]):
                yield [k, *r]

    return list(rest(0))


def test_sums_and_best_are_those_of_all_segmentations():
    rnd = random.Random(1)
    text = "+1 (414) 555-1791 4111111111111111 x@y.zz"
    words = [m.span() for m in re.finditer(r"\S+", text)]
    names = {f"{k} {f}" for i, j in itertools.combinations(range(len(words) + 1), 2) for f in P.features(text, words, i, j, "") for k in P.KINDS}
    weights = {x: rnd.uniform(-1, 1) for x in sorted(names)}
    segs = P.segments(text, words, "", weights)
    ways = all_segmentations(len(words), segs)
    scores = [sum(segs[k][3] for k in w) for w in ways]
    total = sum(map(math.exp, scores))
    for k, p in enumerate(P.marginals(len(words), segs)):
        assert math.isclose(p, sum(math.exp(s) for w, s in zip(ways, scores) if k in w) / total, abs_tol=1e-9)
    top = ways[max(range(len(ways)), key=scores.__getitem__)]
    assert [x[:3] for x in P.best(len(words), segs)] == [segs[k][:3] for k in top if segs[k][2] >= 0]


def islands_of(text):
    return [(text, b, w, P.labelled(text, w, P.base_spans(text))) for b, w in P.islands(text)]


def test_learns_shapes_and_adds_what_the_patterns_miss():
    rnd = random.Random(2)
    examples = []
    for _ in range(150):
        n = lambda a, b: rnd.randint(a, b)
        card = next(c for c in iter(lambda: str(n(10**15, 10**16 - 1)), 0) if P.luhn(c))
        for t in (f"call +1 ({n(200, 999)}) 555-{n(1000, 9999)} now", f"to a.b{n(1, 99)}@mail.com ok", f"on {n(1, 255)}.{n(0, 255)}.{n(0, 255)}.{n(0, 255)} is",
                  f"pay {card} by", f"in {n(1900, 2030)} we", f"v{n(1, 9)}.{n(0, 9)} and", f"id {n(10**15, 10**16)} x", f"{n(1, 99)} of {n(100, 999)} rows"):
            examples += islands_of(t)
    weights = P.learned([e for e in examples if e[3] is not None])

    def spans(t):
        return P.added(t, P.base_spans(t), weights)

    for clean in ("in 1984 we saw 42 of them", "version 3.2 and 12 more", "chapter 7", "a b c"):
        assert spans(clean) == []
    right = total = 0
    for text, before, words, gold in examples:
        if gold is not None:
            got = {x[:3] for x in P.best(len(words), P.segments(text, words, before, weights))}
            total += 1
            right += got == gold
    assert right > 0.98 * total
    # A full-width plus sign is no pattern, but the whole looks like a phone.
    assert spans("x@" + "y" * 100) == []


def test_long_texts_take_linear_time(spark):
    rows = [(1, "1" * 300_000), (2, "a" * 300_000 + "@"), (3, "1 " * 100_000), (4, "+1" * 50_000), (5, None), (6, ""), (None, "x@y.zz"), (None, "x@y.zz")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string")
    got = P.report(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows)
    assert [r.spans for r in got if r.doc_id is None] == ["email:0:6"] * 2
    assert all(r.n_email + r.n_ip + r.n_card + r.n_phone == 0 for r in got if r.doc_id in (1, 2, 3, 5, 6))
    assert P.report(docs.limit(0)).collect() == []


def test_query_on_documents(spark):
    from meterflow.llm.queries import QUERIES
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = QUERIES["op3_pii"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    more = 0
    for r in got:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [want.count(k + ":") for k in P.KINDS]
        have = set(filter(None, r.spans.split(",")))
        assert set(filter(None, want.split(","))) <= have
        more += len(have) - (want.count(",") + bool(want))
        for s in have - set(want.split(",")):
            k, a, b = s.split(":")
            print("added", k, repr(texts[r.doc_id][int(a) - 20:int(b) + 10]))
    assert more <= 0.05 * len(texts)
