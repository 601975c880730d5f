"""Fingerprints: order, insertion and deletion, the edited texts against Python, odd rows."""

import hashlib

from pyspark.sql import functions as F

from meterflow.llm import fingerprints as P
from tests.conftest import SF_SMALL


def vectors(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(1)
    return {r.i: r.v for r in P.with_vector(df, "t", "v").collect()}


def test_order_does_not_matter_but_content_does(spark):
    v = vectors(spark, ["one, two. three\nfour\nfour", "four\none, two. three\nfour", "four\none, two. three",
                        "one, two. Three\nfour\nfour", "", "\n", "one two. three\nfour\nfour"])
    assert v[0] == v[1]
    assert len({tuple(x) for x in v.values()}) == 6


def test_insert_and_delete(spark):
    v = vectors(spark, ["a b c\nd", "e, f g", "a b c\nd\ne, f g"])
    df = spark.createDataFrame([(v[0], v[1], v[2])], "a array<long>, b array<long>, c array<long>")
    r = df.select(P.inserted(F.col("a"), F.col("b")).alias("i"), P.deleted(F.col("c"), F.col("b")).alias("d")).first()
    # The number of parts is the last lane of all three.
    assert r.i == v[2] and r.d == v[0]


def edited(rows):
    """The contract word for word, for distinct ids."""
    rows = sorted((i, t or "") for i, t in rows)
    for (i, t), (_, after) in zip(rows, [*rows[1:], rows[0]]):
        n = len(t) // 4
        yield i, t, t[:len(t) - n] + after[:n], after


def check(got, rows):
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, e, after in edited(rows):
        r = by[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert r.near_next == 1 if after == t else True
        assert r.near_edited == 1 if e == t else True


def test_odd_rows(spark):
    rows = [(5, "a b. c d"), (1, None), (-3, "é" * 10 + "\n x"), (9, ""), (10, "same text here"), (11, "same text here"), (2**40, "w " * 50_000)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, _v string, spot int")
    check(P.compared(docs).collect(), rows)
    alone = P.compared(docs.where("doc_id = 5")).collect()
    assert alone[0].near_next == 1 and alone[0].edited_sha256 == hashlib.sha256(b"a b. ca ").hexdigest()[:64]
    none = P.compared(docs.where("doc_id = 5").withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert [(r.doc_id, r.near_next) for r in none] == [(None, 1.0)]
    assert len(P.compared(docs.unionByName(docs)).collect()) == 2 * len(rows)
    assert P.compared(docs.limit(0)).collect() == []


def test_query_on_documents(spark):
    from meterflow.llm.queries import QUERIES
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = QUERIES["op2_fingerprints"](spark, SF_SMALL).collect()
    check(got, docs)
    same = {}
    for r, t in ((r, dict(docs)[r.doc_id] or "") for r in got):
        assert same.setdefault(t, r.fingerprint) == r.fingerprint
    assert len(set(same.values())) == len(same)
    long = [r for r in got if r.n_chars > 300]
    near = [r.near_edited for r in long]
    far = sorted(r.near_next for r in long if r.near_next < 1)
    assert sum(near) / len(near) > 0.6 and far[len(far) // 2] < 0.2
    assert sum(r.near_edited > r.near_next for r in long) > 0.97 * len(long)
    print("all", sum(r.near_edited > r.near_next for r in got), len(got))


def plain_vector(text):
    """The lanes by the docstring, with hashes of the xxhash library: (exact lanes, sums of +1 and -1)."""
    import re
    import struct

    import xxhash

    def hashes(x):
        h = xxhash.xxh64(x.encode(), seed=42).intdigest()
        return h, xxhash.xxh64(struct.pack("<i", 1), seed=h).intdigest()

    lines, parts = (text or "").split("\n"), []
    for p in lines:
        if len(p) < P.SHORT:
            parts += p.split(" ")
        else:
            for q in re.split(P.CLAUSE, p):
                parts += [q] if len(q) < P.SHORT else q.split(" ")
    parts = [x for x in parts if x]
    exact = [sum(hashes(x)[k] >> s & 0xFFFFFFFF for x in lines) & 0xFFFFFFFF for k in (0, 1) for s in (0, 32)]
    signed = [sum(1 if hashes(x)[k] >> (s + 20 * c) & 1 else -1 for x in parts) for k in (0, 1) for s in range(20) for c in range(3)]
    return exact, signed


def plain_likeness(a, b):
    def dot(x, y):
        return float(sum(i * j for i, j in zip(x[1], y[1])))

    norm = (dot(a, a) * dot(b, b)) ** 0.5
    return 1.0 if a == b else max(0.0, min(1.0, dot(a, b) / norm)) if norm else 0.0


def test_lanes_and_likeness_by_brute_force(spark):
    import math
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    rows += [(10 ** 9, "x" * 300), (10 ** 9 + 1, "\u6c34\u3001\u706b\u3002" * 60), (10 ** 9 + 2, None), (10 ** 9 + 3, "w " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in P.compared(docs).collect()}
    texts = [t or "" for _, t in rows]
    vectors = [plain_vector(t) for t in texts]
    for k, (i, _) in enumerate(rows):
        t, after = texts[k], (k + 1) % len(rows)
        cut = len(t) // 4
        edited = plain_vector(t[:len(t) - cut] + texts[after][:cut])
        assert got[i].fingerprint[:32] == "".join(f"{x:08x}" for x in vectors[k][0])
        assert math.isclose(got[i].near_edited, plain_likeness(vectors[k], edited), rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(got[i].near_next, plain_likeness(vectors[k], vectors[after]), rel_tol=1e-9, abs_tol=1e-12)


def test_long_lines_without_marks_keep_their_likeness(spark):
    rows = [(i, " ".join(f"word{(i * 7919 + j * 104729) % 10007}" for j in range(600))) for i in range(30)]
    rows += [(100 + i, "\u3001".join(chr(0x4E00 + (i * 31 + j * 17) % 4000) * 3 for j in range(300))) for i in range(10)]
    got = P.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert min(r.near_edited for r in got) > 0.5 > max(r.near_next for r in got)


def test_more_parts_than_counters_hold(spark, monkeypatch):
    """Counters of 12 bits hold a fifth of these 20,000 parts; like and unlike are still told apart."""
    monkeypatch.setattr(P, "COUNTER_BITS", 12)
    monkeypatch.setattr(P, "_SPREAD", sum(1 << (12 * k) for k in range(P.COUNTERS)))
    monkeypatch.setattr(P, "_PACKED_MASK", (1 << (12 * P.COUNTERS)) - 1)
    monkeypatch.setattr(P, "PACKED", 24)
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(20_000))) for i in range(3)]
    for r in P.compared(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert r.near_edited > 0.5 and r.near_next < 0.45
