"""SimHash groups against brute force."""

import random
import re

import pytest
import xxhash

from meterflow.llm import simhash as S

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in runs]
    return sum(1 << i for i in range(64) if sum(x >> i & 1 for x in h) * 2 > len(h))


def brute_groups(fps):
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {x: find(x) for x in fps}


@pytest.mark.parametrize("text", [None, "", " \t\n", "a", "A b", "É x\x1cy Z", "the quick Brown fox " * 300, "w" * 5000])
def test_fingerprint(text):
    assert S.fingerprint_of(None if text is None else text.encode()) == brute_fingerprint(text)


@pytest.mark.parametrize("hot", [512, 2])
def test_groups_connect_as_all_pairs_do(spark, hot):
    """Families of near fingerprints, with and without the path for crowded tables."""
    rnd = random.Random(7)
    fps = set()
    for _ in range(6):
        c = rnd.getrandbits(64)
        fps.add(c)
        for _ in range(12):
            x = c
            for b in rnd.sample(range(64), rnd.randint(1, 4)):
                x ^= 1 << b
            fps.add(x)
    fps |= {0, 1, (1 << 63) | 3, (1 << 64) - 1}
    signed = {x: x - (1 << 64) if x >> 63 else x for x in fps}
    nodes = spark.createDataFrame([(s, i) for i, s in enumerate(signed.values())], "fp long, label long")
    edges = S.links(nodes.select("fp"), hot)
    for e in edges.collect():
        assert ((e.a ^ e.b) & ((1 << 64) - 1)).bit_count() <= 3
    got = {r.fp: r.component for r in S.grouped(nodes, edges).collect()}
    want = brute_groups(fps)
    least = {}
    for i, x in enumerate(signed):
        least[want[x]] = min(least.get(want[x], i), i)
    assert got == {signed[x]: least[want[x]] for x in fps}


def test_rows_nulls_repeats_and_clashing_columns(spark):
    rows = [(1, "a b c d", 5), (2, None, 6), (3, "", 7), (3, "", 7), (None, "a b c d", 8), (9, "other words all over here", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp long").withColumnsRenamed({"fp": "component"})
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in S.near_duplicates(docs).collect()), key=str)
    fp = [format(brute_fingerprint(t), "016x") for _, t, _ in rows]
    want = [(1, fp[0], 1), (2, "0" * 16, 2), (3, "0" * 16, 2), (3, "0" * 16, 2), (None, fp[0], 1), (9, fp[5], 9)]
    assert got == sorted(want, key=str)


def test_empty_table(spark):
    assert S.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_on_documents(spark):
    from meterflow.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    fp = {r.doc_id: brute_fingerprint(r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    group = brute_groups(set(fp.values()))
    least = {}
    for i, x in sorted(fp.items()):
        least.setdefault(group[x], i)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, d).collect()}
    assert got == {i: (format(x, "016x"), least[group[x]]) for i, x in fp.items()}


def test_one_large_family_makes_few_links_and_rows(spark):
    """Links and the rows of every join stay a small multiple of the fingerprints."""
    rnd = random.Random(3)
    center = rnd.getrandbits(63)
    fps = {center}
    while len(fps) < 1000:
        x = center
        for b in rnd.sample(range(63), rnd.randint(1, 3)):
            x ^= 1 << b
        fps.add(x)
    nodes = spark.createDataFrame([(x, i) for i, x in enumerate(fps)], "fp long, label long")
    edges = S.written(S.links(nodes.select("fp")), "t")
    assert edges.count() < 3 * len(fps)
    assert {r.component for r in S.grouped(nodes, edges).collect()} == {0}


def test_an_id_that_names_several_texts_loses_none(spark):
    texts = ["one text about the river and its banks today", "quite another matter of bread and salt at home", "a third thing with no words like those"]
    rows = [(5, texts[0]), (5, texts[1]), (7, texts[1]), (9, texts[2]), (9, texts[2]), (None, texts[2]), (11, texts[0])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, h string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in S.deduplicated(docs).collect()), key=str)
    assert got == sorted([(5, texts[0]), (5, texts[1]), (9, texts[2]), (None, texts[2])], key=str)


def test_points_carry_their_size_and_least_member(spark):
    """No aggregate or join of its own for the star's centers and the points' sizes."""
    from meterflow.llm.simhash import _live

    met = spark.createDataFrame([(5, 0, 1, 0, True), (3, 0, 1, 0, True), (2, 0, 1, 0, False), (5, 0, 2, 0, True), (3, 1, 1, 0, False), (2, 1, 1, 0, False)],
                                "fp long, seg int, point long, rest long, member boolean")
    state = spark.createDataFrame([(5, 2), (3, 3), (2, 2)], "fp long, root long")
    got = sorted((r.fp, r.seg, r.point, r.root, r.n, r.center, r.center_root) for r in _live(met, state).collect())
    assert got == [(2, 0, 1, 2, 3, 3, 3), (3, 0, 1, 3, 3, 3, 3), (5, 0, 1, 2, 3, 3, 3)]
