"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest

from meterflow.llm import jaccard_join as J
from tests.conftest import SF_SMALL

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingle_set(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + 3]) for i in range(len(w) - 2)) if len(w) > 2 else frozenset([tuple(w)] if w else [])


def linked(a, b):
    both = len(a & b)
    return both * 100 >= 90 * (len(a) + len(b) - both)


def brute(rows):
    """rows of (doc_id, text) -> sorted (doc_id, size, component)."""
    sets = [shingle_set(t) for _, t in rows]
    nodes = sorted({s for s in sets if s}, key=len)
    root = {s: s for s in nodes}

    def find(s):
        while root[s] is not s:
            root[s] = root[root[s]]
            s = root[s]
        return s

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if len(a) * 100 < 90 * len(b):
                break
            if linked(a, b):
                root[find(a)] = find(b)
    least = {}
    for (i, _), s in zip(rows, sets):
        if s and i is not None:
            least[find(s)] = min(least.get(find(s), i), i)
    return sorted(((i, len(s), least.get(find(s)) if s else i) for (i, _), s in zip(rows, sets)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "k", "s") for i, t in rows], "doc_id long, text string, n int, key string, node string").repartition(4)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at, kind = rng.randrange(len(words)), rng.random()
        if kind < 0.4:
            words[at] = f"new{rng.randrange(10 ** 9)}"
        elif kind < 0.7:
            words.insert(at, f"more{rng.randrange(10 ** 9)}")
        elif len(words) > 4:
            del words[at]
    return words


def corpus(seed=1):
    """Families around a text (kept or not), texts that share a passage, chains, short texts, copies."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10 ** 9)}" for _ in range(n)]
    texts = []
    for size in (10, 13, 14, 30, 60, 100, 200, 800):
        base = fresh(size)
        texts += [base] + [edited(rng, base, rng.randrange(0, 2 + size // 25)) for _ in range(14)]
    passage = fresh(60)
    texts += [fresh(rng.randrange(4, 20)) + passage for _ in range(50)]
    chain = fresh(150)
    for _ in range(12):
        texts.append(chain)
        chain = edited(rng, chain, 2)
    texts += [fresh(n) for n in (1, 1, 2, 3, 5)] + [["a"], ["A"], ["a", "b"], ["a", "B"], ["a", "b", "c"], ["a", "b", "c", "a", "b", "c"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows + [(1000, None), (1001, ""), (1001, "\t \n"), (None, "a b"), (None, None), rows[0], rows[0], (rows[1][0], "another text under one id")]


def test_query(spark):
    from meterflow.llm.queries import QUERIES
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert result(QUERIES["op13_jaccard_join"](spark, SF_SMALL)) == brute(rows)


@pytest.mark.parametrize("crowded, region", [(1, 512), (3, 8)])
def test_components_as_of_all_pairs(spark, crowded, region):
    """With crowded blocks, and with regions that are split by pivots and dealt."""
    rows = corpus()
    assert result(J.near_duplicates(frame(spark, rows), crowded=crowded, region=region)) == brute(rows)


def test_a_family_without_its_centre(spark):
    """Edits of a text that isn't there are mostly unlinked and all as far apart: regions are dealt, and stay exact."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, base, rng.choice([1, 2, 2, 3])))) for i in range(30)]
    assert result(J.near_duplicates(frame(spark, rows), crowded=4, region=8)) == brute(rows)


def test_a_large_family_makes_few_rows(spark):
    """Rows of regions stay in proportion to the sets, however large a family is."""
    rng = random.Random(6)
    base = [f"w{i}" for i in range(100)]
    counts = []
    for m in (200, 400):
        rows = [(i, " ".join(edited(rng, base, 1))) for i in range(m)]
        found = J.described(frame(spark, rows)).where("n > 0").groupBy("key").agg(J.F.first("parts").alias("parts")).withColumn(
            "node", J.F.monotonically_increasing_id())
        few, bound, _ = J.blocks_of(J.written(found, "t").select("node", "parts"))
        counts.append(few.count() + bound.count())
    assert counts[1] < 3 * counts[0]


def test_empty_table_and_very_long_text(spark):
    assert J.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    rng = random.Random(8)
    long = [f"w{rng.randrange(10 ** 9)}" for _ in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(edited(rng, long, 900))), (3, " ".join(long[:50_000])), (4, "x" * 300_000)]
    assert result(J.near_duplicates(frame(spark, rows))) == brute(rows)


def test_linked_sets_share_a_part_that_both_may_use():
    """The rule of blocks, on random linked pairs: equal parts outnumber what either may leave out."""
    rng = np.random.default_rng(0)
    for n in [9, 10, 11, 17, 18, 19, 40, 90, 300, 2000]:
        for _ in range(30):
            a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
            cut = int(rng.integers(0, J.reach(n) + 1))
            b = np.unique(np.concatenate([rng.permutation(a)[cut:], rng.integers(0, 2 ** 63, int(rng.integers(0, J.reach(n) + 1))).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if both * 100 < 90 * (len(a) + len(b) - both) or cut == 0 and len(b) == len(a):
                continue
            k = J.scheme(min(len(a), len(b)))
            for fine in (False, True):
                p, q = J.parts(a, fine), J.parts(b, fine)
                x, y = ({int(s) for s, at in zip(*f[:2]) if at == k} for f in (p, q))
                for f, own in ((p, x), (q, y)):
                    spare = {int(v) for v, at in zip(f[2], f[1]) if at == k}
                    assert len(spare) == 1 and len(x & y) >= max(1, spare.pop(), len(own) - J.reach(min(len(a), len(b))))


def test_regions_join_as_all_pairs_do():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 10 ** 6, 60)
    sets = [np.unique(np.concatenate([rng.permutation(base)[rng.integers(0, 5):], rng.integers(0, 10 ** 6, rng.integers(0, 5))])) for _ in range(40)]
    links = J.join_region(np.arange(40), np.arange(40), sets)
    plain = {(i, j) for i in range(40) for j in range(i) if linked(frozenset(sets[i]), frozenset(sets[j]))}
    assert all((max(l), min(l)) in plain for l in links) and len(links) < 40

    def groups(edges):
        root = list(range(40))
        for _ in range(40):
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        return root

    assert groups(links) == groups(plain)


def test_edits_of_a_common_text_are_dropped_before_pairs(spark, monkeypatch):
    """A family whose members are too far apart is settled by counts of its differences: none is dealt or copied."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(160)]
    rows = [(0, " ".join(base))] + [(i, " ".join(edited(rng, base, 1 if i % 3 else 8))) for i in range(1, 61)]
    went_on, links = [], J.region_links
    monkeypatch.setattr(J, "region_links", lambda members, *a: went_on.append(members.count()) or links(members, *a))
    assert result(J.near_duplicates(frame(spark, rows), crowded=4, region=8)) == brute(rows)
    assert sum(went_on) == 0


def test_a_set_has_hope_as_by_all_pairs():
    rng = np.random.default_rng(2)
    for _ in range(200):
        m = int(rng.integers(1, 30))
        group, size = rng.integers(0, int(rng.integers(1, 6)), m), rng.integers(20, 60, m)
        alone, rest = rng.integers(0, 8, m), rng.integers(0, 8, m)
        plain = [any(group[i] != group[j] and 190 * (alone[i] + alone[j] + abs(rest[i] - rest[j])) <= 10 * (size[i] + size[j])
                     for j in range(m)) for i in range(m)]
        assert J._hopeful(group, size, alone, rest).tolist() == plain


def test_regions_join_by_differences_as_by_sets():
    rng = np.random.default_rng(3)
    for _ in range(40):
        base = np.unique(rng.integers(0, 2000, 80))
        cut = lambda: rng.permutation(base)[int(rng.integers(0, 12)):]
        sets = [np.unique(np.concatenate([cut(), rng.integers(0, 2000, rng.integers(0, 8))])) for _ in range(30)]
        group = rng.integers(0, 25, 30)
        apart, size = [np.setxor1d(s, base) for s in sets], np.array([len(s) for s in sets])
        by_sets = J.join_region(np.arange(30), group, sets)
        assert J.join_region(np.arange(30), group, apart, size, len(base)) == by_sets
        plain = [(i, j) for i in range(30) for j in range(i + 1, 30) if group[i] != group[j] and linked(frozenset(sets[i]), frozenset(sets[j]))]
        joined = {g: g for g in group.tolist()}
        for a, b in by_sets:
            assert (a, b) in plain
            old, new = joined[int(group[a])], joined[int(group[b])]
            joined = {g: new if r == old else r for g, r in joined.items()}
        assert all(joined[int(group[i])] == joined[int(group[j])] for i, j in plain)


def test_only_texts_that_are_asked_for_are_sent(spark):
    """No wanted id is left out, null among them, and most others are."""
    docs = spark.range(4000).selectExpr("if(id = 7, null, id) as doc_id", "cast(id as string) as text")
    wanted = spark.createDataFrame([(None,), *((i,) for i in range(0, 4000, 40))], "label long")
    found = {r.doc_id for r in J.likely(docs, wanted).collect()}
    assert found >= {None, *range(0, 4000, 40)} and len(found) < 300
    assert J.likely(docs, wanted.limit(0)).count() == 0


def test_texts_go_to_their_regions_in_one_shuffle_and_sets_in_none(spark, monkeypatch):
    """Texts are read with their pivots and meet them after one exchange by pivot; no whole set is kept or dealt."""
    rng = random.Random(10)
    base = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(edited(rng, base, 1))) for i in range(20)] + [(20 + i, " ".join(edited(rng, base[::-1], 6))) for i in range(20)]
    kept, apart, write, differ = [], [], J.written, J.differences
    monkeypatch.setattr(J, "written", lambda df, name: kept.append(df.columns) or write(df, name))
    monkeypatch.setattr(J, "differences", lambda texts: apart.append((texts, differ(texts))) or apart[-1][1])
    assert result(J.near_duplicates(frame(spark, rows), crowded=4)) == brute(rows)
    assert not [c for c in kept if "set" in c]
    plan = apart[0][1]._jdf.queryExecution().executedPlan().toString()
    by = re.findall(r"hashpartitioning\((\w+?)#", plan)
    assert by.count("pivot") <= 2 and set(by) <= {"pivot", "_page"}
    sets = {r.node: {x % 2 ** 64 for x in r.set} for r in J.sets_of(apart[0][0]).collect()}
    found = apart[0][1].collect()
    assert found and all((r.n, r.whole) == (len(sets[r.node]), len(sets[r.pivot])) and r.e == len(r.apart) and
                         {x % 2 ** 64 for x in r.apart} == sets[r.node] ^ sets[r.pivot] for r in found)
