"""Quality rules: measures against Python, exact tails, the promise on labelled data, the SQL twin."""

import re
from collections import Counter
from math import exp, lgamma, log

import pytest
from pyspark.sql import functions as F

from meterflow.llm import quality_rules as Q
from meterflow.llm.common import settled
from tests.conftest import SF_CHECK, SF_SMALL
from tests.oracle_util import assert_same, duck

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \t\n", "a", "a b c a b c", "a a a a a", "x y z\nx y z\n\n \nx y z ", "É # * $ % & | < > é", "a b c d a b c", "one two three " * 400,
         "w x y z w x y z w x y z", "q\r\nq\r\nq"]


def test_measures(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id int, text string, n_words int, _w string")
    got = {r.doc_id: tuple(r)[1:] for r in Q.measured(df).collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS)}


def test_colliding_hashes_fall_back_to_words(spark, monkeypatch):
    """With places of 62 bits, all hashes are equal in the few bits left."""
    monkeypatch.setattr(Q, "PLACE_BITS", 62)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string")
    got = {r.doc_id: r.n_repeat_words for r in Q.measured(df).collect()}
    assert got == {i: plain(t)[-1] for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("p, error", [(0.004, 1e-3), (0.02, 0.05), (0.3, 1e-6)])
def test_exact_tails(spark, p, error):
    rows = [(k, n) for n in (1, 10, 400, 2000, 9000) for k in (0, 1, 5, 20, 100, 2500) if k <= n]
    df = spark.createDataFrame(rows, "k long, n long")
    for r in df.select("k", "n", Q.within_risk(F.col("k"), F.col("n"), p, F.lit(error)).alias("ok")).collect():
        tail = sum(exp(lgamma(r.n + 1) - lgamma(i + 1) - lgamma(r.n - i + 1) + i * log(p) + (r.n - i) * log(1 - p)) for i in range(r.k + 1))
        assert r.ok == (tail <= error), (r.k, r.n, float(tail))


def labelled(spark, n):
    """Good documents with few symbols; one in a hundred of one stratum has many."""
    rows = [(i, " ".join(f"word{i}{j}" for j in range(60)) + (" #" * 40 if i % 100 == 0 and i % 2 else " #" * (i % 3)), "ab"[i % 2]) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    return docs, docs.select("doc_id", F.lit(1).alias("quality"))


def test_cutoffs_keep_the_promise(spark):
    docs, labels = labelled(spark, 3000)
    risk = Q.Risk(false_rejection=0.05)
    out = Q.judged(docs, labels, risk=risk)
    for r in out.join(docs, "doc_id").groupBy("lang").agg(F.avg((~F.col("kept")).cast("double")).alias("rejected")).collect():
        assert r.rejected <= risk.false_rejection
    m = settled(Q.measured(docs.select("doc_id", "text", F.col("lang").alias("stratum")), keep=("doc_id", "stratum")))
    few = Q.cutoffs(m.where("doc_id < 60"), labels, "stratum", risk).collect()
    assert all(r.symbol_ratio is None for r in few)  # too few labels prove nothing
    many = Q.cutoffs(m, labels, "stratum", risk).collect()
    assert all(r.symbol_ratio is not None for r in many)


def test_chain_ends_at_the_first_step_that_does_not_hold(spark):
    """All cutoffs in force are bounded together, and none behind a step that fails is used."""
    rows = [(i, " ".join(f"word{i}x{j}" for j in range(60)) + (" ##" * 20 if i % 50 == 0 else "") + (f"\nline {i}" * 30 if i % 50 == 1 else ""), "a")
            for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    m = settled(Q.measured(docs.select("doc_id", "text", F.col("lang").alias("stratum")), keep=("doc_id", "stratum")))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))

    def chain(share, cutoffs):
        return Q.cutoffs(m, labels, "stratum", Q.Risk(share, 0.05, cutoffs)).first()

    symbols, lines = {"symbol_ratio": [0.1, 0.9]}, {"dup_line_ratio": [0.5, 0.99]}
    assert chain(0.035, symbols).symbol_ratio == 0.1 and chain(0.035, lines).dup_line_ratio == 0.5  # each alone rejects 2 %
    both = chain(0.035, symbols | lines)  # together 4 %: only the first gets its strict cutoff
    assert (both.symbol_ratio, both.dup_line_ratio) == (0.1, 0.99)
    turned = chain(0.035, lines | symbols)
    assert (turned.dup_line_ratio, turned.symbol_ratio) == (0.5, 0.9)
    early = chain(0.01, symbols | lines)
    assert (early.symbol_ratio, early.dup_line_ratio) == (0.9, None)
    assert (chain(0.06, symbols | lines).dup_line_ratio, chain(0.05, {}).symbol_ratio) == (0.5, None)


@pytest.mark.parametrize("n", [(1 << 14) - 1, 1 << 14, (1 << 14) + 5, 250_000])
def test_texts_whose_places_do_not_fit(spark, monkeypatch, n):
    """From 2 ** PLACE_BITS words on (here 2 ** 14) windows are compared as words; the counts stay the same, in linear time."""
    monkeypatch.setattr(Q, "PLACE_BITS", 14)
    # Made of a column, so that it is no constant of the plan.
    text = spark.range(1).select(F.col("id").alias("doc_id"), F.concat(
        F.repeat(F.lit("a "), (F.col("id") + n - 9).cast("int")), F.lit("x y z w x y z v u")).alias("text"))
    r = Q.measured(text).first()
    # Of the tail only x y z, twice, repeats; the run of "a" is covered whole.
    assert (r.n_words, r.n_repeat_words) == (n, n - 9 + 6)


def test_junk_of_the_given_table_is_rejected(spark):
    """The cutoffs take effect, and keep their promise on the good documents."""
    d = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("documents", "labels"))
    got = settled(Q.judged(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").join(
        labels.select("doc_id", "quality"), "doc_id").where("not base_failed"))
    by = {r.lang: r for r in got.groupBy("lang").agg(
        F.count_if(F.expr("quality = 1")).alias("good"), F.count_if(F.expr("quality = 1 and not kept")).alias("lost"),
        F.count_if(F.expr("quality <> 1 and not kept")).alias("junk")).collect()}
    assert all(r.lost <= 0.01 * r.good for r in by.values())
    assert {x for x, r in by.items() if r.junk} >= {"en", "fr", "de"}
    assert sum(r.junk for r in by.values()) > 200


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, None), (None, "w " * 60, "en"), (2, "a b c d e f g " * 10, "en"), (2, "a b c d e f g " * 10, "en")],
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (99, 1, 0), (None, 1, 1)], "doc_id long, quality int, kept int")
    got = sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in Q.judged(docs, labels).collect())
    assert got == [(0, 60, True, False), (1, 0, True, False), (2, 70, True, False), (2, 70, True, False)]
    assert Q.judged(docs, labels.limit(0)).count() == 4 and Q.judged(docs.limit(0), labels).collect() == []


@pytest.mark.parametrize("d", [SF_SMALL, SF_CHECK, "/root/testdata/sf0.1"])
def test_sql_twin(spark, d):
    from meterflow.llm.queries import ORACLES, QUERIES
    assert assert_same(QUERIES["op8_quality_rules"](spark, d), duck(d), ORACLES["op8_quality_rules"])
