"""The pipeline against a brute-force version, stage by stage, and on odd tables."""

import itertools
import random
import re
from collections import Counter

import corpus_pipeline as C
from meterflow.llm import mixing, secret_scan
from tests.conftest import SF_SMALL

from .test_packing import check
from .test_secret_scan import RANKS
from .test_simhash import brute_fingerprint, brute_groups


def apply(spark, docs, tmp_path, upto):
    for k, (_, stage) in enumerate(C.STAGES[:upto]):
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    return docs


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    apply(spark, docs, tmp_path, 5)
    got = [spark.read.parquet(f"{tmp_path}/{k}") for k in range(5)]
    assert all(g.columns == docs.columns for g in got[:4])

    kept = {i: r for i, r in rows.items() if re.search(r"[^\W\d_]", r.text or "")}
    first = {r.doc_id: r for r in got[0].collect()}
    assert set(first) <= set(kept) and len(first) >= 0.99 * len(kept)
    assert all(first[i] == rows[i] for i in first)

    fp = {i: brute_fingerprint(r.text) for i, r in first.items()}
    group = brute_groups(set(fp.values()))
    least = {}
    for i in sorted(fp):
        least.setdefault(group[fp[i]], i)
    second = {r.doc_id: r for r in got[1].collect()}
    assert set(second) == set(least.values()) and all(second[i] == rows[i] for i in second)

    third = {r.doc_id: r for r in got[2].collect()}
    assert set(third) == set(second)
    for i, r in third.items():
        text = second[i].text
        spans = secret_scan.base_spans(text)
        spans += secret_scan.guess_spans(text, spans, RANKS, secret_scan.LEAST_COST)
        covered = [any(a <= k < b for _, a, b, _ in spans) for k in range(len(text))]
        want = re.sub("\0+", "\0", "".join("\0" if c else x for x, c in zip(text, covered)))
        assert r.text.replace(secret_scan.MASK, "\0") == want or spans
        assert r.n_chars == (len(r.text) if spans else rows[i].n_chars) and bool(spans) == (r.text != text)
        assert not secret_scan.base_spans(r.text)

    fourth = got[3].collect()
    assert sorted(map(str, fourth)) == sorted(map(str, third.values()))
    assert check(got[4].collect(), [(r.doc_id, r.text) for r in fourth]) == 0


def test_run_is_the_stages_in_turn(spark):
    pieces = C.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} <= set(range(200)) and len(pieces) > 50


def test_odd_rows(spark, tmp_path):
    kind = "doc_id long, text string, lang string, source string, n_chars long, score string, _gid int, _text string"
    rows = [(1, "the one and the other word", "en", "src0", 26, "x", 1, "t"), (1, "the one and the other word", "en", "src0", 26, "x", 1, "t"),
            (2, None, "en", None, 0, "x", 1, "t"), (3, "12 !", None, "src1", 4, "x", 1, "t"), (4, 'api_key = "abcdef123"', "en", "zzz", None, "x", 1, "t"),
            (None, "without an id", None, "src3", 13, "x", 1, "t")]
    docs = spark.createDataFrame(rows, kind)
    got = apply(spark, docs, tmp_path, 4)
    assert got.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text, r.n_chars) for r in got.collect()) == [
        (0, "without an id", 13), (1, rows[0][1], 26), (4, '[secret]"', 9)]
    empty = docs.limit(0)
    for _, stage in C.STAGES:
        empty_out = stage(spark, empty, SF_SMALL)
        assert empty_out.collect() == []


def test_every_prefix_of_the_sequences_is_near_the_weights(spark, tmp_path, monkeypatch):
    """Two periods of all sources and as much again of src19 alone, with texts of many blocks, over many files."""
    rng, rows, weights = random.Random(5), [], {**mixing.SHARES, "other": mixing.REST}
    for source, w in weights.items():
        left, sizes = (2 * w + (60 if source == "src19" else 0)) * mixing.BLOCK, itertools.cycle([3000, 9 * mixing.BLOCK, 700, 30_000])
        while left > 0:
            size = min(left, next(sizes))
            rows.append((len(rows), "word " * (size // 5), source))
            left -= size
    rng.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8).write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(C, "STAGES", C.STAGES[-2:])
    pieces = sorted(C.run(spark, str(tmp_path)).collect(), key=lambda r: (r.sequence_id, r.offset))
    assert sum(r.length for r in pieces) == sum(len(t) // 5 + 1 for _, t, _ in rows)

    source_of, have, total, block = {d: s for d, _, s in rows}, Counter(), 0, mixing.BLOCK / 5
    for _, sequence in itertools.groupby(pieces, key=lambda r: r.sequence_id):
        for r in sequence:
            have[source_of[r.doc_id]] += r.length
            total += r.length
        if total > 190 * block:
            break
        # Pfair is off by less than a block, and an open group of slots by what it holds.
        assert all(abs(have[s] - total * w / 100) <= 5 * block for s, w in weights.items()), (total / block, have)
