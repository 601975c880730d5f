"""Mixing: the plan's promise, the SQL twin, odd rows."""

import random

import pytest
from pyspark.sql import functions as F

from meterflow.llm import mixing as M
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("shares", [[1], [1, 1], [3, 2, 1], [50, 5, 5, 5, 5, 5, 5, 5, 5, 5, 5], [7, 1, 1, 1, 13], [*M.SHARES.values(), M.REST]])
def test_less_than_a_block_from_the_share(spark, shares):
    q = sum(shares)
    rows = M.plan(spark, shares).collect()
    assert sorted(r.slot for r in rows) == list(range(q))
    done = [0] * len(shares)
    for r in sorted(rows, key=lambda r: r.slot):
        assert r.turn == done[r.gid]
        assert r.turn * q // shares[r.gid] <= r.slot < -(-(r.turn + 1) * q // shares[r.gid])
        done[r.gid] += 1
        for n, w in zip(done, shares):
            assert abs(n - (r.slot + 1) * w / q) < 1
    assert done == shares


def test_slots_of_blocks(spark):
    """Every block has the slot of its turn, and all documents one block each."""
    rnd = random.Random(3)
    rows = [(i, "x" * rnd.randint(0, 300), rnd.choice(["a"] * 6 + ["b", "c", None])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = M.placed(docs, ["doc_id"], {"a": 2, "b": 3}, 1, block=500).collect()
    assert sorted(r.doc_id for r in got) == list(range(600))
    slots = {}
    for r in got:
        slots.setdefault(r.slot, set()).add((r.grp, r.block))
        assert r.release <= r.slot < r.deadline
    assert all(len(s) == 1 for s in slots.values())
    size = {i: len(t) + 1 for i, t, _ in rows}
    for grp in ("a", "b", None):
        at = 0
        for r in sorted((r for r in got if r.grp == grp), key=lambda r: r.start):
            assert r.start == at and r.block == at // 500
            at += size[r.doc_id]


def test_odd_rows(spark):
    kind = "doc_id long, text string, source string, block string, _gid int"
    docs = spark.createDataFrame([(1, None, None, "z", 1), (None, "", "src0", "z", 1), (2, "a", "src1", "z", 1), (2, "a", "src1", "z", 1)], kind)
    got = M.placed(docs, ["doc_id"]).collect()
    assert sorted((r.doc_id or 0, r.grp or "", r.start) for r in got) == [(0, "src0", 0), (1, "", 0), (2, "src1", 0), (2, "src1", 2)]
    assert sorted(map(str, M.mixed(docs).collect())) == sorted(map(str, docs.collect()))
    assert M.placed(docs.limit(0), ["doc_id"]).collect() == []


def test_mixed_is_in_order_of_the_slots(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    slot = {r.doc_id: (r.slot, r.start) for r in M.placed(docs, ["doc_id"]).collect()}
    got = M.mixed(docs)
    assert got.columns == docs.columns
    order = [slot[r.doc_id] for r in got.withColumn("p", F.spark_partition_id()).collect()]
    assert order == sorted(slot.values())


def test_sql_twin(spark):
    from meterflow.llm.queries import ORACLES, QUERIES
    from tests.oracle_util import assert_same, duck
    assert assert_same(QUERIES["op1_mixing"](spark, SF_SMALL), duck(SF_SMALL), ORACLES["op1_mixing"])
