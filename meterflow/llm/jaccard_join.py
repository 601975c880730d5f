"""Documents whose word shingles have a Jaccard similarity of at least 0.9: an exact metric-space join.

1 - similarity is a metric, so distances to a common pivot bound the distance
of two sets: |d(x, p) - d(y, p)| <= d(x, y).

* Equal sets are one node from the start, however many rows have them.
* Blocks. Unrelated documents are all at distance 1 from each other and from
  any pivot, so pivots alone can't tell them apart. Sets are first cut into
  parts by shingle hash: linked sets of sizes a <= b differ in at most
  (1 - s) / s * a shingles, so with more parts than that some are equal in
  both. A block is the sets with one equal part. A part that many sets share
  (a common passage) may be left out by a set that has more other parts than
  its links can differ in: it meets all its links there. The other sets, made
  of common parts nearly whole, are cut once more into smaller parts; only
  those of them that are still so use the crowded blocks too.
* Regions. The least node of a block is its pivot. A pivot's region holds the
  sets of all its blocks, each with its exact distance; a set near several
  pivots is replicated to each. Sets within reach of the pivot are linked to it.
* Windows. Only regions in which some set isn't connected to the pivot yet go
  on, with the sets whose distance to the pivot is within reach of such a one.
* Differences. From here a set is the shingles in which it differs from its
  pivot: two sets differ in what their differences don't share. A shingle that
  no other set of the region has in its difference is shared with none, so
  their numbers bound the distance of two sets from below, and sets that no set
  of another component can be near by that bound are dropped (linear work). Edits
  of a common text mostly are.
* Recursion. A region of up to ``REGION`` sets is joined exactly in one task.
  A larger one gets new pivots: sets go to the Voronoi region of the nearest
  pivot p, and to that of any q with d(x, q) <= d(x, p) + 2 * reach, which
  holds every linked pair together; and so on. A region that pivots don't
  make smaller is dealt into blocks, every two of which meet in one task.

Links found are stars and forests, at most a few a set; components spread from
them. Nothing is sampled and no pair of linked sets is lost.

Shingles are compared by 64-bit hashes and whole sets by 128-bit ones.

Defined cases: a null or empty text (no words) has size 0 and is linked with
nothing, so its component is itself, null for a null doc_id; fewer words than a
shingle make one shingle; repeated rows come back repeated in one component; a
null doc_id keeps its row and never names a component (one of only such rows
has a null id); an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.llm.common import release, slices, written
from meterflow.llm.components import components

SHINGLE_WORDS, NUM, DEN = 3, 90, 100

#: Sets in a block from which it counts as crowded; speed only.
CROWDED = 32

#: Sets, and shingles in all, of a region that one task joins; larger regions are split first.
REGION, REGION_SHINGLES = 4096, 4_000_000

#: New pivots of a region that is split, and the share of it that a child may have before it is dealt instead (also
#: the share that a round of dropping must leave behind for another round).
PIVOTS, SHRUNK = 8, 0.8

#: Above the rounding of distances.
EPS = 1e-9

#: Bits by which texts that no step asks for are left out of a shuffle (8 MB); speed only.
BITS = 1 << 26

#: Keys of more rows than this share of all are joined by broadcast (at most 1 / HOT of them).
HOT = 1 / 1000

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: bytes | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """The sorted distinct shingle hashes of a text (UTF-8).

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and white space only.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    length = min(words, len(found))
    h = np.full(len(found) - length + 1, length, np.uint64)
    for i in range(length):
        h = _mix(h * _ODD + w[i:len(h) + i])
    return np.unique(h)


def reach(n: int) -> int:
    """Shingles in which a set of n can differ from a linked one that is no smaller."""
    return n * (DEN - NUM) // NUM


def _reaches() -> list[int]:
    """The least reach of every scheme, each a third above the one before."""
    found = [1]
    while found[-1] < 1 << 40:
        found.append(max(found[-1] + 1, found[-1] * 4 // 3))
    return found


_SCHEMES = _reaches()


def scheme(n: int) -> int:
    """The number of the way that pairs are cut whose smaller set has ``n`` shingles."""
    return bisect_right(_SCHEMES, reach(n)) - 1


def parts(h: np.ndarray, fine: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signatures, scheme, spare parts) of all parts of a set, for every scheme that its links may use.

    ``spare`` is by how many the non-empty parts outnumber the differences that
    are possible; without any, a signature shared by all such sets is added.
    """
    n, sig, schemes, spare = len(h), [], [], []
    least = -(-n * NUM // DEN)
    while reach(least) < 1 <= reach(n):
        least += 1
    mixed = _mix(h)
    for k in range(scheme(least), scheme(n) + 1) if reach(n) else ():
        most = _SCHEMES[k + 1] - 1
        count = 3 * most + 8 if fine else most + most // 8 + 3
        part = (h >> np.uint64(32)) * np.uint64(count) >> np.uint64(32)
        start = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        s = _mix(np.add.reduceat(mixed, start) + (part[start] + np.uint64(k << 56)) * _ODD)
        room = len(s) - min(reach(n), most)
        if room < 1:
            s = np.append(s, np.uint64(k))
        sig.append(s)
        schemes.append(np.full(len(s), k, np.int32))
        spare.append(np.full(len(s), room, np.int32))
    if not sig:
        return np.empty(0, np.uint64), np.empty(0, np.int32), np.empty(0, np.int32)
    return np.concatenate(sig), np.concatenate(schemes), np.concatenate(spare)


def _lists(values: list[np.ndarray], flat: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]), pa.int32()), flat)


def _set_lists(sets: list[np.ndarray]) -> pa.ListArray:
    return _lists(sets, pa.array(np.concatenate([np.empty(0, np.uint64), *sets]).view(np.int64)))


_PARTS = "array<struct<scheme:int,spare:int,sigs:array<bigint>>>"


def _part_lists(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.ListArray:
    """The parts of every set by scheme: a bare list of signatures for each costs half of what one struct a part would."""
    starts = [np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, np.int64) for _, k, _ in found]
    sigs = [part for (sig, _, _), at in zip(found, starts) for part in (np.split(sig, at[1:]) if len(at) else [])]
    flat = np.concatenate([np.empty(0, np.uint64), *sigs]).view(np.int64)
    schemes, spare = (np.concatenate([np.empty(0, np.int32), *(f[i][at] for f, at in zip(found, starts))]) for i in (1, 2))
    rows = pa.StructArray.from_arrays([pa.array(schemes), pa.array(spare), _lists(sigs, pa.array(flat))], ["scheme", "spare", "sigs"])
    return _lists(starts, rows)


def described(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n (set size), key (128-bit hash of the set) and the set's parts, of every row in place."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches):
            sets = [shingles(x) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(h) for h in sets], pa.int64()),
                pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in sets], pa.binary()),
                _part_lists([parts(h) for h in sets])], ["doc_id", "n", "key", "parts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", text).mapInArrow(run, f"doc_id {kind}, n long, key binary, parts {_PARTS}")


def blocks_of(nodes: DataFrame, crowded: int = CROWDED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """For nodes (node, parts): blocks of up to ``crowded`` sets as (pivot, node) under their least node, the
    (node, scheme) that need the others too, and those others as (sig, node, scheme)."""
    rows = nodes.select("node", F.explode("parts").alias("p")).select(F.explode("p.sigs").alias("sig"), "node", "p.scheme", "p.spare").repartition("sig")
    # All columns are read on both sides of the join, so that they share one shuffle.
    blocks = rows.groupBy("sig").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("pivot"), F.min("scheme").alias("_scheme"),
                                     F.min("spare").alias("_spare")).where("many > 1 and _scheme >= 0 and _spare is not null").drop("_scheme", "_spare")
    met = written(rows.join(blocks, "sig"), "blocks")
    few, hot = met.where(F.col("many") <= crowded), met.where(F.col("many") > crowded)
    bound = hot.groupBy("node", "scheme", "spare").agg(F.count(F.lit(1)).alias("hot")).where("hot >= spare").select("node", "scheme")
    return written(few.select("pivot", "node").distinct(), "few"), written(bound, "bound"), hot.select("sig", "node", "scheme")


def finer(texts: DataFrame, bound: DataFrame) -> DataFrame:
    """(node, parts): the smaller parts of the sets named by ``bound``, under its schemes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches):
            found = [parts(shingles(x), True) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), _part_lists(found)], ["node", "parts"])

    mine = texts.select("node", "text").join(bound.select("node").distinct(), "node", "left_semi").mapInArrow(run, f"node long, parts {_PARTS}")
    return mine.join(bound.groupBy("node").agg(F.collect_list("scheme").alias("schemes")), "node").select(
        "node", F.filter("parts", lambda p: F.array_contains("schemes", p["scheme"])).alias("parts"))


def crowded_regions(texts: DataFrame, bound: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(pivot, node) for the sets that need crowded blocks, after a cut into smaller parts."""
    few, still, hot = blocks_of(finer(texts, bound), crowded)
    hot = hot.join(still, ["node", "scheme"], "left_semi").select("sig", "node")
    pivots = hot.groupBy("sig").agg(F.count(F.lit(1)).alias("many"), F.min("node").alias("pivot")).where("many > 1")
    return few.unionByName(hot.join(pivots, "sig").select("pivot", "node")).distinct()


def _bit(key: Column) -> tuple[Column, Column]:
    at = F.pmod(F.xxhash64(key), F.lit(BITS))
    return F.bitmap_bucket_number(at), F.bitmap_bit_position(at)


def likely(docs: DataFrame, wanted: DataFrame, key: str = "doc_id", label: str = "label") -> DataFrame:
    """The rows of ``docs`` whose doc_id is a label of ``wanted``, and few others, without a shuffle: a bit for every
    label's hash, in ``BITS`` bits however many there are."""
    page, bit = _bit(F.col(label))
    pages = wanted.select(page.alias("_page"), bit.alias("_bit")).groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    page, bit = _bit(F.col(key))
    byte = F.conv(F.hex(F.substring("_bits", F.floor(F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = docs.withColumn("_page", page).withColumn("_bit", bit).join(F.broadcast(pages), "_page")
    return met.where(F.call_function("getbit", byte, F.pmod("_bit", F.lit(8)).cast("int")) == 1).select(docs.columns)


def texts_of(docs: DataFrame, wanted: DataFrame, text: str = "text") -> DataFrame:
    """(node, n, text, ...): the documents named by ``wanted`` (node, label, key, ...), with the sizes of their sets.

    Texts are what is kept and shuffled: a set's hashes don't compress and take twice a text's room.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches):
            sets = [shingles(x) for x in b.column(2).cast(pa.binary()).to_pylist()]
            # One id may name several texts.
            same = [i for i, (h, k) in enumerate(zip(sets, b.column(1).to_pylist())) if xxhash.xxh3_128_digest(h.tobytes()) == k]
            at = pa.array(same, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), pa.array([len(sets[i]) for i in same], pa.int64()),
                                              *(c.take(at) for c in b.columns[2:])], ["node", "n", "text", *more])

    more = [c for c in wanted.columns if c not in ("node", "label", "key")]
    kinds = "".join(f", {c} {wanted.schema[c].dataType.simpleString()}" for c in more)
    texts = likely(docs.select("doc_id", F.col(text).alias("_text")), wanted).join(wanted, F.col("doc_id").eqNullSafe(F.col("label")))
    found = written(texts.select("node", "key", "_text", *more).mapInArrow(run, f"node long, n long, text string{kinds}"), "texts")
    repeated = found.groupBy("node").count().where("count > 1").limit(1).count()
    return written(found.dropDuplicates(["node"]), "texts") if repeated else found


def sets_of(texts: DataFrame) -> DataFrame:
    """(node, n, set): the shingles of ``texts`` (node, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches):
            sets = [shingles(x) for x in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(h) for h in sets], pa.int64()), _set_lists(sets)], ["node", "n", "set"])

    return texts.select("node", "text").mapInArrow(run, "node long, n long, set array<bigint>")


def _linked(both: Column, a: Column, b: Column) -> Column:
    return both * DEN >= (a + b - both) * NUM


def distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (pivot, node, ...) with their exact distance ``d`` and whether they are ``linked``."""
    mine = pairs.join(sets.select("node", F.col("n").alias("_n"), F.col("set").alias("_set")), "node")
    theirs = sets.select(F.col("node").alias("pivot"), F.col("n").alias("_m"), F.col("set").alias("_other"))
    both = F.size(F.array_intersect("_set", "_other")).cast("long")
    got = mine.join(theirs, "pivot").select(*pairs.columns, "_n", "_m", both.alias("_both"))
    return got.select(*pairs.columns, _linked(F.col("_both"), F.col("_n"), F.col("_m")).alias("linked"),
                      (1 - F.col("_both") / (F.col("_n") + F.col("_m") - F.col("_both"))).alias("d"))


def differences(texts: DataFrame) -> DataFrame:
    """For texts (node, n, text, pivots) every (pivot, node) with their sizes (``whole``, ``n``), the shingles of only
    one of them (``apart``) and their number ``e``, their distance ``d`` and whether they are ``linked``. Sets are made
    where two texts meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        pivot, other = None, np.empty(0, np.uint64)
        for b in slices(batches):
            apart = []
            for p, own, at in zip(b.column(0).to_pylist(), b.column(4).cast(pa.binary()).to_pylist(), b.column(5).cast(pa.binary())):
                if p != pivot:
                    pivot, other = p, shingles(at.as_py())
                apart.append(np.setxor1d(shingles(own), other, assume_unique=True))
            yield pa.RecordBatch.from_arrays([*b.columns[:4], _set_lists(apart)], ["pivot", "node", "n", "whole", "apart"])

    mine = texts.select(F.explode("pivots").alias("pivot"), "node", "n", F.col("text").alias("_text"))
    theirs = likely(texts.select("node", "n", "text"), mine.select("pivot"), "node", "pivot").select(F.col("node").alias("pivot"), F.col("n").alias("whole"), F.col("text").alias("_other"))
    got = mine.join(theirs, "pivot").select("pivot", "node", "n", "whole", "_text", "_other")
    got = got.mapInArrow(run, "pivot long, node long, n long, whole long, apart array<bigint>")
    got = got.withColumn("e", F.size("apart").cast("long"))
    both = (F.col("n") + F.col("whole") - F.col("e")) / 2
    return got.withColumn("linked", _linked(both, F.col("n"), F.col("whole"))).withColumn("d", F.col("e") / (both + F.col("e")))


def partners(rest: np.ndarray, cost: np.ndarray, root: np.ndarray) -> tuple[list[int], list[int], list[int], list[int]]:
    """For each value v of ``rest``, ascending: (v, the least cost + SPAN * |rest - v| of all rows, its root, the least
    of the rows with another root)."""
    none = 1 << 62
    order = np.argsort(rest, kind="stable")
    rows = list(zip(rest[order].tolist(), cost[order].tolist(), root[order].tolist()))

    def put(at, c, r):
        if r == at[1]:
            at[0] = min(at[0], c)
        elif c < at[0]:
            at[0], at[1], at[2] = c, r, at[0]
        else:
            at[2] = min(at[2], c)

    def walk(rows):
        # The second root is named too: it may come first later.
        best, found, was = {}, {}, None
        for v, c, r in rows:
            if was is not None and v != was:
                best = {k: x + SPAN * abs(v - was) for k, x in best.items()}
            if c < best.get(r, none):
                best[r] = c
                if len(best) > 2:
                    del best[max(best, key=best.get)]
            found[v], was = dict(best), v
        return found

    up, down = walk(rows), walk(rows[::-1])
    out = []
    for v in up:
        at = [none, None, none]
        for found in (up[v], down[v]):
            for r, c in found.items():
                put(at, c, r)
        out.append((v, *at))
    return tuple(map(list, zip(*out))) if out else ([], [], [], [])


#: Linked sets differ in at most (DEN - NUM) / SPAN of the sum of their sizes.
SPAN = DEN + NUM


def _hopeful(group: np.ndarray, size: np.ndarray, alone: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Whether each set may be linked with one of another group, by its size and the numbers of its shingles that no
    other (``alone``) and that some other set has (``rest``): two sets differ in alone + alone' + |rest - rest'| at least."""
    cost = SPAN * alone - (DEN - NUM) * size
    value, least, its, other = (np.array(x, np.int64) for x in partners(rest, cost, group))
    at = np.searchsorted(value, rest)
    return cost + np.where(its[at] != group, least[at], other[at]) <= 0


def join_region(node: np.ndarray, group: np.ndarray, sets: list[np.ndarray], size: np.ndarray | None = None, whole: int = 0) -> list[tuple[int, int]]:
    """Links that connect the sets as all linked pairs do; pairs of one group are connected already.

    With ``size``, ``sets`` are the differences of sets of that size from one
    of size ``whole`` (by default from the empty set). Common shingles of every
    two come from products of the 0/1 matrix of the shingles that several have,
    a bounded number of columns at a time.
    """
    count = np.array([len(s) for s in sets], np.int64)
    size = count if size is None else size
    owner = np.repeat(np.arange(len(sets)), count)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = np.ones(len(sets), bool)
    while kept.any():
        shared = times[column] > 1
        rest = np.bincount(owner[shared], minlength=len(sets))
        now = kept.copy()
        now[kept] = _hopeful(group[kept], size[kept], (count - rest)[kept], rest[kept])
        few, kept = now.sum() > kept.sum() * SHRUNK, now
        if few:
            break
        times = np.bincount(column[kept[owner]], minlength=len(times))
    if not kept.any():
        return []
    shared &= kept[owner]
    place = np.cumsum(kept) - 1
    rank = np.cumsum(np.bincount(column[shared], minlength=len(times)) > 0) - 1
    owner, column = place[owner[shared]], rank[column[shared]]
    node, group, size, count = node[kept], group[kept], size[kept], count[kept]
    lacks = (count + whole - size) // 2
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    columns = int(rank[-1]) + 1 if len(rank) else 0
    kind = np.float32 if columns < 1 << 24 else np.float64
    both, width = np.zeros((len(node), len(node)), kind), max(1, 8_000_000 // len(node))
    for at in range(0, columns, width):
        lo, hi = np.searchsorted(column, [at, at + width])
        x = np.zeros((len(node), min(width, columns - at)), np.float32)
        x[owner[lo:hi], column[lo:hi] - at] = 1
        both += x @ x.T
    root = {g: g for g in group.tolist()}

    def find(g):
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    out = []
    for lo in range(0, len(node), 256):
        hi = min(lo + 256, len(node))
        common = both[lo:hi].astype(np.int64) + whole - lacks[lo:hi, None] - lacks
        near = (common * DEN >= (size[lo:hi, None] + size - common) * NUM) & (group[lo:hi, None] != group)
        for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(near, lo + 1)))):
            a, b = find(int(group[lo + i])), find(int(group[j]))
            if a != b:
                root[b] = a
                out.append((int(node[lo + i]), int(node[j])))
    return out


def _joined(small: DataFrame) -> DataFrame:
    """Links (a, b) within regions that fit one task; ``small`` is (region, node, root, n, whole, apart)."""
    def run(rows: pa.Table) -> pa.Table:
        apart = rows.column("apart").combine_chunks()
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(apart).to_numpy(zero_copy_only=False))])
        flat = apart.flatten().to_numpy()
        found = join_region(rows["node"].to_numpy(), rows["root"].to_numpy(), [flat[i:j] for i, j in zip(ends, ends[1:])],
                            rows["n"].to_numpy(), rows["whole"][0].as_py())
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return small.select("region", "node", "root", "n", "whole", "apart").groupBy("region").applyInArrow(run, "a long, b long")


def _with_sets(small: DataFrame, sets: DataFrame) -> DataFrame:
    """Members (region, node, root) with their whole sets, as differences from the empty one."""
    whole = sets.select("node", F.col("n"), F.lit(0).cast("long").alias("whole"), F.col("set").alias("apart"))
    return small.select("region", "node", "root").join(whole, "node")


def hopeful(members: DataFrame) -> DataFrame:
    """The members (region, node, n, root, whole, apart) that a set of another group of their region may be linked with."""
    met = members.select("region", "node", F.explode("apart").alias("h")).groupBy("region", "h").agg(
        F.count(F.lit(1)).alias("many"), F.min("node").alias("node"))
    alone = met.where("many = 1").groupBy("region", "node").agg(F.count(F.lit(1)).alias("alone"))
    rows = members.join(alone, ["region", "node"], "left").withColumn("alone", F.coalesce("alone", F.lit(0).cast("long")))
    rows = written(rows.withColumn("rest", F.size("apart") - F.col("alone")).withColumn("cost", SPAN * F.col("alone") - (DEN - NUM) * F.col("n")), "alone")

    def run(rows: pa.Table) -> pa.Table:
        found = partners(*(rows[c].to_numpy() for c in ("rest", "cost", "root")))
        of = pa.repeat(rows["region"][0], len(found[0]))
        return pa.table([of, *(pa.array(x, pa.int64()) for x in found)], ["region", "rest", "least", "its", "other"])

    # The two least costs of different groups stand for all sets of one ``rest``.
    least = rows.groupBy("region", "rest", "root").agg(F.min("cost").alias("cost"))
    two = least.withColumn("_at", F.row_number().over(Window.partitionBy("region", "rest").orderBy("cost", "root"))).where("_at <= 2")
    table = two.groupBy("region").applyInArrow(run, "region string, rest long, least long, its long, other long")
    able = F.col("cost") + F.when(F.col("its") != F.col("root"), F.col("least")).otherwise(F.col("other")) <= 0
    return rows.join(table, ["region", "rest"]).where(able).select(members.columns)


def _dealt(large: DataFrame, region: int, region_shingles: int) -> DataFrame:
    """Members dealt into blocks of half a region; every two blocks are a region of their own."""
    blocks = F.greatest(F.ceil(F.col("many") * 2 / region), F.ceil(F.col("total") * 2 / region_shingles)).cast("long")
    df = large.withColumn("_blocks", blocks).withColumn("_at", F.pmod(F.xxhash64("node"), F.col("_blocks")))
    return df.withColumn("_with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1))).select(
        F.concat_ws(":", "region", F.least("_at", "_with").cast("string"), F.greatest("_at", "_with").cast("string")).alias("region"), "node", "n", "root")


def _sized(members: DataFrame, size: str = "n") -> DataFrame:
    """Members (region, node, n, root) with their region's number of sets and shingles; regions of one group are done."""
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("many"), F.sum(size).alias("total"),
                                          F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi")
    return written(members.join(sizes.drop("_lo", "_hi"), "region"), "regions")


def region_links(members: DataFrame, sets: DataFrame, region: int = REGION, region_shingles: int = REGION_SHINGLES,
                 pivots: int = PIVOTS) -> list[DataFrame]:
    """Links within regions, joined recursively; ``members`` is (region, node, n, root)."""
    limit = (F.col("many") <= region) & (F.col("total") <= region_shingles)
    slack = 2 * (1 - NUM / DEN) + EPS
    found, now, depth = [], _sized(members), 0
    while True:
        found.append(written(_joined(_with_sets(now.where(limit), sets)), "links"))
        large = now.where(~limit)
        if not large.limit(1).count():
            return found
        # One pivot for every remainder of a hash: the node with the least.
        seat = F.pmod(F.xxhash64("node", F.lit(depth)), F.lit(pivots))
        chosen = large.groupBy("region", seat.alias("seat")).agg(F.min(F.struct(F.xxhash64("node", F.lit(-depth - 1)), "node"))["node"].alias("pivot"))
        far = written(distances(large.join(chosen, "region"), sets), "pivots")
        found.append(far.where("linked and node <> pivot").select(F.col("node").alias("a"), F.col("pivot").alias("b")))
        spots = far.groupBy("region", "node", "n", "root", "many", "total").agg(F.collect_list(F.struct("d", "seat")).alias("at"))
        near = F.filter("at", lambda p: p["d"] <= F.array_min("at")["d"] + slack)
        child = spots.select(F.col("region").alias("parent"), F.col("many").alias("_all"), "node", "n", "root", F.explode(near).alias("p")).select(
            "_all", F.concat_ws("/", "parent", F.col("p.seat").cast("string")).alias("region"), "node", "n", "root")
        sized = _sized(child.select("region", "node", "n", "root"))
        was = child.groupBy("region").agg(F.max("_all").alias("_all"))
        grown = sized.join(was, "region")
        stuck = ~limit & (F.col("many") > F.col("_all") * SHRUNK)
        dealt = _dealt(grown.where(stuck), region, region_shingles)
        found.append(written(_joined(_with_sets(dealt, sets)), "links"))
        now, depth = written(grown.where(~stuck).drop("_all"), "regions"), depth + 1


def difference_links(members: DataFrame, star: DataFrame, texts: DataFrame, region: int = REGION,
                     region_shingles: int = REGION_SHINGLES) -> list[DataFrame]:
    """Links within the regions of first pivots, ``members`` (region, node, n, root, whole, e), by differences from the
    pivot: ``star`` (pivot, node, apart). Regions too large for a task drop the sets without hope first, round by round,
    and those that stay too large go on as whole sets."""
    limit = (F.col("many") <= region) & (F.col("total") <= region_shingles)
    apart = star.select(F.col("pivot").cast("string").alias("region"), "node", "apart")

    def given(df: DataFrame) -> DataFrame:
        return df.drop("many", "total").join(apart, ["region", "node"], "left").withColumn(
            "apart", F.coalesce("apart", F.array().cast("array<bigint>")))

    now = _sized(members, "e")
    found = [written(_joined(given(now.where(limit))), "links")]
    large = now.where(~limit).drop("many", "total")
    before = large.count()
    while before:
        now = _sized(hopeful(given(large)).drop("apart"), "e")
        found.append(written(_joined(given(now.where(limit))), "links"))
        large = now.where(~limit).drop("many", "total")
        left = large.count()
        if left > before * SHRUNK:
            sets = written(sets_of(texts.join(large.select("node"), "node", "left_semi")), "shingles")
            return found + region_links(large.select("region", "node", "n", "root"), sets, region, region_shingles)
        before = left
    return found


def near_duplicates(docs: DataFrame, text: str = "text", crowded: int = CROWDED, region: int = REGION,
                    region_shingles: int = REGION_SHINGLES) -> DataFrame:
    """doc_id, n_shingles and component_id for every row."""
    rows = written(described(docs, text), "sets")
    nodes = written(rows.where("n > 0").groupBy("key").agg(
        F.min("doc_id").alias("label"), F.first("n").alias("n"), F.first("parts").alias("parts"), F.count(F.lit(1)).alias("copies")).withColumn(
        "node", F.monotonically_increasing_id()), "nodes")

    few, bound, _ = blocks_of(nodes.select("node", "parts"), crowded)

    def read(of: DataFrame) -> DataFrame:
        return texts_of(docs, written(nodes.select("node", "label", "key").join(of, "node"), "wanted"), text)

    regions = few.unionByName(crowded_regions(read(bound.select("node").distinct()), bound, crowded)).distinct()
    # Texts are read with their pivots, so that they go from their documents to their regions: not by node between.
    texts = read(regions.groupBy("node").agg(F.collect_list(F.when(F.col("node") != F.col("pivot"), F.col("pivot"))).alias("pivots")))
    star = written(differences(texts), "stars")
    first = components(star.where("linked").select(F.col("node").alias("a"), F.col("pivot").alias("b")))

    # Windows: sets not connected to their pivot, and those whose distance to it is within reach of one of them.
    def rooted(df: DataFrame, of: str, name: str) -> DataFrame:
        return df.join(first.select(F.col("node").alias(of), F.col("root").alias(name)), of, "left").withColumn(name, F.coalesce(name, of))

    thin = star.select("pivot", "node", "n", "whole", "e", "d")
    heads = thin.groupBy("pivot").agg(F.first("whole").alias("whole")).select(
        "pivot", F.col("pivot").alias("node"), F.col("whole").alias("n"), "whole", F.lit(0).cast("long").alias("e"), F.lit(0.0).alias("d"))
    known = rooted(rooted(thin.unionByName(heads), "node", "root"), "pivot", "_pivot_root")
    apart = F.when(F.col("root") != F.col("_pivot_root"), F.col("d"))
    span = known.groupBy("pivot").agg(F.min(apart).alias("_lo"), F.max(apart).alias("_hi")).where("_lo is not null")
    margin = 1 - NUM / DEN + EPS
    members = known.join(span, "pivot").where(F.col("d").between(F.col("_lo") - margin, F.col("_hi") + margin))
    members = members.select(F.col("pivot").cast("string").alias("region"), "node", "n", "root", "whole", "e")
    links = difference_links(members, star, texts, region, region_shingles)
    for more in links[1:]:
        links[0] = links[0].unionByName(more)
    ends = rooted(rooted(links[0], "a", "x"), "b", "y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    second = components(ends).select(F.col("node").alias("root"), F.col("root").alias("_last"))

    last = first.join(second, "root", "left").select("node", F.coalesce("_last", "root").alias("root")).unionByName(
        second.join(first.select("node"), F.col("root") == F.col("node"), "left_anti").select(F.col("root").alias("node"), F.col("_last").alias("root")))
    found = nodes.select("node", "key", "label", "copies").join(last, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = found.join(found.groupBy("root").agg(F.min("label").alias("component_id")), "root").select("key", "copies", "component_id")
    named = written(named, "components")

    # A text that very many rows share is looked up by broadcast.
    worded, total = rows.where("n > 0").select("doc_id", "n", "key"), named.agg(F.sum("copies")).first()[0] or 0
    common = F.broadcast(named.where(F.col("copies") > total * HOT).drop("copies"))
    rest = named.where(F.col("copies") <= total * HOT).drop("copies")
    joined = worded.join(common, "key").unionByName(worded.join(common, "key", "left_anti").join(rest, "key"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(
        rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")))
