"""SimHash near-duplicates by multi-index hashing.

Each text gets a 64-bit SimHash of its word shingles. Two documents are linked
if their fingerprints differ in at most ``MAX_BITS`` = 3 bits, and a group is
all that links reach. The search works on distinct fingerprints only:

* A fingerprint is two segments of 32 bits. If two fingerprints differ in at
  most 3 bits, one of their segments differs in at most one, so probing a
  table of each segment with every value within one bit meets every pair.
  Of two segments one bit apart only the one with the 0 there probes.
* Whole distances are verified on what the tables return.
* A large family of near copies would return the square of its size, so stars
  come first: what meets at a point is compared with one member there. A
  family falls into few groups that way, and points at which all belong to one
  group are dropped before any pair is formed.
* A point that then still holds more than ``HOT`` fingerprints deals them and
  the probes out by the points near their other segment: members to the
  points within two bits, probes to those within one. All that meet at a point
  with a member within one bit of it are within 3 bits of that member, and any
  two linked ones meet at such a point, so a star around one such member
  keeps the connections whole.

Groups are found by spreading the least label along links and labels, settled
in the shared checkpoint folder after each round.

Defined cases: a null or empty text has no words and fingerprint zero, linked
like any other; fewer words than a shingle make one shingle; repeated rows
come back repeated, in one group; a null doc_id keeps its row and never names
a group (a group of only such rows has a null id); an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterflow.llm.common import release, slices, written
from meterflow.llm.components import components

SHINGLE_WORDS, SEED, MAX_BITS = 3, 42, 3

#: Fingerprints under one segment value from which points are used, not pairs: about where they cost as much.
HOT = 512

#: Hashes are summed as bytes in runs of this many, so that no byte overflows.
_RUN = 255
_LANES = np.uint64(0x0101010101010101)


def fingerprint_of(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """The SimHash of one text (UTF-8) as an unsigned 64-bit number.

    ``bytes.lower`` and ``bytes.split`` know ASCII letters and white space only.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    runs = zip(*[words[i:] for i in range(shingle)]) if len(words) > shingle else [words]
    digest, seed = xxhash.xxh64_digest, SEED
    h = np.frombuffer(b"".join([digest(x, seed) for x in map(b" ".join, runs)]), ">u8").astype(np.uint64)
    at = np.arange(0, len(h), _RUN)
    ones = np.empty((8, 8), np.int64)  # by bit of a byte, then byte
    for bit in range(8):
        sums = np.add.reduceat((h >> np.uint64(bit)) & _LANES, at)
        ones[bit] = sums.view(np.uint8).reshape(-1, 8).sum(0, dtype=np.int64)
    return int(np.packbits(ones.T.ravel() * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, ``fp`` (the 64 bits as a signed long) and a hash ``h`` of the text, of every row in place: no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for b in slices(batches):
            fp = np.array([fingerprint_of(x, shingle) for x in b.column(1).cast(pa.binary()).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)], ["doc_id", "fp", "h"])

    kind = docs.schema["doc_id"].dataType
    return docs.select("doc_id", text, F.xxhash64(text).alias("_h")).mapInArrow(
        run, T.StructType([T.StructField("doc_id", kind), T.StructField("fp", T.LongType()), T.StructField("h", T.LongType())]))


def _bits_apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _segments(fps: DataFrame) -> DataFrame:
    """(fp, seg, val, rest): both halves of every fingerprint, each with the other half."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    half = F.explode(F.array(
        F.struct(F.lit(0).alias("seg"), high.alias("val"), low.alias("rest")),
        F.struct(F.lit(1).alias("seg"), low.alias("val"), high.alias("rest"))))
    return fps.select("fp", half.alias("h")).select("fp", "h.seg", "h.val", "h.rest")


def _raised(val: Column) -> Column:
    """Every value one bit above ``val`` (a 0 of its 32 bits set)."""
    ones = F.array(*[F.lit(1 << i).cast("long") for i in range(32)])
    return F.transform(F.filter(ones, lambda b: val.bitwiseAND(b) == 0), lambda b: val.bitwiseOR(b))


def links(fps: DataFrame, hot: int = HOT) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that are within MAX_BITS, a few a fingerprint.

    Every link returned is within MAX_BITS. What is connected already is
    dropped before anything is joined: first stars under equal segment values,
    then stars at the points where different groups still meet (a segment value
    and the probes that hit it), as long as they find something, and last all
    pairs at the points that are left, one link kept for every two groups.
    """
    seg = _segments(fps)
    centers = seg.groupBy("seg", "val").agg(F.min("fp").alias("b"), F.count(F.lit(1)).alias("n")).where("n > 1")
    found = written(seg.select("seg", "val", F.col("fp").alias("a")).join(centers, ["seg", "val"]).where(
        (F.col("a") != F.col("b")) & (_bits_apart(F.col("a"), F.col("b")) <= MAX_BITS)).select("a", "b").distinct(), "stars")
    state = _rooted(fps.select("fp", F.col("fp").alias("root")), found)
    met = seg.select("fp", "seg", F.col("val").alias("point"), "rest", F.lit(True).alias("member")).unionByName(
        seg.select("fp", "seg", F.explode(_raised(F.col("val"))).alias("point"), "rest", F.lit(False).alias("member")))
    live = _live(met, state)
    while True:
        more = _one_a_pair(live.select(F.col("fp").alias("a"), F.col("center").alias("b"), "root", F.col("center_root").alias("_root")))
        if not more.limit(1).count():
            break
        found = found.unionByName(more.select("a", "b"))
        live = _live(live.drop("root", "n", "center", "center_root"), _rooted(live.select("fp", "root").distinct(), more.select(F.col("root").alias("a"), F.col("_root").alias("b")), "root"))
    few, many = live.where(F.col("n") <= hot), live.where(F.col("n") > hot)
    pairs = few.where("member").select("seg", "point", F.col("fp").alias("a"), "root").join(
        few.select("seg", "point", F.col("fp").alias("b"), F.col("root").alias("_root")), ["seg", "point"])
    found = found.unionByName(_one_a_pair(pairs.select("a", "b", "root", "_root")).select("a", "b"))
    if many.limit(1).count():
        rows = many.withColumnRenamed("point", "val").select("seg", "val", "rest", "fp", "member")
        roots = live.select("fp", "root").distinct()
        stars = _stars(rows.where("member").drop("member"), rows.where("not member").drop("member")).select(F.col("fp").alias("a"), F.col("other").alias("b"))
        stars = stars.join(roots.withColumnsRenamed({"fp": "a"}), "a").join(roots.withColumnsRenamed({"fp": "b", "root": "_root"}), "b")
        found = found.unionByName(_one_a_pair(stars).select("a", "b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _rooted(state: DataFrame, edges: DataFrame, node: str = "fp") -> DataFrame:
    """``state`` (fp, root) with the roots that ``edges`` between its ``node`` values lead to."""
    to = components(edges).select(F.col("node").alias(node), F.col("root").alias("_to"))
    return written(state.join(to, node, "left").select("fp", F.coalesce("_to", "root").alias("root")), "roots")


def _live(met: DataFrame, state: DataFrame) -> DataFrame:
    """What meets at points that a member and several groups share: (fp, seg, point, rest, member, root), with the
    number ``n`` of a point's rows and its least member, ``center``, in all of them."""
    rows, member = met.join(state, "fp"), F.when(F.col("member"), F.col("fp"))
    open_ = rows.groupBy("seg", "point").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("n"), F.min(member).alias("center"),
        F.min_by("root", member).alias("center_root")).where("center is not null and lo <> hi").drop("lo", "hi")
    return written(rows.join(open_, ["seg", "point"]).select("fp", "seg", "point", "rest", "member", "root", "n", "center", "center_root"), "live")


def _one_a_pair(pairs: DataFrame) -> DataFrame:
    """One link (a, b) within MAX_BITS for every two groups (root, _root) that have some."""
    near = (F.col("root") != F.col("_root")) & (_bits_apart(F.col("a"), F.col("b")) <= MAX_BITS)
    return written(pairs.where(near).groupBy("root", "_root").agg(F.min(F.struct("a", "b")).alias("l")).select("l.a", "l.b", "root", "_root"), "pairs")


def _stars(many: DataFrame, strangers: DataFrame) -> DataFrame:
    """(fp, other): stars under crowded segment values, for members and for probes one bit off, both (seg, val, rest, fp)."""
    one = [0, *[1 << i for i in range(32)]]
    two = [(1 << i) | (1 << j) for i in range(32) for j in range(i)]

    def points(df: DataFrame, offsets: list[int], center: bool) -> DataFrame:
        spots = F.explode(F.array(*[F.lit(o).cast("long") for o in offsets]))
        return df.select("seg", "val", "rest", "fp", spots.alias("o")).select(
            "seg", "val", F.col("rest").bitwiseXOR(F.col("o")).alias("point"), "fp", F.lit(center).alias("center"))

    met = points(many, one, True).unionByName(points(many, two, False)).unionByName(points(strangers, one, False))
    spot = ["seg", "val", "point"]
    middle = met.groupBy(*spot).agg(
        F.min(F.when(F.col("center"), F.col("fp"))).alias("middle"), F.count(F.lit(1)).alias("n")).where(
        "middle is not null and n > 1")
    return met.join(middle, spot).where(F.col("fp") != F.col("middle")).select(
        F.col("middle").alias("fp"), F.col("fp").alias("other"))


def grouped(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, root, component): a group's least fingerprint and least ``label``, for nodes (fp, label) and edges (a, b)."""
    roots = components(edges).select(F.col("node").alias("fp"), "root")
    state = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return state.join(state.groupBy("root").agg(F.min("label").alias("component")), "root").select("fp", "root", "component")


def _marked(docs: DataFrame, text: str, shingle: int, hot: int) -> DataFrame:
    """doc_id, fp, root, component and the text's hash ``h`` of every row."""
    fp = written(fingerprints(docs, text, shingle), "fingerprints")
    nodes = written(fp.groupBy("fp").agg(F.min("doc_id").alias("label")), "nodes")
    return fp.join(grouped(nodes, links(nodes.select("fp"), hot)), "fp")


def near_duplicates(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id for every row."""
    return _marked(docs, text, shingle, hot).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))


def deduplicated(docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, hot: int = HOT) -> DataFrame:
    """One row of each group: one of its least doc_id.

    An id may name several texts: each is kept or dropped with its own group
    (of a group's texts under its least id, the one with the least hash stays;
    rows that repeat an id and a text are one). Rows without an id have no name
    to go by and all stay.
    """
    named = docs.where("doc_id is not null")
    first = _marked(named, text, shingle, hot).where("doc_id = component").groupBy("root", "doc_id").agg(F.min("h").alias("_h")).drop("root")
    return named.withColumn("_h", F.xxhash64(text)).join(first, ["doc_id", "_h"], "left_semi").dropDuplicates(["doc_id", "_h"]).select(
        *docs.columns).unionByName(docs.where("doc_id is null"))
