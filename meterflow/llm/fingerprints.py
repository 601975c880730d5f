"""Document fingerprints: a homomorphic multiset hash of paragraphs.

A text's paragraphs are its lines. Each gives a wide vector of hashed numbers;
the text's fingerprint is their sum, lane by lane, modulo powers of two:

* ``EXACT`` lanes modulo 2 ** 32 sum a hash of the whole paragraph. They tell
  texts apart and do not depend on the paragraphs' order.
* ``PACKED`` longs, each of three 20-bit counters, sum the hash bits of the
  paragraph's parts (clauses; words of short paragraphs and of long stretches
  without a clause mark). Read as sums of +1
  and -1, two such vectors' cosine estimates how much of the parts two texts
  share, with a standard error of about 0.09.

Both parts are sums, so a paragraph is put in or taken out by adding or
subtracting its vector (``inserted``, ``deleted``).

DataFrame functions only.

Defined cases: a null text is empty; an empty text is one empty paragraph
without parts; equal fingerprints have likeness 1, and a text without parts is
unlike all others; counters are modulo 2 ** 20, and the sums of +1 and -1 are
read modulo 2 ** 21 around 0, which fits any number of parts as long as these
sums stay below 2 ** 20; a document without an id has no place in the order and is its own next;
repeated ids follow each other by the hash of their text; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EXACT, PACKED = 4, 40
COUNTER_BITS, COUNTERS = 20, 3

#: Paragraphs of fewer characters are cut at spaces, others at clause marks, and what is as long between these at spaces again.
SHORT = 96

#: Marks that end a clause (Latin, Chinese and Japanese, Devanagari, Arabic), with a space behind.
CLAUSE = "[.,;:!?\u3001\u3002\uff01\uff0c\uff0e\uff1a\uff1b\uff1f\u0964\u060c\u061b\u061f\u06d4]+ ?"

#: Ranges of ids a shuffle partition.
RANGES = 8

_LOW32 = 0xFFFFFFFF
_SPREAD = sum(1 << (COUNTER_BITS * k) for k in range(COUNTERS))
_PACKED_MASK = (1 << (COUNTER_BITS * COUNTERS)) - 1

#: Beyond this many parts, sums are wrapped at each step.
_MANY = 1 << 22


def _parts(text: Column) -> Column:
    def clauses(p: Column) -> Column:
        return F.flatten(F.transform(F.split(p, CLAUSE), lambda q: F.when(F.length(q) < SHORT, F.array(q)).otherwise(F.split(q, " "))))

    cut = F.flatten(F.transform(F.split(text, "\n"), lambda p: F.when(F.length(p) < SHORT, F.split(p, " ")).otherwise(clauses(p))))
    return F.filter(cut, lambda x: x != "")


def _half(hashes: str, shift: int) -> Column:
    """The sum of 32 bits of each hash, modulo 2 ** 32."""
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, h: (
        a + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_LOW32))).bitwiseAND(F.lit(_LOW32)))


def _summed(hashes: str, shift: int) -> Column:
    """The sum of each hash's bits from ``shift`` on, one bit to a counter."""
    zero = F.lit(0).cast("long")

    def term(h: Column) -> Column:
        return F.shiftright(h, shift).bitwiseAND(F.lit(_SPREAD))

    return F.when(F.size(hashes) < _MANY, F.aggregate(hashes, zero, lambda a, h: a + term(h))).otherwise(
        F.aggregate(hashes, zero, lambda a, h: (a + term(h)).bitwiseAND(F.lit(_PACKED_MASK))))


def with_vector(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as ``out``: an array of EXACT + PACKED longs and the number of parts."""
    keep = df.columns
    df = df.select(*keep, _parts(F.col(text)).alias("_parts"), F.split(F.col(text), "\n").alias("_lines"))
    df = df.select(
        *keep, F.transform("_parts", lambda p: F.xxhash64(p)).alias("_h0"),
        F.transform("_parts", lambda p: F.xxhash64(p, F.lit(1))).alias("_h1"),
        F.transform("_lines", lambda p: F.xxhash64(p)).alias("_p0"),
        F.transform("_lines", lambda p: F.xxhash64(p, F.lit(1))).alias("_p1"))
    exact = [_half(p, s) for p in ("_p0", "_p1") for s in (0, 32)]
    packed = [_summed(h, s) for h in ("_h0", "_h1") for s in range(COUNTER_BITS)]
    return df.select(*keep, F.array(*exact, *packed, F.size("_h0").cast("long")).alias(out))


def inserted(a: Column, b: Column) -> Column:
    """The fingerprint of both texts' paragraphs together."""
    return F.transform(F.zip_with(a, b, lambda x, y: x + y), _wrapped)


def deleted(a: Column, b: Column) -> Column:
    """The fingerprint of ``a`` without the paragraphs of ``b``."""
    return F.transform(F.zip_with(a, b, lambda x, y: x - y), _wrapped)


def _wrapped(x: Column, i: Column) -> Column:
    return F.when(i < EXACT, x.bitwiseAND(F.lit(_LOW32))).otherwise(x.bitwiseAND(F.lit(_PACKED_MASK)))


def _dot(a: str, b: str) -> Column:
    """The inner product of the counters, read as sums of +1 and -1."""
    def signed(v: str, x: Column, k: int) -> Column:
        count = F.shiftright(x, COUNTER_BITS * k).bitwiseAND(F.lit((1 << COUNTER_BITS) - 1))
        apart = 2 * count - F.get(v, F.lit(EXACT + PACKED))
        half = F.lit(1 << COUNTER_BITS)
        return (F.pmod(apart + half, 2 * half) - half).cast("double")

    terms = F.zip_with(F.slice(a, EXACT + 1, PACKED), F.slice(b, EXACT + 1, PACKED), lambda x, y: reduce(
        lambda s, t: s + t, [signed(a, x, k) * signed(b, y, k) for k in range(COUNTERS)]))
    return F.aggregate(terms, F.lit(0.0), lambda s, t: s + t)


def likeness(a: str, b: str) -> Column:
    """0 to 1 for two columns of fingerprints; 1 if they are equal."""
    norm = F.sqrt(_dot(a, a) * _dot(b, b))
    cosine = F.when(norm > 0, _dot(a, b) / norm).otherwise(0.0)
    return F.when(F.col(a) == F.col(b), 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), cosine)))


def as_text(v: str) -> Column:
    """A fingerprint in hexadecimal, lane by lane."""
    return F.array_join(F.transform(F.col(v), lambda x, i: F.lower(
        F.lpad(F.hex(x), F.when(i < EXACT, 8).otherwise(COUNTER_BITS * COUNTERS // 4), "0"))), "")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (doc_id not null, and ``columns``) with ``next_`` columns: those of the next id, after the last those of the first.

    Ids are cut into ranges at quantiles, RANGES a shuffle partition so that
    hashing spreads them evenly. The first documents of a range also go to the
    end of the range before it (of the first range: of the last), so each
    range is a window of its own.
    """
    n = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # One row of at most n ids.
    at = docs.agg(F.min("doc_id").alias("least"), F.percentile_approx(
        "doc_id", [k / n for k in range(1, n)] or [0.5], F.lit(max(10_000, 10 * n))).alias("cuts")).first()
    cuts = sorted({c for c in at.cuts or [] if c > at.least})
    # The number of cuts up to an id, in two steps: among every step-th cut, then in the stretch behind it.
    step = max(1, math.isqrt(len(cuts)))
    listed = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    coarse = F.size(F.filter(F.array(*[F.lit(c) for c in cuts[step - 1::step]]).cast("array<bigint>"), lambda c: c <= F.col("doc_id"))) * step
    spot = coarse + F.size(F.filter(F.slice(listed, coarse + 1, step), lambda c: c <= F.col("doc_id")))
    row = docs.select(F.struct("*").alias("_row"), "doc_id", spot.alias("_spot"))

    def copy(spot: Column, wrap: int, guest: bool) -> Column:
        return F.struct(spot.alias("spot"), F.lit(wrap).alias("wrap"), F.lit(guest).alias("guest"))

    first = (F.col("_spot") > 0) & (F.get(listed, F.col("_spot") - 1) == F.col("doc_id"))
    copies = F.array_compact(F.array(
        copy(F.col("_spot"), 0, False), F.when(first, copy(F.col("_spot") - 1, 0, True)),
        F.when(F.col("doc_id") == F.lit(at.least), copy(F.lit(len(cuts)), 1, True))))
    dealt = row.select("_row", F.explode(copies).alias("_c")).select("_row.*", "_c.*")
    order = Window.partitionBy("spot").orderBy("wrap", "doc_id", F.xxhash64(columns[0]))
    return dealt.select(*docs.columns, "guest", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]).where(
        ~F.col("guest")).drop("guest")


def compared(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its edited text, and its likeness to that and to the next document.

    The edited text has its last quarter replaced by the start of the next
    document. Columns as in the query's contract.
    """
    plain = docs.select("doc_id", F.coalesce(F.col(text), F.lit("")).alias("_text"))
    df = with_vector(plain, "_text", "_v")
    placed = with_next(df.where("doc_id is not null"), ["_text", "_v"]).unionByName(
        df.where("doc_id is null").select("*", F.col("_text").alias("next__text"), F.col("_v").alias("next__v")))
    size = F.length("_text")
    cut = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring(F.col("_text"), F.lit(1), size - cut), F.substring(F.col("next__text"), F.lit(1), cut))
    df = placed.select("doc_id", size.cast("long").alias("n_chars"), "_v", F.col("next__v").alias("_next"), edited.alias("_edited"))
    df = with_vector(df, "_edited", "_ev")
    return df.select(
        "doc_id", "n_chars", F.sha2(F.col("_edited"), 256).alias("edited_sha256"),
        as_text("_v").alias("fingerprint"), as_text("_ev").alias("edited_fingerprint"),
        likeness("_v", "_ev").alias("near_edited"), likeness("_v", "_next").alias("near_next"))
