"""Mixing sources to target weights by Pfair scheduling.

Each source is a stream of blocks. With a share of w in q slots, block k of a
source is released at slot floor(k * q / w) and due before slot
ceil((k + 1) * q / w); every slot goes to the released block with the earliest
deadline. While sources last, no source is ever a whole block ahead of or
behind its share of the slots so far. Shares are whole numbers, so the plan
repeats after q slots: it is made once, and each document finds its slot by
arithmetic. Nothing is dropped or repeated: a source that has run out leaves
its slots empty.

Within a source, documents follow each other by the hash of their id; places
are prefix sums over hash buckets and then within a bucket, so a source of any
size is spread over all tasks.

DataFrame functions only.

Defined cases: a null source or one without a share belongs to the rest, which
has a share of its own; a null or empty text has size 1 (every text counts
one more than its characters); repeated rows follow each other; a null doc_id
hashes as the empty text; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Shares of 100 slots; sources that aren't listed have REST together.
SHARES = {"src0": 20} | {f"src{i}": 5 for i in range(1, 10)} | {f"src{i}": 3 for i in range(10, 20)}
REST = 5

#: Characters of a block.
BLOCK = 1 << 16

#: Hexadecimal digits of the hash that number a source's buckets: 4096 of them.
BUCKET_DIGITS = 3


def plan(spark: SparkSession, shares: list[int]) -> DataFrame:
    """(gid, turn, slot) of one period: a fold over its slots, earliest deadline first (ties: first source)."""
    q = sum(shares)
    weight = F.array(*[F.lit(w).cast("long") for w in shares])

    def step(state: Column, t: Column) -> Column:
        due = F.transform(weight, lambda w, i: F.when(
            F.floor(F.get(state.done, i) * q / w) <= t,
            F.struct(F.ceil((F.get(state.done, i) + 1) * q / w).alias("deadline"), i.alias("gid"))))
        pick = F.array_min(due).gid
        return F.struct(
            F.transform(state.done, lambda n, i: n + (i == pick).cast("long")).alias("done"),
            F.concat(state.order, F.array(F.struct(pick.alias("gid"), F.get(state.done, pick).alias("turn")))).alias("order"))

    start = F.struct(F.transform(weight, lambda w: F.lit(0).cast("long")).alias("done"),
                     F.array().cast("array<struct<gid:int,turn:bigint>>").alias("order"))
    folded = F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(q - 1).cast("long")), start, step, lambda s: s.order)
    return spark.range(1).select(F.posexplode(folded).alias("slot", "x")).select(
        "x.gid", "x.turn", F.col("slot").cast("long").alias("slot"))


def placed(docs: DataFrame, keep: list[str], shares: dict[str, int] | None = None, rest: int = REST,
           block: int = BLOCK, source: str = "source", text: str = "text") -> DataFrame:
    """``keep`` (columns of ``docs``) with grp, block, slot, release, deadline and start (longs but for grp).

    Rows in the order of (slot, start) are the mixture. ``start`` is the
    document's place in its source; a document belongs to the block that it
    starts in. grp is the source, or null for the rest.
    """
    shares = SHARES if shares is None else shares
    spark, names = docs.sparkSession, list(shares)
    weights, q = [*shares.values(), rest], sum(shares.values()) + rest
    # As many rows as there are shares: a bound that the caller sets.
    sources = F.broadcast(spark.createDataFrame([(n, i, n) for i, n in enumerate(names)], "_source string, _gid int, _grp string"))
    rows = docs.select(
        F.struct(*keep).alias("_row"), F.col(source).alias("_source"), F.col("doc_id").alias("_id"),
        (F.length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long").alias("_size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("_key"))
    rows = rows.join(sources, "_source", "left").withColumn("_gid", F.coalesce("_gid", F.lit(len(names)))).withColumn(
        "_bucket", F.substring("_key", 1, BUCKET_DIGITS))
    spot = ["_gid", "_bucket"]
    # A row a bucket and source: bounded, whatever the number of documents.
    buckets = rows.groupBy(*spot).agg(F.sum("_size").alias("_sum")).select(*spot, (F.sum("_sum").over(
        Window.partitionBy("_gid").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("_before"))
    inside = Window.partitionBy(*spot).orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.sum("_size").over(inside)).join(buckets, spot)
    rows = rows.select("_row", "_gid", "_grp", (F.coalesce("_before", F.lit(0)) + F.coalesce("_inside", F.lit(0))).alias("start"))
    weight = F.get(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("_gid"))
    rows = rows.withColumn("_w", weight).withColumn("block", F.floor(F.col("start") / block))
    rows = rows.withColumn("turn", F.col("block") % F.col("_w")).withColumn("_from", F.floor(F.col("block") / F.col("_w")) * q)
    # As many rows as a period has slots.
    slots = F.broadcast(plan(spark, weights).select(F.col("gid").alias("_gid"), "turn", F.col("slot").alias("_slot")))
    rows = rows.join(slots, ["_gid", "turn"])
    return rows.select(
        "_row.*", F.col("_grp").alias("grp"), "block", (F.col("_from") + F.col("_slot")).alias("slot"),
        (F.col("_from") + F.floor(F.col("turn") * q / F.col("_w"))).alias("release"),
        (F.col("_from") + F.ceil((F.col("turn") + 1) * q / F.col("_w"))).alias("deadline"), "start")


def mixed(docs: DataFrame, **how) -> DataFrame:
    """All of ``docs``, dealt out and sorted in the order of the mixture."""
    p = placed(docs.select(F.struct("*").alias("_all"), "doc_id", "source", "text"), ["_all"], **how)
    return p.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start").select("_all.*")


def spread(docs: DataFrame, keep: list[str], shares: dict[str, int] | None = None, rest: int = REST,
           block: int = BLOCK, source: str = "source", text: str = "text") -> DataFrame:
    """``keep`` with _start, _size and _slots: the slots of all blocks that a document reaches into, the first one first.

    A document that is longer than what is left of its block goes on in the
    next blocks of its source, which have slots of their own.
    """
    shares = SHARES if shares is None else shares
    spark, weights, q = docs.sparkSession, [*shares.values(), rest], sum(shares.values()) + rest
    size = (F.length(F.coalesce(F.col(text), F.lit(""))) + 1).cast("long")
    rows = placed(docs.select(F.struct(*keep).alias("_all"), "doc_id", F.col(source).alias("source"), F.col(text).alias("text"),
                              size.alias("_size")), ["_all", "_size"], shares, rest, block)
    # As many rows as there are shares.
    names = spark.createDataFrame([(g, i) for i, g in enumerate([*shares, None])], "_of string, gid int")
    turns = plan(spark, weights).groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("turn", "slot"))).slot.alias("_turns"))
    turns = F.broadcast(names.join(turns, "gid").select("_of", "_turns"))
    w = F.size("_turns")
    return rows.join(turns, rows["grp"].eqNullSafe(turns["_of"])).select(
        "_all.*", F.col("start").alias("_start"), "_size",
        F.transform(F.sequence("block", F.floor((F.col("start") + F.col("_size") - 1) / block)),
                    lambda b: F.floor(b / w) * q + F.get("_turns", (b % w).cast("int"))).alias("_slots"))


def oracle(shares: dict[str, int] | None = None, rest: int = REST, block: int = BLOCK) -> str:
    """The same rows in DuckDB SQL: the plan by a recursive query, places by one window a source."""
    shares = SHARES if shares is None else shares
    weights, q = [*shares.values(), rest], sum(shares.values()) + rest
    listed = ", ".join(f"('{n}', {i + 1}, {w})" for i, (n, w) in enumerate(shares.items()))
    return f"""
WITH RECURSIVE shares(grp, gid, w) AS (VALUES {listed}, (NULL, {len(weights)}, {rest})),
plan AS (
  SELECT 0::BIGINT AS t, list_transform({weights}, lambda w: 0::BIGINT) AS done, 0::BIGINT AS gid, 0::BIGINT AS turn
  UNION ALL
  SELECT t + 1, list_transform(done, lambda n, i: n + (i = k % 1000)::BIGINT), (k % 1000)::BIGINT, done[k % 1000]
  FROM (SELECT t, done, list_min(list_transform({weights}, lambda w, i:
          CASE WHEN (done[i] * {q}) // w <= t THEN ((done[i] + 1) * {q} + w - 1) // w * 1000 + i END)) AS k
        FROM plan WHERE t < {q})
),
sized AS (
  SELECT doc_id, s.grp, coalesce(s.gid, {len(weights)}) AS gid, coalesce(s.w, {rest}) AS w,
         length(coalesce(text, '')) + 1 AS size, md5(coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents d LEFT JOIN shares s ON d.source = s.grp
),
starts AS (
  SELECT *, (coalesce(sum(size) OVER (PARTITION BY gid ORDER BY key, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS start FROM sized
)
SELECT doc_id, grp, start // {block} AS block,
       start // {block} // w * {q} + p.t - 1 AS slot,
       start // {block} // w * {q} + start // {block} % w * {q} // w AS release,
       start // {block} // w * {q} + ((start // {block} % w + 1) * {q} + w - 1) // w AS deadline, start
FROM starts JOIN plan p ON p.t > 0 AND p.gid = starts.gid AND p.turn = start // {block} % w
"""
