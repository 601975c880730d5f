"""Ranks, AUC and calibration bins over all rows without a window over all rows.

Rows are first counted per distinct score, map-side. The counts are dealt into
ranges of scores and stored with the number of their range; a score's place is
then its place in the range plus the sizes of the ranges before it, of which
there are at most ``ranges`` a group. However many rows share a score, they are
one row here, and no task holds more than a range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.measures import exact_ratio
from meterflow.session import scratch_path

#: Ranges that distinct scores are dealt into.
RANGES = 200


def places(df: DataFrame, score: str, label: str | None = None, by: list[str] | None = None, ranges: int = RANGES) -> DataFrame:
    """A row for every distinct score of a group: n and positives (rows there), below and positives_below (rows of
    the group with a smaller score), total and positives_total (rows of the group).

    Rows without a score are left out; with ``label`` (0 or 1), so are those
    without a label. NaN counts as the greatest score.
    """
    by = list(by or [])
    hit = F.lit(0) if label is None else F.col(label)
    known = F.col(score).isNotNull() & hit.isNotNull()
    counts = df.where(known).groupBy(*by, score).agg(F.count(F.lit(1)).alias("n"), F.sum(hit.cast("long")).alias("positives"))
    path = scratch_path(df.sparkSession, "places")
    # Stored, so that a lost executor can't deal the ranges anew.
    counts.repartitionByRange(ranges, *by, score).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    # Groups may be null: they are compared as one struct.
    group = F.struct(F.lit(0).alias("_all"), *by)
    sizes = stored.groupBy(group.alias("_group"), "_range").agg(F.sum("n").alias("_n"), F.sum("positives").alias("_p"))
    if by:
        whole = Window.partitionBy("_group")
        earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select("_group", F.col("_range").alias("_at"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
                               F.coalesce(F.sum("_p").over(earlier), F.lit(0)).alias("_before_p"),
                               F.sum("_n").over(whole).alias("total"), F.sum("_p").over(whole).alias("positives_total"))
    else:
        # A window without groups would be one task: every range gives its size to all ranges instead.
        given = sizes.select("*", F.explode(F.sequence(F.lit(0), F.lit(ranges - 1))).alias("_at"))
        offsets = given.groupBy("_group", "_at").agg(
            F.sum(F.when(F.col("_range") < F.col("_at"), F.col("_n")).otherwise(0)).alias("_before"),
            F.sum(F.when(F.col("_range") < F.col("_at"), F.col("_p")).otherwise(0)).alias("_before_p"),
            F.sum("_n").alias("total"), F.sum("_p").alias("positives_total"))
    near = Window.partitionBy(*by, "_range").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    inside = stored.select("*", F.coalesce(F.sum("n").over(near), F.lit(0)).alias("_in"),
                           F.coalesce(F.sum("positives").over(near), F.lit(0)).alias("_in_p"))
    joined = inside.withColumn("_own", group).join(offsets, F.col("_own").eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_at")))
    return joined.select(*by, score, "n", "positives", (F.col("_in") + F.col("_before")).alias("below"),
                         (F.col("_in_p") + F.col("_before_p")).alias("positives_below"), "total", "positives_total")


def percent_rank(df: DataFrame, score: str, by: list[str] | None = None, name: str = "percent_rank", decimals: int = 6,
                 ranges: int = RANGES) -> DataFrame:
    """``df`` with the share of the other rows of its group that have a smaller score, 0 to 1.

    Ties share a rank; a row alone in its group has 0; a row without a score
    has NULL and isn't counted.
    """
    by = list(by or [])
    share = F.when(F.col("total") == 1, F.lit(0.0)).otherwise(exact_ratio(F.col("below"), F.col("total") - 1, decimals))
    found = places(df, score, by=by, ranges=ranges).select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate([*by, score])], share.alias(name))
    same = F.lit(True)
    for i, c in enumerate([*by, score]):
        same = same & df[c].eqNullSafe(found[f"_k{i}"])
    return df.join(found, same, "left").select(*[df[c] for c in df.columns], name)


def auc(df: DataFrame, score: str, label: str, by: list[str] | None = None, decimals: int = 6, ranges: int = RANGES) -> DataFrame:
    """rows, positives and auc of every group: how often a positive scores above a negative, ties counting half.

    Exact, from rank sums. NULL for a group without both kinds.
    """
    by = list(by or [])
    negative, negative_below = F.col("n") - F.col("positives"), F.col("below") - F.col("positives_below")
    wins = F.col("positives").cast("decimal(18,0)") * (2 * negative_below + negative).cast("decimal(19,0)")
    pairs = 2 * F.col("positives").cast("decimal(18,0)") * (F.col("rows") - F.col("positives")).cast("decimal(18,0)")
    sums = places(df, score, label, by, ranges).groupBy(*by).agg(
        F.sum("n").alias("rows"), F.sum("positives").alias("positives"), F.sum(wins).alias("wins"))
    return sums.select(*by, "rows", "positives", exact_ratio(F.col("wins"), pairs, decimals).alias("auc"))


def calibration(df: DataFrame, score: str, label: str, by: list[str] | None = None, bins: int = 10, decimals: int = 6,
                ranges: int = RANGES) -> DataFrame:
    """bin (0 is the lowest scores), rows, positives, mean_score and positive_rate of every bin of a group.

    Bins hold equal numbers of rows but for ties, which stay together in the
    bin of their first row; a bin that ties leave empty has no row.
    """
    by = list(by or [])
    found = places(df, score, label, by, ranges)
    slot = F.floor(F.col("below") * bins / F.col("total")).cast("int")
    return found.groupBy(*by, slot.alias("bin")).agg(
        F.sum("n").alias("rows"), F.sum("positives").alias("positives"),
        F.round(F.sum(F.col(score) * F.col("n")) / F.sum("n"), decimals).alias("mean_score"),
    ).select(*by, "bin", "rows", "positives", "mean_score", exact_ratio(F.col("positives"), F.col("rows"), decimals).alias("positive_rate"))
