"""Repaired meter series: gaps filled, stuck and reset registers marked.

Readings are summed per meter and step (hour or day), combined map-side. What
a step needs from its neighbours comes from windows over (meter, time range),
and across their borders from one summary row a range (``linked``): no task
holds more than a range of a meter, however long its series is or however many
of the readings are its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterflow.functions.measures import DEFAULT_SCALE, exact_sum_units, half_up_quotient, units_to_volume

#: Steps of a time range: a month of hours.
RANGE_STEPS = 720

STEPS = ("hour", "day")

#: Volumes (in units) and spans up to which a line between two steps fits longs.
SMALL_UNITS, SMALL_SPAN = 2**40, 2**20


def linked(series: DataFrame, range_steps: int) -> DataFrame:
    """``series`` (meter_id, at, units; one row a step) with the step before, ``prev_at`` and ``prev_units``, and the
    ``length`` of the run of equal volumes in unbroken steps that a step is part of.

    Rows are looked at once, within (meter, range): their neighbours there and
    the run's two ends. A summary row a range, with its borders and the runs at
    them, says what lies before a range's first row and how far the runs at its
    borders reach, over however many ranges.
    """
    slot = ["meter_id", "_range"]
    near = Window.partitionBy(*slot).orderBy("at")
    # The filter holds for every row; the join would add it to one of the two sides, which then couldn't share a shuffle.
    rows = series.withColumn("_range", F.floor(F.col("at") / range_steps)).where("_range is not null").select(
        "*", F.lag("at").over(near).alias("_at"), F.lag("units").over(near).alias("_units"))
    starts = F.col("_at").isNull() | (F.col("_at") != F.col("at") - 1) | (F.col("_units") != F.col("units"))
    rows = rows.withColumn("_start", F.max(F.when(starts, F.col("at"))).over(near.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_end", F.max("at").over(Window.partitionBy(*slot, "_start")))

    ends = rows.groupBy(*slot).agg(
        F.min("at").alias("_first"), F.min_by("units", "at").alias("_first_units"), F.min("_end").alias("_first_end"),
        F.max("at").alias("_last"), F.max_by("units", "at").alias("_last_units"), F.max("_start").alias("_last_start"))
    whole = Window.partitionBy("meter_id")
    up, down = whole.orderBy("_range"), whole.orderBy(F.desc("_range"))
    ends = ends.select("*", F.lag("_last").over(up).alias("_before"), F.lag("_last_units").over(up).alias("_before_units"))
    goes_on = (F.col("_before") == F.col("_first") - 1) & (F.col("_before_units") == F.col("_first_units"))
    ends = ends.withColumn("_from", F.coalesce(goes_on, F.lit(False)))
    ends = ends.withColumn("_into", F.coalesce(F.lead("_from").over(up), F.lit(False)))
    one, earlier = F.col("_first_end") == F.col("_last"), (Window.unboundedPreceding, -1)
    # A range that is one run hands on where that run comes from; any other one has a border of its own.
    ends = ends.select(
        *slot, "_first", "_last", "_before", "_before_units", "_from", "_into",
        F.max(F.when(~(one & F.col("_from")), F.col("_last_start"))).over(up.rowsBetween(*earlier)).alias("_far_start"),
        F.min(F.when(~(one & F.col("_into")), F.col("_first_end"))).over(down.rowsBetween(*earlier)).alias("_far_end"))
    start = F.when((F.col("_start") == F.col("_first")) & F.col("_from"), F.col("_far_start")).otherwise(F.col("_start"))
    end = F.when((F.col("_end") == F.col("_last")) & F.col("_into"), F.col("_far_end")).otherwise(F.col("_end"))
    return rows.join(ends, slot).select(
        "meter_id", "at", "units", F.coalesce("_at", "_before").alias("prev_at"), F.coalesce("_units", "_before_units").alias("prev_units"),
        (end - start + 1).alias("length"))


def _between(at: Column, prev_at: Column, next_at: Column, prev: Column, units: Column) -> Column:
    """The volume at step ``at`` on the line between two steps, halves away from zero; as longs where they can't overflow."""
    span, num = next_at - prev_at, prev * (next_at - at) + units * (at - prev_at)
    usual = prev.between(-SMALL_UNITS, SMALL_UNITS) & units.between(-SMALL_UNITS, SMALL_UNITS) & (span <= SMALL_SPAN)
    size = F.call_function("div", F.abs(num) * 2 + span, span * 2)
    wide = prev.cast("decimal(20,0)") * (next_at - at) + units.cast("decimal(20,0)") * (at - prev_at)
    return F.when(usual, F.when(num < 0, -size).otherwise(size)).otherwise(half_up_quotient(wide, span).cast("long"))


def repaired(readings: DataFrame, step: str = "hour", max_gap: int = 24, stuck_steps: int = 3, reset_factor: int = 10,
             range_steps: int = RANGE_STEPS) -> DataFrame:
    """meter_id, step_ts, consumption_kl, reason and missing_before for every step of every meter.

    ``reason`` is empty for a step that is taken as it stands, else a list of:

    * ``filled``: the step had no reading and up to ``max_gap`` steps are
      missing in a row; the value is interpolated linearly between the steps on
      both sides, rounded half up to 10^-4 kL.
    * ``after_gap``: more are missing before this step; they are not made up.
    * ``stuck``: part of ``stuck_steps`` or more steps in a row with the same
      volume above zero.
    * ``reset``: less than 1 / ``reset_factor`` of the step before it.

    Only ``filled`` rows are new; all others keep their summed volume.
    ``missing_before`` counts the steps without a reading just before a step.
    Readings without a time or a meter belong to no series and are left out,
    as are volumes that can't be summed (see ``rejected_readings``); a step with
    no other has no reading.
    """
    if step not in STEPS:
        raise ValueError(f"step is one of {STEPS}")
    day, ts = F.unix_date(F.to_date("reading_ts")).cast("long"), F.col("reading_ts")
    at = day if step == "day" else day * 24 + F.hour(ts)
    units = exact_sum_units("consumption_kl").cast("long")
    series = readings.where("reading_ts is not null and meter_id is not null").groupBy("meter_id", at.alias("at")).agg(units.alias("units")).where(
        "units is not null")
    found = linked(series, range_steps)
    prev_at, prev, own = F.col("prev_at"), F.col("prev_units"), F.col("at")
    missing = F.coalesce(own - prev_at - 1, F.lit(0)).cast("long")
    reason = F.concat_ws(",", F.when((F.col("length") >= stuck_steps) & (F.col("units") > 0), "stuck"),
                         F.when(F.col("units") * reset_factor < prev, "reset"), F.when(missing > max_gap, "after_gap"))
    # A step brings the missing ones before it: all rows come from one pass.
    first = F.when((missing >= 1) & (missing <= max_gap), prev_at + 1).otherwise(own)
    rows = found.select("*", missing.alias("missing"), reason.alias("_reason"), F.explode(F.sequence(first, own)).alias("i"))
    i, filled = F.col("i"), F.col("i") < own
    rows = rows.select("meter_id", i, F.when(filled, _between(i, prev_at, own, prev, F.col("units"))).otherwise(F.col("units")).alias("units"),
                       F.when(filled, "filled").otherwise(F.col("_reason")).alias("reason"),
                       F.when(filled, 0).otherwise(F.col("missing")).alias("missing_before"))
    day = i if step == "day" else F.floor(i / 24)
    ts = F.date_from_unix_date(day.cast("int")).cast("timestamp_ntz")
    if step == "hour":
        ts = ts + F.make_dt_interval(hours=F.pmod(i, F.lit(24)).cast("int"))
    volume = F.when(F.col("units").between(-(2**53), 2**53), F.col("units") / float(10**DEFAULT_SCALE)).otherwise(units_to_volume("units"))
    return rows.select("meter_id", ts.alias("step_ts"), volume.alias("consumption_kl"), "reason", "missing_before")
