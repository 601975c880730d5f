"""Timestamp parsing and calendar keys.

Readings arrive as ISO-8601 text, some with a ``Z`` suffix and some without.
They are parsed once, in silver, to ``TIMESTAMP_NTZ`` holding the UTC wall
clock. Every calendar key below works on that value, so results do not
depend on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OFFSET = r"[0-9]([+-])([0-9]{2}):?([0-9]{2})\s*$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_utc_timestamp(c: Column | str) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ in UTC; malformed text -> NULL.

    Text without a zone is taken as UTC (what the chart code of the original
    pipeline does with ``utc=True``); ``Z`` is UTC; ``+hh:mm`` / ``-hhmm``
    offsets are subtracted. A ``TIMESTAMP`` / ``TIMESTAMP_NTZ`` column can be
    passed too (the ANSI-safe ``try_cast`` is applied either way).
    """
    s = _c(c).cast("string")
    # try_cast to TIMESTAMP_NTZ reads the wall clock and ignores any zone
    # suffix. Text ending in Z or without an offset (the common cases) is
    # done after that single cast; only text with a numeric offset pays for
    # the regex extraction.
    base = s.try_cast("timestamp_ntz")
    has_offset = ~s.endswith("Z") & s.rlike(_OFFSET)
    sign = F.regexp_extract(s, _OFFSET, 1)
    hh = F.regexp_extract(s, _OFFSET, 2).try_cast("int")
    mm = F.regexp_extract(s, _OFFSET, 3).try_cast("int")
    minutes = (hh * 60 + mm) * F.when(sign == "-", F.lit(-1)).otherwise(F.lit(1))
    shifted = base - F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    return F.when(has_offset, shifted).otherwise(base)


def report_date(ts: Column | str) -> Column:
    """``yyyy-MM-dd`` text of the (UTC) reading date."""
    return F.date_format(_c(ts), "yyyy-MM-dd")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_c(ts))


def weekday_name(ts: Column | str) -> Column:
    """Full English weekday name (``Monday``), like pandas ``day_name()``."""
    return F.date_format(_c(ts), "EEEE")


def month_start(d: Column | str) -> Column:
    """First day of the month of a date / timestamp / ``yyyy-MM-dd`` text."""
    return F.trunc(F.to_date(_c(d)), "MM")
