"""Business rules expressed as Columns.

The original job marked 90 % of readings billed with an unseeded ``rand()``;
here the rule is a parameter and both defaults are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from meterflow.params import BILLED_SHARE, DISTRICT_PREFIX_LEN


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def district_of(meter_id: Column | str, prefix_len: int = DISTRICT_PREFIX_LEN) -> Column:
    """District code = leading characters of the meter id."""
    return F.substring(_c(meter_id), 1, prefix_len)


def meter_suffix(meter_id: Column | str) -> Column:
    """Number after the last dash of a meter id (NULL when not numeric)."""
    return F.substring_index(_c(meter_id), "-", -1).try_cast("long")


def billed_by_hash(
    meter_id: Column | str = "meter_id",
    ts: Column | str = "reading_ts",
    share: float = BILLED_SHARE,
) -> Column:
    """Reproducible stand-in for ``rand() < share``: a hash of the reading."""
    bucket = F.pmod(F.xxhash64(_c(meter_id), _c(ts)), F.lit(10_000))
    return bucket < F.lit(int(round(share * 10_000)))


def billed_by_suffix(meter_id: Column | str = "meter_id", modulus: int = 10) -> Column:
    """Meter billed unless its numeric suffix is a multiple of ``modulus``.

    About 1 - 1/modulus of meters are billed. Unlike the hash rule it has an
    exact SQL twin, which the oracle checks rely on.
    """
    s = meter_suffix(meter_id)
    return F.coalesce(F.pmod(s, F.lit(modulus)) != 0, F.lit(False))
