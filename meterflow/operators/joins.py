"""Join helpers: broadcast only what is proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    MapType,
    StringType,
    StructType,
)

DEFAULT_MAX_BYTES = 64 * 1024 * 1024


# Bytes per value of the fixed-width types (Spark's in-memory widths).
_WIDTHS = {"boolean": 1, "byte": 1, "tinyint": 1, "short": 2, "smallint": 2, "int": 4, "integer": 4,
           "date": 4, "float": 4, "long": 8, "bigint": 8, "double": 8, "timestamp": 8, "timestamp_ntz": 8}


def _width(dt) -> int:
    """Width of a fixed-width type; decimals and anything else count 16."""
    return _WIDTHS.get(dt.simpleString(), 16)


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: one plain aggregate, whose tasks send one row each.

    Bytes = fixed-width columns at their type width plus the actual length
    of every string / binary value; nested columns are measured through
    their JSON text.
    """
    fixed = 8  # per-row overhead
    var = []
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (StringType, BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)).cast("long"))
        elif isinstance(t, (ArrayType, MapType, StructType)):
            var.append(F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)))
        else:
            fixed += _width(t)
    var_sum = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    r = df.agg(F.count(F.lit(1)).alias("n"), var_sum.alias("v")).first()
    n = int(r["n"])
    return n, n * fixed + int(r["v"] or 0)


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = DEFAULT_MAX_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows and
    ``max_bytes`` bytes, both measured; otherwise leave the join to the
    planner (a shuffle join; AQE may still switch strategy from run-time
    sizes and splits skewed partitions).

    Meant for dimension tables: the check reads the dimension once, spread
    over its tasks, with no exchange that carries its rows. A side whose size is fixed by
    construction (a bin list, a weekday x hour profile) is broadcast on that
    bound instead of being measured."""
    n, b = measured_size(df)
    return F.broadcast(df) if n <= max_rows and b <= max_bytes else df
