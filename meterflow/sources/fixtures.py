"""Map the driver's tables onto the shapes of the metering feeds.

The original pipeline only ran on its own random generator. To test and
benchmark on shared, deterministic data, the TPC-H-like tables and the
``events`` table are re-shaped (see FIXTURES.md for the mapping). Every
function here is a projection, filter or aggregation: the result grows with
the input tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Event types landed by the nested (sensus) feed; all others go to the flat one.
NESTED_EVENT_TYPES = ("click", "view", "purchase")
# Event types read as pressure; the others are vibration readings.
PRESSURE_EVENT_TYPES = ("click", "view", "purchase")


_SCANS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a driver table. The tables are read-only, so the relation
    (file listing and footer read) is made once per session and path and
    reused, like a table registered in a catalog."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _SCANS.get(key)
    if df is None or df.sparkSession is not spark:
        df = _SCANS[key] = spark.read.parquet(path)
    return df


def _is_nested() -> F.Column:
    return F.col("event_type").isin(*NESTED_EVENT_TYPES)


def _is_flat() -> F.Column:
    """Everything else, events without a type included (both filters reach the scan)."""
    return ~_is_nested() | F.col("event_type").isNull()


def sensus_from_events(events: DataFrame) -> DataFrame:
    """Nested feed: meter_id, timestamp_utc (ISO text with Z), reading_data.flow_kl."""
    return events.where(_is_nested()).select(
        F.concat(F.lit("SEN-"), F.col("user_id").cast("string")).alias("meter_id"),
        F.date_format("ts", ISO_Z).alias("timestamp_utc"),
        F.struct(F.col("value").alias("flow_kl")).alias("reading_data"),
    )


def itron_from_events(events: DataFrame) -> DataFrame:
    """Flat feed: itron_device_id, read_datetime (ISO text, no zone), consumption_m3."""
    return events.where(_is_flat()).select(
        F.concat(F.lit("ITR-"), F.col("user_id").cast("string")).alias("itron_device_id"),
        F.date_format("ts", ISO_LOCAL).alias("read_datetime"),
        F.col("value").alias("consumption_m3"),
    )


def _lineitem_meter(district: str) -> F.Column:
    if district == "flags":
        return F.concat(
            F.lit("D"), F.col("l_returnflag"), F.col("l_linestatus"), F.lit("-"),
            F.col("l_suppkey").cast("string"),
        )
    if district == "nation":
        return F.concat(
            F.lit("N"), F.lpad(F.pmod(F.col("l_suppkey"), F.lit(25)).cast("string"), 2, "0"),
            F.lit("-"), F.col("l_orderkey").cast("string"),
        )
    raise ValueError(district)


def readings_from_lineitem(lineitem: DataFrame, district: str = "flags") -> DataFrame:
    """Long-range readings (seven years, daily), already typed: silver shape.

    ``district="flags"``: meter ``D<returnflag><linestatus>-<suppkey>``.
    ``district="nation"``: meter ``N<nn>-<orderkey>`` with nn = suppkey mod 25,
    so districts line up with the nation dimension.
    The timestamp stays a column of the scan, so date filters reach Parquet.
    """
    return lineitem.select(
        _lineitem_meter(district).alias("meter_id"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("reading_ts"),
        F.col("l_quantity").cast("double").alias("consumption_kl"),
    )


def asset_master_from_orders(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Nested asset master: one asset per order; last maintenance = last ship date.

    The line items are reduced to one row per order before the join, so the
    join is one-to-one whatever the number of lines per order.
    """
    last_ship = lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("last_ship"))
    o = orders.join(last_ship, orders.o_orderkey == last_ship.l_orderkey, "left")
    return o.select(
        F.concat(F.lit("MTR-"), F.col("o_orderkey").cast("string")).alias("asset_id"),
        F.col("o_orderpriority").alias("asset_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("install_date"),
        F.date_format("last_ship", "yyyy-MM-dd").alias("last_maintenance_date"),
        F.col("o_orderstatus").alias("manufacturer"),
        F.concat(F.lit("M-"), F.col("o_custkey").cast("string")).alias("model_number"),
        F.struct(
            (F.pmod(F.col("o_custkey"), F.lit(1800)) / 10.0 - 90.0).alias("latitude"),
            (F.pmod(F.col("o_custkey"), F.lit(3600)) / 10.0 - 180.0).alias("longitude"),
        ).alias("location"),
    )


def assets_with_history(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Silver dim_asset with failure_event and material from the log, both from one aggregate per order.

    The same rows as joining ``asset_master_from_orders`` with the summary of
    ``maintenance_log_from_lineitem``, but the line items are read and
    shuffled once, by the numeric order key. The latest material (one
    character; ties: the larger) rides with its date in one long, so the
    aggregate keeps to hash buffers.
    """
    latest = F.max(F.unix_date(F.to_date("l_shipdate")).cast("long") * 256 + F.ascii("l_linestatus"))
    per_order = lineitem.groupBy("l_orderkey").agg(
        F.max("l_shipdate").alias("last_ship"), latest.alias("latest"),
        F.max(_failure()).alias("failure_event"))
    o = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return o.select(
        F.concat(F.lit("MTR-"), F.col("o_orderkey").cast("string")).alias("asset_id"),
        F.col("o_orderpriority").alias("asset_type"),
        F.to_date("o_orderdate").alias("install_date"),
        F.to_date("last_ship").alias("last_maintenance_date"),
        F.col("o_orderstatus").alias("manufacturer"),
        F.coalesce(F.col("failure_event"), F.lit(0)).alias("failure_event"),
        F.char(F.pmod(F.col("latest"), F.lit(256))).alias("material"),
    )


def _failure() -> F.Column:
    return F.when((F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 48), 1).otherwise(0).cast("int")


def maintenance_log_from_lineitem(lineitem: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Maintenance log: one row per line item of an order (= asset).

    failure_event = 1 for a returned line of quantity >= 48. The log's
    install_date / asset_type copies come from ``orders`` when it is given
    (for landing the full CSV); the feature jobs take them from the asset
    master, so they pass no ``orders`` and skip that join.
    """
    if orders is not None:
        o = orders.select("o_orderkey", "o_orderdate", "o_orderpriority")
        src = lineitem.join(o, lineitem.l_orderkey == o.o_orderkey, "left")
        install, atype = F.to_date("o_orderdate"), F.col("o_orderpriority")
    else:
        src = lineitem
        install, atype = F.lit(None).cast("date"), F.lit(None).cast("string")
    return src.select(
        F.concat(F.lit("MTR-"), F.col("l_orderkey").cast("string")).alias("asset_id"),
        install.alias("install_date"),
        atype.alias("asset_type"),
        F.col("l_linestatus").alias("material"),
        F.to_date("l_shipdate").alias("last_maintenance_date"),
        _failure().alias("failure_event"),
    )


def sensor_readings_from_events(events: DataFrame) -> DataFrame:
    """Long-format sensor history: asset_id, reading_ts, sensor, value."""
    pressure = F.coalesce(F.col("event_type").isin(*PRESSURE_EVENT_TYPES), F.lit(False))
    return events.select(
        F.concat(F.lit("MTR-"), F.col("user_id").cast("string")).alias("asset_id"),
        F.col("ts").cast("timestamp_ntz").alias("reading_ts"),
        F.when(pressure, "pressure").otherwise("vibration").alias("sensor"),
        F.col("value").alias("value"),
    )


def district_dim_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """District dimension: one district per nation (district_id N<nn>)."""
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.concat(F.lit("N"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(
            "district_id"
        ),
        F.initcap(F.col("n_name")).alias("district_name"),
        F.initcap(F.col("r_name")).alias("region_name"),
    )


def land_json(df: DataFrame, path: str) -> str:
    """Write a bronze feed as JSON Lines (splittable)."""
    df.write.mode("overwrite").json(path)
    return path


def land_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", "true").option("dateFormat", "yyyy-MM-dd").csv(path)
    return path
