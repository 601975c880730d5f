"""Column-level building blocks (JVM-side built-ins only, no UDFs)."""

from meterflow.functions.measures import (  # noqa: F401
    exact_mean,
    exact_sum_units,
    pct,
    ratio,
    units_to_volume,
)
from meterflow.functions.rules import (  # noqa: F401
    billed_by_hash,
    billed_by_suffix,
    district_of,
    meter_suffix,
)
from meterflow.functions.time import (  # noqa: F401
    hour_of_day,
    month_start,
    parse_utc_timestamp,
    report_date,
    weekday_name,
)
