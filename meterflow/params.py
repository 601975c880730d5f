"""Business parameters and their defaults.

Everything that was hard-coded or random in the original jobs is a parameter
here: the billing rule, the as-of date, bin edges and quality bounds.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Fixed values that must equal the original pipeline's for identical results.
# Age bins used by the failure-rate chart: half-open [lo, hi) day ranges.
AGE_BIN_EDGES = [0, 100, 200, 300, 400, 500, 600, 700, 800, 900, 1000]
AGE_BIN_LABELS = [
    "0-100", "100-200", "200-300", "300-400", "400-500",
    "500-600", "600-700", "700-800", "800-900", "900-1000",
]
# Share of readings marked billed by the original (random) billing rule.
BILLED_SHARE = 0.9
# Characters of meter_id that name the district.
DISTRICT_PREFIX_LEN = 3
# Itron readings are cubic metres; 1 m3 = 1 kL.
M3_TO_KL = 1.0
# Documented report filter.
MAINTENANCE_OVERDUE_DAYS = 365

# As-of date used by the fixtures mapped from the driver tables.
ASSET_AS_OF = dt.date(2001, 12, 31)


@dataclass(frozen=True)
class LossSplit:
    """Share of NRW volume that is apparent loss (theft, meter error).

    The only numbers the documentation gives are 1,500 apparent of 5,000 kL.
    """

    apparent_share: float = 0.3


@dataclass(frozen=True)
class AgeBins:
    edges: list[int] = field(default_factory=lambda: list(AGE_BIN_EDGES))
    labels: list[str] = field(default_factory=lambda: list(AGE_BIN_LABELS))

    def __post_init__(self):
        if len(self.labels) != len(self.edges) - 1 or list(self.edges) != sorted(set(self.edges)):
            raise ValueError("age bins need ascending edges and one label between each two")

    def ranges(self) -> list[tuple[int, int, str]]:
        """(lo, hi, label) of each half-open bin."""
        return list(zip(self.edges, self.edges[1:], self.labels, strict=False))
