"""Run parameters.

Every operator that depends on "which year" or "what time is it" takes these
explicitly, so a job is reproducible: nothing reads the wall clock.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def _default_pool_years() -> tuple[int, ...]:
    return (2022, 2023, 2024, 2025, 2026, 2027)


@dataclass(frozen=True)
class RunParams:
    """Parameters of one run.

    control_year   fiscal year being built; the prior year is ``control_year - 1``.
    as_of          cut-off instant: lines signed after it are ignored and
                   notification dates before it count as overdue.
    code_width     number of trailing characters of a job number that hold the
                   campaign code.
    year_width     number of characters of the fiscal year inside a job number.
    discount_code  campaign code that marks a discount campaign.
    discount_test  how a roll-forward unit counts as a discount unit: "text", as the
                   source has it (the code anywhere in account, audience and
                   campaign code), or "code" (the campaign code equals it).
    pool_years     renewal-pool years in scope.
    pool_classes   renewal-pool verticals in scope.
    """

    control_year: int = 2024
    as_of: str = "2024-06-30 00:00:00"
    code_width: int = 2
    year_width: int = 2
    discount_code: str = "99"
    discount_test: str = "text"
    pool_years: tuple[int, ...] = field(default_factory=_default_pool_years)
    pool_classes: tuple[str, ...] = ("Research", "Technology", "Consulting")

    def __post_init__(self) -> None:
        _dt.datetime.fromisoformat(self.as_of)  # fail fast on a malformed instant
        if self.discount_test not in ("text", "code"):
            raise ValueError("discount_test must be 'text' or 'code'")
        if len(self.discount_code) != self.code_width:
            raise ValueError("discount_code must be code_width characters long")

    @property
    def prior_year(self) -> int:
        return self.control_year - 1

    def as_of_col(self) -> Column:
        """The cut-off as a session-independent TIMESTAMP_NTZ literal."""
        return F.lit(self.as_of).cast("timestamp_ntz")

    # Year-bearing labels follow the control year (FY24 for 2024, ...).
    def fy_tag(self, offset: int = 0) -> str:
        return f"FY{(self.control_year + offset) % 100:02d}"
