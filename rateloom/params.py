"""Parameters of one pricing run."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta

MAX_RATING_FACTORS = 8
RUN_KEYS = ("TermType", "UWYear")


def as_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def months_back(day: date, months: int) -> date:
    """``day`` moved back by whole months, clamped to the last day of a shorter month."""
    month0 = day.year * 12 + day.month - 1 - months
    year, month = divmod(month0, 12)
    return date(year, month + 1, min(day.day, calendar.monthrange(year, month + 1)[1]))


def years_back(day: date, years: int) -> date | None:
    """Same calendar day ``years`` earlier; None where that day does not exist."""
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return None


@dataclass(frozen=True)
class PricingParams:
    """Windows and rating factors of a run.

    The premium window (PB) is ``[prem_loss_start, end)``, the quote and sale window
    (QB) ``[sale_quote_start, end)``; renewed written premium in the QB window starts
    at ``renewal_start``. ``nulls`` says what a NULL premium does to a count:
    ``strict`` makes the group's count 0, ``skip`` leaves the row out. ``retained_as_of``
    is the latest retention date of the base; if not given it is looked up.
    """

    prem_loss_start: date
    end: date
    sale_quote_start: date
    renewal_start: date
    rate_factors: tuple[str, ...] = ()
    nulls: str = "strict"
    retained_as_of: date | None = None

    def __post_init__(self):
        for name in ("prem_loss_start", "end", "sale_quote_start", "renewal_start"):
            object.__setattr__(self, name, as_date(getattr(self, name)))
        if self.retained_as_of is not None:
            object.__setattr__(self, "retained_as_of", as_date(self.retained_as_of))
        object.__setattr__(self, "rate_factors", tuple(self.rate_factors))
        if len(self.rate_factors) > MAX_RATING_FACTORS:
            raise ValueError(
                f"{len(self.rate_factors)} rating factors given; the limit is {MAX_RATING_FACTORS}"
            )
        if len(set(self.rate_factors)) != len(self.rate_factors):
            raise ValueError(f"rating factors repeat: {list(self.rate_factors)}")
        reserved = sorted(set(self.rate_factors) & set(RUN_KEYS))
        if reserved:
            raise ValueError(f"{reserved} are always grouping keys and cannot be rating factors")
        if self.nulls not in ("strict", "skip"):
            raise ValueError(f"nulls must be 'strict' or 'skip', not {self.nulls!r}")
        if years_back(self.end, 1) is None:
            raise ValueError(
                f"end date {self.end} has no same day one year earlier, so look-back years "
                "are undefined; use 28 February or 1 March"
            )

    @property
    def keys(self) -> tuple[str, ...]:
        return RUN_KEYS + self.rate_factors

    @property
    def retention_window(self) -> tuple[date, date]:
        return months_back(self.sale_quote_start, 6), months_back(self.end, 6)

    @property
    def cancel_start(self) -> date | None:
        return years_back(self.sale_quote_start, 1)

    @property
    def three_day_end(self) -> date:
        return self.end - timedelta(days=3)

    @property
    def earliest_start(self) -> date:
        """No branch of the summary looks at a term that starts before this day."""
        starts = [self.prem_loss_start, self.sale_quote_start, self.renewal_start,
                  self.retention_window[0], self.cancel_start]
        return min(day for day in starts if day is not None)
