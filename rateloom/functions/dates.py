"""Date columns: look-back years, month arithmetic, window labels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from rateloom.params import years_back


def minus_months_or_null(day: Column, months: int) -> Column:
    """Same day of the month, ``months`` earlier; NULL where that day does not exist.

    ``add_months`` clamps (30 April less two months is 28 February), so the day of the
    month is compared with the original.
    """
    moved = F.add_months(day, -months)
    return F.when(F.dayofmonth(moved) == F.dayofmonth(day), moved)


def lookback_year(day: Column, end: date) -> Column:
    """1, 2 or 3: the year before ``end`` the day falls in, 3 being anything older.

    Days after ``end`` are year 1; the windows of the summary cut them off.
    """
    return (
        F.when(day >= F.lit(years_back(end, 1)), 1)
        .when(day >= F.lit(years_back(end, 2)), 2)
        .when(day < F.lit(years_back(end, 2)), 3)
    )


def day_label(day: Column) -> Column:
    """``30SEP16`` for 30 September 2016."""
    return F.upper(F.date_format(day, "ddMMMyy"))


def window_label(start: Column, end: Column) -> Column:
    return F.concat(day_label(start), F.lit(" - "), day_label(end))
