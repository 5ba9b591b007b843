"""Aggregates and row measures with the NULL rules the summary relies on.

All of these return column expressions; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strict_sum(value: Column) -> Column:
    """Sum that is NULL as soon as one value is NULL."""
    return F.when(~F.bool_or(value.isNull()), F.sum(value))


def strict_count(test: Column) -> Column:
    """How many rows pass ``test``; NULL as soon as the test is NULL for one row."""
    return strict_sum(F.when(test.isNull(), None).when(test, 1).otherwise(0))


def distinct_with_null(value: Column) -> Column:
    """Number of distinct values, NULL being one of them."""
    return F.count_distinct(value) + F.max(value.isNull().cast("int"))


def capped(value: str, cap: int) -> str:
    """SQL for ``value`` limited from above; NULL stays NULL (``least`` would return the cap)."""
    return f"IF({value} > {cap}, {cap}, {value})"


# Sums of decimals of up to this many digits are sums of longs in Spark; wider ones build an object per row and sum.
_LONG_SUM_DIGITS = 8


class Parts:
    """A decimal as two numbers that add up as longs: its last 8 digits, and how many whole units of the next place there are.

    Exact for every value. ``Parts.of`` gives None for types of more than 19 digits, which add up as they are: the upper part has
    11 digits at most, so its sum holds 90 million values of the largest size.
    """

    def __init__(self, kind: T.DecimalType):
        self.kind, self.unit = kind, 10 ** (_LONG_SUM_DIGITS - kind.scale)

    @classmethod
    def of(cls, kind: T.DataType) -> Parts | None:
        fits = isinstance(kind, T.DecimalType) and _LONG_SUM_DIGITS < kind.precision <= 19 and kind.scale <= _LONG_SUM_DIGITS
        return cls(kind) if fits else None

    @property
    def sum_type(self) -> str:
        """The type that a plain sum has."""
        return f"DECIMAL({min(self.kind.precision + 10, 38)},{self.kind.scale})"

    def high(self, value: str) -> str:
        return f"CAST({value} AS BIGINT) div {self.unit}"

    def low(self, value: str, high: str) -> str:
        """What ``high`` leaves of ``value``."""
        return f"CAST({value} - CAST({high} * {self.unit} AS {self.kind.simpleString()}) AS DECIMAL({_LONG_SUM_DIGITS},{self.kind.scale}))"

    def total(self, high: str, low: str) -> str:
        return f"CAST({high} AS DECIMAL(19,0)) * {self.unit} + {low}"
