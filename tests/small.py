"""Small premium and quote frames with every kind of gap in them."""

from __future__ import annotations

import random
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import types as T

from rateloom.coverages import LOSS_COVERAGES, PREMIUM_COVERAGES, named

MONEY = T.DecimalType(18, 2)
_LOSS_MONEY = [*named("LOSS_RI", LOSS_COVERAGES), *named("LOSS_25", LOSS_COVERAGES), *named("LOSS_100", LOSS_COVERAGES)]

BASE_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("VehicleTermKey", "PolicyTermKey")]
    + [T.StructField(n, T.DateType()) for n in (
        "PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "CancellationDate", "RetainedAsOfDate")]
    + [T.StructField(n, T.StringType()) for n in (
        "TransactionType", "TermType", "FinanceChannel", "CancelReason_F", "PolicyStateCode_F", "Segment_F",
        "PrimaryDriverGender", "OptionalCoverageType", "SelectedBILimit_f")]
    + [T.StructField(n, T.IntegerType()) for n in (
        "VehicleCount", "Retained6Months", "PrimaryDriverAge", "VehicleYearNumber", "DownPaymentMonthsNumber", "UWYear")]
    + [T.StructField("RetentionTier2_Calculated", T.DoubleType())]
    + [T.StructField(n, MONEY) for n in [*named("WP"), *named("EP", (*PREMIUM_COVERAGES, "TOTAL")), *named("CLEP"), *_LOSS_MONEY]]
    + [T.StructField(n, T.DoubleType()) for n in named("EE")]
    + [T.StructField(n, T.LongType()) for n in named("LOSS_CC", (*LOSS_COVERAGES, "TOTAL"))]
)
QUOTE_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("RowKey", "VehicleKey", "QuoteID")]
    + [T.StructField("QuoteVersionDate", T.DateType())]
    + [T.StructField(n, T.StringType()) for n in ("FinanceChannel", "PolicyStateCode_F", "Segment_F")]
    + [T.StructField("VehicleCount", T.IntegerType())]
    + [T.StructField(n, MONEY) for n in named("WP")]
)


def premium_row(**given) -> dict:
    """A new-business term in every window, without premium or losses."""
    row = {f.name: None for f in BASE_SCHEMA}
    row.update(
        VehicleTermKey=1, PolicyTermKey=1, PolicyTermStartEffDate=date(2000, 8, 1),
        PolicyTermExpirationEffDate=date(2001, 2, 1), RetainedAsOfDate=date(2001, 8, 1),
        TransactionType="New Business", TermType="New Business", FinanceChannel="PC",
        PolicyStateCode_F="A", Segment_F="S", VehicleCount=1,
    )
    row.update({n: Decimal("0.00") for n in [*named("WP"), *named("EP"), "EP_TOTAL"]})
    row.update(given)
    return row


def quote_row(**given) -> dict:
    row = {f.name: None for f in QUOTE_SCHEMA}
    row.update(RowKey=1, VehicleKey=1, QuoteID=1, QuoteVersionDate=date(2000, 8, 1), FinanceChannel="PC",
               PolicyStateCode_F="A", Segment_F="S", VehicleCount=1)
    row.update({n: Decimal("0.00") for n in named("WP")})
    row.update(given)
    return row


def frame(spark, schema, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in rows], schema)


def random_rows(seed: int, premium: int = 400, quotes: int = 300):
    rng = random.Random(seed)
    pick = rng.choice

    def money(gap=0.03):
        if rng.random() < gap:
            return None
        return pick([Decimal("0.00"), Decimal("0.50"), Decimal("1.00"), Decimal(rng.randint(0, 9_000_000)) / 100])

    def day():
        return date(1997, 6, 1) + timedelta(days=rng.randint(0, 1700))

    base = []
    for i in range(premium):
        start = day()
        row = premium_row(
            VehicleTermKey=i, PolicyTermKey=i // 3, PolicyTermStartEffDate=start,
            PolicyTermExpirationEffDate=start + timedelta(days=pick([181, 184, 365])),
            CancellationDate=pick([None, start + timedelta(days=rng.randint(0, 200))]),
            RetainedAsOfDate=pick([None, date(2001, 6, 15)]),
            TransactionType=pick(["New Business", "Renewal", "Policy Change", None]),
            TermType=pick(["New Business", "Renewal", "Rewrite", None]),
            FinanceChannel=pick(["PC", "Web", "Agent", None]),
            CancelReason_F=pick(["Non-Payment", "Fraud/UW", "Moved", None]),
            PolicyStateCode_F=pick(["A", "B", None]), Segment_F=pick(["S", None]),
            PrimaryDriverGender=pick(["M", "F", None]), OptionalCoverageType=pick(["None", "Full", None]),
            SelectedBILimit_f=pick(["Minimum", "High", None]), VehicleCount=pick([1, 2, 3]),
            Retained6Months=pick([0, 1, None]), PrimaryDriverAge=pick([16, 40, 80, None]),
            VehicleYearNumber=pick([1999, 2015, None]), DownPaymentMonthsNumber=pick([0, 6, 12, None]),
            RetentionTier2_Calculated=pick([10.0, 80.0, 95.5, None]),
        )
        row.update({n: money(0.003) for n in named("WP")})
        row.update({n: money(0.003) for n in named("EP", (*PREMIUM_COVERAGES, "TOTAL"))})
        row.update({n: money() for n in [*named("CLEP"), *_LOSS_MONEY]})
        row.update({n: pick([0.0, 0.25, 0.5, None]) for n in named("EE")})
        row.update({n: pick([0, 1, 2, None]) for n in named("LOSS_CC", (*LOSS_COVERAGES, "TOTAL"))})
        base.append(row)
    quoted = []
    for i in range(quotes):
        row = quote_row(RowKey=i // 2, VehicleKey=i, QuoteID=i // 4, QuoteVersionDate=day(),
                        FinanceChannel=pick(["PC", "Web", "Agent", None]), VehicleCount=pick([1, 2]),
                        PolicyStateCode_F=pick(["A", "C", None]), Segment_F=pick(["S", None]))
        row.update({n: money(0.003) for n in named("WP")})
        quoted.append(row)
    return base, quoted
