"""The premium and loss base: one row per vehicle-term."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.coverages import LOSS_COVERAGES, PREMIUM_COVERAGES, named
from rateloom.functions.recode import channel
from rateloom.operators.losses import develop, loss_by_vehicle, losses_as_of, with_caps

# Descriptive columns of the base, in order.
BASE_COLUMNS = (
    "VehicleTermKey", "PolicyTermKey", "OrigCorePolicyNumber", "CorePolicyNumber",
    "PolicyTermStartEffDate", "PolicyTermExpirationEffDate", "PolicyStateCode_F", "UWYear",
    "TermType", "TransactionDateTime", "TransactionType", "CancelReason_F", "CancellationDate",
    "FinanceChannel_F", "TransactionJobID", "SourceSystemVehicleID", "VehicleCount",
    "PrimaryDriverAge", "PrimaryDriverGender", "RetentionTierProb", "RetentionTier2_Calculated",
    "VehicleYearNumber", "SelectedBILimit_f", "OptionalCoverageType", "DownPaymentMonthsNumber",
    "RetainedAsOfDate", "Retained6Months", "Retained12Months", "EarnedAsOfDate",
)
PREMIUM_COLUMNS = (
    *named("WP"), *named("EP", (*PREMIUM_COVERAGES, "TOTAL")), *named("EE"), *named("CLEP"),
)
DEVELOPED_COLUMNS = (*named("LOSS_CC", (*LOSS_COVERAGES, "TOTAL")), *named("LOSS_RI", LOSS_COVERAGES))
LOSS_COLUMNS = (*DEVELOPED_COLUMNS, *named("LOSS_25", LOSS_COVERAGES), *named("LOSS_100", LOSS_COVERAGES))


def premium_columns(premium: DataFrame, keep: tuple[str, ...] = (), needed: Collection[str] | None = None) -> list[str]:
    """The columns the base takes from the premium extract, as far as it has them; of the descriptive ones those ``needed``."""
    present = set(premium.columns)
    described = BASE_COLUMNS if needed is None else [c for c in BASE_COLUMNS if c.lower() in {n.lower() for n in needed}]
    return [c for c in (*described, *PREMIUM_COLUMNS, *keep) if c in present]


def developed_losses(
    premium: DataFrame,
    losses: DataFrame,
    ibnr: DataFrame,
    orphan_losses: str = "drop",
    earned_as_of: date | Column | None = None,
) -> DataFrame:
    """As-of cut, claims to vehicle-terms, IBNR."""
    return develop(ibnr, loss_by_vehicle(losses_as_of(losses, premium, earned_as_of)), orphan_losses)


def premium_loss_base(
    premium: DataFrame,
    losses: DataFrame,
    ibnr: DataFrame,
    orphan_losses: str = "drop",
    keep: tuple[str, ...] = (),
    earned_as_of: date | Column | None = None,
    earned_from: DataFrame | None = None,
    caps: bool = True,
) -> DataFrame:
    """Every premium row with its developed and capped losses and its sales channel.

    ``keep`` names further premium columns to carry, such as rating factors the premium
    table already has. The claims are cut at ``earned_as_of``, or else at the latest earned
    date of ``earned_from``, or else of ``premium``. Premium rows without losses keep NULL losses. All three inputs
    meet on VehicleTermKey, so rows move once per input and not again between the joins;
    the capped columns are made after the join, so that they do not move at all. Without ``caps`` they are
    left to the caller, who moves the rows once more first.
    """
    carried = premium_columns(premium, keep)
    cut_by = premium if earned_from is None else earned_from
    joined = premium.selectExpr(*carried).join(
        developed_losses(cut_by, losses, ibnr, orphan_losses, earned_as_of), "VehicleTermKey", "left"
    )
    joined = joined.withColumn("FinanceChannel", channel(F.col("FinanceChannel_F")))
    if not caps:
        return joined.selectExpr(*carried, *DEVELOPED_COLUMNS, "FinanceChannel")
    return with_caps(joined).selectExpr(*carried, *LOSS_COLUMNS, "FinanceChannel")


#: A stored base is dealt into folders by this column: year and month of the term's start, as 201609. Terms without a start,
#: and those that expire before they start, which a window may reach from either side, are in a folder of their own.
START_MONTH = "StartMonth"


def by_month(base: DataFrame) -> DataFrame:
    """The base with START_MONTH, in ranges of month and vehicle-term: a month's files are as many as its rows fill, and a
    month that holds most rows is spread over several tasks."""
    start, expiry = F.col("PolicyTermStartEffDate").cast("date"), F.col("PolicyTermExpirationEffDate").cast("date")
    month = F.when(expiry < start, None).otherwise(F.year(start) * 100 + F.month(start)).cast("int")
    return base.withColumn(START_MONTH, month).repartitionByRange(START_MONTH, "VehicleTermKey").sortWithinPartitions(
        START_MONTH, "VehicleTermKey")


def in_months(base: DataFrame, first: date, end: date) -> DataFrame:
    """Rows of a base by month that start from ``first`` on and, or expire, before ``end``; other months are not read."""
    if START_MONTH not in base.columns:
        return base
    month = F.col(START_MONTH)
    within = month.between(first.year * 100 + first.month, end.year * 100 + end.month)
    return base.where(month.isNull() | within).drop(START_MONTH)
