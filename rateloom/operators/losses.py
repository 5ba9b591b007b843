"""Claim transactions to one developed, capped loss row per vehicle-term."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateloom.coverages import IBNR_COVERAGES, LOSS_CAPS, LOSS_COVERAGES, named
from rateloom.functions.measures import Parts, capped, distinct_with_null, strict_sum
from rateloom.functions.recode import coverage_code

INCURRED = "NetPaidClaims + NetCaseReserves"


def losses_as_of(losses: DataFrame, premium: DataFrame, earned_as_of: date | Column | None = None) -> DataFrame:
    """Transactions up to the latest earned day of the premium table, looked up if not given."""
    if earned_as_of is None:
        earned_as_of = premium.agg(F.max("EarnedAsOfDate")).scalar()
    last_earned = earned_as_of if isinstance(earned_as_of, Column) else F.lit(earned_as_of)
    return losses.where(F.col("TransactionDate").cast("date") <= last_earned.cast("date"))


def loss_summary(losses: DataFrame) -> DataFrame:
    """Incurred loss and distinct claims by vehicle-term and coverage code.

    Claims under an unknown coverage name come out under a NULL code.
    """
    return (
        losses.select("VehicleTermKey", "ClaimNumber", F.expr(INCURRED).alias("incurred"),
                      coverage_code(F.col("CoverageType")).alias("Coverage"))
        .groupBy("VehicleTermKey", "Coverage")
        .agg(strict_sum(F.col("incurred")).alias("LOSS_RI"),
             distinct_with_null(F.col("ClaimNumber")).alias("LOSS_CC"))
    )


def total_claims(losses: DataFrame) -> DataFrame:
    """Distinct claims by vehicle-term over all coverages, unknown ones included."""
    return losses.groupBy("VehicleTermKey").agg(
        distinct_with_null(F.col("ClaimNumber")).alias("LOSS_CC_TOTAL")
    )


def _amount_type(*types: T.DataType) -> str:
    """A type that holds sums of amounts of all these types with every digit behind the point."""
    if not all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in types):
        return "DOUBLE"
    return f"DECIMAL(37, {max(getattr(t, 'scale', 0) for t in types)})"


def loss_by_vehicle(losses: DataFrame) -> DataFrame:
    """One row per vehicle-term: LOSS_RI_* and LOSS_CC_* per coverage, LOSS_CC_TOTAL.

    Transactions are reduced to claims first, which turns distinct counts into plain counts and spreads a vehicle with very
    many transactions over its claims. A claim carries its amount per coverage and two sets of coverages, as bits: those it
    has, and those with a missing amount. Claims of a vehicle then add up, within the tasks before they move: two shuffles.
    Decimals are added up in two parts, as longs.
    """
    bits = {cov: 1 << i for i, cov in enumerate(LOSS_COVERAGES)}
    places = ", ".join(f"'{cov}'" for cov in LOSS_COVERAGES)
    rows = losses.select(
        "VehicleTermKey", "ClaimNumber", F.expr(INCURRED).alias("incurred"), coverage_code(F.col("CoverageType")).alias("line"),
    ).selectExpr("VehicleTermKey", "ClaimNumber", "incurred", f"shiftright(shiftleft(1, CAST(coalesce(array_position(array({places}), line), 0) AS INT)), 1) AS bit")
    parts = Parts.of(rows.schema["incurred"].dataType)
    if parts:
        rows = rows.withColumn("high", F.expr(parts.high("incurred"))).withColumn("low", F.expr(parts.low("incurred", "high")))
    added = ("high", "low") if parts else ("incurred",)
    claims = rows.groupBy("VehicleTermKey", "ClaimNumber").agg(
        F.expr("bit_or(bit) AS present"), F.expr("bit_or(IF(incurred IS NULL, bit, 0)) AS unknown"),
        *[F.expr(f"sum(IF(bit = {bit}, {part}, NULL)) AS {part}_{cov}") for cov, bit in bits.items() for part in added],
    )
    if parts:  # the low parts of a claim add up to more digits than a long sum takes, and are taken apart once more
        carry = Parts.of(claims.schema[f"low_{LOSS_COVERAGES[0]}"].dataType)
        claims = claims.selectExpr("VehicleTermKey", "present", "unknown", *[sql for cov in bits for sql in (
            f"high_{cov} + {carry.high(f'low_{cov}')} AS high_{cov}", f"{carry.low(f'low_{cov}', carry.high(f'low_{cov}'))} AS low_{cov}")])
    vehicles = claims.groupBy("VehicleTermKey").agg(
        F.expr("bit_or(unknown) AS unknown"), F.expr("count(*) AS cc_total"),
        *[F.expr(f"sum({part}_{cov}) AS {part}_{cov}") for cov in bits for part in added],
        *[F.expr(f"count_if((present & {bit}) != 0) AS cc_{cov}") for cov, bit in bits.items()],
    )
    ri = {cov: parts.total(f"high_{cov}", f"low_{cov}") if parts else f"incurred_{cov}" for cov in bits}
    amount = _amount_type(losses.schema["NetPaidClaims"].dataType, losses.schema["NetCaseReserves"].dataType)
    # A coverage without claims is 0; one with a missing amount stays NULL.
    return vehicles.selectExpr(
        "VehicleTermKey",
        *[f"CAST(IF((unknown & {bit}) != 0, NULL, coalesce({ri[cov]}, 0)) AS {amount}) AS LOSS_RI_{cov}" for cov, bit in bits.items()],
        *[f"cc_{cov} AS LOSS_CC_{cov}" for cov in bits], "cc_total AS LOSS_CC_TOTAL",
    )


def develop(ibnr: DataFrame, losses_by_vehicle: DataFrame, orphan_losses: str = "drop") -> DataFrame:
    """Losses plus IBNR per vehicle-term, missing amounts as 0.

    The IBNR table decides which vehicle-terms there are: a vehicle with losses but no
    IBNR row is dropped, unless ``orphan_losses='keep'``.
    """
    if orphan_losses not in ("drop", "keep"):
        raise ValueError(f"orphan_losses must be 'drop' or 'keep', not {orphan_losses!r}")
    how = "left" if orphan_losses == "drop" else "full"
    joined = ibnr.selectExpr("VehicleTermKey", *named("IBNR", IBNR_COVERAGES)).join(
        losses_by_vehicle, "VehicleTermKey", how
    )

    types = [ibnr.schema[c].dataType for c in named("IBNR", IBNR_COVERAGES)]
    kind = _amount_type(*types, *(losses_by_vehicle.schema[c].dataType for c in named("LOSS_RI", LOSS_COVERAGES)))

    def amount(cov):
        loss = f"CAST(coalesce(LOSS_RI_{cov}, 0) AS {kind})"
        if cov not in IBNR_COVERAGES:
            return loss
        return f"{loss} + CAST(coalesce(IBNR_{cov}, 0) AS {kind})"

    return joined.selectExpr(
        "VehicleTermKey",
        *[f"{amount(cov)} AS LOSS_RI_{cov}" for cov in LOSS_COVERAGES],
        *[f"coalesce({c}, 0) AS {c}" for c in named("LOSS_CC", (*LOSS_COVERAGES, "TOTAL"))],
    )


def with_caps(losses: DataFrame) -> DataFrame:
    """Add LOSS_25_* and LOSS_100_*: the developed loss capped at 25,000 and 100,000."""
    return losses.selectExpr(
        "*",
        *[f"{capped(f'LOSS_RI_{cov}', cap)} AS {name}_{cov}"
          for name, cap in LOSS_CAPS.items() for cov in LOSS_COVERAGES],
    )
