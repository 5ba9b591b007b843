"""What the summary measures, stated once.

A *branch* is a condition on rows together with the figures taken over the rows that
meet it. All branches are computed in one pass: every premium row is unpivoted into
*lines* (one per coverage, and a few that carry the per-vehicle figures), each line has
the same small set of number columns (*slots*), and the lines are summed by key and line
name. The tables below say which figure travels in which slot.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from rateloom.coverages import LOSS_COVERAGES, PREMIUM_COVERAGES
from rateloom.params import PricingParams

# Slots, in bit order: counts, fractional numbers, amounts. The row condition of slot i
# is bit i of a line's ``rows``; bit i of ``unknown`` says that a NULL spoilt slot i.
COUNT_SLOTS = tuple(f"c{i}" for i in range(1, 11))
KEPT_SLOT = "c10"  # only the retained vehicles, whose column may be of any number type
NUMBER_SLOTS = tuple(f"x{i}" for i in range(1, 5))
AMOUNT_SLOTS = tuple(f"m{i}" for i in range(1, 8))
RETAINED = "_retained_as_of"
SLOTS = COUNT_SLOTS + NUMBER_SLOTS + AMOUNT_SLOTS


def bit_of(slot: str) -> int:
    return 1 << SLOTS.index(slot)


@dataclass(frozen=True)
class CoverageStat:
    """A figure per coverage. ``name`` is PREFIX or PREFIX_WINDOW; columns are PREFIX_covWINDOW."""

    name: str
    slot: str
    rows: str
    measure: str
    strict: bool = False
    coverages: tuple[str, ...] = PREMIUM_COVERAGES

    def column(self, coverage: str) -> str:
        prefix, window = (self.name[:-3], self.name[-2:]) if self.name[-3:] in ("_QB", "_PB") else (self.name, "")
        return f"{prefix}_{coverage}{window}"

    @property
    def columns(self) -> list[str]:
        return [self.column(cov) for cov in self.coverages]


@dataclass(frozen=True)
class VehicleStat:
    """A figure with a single column, in a slot of a line of its own."""

    name: str
    line: str
    slot: str
    rows: str
    measure: str
    strict: bool = False

    @property
    def columns(self) -> list[str]:
        return [self.name]


# Measures of a coverage line:
#   sold      written premium at least 1
#   generated written premium above 0
#   taken     earned and written premium above 0
#   share     sold, divided by the vehicles of the policy: sums to policies
# Any other name is a column of the line, added up as it is.
PREMIUM_STATS = (
    CoverageStat("PCVS_QB", "c1", "sale_pc_qb", "sold", strict=True),
    CoverageStat("WVS_QB", "c2", "sale_web_qb", "sold", strict=True),
    CoverageStat("AVS_QB", "c3", "sale_agent_qb", "sold", strict=True),
    CoverageStat("TVS_PB", "c4", "sale_pb", "sold", strict=True),
    CoverageStat("VGEN_QB", "c5", "renewal_qb", "generated", strict=True),
    CoverageStat("VGEN_PB", "c6", "renewal_pb", "generated", strict=True),
    CoverageStat("VREN_QB", "c7", "insured_renewal_qb", "taken", strict=True),
    CoverageStat("VREN_PB", "c8", "insured_renewal_pb", "taken", strict=True),
    CoverageStat("LOSS_CC", "c9", "pb", "cc", coverages=LOSS_COVERAGES),
    CoverageStat("TPS_QB", "x1", "sale_qb", "share", strict=True),
    CoverageStat("TPS_PB", "x2", "sale_pb", "share", strict=True),
    CoverageStat("EE", "x3", "pb", "ee"),
    CoverageStat("ADJ_WP", "x4", "written_pb", "adj"),
    CoverageStat("WP_QB", "m1", "written_qb", "wp"),
    CoverageStat("WP_PB", "m2", "written_pb", "wp"),
    CoverageStat("EP", "m3", "pb", "ep"),
    CoverageStat("CLEP", "m4", "pb", "clep"),
    CoverageStat("LOSS_25", "m5", "pb", "loss_25", coverages=LOSS_COVERAGES),
    CoverageStat("LOSS_100", "m6", "pb", "loss_100", coverages=LOSS_COVERAGES),
    CoverageStat("LOSS_RI", "m7", "pb", "loss_ri", coverages=LOSS_COVERAGES),
)

QUOTE_STATS = (
    CoverageStat("PCVQ_QB", "c1", "quote_pc_qb", "sold", strict=True),
    CoverageStat("WVQ_QB", "c2", "quote_web_qb", "sold", strict=True),
    CoverageStat("AVQ_QB", "c3", "quote_agent_qb", "sold", strict=True),
    CoverageStat("TPQ_QB", "x1", "quote_qb", "share", strict=True),
)

# Measures of a vehicle: one (rows), sold_bi (BI written premium at least 1), a column
# (added up), a column with _if_bi (added up where BI written premium is above 0).
# Rows are counted in the slots that count on a coverage line; what is added up takes the
# slot of a coverage measure of the same type.
VEHICLE_STATS = (
    VehicleStat("BMGender_WP_BI", "V1", "c1", "mix_male", "sold_bi", strict=True),
    VehicleStat("BMLiaOnly_WP_BI", "V1", "c2", "mix_liability_only", "sold_bi", strict=True),
    VehicleStat("BMMinLimit_WP_BI", "V1", "c3", "mix_minimum_limit", "sold_bi", strict=True),
    VehicleStat("BMPayFull_WP_BI", "V1", "c4", "mix_paid_in_full", "sold_bi", strict=True),
    VehicleStat("BMRTPlus_WP_BI", "V1", "c5", "mix_retention_tier", "sold_bi", strict=True),
    VehicleStat("Month6Total", "V1", "c6", "six_months", "one"),
    VehicleStat("Total1Year", "V1", "c7", "one_year", "one"),
    VehicleStat("Cancels_NonPay", "V1", "c8", "cancel_non_pay", "one"),
    VehicleStat("Month6Active", "V1", KEPT_SLOT, "six_months", "Retained6Months"),
    VehicleStat("BMAge23_WP_BI", "V1", "x3", "mix_age_known", "PrimaryDriverAge_if_bi", strict=True),
    VehicleStat("BMVeh2015_WP_BI", "V1", "x4", "mix_year_known", "VehicleYearNumber_if_bi", strict=True),
    VehicleStat("Cancels_Fraud", "V2", "c1", "cancel_fraud", "one"),
    VehicleStat("Cancels_Other", "V2", "c2", "cancel_other", "one"),
    VehicleStat("CXX_QBTotal", "V2", "c3", "three_days_qb", "one"),
    VehicleStat("CXX_PBTotal", "V2", "c4", "three_days_pb", "one"),
    VehicleStat("CXX_ThreeDays_QB", "V2", "c5", "three_days_cancelled_qb", "one"),
    VehicleStat("CXX_ThreeDays_Total", "V2", "c6", "three_days_cancelled_pb", "one"),
    VehicleStat("LOSS_CC_TOTAL", "V2", "c9", "pb", "LOSS_CC_TOTAL"),
)

ALL_STATS = PREMIUM_STATS + VEHICLE_STATS + QUOTE_STATS
STAT_NAMES = tuple(stat.name for stat in ALL_STATS)


def sql_day(day: date | None) -> str:
    return f"DATE'{day}'" if day else "CAST(NULL AS DATE)"


def sql_window(column: str, start: date, end: date) -> str:
    return f"({column} >= {sql_day(start)} AND {column} < {sql_day(end)})"


def shared_conditions(p: PricingParams) -> dict[str, str]:
    """Conditions most branches share, evaluated once per premium row as columns."""
    pb = sql_window("PolicyTermStartEffDate", p.prem_loss_start, p.end)
    sale, renewal = "TransactionType = 'New Business'", "TransactionType = 'Renewal'"
    return {
        "_pb": pb,
        "_qb": sql_window("PolicyTermStartEffDate", p.sale_quote_start, p.end),
        "_sale": sale,
        "_renewal": renewal,
        "_mix": f"{pb} AND (({sale} AND WP_BI > 0) OR ({renewal} AND EP_BI > 0))",
    }


def premium_conditions(p: PricingParams) -> dict[str, str]:
    """Row conditions over the premium base as SQL, by name.

    They refer to the shared conditions and to a column with the latest retention date of
    the whole base.
    """
    start, expiry = "PolicyTermStartEffDate", "PolicyTermExpirationEffDate"
    either = "(_sale OR _renewal)"
    six_months = f"{sql_window(start, *p.retention_window)} AND {either} AND {start} < add_months({RETAINED}, -6)"

    # A sale window that starts on 29 February has no same day a year earlier: no rows.
    one_year = f"{expiry} < {sql_day(p.end)} AND {start} >= {sql_day(p.cancel_start)} AND {either}"
    # Two months before expiry; there is no such day if the month is too short.
    two_back = f"add_months({expiry}, -2)"
    early = f"{one_year} AND day({two_back}) = day({expiry}) AND CancellationDate < {two_back}"

    three_days_qb = f"{sql_window(start, p.sale_quote_start, p.three_day_end)} AND {either} AND EP_BI > 0"
    three_days_pb = f"{sql_window(start, p.prem_loss_start, p.three_day_end)} AND {either} AND EP_BI > 0"
    within_three_days = f"CancellationDate <= date_add({start}, 3)"

    return {
        "pb": "_pb",
        "sale_qb": "_qb AND _sale",
        "sale_pb": "_pb AND _sale",
        "sale_pc_qb": "_qb AND _sale AND FinanceChannel = 'PC'",
        "sale_web_qb": "_qb AND _sale AND FinanceChannel = 'Web'",
        "sale_agent_qb": "_qb AND _sale AND FinanceChannel = 'Agent'",
        "renewal_qb": "_qb AND _renewal",
        "renewal_pb": "_pb AND _renewal",
        "insured_renewal_qb": "_qb AND _renewal AND WP_BI > 0",
        "insured_renewal_pb": "_pb AND _renewal AND WP_BI > 0",
        "written_qb": f"((_qb AND _sale) OR ({sql_window(start, p.renewal_start, p.end)} AND _renewal AND EP_TOTAL > 0))",
        "written_pb": "_pb AND (_sale OR (_renewal AND EP_TOTAL > 0))",
        "mix_age_known": "_mix AND PrimaryDriverAge IS NOT NULL",
        "mix_male": "_mix AND PrimaryDriverGender = 'M'",
        "mix_liability_only": "_mix AND OptionalCoverageType = 'None'",
        "mix_minimum_limit": "_mix AND SelectedBILimit_f = 'Minimum'",
        "mix_paid_in_full": "_mix AND DownPaymentMonthsNumber >= 6",
        "mix_retention_tier": "_mix AND RetentionTier2_Calculated >= 80",
        "mix_year_known": "_mix AND VehicleYearNumber IS NOT NULL",
        "six_months": six_months,
        "one_year": one_year,
        "cancel_non_pay": f"{early} AND CancelReason_F = 'Non-Payment'",
        "cancel_fraud": f"{early} AND CancelReason_F = 'Fraud/UW'",
        "cancel_other": f"{early} AND CancelReason_F NOT IN ('Fraud/UW', 'Non-Payment')",
        "three_days_qb": three_days_qb,
        "three_days_pb": three_days_pb,
        "three_days_cancelled_qb": f"{three_days_qb} AND {within_three_days}",
        "three_days_cancelled_pb": f"{three_days_pb} AND {within_three_days}",
    }


def quote_conditions(p: PricingParams) -> dict[str, str]:
    """Row conditions over the quote base as SQL, by name."""
    qb = sql_window("QuoteVersionDate", p.sale_quote_start, p.end)
    return {
        "quote_qb": qb,
        "quote_pc_qb": f"{qb} AND FinanceChannel = 'PC'",
        "quote_web_qb": f"{qb} AND FinanceChannel = 'Web'",
        "quote_agent_qb": f"{qb} AND FinanceChannel = 'Agent'",
    }


def any_of(conditions) -> str:
    """Disjunction, leaving out conditions that only narrow another one."""
    given = list(dict.fromkeys(conditions))
    widest = [c for c in given if not any(c.startswith(f"{other} AND ") for other in given)]
    return " OR ".join(f"({c})" for c in widest)


def or_bits(parts) -> str:
    return " | ".join(f"({p})" for p in parts) or "0"


def row_bits(stats, conditions: dict[str, str]) -> str:
    """Integer with the bit of every slot whose row condition holds."""
    by_rows: dict[str, int] = {}
    for s in stats:
        by_rows[s.rows] = by_rows.get(s.rows, 0) | bit_of(s.slot)
    return or_bits(f"IF({conditions[rows]}, {bits}, 0)" for rows, bits in by_rows.items())
