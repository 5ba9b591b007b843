"""Coverage codes, their spellings in the source tables, and column names built from them."""

from __future__ import annotations

# Coverage codes in output order. Premium and loss lists are not the
# same: BIFEE carries no loss, COMP_CAT carries no premium.
PREMIUM_COVERAGES = (
    "BI", "PD", "COL", "COMP", "CE", "LOAN", "MED", "PIP", "PIPWAGE", "RENT", "TOW",
    "UMBI", "UMPD", "BIFEE",
)
LOSS_COVERAGES = (
    "BI", "PD", "COL", "COMP", "COMP_CAT", "CE", "LOAN", "MED", "PIP", "PIPWAGE",
    "RENT", "TOW", "UMBI", "UMPD",
)
IBNR_COVERAGES = (
    "BI", "PD", "COMP", "COL", "UMBI", "UMPD", "MED", "PIP", "PIPWAGE", "LOAN", "CE", "RENT",
)

# Where the warehouse spells a coverage differently from its code.
# Custom equipment is CUST in written premium and CE in the earned measures.
SOURCE_SPELLING = {
    "BIFEE": "EXP", "COL": "COLL", "PIPWAGE": "ILC", "RENT": "RR", "TOW": "ERS",
}
WRITTEN_SPELLING = {**SOURCE_SPELLING, "CE": "CUST"}

# Claim coverage names and their codes. Any other name has no code.
CLAIM_COVERAGE_CODES = {
    "BodilyInjury": "BI",
    "PropertyDamage": "PD",
    "Comprehensive": "COMP",
    "COMP_CAT": "COMP_CAT",
    "Collision": "COL",
    "UMBI": "UMBI",
    "UMPD": "UMPD",
    "RentalReimbursement": "RENT",
    "MedPay": "MED",
    "PIP": "PIP",
    "LoanGap": "LOAN",
    "TowingLabor": "TOW",
    "CustomEquipment": "CE",
    "PIPLostWages": "PIPWAGE",
    "Unknown": "UNK",
}

LOSS_CAPS = {"LOSS_25": 25_000, "LOSS_100": 100_000}


def named(prefix: str, coverages=PREMIUM_COVERAGES, suffix: str = "") -> list[str]:
    """Column names ``<prefix>_<coverage><suffix>`` in coverage order."""
    return [f"{prefix}_{cov}{suffix}" for cov in coverages]


def source_column(measure: str, coverage: str) -> str:
    """Name of a premium measure in the warehouse tables, e.g. WP of BIFEE is ``WP_EXP``."""
    spelling = WRITTEN_SPELLING if measure == "WP" else SOURCE_SPELLING
    return f"{measure}_{spelling.get(coverage, coverage)}"
