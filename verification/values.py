"""Names and codes of the source tables as the oracle knows them, written out by hand and not shared with the engine."""

# Coverages with premium, with losses, and with IBNR.
PREMIUM_COVERAGES = ("BI", "PD", "COL", "COMP", "CE", "LOAN", "MED", "PIP", "PIPWAGE", "RENT", "TOW", "UMBI", "UMPD", "BIFEE")
LOSS_COVERAGES = ("BI", "PD", "COL", "COMP", "COMP_CAT", "CE", "LOAN", "MED", "PIP", "PIPWAGE", "RENT", "TOW", "UMBI", "UMPD")
IBNR_COVERAGES = ("BI", "PD", "COMP", "COL", "UMBI", "UMPD", "MED", "PIP", "PIPWAGE", "LOAN", "CE", "RENT")

# Endings of the warehouse's premium columns, in the order of PREMIUM_COVERAGES; written premium has its own.
WRITTEN = ("BI", "PD", "COLL", "COMP", "CUST", "LOAN", "MED", "PIP", "ILC", "RR", "ERS", "UMBI", "UMPD", "EXP")
EARNED = ("BI", "PD", "COLL", "COMP", "CE", "LOAN", "MED", "PIP", "ILC", "RR", "ERS", "UMBI", "UMPD", "EXP")

# Claim coverages and their codes.
CLAIM_CODES = {
    "BodilyInjury": "BI", "PropertyDamage": "PD", "Comprehensive": "COMP", "COMP_CAT": "COMP_CAT", "Collision": "COL",
    "UMBI": "UMBI", "UMPD": "UMPD", "RentalReimbursement": "RENT", "MedPay": "MED", "PIP": "PIP", "LoanGap": "LOAN",
    "TowingLabor": "TOW", "CustomEquipment": "CE", "PIPLostWages": "PIPWAGE", "Unknown": "UNK",
}

# The summary's columns behind its ten keys, as (prefix, window), in order; each stands for its coverages.
_BY_COVERAGE = [
    ("PCVQ", "QB"), ("WVQ", "QB"), ("AVQ", "QB"), ("TPQ", "QB"), ("PCVS", "QB"), ("WVS", "QB"), ("AVS", "QB"), ("TPS", "QB"),
    ("TVS", "PB"), ("TPS", "PB"), ("VGEN", "QB"), ("VGEN", "PB"), ("VREN", "QB"), ("VREN", "PB"),
]
_MIX = ["BMAge23_WP_BI", "BMGender_WP_BI", "BMRTPlus_WP_BI", "BMVeh2015_WP_BI", "BMMinLimit_WP_BI", "BMLiaOnly_WP_BI", "BMPayFull_WP_BI"]
_AMOUNTS = [("WP", "QB"), ("WP", "PB"), ("ADJ_WP", ""), ("EE", ""), ("EP", ""), ("CLEP", "")]
_TERMS = ["Month6Total", "Month6Active", "Total1Year", "CXX_QBTotal", "CXX_PBTotal", "Cancels_Other", "Cancels_Fraud",
          "Cancels_NonPay", "CXX_ThreeDays_QB", "CXX_ThreeDays_Total", "LOSS_CC_TOTAL"]
_LOSSES = ["LOSS_CC", "LOSS_25", "LOSS_100", "LOSS_RI"]


def source_column(measure: str, coverage: str) -> str:
    endings = WRITTEN if measure == "WP" else EARNED
    return f"{measure}_{endings[PREMIUM_COVERAGES.index(coverage)]}"


def summary_columns() -> list[str]:
    """The columns of the summary behind its keys."""
    def spread(parts):
        return [f"{prefix}_{cov}{window}" for prefix, window in parts for cov in PREMIUM_COVERAGES]

    losses = [f"{prefix}_{cov}" for prefix in _LOSSES for cov in LOSS_COVERAGES]
    return ["NetPolQuotes", *spread(_BY_COVERAGE), *_MIX, *spread(_AMOUNTS), *_TERMS, *losses]
