"""Expected results as SQL, branch by branch.

Written from the definition of each figure: one filtered group-by per branch, all of them
outer-joined on the keys. It shares no code and no names with the engine (``values`` has its own).
"""

from __future__ import annotations

from verification.fixtures import EXTRACT_FLOOR, view_ctes
from verification.values import CLAIM_CODES, IBNR_COVERAGES, LOSS_COVERAGES, PREMIUM_COVERAGES, source_column

PB0, END, QB0, REN0 = "1998-07-01", "2001-07-01", "2000-07-01", "2000-07-01"
FACTORS = ("PolicyStateCode_F", "Segment_F")
KEYS = ("TermType", "UWYear", *FACTORS)

D = "DATE '{}'".format
PB = f"(PolicyTermStartEffDate >= {D(PB0)} AND PolicyTermStartEffDate < {D(END)})"
QB = f"(PolicyTermStartEffDate >= {D(QB0)} AND PolicyTermStartEffDate < {D(END)})"
NB, RN = "TransactionType = 'New Business'", "TransactionType = 'Renewal'"
QUOTE_QB = f"(QuoteVersionDate >= {D(QB0)} AND QuoteVersionDate < {D(END)})"


def channel(raw):
    return (f"CASE WHEN {raw} IS NULL THEN NULL WHEN {raw}='PriceComparison' THEN 'PC' "
            f"WHEN {raw}='WebOnly' THEN 'Web' ELSE 'Agent' END")


def lookback(day):
    return (f"CASE WHEN {day} >= {D('2000-07-01')} THEN 1 WHEN {day} >= {D('1999-07-01')} THEN 2 "
            f"WHEN {day} < {D('1999-07-01')} THEN 3 END")


TERM_TYPE = ("CASE WHEN TransactionType='New Business' THEN 'NB' WHEN TransactionType='Renewal' THEN 'RN' "
             "WHEN TermType IS NULL OR TermType='New Business' THEN 'NB' WHEN TermType='Renewal' THEN 'RN' "
             "ELSE TermType END")
RELABEL = "CASE WHEN TransactionType='Submission' THEN 'New Business' ELSE TransactionType END"


def bigint(x):
    return f"CAST({x} AS BIGINT)"


def dbl(x):
    return f"CAST({x} AS DOUBLE)"


def with_(ctes, select):
    return "WITH " + ",\n".join(ctes) + "\n" + select


# ---------------------------------------------------------------- losses and base

def premium_cte(source="fx_pm"):
    earned = ", ".join(f"coalesce({c}, 0) AS {c}" for c in ["EP_TOTAL"] + [f"EP_{c}" for c in PREMIUM_COVERAGES])
    return f"prem AS (SELECT * REPLACE ({RELABEL} AS TransactionType, {earned}) FROM {source})"


def loss_ctes(losses="fx_loss", premium="prem"):
    code = "CASE CoverageType " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLAIM_CODES.items()) + " END"
    return [
        f"""loss0 AS (SELECT * REPLACE (CASE WHEN CatastropheKey <> 1 AND CoverageType='Comprehensive'
 THEN 'COMP_CAT' ELSE CoverageType END AS CoverageType) FROM {losses})""",
        f"loss1 AS (SELECT *, {code} AS Coverage FROM loss0 WHERE TransactionDate <= (SELECT max(EarnedAsOfDate) FROM {premium}))",
        """loss_sum AS (SELECT VehicleTermKey, Coverage,
 CASE WHEN bool_or(NetPaidClaims IS NULL OR NetCaseReserves IS NULL) THEN NULL ELSE sum(NetPaidClaims+NetCaseReserves) END AS LOSS_RI,
 count(DISTINCT ClaimNumber) + max(CASE WHEN ClaimNumber IS NULL THEN 1 ELSE 0 END) AS LOSS_CC
 FROM loss1 GROUP BY VehicleTermKey, Coverage)""",
        """loss_tot AS (SELECT VehicleTermKey,
 count(DISTINCT ClaimNumber) + max(CASE WHEN ClaimNumber IS NULL THEN 1 ELSE 0 END) AS LOSS_CC_TOTAL
 FROM loss1 GROUP BY VehicleTermKey)""",
    ]


def pivot_cte():
    cells = []
    for cov in LOSS_COVERAGES:
        # A coverage without claims is 0, one with an unknown amount stays unknown.
        cells.append(f"CASE WHEN bool_or(Coverage='{cov}') THEN max(CASE WHEN Coverage='{cov}' THEN LOSS_RI END) ELSE 0 END AS LOSS_RI_{cov}")
        cells.append(f"coalesce(max(CASE WHEN Coverage='{cov}' THEN LOSS_CC END), 0) AS LOSS_CC_{cov}")
    return (f"loss_piv AS (SELECT s.VehicleTermKey, {', '.join(cells)}, max(LOSS_CC_TOTAL) AS LOSS_CC_TOTAL "
            "FROM loss_sum s JOIN loss_tot t ON s.VehicleTermKey=t.VehicleTermKey GROUP BY s.VehicleTermKey)")


def developed_cte(ibnr="fx_ibnr", how="LEFT"):
    columns = ["coalesce(i.VehicleTermKey, p.VehicleTermKey) AS VehicleTermKey"]
    for cov in LOSS_COVERAGES:
        ri = f"coalesce(LOSS_RI_{cov}, 0)" + (f" + coalesce(IBNR_{cov}, 0)" if cov in IBNR_COVERAGES else "")
        columns += [f"{ri} AS LOSS_RI_{cov}", f"coalesce(LOSS_CC_{cov}, 0) AS LOSS_CC_{cov}"]
    columns.append("coalesce(LOSS_CC_TOTAL, 0) AS LOSS_CC_TOTAL")
    caps = [f"CASE WHEN LOSS_RI_{cov} > {cap} THEN {cap} ELSE LOSS_RI_{cov} END AS {name}_{cov}"
            for name, cap in (("LOSS_25", 25000), ("LOSS_100", 100000)) for cov in LOSS_COVERAGES]
    return [
        f"loss_dev AS (SELECT {', '.join(columns)} FROM {ibnr} i {how} JOIN loss_piv p ON i.VehicleTermKey=p.VehicleTermKey)",
        f"loss_cap AS (SELECT *, {', '.join(caps)} FROM loss_dev)",
    ]


def base_ctes(how="LEFT", extra="", join=""):
    return [
        *view_ctes("fx_pm", "fx_loss", "fx_ibnr"),
        premium_cte(),
        *loss_ctes(),
        pivot_cte(),
        *developed_cte(how=how),
        f"base AS (SELECT p.*, {channel('p.FinanceChannel_F')} AS FinanceChannel, l.* EXCLUDE (VehicleTermKey){extra} "
        f"FROM prem p LEFT JOIN loss_cap l ON p.VehicleTermKey=l.VehicleTermKey{join})",
    ]


def quote_ctes():
    kept = f"(QuoteVersionDate >= {D(EXTRACT_FLOOR)} AND (LastQuoteVersionIndicator='T' OR QuoteVersionBoundIndicator='T'))"
    return [
        *view_ctes("fx_quote"),
        f"quotes AS (SELECT *, {channel('FinanceChannel_F')} AS FinanceChannel FROM fx_quote WHERE {kept})",
    ]


# ---------------------------------------------------------------- branches

def count_sold(x, strict=True):
    total = f"sum(CASE WHEN {x} >= 1 THEN 1 ELSE 0 END)"
    return f"CASE WHEN bool_or({x} IS NULL) THEN 0 ELSE {total} END" if strict else total


def count_positive(x, strict=True):
    total = f"sum(CASE WHEN {x} > 0 THEN 1 ELSE 0 END)"
    return f"CASE WHEN bool_or({x} IS NULL) THEN 0 ELSE {total} END" if strict else total


def count_taken(ep, wp, strict=True):
    both = f"({ep} > 0 AND {wp} > 0)"
    total = f"sum(CASE WHEN {both} THEN 1 ELSE 0 END)"
    return f"CASE WHEN bool_or({both} IS NULL) THEN 0 ELSE {total} END" if strict else total


def sum0(x):
    return f"coalesce(sum({x}), 0)"


class Oracle:
    """Branch SQL over the CTEs ``terms`` (premium base) and ``qterms`` (quotes)."""

    def __init__(self, keys=KEYS, strict=True, adjusted=()):
        self.keys, self.strict, self.adjusted = tuple(keys), strict, adjusted
        self.group = ", ".join(self.keys)

    def premium_rows(self, base="base"):
        return f"terms AS (SELECT * REPLACE ({TERM_TYPE} AS TermType, {lookback('PolicyTermStartEffDate')} AS UWYear) FROM {base})"

    def quote_rows(self, quotes="quotes"):
        return f"qterms AS (SELECT *, 'NB' AS TermType, {lookback('QuoteVersionDate')} AS UWYear FROM {quotes})"

    def plain(self, source, where, columns):
        cells = ", ".join(f"{expr} AS {name}" for name, expr in columns)
        return f"SELECT {self.group}, {cells} FROM {source} WHERE {where} GROUP BY {self.group}"

    def policies(self, source, where, policy, names):
        inner = ", ".join(
            (f"CASE WHEN bool_or(WP_{c} IS NULL) THEN NULL ELSE sum(CASE WHEN WP_{c} >= 1 THEN 1 ELSE 0 END) END"
             if self.strict else f"sum(CASE WHEN WP_{c} >= 1 THEN 1 ELSE 0 END)") + f" AS n_{c}"
            for c in PREMIUM_COVERAGES)
        outer = ", ".join(
            f"CASE WHEN bool_or(n_{c} IS NULL) THEN 0 ELSE sum(CASE WHEN n_{c} >= 1 THEN CAST(n_{c} AS DOUBLE)/VehicleCount ELSE 0 END) END AS {name}"
            for c, name in zip(PREMIUM_COVERAGES, names))
        return (f"SELECT {self.group}, {outer} FROM (SELECT {self.group}, {policy}, VehicleCount, {inner} "
                f"FROM {source} WHERE {where} GROUP BY {self.group}, {policy}, VehicleCount) GROUP BY {self.group}")

    def branch(self, name):
        """(SQL, [(column, kind)]) of one branch."""
        P, L, strict = PREMIUM_COVERAGES, LOSS_COVERAGES, self.strict

        def counted(prefix, window, where, source="terms", measure=count_sold):
            names = [f"{prefix}_{c}{window}" for c in P]
            cells = [(n, measure(f"WP_{c}", strict)) for n, c in zip(names, P)]
            return self.plain(source, where, cells), [(n, "int") for n in names]

        def single(column, where, expr="count(*)", kind="int"):
            return self.plain("terms", where, [(column, expr)]), [(column, kind)]

        mix = f"{PB} AND (({NB} AND WP_BI > 0) OR ({RN} AND EP_BI > 0))"
        either = f"({NB} OR {RN})"
        year = (f"PolicyTermExpirationEffDate < {D(END)} AND PolicyTermStartEffDate >= {D('1999-07-01')} AND {either}")
        two_back = "CAST(PolicyTermExpirationEffDate - INTERVAL 2 MONTH AS DATE)"
        early = f"day({two_back}) = day(PolicyTermExpirationEffDate) AND CancellationDate < {two_back}"
        six = (f"PolicyTermStartEffDate >= {D('2000-01-01')} AND PolicyTermStartEffDate < {D('2001-01-01')} AND "
               f"PolicyTermStartEffDate < (SELECT CAST(max(RetainedAsOfDate) - INTERVAL 6 MONTH AS DATE) FROM terms) AND {either}")
        three = f"PolicyTermStartEffDate < {D('2001-06-28')} AND PolicyTermStartEffDate >= {{}} AND {either} AND EP_BI > 0"
        three_q, three_p = three.format(D(QB0)), three.format(D(PB0))
        soon = "CancellationDate <= PolicyTermStartEffDate + 3"
        paid = f"({RN} AND EP_TOTAL > 0)"
        written_pb = f"{PB} AND (({NB}) OR {paid})"
        written_qb = (f"(({NB} AND {QB}) OR ({paid} AND PolicyTermStartEffDate >= {D(REN0)} AND "
                      f"PolicyTermStartEffDate < {D(END)}))")

        def weighted(x):
            total = f"sum(CASE WHEN WP_BI > 0 THEN CAST({x} AS DOUBLE) ELSE 0 END)"
            return f"CASE WHEN bool_or(WP_BI IS NULL) THEN 0 ELSE {total} END" if strict else total

        def sums(columns, where, kind):
            return self.plain("terms", where, [(n, sum0(e)) for n, e in columns]), [(n, kind) for n, _ in columns]

        sold_bi = count_sold("WP_BI", strict)
        if name in ("PCVS_QB", "WVS_QB", "AVS_QB"):
            code = {"P": "PC", "W": "Web", "A": "Agent"}[name[0]]
            return counted(name[:-3], "QB", f"{QB} AND {NB} AND FinanceChannel='{code}'")
        if name in ("PCVQ_QB", "WVQ_QB", "AVQ_QB"):
            code = {"P": "PC", "W": "Web", "A": "Agent"}[name[0]]
            return counted(name[:-3], "QB", f"{QUOTE_QB} AND FinanceChannel='{code}'", "qterms")
        if name == "TVS_PB":
            return counted("TVS", "PB", f"{PB} AND {NB}")
        if name in ("TPS_QB", "TPS_PB"):
            names = [f"TPS_{c}{name[-2:]}" for c in P]
            window = QB if name == "TPS_QB" else PB
            return self.policies("terms", f"{window} AND {NB}", "PolicyTermKey", names), [(n, "num") for n in names]
        if name == "TPQ_QB":
            names = [f"TPQ_{c}QB" for c in P]
            return self.policies("qterms", QUOTE_QB, "QuoteID", names), [(n, "num") for n in names]
        if name in ("VGEN_QB", "VGEN_PB"):
            return counted("VGEN", name[-2:], f"{QB if name[-2:] == 'QB' else PB} AND {RN}", measure=count_positive)
        if name in ("VREN_QB", "VREN_PB"):
            names = [f"VREN_{c}{name[-2:]}" for c in P]
            where = f"{QB if name[-2:] == 'QB' else PB} AND {RN} AND WP_BI > 0"
            cells = [(n, count_taken(f"EP_{c}", f"WP_{c}", strict)) for n, c in zip(names, P)]
            return self.plain("terms", where, cells), [(n, "int") for n in names]
        if name == "WP_QB":
            return sums([(f"WP_{c}QB", f"WP_{c}") for c in P], written_qb, "money")
        if name == "WP_PB":
            return sums([(f"WP_{c}PB", f"WP_{c}") for c in P], written_pb, "money")
        if name == "ADJ_WP":
            cells = [(f"ADJ_WP_{c}", f"{f'ADJ_WP_{c}' if c in self.adjusted else '1.0'} * CAST(WP_{c} AS DOUBLE)") for c in P]
            return sums(cells, written_pb, "adjusted")
        if name in ("EE", "EP", "CLEP"):
            return sums([(f"{name}_{c}", f"{name}_{c}") for c in P], PB, "num" if name == "EE" else "money")
        if name in ("LOSS_25", "LOSS_100", "LOSS_RI"):
            return sums([(f"{name}_{c}", f"{name}_{c}") for c in L], PB, "money")
        if name == "LOSS_CC":
            return sums([(f"LOSS_CC_{c}", f"LOSS_CC_{c}") for c in L], PB, "int")
        if name == "LOSS_CC_TOTAL":
            return sums([("LOSS_CC_TOTAL", "LOSS_CC_TOTAL")], PB, "int")
        singles = {
            "BMAge23_WP_BI": (f"{mix} AND PrimaryDriverAge IS NOT NULL", weighted("PrimaryDriverAge"), "num"),
            "BMVeh2015_WP_BI": (f"{mix} AND VehicleYearNumber IS NOT NULL", weighted("VehicleYearNumber"), "num"),
            "BMGender_WP_BI": (f"{mix} AND PrimaryDriverGender='M'", sold_bi, "int"),
            "BMLiaOnly_WP_BI": (f"{mix} AND OptionalCoverageType='None'", sold_bi, "int"),
            "BMMinLimit_WP_BI": (f"{mix} AND SelectedBILimit_f='Minimum'", sold_bi, "int"),
            "BMPayFull_WP_BI": (f"{mix} AND DownPaymentMonthsNumber >= 6", sold_bi, "int"),
            "BMRTPlus_WP_BI": (f"{mix} AND RetentionTier2_Calculated >= 80", sold_bi, "int"),
            "Month6Active": (six, sum0("Retained6Months"), "int"),
            "Month6Total": (six, "count(*)", "int"),
            "Cancels_NonPay": (f"{year} AND CancelReason_F='Non-Payment' AND {early}", "count(*)", "int"),
            "Cancels_Fraud": (f"{year} AND CancelReason_F='Fraud/UW' AND {early}", "count(*)", "int"),
            "Cancels_Other": (f"{year} AND CancelReason_F NOT IN ('Fraud/UW','Non-Payment') AND {early}", "count(*)", "int"),
            "Total1Year": (year, "count(*)", "int"),
            "CXX_QBTotal": (three_q, "count(*)", "int"),
            "CXX_PBTotal": (three_p, "count(*)", "int"),
            "CXX_ThreeDays_QB": (f"{three_q} AND {soon}", "count(*)", "int"),
            "CXX_ThreeDays_Total": (f"{three_p} AND {soon}", "count(*)", "int"),
        }
        where, expr, kind = singles[name]
        return single(name, where, expr, kind)

    def joined(self, names, extra_keys=()):
        """CTEs and SELECT of the named branches outer-joined on the keys."""
        ctes, cells, joins, tables = [], [], [], []
        for i, name in enumerate(names):
            sql, columns = self.branch(name)
            table = f"b{i}"
            tables.append(table)
            ctes.append(f"{table} AS ({sql})")
            same = " AND ".join(f"k.{key} IS NOT DISTINCT FROM {table}.{key}" for key in self.keys)
            joins.append(f"LEFT JOIN {table} ON {same}")
            for column, kind in columns:
                value = f"coalesce({table}.{column}, 0)"
                cell = {"int": bigint(value), "money": dbl(value),
                        "num": f"round({dbl(value)}, 6)", "adjusted": f"round({dbl(value)}, 4)"}[kind]
                cells.append(f"{cell} AS {column}")
        keys = " UNION ".join(f"SELECT {self.group} FROM {t}" for t in tables)
        ctes.append(f"k AS ({keys})")
        head = ", ".join([f"k.{key}" for key in self.keys])
        return ctes, head, cells, " ".join(["FROM k", *joins])


PREMIUM_BRANCHES = (
    "PCVS_QB", "WVS_QB", "AVS_QB", "TVS_PB", "TPS_QB", "TPS_PB", "VGEN_QB", "VGEN_PB", "VREN_QB", "VREN_PB",
    "BMAge23_WP_BI", "BMGender_WP_BI", "BMLiaOnly_WP_BI", "BMMinLimit_WP_BI", "BMPayFull_WP_BI",
    "BMRTPlus_WP_BI", "BMVeh2015_WP_BI", "Month6Active", "Month6Total", "Cancels_NonPay", "Cancels_Fraud",
    "Cancels_Other", "Total1Year", "CXX_QBTotal", "CXX_PBTotal", "CXX_ThreeDays_QB", "CXX_ThreeDays_Total",
    "EE", "EP", "CLEP", "LOSS_CC", "LOSS_CC_TOTAL", "LOSS_25", "LOSS_100", "LOSS_RI", "ADJ_WP", "WP_QB", "WP_PB",
)
QUOTE_BRANCHES = ("PCVQ_QB", "WVQ_QB", "AVQ_QB", "TPQ_QB")


def stats_sql(names, strict=True):
    o = Oracle(strict=strict)
    ctes = []
    if any(n not in QUOTE_BRANCHES for n in names):
        ctes += [*base_ctes(), o.premium_rows()]
    if any(n in QUOTE_BRANCHES for n in names):
        ctes += [c for c in quote_ctes() if c not in ctes] + [o.quote_rows()]
    branches, head, cells, source = o.joined(names)
    return with_([*ctes, *branches], f"SELECT {head}, {', '.join(cells)} {source}")


def summary_sql(quotes=True, strict=True, keys=KEYS, ctes=None, adjusted=()):
    """The full summary. ``ctes`` replaces the default ``base`` and ``quotes`` views."""
    o = Oracle(keys, strict, adjusted)
    if ctes is None:
        ctes = base_ctes()
        if quotes:
            ctes += [c for c in quote_ctes() if c not in ctes]
    ctes = [*ctes, o.premium_rows()] + ([o.quote_rows()] if quotes else [])
    names = PREMIUM_BRANCHES + (QUOTE_BRANCHES if quotes else ())
    branches, head, cells, source = o.joined(names)
    if not quotes:
        cells += [f"CAST(0 AS BIGINT) AS {p}_{c}QB" for p in ("PCVQ", "WVQ", "AVQ") for c in PREMIUM_COVERAGES]
        cells += [f"CAST(0 AS DOUBLE) AS TPQ_{c}QB" for c in PREMIUM_COVERAGES]
    pads = [f"'.' AS var{i}" for i in range(len(keys) + 1, 11)]
    fixed = ", ".join([*pads, "CAST(0 AS DOUBLE) AS NetPolQuotes"])
    return with_([*ctes, *branches], f"SELECT {head}, {fixed}, {', '.join(cells)} {source}")


# ---------------------------------------------------------------- extracts

def src_premium_select():
    wp = [f"pm.{source_column('WP', c)}" for c in PREMIUM_COVERAGES]
    columns = [
        "pm.PolicyTermKey", "pm.VehicleTermKey", "pm.PolicyNumber AS OrigCorePolicyNumber",
        "pm.PolicyNumber AS CorePolicyNumber", "pm.PeriodStart AS PolicyTermStartEffDate",
        "pm.PeriodEnd AS PolicyTermExpirationEffDate", "CAST(year(pm.PeriodStart) AS INTEGER) AS UWYear", "pm.TermType",
        "pm.UpdateTime AS TransactionDateTime",
        "CASE WHEN pm.TransactionType='Submission' THEN 'New Business' ELSE pm.TransactionType END AS TransactionType",
        "pm.CancelReason_F", "pm.CancellationDate", "pf.FinanceChannel_F", "pf.PolicyStateCode_F", "pf.VehicleCount",
        "pm.state AS PolicyStateCode", "pm.MaxLoadDate AS EarnedAsOfDate", "pm.MaxLoadDate AS RetainedAsOfDate",
        "pm.Retained6Months", "pm.Retained12Months", "pm.JobID AS TransactionJobID",
        "pm.VehicleFixedID AS SourceSystemVehicleID", "pf.PrimaryDriverAge", "pf.PrimaryDriverGender",
        "pf.RetentionTier2 AS RetentionTierProb", "pf.RetentionTier2_Calculated", "pf.VehicleYearNumber",
        "pf.SelectedBILimit_f", "pf.OptionalCoverage_F AS OptionalCoverageType",
        "pf.DownPaymentsMonthNumber AS DownPaymentMonthsNumber",
        f"{' + '.join(wp)} AS WP_Total", "0 AS WE_TOTAL", "coalesce(pm.EP_TOTAL, 0) AS EP_TOTAL",
    ]
    for c, w in zip(PREMIUM_COVERAGES, wp):
        columns += [
            f"{w} AS WP_{c}", f"CASE WHEN {w} > 0 THEN 1 ELSE 0 END AS WE_{c}",
            f"coalesce(pm.{source_column('EP', c)}, 0) AS EP_{c}",
            f"pm.{source_column('CLEP', c)} AS CLEP_{c}", f"pm.{source_column('EE', c)} AS EE_{c}",
        ]
    return (f"SELECT {', '.join(columns)} FROM src_pm pm JOIN src_reporting pf ON pm.VehicleTermKey=pf.VehicleTermKey "
            f"WHERE pm.BoundIndicator=1 AND pm.PeriodStart >= {D(EXTRACT_FLOOR)}")


def src_quote_select():
    wp = ", ".join(f"PCR.{source_column('WP', c)} AS WP_{c}" for c in PREMIUM_COVERAGES)
    return f"""SELECT PMQ.JobID AS RowKey, PMQ.state AS PolicyStateCode, {channel('PMR.FinanceChannel_F')} AS FinanceChannel,
 PCS.QuoteID, PMQ.VehicleFixedID AS VehicleKey, DQ.QuoteVersionDateTime AS QuoteVersionDate,
 CAST(year(PMQ.PeriodStart) AS INTEGER) AS UWYear, PMR.VehicleCount, {wp}
 FROM src_pm PMQ JOIN src_reporting PMR ON PMQ.JobID=PMR.JobID AND PMQ.VehicleFixedID=PMR.VehicleFixedID
 JOIN src_rating PCR ON PCR.JobID=PMQ.JobID AND PCR.VehicleFixedID=PMQ.VehicleFixedID
 JOIN src_rating_sup PCS ON PCS.JobID=PCR.JobID AND PCS.VehicleFixedID=PCR.VehicleFixedID
 JOIN src_dim_quote DQ ON DQ.QuoteVersionKey=PCS.QuoteVersionKey
 WHERE DQ.QuoteVersionDateTime >= {D(EXTRACT_FLOOR)} AND (DQ.LastQuoteVersionIndicator='T' OR DQ.QuoteVersionBoundIndicator='T')"""


FACTOR_COLUMNS = ("Segment_F", "Limit_BI", "PriorBILimit_F", "TermNumber")
_FACTOR_SELECT = "PMR.Segment_F, PCR.Limit_BI, SUP.PriorBILimit_F, PMR.TermNumber"
_FACTOR_FROM = """src_reporting PMR JOIN src_rating PCR ON PMR.JobID=PCR.JobID AND PMR.VehicleFixedID=PCR.VehicleFixedID
 JOIN src_rating_sup SUP ON PMR.JobID=SUP.JobID AND PMR.VehicleFixedID=SUP.VehicleFixedID"""


def src_premium_factor_select():
    return f"SELECT PMR.VehicleTermKey, {_FACTOR_SELECT} FROM {_FACTOR_FROM} WHERE PMR.BoundIndicator=1"


def src_quote_factor_select(bound=0):
    return (f"SELECT PMR.JobID AS RowKey, PMR.VehicleFixedID AS VehicleKey, {_FACTOR_SELECT.replace('PMR.TermNumber', '1 AS TermNumber')} "
            f"FROM {_FACTOR_FROM} JOIN src_dim_quote DQ ON DQ.QuoteVersionKey=SUP.QuoteVersionKey "
            f"WHERE PMR.BoundIndicator={bound} AND DQ.QuoteVersionDateTime >= {D(EXTRACT_FLOOR)} "
            "AND (DQ.LastQuoteVersionIndicator='T' OR DQ.QuoteVersionBoundIndicator='T')")


SRC_PREMIUM_VIEWS = ("src_pm", "src_reporting")
SRC_FACTOR_VIEWS = ("src_reporting", "src_rating", "src_rating_sup")
SRC_QUOTE_VIEWS = ("src_pm", "src_reporting", "src_rating", "src_rating_sup", "src_dim_quote")
