"""Insurance-shaped views over the given tables.

Each view is one SQL text that Spark and DuckDB both run, so the engine and the
oracle start from the same rows. Whole tables are read; nothing is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateloom.params import PricingParams
from rateloom.sources.store import Store
from verification.values import PREMIUM_COVERAGES, source_column

BASE_TABLES = ("nation", "customer", "orders", "lineitem")

FIXTURE_PARAMS = PricingParams(
    prem_loss_start="1998-07-01",
    end="2001-07-01",
    sale_quote_start="2000-07-01",
    renewal_start="2000-07-01",
    rate_factors=("PolicyStateCode_F", "Segment_F"),
)
EXTRACT_FLOOR = "1996-01-01"

_NOT_EARNED = "sk%4=0 AND o_orderstatus='F'"


_AMOUNTS = {f"amount_{i + 1}": f"CAST(price*{i + 1} AS DECIMAL(18,2))" for i in range(len(PREMIUM_COVERAGES))}


def _premium_columns() -> str:
    columns = []
    for i, (cov, amount) in enumerate(zip(PREMIUM_COVERAGES, _AMOUNTS.values())):
        idle = f"(pk+{i})%3=0"
        zero = "CAST(0 AS DECIMAL(18,2))"
        wp_null = "pk%500=0" if cov == "TOW" else "1=0"
        columns += [
            f"CASE WHEN {wp_null} THEN NULL WHEN {idle} THEN {zero} ELSE {amount} END AS WP_{cov}",
            f"CASE WHEN pk%11=0 THEN NULL WHEN ({_NOT_EARNED}) OR {idle} THEN {zero} ELSE {amount} END AS EP_{cov}",
            f"CASE WHEN ({_NOT_EARNED}) OR {idle} THEN {zero} ELSE {amount} END AS CLEP_{cov}",
            f"CASE WHEN ({_NOT_EARNED}) OR {idle} THEN CAST(0 AS DOUBLE) ELSE CAST(0.5 AS DOUBLE) END AS EE_{cov}",
        ]
    return ",\n ".join(columns)


def _case(subject: str, values: dict, default: str = "NULL") -> str:
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())
    return f"CASE {subject} {arms} ELSE {default} END"


# Claim coverages as the transactions spell them, and the IBNR columns.
_CLAIM_NAMES = (
    "BodilyInjury", "PropertyDamage", "Comprehensive", "Collision", "UMBI", "UMPD",
    "RentalReimbursement", "MedPay", "PIP", "LoanGap", "TowingLabor", "CustomEquipment",
    "PIPLostWages", "Unknown", "Glass",
)
_IBNR_ORDER = ("BI", "PD", "COMP", "COL", "UMBI", "UMPD", "MED", "PIP", "PIPWAGE", "LOAN", "CE", "RENT")

FX_TERM = """
SELECT l_orderkey*10+l_linenumber AS VehicleTermKey, l_orderkey AS PolicyTermKey,
 min(l_partkey) AS pk, min(l_suppkey) AS sk, min(l_linenumber) AS ln,
 sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS price
FROM lineitem GROUP BY l_orderkey, l_linenumber"""

FX_PM = f"""
SELECT VehicleTermKey, PolicyTermKey, CAST(o_orderdate AS DATE) AS PolicyTermStartEffDate,
 CAST(o_orderdate + INTERVAL 6 MONTH AS DATE) AS PolicyTermExpirationEffDate,
 CASE o_orderstatus WHEN 'O' THEN 'Submission' WHEN 'F' THEN 'Renewal' ELSE 'Policy Change' END AS TransactionType,
 CASE WHEN o_custkey%10=0 THEN NULL WHEN o_custkey%2=0 THEN 'New Business' ELSE 'Renewal' END AS TermType,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'PriceComparison' WHEN '2-HIGH' THEN 'WebOnly' WHEN '3-MEDIUM' THEN NULL ELSE 'Agency' END AS FinanceChannel_F,
 n_name AS PolicyStateCode_F,
 CASE WHEN c_mktsegment='FURNITURE' THEN NULL ELSE c_mktsegment END AS Segment_F,
 CAST(count(*) OVER (PARTITION BY PolicyTermKey) AS INT) AS VehicleCount,
 CASE sk%5 WHEN 0 THEN 'Non-Payment' WHEN 1 THEN 'Fraud/UW' WHEN 2 THEN 'Moved' ELSE NULL END AS CancelReason_F,
 CAST(CASE sk%5 WHEN 0 THEN o_orderdate + INTERVAL 2 DAY WHEN 1 THEN o_orderdate + INTERVAL 45 DAY WHEN 2 THEN o_orderdate + INTERVAL 100 DAY ELSE NULL END AS DATE) AS CancellationDate,
 CASE WHEN pk%7=0 THEN NULL ELSE ln%2 END AS Retained6Months, DATE '2001-08-01' AS RetainedAsOfDate,
 year(o_orderdate) AS UWYear, DATE '2001-03-01' AS EarnedAsOfDate,
 CASE WHEN pk%13=0 THEN NULL ELSE 16+pk%60 END AS PrimaryDriverAge,
 CASE WHEN pk%2=0 THEN 'M' ELSE 'F' END AS PrimaryDriverGender,
 CASE WHEN sk%17=0 THEN NULL ELSE 1995+pk%25 END AS VehicleYearNumber,
 CASE WHEN pk%5=0 THEN 'None' ELSE 'Full' END AS OptionalCoverageType,
 CASE WHEN sk%2=0 THEN 'Minimum' ELSE 'Standard' END AS SelectedBILimit_f,
 pk%12 AS DownPaymentMonthsNumber, pk%100 AS RetentionTier2_Calculated,
 CASE WHEN {_NOT_EARNED} THEN CAST(0 AS DECIMAL(18,2)) ELSE CAST(price AS DECIMAL(18,2)) END AS EP_TOTAL,
 {_premium_columns()}
FROM fx_term JOIN orders ON PolicyTermKey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey"""

FX_LOSS = f"""
SELECT l_orderkey*10+l_linenumber AS VehicleTermKey, l_suppkey AS ClaimNumber, CAST(l_shipdate AS DATE) AS TransactionDate,
 {_case("l_partkey%15", {i: f"'{n}'" for i, n in enumerate(_CLAIM_NAMES)})} AS CoverageType,
 CASE WHEN l_quantity>=40 THEN 2 ELSE 1 END AS CatastropheKey,
 CAST(l_extendedprice AS DECIMAL(18,2)) AS NetPaidClaims,
 CASE WHEN l_partkey%97=0 THEN NULL ELSE CAST(CAST(l_quantity AS DECIMAL(18,2))*100 AS DECIMAL(18,2)) END AS NetCaseReserves
FROM lineitem"""

FX_IBNR = "SELECT VehicleTermKey, PolicyTermKey, " + ", ".join(
    f"CAST((pk+{i})%50 AS DECIMAL(18,2)) AS IBNR_{cov}" for i, cov in enumerate(_IBNR_ORDER)
) + " FROM fx_term WHERE ln<=5"

_WP = ", ".join(f"WP_{cov}" for cov in PREMIUM_COVERAGES)

FX_QUOTE = f"""
SELECT p.PolicyTermKey AS RowKey, p.VehicleTermKey AS VehicleKey, o_custkey AS QuoteID, o_orderdate AS QuoteVersionDate,
 FinanceChannel_F, VehicleCount, PolicyStateCode_F, Segment_F,
 CASE WHEN o_orderkey%3=0 THEN 'T' ELSE 'F' END AS LastQuoteVersionIndicator,
 CASE WHEN o_orderkey%4=0 THEN 'T' ELSE 'F' END AS QuoteVersionBoundIndicator,
 {_WP}
FROM fx_pm p JOIN orders ON p.PolicyTermKey=o_orderkey"""


def _source_measures(measures) -> str:
    return ", ".join(
        f"{m}_{cov} AS {source_column(m, cov)}" for m in measures for cov in PREMIUM_COVERAGES
    )


# The same rows split into the warehouse tables, under their source column names.
SRC_PM = f"""
SELECT VehicleTermKey, PolicyTermKey, PolicyTermKey AS JobID, VehicleTermKey AS VehicleFixedID,
 concat('P', CAST(PolicyTermKey AS VARCHAR(20))) AS PolicyNumber,
 PolicyTermStartEffDate AS PeriodStart, PolicyTermExpirationEffDate AS PeriodEnd, TermType,
 CAST(PolicyTermStartEffDate AS TIMESTAMP) AS UpdateTime, TransactionType, CancelReason_F, CancellationDate,
 PolicyStateCode_F AS state, EarnedAsOfDate AS MaxLoadDate, Retained6Months, Retained6Months AS Retained12Months,
 CASE WHEN PolicyTermKey%9=0 THEN 0 ELSE 1 END AS BoundIndicator,
 EP_TOTAL, {_source_measures(("WP", "EP", "CLEP", "EE"))}
FROM fx_pm"""

SRC_REPORTING = """
SELECT VehicleTermKey, PolicyTermKey AS JobID, VehicleTermKey AS VehicleFixedID,
 PolicyStateCode_F, FinanceChannel_F, VehicleCount,
 CASE WHEN PolicyTermKey%9=0 THEN 0 ELSE 1 END AS BoundIndicator,
 PrimaryDriverAge, PrimaryDriverGender, CAST(RetentionTier2_Calculated AS DOUBLE) AS RetentionTier2,
 CAST(RetentionTier2_Calculated AS DOUBLE) AS RetentionTier2_Calculated, VehicleYearNumber, SelectedBILimit_f,
 OptionalCoverageType AS OptionalCoverage_F, DownPaymentMonthsNumber AS DownPaymentsMonthNumber,
 Segment_F, PolicyTermKey%4 AS TermNumber
FROM fx_pm"""

SRC_RATING = f"""
SELECT PolicyTermKey AS JobID, VehicleTermKey AS VehicleFixedID,
 CASE WHEN VehicleTermKey%3=0 THEN '100/300' ELSE '25/50' END AS Limit_BI,
 CASE WHEN PrimaryDriverAge IS NULL THEN NULL ELSE PrimaryDriverAge-45 END AS AgeDifference,
 {_source_measures(("WP",))}
FROM fx_pm"""

SRC_RATING_SUP = """
SELECT PolicyTermKey AS JobID, VehicleTermKey AS VehicleFixedID, o_custkey AS QuoteID, o_orderkey AS QuoteVersionKey,
 CASE WHEN Segment_F='BUILDING' THEN 'None' ELSE Segment_F END AS PriorBILimit_F
FROM fx_pm JOIN orders ON PolicyTermKey=o_orderkey"""

SRC_DIM_QUOTE = """
SELECT o_orderkey AS QuoteVersionKey, o_orderdate AS QuoteVersionDateTime,
 CASE WHEN o_orderkey%3=0 THEN 'T' ELSE 'F' END AS LastQuoteVersionIndicator,
 CASE WHEN o_orderkey%4=0 THEN 'T' ELSE 'F' END AS QuoteVersionBoundIndicator
FROM orders"""

SRC_LOSS = """
SELECT VehicleTermKey, CAST(floor(VehicleTermKey/10) AS BIGINT) AS PolicyTermKey, ClaimNumber, TransactionDate,
 CoverageType, NetPaidClaims, NetCaseReserves, CatastropheKey
FROM fx_loss"""

# Multipliers by driver attributes: one row per combination that occurs.
SRC_ADJUSTMENT = """
SELECT DISTINCT PrimaryDriverAge AS PrimAge, PrimaryDriverGender AS PrimGen, PolicyStateCode_F AS State,
 CAST(0.9 + CAST(coalesce(PrimaryDriverAge,0)%5 AS DOUBLE)/20 AS DOUBLE) AS ADJ_WP_BI,
 CAST(1.1 AS DOUBLE) AS ADJ_WP_COL
FROM fx_pm WHERE PrimaryDriverAge IS NULL OR PrimaryDriverAge%4<>0"""

VIEWS = {
    "fx_term": FX_TERM,
    "fx_pm": FX_PM,
    "fx_loss": FX_LOSS,
    "fx_ibnr": FX_IBNR,
    "fx_quote": FX_QUOTE,
    "src_pm": SRC_PM,
    "src_reporting": SRC_REPORTING,
    "src_rating": SRC_RATING,
    "src_rating_sup": SRC_RATING_SUP,
    "src_dim_quote": SRC_DIM_QUOTE,
    "src_loss": SRC_LOSS,
    "src_adjustment": SRC_ADJUSTMENT,
}
_USES = {
    "fx_term": (), "fx_pm": ("fx_term",), "fx_loss": (), "fx_ibnr": ("fx_term",),
    "fx_quote": ("fx_pm",), "src_pm": ("fx_pm",), "src_reporting": ("fx_pm",),
    "src_rating": ("fx_pm",), "src_rating_sup": ("fx_pm",), "src_dim_quote": (),
    "src_loss": ("fx_loss",), "src_adjustment": ("fx_pm",),
}


def view_ctes(*names: str) -> list[str]:
    """``name AS (sql)`` for the views and whatever they are built on, in order."""
    needed: list[str] = []

    def add(name):
        for parent in _USES[name]:
            add(parent)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return [f"{name} AS ({VIEWS[name].strip()})" for name in needed]


# How Spark builds the views. Line items move once, by their order: what is grouped by order and line, joined with the order
# and counted by policy term stays where it is. Customers and nations are joined to the orders, of which there are fewer. Each
# view is built on its own, so that it carries its own columns only. Policy terms are counted before the premium is made from
# the price: the count carries no premium, a term that a run does not look at gets none, and an amount is made once, not in
# each of the three columns that hold it.
_BY_ORDER = {"fx_term", "fx_ibnr"}  # the views that group line items, and nothing but that
_LINE_BY_LINE = "FROM fx_term JOIN orders ON PolicyTermKey=o_orderkey JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey"
_ORDER_BY_ORDER = "FROM fx_term JOIN (orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey) ON PolicyTermKey=o_orderkey"
_VEHICLES = "count(*) OVER (PARTITION BY PolicyTermKey)"


_COUNTED = f"(SELECT *, {_VEHICLES} AS vehicles {_ORDER_BY_ORDER})"
_OF_A_TERM = ("VehicleTermKey, PolicyTermKey, pk, sk, ln, price, vehicles, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, "
              "n_name, c_mktsegment")


def _counted_first(view: str, counted: str) -> str:
    for name, amount in _AMOUNTS.items():
        view = view.replace(amount, name)
    amounts = ", ".join(f"{amount} AS {name}" for name, amount in _AMOUNTS.items())
    return view.replace(_VEHICLES, "vehicles").replace(_LINE_BY_LINE, f"FROM (SELECT *, {amounts} FROM {counted})")


def _tables(sf_dir: str, moved: bool) -> list[str]:
    hints = {"lineitem": "/*+ REPARTITION(l_orderkey) */ "} if moved else {}
    return [f"{t} AS (SELECT {hints.get(t, '')}* FROM parquet.`{sf_dir}/{t}.parquet`)" for t in BASE_TABLES]


def stored_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted policy terms with their orders, stored, for runs that read several views built from them."""
    ctes = ",\n".join([*_tables(sf_dir, True), *view_ctes("fx_term")])
    return Store.temporary(spark).write(spark.sql(f"WITH {ctes}\nSELECT {_OF_A_TERM} FROM {_COUNTED}"), "terms")[1]


def fixture(spark: SparkSession, sf_dir: str, name: str, terms: DataFrame | None = None) -> DataFrame:
    """One view; with ``terms``, those that ``stored_terms`` made, they are not made again for it."""
    views = view_ctes(name)
    moved = name not in _BY_ORDER and any(v.startswith("fx_term ") for v in views)
    ctes = [_counted_first(v, _COUNTED if terms is None else "{terms}") if _LINE_BY_LINE in v else v for v in views]
    given = {} if terms is None or not any("{terms}" in c for c in ctes) else {"terms": terms}
    return spark.sql("WITH " + ",\n".join(_tables(sf_dir, moved and not given) + ctes) + f"\nSELECT * FROM {name}", **given)


def stored_fixtures(spark: SparkSession, sf_dir: str, path: str) -> dict[str, DataFrame]:
    """All views as parquet under ``path``, each built from the stored views it uses."""
    for table in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)
    stored = {}
    for name, sql in VIEWS.items():
        spark.sql(sql).write.mode("overwrite").parquet(f"{path}/{name}")
        stored[name] = spark.read.parquet(f"{path}/{name}")
        stored[name].createOrReplaceTempView(name)
    for name in (*BASE_TABLES, *VIEWS):
        spark.catalog.dropTempView(name)
    return stored
