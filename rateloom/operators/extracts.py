"""The source extracts: premium, losses, IBNR, quotes and rating factors.

Each one is a lazy DataFrame; filters and the column list reach the scans.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.coverages import IBNR_COVERAGES, PREMIUM_COVERAGES, named, source_column
from rateloom.functions.recode import catastrophe_coverage, channel, transaction_type
from rateloom.sources.tables import require_columns

HISTORY_START = date(2015, 1, 1)
VEHICLE_KEY = ["JobID", "VehicleFixedID"]

# Columns of the premium extract and their names there, those of the premium table first. The others stand
# without a table's name in the rules: they belong to whichever of the two tables has them.
_PM_RENAMES = {
    "PolicyTermKey": "PolicyTermKey",
    "VehicleTermKey": "VehicleTermKey",
    "PolicyNumber": "OrigCorePolicyNumber",
    "PeriodStart": "PolicyTermStartEffDate",
    "PeriodEnd": "PolicyTermExpirationEffDate",
    "state": "PolicyStateCode",
    "JobID": "TransactionJobID",
    "VehicleFixedID": "SourceSystemVehicleID",
}
_FREE_RENAMES = {
    "TermType": "TermType",
    "UpdateTime": "TransactionDateTime",
    "CancelReason_F": "CancelReason_F",
    "CancellationDate": "CancellationDate",
    "Retained6Months": "Retained6Months",
    "Retained12Months": "Retained12Months",
    "FinanceChannel_F": "FinanceChannel_F",
    "VehicleCount": "VehicleCount",
    "PrimaryDriverAge": "PrimaryDriverAge",
    "PrimaryDriverGender": "PrimaryDriverGender",
    "RetentionTier2": "RetentionTierProb",
    "RetentionTier2_Calculated": "RetentionTier2_Calculated",
    "VehicleYearNumber": "VehicleYearNumber",
    "SelectedBILimit_f": "SelectedBILimit_f",
    "OptionalCoverage_F": "OptionalCoverageType",
    "DownPaymentsMonthNumber": "DownPaymentMonthsNumber",
}
# What the rules need of them.
_FREE_REQUIRED = ("TermType", "CancelReason_F", "CancellationDate", "MaxLoadDate", "Retained6Months", "FinanceChannel_F", "VehicleCount")


class ColumnOwners:
    """Finds the table that a column without a table's name belongs to, by the schemas, ignoring case.

    A column that several of the tables have is an error as soon as it is asked for, as it would be in SQL.
    """

    def __init__(self, **tables: DataFrame):
        self.columns = {alias: {c.lower() for c in df.columns} for alias, df in tables.items()}

    def find(self, column: str) -> str | None:
        """``alias.column``, or None where no table has it."""
        having = [alias for alias, columns in self.columns.items() if column.lower() in columns]
        if len(having) > 1:
            raise ValueError(f"column {column} is ambiguous: {' and '.join(having)} have it")
        return f"{having[0]}.{column}" if having else None

    def of(self, column: str) -> str:
        """``alias.column``; raises where no table has it."""
        found = self.find(column)
        if found is None:
            raise ValueError(f"none of {', '.join(self.columns)} has the column {column}")
        return found

    def require(self, columns: Sequence[str]) -> None:
        missing = [c for c in columns if self.find(c) is None]
        if missing:
            raise ValueError(f"none of {', '.join(self.columns)} has the columns {missing}")


def _only_within(rows: DataFrame, condition: str, names: dict[str, str], kept: Sequence[str]) -> DataFrame:
    """The same rows; where ``condition`` doesn't hold, only the ``kept`` columns have values. ``names`` are further names of columns.

    A row without its amounts takes little room where it moves or is stored, and is still there to be counted.
    """
    present, kept = {c.lower() for c in rows.columns}, {c.lower() for c in kept}
    further = {name: F.col(source) for source, name in names.items() if source.lower() in present and name.lower() not in present}
    marked = rows.withColumns(further).withColumn("_within", F.expr(condition))
    return marked.select(*[F.col(c) if c.lower() in kept else F.when(F.col("_within"), F.col(c)).alias(c) for c in rows.columns])


def premium_extract(pm: DataFrame, reporting: DataFrame, history_start: date | str = HISTORY_START, wanted: str = "true") -> DataFrame:
    """Bound vehicle-terms with reporting attributes, coverages under their own codes.

    Columns that the rules name without a table are taken from the one that has them (``ColumnOwners``). Rows that are not
    ``wanted``, a condition on the key, the start and the expiry of the term, come with these, the earned date and what the
    reporting table has, but without amounts.
    """
    owners = ColumnOwners(pm=pm, pf=reporting)
    owners.require(_FREE_REQUIRED)
    free = {owners.find(source): name for source, name in _FREE_RENAMES.items()}
    present = {c.lower() for c in pm.columns}
    columns = [f"pm.{source} AS {name}" for source, name in _PM_RENAMES.items() if source.lower() in present]
    columns += [f"{source} AS {name}" for source, name in free.items() if source]
    if "policynumber" in present:
        columns.append("pm.PolicyNumber AS CorePolicyNumber")
    written = [f"pm.{source_column('WP', cov)}" for cov in PREMIUM_COVERAGES]
    columns += [
        "pf.PolicyStateCode_F AS PolicyStateCode_F",
        "year(pm.PeriodStart) AS UWYear",
        "pm.TransactionType AS TransactionType",
        f"{owners.of('MaxLoadDate')} AS EarnedAsOfDate",
        f"{owners.of('MaxLoadDate')} AS RetainedAsOfDate",
        f"{' + '.join(written)} AS WP_Total",
        "0 AS WE_TOTAL",
        f"coalesce({owners.of('EP_TOTAL')}, 0) AS EP_TOTAL",
    ]
    for cov, wp in zip(PREMIUM_COVERAGES, written):
        columns += [
            f"{wp} AS WP_{cov}",
            f"IF({owners.of(source_column('WP', cov))} > 0, 1, 0) AS WE_{cov}",
            f"coalesce({owners.of(source_column('EP', cov))}, 0) AS EP_{cov}",
            f"{owners.of(source_column('CLEP', cov))} AS CLEP_{cov}",
            f"{owners.of(source_column('EE', cov))} AS EE_{cov}",
        ]
    bound = (F.col("BoundIndicator") == 1) & (F.col("PeriodStart") >= F.lit(history_start).cast("date"))
    rows = pm.where(bound)
    if wanted != "true":
        rows = _only_within(rows, wanted, _PM_RENAMES, ("VehicleTermKey", "PeriodStart", "PeriodEnd", "MaxLoadDate"))
    joined = rows.alias("pm").join(
        reporting.alias("pf"), F.col("pm.VehicleTermKey") == F.col("pf.VehicleTermKey")
    )
    return joined.selectExpr(*columns).withColumn("TransactionType", transaction_type(F.col("TransactionType")))


# Columns of the claim extract.
LOSS_COLUMNS = (
    "VehicleTermKey", "PolicyTermKey", "OrigCorePolicyNumber", "CorePolicyNumber",
    "CurrentCorePolicyNumber", "PolicyTermStartEffDate", "PolicyTermExpirationEffDate",
    "VehicleIdentificationNumber", "VehicleMakeName", "VehicleModelName", "ClaimNumber",
    "ExposureID", "SourceSystemTransactionNumber", "LossDate", "TransactionDate", "FiCalDate",
    "CoverageType", "NetPaidClaims", "NetCaseReserves", "Payment", "Reserve", "RecoveryReserve",
    "Salvage", "Subrogation", "CatastropheKey",
)


def loss_extract(transactions: DataFrame) -> DataFrame:
    """Claim transactions, catastrophe claims under comprehensive set apart."""
    coverage = catastrophe_coverage(F.col("CoverageType"), F.col("CatastropheKey"))
    return transactions.selectExpr(
        *[c for c in LOSS_COLUMNS if c in transactions.columns]
    ).withColumn("CoverageType", coverage)


def ibnr_extract(summary_ibnr: DataFrame) -> DataFrame:
    """IBNR per vehicle-term."""
    optional = ("PolicyTermKey", "MonthAgeDateKey", "IBNR_TOTAL")
    columns = ["VehicleTermKey", *[c for c in optional if c in summary_ibnr.columns]]
    if "PeriodStart" in summary_ibnr.columns:
        columns.append("PeriodStart AS PolicyTermStartEffDate")
    return summary_ibnr.selectExpr(*columns, *named("IBNR", IBNR_COVERAGES))


def kept_quote_versions(quotes: DataFrame, history_start: date | str = HISTORY_START,
                        when: str = "QuoteVersionDateTime") -> DataFrame:
    """The last version of a quote and any bound version, from ``history_start`` on."""
    return quotes.where(
        (F.col(when) >= F.lit(history_start).cast("date"))
        & ((F.col("LastQuoteVersionIndicator") == "T") | (F.col("QuoteVersionBoundIndicator") == "T"))
    )


def _versions_by_vehicle(rating_sup: DataFrame, dim_quote: DataFrame, history_start, extra=()) -> DataFrame:
    # The quote dimension has a row per quote version, so it grows with the quotes and is
    # not hinted for broadcast; filtered first, it thins out the widest joins that follow.
    versions = kept_quote_versions(dim_quote, history_start).select("QuoteVersionKey", "QuoteVersionDateTime")
    return rating_sup.select(*VEHICLE_KEY, "QuoteID", "QuoteVersionKey", *extra).join(versions, "QuoteVersionKey")


_FACTOR = "factor_"  # before the names of factors among the columns of quoted vehicles


def quoted_vehicles(
    reporting: DataFrame,
    rating: DataFrame,
    rating_sup: DataFrame,
    dim_quote: DataFrame,
    quoted_from: date | str = HISTORY_START,
    factors: Sequence[str | Factor] = (),
) -> DataFrame:
    """Vehicles with a kept quote version from ``quoted_from`` on, what they were quoted, and rating factors.

    The quote extract and the quote factors both start from these rows, so where both are wanted the rows can be stored
    once; either alone reads only its own columns.
    """
    columns = _factor_columns(reporting, rating, rating_sup, factors)
    written = [F.col(source_column("WP", cov)).alias(f"WP_{cov}") for cov in PREMIUM_COVERAGES]
    reported = [c for c in ("FinanceChannel_F", "VehicleCount") if c in reporting.columns]
    return (
        _versions_by_vehicle(rating_sup, dim_quote, quoted_from, columns["supplement"])
        .join(rating.select(*VEHICLE_KEY, *written, *columns["rating"]), VEHICLE_KEY)
        .join(reporting.select(*VEHICLE_KEY, "BoundIndicator", *reported, *columns["reporting"]), VEHICLE_KEY)
    )


def amounts_within(vehicles: DataFrame, quoted: str) -> DataFrame:
    """``quoted_vehicles`` with amounts where ``quoted`` holds, a condition on QuoteVersionDate; all of them, with their factors."""
    kept = ["QuoteVersionDateTime", "BoundIndicator", *VEHICLE_KEY, *[c for c in vehicles.columns if c.startswith(_FACTOR)]]
    return _only_within(vehicles, quoted, {"QuoteVersionDateTime": "QuoteVersionDate"}, kept)


def quotes_of(vehicles: DataFrame, pm: DataFrame, history_start: date | str = HISTORY_START) -> DataFrame:
    """The quote extract from ``quoted_vehicles`` and the premium table."""
    return (
        vehicles.where(F.col("QuoteVersionDateTime") >= F.lit(history_start).cast("date"))
        .join(pm.selectExpr(*VEHICLE_KEY, "state", "year(PeriodStart) AS UWYear"), VEHICLE_KEY)
        .withColumn("FinanceChannel", channel(F.col("FinanceChannel_F")))
        .selectExpr(
            "JobID AS RowKey",
            "state AS PolicyStateCode",
            "FinanceChannel",
            "QuoteID",
            "VehicleFixedID AS VehicleKey",
            "QuoteVersionDateTime AS QuoteVersionDate",
            "UWYear",
            "VehicleCount",
            *named("WP"),
        )
    )


def factors_of(vehicles: DataFrame, factors: Sequence[str | Factor], constants: dict[str, object] | None = None,
               quoted_from: date | str = HISTORY_START) -> DataFrame:
    """The quote factors from ``quoted_vehicles`` that were made with these factors."""
    fixed = [F.lit(value).alias(name) for name, value in (constants or {}).items()]
    unbound = (F.col("BoundIndicator") == 0) & (F.col("QuoteVersionDateTime") >= F.lit(quoted_from).cast("date"))
    return vehicles.where(unbound).select(
        F.col("JobID").alias("RowKey"), F.col("VehicleFixedID").alias("VehicleKey"),
        *[F.col(_FACTOR + name).alias(name) for name in factor_names(factors)], *fixed,
    )


def quote_extract(
    pm: DataFrame,
    reporting: DataFrame,
    rating: DataFrame,
    rating_sup: DataFrame,
    dim_quote: DataFrame,
    history_start: date | str = HISTORY_START,
) -> DataFrame:
    """Quoted vehicles with their quote version, channel and quoted premium per coverage."""
    return quotes_of(quoted_vehicles(reporting, rating, rating_sup, dim_quote, history_start), pm, history_start)


@dataclass(frozen=True)
class Factor:
    """A rating factor: its name, an expression over one rating table, and that table's name.

    The expression is SQL text, or a function of a column such as ``band``, applied to the column ``source``. Without an
    expression it is the column of that name; without an owner, the one table that has the column.
    """

    name: str
    expression: str | Callable[[Column], Column] | None = None
    owner: str | None = None
    source: str | None = None

    @property
    def column(self) -> Column:
        if callable(self.expression):
            return self.expression(F.col(self.source or self.name))
        return F.expr(self.expression or f"`{self.name}`")


def factor_names(factors: Sequence[str | Factor]) -> list[str]:
    return [f.name if isinstance(f, Factor) else f for f in factors]


def _factor_columns(reporting: DataFrame, rating: DataFrame, rating_sup: DataFrame, factors) -> dict[str, list[Column]]:
    """The chosen factors by the table that has them, named as columns of their own."""
    owners = {"reporting": reporting, "rating": rating, "supplement": rating_sup}
    factors = [f if isinstance(f, Factor) else Factor(f) for f in factors]
    unowned = [f.name for f in factors if f.owner not in owners and (f.owner or (f.expression and not f.source))]
    if unowned:
        raise ValueError(f"factors need one of {list(owners)} as owner: {unowned}")
    found = {f.name: [f.owner] if f.owner else [name for name, df in owners.items() if (f.source or f.name) in df.columns] for f in factors}
    missing = [f for f, names in found.items() if not names]
    if missing:
        raise ValueError(f"no rating table has the factors {missing}")
    ambiguous = {f: names for f, names in found.items() if len(names) > 1}
    if ambiguous:
        raise ValueError(f"factors in more than one rating table: {ambiguous}; name their owner")
    return {name: [f.column.alias(_FACTOR + f.name) for f in factors if found[f.name] == [name]] for name in owners}


def premium_factors(
    reporting: DataFrame, rating: DataFrame, rating_sup: DataFrame, factors: Sequence[str | Factor]
) -> DataFrame:
    """Rating factors of bound vehicle-terms, keyed by VehicleTermKey."""
    columns = _factor_columns(reporting, rating, rating_sup, factors)
    rows = (
        reporting.where(F.col("BoundIndicator") == 1).select("VehicleTermKey", *VEHICLE_KEY, *columns["reporting"])
        .join(rating.select(*VEHICLE_KEY, *columns["rating"]), VEHICLE_KEY)
        .join(rating_sup.select(*VEHICLE_KEY, *columns["supplement"]), VEHICLE_KEY)
    )
    return rows.select("VehicleTermKey", *[F.col(_FACTOR + name).alias(name) for name in factor_names(factors)])


def quote_factors(
    reporting: DataFrame,
    rating: DataFrame,
    rating_sup: DataFrame,
    dim_quote: DataFrame,
    factors: Sequence[str | Factor],
    constants: dict[str, object] | None = None,
    quoted_from: date | str = HISTORY_START,
) -> DataFrame:
    """Rating factors of unbound quoted vehicles, keyed by RowKey and VehicleKey.

    ``constants`` stands in for factors that quotes do not have.
    """
    unbound = reporting.where(F.col("BoundIndicator") == 0)
    vehicles = quoted_vehicles(unbound, rating, rating_sup, dim_quote, quoted_from, factors)
    return factors_of(vehicles, factors, constants, quoted_from)


def standardise_premium(premium: DataFrame) -> DataFrame:
    """Premium rows that already carry coverage codes: relabel submissions, fill earned premium."""
    earned = ["EP_TOTAL", *named("EP")]
    rest = [c for c in premium.columns if c not in earned and c != "TransactionType"]
    return premium.withColumn("TransactionType", transaction_type(F.col("TransactionType"))).selectExpr(
        *rest, "TransactionType", *[f"coalesce({c}, 0) AS {c}" for c in earned]
    )


def standardise_quotes(quotes: DataFrame, raw_channel: str = "FinanceChannel_F") -> DataFrame:
    require_columns(quotes, [raw_channel, "QuoteVersionDate", "VehicleCount", *named("WP")], "quotes")
    return quotes.withColumn("FinanceChannel", channel(F.col(raw_channel)))
