"""Reading the source tables and checking what they must contain."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from rateloom.coverages import IBNR_COVERAGES, PREMIUM_COVERAGES, named, source_column

# Columns the rules read. Those of the premium and the reporting table that they name without a table are
# looked for where both tables are at hand (``operators.extracts.ColumnOwners``).
REQUIRED_COLUMNS = {
    "PM": [
        "VehicleTermKey", "PolicyTermKey", "JobID", "VehicleFixedID", "PeriodStart", "PeriodEnd",
        "TransactionType", "BoundIndicator", *[source_column("WP", cov) for cov in PREMIUM_COVERAGES],
    ],
    "PM_Reporting": ["VehicleTermKey", "JobID", "VehicleFixedID", "PolicyStateCode_F", "BoundIndicator"],
    "TransactionLoss": [
        "VehicleTermKey", "ClaimNumber", "TransactionDate", "CoverageType", "NetPaidClaims",
        "NetCaseReserves", "CatastropheKey",
    ],
    "SummaryIBNR": ["VehicleTermKey", *named("IBNR", IBNR_COVERAGES)],
    "PCRating": [
        "JobID", "VehicleFixedID", *[source_column("WP", cov) for cov in PREMIUM_COVERAGES],
    ],
    "PCRatingSup": ["JobID", "VehicleFixedID", "QuoteID", "QuoteVersionKey"],
    "DimQuote": [
        "QuoteVersionKey", "QuoteVersionDateTime", "LastQuoteVersionIndicator",
        "QuoteVersionBoundIndicator",
    ],
}


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}")


def read_table(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """One source table, from the catalog or from a parquet folder, checked for its columns."""
    df = spark.read.parquet(location) if location else spark.table(name)
    contract = REQUIRED_COLUMNS.get(name.split(".")[-1])
    if contract:
        require_columns(df, contract, name)
    return df


def read_query(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple | None = None,
    partitions: int = 1,
    **options,
) -> DataFrame:
    """Result of a SQL text run by a database over JDBC.

    With a partition column the read is split into ``partitions`` ranges; the first and
    last range are open, so rows outside ``bounds`` are read too.
    """
    reader = spark.read.format("jdbc").option("url", url)
    if partition_column is None:
        reader = reader.option("query", query)
    else:
        low, high = bounds
        reader = reader.option("dbtable", f"({query}) q").options(
            partitionColumn=partition_column, lowerBound=low, upperBound=high, numPartitions=partitions
        )
    return reader.options(**options).load()
