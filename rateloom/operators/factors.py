"""Attaching rating factors and premium adjustments."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW_WEIGHT = "RowWeight"

# Attributes an adjustment table is keyed by.
ADJUSTMENT_KEY = ("PrimAge", "PrimGen", "State", "YearsLic", "YNPMainVehicle", "YNP_Group")


def attach_factors(base: DataFrame, factors: DataFrame, key: str | list[str] = "VehicleTermKey", how: str = "inner") -> DataFrame:
    """Base rows that have factors, with them; all base rows with ``how="left"``. Meant for a key that is unique in ``factors``."""
    _require_new_names(base, factors, key)
    return base.join(factors, key, how)


def _require_new_names(base: DataFrame, factors: DataFrame, key) -> None:
    keys = [key] if isinstance(key, str) else list(key)
    taken = [c for c in factors.columns if c in base.columns and c not in keys]
    if taken:
        raise ValueError(f"the base already has the factor columns {taken}")


def folded_factors(factors: DataFrame, key: str | list[str] = "RowKey", columns: list[str] | None = None) -> DataFrame:
    """Distinct factor combinations per key, with the number of rows each stands for."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = [c for c in (factors.columns if columns is None else columns) if c not in keys]
    return factors.groupBy(*keys, *columns).agg(F.count(F.lit(1)).alias(ROW_WEIGHT))


def attach_factors_by_job(quotes: DataFrame, factors: DataFrame, columns: list[str],
                          key: str | list[str] = "RowKey") -> DataFrame:
    """Quoted vehicles with the factors of every vehicle of the same job.

    Both sides hold a row per vehicle while the key is the job, so a job of V vehicles
    has V x V pairs. Equal factor rows of a job are folded into one with a RowWeight, so
    those pairs are counted and not written out; the summary multiplies by the weight.
    """
    folded = folded_factors(factors, key, columns)
    _require_new_names(quotes, folded, key)
    return quotes.join(folded, key, "inner")


#: Adjustments up to so many rows are broadcast: some 20 numbers a row, so a few tens of megabytes.
BROADCAST_ROWS = 100_000
#: Attribute tuples that hold more than this part of all rows are spread; there are at most as many of them as it says.
HOT_PART = 200


def attach_adjustments(base: DataFrame, adjustments: DataFrame, key=ADJUSTMENT_KEY, broadcast_rows: int = BROADCAST_ROWS,
                       spread: int = 64) -> DataFrame:
    """All base rows, with the ADJ_WP_* multipliers of their attributes where there are any.

    Missing attributes match missing attributes. The adjustments' rows are counted, no further than the limit: a table
    within it is broadcast. A larger one is joined by shuffling on attributes, of which a few tuples may hold most
    rows; the base's tuples are counted, and the rows of those few dealt over ``spread`` copies of their adjustments.
    """
    added = [c for c in adjustments.columns if c not in key]
    right = adjustments.select(*[F.col(k).alias(f"_adj_{k}") for k in key], *added)
    same = [F.col(k).eqNullSafe(F.col(f"_adj_{k}")) for k in key]
    if adjustments.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return base.join(F.broadcast(right), reduce(and_, same), "left").select(*base.columns, *added)

    counts = base.groupBy(*key).agg(F.count(F.lit(1)).alias("_rows"))
    rows = counts.agg(F.sum("_rows")).first()[0] or 0
    hot = counts.where(F.col("_rows") > rows / HOT_PART).select(*[F.col(k).alias(f"_adj_{k}") for k in key], F.lit(True).alias("_hot"))
    hot = F.broadcast(base.sparkSession.createDataFrame(hot.collect(), hot.schema))  # at most HOT_PART rows
    left = base.join(hot, reduce(and_, same), "left").select(
        *base.columns, F.when(F.col("_hot"), F.pmod(F.xxhash64(*base.columns), F.lit(spread))).otherwise(0).alias("_part"))
    names = hot.drop("_hot")
    for k in key:
        names = names.withColumnRenamed(f"_adj_{k}", f"_hot_{k}")
    of_hot = reduce(and_, [F.col(f"_adj_{k}").eqNullSafe(F.col(f"_hot_{k}")) for k in key])
    names = names.withColumn("_hot", F.lit(True))
    copies = F.when(F.col("_hot"), F.lit(spread)).otherwise(1)
    right = right.join(F.broadcast(names), of_hot, "left").withColumn(
        "_adj_part", F.explode(F.sequence(F.lit(0).cast("long"), copies.cast("long") - 1)))
    same.append(F.col("_part") == F.col("_adj_part"))
    return left.join(right.select(*[f"_adj_{k}" for k in key], *added, "_adj_part"), reduce(and_, same), "left").select(*base.columns, *added)
