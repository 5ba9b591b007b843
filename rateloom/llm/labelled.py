"""Bounded samples of labelled rows, for the classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import fold


def labelled_rows(df: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, id_column: str = "doc_id") -> DataFrame:
    """The rows with a label of 0 or 1 outside the held-out fold, with the label as ``label``.

    A document labelled more than once counts as 1 if any of its labels is 1; rows without an id have no label.
    """
    known = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(id_column).cast("long").alias("labelled")).agg(
        F.max(label).cast("int").alias("label"))
    known = known.where(F.crc32(F.col("labelled").cast("string").cast("binary")) % folds != held_out)
    return df.join(known, df[id_column] == known["labelled"]).drop("labelled")


def sampled(rows: DataFrame, id_column: str, most: int, counted: DataFrame) -> DataFrame:
    """About ``most`` rows at the utmost, chosen by a hash of the id.

    ``counted`` are the same rows, perhaps in a form that is cheaper to count. Who collects the rows sets a firm limit.
    """
    n = counted.count()
    if n <= most:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.col(id_column), F.lit("sample")), F.lit(1 << 20)) < int((1 << 20) * most / n))
