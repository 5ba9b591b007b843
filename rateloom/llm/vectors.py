"""Vectors as rows of numbers, for the two searches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def valid_vectors(df: DataFrame, id_column: str, vector_column: str, k: int, change=None) -> DataFrame:
    """vec_id, vector (doubles) of rows that have an id and a vector of finite numbers, after ``change`` of each number.

    Rows with the same id all stay. Of rows that are the same in id and vector k stay at most: more can't be among the k best.
    """
    vector = F.col(vector_column).cast("array<double>")
    if change is not None:
        vector = F.transform(vector, change)
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", finite))
    copies = rows.groupBy("vec_id", "vector").agg(F.least(F.count(F.lit(1)), F.lit(k)).cast("int").alias("copies"))
    return copies.select("vec_id", "vector", F.explode(F.sequence(F.lit(1), "copies")).alias("copy")).drop("copy")


def with_length(df: DataFrame) -> DataFrame:
    """The rows with their vector's length; numbers are divided by the largest first, so that no square leaves a double's
    range. A length beyond the range is its end."""
    rows = df.withColumn("most", F.array_max(F.transform("vector", F.abs)))  # a column of its own: found once, not for every number
    squares = F.aggregate("vector", F.lit(0.0), lambda a, x: a + (x / F.col("most")) * (x / F.col("most")))
    length = F.when(F.col("most") > 0, F.least(F.col("most") * F.sqrt(squares), F.lit(1.7e308))).otherwise(F.lit(0.0))
    return rows.withColumn("length", length).drop("most")


def lengths(x: np.ndarray) -> np.ndarray:
    """The same for the rows of a matrix."""
    most = np.abs(x).max(1, initial=0.0)
    with np.errstate(over="ignore"):
        return np.minimum(most * np.sqrt(((x / np.where(most > 0, most, 1.0)[:, None]) ** 2).sum(1)), 1.7e308)


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """List values as rows of a matrix; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths(), np.int64)
    flat = np.asarray(column.flatten(), np.float64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(lengths), width))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def dealt(id_column: str, vector_column: str, parts: Column | int) -> Column:
    """A part for each row, by id and vector, so that many rows of one id go to several."""
    return F.pmod(F.xxhash64(id_column, vector_column), F.lit(parts) if isinstance(parts, int) else parts).cast("int")


def ranked(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to the smaller id. Every found pair of rows counts."""
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at_least = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= at_least)
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((ids[places], -scores[places]))][:k]
