"""Shards by jump consistent hashing: no ring table, and a new shard takes rows only into itself."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.shared import ship_package, stored

#: The key of rows without an id.
MISSING_KEY = -1


def jump_shards(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each key, all keys at once: one turn of the loop for each jump that any key still makes."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    state = np.asarray(keys).astype(np.int64).view(np.uint64).copy()
    at = np.zeros(len(state), np.int64)
    target = np.zeros(len(state), np.int64)
    going = np.arange(len(state))
    while len(going):
        at[going] = target[going]
        with np.errstate(over="ignore"):
            state[going] = state[going] * np.uint64(2862933555777941757) + np.uint64(1)
        step = (state[going] >> np.uint64(33)).astype(np.float64) + 1.0
        target[going] = ((at[going] + 1) * (2147483648.0 / step)).astype(np.int64)
        going = going[target[going] < shards]
    return at


def jump_shard(key: Column, shards: int) -> Column:
    """The shard of a stable integer key as a column."""

    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_shards(keys.to_numpy(np.int64), shards).astype(np.int32))

    return shard(F.coalesce(key.cast("long"), F.lit(MISSING_KEY)))


def shard_documents(df: DataFrame, shards: int = 8, id_column: str = "doc_id", text_column: str = "text",
                    cells: int = 1024) -> DataFrame:
    """Per row: doc_id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.

    ``key`` law: id and number of shards decide, so reruns and other texts change no shard; rows without an id share key -1.
    Slots also depend on the rows' order in the input, as rows with one id may be very many.
    ``grown_shard`` is the shard among one more. Missing texts have size 1 and the crc32 of an empty text. Repeated rows
    share a shard and have slots of their own; an empty table gives no rows.

    Slots run from 0 within a shard, without gaps. Each shard's rows fall into ``cells`` cells by a hash of the row and
    of its place in the input, so also a repeated id fills all cells; slots are cell offsets plus places inside a cell,
    and no task holds a whole shard.
    """
    ship_package(df.sparkSession)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), (F.octet_length(text).cast("long") + 1).alias("size"),
                     F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("place"))
    rows = rows.select(
        "doc_id", "size", "text_crc32", jump_shard(F.col("doc_id"), shards).alias("shard"),
        jump_shard(F.col("doc_id"), shards + 1).alias("grown_shard"),
        F.pmod(F.xxhash64("doc_id", "text_crc32", "place"), F.lit(cells)).cast("int").alias("cell"))
    rows = stored(rows, "shards")
    counts = rows.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_crc32", "size")) - 1
    return rows.withColumn("inside", inside).join(offsets, ["shard", "cell"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("offset") + F.col("inside")).alias("slot"), "grown_shard")
