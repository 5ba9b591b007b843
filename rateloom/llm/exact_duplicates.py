"""Exact duplicates by deterministic block naming, with DataFrame functions only.

A text, with A-Z lower-cased, is cut into blocks of 2,048 bytes. Equal blocks get one integer as name, by their place in a sort;
then adjacent names are taken as pairs, and pairs named in the same way, until every document has one name. Names stand for
contents, not for hashes of them: two texts are equal exactly if their numbers of blocks and their last names are equal.

Blocks are dealt to buckets by a hash, and a name is made of the bucket and the rank of the block among the bucket's distinct
ones, so the texts move in one shuffle and the names need no second look-up. A block or pair that very many rows have would
fill its bucket; the most frequent ones (4,096 at most, so that no other has more than that part of all rows) are counted first,
named apart in a small table that is broadcast, and their rows are spread. The counts decide on the way only.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rateloom.llm.shared import stored

BLOCK_BYTES = 2048
#: Keys that are handled apart: at most so many, and only those with so many rows.
HOT_KEYS, HOT_ROWS = 4096, 1000
#: Buckets, and bits of a name for the rank in its bucket.
BUCKETS, RANK_BITS = 1 << 20, 40


def normalised(text):
    """The text with A-Z lower-cased and nothing else changed; a missing one is empty."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.octet_length(text) == F.char_length(text)  # ASCII only, where lower() does just that, and faster
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def _blocks(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """place (of the row), pos, blocks, block; doc_id and text_sha256 stand with the first block of a row."""
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.col(id_column).cast("long").alias("doc_id"),
                     normalised(F.col(text_column)).cast("binary").alias("bytes"))
    rows = rows.withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.octet_length("bytes") / BLOCK_BYTES)).cast("int"))
    rows = rows.withColumn("pos", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    first = F.col("pos") == 0
    return rows.select("place", "pos", "blocks", F.when(first, F.col("doc_id")).alias("doc_id"),
                       F.when(first, F.sha2("bytes", 256)).alias("text_sha256"),
                       F.substring("bytes", F.col("pos") * BLOCK_BYTES + 1, F.lit(BLOCK_BYTES)).alias("block"))


def _hot_names(rows: DataFrame, keys: list[str]) -> DataFrame | None:
    """Names below 0 for the keys that very many rows have; None if there are none."""
    hashed = F.xxhash64(*keys)
    counts = rows.groupBy(hashed.alias("hash")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= HOT_ROWS)
    most = [r["hash"] for r in counts.orderBy(F.desc("n"), "hash").limit(HOT_KEYS).collect()]
    if not most:
        return None
    hashes = rows.sparkSession.createDataFrame([(h,) for h in most], "hash long")
    found = rows.withColumn("hash", hashed).join(F.broadcast(hashes), "hash").select(*keys).distinct()
    rank = F.row_number().over(Window.orderBy(*keys))  # one small table: HOT_KEYS hashes
    return stored(found.select(*(F.col(k).alias(f"hot_{k}") for k in keys), (-rank).cast("long").alias("hot_name")), "hot-names")


def named(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows with ``name`` in place of the keys: equal for equal keys and different for different ones, never 0."""
    hot = _hot_names(rows, keys)
    if hot is None:
        rows = rows.withColumn("hot_name", F.lit(None).cast("long"))
    else:
        same = [F.col(k) == F.col(f"hot_{k}") for k in keys]
        rows = rows.join(F.broadcast(hot), same, "left").drop(*(f"hot_{k}" for k in keys))
    cold = F.col("hot_name").isNull()
    bucket = F.when(cold, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))).otherwise(
        BUCKETS + F.pmod(F.xxhash64("place", "pos"), F.lit(BUCKETS)))
    rows = rows.select(*(c for c in rows.columns if c not in keys), bucket.alias("bucket"), *(F.when(cold, F.col(k)).alias(k) for k in keys))
    rank = F.dense_rank().over(Window.partitionBy("bucket").orderBy(*keys)).cast("long")
    name = F.coalesce("hot_name", F.shiftleft("bucket", RANK_BITS) + rank)
    return rows.withColumn("name", name).drop("hot_name", "bucket", *keys)


def _identities(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """place, doc_id, text_sha256, blocks, name per row, stored: equal texts have equal (blocks, name), others don't."""
    first = stored(named(_blocks(df, id_column, text_column), ["block"]), "block-names")
    level = first.select("place", "pos", "blocks", F.col("blocks").alias("left"), "name")
    done = [level.where("left = 1")]
    most = first.agg(F.max("blocks")).first()[0] or 1
    while most > 1:
        odd = F.col("pos") % 2 == 1
        pairs = level.where("left > 1").groupBy("place", F.shiftright("pos", 1).alias("half")).agg(
            F.max("blocks").alias("blocks"), F.max("left").alias("left"), F.max(F.when(~odd, F.col("name"))).alias("one"),
            F.coalesce(F.max(F.when(odd, F.col("name"))), F.lit(0)).alias("two"))  # 0: the last name has no neighbour
        pairs = pairs.select("place", F.col("half").alias("pos"), "blocks", F.ceil(F.col("left") / 2).cast("int").alias("left"), "one", "two")
        level = stored(named(pairs, ["one", "two"]), "pair-names")
        done.append(level.where("left = 1"))
        most = -(-most // 2)
    last = done[0]
    for some in done[1:]:
        last = last.unionByName(some)
    documents = first.where("pos = 0").select("place", "doc_id", "text_sha256")
    return stored(last.select("place", "blocks", "name").join(documents, "place"), "identities")


def exact_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (of the normalised text).

    Texts are equal when they are identical after lower-casing A-Z; a missing text is empty. Of equal texts the row with the
    largest id stays, a missing id counting as the smallest; of several such rows one stays. A group of rows without ids has no
    ``keep_id``. An empty table gives no rows. ``df`` must give its rows in the same order when a task is run again, as
    stored tables do.
    """
    rows = _identities(df, id_column, text_column)
    groups = rows.groupBy("blocks", "name").agg(
        F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keep_id"),
        F.coalesce(F.max_by("place", "doc_id"), F.max("place")).alias("stays")).where("n > 1")
    groups = stored(groups, "duplicate-groups")
    # groups of very many rows are looked up in a broadcast table, and their rows spread where the others are joined
    large = groups.where(F.col("n") >= HOT_ROWS).orderBy(F.desc("n"), "blocks", "name").limit(HOT_KEYS)
    hot = large.select("blocks", "name", F.struct("n", "keep_id", "stays").alias("hot"))
    rows = rows.join(F.broadcast(hot), ["blocks", "name"], "left")
    known = F.col("hot").isNotNull()
    rows = rows.select("place", "doc_id", "text_sha256", "hot", F.when(known, F.lit(-1)).otherwise(F.col("blocks")).alias("blocks"),
                       F.when(known, F.col("place")).otherwise(F.col("name")).alias("name"))
    rows = rows.join(groups.select("blocks", "name", F.struct("n", "keep_id", "stays").alias("group")), ["blocks", "name"], "left")
    group = F.coalesce("hot", "group")
    return rows.select("doc_id", F.when(group.isNull(), F.col("doc_id")).otherwise(group["keep_id"]).alias("keep_id"),
                       F.coalesce(group["n"], F.lit(1)).cast("long").alias("group_size"),
                       F.coalesce(group["stays"] == F.col("place"), F.lit(True)).alias("kept"), "text_sha256")
