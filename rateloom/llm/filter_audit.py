"""How five filters act on each other: what every order of them keeps and removes at every step, by part of the corpus.

A document's outcomes in all orders depend only on the mask of filters it fails. Every mask stands for one wide integer with a
field for each of the 600 steps (120 orders of 5); a field holds five lanes: kept, removed, failing but removed before, and good
and toxic ones lost. Adding these integers counts all steps at once. The integers are summed per part within the tasks, then over
them, and unpacked in the end. A lane has 48 bits and adds at most 1 for a document, so no lane runs over below 2^48 documents
of a part; the topmost field, which counts them, has no bound and is checked.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import map_batches, stored

FILTERS = "ABCDE"
LANES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
ORDERS = ["".join(o) for o in permutations(FILTERS)]
LANE_BYTES = 6
STEPS = len(ORDERS) * len(FILTERS)
#: Lanes: those of the steps, then one per filter for documents that fail it alone, then the number of documents.
ALONE, TOTAL = STEPS * len(LANES), STEPS * len(LANES) + len(FILTERS)
#: Sums of parts that a task holds before it sends them on; slices in which a part's sums are added first.
PARTS_AT_ONCE, SLICES = 1000, 64
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, "
          "toxic_lost long, shapley long")
_DUPLICATE = 1 << FILTERS.index("E")
_UPPER = bytes(range(65, 91))
_SIGNS = re.compile(rb"[#$%&*|]")


def failed(text: bytes) -> int:
    """Bits of the filters A to D that a text (UTF-8) fails."""
    words = text.split()
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text) if text.isascii() else len(text.decode())
    return ((len(words) < 200) | (100 * len(set(words)) < 50 * len(words)) << 1 | (100 * upper > 2 * points) << 2
            | (_SIGNS.search(text) is not None) << 3)


@cache
def outcomes(mask: int, good: bool, toxic: bool) -> int:
    """The wide integer of one document: 1 in each lane that counts it."""
    lanes = np.zeros(TOTAL + 1, np.uint8)
    for o, order in enumerate(ORDERS):
        gone = False
        for s, letter in enumerate(order):
            at, fails = (o * len(FILTERS) + s) * len(LANES), bool(mask >> FILTERS.index(letter) & 1)
            removed = fails and not gone
            gone = gone or fails
            lanes[at:at + len(LANES)] = not gone, removed, fails and not removed, removed and good, removed and toxic
    for k in range(len(FILTERS)):
        lanes[ALONE + k] = mask == 1 << k
    lanes[TOTAL] = 1
    wide = np.zeros((len(lanes), LANE_BYTES), np.uint8)
    wide[:, 0] = lanes
    return int.from_bytes(wide.tobytes(), "little")


def unpacked(total: int) -> np.ndarray:
    """All lanes of a sum, as long integers."""
    if total >> (8 * LANE_BYTES * TOTAL) >= 1 << 8 * LANE_BYTES:
        raise OverflowError("more documents in a part than a lane can count")
    lanes = np.zeros((TOTAL + 1, 8), np.uint8)
    lanes[:, :LANE_BYTES] = np.frombuffer(total.to_bytes((TOTAL + 1) * LANE_BYTES, "little"), np.uint8).reshape(-1, LANE_BYTES)
    return lanes.reshape(-1).view("<i8")


def _packed(sums: dict[tuple, int]) -> pa.RecordBatch:
    size = [(v.bit_length() + 7) // 8 for v in sums.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array([p for p, _ in sums], pa.string()), pa.array([s for _, s in sums], pa.int32()),
         pa.array([v.to_bytes(n, "little") for v, n in zip(sums.values(), size, strict=True)], pa.binary())], names=["part", "slice", "sum"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (part, mask, good, toxic, n) to sums of their integers."""
    sums: dict[tuple, int] = {}
    for batch in batches:
        for part, mask, good, toxic, n, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            sums[part, piece] = sums.get((part, piece), 0) + n * outcomes(mask, good, toxic)
            if len(sums) >= PARTS_AT_ONCE:
                yield _packed(sums)
                sums = {}
    if sums:
        yield _packed(sums)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of equal (part, slice), which stand together, to one."""
    sums: dict[tuple, int] = {}
    for batch in batches:
        for part, piece, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (part, piece) not in sums and len(sums) >= 100:
                yield _packed(sums)
                sums = {}
            sums[part, piece] = sums.get((part, piece), 0) + int.from_bytes(total, "little")
    if sums:
        yield _packed(sums)


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """600 rows for each part."""
    orders = [o for o in ORDERS for _ in FILTERS]
    steps = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))
    letters = np.array([FILTERS.index(x) for o in ORDERS for x in o])
    for batch in _merge(batches):
        for part, _, total in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            lanes = unpacked(int.from_bytes(total, "little"))
            fields = dict(zip(LANES, lanes[:ALONE].reshape(-1, len(LANES)).T, strict=True))
            shapley = np.array([fields["removed"][letters == k].sum() for k in range(len(FILTERS))])
            columns = {"part": [part] * STEPS, "filter_order": orders, "step": steps, **{k: fields[k] for k in LANES[:3]},
                       "unique_fails": lanes[ALONE:TOTAL][letters], "good_lost": fields["good_lost"], "toxic_lost": fields["toxic_lost"],
                       "shapley": shapley[letters]}
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def masks(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """part, mask, good, toxic, n: how many documents of a part fail just these filters, in pieces that add up.

    E compares texts by their SHA-256. Copies are added up before they meet, so a text that very many rows have is a few rows
    for each part; nothing is joined on it.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
                 pa.array([failed(t) for t in texts], pa.int32())], names=["doc_id", "part", "digest", "mask"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(part_column).cast("string"), F.lit("")).alias("part"),
                     F.col(text_column).cast("string").cast("binary").alias("text"))
    rows = map_batches(rows, judge, "doc_id long, part string, digest binary, mask int")
    rows = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic"))
    marks = marks.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    # rows without an id find no label; the spread keeps them from meeting in one task
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(F.lit(0)).alias("spread")
    rows = rows.withColumn("spread", spread).join(marks.withColumn("spread", F.lit(0).cast("long")), ["doc_id", "spread"], "left").select(
        "doc_id", "part", "digest", "mask", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    texts = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.coalesce(F.min_by("n", "doc_id"), F.lit(0)).alias("at_least"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("unnamed"))
    texts = stored(texts, "audited-texts")  # read twice; few bytes for each text
    least = texts.groupBy("digest").agg(F.min("least").alias("first"), F.count(F.lit(1)).alias("many"))
    least = least.where("many > 1").select("digest", "first")
    texts = texts.join(least, "digest", "left")
    passing = F.col("unnamed") + F.when(F.coalesce("first", "least") == F.col("least"), F.col("at_least")).otherwise(F.lit(0))
    texts = texts.withColumn("passing", passing)
    both = F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")),
                   F.struct((F.col("mask") + _DUPLICATE).alias("mask"), (F.col("n") - F.col("passing")).alias("n")))
    return texts.select("part", "good", "toxic", F.inline(both)).where("n > 0").select("part", "mask", "good", "toxic", "n")


def audit_filters(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_column: str = "source") -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A: under 200 words; B: fewer than half of them distinct; C: over 2% of the characters in A-Z; D: one of ``#$%&*|``; E: the
    text of a smaller id. Missing texts are empty, a missing part is the empty string. A row without an id has no smaller one and
    no label; rows of one id and text are no copies of each other. Of repeated labels any that is 1 counts. An empty table
    gives no rows.
    """
    rows = masks(df, labels, id_column, text_column, part_column)
    rows = rows.withColumn("slice", F.pmod(F.spark_partition_id(), F.lit(SLICES)).cast("int"))
    sums = map_batches(rows, _add, "part string, slice int, sum binary", 5000)
    sums = map_batches(sums.repartition("part", "slice").sortWithinPartitions("part", "slice"), _merge, "part string, slice int, sum binary")
    sums = sums.withColumn("slice", F.lit(0))
    return map_batches(sums.repartition("part").sortWithinPartitions("part"), _report, SCHEMA)
