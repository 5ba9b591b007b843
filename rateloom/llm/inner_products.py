"""Exact largest inner products, with candidates in order of length.

Candidates are cut into blocks by descending length. A query's threshold is its k-th best score among the longest
candidates; blocks whose greatest length times the query's own length stays below it are never opened. Inside a block
candidates run by descending length: once length times length is below the threshold, the query is done. Before that, a
rotation (the right singular vectors of a sample) puts most of a product into the first coordinates; what the rest can add
is at most the product of both rests' lengths (Cauchy-Schwarz), and only candidates whose bound reaches the threshold are
multiplied out, in the original whole numbers. The threshold rises as better candidates come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import map_batches, stored
from rateloom.llm.vectors import dealt, lengths, matrix, ranked, valid_vectors, with_length

SCALE = 64.0
#: Vectors that the rotation is found on; longest candidates that set the first thresholds.
SAMPLE_VECTORS, LONGEST = 8_000, 2_048
#: Candidates of a block, queries that meet a block in one task, candidates of a step, queries of a step.
BLOCK, QUERIES_AT_ONCE, STEP, TILE = 4_096, 2_048, 1_024, 256
#: Rotated coordinates of the partial product, as a share of all.
HEAD = 0.25
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


def floored(x: Column) -> Column:
    """The next whole number below, as a double of any size (``floor`` itself gives longs)."""
    near = F.rint(x)
    return F.when(near > x, near - 1.0).otherwise(near)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact as long as they fit into a long."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    if lengths(q).max() * lengths(x).max() < _EXACT:
        return (q @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in q], [[int(v) for v in row] for row in x]
    return np.array([[max(-_LONG, min(_LONG, sum(a * b for a, b in zip(r, c, strict=True)))) for c in whole[1]] for r in whole[0]], np.int64)


def rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors, the strongest first."""
    sample = sample / max(np.abs(sample).max(initial=0.0), 1e-300)
    return np.linalg.svd(sample.T @ sample)[0] if len(sample) else np.eye(sample.shape[1])


@np.errstate(over="ignore", invalid="ignore")
def block_search(ids: np.ndarray, x: np.ndarray, who: np.ndarray, q: np.ndarray, floor: np.ndarray, turn: np.ndarray, k: int):
    """(query, candidate, score) for every query's k best in the block that reach its threshold.

    Bounds beyond a double's range are infinite or undefined; such candidates are multiplied out.
    """
    head = max(1, int(HEAD * x.shape[1]))
    length = lengths(x)
    order = np.argsort(-length, kind="stable")
    ids, x, length = ids[order], x[order], length[order]
    turned, asked, own = x @ turn, q @ turn, lengths(q)
    rest, open_rest = lengths(turned[:, head:]), lengths(asked[:, head:])
    top = np.full((len(q), k), -np.inf)
    limit = floor.copy()
    slack = 1e-9 * (1 + own * (length[0] if len(length) else 0))
    found = []
    for a in range(0, len(x), STEP):
        going = np.flatnonzero(~(own * length[a] < limit - slack))
        if not len(going):
            break
        b = min(len(x), a + STEP)
        bound = asked[going, :head] @ turned[a:b, :head].T + np.outer(open_rest[going], rest[a:b])
        maybe = ~(bound < (limit - slack)[going, None]) & (ids[None, a:b] != who[going, None])
        rows, columns = np.nonzero(maybe)
        if not len(rows):
            continue
        if len(rows) * 8 < maybe.size and own.max() * length[0] < _EXACT:
            scores = np.einsum("ij,ij->i", q[going[rows]], x[a + columns]).astype(np.int64)
        else:
            scores = products(q[going], x[a:b])[rows, columns]
        good = scores >= limit[going[rows]]
        rows, columns, scores = rows[good], columns[good], scores[good]
        found.append((going[rows], a + columns, scores))
        block = np.full((len(going), b - a), -np.inf)
        block[rows, columns] = scores
        top[going] = np.partition(np.hstack([top[going], block]), b - a, axis=1)[:, b - a:]
        limit = np.maximum(limit, top.min(1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    rows, columns, scores = (np.concatenate(c) for c in zip(*found, strict=True))
    good = scores >= limit[rows]
    rows, columns, scores = rows[good], columns[good], scores[good]
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    nth = np.arange(len(rows)) - np.repeat(starts, np.diff(np.append(starts, len(rows))))
    keep = nth < k
    return who[rows[keep]], ids[columns[keep]], scores[keep]


def largest_products(df: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding",
                     scale: float = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest inner products of whole numbers floor(scale * x), exactly.

    Queries are the rows for which ``is_query(vec_id)`` holds; all other rows are candidates. Missing vectors, those that
    hold missing, infinite or undefined numbers (also after scaling) and rows without an id take no part; rows with one
    id all do, but not with each other; shorter vectors, also empty ones, end in zeros. Equal scores are ranked by id. Scores beyond
    a long's range are set to its end.

    Blocks hold equal numbers of candidates by length; where many have one length, a block is dealt to several tasks.
    """
    spark = df.sparkSession
    vectors = valid_vectors(df, id_column, vector_column, k, lambda x: floored(x * scale))
    vectors = stored(with_length(vectors), "whole")
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not shape["n"]:
        return empty
    width, n = max(1, shape["width"]), shape["n"]
    share = int((1 << 20) * min(1.0, SAMPLE_VECTORS / n)) + 1
    got = vectors.where(dealt("vec_id", "vector", 1 << 20) < share).limit(2 * SAMPLE_VECTORS).toArrow()
    order = np.argsort(np.asarray(got.column("vec_id")))
    turn = rotation(matrix(got.column("vector"), width)[order])
    steps = min(1000, -(-n // BLOCK))
    cuts = vectors.agg(F.percentile_approx("length", [i / steps for i in range(1, steps)], 10_000).alias("cuts")).first()["cuts"] if steps > 1 else []
    cuts = np.unique(np.array(cuts or [], np.float64))
    first = vectors.orderBy(F.col("length").desc(), "vec_id").limit(LONGEST).toArrow()
    first_ids, first_x = np.asarray(first.column("vec_id")), matrix(first.column("vector"), width)
    queries = vectors.where(is_query(F.col("vec_id")))
    blocks = max(1, -(-queries.count() // QUERIES_AT_ONCE))

    bucket = F.lit(0)
    for cut in cuts.tolist() if len(cuts) <= 16 else []:
        bucket = bucket + F.when(F.col("length") > cut, 1).otherwise(0)
    if len(cuts) > 16:
        bucket = F.size(F.filter(F.array(*map(F.lit, cuts.tolist())), lambda c: c < F.col("length")))
    placed = vectors.withColumn("bucket", bucket.cast("int"))
    sizes = placed.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"), F.max("length").alias("longest"))
    bounds = {r["bucket"]: (r["parts"], r["longest"]) for r in sizes.collect()}  # a row for every block, 1000 at most

    def asked(batches):
        for batch in batches:
            ids, q = np.asarray(batch.column(0)), matrix(batch.column(1), width)
            own = lengths(q)
            scores = products(q, first_x).astype(np.float64)
            scores[ids[:, None] == first_ids[None, :]] = -np.inf
            floor = np.partition(scores, -k, axis=1)[:, -k] if scores.shape[1] > k else np.full(len(q), -np.inf)
            for bucket, (parts, longest) in bounds.items():
                with np.errstate(over="ignore", invalid="ignore"):
                    open_ones = np.flatnonzero(~(own * longest * (1 + 1e-9) < floor))
                for part in range(parts):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(open_ones), bucket, np.int32)), pa.array(np.full(len(open_ones), part, np.int32)),
                         pa.array(ids[open_ones]), pa.array(floor[open_ones]), batch.column(1).take(pa.array(open_ones))],
                        names=["bucket", "part", "query_id", "floor", "query"])

    right = map_batches(queries.select("vec_id", "vector"), asked, "bucket int, part int, query_id long, floor double, query array<double>", 1024)
    right = right.withColumn("block", dealt("query_id", "query", blocks))
    left = placed.join(sizes.select("bucket", "parts"), "bucket").select(
        "bucket", dealt("vec_id", "vector", F.col("parts")).alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "vector")

    def meet(some: pa.Table, asking: pa.Table) -> pa.Table:
        ids, x = np.asarray(some.column("vec_id")), matrix(some.column("vector"), width)
        out = []
        for a in range(0, asking.num_rows if len(ids) else 0, TILE):
            part = asking.slice(a, TILE)
            out.append(block_search(ids, x, np.asarray(part.column("query_id")), matrix(part.column("query"), width),
                                    np.asarray(part.column("floor")), turn, k))
        merged = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), (pa.array(m, pa.int64()) for m in merged), strict=True)))

    keys = ["bucket", "part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
    return ranked(found, k)
