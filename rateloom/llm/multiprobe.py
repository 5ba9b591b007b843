"""Largest inner products by multiprobe p-stable hashing.

Vectors are scaled to length 1 at most and lifted onto the unit sphere by one more coordinate, so that a large inner product
with a query is a small distance to it. Each table cuts m random projections into slabs of equal width; a vector's bucket are
its slabs. A query visits, in each table, its own bucket and then neighbouring ones (one slab up or down in some projections)
in the order of their estimated success: the expected squared distance to the slabs' borders, which depends only on the
borders' order by distance. What the tables find is merged, and scored exactly on the original vectors.

Buckets may miss: where lengths are skewed, the one longest vector crowds the rest round a pole. Queries that meet fewer than
k vectors of a part score that part whole, and where all probes together miss the wanted recall on the sample, all queries do.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import lists, map_batches, stored
from rateloom.llm.vectors import best, dealt, lengths, matrix, ranked, valid_vectors, with_length

TABLES, PROJECTIONS, WIDTH = 6, 8, 1.5
#: How many buckets a table's visit may take, tried in this order on the sample until it reaches the recall.
PROBES = (16, 32, 64, 128, 256, 512, 1024, 2048, 4096)
SAMPLE_VECTORS, SAMPLE_QUERIES, RECALL = 4_000, 200, 0.95
#: Vectors and queries that meet in one task, and queries that it looks at together.
VECTORS_AT_ONCE, QUERIES_AT_ONCE, TILE = 16_384, 16_384, 128
_BASE = 64


def probe_order(projections: int, most: int) -> np.ndarray:
    """Sets of steps in the order of their expected score, a row each: which of the 2m nearest borders are crossed.

    Borders are numbered by distance. No set crosses both borders of one projection, that is j and 2m - 1 - j.
    """
    m = projections
    j = np.arange(1, m + 1)
    near = j * (j + 1) / (4 * (m + 1) * (m + 2))
    i = np.arange(m + 1, 2 * m + 1)
    far = 1 - (2 * m + 1 - i) / (m + 1) + (2 * m + 1 - i) * (2 * m + 2 - i) / (4 * (m + 1) * (m + 2))
    cost = np.concatenate([near, far])
    out, heap = [()], [(cost[0], (0,))]
    while heap and len(out) < most:
        score, steps = heapq.heappop(heap)
        if not any(2 * m - 1 - s in steps for s in steps):
            out.append(steps)
        if (last := steps[-1]) + 1 < 2 * m:
            heapq.heappush(heap, (score - cost[last] + cost[last + 1], (*steps[:-1], last + 1)))
            heapq.heappush(heap, (score + cost[last + 1], (*steps, last + 1)))
    table = np.zeros((len(out), 2 * m))
    for row, steps in enumerate(out):
        table[row, list(steps)] = 1
    return table


@dataclass
class ProbeIndex:
    directions: np.ndarray  # (table, coordinate, projection)
    shifts: np.ndarray  # (table, projection)
    longest: float
    probes: int
    sample_recall: float = 0.0
    exact: bool = True  # the wanted recall was not reached, or not measured: buckets are not relied on

    @property
    def width(self) -> int:
        return self.directions.shape[1] - 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        x = x / self.longest
        return np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(1)))[:, None]])

    def slabs(self, table: int, points: np.ndarray) -> np.ndarray:
        return (points @ self.directions[table] + self.shifts[table]) / WIDTH

    @staticmethod
    def codes(slabs: np.ndarray) -> np.ndarray:
        """A number for each bucket; far-out slabs are taken together."""
        inside = np.clip(slabs, 2 - _BASE // 2, _BASE // 2 - 3) + _BASE // 2
        return inside @ (float(_BASE) ** np.arange(slabs.shape[1]))

    def visits(self, table: int, queries: np.ndarray, order: np.ndarray) -> np.ndarray:
        """Bucket numbers that each query visits, a column a query, in their order."""
        unit = queries / lengths(queries)[:, None]
        place = self.slabs(table, np.hstack([unit, np.zeros((len(unit), 1))]))
        floor = np.clip(np.floor(place), 2 - _BASE // 2, _BASE // 2 - 3)
        below = place - floor
        distance = np.hstack([below, 1 - below])
        step = np.hstack([np.tile(-(float(_BASE) ** np.arange(place.shape[1])), (len(unit), 1)),
                          np.tile(float(_BASE) ** np.arange(place.shape[1]), (len(unit), 1))])
        by_distance = np.argsort(distance, axis=1, kind="stable")
        return order @ np.take_along_axis(step, by_distance, 1).T + self.codes(floor)


def _visited(buckets: np.ndarray, of_vector: np.ndarray, visits: np.ndarray) -> np.ndarray:
    """Which vectors (columns) each query (rows) meets in a table, given its distinct buckets and which of them a vector has."""
    at = np.minimum(np.searchsorted(buckets, visits), len(buckets) - 1)
    hit = np.zeros((visits.shape[1], len(buckets)), bool)
    t, q = np.nonzero(buckets[at] == visits)
    hit[q, at[t, q]] = True
    return hit[:, of_vector]


def fit(vectors: DataFrame, k: int, recall: float = RECALL, seed: int = 7) -> ProbeIndex | None:
    """Directions, and the number of probes that reaches the recall on a bounded sample of the vectors; None without any.

    ``exact`` is set where none reaches it.
    """
    shape = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("width"), F.max("length").alias("longest")).first()
    if not shape["n"]:
        return None
    share = min(1.0, SAMPLE_VECTORS / shape["n"])
    got = vectors.where(dealt("vec_id", "vector", 1 << 20) < int(share * (1 << 20)) + 1).limit(2 * SAMPLE_VECTORS).toArrow()
    ids, x = np.asarray(got.column("vec_id")), matrix(got.column("vector"), shape["width"])
    order = np.lexsort((*x.T, ids))
    ids, x = ids[order], x[order]
    rng = np.random.default_rng(seed)
    index = ProbeIndex(rng.normal(size=(TABLES, shape["width"] + 1, PROJECTIONS)), rng.uniform(0, WIDTH, (TABLES, PROJECTIONS)),
                       shape["longest"], PROBES[-1])
    if len(x) < 2:
        return index
    asked = np.sort(rng.permutation(len(x))[:SAMPLE_QUERIES])
    with np.errstate(over="ignore", invalid="ignore"):
        scores = x[asked] @ x.T
    scores[ids[asked][:, None] == ids[None, :]] = -np.inf
    wanted = np.argpartition(-scores, min(k, len(x) - 1) - 1, axis=1)[:, :min(k, len(x) - 1)]
    others = np.take_along_axis(scores, wanted, 1) > -np.inf
    if not others.any():
        return index
    tables = [np.unique(index.codes(np.floor(index.slabs(t, index.lifted(x)))), return_inverse=True) for t in range(TABLES)]
    table = probe_order(PROJECTIONS, PROBES[-1])
    for index.probes in PROBES:
        met = np.zeros(scores.shape, bool)
        for t in range(TABLES):
            met |= _visited(*tables[t], index.visits(t, x[asked], table[:index.probes]))
        index.sample_recall = float(np.take_along_axis(met, wanted, 1)[others].mean())
        if index.sample_recall >= recall:
            index.exact = False
            break
    return index


def nearest(df: DataFrame, is_query, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: each query's k largest inner products among all other vectors that it finds, k rows
    wherever there are as many others.

    Queries are the rows for which ``is_query(vec_id)`` holds. Missing and zero vectors, those holding missing, infinite or
    undefined numbers, and rows without an id take no part; rows with one id all do, but not with each other; shorter vectors end
    in zeros. Equal scores are ranked by id. Every vector is in the index; only the number of probes is fitted on a sample.

    Vectors carry their bucket of every table. They are dealt to parts of bounded size by a hash of id and vector, the queries to
    blocks, and each block meets each part in a task. What the tables find is merged there, so a vector that several tables
    find is scored once, and copies or clusters, which fill a bucket, burden no task more than others. A query that meets
    fewer than k vectors of a part scores all of the part; all queries do if the sample's recall stays too low.
    """
    spark = df.sparkSession
    vectors = stored(with_length(valid_vectors(df, id_column, vector_column, k)).where("length > 0"), "vectors")
    index = fit(vectors, k)
    if index is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    queries = vectors.where(is_query(F.col("vec_id"))).select(F.col("vec_id").alias("query_id"), F.col("vector").alias("query"))
    parts, blocks = (max(1, -(-rows.count() // most)) for rows, most in ((vectors, VECTORS_AT_ONCE), (queries, QUERIES_AT_ONCE)))
    order = probe_order(PROJECTIONS, index.probes)
    width = index.width

    def hashed(batches):
        for batch in batches:
            points = index.lifted(matrix(batch.column(1), width))
            codes = np.stack([index.codes(np.floor(index.slabs(t, points))) for t in range(TABLES)], 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, lists(codes.reshape(-1), np.full(len(points), TABLES), pa.float64())],
                                             names=["vec_id", "vector", "codes"])

    def every(number: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(number - 1)))

    indexed = stored(map_batches(vectors.select("vec_id", "vector"), hashed, "vec_id long, vector array<double>, codes array<double>", 4096), "buckets")
    left = indexed.select(dealt("vec_id", "vector", parts).alias("part"), every(blocks).alias("block"), "vec_id", "vector", "codes")
    right = queries.select(every(parts).alias("part"), dealt("query_id", "query", blocks).alias("block"), "query_id", "query")

    def meet(some: pa.Table, asking: pa.Table) -> pa.Table:
        ids, x = np.asarray(some.column("vec_id")), matrix(some.column("vector"), width)
        tables = [np.unique(codes, return_inverse=True) for codes in matrix(some.column("codes"), TABLES).T]
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for a in range(0, asking.num_rows if len(ids) else 0, TILE):
            part = asking.slice(a, TILE)
            who, q = np.asarray(part.column("query_id")), matrix(part.column("query"), width)
            met = np.full((len(who), len(ids)), index.exact)
            for t in range(0 if index.exact else TABLES):
                met |= _visited(*tables[t], index.visits(t, q, order))
            met[(met & (ids[None, :] != who[:, None])).sum(1) < k] = True
            some_met = np.flatnonzero(met.any(0))
            with np.errstate(over="ignore", invalid="ignore"):
                rough = q @ x[some_met].T
            for row, name in enumerate(who):
                of_met = np.flatnonzero(met[row, some_met] & (ids[some_met] != name))
                if len(of_met) > k and np.isfinite(rough[row, of_met]).all():  # a margin for the order of addition
                    s = rough[row, of_met]
                    of_met = of_met[s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9 * (1 + np.abs(s).max())]
                if len(of_met):
                    places = some_met[of_met]
                    exact = (x[places] * q[row]).sum(1)
                    top = best(exact, ids[places], k)
                    out.append((np.full(len(top), name), ids[places[top]], exact[top]))
        merged = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
        return pa.table({"query_id": pa.array(merged[0], pa.int64()), "vec_id": pa.array(merged[1], pa.int64()), "score": pa.array(merged[2], pa.float64())})

    keys = ["part", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score double")
    return ranked(found, k)
