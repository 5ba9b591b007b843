"""Near duplicates: an exact n-gram Jaccard join by a token-group matrix, and its connected components.

Texts with the same set of word shingles form a class; classes are compared, by these steps:

1. *Groups.* Classes that share a least shingle under one of some hash functions compare themselves with the first class
   that has it; verified links join them. Classes with the same first class go into the same group, a block of bounded size;
   many that are joined already get blocks of their own. Classes left alone that share the least of their first tokens with
   enough others are grouped by it.
2. *Matrix.* Tokens are ordered, those that few documents have first. A group's row cells are the union of its members'
   first tokens, about a quarter of each set, without those that one document has: each cell holds the range of sizes and
   of components of the members that have the token.
3. *Bound.* Of two linked sets, all shared tokens up to the end of one's first tokens are cells of both; what is behind them
   is too short for the threshold by itself. So a pair of groups (or a group with itself) must share a number of cells that
   follows from the sizes. Shared cells are added up per pair, in each part of the matrix and then by a keyed sum, and only
   pairs that reach the number qualify. Cells whose members are all joined already don't count.
4. *Open.* For a qualifying pair the overlap of every member with the other group's whole token union bounds its overlap with
   any member of that group. Only members that reach the threshold are compared, exactly, by one product of the two groups'
   token matrices; what comes out are links that join the members, not all pairs.

Rows travel as packed arrays of token hashes. Exact copies are counted once; groups with many members are dealt to blocks.
The order of tokens is a hint only: it is made of a bounded list of the most frequent tokens, and any order gives the same
links. Token sets are made of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import held, map_batches, mix64, stored

WORDS, PERCENT = 5, 75
#: Hash functions for the groups; most frequent tokens that order the others; members of a group, and how many joined ones
#: get groups of their own; columns of a token matrix that are multiplied at once.
KEYS, FREQUENT, BLOCK, OWN_GROUPS, COLUMNS = 4, 1 << 20, 1024, 256, 8192
#: Lone classes with a first token in common that make a group; tokens of all classes for each part of the matrix, which has
#: 2 ** PART_BITS parts at least.
TOGETHER, PART_TOKENS, PART_BITS = 16, 1 << 21, 11
#: Tokens that are counted before they leave a task, and bits of the filters of wanted texts and of tokens counted twice.
COUNTED_AT_ONCE, FILTER_BITS, TWICE_BITS = 2_000_000, 1 << 25, 1 << 28
#: Words whose hashes a worker keeps.
REMEMBERED_WORDS = 250_000
#: Pairs of matrix cells that are looked at in one go.
PAIRS_AT_ONCE = 1_000_000
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], np.uint64)
_SHIFT = np.uint64(21)  # a token's number in counts: its upper 43 bits, 11 of them for the part
_HALF = np.uint64(1 << 63)  # tokens below are counted
_PART_BITS = TWICE_BITS >> 10  # counted tokens have 1024 parts


class _WordHashes(dict):
    """64-bit hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """The hashes of each text's distinct shingles, ascending. A shorter text is one shingle; without words there is none."""
    found = [(t or "").encode().lower().split() for t in texts]
    counts = np.array([len(f) for f in found], np.int64)
    hashes = held("near_duplicates", "words", _WordHashes)
    h = np.fromiter(map(hashes.__getitem__, chain.from_iterable(found)), np.uint64, int(counts.sum()))
    total = np.full(len(h), np.uint64(words))
    with np.errstate(over="ignore"):
        for k in range(words):
            total[:len(h) - k] += h[k:] * (_ODD[k % len(_ODD)] * np.uint64(2 * (k // len(_ODD)) + 1))
        total = mix64(total)
        out = []
        for first, n in zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
            if n >= words:
                s = np.sort(total[first:first + n - words + 1])
                out.append(s if (s[1:] > s[:-1]).all() else np.unique(s))
            else:
                short = np.uint64(n)
                for k in range(n):
                    short += h[first + k] * (_ODD[k % len(_ODD)] * np.uint64(2 * (k // len(_ODD)) + 1))
                out.append(mix64(np.array([short])) if n else np.zeros(0, np.uint64))
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def _packed(parts: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, list[list[bytes]]]:
    """Ascending parts, and every column's bytes for each part."""
    heads = np.flatnonzero(np.concatenate([[True], parts[1:] != parts[:-1]])) if len(parts) else np.zeros(0, np.int64)
    ends = np.append(heads[1:], len(parts))
    return parts[heads], [[c[a:b].tobytes() for a, b in zip(heads, ends, strict=True)] for c in columns]


def _sketches(df: DataFrame, id_column: str, text_column: str, words: int) -> DataFrame:
    """Rows of two kinds, stored. kind 0, a document: place, doc_id, text_hash, n, set_a, set_b (hashes of the whole set) and
    keys. kind 1: part, tokens and in how many documents of the task they are."""
    text = F.col(text_column).cast("string")
    rows = df.select(F.monotonically_increasing_id().alias("place"), F.col(id_column).cast("long").alias("doc_id"),
                     F.xxhash64(text).alias("text_hash"), text.alias("text"))
    names = ["kind", "place", "doc_id", "text_hash", "n", "set_a", "set_b", "keys", "part", "tokens", "counts"]
    seeds = mix64(np.arange(KEYS, dtype=np.uint64) + np.uint64(77)) | np.uint64(1)

    def counted(tokens: list[np.ndarray]) -> pa.RecordBatch:
        numbers, counts = np.unique(np.concatenate(tokens) >> _SHIFT, return_counts=True)
        parts, (low, n) = _packed((numbers >> np.uint64(32)).astype(np.int32), numbers.astype(np.uint32), np.minimum(counts, 0xFFFFFFFF).astype(np.uint32))
        m = len(parts)
        empty = [pa.nulls(m, pa.int64()) for _ in range(6)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.ones(m, np.int32)), *empty, pa.nulls(m, pa.list_(pa.int64())), pa.array(parts), pa.array(low, pa.binary()),
             pa.array(n, pa.binary())], names=names)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            sets = shingle_sets(batch.column(3).to_pylist(), words)
            with np.errstate(over="ignore"):
                a = np.array([mix64(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                b = np.array([np.bitwise_xor.reduce(mix64(s ^ _ODD[1])) for s in sets], np.uint64)
                keys = [_signed(np.array([(s * k).min() for k in seeds])).tolist() if len(s) else [] for s in sets]
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(m, np.int32)), batch.column(0), batch.column(1), batch.column(2), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(_signed(a)), pa.array(_signed(b)), pa.array(keys, pa.list_(pa.int64())), pa.nulls(m, pa.int32()),
                 pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary())], names=names)
            for s in sets:
                waiting.append(low := s[:np.searchsorted(s, _HALF)])
                held += len(low)
                if held > COUNTED_AT_ONCE:
                    yield counted(waiting)
                    waiting, held = [], 0
        if held:
            yield counted(waiting)

    schema = ("kind int, place long, doc_id long, text_hash long, n long, set_a long, set_b long, keys array<long>, part int, "
              "tokens binary, counts binary")
    return stored(map_batches(rows, sketch, schema), "sketches")


def _frequent(sketches: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[int, bytes]]:
    """Numbers of the most frequent counted tokens, ascending, and the order of their count: FREQUENT tokens at most. And a
    bit array of fixed size with a mark for every token that is counted at least twice, by parts, compressed: TWICE_BITS at
    most when tokens fill it.

    All counts are added up; the least count that is listed is chosen so that the list keeps its size.
    """
    counts = sketches.where("kind = 1").select("part", "tokens", "counts")

    def add_up(some: pa.Table) -> pa.Table:
        part = some.column("part")[0].as_py()
        tokens = np.concatenate([np.frombuffer(t, np.uint32) for t in some.column("tokens").to_pylist()])
        n = np.concatenate([np.frombuffer(t, np.uint32) for t in some.column("counts").to_pylist()])
        distinct, inverse = np.unique(tokens, return_inverse=True)
        order = np.log2(np.bincount(inverse, n)).astype(np.uint8)
        often = order > 0
        marks = np.zeros(_PART_BITS, bool)
        marks[distinct[often] % _PART_BITS] = True
        return pa.table({"part": pa.array([part], pa.int32()), "marks": pa.array([pa.compress(np.packbits(marks).tobytes(), codec="zstd", asbytes=True)], pa.binary()), "tokens": pa.array([distinct[often].tobytes()], pa.binary()),
                         "orders": pa.array([order[often].tobytes()], pa.binary()),
                         "sizes": pa.array([np.bincount(order[often], minlength=64).tolist()], pa.list_(pa.int64()))})

    totals = stored(counts.groupBy("part").applyInArrow(add_up, "part int, marks binary, tokens binary, orders binary, sizes array<long>"), "frequent")
    sizes = {r["o"]: r["n"] for r in totals.select(F.posexplode("sizes").alias("o", "n")).groupBy("o").agg(F.sum("n").alias("n")).collect()}
    least, listed = 64, 0
    while least > 1 and listed + (sizes.get(least - 1) or 0) <= FREQUENT:
        least -= 1
        listed += sizes.get(least) or 0

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for tokens, orders in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                o = np.frombuffer(orders, np.uint8)
                out.append((np.frombuffer(tokens, np.uint32)[o >= least].tobytes(), o[o >= least].tobytes()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in out], pa.binary()), pa.array([x for _, x in out], pa.binary())],
                                             names=["part", "tokens", "orders"])

    got = map_batches(totals.select("part", "tokens", "orders"), cut, "part int, tokens binary, orders binary").toArrow().to_pylist()
    got.sort(key=lambda r: r["part"])
    numbers = [np.frombuffer(r["tokens"], np.uint32).astype(np.int64) + (r["part"] << 32) for r in got]
    orders = [np.frombuffer(r["orders"], np.uint8) for r in got]
    twice = {r["part"]: bytes(r["marks"]) for r in totals.select("part", "marks").toLocalIterator()}
    return np.concatenate([np.zeros(0, np.int64), *numbers]), np.concatenate([np.zeros(0, np.uint8), *orders]), twice


def _marks(twice: dict[int, bytes]) -> np.ndarray:
    """The bit array of tokens counted twice."""
    marks = np.zeros((1024, _PART_BITS // 8), np.uint8)
    for part, packed in twice.items():
        marks[part] = np.frombuffer(pa.decompress(packed, _PART_BITS // 8, codec="zstd"), np.uint8)
    return marks.reshape(-1)


def first_tokens(tokens: np.ndarray, numbers: np.ndarray, orders: np.ndarray, twice: np.ndarray, percent: int) -> np.ndarray:
    """A set's first tokens: those counted once, then unlisted ones, then frequent ones by the order of their
    count, each by hash; uncounted ones last. So many that a linked set must share one of its own first tokens with them.
    Those counted once, which nobody shares, are left out again."""
    own = (tokens >> _SHIFT).astype(np.int64)
    order = np.full(len(own), 255, np.uint8)
    known = own[:np.searchsorted(tokens, _HALF)]
    place = (known >> 32) * _PART_BITS + (known & 0xFFFFFFFF) % _PART_BITS
    again = (twice[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
    order[:len(known)] = again
    if len(numbers) and len(known):
        at = np.minimum(np.searchsorted(numbers, known), len(numbers) - 1)
        listed = numbers[at] == known
        order[:len(known)][listed] = orders[at[listed]] + 1
    length = len(own) - -(-percent * len(own) // 100) + 1
    first = np.argsort(order, kind="stable")[:length]
    return tokens[first[order[first] > 0]]


def cells_needed(small: np.ndarray, large: np.ndarray, percent: int) -> np.ndarray:
    """How many first tokens two linked sets of these sizes share at least, smaller one first. Never more for a smaller
    ``small`` or a larger ``large``, so the ends of ranges of sizes give a bound for all sizes in them.

    Sets of sizes s <= l share p(s + l) / (100 + p) tokens at least, and fewer than p * l / 100 of them come after the end of
    the first tokens of the one whose first tokens end first.
    """
    return np.maximum(percent * (100 * small - percent * large) // (100 * (100 + percent)) + 1, 1)


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of ascending distinct tokens."""
    least, most = sorted((len(x), len(y)))
    if 100 * least < percent * most:
        return False
    both = len(x) + len(y) - len(np.union1d(x, y)) if len(x) + len(y) < 64 else int(np.isin(x, y, assume_unique=True, kind="sort").sum())
    return both * (100 + percent) >= percent * (len(x) + len(y))


def _wanted_filter(wanted: DataFrame) -> np.ndarray:
    """A bit array of fixed size in which all wanted (doc_id, text_hash) are marked."""
    place = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(FILTER_BITS))
    word = wanted.select(place.alias("place")).selectExpr("place div 64 AS word", "shiftleft(1L, cast(place % 64 AS int)) AS bit")
    got = word.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.uint64)
    bits[np.asarray(got.column("word"))] = np.asarray(got.column("bits"), np.int64).view(np.uint64)
    return bits


def _texts(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.col(text_column).cast("string")
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    return rows.withColumn("place", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(FILTER_BITS)))


def _token_sets(texts: DataFrame, wanted: DataFrame, words: int, name: str) -> DataFrame:
    """tokens (packed) of the wanted (doc_id, text_hash, more), with what else they hold, stored. Texts don't leave the scan:
    those the filter knows are made into sets there."""
    bits = _wanted_filter(wanted)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = np.asarray(batch.column(3))
            hit = np.flatnonzero((bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1))
            some = batch.take(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [some.column(0), some.column(1), pa.array([x.tobytes() for x in shingle_sets(some.column(2).to_pylist(), words)], pa.binary())],
                names=["doc_id", "text_hash", "tokens"])

    sets = map_batches(texts.select("doc_id", "text_hash", "text", "place"), make, "doc_id long, text_hash long, tokens binary")
    keys = ["unnamed", "number", "text_hash"]  # one shuffle serves both steps; no key is missing
    named = [F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("number"), F.col("text_hash")]
    sets = sets.select(*named, "tokens").groupBy(*keys).agg(F.first("tokens").alias("tokens"))
    more = [c for c in wanted.columns if c not in ("doc_id", "text_hash")]
    return stored(sets.join(wanted.select(*named, *more), keys).select(*more, "tokens"), name)


def open_groups(one: list[np.ndarray], one_names: np.ndarray, two: list[np.ndarray], two_names: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Names to join so that linked members of the two groups are joined; members of one name are joined already."""
    kept = []
    for own, other in ((one, two), (two, one)):
        union = np.unique(np.concatenate(other))
        kept.append(np.array([k for k, x in enumerate(own)
                              if 100 * int(np.isin(x, union, assume_unique=True, kind="sort").sum()) >= percent * len(x)], np.int64))
    if not (len(kept[0]) and len(kept[1])):
        return []
    one, two = [one[k] for k in kept[0]], [two[k] for k in kept[1]]
    one_names, two_names = one_names[kept[0]], two_names[kept[1]]
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    places = []
    for sets in (one, two):
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(shared, flat), max(0, len(shared) - 1))
        hit = shared[at] == flat if len(shared) else np.zeros(len(flat), bool)
        order = np.argsort(at[hit], kind="stable")
        places.append((owner[hit][order], at[hit][order]))
    both = np.zeros((len(one), len(two)), np.float32)
    for a in range(0, len(shared), COLUMNS):
        sides = []
        for (owner, at), n in zip(places, both.shape, strict=True):
            i, j = np.searchsorted(at, [a, a + COLUMNS])
            side = np.zeros((n, min(COLUMNS, len(shared) - a)), np.float32)
            side[owner[i:j], at[i:j] - a] = 1
            sides.append(side)
        both += sides[0] @ sides[1].T
    total = np.array([len(x) for x in one])[:, None] + np.array([len(x) for x in two])[None, :]
    rows, columns = np.nonzero((both.astype(np.int64) * (100 + percent) >= percent * total) & (one_names[:, None] != two_names[None, :]))
    found, first = [], {}

    def root(x: int) -> int:
        while first.setdefault(x, x) != x:
            first[x] = x = first[first[x]]
        return x

    for x, y in zip(one_names[rows].tolist(), two_names[columns].tolist(), strict=True):
        if (i := root(x)) != (j := root(y)):
            first[max(i, j)] = min(i, j)
            found.append((x, y))
    return found


def _star_links(classes: DataFrame, texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Pairs (leader, node) of the first class that has a key and another one, and those that are links, as (a, b); stored."""
    keyed = classes.where("n > 0").select("node", "n", F.posexplode("keys").alias("nth", "key"))
    first = keyed.groupBy("nth", "key").agg(F.min(F.struct("node", "n")).alias("first"), F.count(F.lit(1)).alias("many")).where("many > 1")
    pairs = keyed.join(first.select("nth", "key", "first"), ["nth", "key"]).where(
        (F.col("node") != F.col("first.node")) & (100 * F.least("n", "first.n") >= percent * F.greatest("n", "first.n")))
    pairs = stored(pairs.select(F.col("first.node").alias("leader"), "node").distinct(), "star-pairs")
    dealt = pairs.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    # where a set is to go is known before it is made, so it moves once; a class has a leader for each hash function at most
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    to = pairs.join(dealt, "leader").groupBy("node").agg(F.collect_list(F.struct("leader", block)).alias("to"))
    wanted = classes.select("node", "doc_id", "text_hash").join(to, "node", "left").join(
        dealt.withColumnRenamed("leader", "node"), "node", "left").where("to IS NOT NULL OR blocks IS NOT NULL")
    sets = _token_sets(texts, stored(wanted, "star-wanted"), words, "star-sets")
    left = sets.where("to IS NOT NULL").select(F.inline("to"), "node", "tokens")
    right = sets.where("blocks IS NOT NULL").select(
        F.col("node").alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("own_block"), F.col("tokens").alias("own_tokens"))

    def check(some: pa.Table, leader: pa.Table) -> pa.Table:
        a, b = [], []
        if leader.num_rows:
            name, own = leader.column("own")[0].as_py(), np.frombuffer(leader.column("own_tokens")[0].as_py(), np.uint64)
            for node, tokens in zip(some.column("node").to_pylist(), some.column("tokens").to_pylist(), strict=True):
                if linked(own, np.frombuffer(tokens, np.uint64), percent):
                    a.append(name)
                    b.append(node)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    links = left.groupBy("leader", "block").cogroup(right.groupBy("own", "own_block")).applyInArrow(check, "a long, b long")
    return pairs, stored(links, "star-links")


def _groups(classes: DataFrame, pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """node, doc_id, text_hash, n, component (by the links so far), group and whether it is alone there, stored."""
    first = pairs.groupBy("node").agg(F.min("leader").alias("leader"))
    rows = classes.select("node", "doc_id", "text_hash", "n").join(first, "node", "left").join(joined, "node", "left").select(
        "node", "doc_id", "text_hash", "n", F.coalesce("leader", "node").alias("leader"), F.coalesce("component", "node").alias("component"))
    rows = stored(rows, "grouped")
    parts = lambda n: F.ceil(n / BLOCK).cast("int")
    large = rows.groupBy("component").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") >= OWN_GROUPS).select("component", parts(F.col("many")).alias("own"))
    small = rows.join(large, "component", "left_anti").groupBy("leader").agg(F.count(F.lit(1)).alias("many")).where("many > 1").select("leader", parts(F.col("many")).alias("shared"))
    rows = rows.join(large, "component", "left").join(small, "leader", "left")
    group = F.when(F.col("own").isNotNull(), F.xxhash64(F.lit(1), "component", F.pmod(F.xxhash64("node"), F.col("own")))).otherwise(
        F.xxhash64(F.lit(2), "leader", F.pmod(F.xxhash64("component"), F.coalesce("shared", F.lit(1)))))
    alone = F.col("own").isNull() & F.col("shared").isNull()
    return stored(rows.select("node", "doc_id", "text_hash", "n", "component", group.alias("group"), alone.alias("alone")), "groups")


def components(links: DataFrame) -> DataFrame:
    """node, component: the least node reachable, for every node of a link (a, b), by large and small stars in turn."""

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = both.join(least, "u")
        if large:
            out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return out.where("a != b").distinct()

    edges = stored(links.select("a", "b").where("a != b").distinct(), "edges")
    before = None
    while True:
        edges = stored(star(star(edges, True), False), "edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if (now["n"], now["h"]) == before:
            break
        before = (now["n"], now["h"])
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def _members(texts: DataFrame, classes: DataFrame, counts: tuple[np.ndarray, np.ndarray, dict[int, bytes]], words: int, percent: int) -> DataFrame:
    """group, component, doc_id, text_hash, n and tokens (first ones, packed) of classes that have first tokens, stored; others
    are linked with nothing that they aren't joined with. ``classes`` are those of ``_groups``; TOGETHER lone ones or more that
    have the same least first token get a group, in blocks."""

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, orders, twice = counts
        marks = _marks(twice)
        for batch in batches:
            firsts = [first_tokens(s, numbers, orders, marks, percent) for s in shingle_sets(batch.column(2).to_pylist(), words)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([f.tobytes() or None for f in firsts], pa.binary()),
                 pa.array([int(_signed(mix64(f).min(keepdims=True))[0]) if len(f) else None for f in firsts], pa.int64())],
                names=["doc_id", "text_hash", "tokens", "least"])

    rows = map_batches(texts.select("doc_id", "text_hash", "text"), prefixes, "doc_id long, text_hash long, tokens binary, least long").where("tokens IS NOT NULL")
    # repeated rows of one id and text count once; one shuffle serves both steps
    named = [F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", F.lit(0)).alias("number"), F.col("text_hash")]
    rows = rows.select(*named, "tokens", "least").groupBy("unnamed", "number", "text_hash").agg(F.first("tokens").alias("tokens"), F.first("least").alias("least"))
    rows = rows.join(classes.select(*named, "doc_id", "node", "group", "alone", "component", "n"), ["unnamed", "number", "text_hash"])
    rows = stored(rows.drop("unnamed", "number"), "first-tokens")
    blocks = rows.where("alone").groupBy("least").agg(F.count(F.lit(1)).alias("many")).where(F.col("many") >= TOGETHER).select(
        "least", F.lit(True).alias("alone"), F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks"))
    group = F.when(F.col("blocks").isNotNull(), F.xxhash64(F.lit(3), "least", F.pmod(F.xxhash64("node"), F.col("blocks")))).otherwise(F.col("group"))
    return stored(rows.join(blocks, ["least", "alone"], "left").select(group.alias("group"), "component", "doc_id", "text_hash", "n", "tokens"), "members")


def _candidates(members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups that share as many cells as linked members would, stored. ``members`` are those of ``_members``."""
    total = members.agg(F.sum(F.length("tokens") / 8)).first()[0] or 0
    shift = np.uint64(64 - max(PART_BITS, int(total // PART_TOKENS).bit_length()))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0

        def out() -> pa.RecordBatch:
            sizes = [len(w[0]) for w in waiting]
            t = np.concatenate([w[0] for w in waiting])
            g, c, n = (np.repeat(np.array([w[k] for w in waiting], np.int64), sizes) for k in (1, 2, 3))
            order = np.lexsort((n, c, g, t))
            t, g, c, n = t[order], g[order], c[order], n[order]
            new = np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1]) | (c[1:] != c[:-1]) | (n[1:] != n[:-1])])
            parts, columns = _packed((t[new] >> shift).astype(np.int64), t[new], g[new], c[new], n[new])
            return pa.RecordBatch.from_arrays([pa.array(parts), *(pa.array(x, pa.binary()) for x in columns)],
                                              names=["part", "tokens", "groups", "components", "sizes"])

        for batch in batches:
            for group, component, n, tokens in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                waiting.append((np.frombuffer(tokens, np.uint64), group, component, n))
                held += len(waiting[-1][0])
                if held > COUNTED_AT_ONCE:
                    yield out()
                    waiting, held = [], 0
        if held:
            yield out()

    matrix = map_batches(members.select("group", "component", "n", "tokens"), deal,
                         "part long, tokens binary, groups binary, components binary, sizes binary", 2000)

    def meet(some: pa.Table) -> pa.Table:
        t, g, c, n = (np.concatenate([np.frombuffer(x, kind) for x in some.column(name).to_pylist()]) for name, kind in (
            ("tokens", np.uint64), ("groups", np.int64), ("components", np.int64), ("sizes", np.int64)))
        order = np.lexsort((g, t))
        t, g, c, n = t[order], g[order], c[order], n[order]
        heads = np.flatnonzero(np.concatenate([[True], (t[1:] != t[:-1]) | (g[1:] != g[:-1])]))
        least, most = (f.reduceat(n, heads) for f in (np.minimum, np.maximum))
        low, high = (f.reduceat(c, heads) for f in (np.minimum, np.maximum))
        t, (names, g) = t[heads], np.unique(g[heads], return_inverse=True)  # a matrix cell each
        partners = np.searchsorted(t, t, side="right") - np.arange(len(t))  # itself included
        ends = np.cumsum(partners)
        cuts = np.unique(np.searchsorted(ends, np.arange(0, int(ends[-1]), PAIRS_AT_ONCE)))
        keys, shared, need = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for a, b in zip(cuts, np.append(cuts[1:], len(t)), strict=True):
            i = np.repeat(np.arange(a, b), partners[a:b])
            j = i + np.arange(len(i)) - np.repeat(ends[a:b] - partners[a:b] - (ends[a] - partners[a]), partners[a:b])
            fits = (100 * most[i] >= percent * least[j]) & (100 * most[j] >= percent * least[i])
            fits &= np.minimum(low[i], low[j]) != np.maximum(high[i], high[j])
            i, j = i[fits], j[fits]
            every = np.concatenate([keys, g[i] * len(names) + g[j]])
            ones = np.concatenate([shared, np.ones(len(i), np.int64)])
            needs = np.concatenate([need, cells_needed(np.minimum(least[i], least[j]), np.maximum(most[i], most[j]), percent)])
            order = np.argsort(every, kind="stable")
            every = every[order]
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            if len(first):
                keys, shared, need = every[first], np.add.reduceat(ones[order], first), np.minimum.reduceat(needs[order], first)
        return pa.table({"a": pa.array(names[keys // len(names)]), "b": pa.array(names[keys % len(names)]), "shared": pa.array(shared), "need": pa.array(need)})

    pairs = matrix.groupBy("part").applyInArrow(meet, "a long, b long, shared long, need long").groupBy("a", "b").agg(
        F.sum("shared").alias("shared"), F.min("need").alias("need"))
    return stored(pairs.where("shared >= need").select("a", "b"), "candidates")


def _group_links(grouped: DataFrame, candidates: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (a, b) of components that have linked members in candidate groups, stored."""
    involved = candidates.select(F.col("a").alias("group")).union(candidates.select(F.col("b").alias("group"))).distinct()
    members = grouped.join(involved, "group", "left_semi").select("group", "component", "doc_id", "text_hash")
    sets = _token_sets(texts, members, words, "group-sets")
    # the smaller groups that one group meets are opened against it together, so its members are sent once for many of them
    many = members.groupBy("group").agg(F.count(F.lit(1)).alias("many"))
    pairs = candidates.join(many.select(F.col("group").alias("a"), F.col("many").alias("many_a")), "a").join(
        many.select(F.col("group").alias("b"), F.col("many").alias("many_b")), "b")
    turned = F.col("many_a") < F.col("many_b")
    pairs = pairs.select(*(F.when(turned, F.col(y)).otherwise(F.col(x)).alias(name) for name, x, y in (
        ("large", "a", "b"), ("small", "b", "a"), ("many", "many_b", "many_a"))))
    parts = pairs.groupBy("large").agg(F.ceil(F.sum("many") / BLOCK).cast("int").alias("parts"))
    pairs = stored(pairs.join(parts, "large").select("large", "small", F.pmod(F.xxhash64("small"), F.col("parts")).alias("bundle")), "group-pairs")
    one = pairs.select("large", "bundle").distinct().join(
        sets.select(F.col("group").alias("large"), "component", "tokens"), "large").select("large", "bundle", "component", "tokens")
    two = pairs.join(sets.select(F.col("group").alias("small"), "component", "tokens"), "small").select(
        F.col("large").alias("to_large"), F.col("bundle").alias("to_bundle"), F.col("component").alias("to_component"), F.col("tokens").alias("to_tokens"))

    def check(first: pa.Table, second: pa.Table) -> pa.Table:
        found = []
        if first.num_rows and second.num_rows:
            x, y = ([np.frombuffer(t, np.uint64) for t in s.column(c).to_pylist()] for s, c in ((first, "tokens"), (second, "to_tokens")))
            found = open_groups(x, np.asarray(first.column("component")), y, np.asarray(second.column("to_component")), percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return stored(one.groupBy("large", "bundle").cogroup(two.groupBy("to_large", "to_bundle")).applyInArrow(check, "a long, b long"), "group-links")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable by links, its own included), text_hash, stays.

    Words are lower-cased (A-Z) and parted by ASCII white space. Two documents are linked when 100 * intersection >=
    percent * union of their distinct shingles. Texts with fewer words are one shingle, the whole sequence; missing and
    empty ones have none and are linked with nothing, each a component of its own. Rows without an id take part; a
    component of nothing else has none. Repeated rows are copies. ``stays`` marks one row of each component, that with the
    smallest id (of several such rows, any with one text hash). An empty table gives no rows.
    """
    texts = _texts(df, id_column, text_column)
    sketches = _sketches(df, id_column, text_column, words)
    docs = sketches.where("kind = 0").select("place", "doc_id", "text_hash", "n", "set_a", "set_b", "keys")
    some = docs.where("n > 0")
    classes = stored(some.groupBy("set_a", "set_b").agg(
        F.min(F.struct("place", "doc_id", "text_hash", "n", "keys")).alias("one"),
        F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "place")).alias("least"),
    ).select("set_a", "set_b", F.col("one.place").alias("node"), "one.doc_id", "one.text_hash", "one.n", "one.keys", "least"), "classes")
    counts = _frequent(sketches)
    pairs, stars = _star_links(classes, texts, words, percent)
    grouped = _groups(classes, pairs, stored(components(stars), "joined"))
    members = _members(texts, grouped, counts, words, percent)
    links = _group_links(members, _candidates(members, percent), texts, words, percent)
    joined = stored(components(links), "joined").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    member = classes.select("node", "set_a", "set_b", "least").join(grouped.select("node", "component"), "node").join(
        joined, "component", "left").select("set_a", "set_b", "least", F.coalesce("whole", "component").alias("component"))
    least = member.groupBy("component").agg(F.min("least").alias("stays"))
    named = member.join(least, "component").select("set_a", "set_b", F.col("stays"))
    out = docs.join(named, (docs["set_a"] == named["set_a"]) & (docs["set_b"] == named["set_b"]) & (docs["n"] > 0), "left")
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("stays.doc_id")).otherwise(F.col("doc_id")).alias("component_id"),
        "text_hash", F.coalesce(F.col("stays.place") == F.col("place"), F.lit(True)).alias("stays"))


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with the columns it had; rows without shingles all stay."""
    found = near_duplicates(df, id_column, text_column, words, percent).where("stays").groupBy("doc_id", "text_hash").agg(
        F.max(F.col("n_shingles")).alias("most"))
    keys = found.select(F.col("doc_id").alias("of"), F.col("text_hash").alias("of_text"), "most")
    text = F.col(text_column).cast("string")
    rows = df.select(F.struct("*").alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"))
    rows = rows.join(keys, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_hash") == F.col("of_text")))
    some = rows.where("most > 0").dropDuplicates(["doc_id", "text_hash"])
    return some.select("row.*").union(rows.where("most = 0").select("row.*"))
