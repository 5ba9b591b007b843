"""Periodic runs of words, and texts without the repetitions.

A run is a stretch of words with smallest period q (words q apart are the same), at least three times as long as q and at least
24 words long, that no neighbouring word extends. Found by block convolution at dyadic scales:

1. At scale L the text is cut into blocks of L words. A run with a period from L to 2 L - 1 holds a whole block, and that
   block's next occurrence as well, which begins L to 2 L - 1 words on; the least scale, 8, takes the smaller periods too.
2. The squared differences of a block's words (as numbers) and the words of the following window are summed at all distances at
   once, by number theoretic transforms modulo one or two primes: exact integers. The block occurs where the sum is 0. Blocks
   are transformed many at a time. A block with a word that does not recur within the window cannot occur there, and is left out.
3. Each distance found is the seed of an extension to both sides, word by word, which decides.

Words are compared as bytes; a text's words are numbered in the order of their first places. Work grows as n log^2 n at most, but
for the extensions of occurrences that lead to no run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.shared import map_batches

LEAST_LENGTH, TIMES, LEAST_SCALE = 24, 3, 8
#: Words of a block that are looked for, at larger scales its first ones; numbers that are transformed at once.
BLOCK, AT_ONCE = 1024, 1 << 18
#: Primes with roots of unity of every power of two up to 2^23, and a generator of both.
PRIMES, GENERATOR = (998244353, 469762049), 3
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


@cache
def _roots(prime: int, half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    root = pow(GENERATOR, (prime - 1) // (2 * half), prime)
    if inverse:
        root = pow(root, -1, prime)
    out = np.ones(half, np.int64)
    for k in range(1, half):
        out[k] = out[k - 1] * root % prime
    return out


def _reduced(x: np.ndarray, prime: int) -> np.ndarray:
    """x modulo the prime, for x >= 0; a division by a constant is faster than a remainder."""
    return x - x // prime * prime


def transform(rows: np.ndarray, prime: int) -> np.ndarray:
    """The number theoretic transform of every row, in bit-reversed order. The length is a power of two."""
    out = _reduced(rows, prime)
    half = rows.shape[1] // 2
    while half:
        pairs = out.reshape(len(rows), -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        difference = _reduced((a + (prime - b)) * _roots(prime, half, False), prime)
        pairs[:, :, 0] = _reduced(a + b, prime)
        pairs[:, :, 1] = difference
        half //= 2
    return out


def back_transform(rows: np.ndarray, prime: int) -> np.ndarray:
    """The inverse of ``transform``."""
    out, half = rows.copy(), 1
    while half < rows.shape[1]:
        pairs = out.reshape(len(rows), -1, 2, half)
        turned = _reduced(pairs[:, :, 1] * _roots(prime, half, True), prime)
        a = pairs[:, :, 0].copy()
        pairs[:, :, 0] = _reduced(a + turned, prime)
        pairs[:, :, 1] = _reduced(a + (prime - turned), prime)
        half *= 2
    return _reduced(out * pow(rows.shape[1], -1, prime), prime)


def occurrences(blocks: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Where each row of ``blocks`` (P numbers from 0) stands in its row of ``windows`` (2 P - 1): marks for P distances.

    The sum of squared differences at a distance is block squares + window squares - 2 * products; it is 0 if it is 0 modulo
    primes whose product is above its greatest possible value.
    """
    m, p = blocks.shape
    most = int(max(blocks.max(initial=0), windows.max(initial=0)))
    if p * most * most >= PRIMES[0] * PRIMES[1]:  # smaller numbers for the same words
        some = np.unique(np.concatenate([blocks, windows], 1), return_inverse=True)[1].reshape(m, -1)
        blocks, windows, most = some[:, :p], some[:, p:], int(some.max())
    found = np.ones((m, p), bool)
    for prime in PRIMES[:1] if p * most * most < PRIMES[0] else PRIMES:
        turned, padded = np.zeros((m, 2 * p), np.int64), np.zeros((m, 2 * p), np.int64)
        turned[:, 0], turned[:, p + 1:] = blocks[:, 0], blocks[:, :0:-1]
        padded[:, :2 * p - 1] = windows
        products = back_transform(_reduced(transform(turned, prime) * transform(padded, prime), prime), prime)[:, :p]
        squares = np.cumsum(np.concatenate([np.zeros((m, 1), np.int64), windows * windows], 1), 1)
        sums = (blocks * blocks).sum(1)[:, None] + squares[:, p:] - squares[:, :p]
        found &= _reduced(sums, prime) == _reduced(2 * products, prime)
    return found


def _same(x: np.ndarray, i: int, j: int, step: int) -> int:
    """How many words from i and j on (or back) are the same, i < j."""
    total, chunk = 0, 64
    while True:
        if step > 0:
            n = min(chunk, len(x) - j - total)
            differ = x[i + total:i + total + n] != x[j + total:j + total + n]
        else:
            n = min(chunk, i + 1 - total)
            differ = (x[i + 1 - total - n:i + 1 - total] != x[j + 1 - total - n:j + 1 - total])[::-1]
        if n <= 0:
            return total
        if (k := int(differ.argmax())) or differ[0]:
            return total + k
        total, chunk = total + n, 2 * chunk


def find_runs(x: np.ndarray, least: int = LEAST_LENGTH) -> list[tuple[int, int, int]]:
    """All runs of a row of numbers from 0, as (start, length, period), by start and period. ``least`` is 24 or more."""
    n = len(x)
    if n < least:
        return []
    x = x.astype(np.int64)
    often = np.bincount(x)[x] >= TIMES  # a run's words all stand in it three times
    runs: dict[tuple[int, int], int] = {}
    keys, scale = None, LEAST_SCALE
    while scale == LEAST_SCALE or scale <= n // TIMES:
        size = min(scale, BLOCK)
        low, high = (1 if scale == LEAST_SCALE else scale), min(2 * scale, n // TIMES + 1)
        starts = np.arange(0, n - size - low + 1, scale)
        starts = starts[np.logical_and.reduceat(often, starts)] if size == scale and len(starts) else starts[
            [bool(often[b:b + size].all()) for b in starts]]
        if len(starts) and keys is None:
            order = np.argsort(x, kind="stable")
            keys, padded = x[order] * (n + 1) + order, np.append(x, np.full(4 * BLOCK, x.max() + 1))
        for first in range(low, high, size):
            if not len(starts):
                break
            last = min(first + size, high)  # distances from first to last - 1
            at = (starts[:, None] + np.arange(size)).reshape(-1)
            wanted = x[at] * (n + 1) + at + first
            k = np.searchsorted(keys, wanted)
            recurs = (k < n) & (keys[np.minimum(k, n - 1)] < wanted + (last - first))
            some = starts[recurs.reshape(-1, size).all(1)]
            for part in range(0, len(some), max(1, AT_ONCE // (2 * size))):
                own = some[part:part + max(1, AT_ONCE // (2 * size))]
                windows = own[:, None] + first + np.arange(2 * size - 1)
                row, distance = np.nonzero(occurrences(x[own[:, None] + np.arange(size)], padded[np.minimum(windows, len(padded) - 1)])[:, :last - first])
                _extend(x, own[row], distance + first, size, least, runs)
        scale *= 2
    return sorted((s, e - s, q) for (s, e), q in runs.items())


def _extend(x: np.ndarray, at: np.ndarray, period: np.ndarray, size: int, least: int, runs: dict[tuple[int, int], int]) -> None:
    """Extend occurrences of the blocks ``at``, each ``period`` words on, and enter those that are runs."""
    unknown = np.ones(len(at), bool)
    for (s, e), q in list(runs.items()):  # within a run known already, its period's multiples lead to the same run
        unknown &= ~((at >= s) & (at + period + size <= e) & (period % q == 0))
    order = np.lexsort((at[unknown], period[unknown]))
    before, until = 0, 0
    for b, q in zip(at[unknown][order].tolist(), period[unknown][order].tolist(), strict=True):
        if q == before and b < until:
            continue
        until = b + _same(x, b, b + q, 1)
        before = q
        if until - b < size:  # never: a sum of 0 is an occurrence
            continue
        s, e = b - _same(x, b - 1, b + q - 1, -1) if b else 0, until + q
        if e - s >= max(least, TIMES * q):
            runs[s, e] = min(q, runs.get((s, e), q))


def numbered(words: list[bytes]) -> np.ndarray:
    """The words as numbers from 0, by first places."""
    known: dict[bytes, int] = {}
    return np.array([known.setdefault(w, len(known)) for w in words], np.int64)


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period:start + length] = False
    return [words[k] for k in np.flatnonzero(kept).tolist()]


def periodic_runs(df: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST_LENGTH,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row, over the whole text: doc_id, n_words, runs (start, length, period; by start, then period), collapsed (the kept
    words, joined by one space).

    Words are parted by ASCII white space. ``rewrite`` may change a row's words first. Missing and empty texts have no words:
    no runs, an empty text. Repeated rows give repeated rows, rows without an id take part, an empty table gives no rows. A
    text is worked on in one task, in memory that grows with its length; nothing is shuffled.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts, found, texts = batch.column(0).to_pylist(), [], [], []
            for doc_id, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                words = (text or b"").split()
                if rewrite:
                    words = rewrite(doc_id, words)
                runs = find_runs(numbered(words), least) if len(words) >= least else []
                counts.append(len(words))
                found.append([{"start": s, "length": n, "period": q} for s, n, q in runs])
                texts.append(b" ".join(collapsed(words, runs)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    return map_batches(rows, find, SCHEMA)
