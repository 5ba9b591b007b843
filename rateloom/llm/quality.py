"""Quality scores by a generalised additive model with pairwise interactions.

Every feature of a text is cut into bins. Boosting goes round the features: each turn fits one shallow tree on one feature
alone to the present residuals and adds a small part of it to the feature's lookup table. Then the pairs of features that
explain most of what is left get tables of their own in the same way. A score is the sum of the looked-up values, so
each feature's and pair's share in it can be read off its table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.labelled import labelled_rows, sampled
from rateloom.llm.shared import BATCH_ROWS, fold, lists, map_batches, ship_package, stored

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "commas_stops", "loud", "symbols", "bars", "beyond_ascii", "line_words",
    "distinct_words", "top_word", "repeated_neighbours", "repeated_lines", "letters_in_words",
)
#: Rows that the model is fitted on, at most; bins of a feature, and of a feature in a pair; rounds of boosting.
TRAIN_ROWS, BINS, PAIR_BINS, ROUNDS, PAIR_ROUNDS, PAIRS = 20_000, 32, 8, 150, 60, 8
RATE, SMOOTH = 0.15, 5.0
FOLDS, HELD_OUT, ACCEPT = 4, 2, 0.7

_KINDS = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "commas_stops": b",.;:", "loud": b"!?", "symbols": b"#$%&*@^~+=<>_\\/",
    "bars": b"|\t",
}
_COUNTED = {k: np.frombuffer(v, np.uint8) for k, v in _KINDS.items()}
_LINE = re.compile(rb"[^\n]+")


def text_features(text: str | None) -> list[float]:
    """The features of a whole text; those of an empty or missing one are 0."""
    raw = (text or "").encode()
    words = raw.lower().split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    of = {k: float(by_byte[v].sum()) / len(raw) for k, v in _COUNTED.items()}
    letters = float(by_byte[65:91].sum() + by_byte[97:123].sum())
    beyond = float(by_byte[128:].sum())
    counts = Counter(words)
    lines = [line.strip() for line in _LINE.findall(raw)]
    return [
        float(np.log1p(len(raw))), float(np.log1p(n)), sum(map(len, words)) / n, float(by_byte[65:91].sum()) / max(1.0, letters),
        of["digits"], of["commas_stops"], of["loud"], of["symbols"], of["bars"], beyond / len(raw), n / len(lines),
        len(counts) / n ** 0.75, counts.most_common(1)[0][1] / n, sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines), (letters + beyond) / len(raw),
    ]


def document_features(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, features."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([text_features(t) for t in batch.column(1).to_pylist()], np.float32).reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), lists(rows, np.full(batch.num_rows, len(FEATURES)), pa.float32())], names=["doc_id", "features"])

    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return map_batches(rows, make, "doc_id long, features array<float>")


@dataclass
class AdditiveModel:
    """Bin edges, a table per feature, and a table per pair of features over coarser edges."""

    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, t in enumerate(self.tables):
            total += t[np.searchsorted(self.edges[j], x[:, j], side="right")]
        coarse = {j: np.searchsorted(self.coarse[j], x[:, j], side="right") for p in self.pairs for j in p}
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            total += t[coarse[i], coarse[j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """The gain of the best cut of consecutive bins, and the first bin behind it (0: none)."""
    if len(g) < 2:
        return 0.0, 0
    a, b, gs, hs = np.cumsum(g)[:-1], np.cumsum(h)[:-1], g.sum(), h.sum()
    gains = a**2 / (b + SMOOTH) + (gs - a) ** 2 / (hs - b + SMOOTH) - gs**2 / (hs + SMOOTH)
    k = int(np.argmax(gains))
    return (float(gains[k]), k + 1) if gains[k] > 1e-9 else (0.0, 0)


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """A tree over one feature's bins with few leaves: the value of each bin."""
    spans = [(0, len(g))]
    while len(spans) < leaves:
        cuts = [(*_best_cut(g[a:b], h[a:b]), a, b) for a, b in spans]
        gain, k, a, b = max(cuts)
        if not k:
            break
        spans.remove((a, b))
        spans += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in spans:
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + SMOOTH)
    return out


def _pair_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A tree of two levels over two features: one cut of the first, then one of the second on either side, or turned."""
    best: tuple[float, np.ndarray] = (0.0, np.zeros(g.shape))
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for k in range(1, len(a)):
            value, gain = np.zeros(a.shape), -float(a.sum() ** 2 / (b.sum() + SMOOTH))
            for rows in (slice(0, k), slice(k, None)):
                x, y = a[rows].sum(0), b[rows].sum(0)
                _, c = _best_cut(x, y)
                for columns in (slice(0, c), slice(c, None)):
                    if (hs := y[columns].sum()) > 0:
                        gs = x[columns].sum()
                        value[rows, columns] = gs / (hs + SMOOTH)
                        gain += float(gs**2 / (hs + SMOOTH))
            if gain > best[0]:
                best = (gain, value.T.copy() if turned else value)
    return best


def fit(x: np.ndarray, y: np.ndarray) -> AdditiveModel:
    """Cyclic boosting. Without both labels the model is the labels' mean, 0.5 without any."""
    quantiles = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    coarse = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, PAIR_BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    model = AdditiveModel(quantiles, coarse)
    rate = (float(y.sum()) + 0.5) / (len(y) + 1.0)
    model.base = float(np.log(rate / (1 - rate)))
    model.tables = [np.zeros(len(e) + 1) for e in quantiles]
    if len(np.unique(y)) < 2:
        return model
    margin = np.full(len(y), model.base)
    bins = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(quantiles)]

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-margin))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for j, table in enumerate(model.tables):
            g, h = residuals()
            step = RATE * _tree(np.bincount(bins[j], g, len(table)), np.bincount(bins[j], h, len(table)))
            table += step
            margin += step[bins[j]]
    small = [np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(coarse)]
    sizes = [len(e) + 1 for e in coarse]

    def grids(i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        g, h = residuals()
        cell = small[i] * sizes[j] + small[j]
        return tuple(np.bincount(cell, w, sizes[i] * sizes[j]).reshape(sizes[i], sizes[j]) for w in (g, h))

    gains = sorted(((_pair_tree(*grids(i, j))[0], i, j) for i in range(len(sizes)) for j in range(i)), reverse=True)
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain > 0]
    model.pair_tables = [np.zeros((sizes[i], sizes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            step = RATE * _pair_tree(*grids(i, j))[1]
            table += step
            margin += step[small[i], small[j]]
    return model


def train(features: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held_out: int = HELD_OUT,
          most: int = TRAIN_ROWS) -> AdditiveModel:
    """Fit on at most about ``most`` labelled rows outside the held-out fold (a fixed bound: 17 numbers a row)."""
    rows = labelled_rows(features, labels, label, folds, held_out)
    got = sampled(rows, "doc_id", most, rows).select("doc_id", "features", "label").limit(2 * most).toArrow()
    x = np.array(got.column("features").to_pylist(), np.float64).reshape(-1, len(FEATURES))
    y = np.array(got.column("label").to_pylist(), np.float64)
    order = np.lexsort((*x.T, np.array([i or 0 for i in got.column("doc_id").to_pylist()], np.int64)))
    return fit(x[order], y[order])


def score_features(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """doc_id, score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            x = np.asarray(column.flatten(), np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(x))], names=["doc_id", "score"])

    return map_batches(features.select("doc_id", "features"), score, "doc_id long, score double", 10_000)


def score_quality(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS,
                  held_out: int = HELD_OUT, most: int = TRAIN_ROWS, accept: float = ACCEPT) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Scores are made from the text alone, all of it.

    Empty and missing texts score as texts whose features are all 0. Repeated rows score alike. Without labels every score
    is 0.5; with one label only, its smoothed share. An empty table gives no rows.
    """
    features = stored(document_features(df, id_column, text_column), "features")
    scored = score_features(features, train(features, labels, folds=folds, held_out=held_out, most=most))
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"))


def keep_good(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              accept: float = ACCEPT) -> DataFrame:
    """The rows whose text scores at least ``accept``, with the columns they had.

    Missing and empty texts score as texts whose features are all 0; repeated rows stay or go together; an empty table gives no
    rows. Where the labels are not of both kinds nothing can be learned, and all rows stay.
    """
    features = stored(document_features(df, id_column, text_column), "features")
    model = train(features, labels)
    if not any(t.any() for t in model.tables):
        return df

    def good(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            parts = (column.slice(k, BATCH_ROWS).to_pylist() for k in range(0, len(column), BATCH_ROWS))
            x = np.array([text_features(t) for p in parts for t in p], np.float32).astype(np.float64).reshape(-1, len(FEATURES))
            yield pa.array(model.scores(x) >= accept)

    ship_package(df.sparkSession)
    return df.where(F.arrow_udf(good, "boolean")(F.col(text_column).cast("string")))
