"""Toxic words by a linear-chain conditional random field; documents by the field's marginals.

Labels are given for documents, not for words. A first pass over a bounded sample of labelled documents finds the word
features (the word, its first letters, its ending) that stand in toxic documents far more often than chance allows; words
that carry one in a toxic document are the labelled tokens. The field is trained on runs of tokens with these labels. To
score a document, forward-backward gives every word its probability of being toxic; the surest word and the expected
number of toxic words give the document's score, and words above a half are reported with their offsets.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateloom.llm.labelled import labelled_rows, sampled
from rateloom.llm.shared import BATCH_ROWS, fold, held, lists, map_batches, ship_package, stored

#: Documents of each label and runs of tokens of each kind that are learnt from, at most.
TRAIN_DOCS, TRAIN_RUNS = 4_000, 4_000
#: Tokens of a run: long texts are cut into runs, and all of them are scored.
RUN = 64
#: Features are hashed into so many weights.
BUCKETS = 1 << 19
FOLDS, HELD_OUT = 5, 0
EPOCHS, STEP, DECAY, RUNS_AT_ONCE = 8, 0.5, 1e-5, 256
#: Rarer than that in clean documents, a feature may mark a token.
LEAST_LIFT = 4.0
#: Words that a worker remembers before it starts afresh.
REMEMBERED = 300_000
_WORD = re.compile(r"[^\W\d_]+")
_KINDS = 6


def word_features(word: str) -> list[int]:
    """The buckets of a word's features."""
    w, crc = word.lower(), zlib.crc32
    return [crc(w.encode(), 1) % BUCKETS, crc(w[:3].encode(), 2) % BUCKETS, crc(w[:4].encode(), 3) % BUCKETS,
            crc(w[:5].encode(), 4) % BUCKETS, crc(w[:6].encode(), 5) % BUCKETS, crc(w[-3:].encode(), 6) % BUCKETS]


@dataclass
class ToxicModel:
    """Weights of features, bias, transitions (from, to), and the document score's weights: constant, surest word, number."""

    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray



def odds(emissions: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Forward and backward ratios (toxic to clean) of runs of tokens, a run a column, and the factors of the emissions."""
    e, m = np.exp(np.clip(emissions, -30, 30)), np.exp(moves)
    forward, backward = np.empty_like(e), np.empty_like(e)
    forward[0] = e[0]
    for t in range(1, len(e)):
        f = forward[t - 1]
        forward[t] = e[t] * (m[0, 1] + f * m[1, 1]) / (m[0, 0] + f * m[1, 0])
    backward[-1] = 1.0
    for t in range(len(e) - 2, -1, -1):
        b = e[t + 1] * backward[t + 1]
        backward[t] = (m[1, 0] + m[1, 1] * b) / (m[0, 0] + m[0, 1] * b)
    return forward, backward, e


def train_field(features: np.ndarray, labels: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    """Weights, bias and transitions from runs: buckets (run, token, feature), labels and which tokens are real (run, token)."""
    weights, bias, moves = np.zeros(BUCKETS), -2.0, np.zeros((2, 2))
    seen, seen_bias, seen_moves = np.full(BUCKETS, 1e-6), 1e-6, np.full((2, 2), 1e-6)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        places = order.permutation(len(features))
        for a in range(0, len(places), RUNS_AT_ONCE):
            pick = places[a:a + RUNS_AT_ONCE]
            x, y, r = features[pick], labels[pick], real[pick]
            f, b, e = (a.T for a in odds(np.where(r, weights[x].sum(2) + bias, -30.0).T.copy(), moves))
            error = np.where(r, y - f * b / (1 + f * b), 0.0)
            gradient = np.bincount(x.ravel(), np.repeat(error.ravel(), _KINDS), BUCKETS) / len(pick) - DECAY * weights
            seen += gradient**2
            weights += STEP * gradient / np.sqrt(seen)
            g = float(error.sum()) / len(pick)
            seen_bias += g * g
            bias += STEP * g / np.sqrt(seen_bias)
            m, ahead = np.exp(moves), e[:, 1:] * b[:, 1:]
            pairs = np.stack([np.full_like(ahead, m[0, 0]), m[0, 1] * ahead, m[1, 0] * f[:, :-1], m[1, 1] * f[:, :-1] * ahead])
            pairs = np.where(r[:, 1:], pairs / pairs.sum(0), 0.0).sum((1, 2)).reshape(2, 2)
            both = r[:, 1:]
            found = np.array([[float(((y[:, :-1] == i) & (y[:, 1:] == j) & both).sum()) for j in (0, 1)] for i in (0, 1)])
            g2 = (found - pairs) / len(pick)
            g2[0, 0] = 0.0
            seen_moves += g2**2
            moves += STEP * g2 / np.sqrt(seen_moves)
    return weights, float(bias), moves


def in_runs(values: np.ndarray, counts: np.ndarray, filler) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts' tokens (``counts`` of each) as rows of RUN tokens; which are real; the text of each row."""
    runs = -(-counts // RUN)
    owner = np.repeat(np.arange(len(counts)), runs)
    first_token, first_run = np.cumsum(counts) - counts, np.cumsum(runs) - runs
    inside = np.arange(len(values)) - np.repeat(first_token, counts)
    row = np.repeat(first_run, counts) + inside // RUN
    out = np.full((int(runs.sum()), RUN, *values.shape[1:]), filler, values.dtype)
    real = np.zeros((len(out), RUN), bool)
    out[row, inside % RUN], real[row, inside % RUN] = values, True
    return out, real, owner


class Scorer:
    """Scores texts; remembers the emissions of words."""

    def __init__(self, model: ToxicModel):
        self.model, self.known = model, {}
        self.weight = array("d", model.weights.astype(np.float64))

    def marginals(self, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
        """Words, the number of them, and every word's probability."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        known, words, found = self.known, [], []
        for text in texts:
            w = _WORD.findall(text or "")
            for x in w:
                if x not in known:
                    known[x] = sum(map(self.weight.__getitem__, word_features(x)), self.model.bias)
            found += map(known.__getitem__, w)
            words.append(w)
        counts = np.array([len(w) for w in words], np.int64)
        runs, real, _ = in_runs(np.array(found, np.float64), counts, -30.0)
        if not len(runs):
            return words, counts, np.zeros(0)
        f, b, _ = odds(runs.T.copy(), self.model.moves)
        both = f * b
        return words, counts, (both / (1 + both)).T[real]

    def inputs(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: constant, log odds of the surest word, log of 1 + expected toxic words. Then counts and marginals."""
        _, counts, p = self.marginals(texts)
        starts = np.cumsum(counts) - counts
        surest, expected = np.zeros(len(counts)), np.zeros(len(counts))
        some = np.flatnonzero(counts)
        if len(some):
            surest[some] = np.maximum.reduceat(p, starts[some])
            expected[some] = np.add.reduceat(p, starts[some])
        surest = np.clip(surest, 1e-9, 1 - 1e-9)
        return np.stack([np.ones(len(counts)), np.log(surest / (1 - surest)), np.log1p(expected)], 1), counts, p

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        x, counts, p = self.inputs(texts)
        return 1 / (1 + np.exp(-np.clip(x @ self.model.document, -30, 30))), counts, p


def _signature(words: list[str]) -> int:
    """Alike for most near copies: the least hash of three consecutive words."""
    return min((zlib.crc32(" ".join(words[i:i + 3]).encode("utf-8", "surrogatepass")) for i in range(max(1, len(words) - 2))), default=0)


def training_sample(df: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, most: int) -> DataFrame:
    """doc_id, text, label, weight: at most about ``most`` documents of each label, near copies left out, stored.

    ``weight`` is how many documents of its label a document stands for.
    """
    rows = labelled_rows(df, labels, label, folds, held_out)
    parts = []
    for value in (0, 1):
        own = rows.where(F.col("label") == value)
        n = own.select("doc_id").count()
        parts.append(sampled(own, "doc_id", most, own.select("doc_id")).withColumn("weight", F.lit(max(1.0, n / most))))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signs = [_signature(_WORD.findall(t or "")) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signs, pa.int64())], names=[*batch.schema.names, "sign"])

    both = parts[0].unionByName(parts[1]).select("doc_id", "text", "label", "weight")
    signed = stored(map_batches(both, sign, "doc_id long, text string, label int, weight double, sign long"), "toxic-sample")
    first = signed.groupBy("sign", "label").agg(F.min("doc_id").alias("kept")).select("kept")
    return signed.join(first, signed["doc_id"] == first["kept"], "left_semi").drop("sign")


def marking_features(sample: DataFrame) -> np.ndarray:
    """For every bucket: may a token with it be labelled toxic. Counts documents by bucket and label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = {b for w in set(_WORD.findall(text or "")) for b in word_features(w)}
                counts[label, list(found)] += 1
        some = np.flatnonzero(counts.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[0, some]), pa.array(counts[1, some])], names=["bucket", "clean", "toxic"])

    by_bucket = map_batches(sample.select("text", "label"), count, "bucket long, clean long, toxic long")
    got = by_bucket.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where("toxic >= 2").toArrow()
    totals = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = max(1, totals.get(0, 0)), max(1, totals.get(1, 0))
    c0, c1 = (np.asarray(got.column(c), np.float64) for c in ("clean", "toxic"))
    share = n1 / (n0 + n1)
    both = c0 + c1
    # the likelihood ratio of "as many as chance would have it"; far out, its tail falls as exp(-g / 2)
    g = 2 * (c1 * np.log(c1 / (both * share)) + np.where(c0 > 0, c0 * np.log(np.maximum(c0, 1) / (both * (1 - share))), 0.0))
    lift = (c1 / n1) / ((c0 + 0.5) / n0)
    marks = np.zeros(BUCKETS, bool)
    marks[np.asarray(got.column("bucket"))[(g > 2 * np.log(2.0 * max(1, len(both)))) & (lift >= LEAST_LIFT)]] = True
    return marks


def training_runs(sample: DataFrame, marks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs with a toxic token and runs without one, at most about ``most`` of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [_WORD.findall(t or "") for t in batch.column(1).to_pylist()]
            x = np.array([word_features(w) for ws in words for w in ws], np.int32).reshape(-1, _KINDS)
            counts = np.array([len(w) for w in words], np.int64)
            runs, real, owner = in_runs(x, counts, 0)
            y = marks[runs].any(2) & real & (np.array(batch.column(2).to_pylist())[owner] == 1)[:, None]
            number = np.arange(len(runs)) - np.repeat(np.cumsum(-(-counts // RUN)) - -(-counts // RUN), -(-counts // RUN))
            key = np.array(batch.column(0).to_pylist(), np.int64)[owner] if len(runs) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key * 1_000_003 + number), pa.array(y.any(1)), pa.array(real.sum(1)), lists(runs.reshape(-1), np.full(len(runs), RUN * _KINDS), pa.int32()),
                 lists(y.reshape(-1).astype(np.int8), np.full(len(runs), RUN), pa.int8())], names=["run", "marked", "tokens", "x", "y"])

    runs = stored(map_batches(sample.select("doc_id", "text", "label"), cut, "run long, marked boolean, tokens long, x array<int>, y array<tinyint>"), "toxic-runs")
    parts = []
    for marked in (True, False):
        own = runs.where(F.col("marked") == marked)
        parts.append(sampled(own, "run", most, own.select("run")).limit(2 * most))
    got = parts[0].unionByName(parts[1]).toArrow()
    order = np.argsort(np.asarray(got.column("run")), kind="stable")
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(-1, RUN, _KINDS)[order] if got.num_rows else np.zeros((0, RUN, _KINDS), np.int32)
    y = np.asarray(got.column("y").combine_chunks().flatten()).reshape(-1, RUN)[order] if got.num_rows else np.zeros((0, RUN), np.int8)
    return x, y, np.arange(RUN)[None, :] < np.asarray(got.column("tokens"))[order][:, None]


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression, by Newton's method with a little shrinkage."""
    w, shrink = np.zeros(x.shape[1]), np.diag([1e-3, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + shrink, x.T @ (weight * (y - p)) - shrink @ w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(df: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held_out: int = HELD_OUT,
          most_docs: int = TRAIN_DOCS, most_runs: int = TRAIN_RUNS) -> ToxicModel:
    """The model of (doc_id, text) rows with document labels. Without both labels it gives every text the labels' share."""
    sample = training_sample(df, labels, label, folds, held_out, most_docs)
    marks = marking_features(sample)
    x, y, real = training_runs(sample, marks, most_runs)
    model = ToxicModel(*train_field(x, y.astype(np.float64), real), np.zeros(3))

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            values = scorer.inputs(batch.column(0).to_pylist())[0]
            yield pa.RecordBatch.from_arrays(
                [lists(values.reshape(-1), np.full(len(values), 3), pa.float64()), batch.column(1), batch.column(2)], names=["x", "label", "weight"])

    got = map_batches(sample.select("text", "label", "weight"), inputs, "x array<double>, label int, weight double").limit(4 * most_docs).toArrow()
    rows = sorted(zip(got.column("x").to_pylist(), got.column("label").to_pylist(), got.column("weight").to_pylist(), strict=True))
    found = np.array([r[1] for r in rows], np.float64)
    if len(set(found.tolist())) < 2:
        share = (found.sum() + 0.5) / (len(found) + 1.0)
        model.document = np.array([np.log(share / (1 - share)), 0.0, 0.0])
    else:
        model.document = logistic(np.array([r[0] for r in rows]), found, np.array([r[2] for r in rows]))
    model.weights = model.weights.astype(np.float32)
    return model


def _scorer(name: str, model: ToxicModel) -> Scorer:
    return held(f"toxicity {name}", "scorer", lambda: Scorer(model))


def score_toxicity(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", folds: int = FOLDS,
                   held_out: int = HELD_OUT, accept: float = 0.5) -> DataFrame:
    """Per row, over the whole text: doc_id, held_out, score, predicted, spans (start and end in characters, word, probability).

    Empty and missing texts have no words; they score as texts without any toxic word. Repeated rows score alike. Without
    labels every score is 0.5; with one label only, its smoothed share. An empty table gives no rows.
    """
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    model = train(rows, labels, folds=folds, held_out=held_out)
    name = f"{zlib.crc32(model.weights.tobytes())}-{model.document.tolist()}"
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("word", pa.string()), ("probability", pa.float64())])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(name, model)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            scores, counts, p = scorer.scores(texts)
            spans, ends = [], np.cumsum(counts)
            for text, a, b in zip(texts, ends - counts, ends, strict=True):
                hot = set(np.flatnonzero(p[a:b] > 0.5).tolist())
                spans.append([{"start": m.start(), "end": m.end(), "word": m[0], "probability": float(p[a + k])}
                              for k, m in enumerate(_WORD.finditer(text)) if k in hot] if hot else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(spans, pa.list_(span))], names=["doc_id", "score", "spans"])

    scored = map_batches(rows, score, "doc_id long, score double, spans array<struct<start:long,end:long,word:string,probability:double>>")
    return scored.select("doc_id", (fold("doc_id", folds) == held_out).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"), "spans")


def keep_clean(df: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", accept: float = 0.5) -> DataFrame:
    """The rows whose text scores below ``accept``, with the columns they had.

    Missing and empty texts have no toxic word and stay; repeated rows stay or go together; an empty table gives no rows. Where
    the labels are not of both kinds nothing can be learned, and all rows stay.
    """
    rows = df.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    model = train(rows, labels)
    if not model.document[1:].any():
        return df
    name = f"{zlib.crc32(model.weights.tobytes())}-{model.document.tolist()}"

    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(name, model)
        for column in texts:
            parts = (column.slice(k, BATCH_ROWS).to_pylist() for k in range(0, len(column), BATCH_ROWS))
            yield pa.array(np.concatenate([np.zeros(0, bool), *(scorer.scores(p)[0] < accept for p in parts)]))

    ship_package(df.sparkSession)
    return df.where(F.arrow_udf(clean, "boolean")(F.col(text_column).cast("string")))
