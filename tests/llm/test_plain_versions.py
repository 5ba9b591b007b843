"""Whole results against plain versions where there is no SQL; extreme numbers, empty tables, file layout."""

import math
from bisect import bisect_right
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rateloom.llm import inner_products, licenses, mixing, multiprobe, pieces, quality, sharding, token_files, toxicity
from rateloom.llm.queries import QUERIES
from rateloom.llm.shared import fresh_path, stored

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def is_query(c):
    return c % 20 == 0


def both_searches(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    near = multiprobe.nearest(df, is_query, 20).orderBy("query_id", "rank").collect()
    products = inner_products.largest_products(df, is_query, 20).orderBy("query_id", "rank").collect()
    return [tuple(r) for r in near], [tuple(r) for r in products]


def wanted(rows, score):
    out = []
    for q, x in rows:
        if q % 20 == 0:
            scored = sorted(((-score(x, y), v) for v, y in rows if v != q))[:20]
            out += [(q, k, v, -s) for k, (s, v) in enumerate(scored, 1)]
    return out


def whole(x, y):
    total = sum(math.floor(64 * a) * math.floor(64 * b) for a, b in zip(x, y, strict=True))
    return max(-(2**63) + 1, min(2**63 - 1, total))


@pytest.mark.parametrize("large", [1e100, 1e160, 1e200, 1e300])
def test_huge_numbers_lose_no_rows(spark, large):
    rows = [(0, [large, 0.0])] + [(i, [0.0, 1.0]) for i in range(1, 30)]
    near, products = both_searches(spark, rows)
    assert products == wanted(rows, whole)
    assert near == wanted(rows, lambda x, y: sum(a * b for a, b in zip(x, y, strict=True)))


@pytest.mark.parametrize("small", [1e-100, 1e-200, 1e-300])
def test_tiny_numbers_lose_no_rows(spark, small):
    rows = [(i, [small * (i + 1), 0.0]) for i in range(30)]
    near, products = both_searches(spark, rows)
    assert products == wanted(rows, whole)
    assert near == wanted(rows, lambda x, y: sum(a * b for a, b in zip(x, y, strict=True)))


def test_licenses_equal_a_search_without_seeds(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 4000")
    search, found = licenses.notice_search(), 0
    texts = {r.doc_id: r.text for r in docs.collect()}
    texts |= {-k: f"some words {n[1]} more, {n[1].replace('e', 'x', n[2])} end" for k, n in enumerate(licenses.NOTICES, 1)}
    made = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    for r in licenses.scan_licenses(made).collect():
        words = licenses.normalise(texts[r.doc_id]).split()
        places = {p: [i for i in range(len(words)) if words[i:i + len(p.split())] == p.split()] for p in licenses.PHRASES}
        starts = sorted(i for at in places.values() for i in at)
        base = {licenses.PHRASES[p] for p, at in places.items() if at}
        text = " ".join(words)
        fuzzy = {licenses.NOTICES[k][0] for k, exact in enumerate(search.exact) if exact.search(text)}
        found += len(fuzzy)
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(words), len(starts), starts[0] if starts else None, starts[-1] if starts else None)
        assert r.base_labels == ",".join(sorted(base)) and r.labels == ",".join(sorted(base | fuzzy))
        assert (r.score == 1.0) if base else (0 < r.score <= 1 if fuzzy else r.score == 0)
    assert found >= len(licenses.NOTICES)


def test_toxicity_scores_equal_a_plain_forward_backward():
    rng = np.random.default_rng(4)
    model = toxicity.ToxicModel(rng.normal(0, 0.7, toxicity.BUCKETS).astype(np.float32), -1.0, np.array([[0.0, -0.5], [0.3, 0.8]]),
                                np.array([-2.0, 0.7, 1.1]))
    texts = ["", None, "one", "some words of a text and more of them", " ".join(f"w{'abcdefg'[k % 7]}x{'qrs'[k % 3]}" for k in range(300))]
    scores = toxicity.Scorer(model).scores(texts)[0]
    m = np.exp(model.moves)
    for text, got in zip(texts, scores, strict=True):
        words = toxicity._WORD.findall(text or "")
        e = [math.exp(max(-30, min(30, sum(float(model.weights[b]) for b in toxicity.word_features(w)) + model.bias))) for w in words]
        marginals = []
        for a in range(0, len(e), toxicity.RUN):
            own = [(1.0, x) for x in e[a:a + toxicity.RUN]]
            forward, backward = [own[0]], [(1.0, 1.0)]
            for x in own[1:]:
                f = forward[-1]
                now = [(f[0] * m[0, j] + f[1] * m[1, j]) * x[j] for j in (0, 1)]
                forward.append(tuple(v / sum(now) for v in now))
            # a run is filled up with words that are clean
            rest = [(1.0, math.exp(-30.0))] * (toxicity.RUN - len(own))
            for x in [*own, *rest][:0:-1]:
                b = backward[-1]
                now = [sum(m[i, j] * x[j] * b[j] for j in (0, 1)) for i in (0, 1)]
                backward.append(tuple(v / sum(now) for v in now))
            backward = backward[::-1][:len(own)]
            marginals += [f[1] * b[1] / (f[0] * b[0] + f[1] * b[1]) for f, b in zip(forward, backward, strict=True)]
        surest = min(max(max(marginals, default=0.0), 1e-9), 1 - 1e-9)
        total = model.document @ [1.0, math.log(surest / (1 - surest)), math.log1p(sum(marginals))]
        assert got == pytest.approx(1 / (1 + math.exp(-total)), abs=1e-9)


def test_quality_scores_equal_sums_of_looked_up_values(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    features = stored(quality.document_features(docs, "doc_id", "text"), "test-features")
    model = quality.train(features, labels)
    assert model.pairs
    got = {r.doc_id: r.score for r in quality.score_features(features, model).collect()}
    for r in features.collect():
        x = [float(np.float32(v)) for v in r.features]
        margin = model.base + sum(float(t[bisect_right(e.tolist(), v)]) for t, e, v in zip(model.tables, model.edges, x, strict=True))
        margin += sum(float(t[bisect_right(model.coarse[i].tolist(), x[i]), bisect_right(model.coarse[j].tolist(), x[j])])
                      for (i, j), t in zip(model.pairs, model.pair_tables, strict=True))
        assert got[r.doc_id] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-9)


def test_filters_without_labels_keep_all_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5), (None, None, None, None, None)], SCHEMA)
    for labels in (spark.createDataFrame([], "doc_id long, quality int, toxic int"), spark.createDataFrame([(1, 1, 1)], "doc_id long, quality int, toxic int")):
        assert toxicity.keep_clean(docs, labels).count() == quality.keep_good(docs, labels).count() == 2


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert mixing.mix_sources(docs).count() == mixing.copied(docs).count() == 0
    assert pieces.sample_pieces(docs, PIECES).count() == licenses.scan_licenses(docs).count() == sharding.shard_documents(docs).count() == 0
    path = fresh_path(spark, "test-empty")
    token_files.write_tokens(docs, path, BPE)
    assert token_files.token_digest(spark, path).count() == token_files.token_index(spark, path).count() == 0


def test_pipeline_with_missing_values_and_without_rows(spark, tmp_path):
    rows = [(i, f"some text number {i} with words that differ {i * 7}", "en", None if i % 3 else "a", 1) for i in range(30)]
    rows += [(None, "no id here at all", None, "a", None), (None, None, None, None, None), (3, "", "", "", 0), (5, None, "x", "b", None)]
    for name, some in (("some", rows), ("none", [])):
        folder = tmp_path / name
        spark.createDataFrame(some, SCHEMA).write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame([(1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(folder / "labels.parquet"))
        got = corpus_pipeline.run(spark, str(folder))
        assert got.columns == ["doc_id", "n_pieces", "ids_crc32", "lossless", "ids"]
        found = got.collect()
        assert (len(found) > 10) == bool(some) and all(r.lossless for r in found)


def test_token_files_have_their_layout(spark):
    path = fresh_path(spark, "test-layout")
    token_files.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, BPE)
    for file in Path(path).glob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for k in range(meta.num_row_groups):
            columns = {meta.row_group(k).column(c).path_in_schema: meta.row_group(k).column(c) for c in range(meta.num_columns)}
            tokens = next(c for name, c in columns.items() if name.startswith("token_ids"))
            assert any("DICTIONARY" in e for e in tokens.encodings)
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["row_start"].encodings
            assert columns["doc_id"].has_column_index and columns["doc_id"].has_offset_index
            assert meta.row_group(k).total_byte_size < 2 * int(token_files.LAYOUT["parquet.block.size"])


def test_very_long_text_in_the_near_duplicate_join(spark):
    from rateloom.llm import near_duplicates

    rng = np.random.default_rng(6)
    long = [f"w{k}" for k in rng.integers(0, 10**6, 40_000).tolist()]
    other = long[:39_000] + [f"v{k}" for k in range(1_000)]
    rows = [(1, " ".join(long)), (2, " ".join(other)), (3, " ".join(long[:25_000])), (4, "short text of six words here")]
    got = {r.doc_id: r.component_id for r in near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def shingles(t):
        w = t.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in rows}
    linked = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    assert linked == {(1, 2)} and got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_sessions_keep_their_settings(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    QUERIES["op5_licenses"](spark, SF).agg(F.count(F.lit(1))).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_intermediate_tables_are_in_one_folder(spark):
    from rateloom.llm import shared

    path = fresh_path(spark, "test")
    assert path.startswith(shared.run_folder(spark) + "/test-")
    table = stored(spark.range(3), "test")
    assert table.count() == 3 and all(shared.run_folder(spark) in f for f in table.inputFiles())
    shared.clean_up(spark)
    assert not Path(shared.run_folder(spark)).exists()
