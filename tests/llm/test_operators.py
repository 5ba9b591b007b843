"""Each operator against a plain version, and on awkward rows: missing values, empty and very long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import math
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rateloom.llm import inner_products, licenses, mixing, multiprobe, near_duplicates, pieces, quality, sharding, token_files, toxicity
from rateloom.llm.queries import ORACLE, QUERIES
from rateloom.llm.shared import fresh_path

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{i % 977}" for i in range(30_000))
TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (2, "the quick brown fox jumps over the lazy dog near the river bank today", "a"),
    (3, "", None), (4, None, "b"), (None, "Released under the MIT Licence, see MIT License.", "b"), (5, LONG, "b"),
    (6, "  two  spaces\n▁ and <|endoftext|>  中文 don't", "c"), (7, "x" * 5000, "c"), (8, "MIT license Apache License mit license", None),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    return rows.withColumns({"label": F.lit("x"), "size": F.lit(-1), "score": F.lit("z"), "key": F.lit(0), "lang": F.lit(None).cast("string")})


def test_licenses(spark, docs):
    got = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(docs).collect()}
    r = got[(8, 6)]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.score) == (3, 0, 4, "apache,mit", 1.0)
    r = got[(None, 8)]
    assert (r.n_base, r.first_word, r.labels) == (1, 6, "mit") and [s.errors for s in r.spans] == [1]
    assert got[(3, 0)].labels == got[(4, 0)].labels == "" and got[(4, 0)].first_word is None
    words = licenses.normalise("a MIT license MIT license")
    assert licenses.places(words, "mit license") == [1, 3]


def test_fuzzy_notices_are_found_with_any_allowed_errors():
    rng, search = random.Random(3), licenses.notice_search()
    for k, (_, notice, errors) in enumerate(licenses.NOTICES):
        for _ in range(20):
            text = list(notice)
            for _ in range(errors):
                at = rng.randrange(1, len(text) - 1)
                if text[at] != " ":
                    text[at] = rng.choice("qz")
            found = search.search(licenses.normalise("lorem ipsum " + "".join(text) + " dolor"))
            assert k in {h[0] for h in found}


def test_token_files_are_what_the_library_gives(spark, docs):
    from tokenizers import Tokenizer

    path = fresh_path(spark, "test")
    token_files.write_tokens(docs, path, BPE)
    got = [tuple(r) for r in token_files.token_digest(spark, path).orderBy("start").collect()]
    library, at, want = Tokenizer.from_file(BPE), 0, []
    for doc_id, text, _ in sorted(TEXTS, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert got == want
    index = token_files.token_index(spark, path)
    assert "token_ids" not in index.columns and index.agg(F.sum("n_tokens")).first()[0] == at


def test_pieces_are_lossless_and_repeatable(spark, docs):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = pieces.sample_pieces(docs, PIECES).collect()
    assert all(r.lossless and r.n_pieces == len(r.ids) for r in got)
    texts = {(d, zlib.crc32((t or "").encode())): t or "" for d, t, _ in TEXTS}
    assert {(r.doc_id, zlib.crc32(model.decode(r.ids).encode())) for r in got} == set(texts)
    again = {(r.doc_id, tuple(r.ids)) for r in pieces.sample_pieces(docs.repartition(3), PIECES).collect()}
    assert again == {(r.doc_id, tuple(r.ids)) for r in got}
    back = pieces.decode_pieces(pieces.sample_pieces(docs, PIECES), PIECES)
    assert sorted((r.doc_id or 0, r.text) for r in back.collect()) == sorted((d or 0, t or "") for d, t, _ in TEXTS)


def test_pieces_are_drawn_with_their_odds():
    lattice = pieces.PieceLattice(PIECES)
    n = 40_000
    ids, counts = lattice.draw(["the"] * n, pieces.row_seeds(list(range(n)), 7))
    ends = np.cumsum(counts)
    seen = defaultdict(int)
    for a, b in zip(ends - counts, ends, strict=True):
        seen["".join(lattice.bytes[i].decode() + "|" for i in ids[a:b])] += 1
    states = {lattice.bytes[p].decode(): w for p, w in zip(lattice.ends, lattice.weights, strict=True) if p >= 0}
    paths = {}

    def walk(rest, path, product):
        if not rest:
            paths[path] = product
        for k in range(1, len(rest) + 1):
            if rest[:k] in states:
                walk(rest[k:], path + rest[:k] + "|", product * states[rest[:k]])

    walk(" the", "", 1.0)
    total = sum(paths.values())
    for path, product in paths.items():
        p = product / total
        assert abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def _odds(lattice, text):
    """Each segmentation's odds, by all paths through the whole text's lattice."""
    states = {lattice.bytes[p].decode(): (int(p), w) for p, w in zip(lattice.ends, lattice.weights, strict=True) if p >= 0}
    paths = {}

    def walk(rest, path, product):
        if not rest:
            paths[path] = product
        for k in range(1, len(rest) + 1):
            if rest[:k] in states:
                walk(rest[k:], (*path, states[rest[:k]][0]), product * states[rest[:k]][1])

    walk(" " + text, (), 1.0)
    return {path: product / sum(paths.values()) for path, product in paths.items()}


def test_runs_of_spaces_are_drawn_from_the_whole_lattice():
    lattice, n = pieces.PieceLattice(PIECES), 20_000
    ids, counts = lattice.draw(["the   x "] * n, pieces.row_seeds(list(range(n)), 7))
    seen = defaultdict(int)
    for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True):
        seen[tuple(ids[a:b].tolist())] += 1
    odds = _odds(lattice, "the   x ")
    assert set(seen) <= set(odds) and any(b"  " in lattice.bytes[i] for path in seen for i in path)
    assert all(abs(seen[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4 for path, p in odds.items())


def test_long_units_are_drawn_from_one_lattice(monkeypatch):
    word = "information" * 40
    lattice, n = pieces.PieceLattice(PIECES), 2_000
    ids, counts = lattice.draw([word] * n, pieces.row_seeds(list(range(n)), 7))
    assert all(lattice.decode(ids[a:b].tolist()) == word.encode() for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True))
    sizes, over = np.array([len(b) for b in lattice.bytes]), 0
    for a, b in zip(np.cumsum(counts) - counts, np.cumsum(counts), strict=True):
        ends = np.cumsum(sizes[ids[a:b]])
        over += not (ends == 32).any()
    assert over > 0  # a piece reaches over the 32nd character
    # filtered alone, in stretches, a unit has the shares that it has among others
    short = pieces.PieceLattice(PIECES)
    short._learn([" informationtheory中xx"])
    monkeypatch.setattr(pieces, "STRETCH", 3)
    alone = pieces.PieceLattice(PIECES)
    alone._learn_long(" informationtheory中xx")
    assert np.array_equal(short.piece.all, alone.piece.all) and np.array_equal(short.back.all, alone.back.all)
    assert np.array_equal(short.first_edge.all[1:], alone.first_edge.all[1:]) and np.allclose(short.share.all, alone.share.all)


def test_shards(spark, docs):
    def jump(key, n):
        key, b, j = key & (2**64 - 1), -1, 0
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) & (2**64 - 1)
            j = int((b + 1) * (2147483648.0 / ((key >> 33) + 1)))
        return b

    keys = np.array([0, 1, 7, 10**12, -1, -5], np.int64)
    assert [int(s) for s in sharding.jump_shards(keys, 9)] == [jump(int(k), 9) for k in keys]
    rows = sharding.shard_documents(docs.union(docs)).collect()
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 8) and r.shard == jump(-1 if r.doc_id is None else r.doc_id, 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(rows) == 2 * len(TEXTS)
    by_id = {(r.doc_id, r.size, r.text_crc32) for r in rows}
    assert by_id == {(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _ in TEXTS}


def test_mix_comes_near_its_targets(spark, docs):
    rows = mixing.mix_sources(docs).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.taken <= 2 * r.size for r in rows)
    assert sorted(map(tuple, mixing.mix_sources(docs).collect()), key=str) == sorted(map(tuple, rows), key=str)
    big = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 4)).alias("source"),
                                   F.repeat(F.lit("w "), (F.col("id") % 50).cast("int")).alias("text"))
    sums = mixing.mix_sources(big).groupBy("source", "target").agg(F.sum("taken").alias("taken")).collect()
    total = sum(i % 50 for i in range(3000))
    assert abs(sum(r.target for r in sums) - 1.5 * total) < 1e-6 and all(abs(r.taken - r.target) <= 50 for r in sums)
    copies = mixing.copied(big)
    assert copies.columns == big.columns and abs(copies.select(F.sum(mixing.word_count(F.col("text")))).first()[0] - 1.5 * total) <= 200


def _vectors(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(n)]
    rows += [(n + i, rows[3][1]) for i in range(30)]  # ties
    return spark.createDataFrame([*rows, (900, None), (901, [1.0, None]), (902, [float("nan")] * 8), (903, [float("inf")] * 8), (None, [1.0] * 8),
                                  (904, [0.0] * 8), (905, [])], "vec_id long, embedding array<double>").withColumn("score", F.lit("x")), rows


def _brute(rows, k, whole):
    ids = [i for i, _ in rows]
    x = np.array([[math.floor(64 * c) if whole else c for c in (v + [0.0] * 8)[:8]] for _, v in rows])
    out = {}
    for a, i in enumerate(ids):
        if i % 20 == 0:
            s = (x * x[a]).sum(1)
            out[i] = [(ids[b], s[b]) for b in sorted(range(len(ids)), key=lambda b: (-s[b], ids[b])) if b != a][:k]
    return out


def test_inner_products_are_exact(spark):
    df, rows = _vectors(spark)
    got = defaultdict(list)
    for r in inner_products.largest_products(df, lambda c: c % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    want = _brute([*rows, (904, [0.0] * 8), (905, [])], 20, True)
    assert got == {q: [(i, int(s)) for i, s in v] for q, v in want.items()}
    assert inner_products.largest_products(df.where("false"), lambda c: c % 20 == 0).count() == 0


def test_multiprobe_recall(spark):
    df, rows = _vectors(spark)
    got = defaultdict(dict)
    for r in multiprobe.nearest(df, lambda c: c % 20 == 0, 20).collect():
        got[r.query_id][r.vec_id] = r.score
    want = _brute(rows, 20, False)
    recall = np.mean([sum(min(s.values()) <= b + 1e-9 for _, b in want[q]) and len(set(s) & {i for i, _ in want[q]}) / len(want[q]) for q, s in got.items()])
    assert set(got) == set(want) and recall >= 0.9 and all(len(s) == 20 for s in got.values())
    assert multiprobe.nearest(df.where("vec_id = 904"), lambda c: c % 20 == 0).count() == 0


def test_repeated_ids_are_all_candidates(spark):
    import duckdb

    rng = np.random.default_rng(9)
    rows = [(int(i), rng.normal(size=8).tolist()) for i in rng.integers(0, 90, 400)]
    rows += [rows[5]] * 30 + [(20, rows[6][1])] * 3
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    embeddings = df.toArrow()  # noqa: F841  the SQL reads it by its name
    want = duckdb.sql(ORACLE["op3_inner_products"]).fetchall()
    got = inner_products.largest_products(df, lambda c: c % 20 == 0, 20).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    vectors, best = [(i, np.array(v)) for i, v in rows], defaultdict(list)
    for a, x in vectors:
        if a % 20 == 0:
            best[a] += [(float((x * y).sum()), -b) for b, y in vectors if b != a]
    found = defaultdict(list)
    for r in multiprobe.nearest(df, lambda c: c % 20 == 0, 20).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.score, -r.vec_id))
    assert set(found) == set(best)
    for q, pairs in best.items():
        near = sorted(pairs, reverse=True)[:20]
        assert len(found[q]) == 20 and abs(found[q][0][0] - near[0][0]) < 1e-9 and np.mean([a[0] >= near[-1][0] - 1e-9 for a in found[q]]) >= 0.9


def _found(df):
    got = defaultdict(list)
    for r in multiprobe.nearest(df, lambda c: c % 20 == 0, 20).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    return got


def test_multiprobe_with_skewed_lengths(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(430, 64)) * rng.lognormal(0, 1, size=(430, 1))  # no number of probes reaches the recall
    x[7] *= 10_000  # crowds all others round one pole
    want = {a: [int(b) for b in np.argsort(-np.where(np.arange(430) == a, -np.inf, x @ x[a]))[:20]] for a in range(0, 430, 20)}
    assert _found(spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")) == want


def test_multiprobe_queries_that_miss_their_buckets(spark, monkeypatch):
    df, rows = _vectors(spark)
    fit = multiprobe.fit

    def few_probes(*args):
        index = fit(*args)
        index.probes, index.exact = 1, False
        return index

    monkeypatch.setattr(multiprobe, "fit", few_probes)
    got = _found(df)
    assert set(got) == {i for i, _ in rows if i % 20 == 0} and all(len(s) == 20 for s in got.values())


def test_probe_order_is_by_expected_score():
    order = multiprobe.probe_order(4, 81)
    assert len(order) == 81 and len(np.unique(order, axis=0)) == 81 and not order[0].any()
    assert all(not (row[j] and row[7 - j]) for row in order for j in range(4))


def _plain_components(rows):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    least = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    least[i] = least[j] = min(least[i], least[j])
    named = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            named[least[i]] = min(named.get(least[i], doc_id), doc_id)
    return sorted((str(d), len(sets[i]), named.get(least[i])) for i, (d, _) in enumerate(rows))


def test_near_duplicates_against_all_pairs(spark, docs):
    rng = random.Random(11)
    base = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([4, 30, 60, 90]))] for _ in range(12)]
    rows = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"z{rng.randrange(9)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(d, t) for d, t, _ in TEXTS if d != 5]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    got = near_duplicates.near_duplicates(df).collect()
    assert sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in got) == _plain_components(rows)
    kept = near_duplicates.keep_one(df)
    assert kept.columns == df.columns and kept.count() == sum(r.stays for r in got)
    assert near_duplicates.near_duplicates(df.where("false")).count() == 0


def test_components():
    one, two = np.arange(100, dtype=np.uint64), np.arange(15, 100, dtype=np.uint64)
    assert near_duplicates.linked(one, two, 75) and not near_duplicates.linked(one, np.arange(60, 160, dtype=np.uint64), 75)
    assert near_duplicates.open_groups([one], np.array([1]), [two], np.array([2]), 75) == [(1, 2)]


@pytest.fixture(scope="module")
def labelled(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(400):
        words = [rng.choice("alpha beta gamma delta omega sigma kappa lambda".split()) + rng.choice(["", "s", "ed"]) for _ in range(60)]
        toxic, good = i % 4 == 0, i % 3 != 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(60)] = "grobian" + rng.choice(["", "er", "isch"])
        text = " ".join(words) if good else " ".join(w + "###" for w in words)
        texts.append((i, text))
        labels.append((i, int(good), int(toxic)))
    texts += [(1000, None), (1001, ""), (None, "alpha beta"), (1002, LONG)]
    return (spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit("x")),
            spark.createDataFrame([*labels, (1000, None, None)], "doc_id long, quality int, toxic int"), labels)


def test_toxicity(spark, labelled):
    df, labels, truth = labelled
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert len(got) == 404 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(i, t) for i, _, t in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i in got if got[i].held_out} >= {i for i, _ in held} and np.mean([got[i].predicted == t for i, t in held]) >= 0.95
    spans = [s for i, t in held if t for s in got[i].spans]
    assert spans and all(s.word.startswith("grobian") for s in spans)
    none = toxicity.score_toxicity(df, labels.where("false")).collect()
    assert {round(r.score, 6) for r in none} == {0.5}
    assert toxicity.score_toxicity(df.where("false"), labels).count() == 0


def test_field_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    e, moves = rng.normal(size=(5, 1)), rng.normal(size=(2, 2))
    f, b, _ = toxicity.odds(e, moves)
    weights = {}
    for code in range(32):
        y = [(code >> t) & 1 for t in range(5)]
        weights[tuple(y)] = math.exp(sum(e[t, 0] * y[t] for t in range(5)) + sum(moves[y[t], y[t + 1]] for t in range(4)))
    total = sum(weights.values())
    for t in range(5):
        p = sum(w for y, w in weights.items() if y[t]) / total
        assert abs(p - (f * b / (1 + f * b))[t, 0]) < 1e-9


def test_quality(spark, labelled):
    df, labels, truth = labelled
    got = {r.doc_id: r for r in quality.score_quality(df, labels).collect()}
    assert len(got) == 404 and all(r.predicted == (r.score >= 0.7) for r in got.values())
    held = [(i, q) for i, q, _ in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i].predicted == q for i, q in held]) >= 0.95
    assert {r.score for r in quality.score_quality(df, labels.where("false")).collect()} == {0.5}
    assert quality.score_quality(df.where("false"), labels).count() == 0


def test_additive_model_is_a_sum_of_tables():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)  # an interaction, invisible to single features
    model = quality.fit(x, y)
    assert (1, 0) in model.pairs and np.mean((model.scores(x) >= 0.5) == y) > 0.9


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(spark, docs, SF).persist()
        assert docs.columns == before.columns, name
        assert docs.select("doc_id").distinct().join(before, "doc_id", "left_anti").count() == 0
    out = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert out.where("lossless").count() == docs.count() > 100


def _least_of_components(rows):
    sets = []
    for r in rows:
        w = (r.text or "").encode().lower().split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    least = [r.doc_id for r in rows]
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and least[i] != least[j]:
                low, high = sorted((least[i], least[j]))
                least = [low if x == high else x for x in least]
    return [r for r, a, x in zip(rows, sets, least, strict=True) if not a or x == r.doc_id]


def test_pipeline_stages_against_plain_versions(spark, tmp_path):
    import duckdb

    given = spark.read.parquet(f"{SF}/documents.parquet")
    rows = given.orderBy("doc_id").collect()
    names = [n for n in given.columns if n not in ("doc_id", "text")]
    for i, r in enumerate(rows[:60]):  # exact and near copies, by turns, and texts without words
        text = r.text if i % 2 else f"{r.text} {i}"
        rows.append(r.asDict() | {"doc_id": 10**6 + i, "text": text if i % 20 else ""})
    rows = [(r["doc_id"], r["text"], *(r[n] for n in names)) for r in rows]
    schema = "doc_id long, text string, " + ", ".join(f"{n} {dict(given.dtypes)[n]}" for n in names)
    sf = str(tmp_path)
    spark.createDataFrame(rows, schema).write.parquet(f"{sf}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{sf}/labels.parquet")
    labels, docs = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/documents.parquet")

    def after(number):
        path = fresh_path(spark, f"test-{number}")
        corpus_pipeline.STAGES[number][1](spark, docs, sf).write.parquet(path)
        return spark.read.parquet(path)

    def same(got, want):
        assert sorted(map(str, got)) == sorted(map(str, want)) and want

    for number, (score, stays) in enumerate(((toxicity.score_toxicity, lambda s: s < 0.5), (quality.score_quality, lambda s: s >= 0.7))):
        scores = {r.doc_id: r.score for r in score(docs, labels).collect()}
        kept = after(number)
        same(kept.collect(), [r for r in docs.collect() if stays(scores[r.doc_id])])
        docs = kept
    kept, before = after(2), docs.orderBy("doc_id").collect()
    same(kept.collect(), want := _least_of_components(before))
    assert len(want) < len(before)
    docs = kept
    documents = docs.toArrow()  # noqa: F841  the SQL reads it by its name
    copies = {r[0]: r[-1] for r in duckdb.sql(ORACLE["op2_source_mix"]).fetchall()}
    mixed = after(3)
    same(mixed.collect(), [r for r in docs.collect() for _ in range(copies[r.doc_id])])
    docs, lattice, want = mixed, pieces.PieceLattice(PIECES), []
    for r in docs.collect():
        ids = lattice.draw([r.text or ""], pieces.row_seeds([r.doc_id], 7))[0]
        want.append((r.doc_id, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), True, ids.tolist()))
    same([tuple(r) for r in after(4).collect()], want)
    same([tuple(r) for r in corpus_pipeline.run(spark, sf).collect()], want)


def test_all_queries_are_registered():
    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 14))
