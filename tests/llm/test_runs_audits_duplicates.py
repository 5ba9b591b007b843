"""Periodic runs, filter audits and exact duplicates against plain versions, and on awkward rows."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateloom.llm import exact_duplicates, filter_audit, periodic_runs
from rateloom.llm.queries import ORACLE, QUERIES, tail_repeated
from verification.compare import compare, oracle_connection

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 701}" for i in range(30_000))
TEXTS = [
    (1, "x y " * 20 + "z", "a"), (2, "X Y " * 20 + "z", "a"), (2, "X Y " * 20 + "z", "a"), (3, "", None), (4, None, "a"),
    (None, "x y " * 20 + "z", "b"), (None, "x y " * 20 + "z", "b"), (5, LONG, ""), (6, LONG, "b"), (7, LONG.upper(), "b"),
    (8, "a # b", None), (9, "ÄÖ äö\x0b\x1c q", "c"), (10, "äÖ äö\x0b\x1c q", "c"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string, source string")
    clashing = ("place", "pos", "blocks", "block", "name", "hot", "part", "mask", "runs", "n", "kept", "group", "slice", "label")
    return rows.withColumns({c: F.lit("x") for c in clashing})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (2, 1, None), (6, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")


def brute_runs(x, least=24):
    found = {}
    for q in range(1, len(x) // 3 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q):
                found.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


def test_runs_equal_brute_force():
    rng, seen = random.Random(5), 0
    for _ in range(400):
        n, kinds = rng.choice([0, 5, 23, 24, 60, 130, 300]), rng.choice([1, 2, 3, 40])
        x = [rng.randrange(kinds) for _ in range(n)]
        for _ in range(rng.randrange(4)):
            if n > 30:
                a, p, m = rng.randrange(n), rng.choice([1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 40, 64]), rng.randrange(10, 250)
                for i in range(a + p, min(n, a + m)):
                    x[i] = x[i - p]
        want = brute_runs(x)
        seen += len(want)
        assert periodic_runs.find_runs(np.array(x, np.int64)) == want
    assert seen > 100


def test_runs_of_long_and_regular_texts():
    words = np.random.default_rng(1).integers(0, 5000, 9000)
    tiled = np.concatenate([[9999], np.tile(words, 4), [9998]])
    assert periodic_runs.find_runs(tiled) == [(1, 36000, 9000)]  # blocks are longer than what is transformed at once
    assert periodic_runs.find_runs(np.zeros(20_000, np.int64)) == [(0, 20_000, 1)]
    many = np.array(([0] * 100 + [1]) * 50)
    assert periodic_runs.find_runs(many) == sorted([(101 * k, 100, 1) for k in range(50)] + [(0, 5050, 101)])


def test_transforms_are_exact():
    rng = np.random.default_rng(2)
    for prime in periodic_runs.PRIMES:
        x = rng.integers(0, prime, (3, 64))
        assert (periodic_runs.back_transform(periodic_runs.transform(x, prime), prime) == x).all()
    blocks = rng.integers(0, 1 << 40, (4, 16))  # too large for the primes: renumbered first
    windows = rng.integers(0, 1 << 40, (4, 31))
    windows[2, 5:21] = blocks[2]
    found = periodic_runs.occurrences(blocks, windows)
    assert found.sum() == 1 and found[2, 5]


def test_periodic_runs_on_awkward_rows(spark, docs):
    rows = periodic_runs.periodic_runs(docs).collect()
    assert Counter(r.doc_id for r in rows) == Counter(t[0] for t in TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(x) for x in by_id[1].runs] == [(0, 40, 2)] and by_id[1].collapsed == "x y z"
    assert (by_id[4].n_words, by_id[4].collapsed, by_id[3].runs) == (0, "", [])
    assert [tuple(x) for x in by_id[5].runs] == [(0, 30_000, 701)]
    assert (by_id[9].n_words, by_id[9].collapsed) == (4, "ÄÖ äö \x1c q")
    assert periodic_runs.periodic_runs(docs.limit(0)).count() == 0


def test_query_of_runs_equals_a_plain_version(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, SF).collect()
    assert len(rows) == len(texts)
    found = 0
    for r in rows:
        words = texts[r.doc_id].encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if n > 3000:
            continue
        if h % 10 == 0 and n:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
        assert tail_repeated(r.doc_id, texts[r.doc_id].encode().split()) == words
        runs = brute_runs(words)
        found += len(runs)
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2])) if runs else (None, None, None)
        assert tuple(r) == (
            r.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())
    assert found > 10


def plain_audit(texts, marks):
    first, failed = {}, []
    for i, t, _ in texts:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, part in texts:
        t = t or ""
        words = t.encode().split()
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
                 "D": any(c in "#$%&*|" for c in t), "E": i is not None and first[t] < i}
        failed.append((part or "", fails, *marks.get(i, (False, False))))
    out = {}
    for part in {f[0] for f in failed}:
        own, shapley = [f for f in failed if f[0] == part], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, x in enumerate(order, 1):
                gone = [f for f in left if f[1][x]]
                left = [f for f in left if not f[1][x]]
                shapley[x] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), sum(f[1][x] for f in own) - len(gone),
                    sum(f[1][x] and sum(f[1].values()) == 1 for f in own), sum(f[2] for f in gone), sum(f[3] for f in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_audit_equals_a_plain_version(spark, docs, labels):
    rows = filter_audit.audit_filters(docs, labels).collect()
    marks = {1: (True, False), 2: (True, True), 6: (False, True)}
    want = plain_audit(TEXTS, marks)
    assert len(rows) == len(want) == 600 * 4
    assert {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in rows} == want
    assert filter_audit.audit_filters(docs.limit(0), labels).count() == 0
    assert filter_audit.audit_filters(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def test_wide_sums_do_not_overflow():
    most = (1 << 48) - 1
    lanes = filter_audit.unpacked(most * filter_audit.outcomes(31, True, True))
    assert set(lanes.tolist()) == {0, most} and lanes[filter_audit.TOTAL] == most
    with pytest.raises(OverflowError):
        filter_audit.unpacked((1 << 48) * filter_audit.outcomes(0, False, False))
    both = filter_audit.unpacked(3 * filter_audit.outcomes(1, False, False) + 4 * filter_audit.outcomes(3, True, False))
    assert both[filter_audit.TOTAL] == 7 and both[filter_audit.ALONE] == 3


def plain_duplicates(texts):
    def lower(t):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")

    groups = defaultdict(list)
    for i, t, _ in texts:
        groups[lower(t)].append(i)
    out = []
    for t, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(i, order[-1], len(ids), k == len(ids) - 1, sha) for k, i in enumerate(order)]
    return sorted(out, key=str)


def test_duplicates_equal_a_plain_version(spark, docs):
    got = sorted((tuple(r) for r in exact_duplicates.exact_duplicates(docs).collect()), key=str)
    assert got == plain_duplicates(TEXTS)
    assert exact_duplicates.exact_duplicates(docs.limit(0)).count() == 0


def test_duplicates_with_hot_blocks_and_odd_lengths(spark, monkeypatch):
    monkeypatch.setattr(exact_duplicates, "BLOCK_BYTES", 8)
    monkeypatch.setattr(exact_duplicates, "HOT_ROWS", 20)
    monkeypatch.setattr(exact_duplicates, "HOT_KEYS", 5)
    rng = random.Random(3)
    texts = []
    for i in range(1200):
        if i % 3 == 0:
            t = "Same text for a third of all rows, " * 3  # a hot group, with hot blocks and pairs
        else:
            t = "".join(rng.choice("aAbé") for _ in range(rng.choice([0, 1, 7, 8, 9, 16, 17, 40, 65]) if i % 5 else 2))
        texts.append((rng.choice([i, i % 100, None]), t, None))
    rows = spark.createDataFrame(texts, "doc_id long, text string, source string").repartition(5)
    stored = exact_duplicates.stored(rows, "test")
    got = sorted((tuple(r) for r in exact_duplicates.exact_duplicates(stored).collect()), key=str)
    assert got == plain_duplicates(texts)
    plan = exact_duplicates.exact_duplicates(stored)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "MapInPandas"))


@pytest.mark.parametrize("name", ["op12_filter_audit", "op13_exact_duplicates"])
def test_queries_equal_their_sql(spark, name):
    ok, note = compare(spark, oracle_connection(SF), name, QUERIES[name], ORACLE[name], SF)
    assert ok, note
