"""The bound on shared cells, and groups of lone classes, of the n-gram Jaccard join."""

import random

import numpy as np
import pytest

from rateloom.llm import near_duplicates


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_linked_sets_share_as_many_first_tokens_as_needed(percent):
    rng = np.random.default_rng(percent)
    marks = np.full(near_duplicates.TWICE_BITS // 8, 255, np.uint8)  # no token is known to be in one document only
    none = np.zeros(0, np.int64), np.zeros(0, np.uint8)
    linked = tight = 0
    for _ in range(600):
        many = int(rng.integers(1, 90))
        both = rng.integers(0, 2**64, many, dtype=np.uint64)
        x, y = (np.unique(np.concatenate([both, rng.integers(0, 2**64, int(rng.integers(0, 1 + many * (100 - percent) // 100)), dtype=np.uint64)])) for _ in "xy")
        if not near_duplicates.linked(x, y, percent):
            continue
        first = [near_duplicates.first_tokens(s, *none, marks, percent) for s in (x, y)]
        shared = len(np.intersect1d(*first))
        small, large = sorted((len(x), len(y)))
        need = int(near_duplicates.cells_needed(np.array(small), np.array(large), percent))
        assert shared >= need >= 1
        linked, tight = linked + 1, tight + (need > 1)
    assert linked > 100 and tight > 20


@pytest.mark.parametrize("percent", [50, 75, 90])
def test_ends_of_ranges_bound_all_sizes(percent):
    small, large = np.meshgrid(np.arange(1, 300), np.arange(1, 300), indexing="ij")
    need = near_duplicates.cells_needed(small, large, percent)
    assert (np.diff(need, axis=0) >= 0).all() and (np.diff(need, axis=1) <= 0).all()
    # never more than the exact number: tokens that must be shared, less those behind the first ones of the larger set
    fits = (small <= large) & (100 * small >= percent * large)
    exact = -(-percent * (small + large) // (100 + percent)) - (-(-percent * large // 100) - 1)
    assert (need <= np.maximum(exact, 1))[fits].all()


@pytest.mark.parametrize(("together", "block", "at_once"), [(2, 4, 40), (16, 1024, 1_000_000)])
def test_clusters_of_texts_that_are_mostly_not_linked(spark, monkeypatch, together, block, at_once):
    monkeypatch.setattr(near_duplicates, "TOGETHER", together)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    monkeypatch.setattr(near_duplicates, "PAIRS_AT_ONCE", at_once)
    monkeypatch.setattr(near_duplicates, "KEYS", 1)  # so that many classes stay alone at first
    rng = random.Random(5)
    rows = []
    for cluster in range(2):
        base = [f"c{cluster}w{k}" for k in range(90)]
        for i in range(45):
            words = list(base)
            for _ in range(rng.randrange(6)):
                words[rng.randrange(len(words))] = f"c{cluster}z{rng.randrange(12)}"
            rows.append((1000 * cluster + i, " ".join(words + [f"own{cluster}x{i}y{k}" for k in range(rng.randrange(14))])))
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
    least, links = {i: i for i in sets}, 0
    for _ in sets:
        before = dict(least)
        links = 0
        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
                    links += 1
        if least == before:
            break
    assert 20 < links < 45 * 44 // 2
    got = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in got} == least
