import itertools
import random
import re

import numpy as np
import pytest

from tickloom.llm import circulant_minhash as cm

SCHEMA = "doc_id long, text string, cls string, `a.b` string"
WORDS = [f"w{k}" for k in range(60)]
EDGE = [(1, None), (2, ""), (None, "x"), (3, "a b"), (4, "A b"), (4, "a b"), (5, " \n\t"), (6, "one"), (7, "ONE"), (8, "é" * 5000), (None, "é" * 5000), (9, "x y x y x"), (10, "y x y")]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).coalesce(2)


def brute(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[k : k + 2]) for k in range(max(1, len(w) - 1))} if w else set())
    comp = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    out = []
    for k, (i, _) in enumerate(rows):
        named = [rows[j][0] for j in range(len(rows)) if comp[j] == comp[k] and rows[j][0] is not None]
        least = min(named) if named else None
        out.append((i, len(sets[k]), least, i == least))
    return sorted(map(str, out))


def found(spark, rows, **how):
    got = cm.near_duplicates(table(spark, rows), **how).collect()
    return sorted(str((r.doc_id, r.n_shingles, r.component_id, r.doc_id == r.component_id)) for r in got)


def near_copies(rng, groups):
    rows = []
    for _ in range(groups):
        text = rng.choices(WORDS, k=rng.choice([1, 2, 3, 5, 6, 8, 40, 90]))
        for _ in range(rng.choice([1, 4, 25])):
            text = [rng.choice(WORDS) if rng.random() < 0.04 else w for w in text]  # copies of copies: chains
            rows.append((len(rows) * 7 % 1009, " ".join(text)))
    return rows


@pytest.mark.parametrize(("rounds", "block"), [(3, 1024), (1, 4), (0, 2)])
def test_against_brute_force(spark, rounds, block):
    rows = near_copies(random.Random(rounds), 25) + EDGE
    assert found(spark, rows, rounds=rounds, block=block) == brute(rows)


def test_classes_that_only_share_the_bands_of_a_third_meet(spark):
    rows = near_copies(random.Random(5), 25)
    got = cm.near_duplicates(table(spark, rows), count=8, rows=1).collect()  # broad groups: most pairs in one aren't led by either
    assert sorted(str((r.doc_id, r.n_shingles, r.component_id, r.doc_id == r.component_id)) for r in got) == brute(rows)


def test_edges_and_empty_table(spark):
    assert found(spark, EDGE) == brute(EDGE)
    assert found(spark, []) == []
    assert cm.query(table(spark, EDGE)).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    kept = cm.keep_one(table(spark, EDGE))
    assert kept.columns == ["doc_id", "text", "cls", "a.b"]
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "5", "6", "8", "9", "None", "None"])


def test_permutations_and_signature():
    x = np.concatenate([np.arange(1 << 20, dtype=np.uint32), np.uint32(0xFFFFFFFF) - np.arange(1 << 20, dtype=np.uint32)])
    for f in (cm.sigma, cm.pi):
        assert len(np.unique(f(x.copy()))) == len(x)  # no two integers meet
    rng = np.random.default_rng(1)
    s = rng.integers(0, 1 << 62, 700).astype(np.uint64)
    at = cm.sigma((cm.mix(s, 31) >> np.uint64(32)).astype(np.uint32))
    assert cm.signature(s, 9).tolist() == [int(cm.pi(at - np.uint32(k)).min()) for k in range(9)]


@pytest.mark.parametrize("n", [5, 40, 400])
def test_share_of_equal_coordinates_is_the_similarity(n):
    rng = np.random.default_rng(n)
    shares, missed = [], 0
    for _ in range(200):
        a = rng.integers(0, 1 << 62, n).astype(np.uint64)
        b = np.concatenate([a[: 4 * n // 5], a[:0]])  # a subset: similarity exactly 0.8
        x, y = cm.signature(a, 250), cm.signature(b, 250)
        shares.append((x == y).mean())
        missed += not (cm.bands(x, 5) == cm.bands(y, 5)).any()
    assert abs(np.mean(shares) - 0.8) < 0.02 and not missed
