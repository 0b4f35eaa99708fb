import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from tickloom.llm import importance

SCHEMA = "doc_id long, text string, score string, `rank.x` string"
EDGE = [(1, None), (2, ""), (None, "Some words " * 12), (3, "a b"), (4, "a-b é9É"), (4, "a-b é9É"), (5, " \n\t--"), (6, "word " * 25), (7, "word " * 25), (7, "word " * 25), (8, "x" * 3000 + " " + "y " * 40)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).coalesce(2)


def grams(text, low, high):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[k : k + n]) for n in range(low, high + 1) for k in range(len(w) - n + 1)]


def brute(rows, target, low=1, high=1, buckets=importance.BUCKETS):
    def counted(texts):
        c = [0] * buckets
        for t in texts:
            for g in grams(t, low, high)[1]:
                c[zlib.crc32(g.encode()) % buckets] += 1
        return c

    s, t = counted(x for _, x in rows), counted(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, x in rows:
        words, g = grams(x, low, high)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in g)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, words, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[: 10 * len(fit) // 100]):
        r[5] = k + 1
    return sorted(map(str, out))


@pytest.mark.parametrize("rows", ["edge", "many", "none"])
def test_against_brute_force(spark, rows):
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)] + ["É", "déjà", "9"]
    many = [(k * 7 % 211, " ".join(rng.choices(words, k=rng.choice([0, 5, 19, 20, 21, 90])))) for k in range(400)]
    rows = {"edge": EDGE, "many": many + EDGE, "none": []}[rows]
    target = [" ".join(words[:40]), None, "w1 w2"]
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(table(spark, rows), items).collect()
    assert sorted(str(list(r)) for r in got) == brute(rows, target)


def test_runs_of_words(spark):
    target = ["a b c a b", "b c"]
    rows = [(k, f"a b c x{k} a b " * 5) for k in range(20)] + EDGE
    items = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = importance.resample(table(spark, rows), items, low=1, high=3, buckets=97).collect()
    assert sorted(str(list(r)) for r in got) == brute(rows, target, 1, 3, 97)


@pytest.mark.parametrize(("low", "high"), [(1, 1), (2, 2), (1, 3)])
def test_dictionary_in_pieces_that_starts_anew(monkeypatch, low, high):
    """Very long texts are read in pieces; neither these nor a dictionary that forgets change a feature."""
    monkeypatch.setattr(importance, "KEPT", 50)
    monkeypatch.setattr(importance, "PIECE", 100)
    monkeypatch.setattr(importance, "RUN", 40)
    rng = random.Random(low + high)
    known = importance.Dictionary(low, high, 1000)
    for _ in range(5):
        texts = [" ".join(rng.choices([f"w{k}" for k in range(60)] + ["É" * 90, "x" * 300], k=rng.choice([0, 1, 2, 3, 500]))) for _ in range(30)]
        found = list(known.features([t.encode() for t in texts]))
        buckets, whose, words = (np.concatenate([f[k] for f in found]) for k in range(3))
        assert len(found) > 5
        for k, text in enumerate(texts):
            n, want = grams(text, low, high)
            assert (words == k).sum() == n
            assert np.array_equal(np.sort(buckets[whose == k]), np.sort([zlib.crc32(g.encode()) % 1000 for g in want]))


def test_global_order(spark):
    from pyspark.sql import functions as F

    rows = spark.range(0, 5000, 1, 7).withColumn("v", F.pmod(F.hash("id"), F.lit(50)))
    got = importance.ranked(rows, F.col("v").desc(), F.col("id")).collect()
    want = sorted(got, key=lambda r: (-r.v, r.id))
    assert [r.place for r in want] == list(range(1, 5001))


def test_draw_keeps_columns(spark):
    rows = [(k, f"w{k} " * 25) for k in range(40)]
    items = spark.createDataFrame([(0, "w3 " * 50)], "item_id long, text string")
    got = importance.draw(table(spark, rows), items)
    assert got.columns == ["doc_id", "text", "score", "rank.x"] and 3 in {r.doc_id for r in got.collect()} and got.count() == 4
