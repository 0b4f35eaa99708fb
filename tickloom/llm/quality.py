"""Quality classifier: Bradley-Terry pairwise ranking.

Each document has a vector of surface features (byte classes, word and line shape, repetition).  A preference pair is a
labelled good document against a labelled bad one; the weights maximise the Bradley-Terry likelihood, that is, the
logistic likelihood of feature differences, with a small ridge, by Newton steps.  A document's strength is the weighted
sum of its features.  The threshold is the quantile of strengths in the labelled sample that parts the labels best; the
score is the logistic function of the distance from it, so 0.5 is the threshold.

The fit uses a bounded sample of labelled rows (``SAMPLE``: those first by a hash of the identifier); features come
from whole texts and every document is scored.  Neither labels, language, source nor identifier is a feature.

Defined results: null and empty texts are scored as the empty text; a null identifier never labels; rows that share an
identifier are scored on their own; without labels of both kinds every score is 0.5; an empty table gives no row.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import P, bound_batches

#: Labelled rows that the fit takes at most.
SAMPLE = 6_000
#: Preference pairs drawn at most.
PAIRS = 40_000
RIDGE = 1e-3

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CAPS = re.compile(rb"\b[A-Z]{2,}\b")
_TAIL = re.compile(rb"[^\w\s,.;:'\")\]\x80-\xff](?=\s|$)")
FEATURES = 21 + len(_MARKS)


def features(text: str | None) -> np.ndarray:
    """The features of one text; the empty text gives zeros."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES)
    n = len(raw)
    if not n:
        return out
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum()
    words, lines = raw.split(), raw.split(b"\n")
    m = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    distinct = len(set(words))
    some = [x for x in lines if x.strip()]
    grams = list(zip(words, words[1:], words[2:], strict=False))
    starts = {}
    for x in words:
        starts[x] = starts.get(x, 0) + 1
    out[:21] = (
        counts[65:91].sum() / n, counts[97:123].sum() / n, counts[48:58].sum() / n, counts[32] / n, counts[10] / n,
        counts[128:].sum() / n, letters / n, counts[[0, *range(1, 9), *range(11, 32), 127]].sum() / n,
        lengths.mean() / 10, lengths.std() / 10, min(lengths.max(), 200) / 100, distinct / m, np.log1p(m) / 10, distinct / m * np.log1p(m) / 10,
        max(starts.values(), default=0) / m, len(set(grams)) / max(len(grams), 1), len(set(some)) / max(len(some), 1), np.log1p(len(some)) / 10,
        len(_CAPS.findall(raw)) / m, len(_TAIL.findall(raw)) / m, m / max(len(some), 1) / 100,
    )
    out[21:] = np.minimum(counts[list(_MARKS)] / m, 2)
    return np.nan_to_num(out)


def fit(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = 7) -> dict:
    """Weights, centre, scale and threshold from features and labels (1 preferred to 0)."""
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    centre, scale = x.mean(axis=0) if len(x) else np.zeros(x.shape[1]), x.std(axis=0) if len(x) else np.ones(x.shape[1])
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - centre) / scale, -8, 8)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return {"w": w, "centre": centre, "scale": scale, "at": 0.0, "quantile": None}
    rng = np.random.default_rng(seed)
    k = min(pairs, len(good) * len(bad))
    diff = z[rng.choice(good, k)] - z[rng.choice(bad, k)]
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -40, 40)))
        step = np.linalg.solve((diff * (p * (1 - p))[:, None]).T @ diff / k + ridge * np.eye(len(w)), diff.T @ (1 - p) / k - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    s = z @ w
    order = np.argsort(s, kind="stable")
    # Errors if the lowest c of the sample are rejected, each label weighing the same in all.
    lost = np.concatenate([[0], np.cumsum((y[order] == 1) / len(good))])
    left = np.concatenate([[0], np.cumsum((y[order] == 0) / len(bad))])
    best = np.flatnonzero(np.isclose(lost + 1 - left, (lost + 1 - left).min()))
    cut = int(best[len(best) // 2])
    top, below = s[order][min(cut, len(s) - 1)], s[order][max(cut - 1, 0)]
    return {"w": w, "centre": centre, "scale": scale, "at": float((top + below) / 2), "quantile": cut / len(s)}


def scorer(model: dict):
    w, centre, scale, at = model["w"], model["centre"], model["scale"], model["at"]

    @F.pandas_udf("double")
    def run(text: pd.Series) -> pd.Series:
        if not len(text):
            return pd.Series([], dtype="float64")
        z = np.clip((np.stack([features(t) for t in text]) - centre) / scale, -8, 8)
        return pd.Series(1 / (1 + np.exp(-np.clip(z @ w - at, -40, 40))))

    return run


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> dict:
    """Fit on at most ``sample`` labelled identifiers outside the held-out fold, with one text each: of documents that share an identifier the one whose text has the least hash."""
    known = labels.select(F.col(id_col).alias(f"{P}id"), F.col(label_col).cast("int").alias(f"{P}y")).where(F.col(f"{P}id").isNotNull() & F.col(f"{P}y").isin(0, 1) & ~held_out(f"{P}id"))
    some = known.orderBy(F.xxhash64(f"{P}id"), f"{P}id", f"{P}y").limit(sample)
    rows = docs.select(F.col(f"`{id_col}`").alias(f"{P}id"), F.col(f"`{text_col}`").alias("text")).join(F.broadcast(some), f"{P}id")
    one = rows.groupBy(f"{P}id", f"{P}y").agg(F.min_by(F.struct("text"), F.struct(F.xxhash64("text"), "text")).alias("t")).select(f"{P}id", f"{P}y", "t.text")

    @F.pandas_udf("array<double>")
    def vector(text: pd.Series) -> pd.Series:
        return pd.Series([features(t).tolist() for t in text])

    got = one.select(f"{P}id", f"{P}y", vector("text").alias("x")).collect()  # at most ``sample`` rows of features
    got.sort(key=lambda r: (r[0], r[1], r[2]))
    return fit(np.array([r[2] for r in got], dtype=np.float64).reshape(len(got), FEATURES), np.array([r[1] for r in got], dtype=np.int64))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """``docs`` with ``__tl_score``, higher where label 1 is likelier."""
    bound_batches(docs.sparkSession)
    return docs.withColumn(f"{P}score", scorer(train(docs, labels, id_col, text_col, sample=sample))(F.col(text_col)))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    d = score_documents(docs.select("doc_id", "text"), labels)
    s = F.col(f"{P}score")
    return d.select("doc_id", held_out("doc_id").alias("held_out"), s.alias("score"), (s >= 0.5).cast("int").alias("predicted"))
