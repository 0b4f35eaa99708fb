"""Pairwise-complete Pearson correlation of many columns in one scan.

A task turns its rows into matrices: with X the finite values (others zero) and M their mask, products of X, X * X and M
give for all pairs at once the number of rows where both are finite, the sums, squares and cross products over these
rows.  Values are taken relative to a reference near them, and partial results are merged by their means and centred
products (the pairwise update of Chan, Golub and LeVeque), so large offsets lose no digits.  A constant side is told
exactly: where squares don't rule it out by far, by the least and the greatest value over the rows of the pair.  What is
shuffled is one small record a task and group, merged in two steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Groups that a task holds at a time; beyond it they are handed on and begun anew.
HELD = 64
#: Rows of a batch that are turned into matrices at once.
ROWS = 4096
#: Centred squares above this share of the squares about the base are no rounding error (which is below rows x 1e-15).
SURE = 1e-6
#: Bytes of a generated method beyond which the JVM interprets it (HotSpot's ``HugeMethodLimit``).
METHOD_BYTES = 8000
#: Records of a group in the first of the two merging steps: as many as tasks, divided by this.
PARTS = 64


class Moments:
    """For each ordered pair (i, j), over the rows where both are finite: count, mean of i from its column's base, centred squares of i, centred product, bounds of i (infinite where i varies for certain).

    A column's base is one of its values, kept apart from the means, so that these stay small numbers.
    """

    __slots__ = ("n", "base", "mean", "square", "cross", "low", "high")

    def __init__(self, n, base, mean, square, cross, low, high):
        self.n, self.base, self.mean, self.square, self.cross, self.low, self.high = n, base, mean, square, cross, low, high

    @classmethod
    def of(cls, x: np.ndarray) -> Moments:
        """Of the rows of ``x``; NaN and infinities are missing."""
        there = np.isfinite(x)
        first = np.where(there.any(axis=0), x[there.argmax(axis=0), np.arange(x.shape[1])], 0.0)
        m = there.astype(np.float64)
        with np.errstate(invalid="ignore", over="ignore"):
            d = np.where(there, x - first, 0.0)
            n, total = m.T @ m, d.T @ m
            square, cross = (d * d).T @ m, d.T @ d
            per = np.where(n > 0, n, 1.0)
            mean = total / per
            # A pair whose squares stand far above their rounding error varies for certain; only the others are looked at.
            low, high = np.where(n > 0, -np.inf, np.inf), np.where(n > 0, np.inf, -np.inf)
            unsure = (n > 0) & ~(square - total * mean > SURE * square)
            for i in np.flatnonzero(unsure.any(axis=1)):
                some = x[there[:, i]]
                known, own = there[there[:, i]][:, unsure[i]], some[:, i : i + 1]
                low[i, unsure[i]] = np.where(known, own, np.inf).min(axis=0)
                high[i, unsure[i]] = np.where(known, own, -np.inf).max(axis=0)
            return cls(n, np.broadcast_to(first[:, None], n.shape), mean, square - total * mean, cross - total * mean.T, low, high)

    def merge(self, o: Moments) -> Moments:
        n = self.n + o.n
        per = np.where(n > 0, n, 1.0)
        with np.errstate(invalid="ignore", over="ignore"):
            base = np.where(np.diag(self.n)[:, None] > 0, self.base, o.base)
            mine, other = self.mean + (self.base - base), o.mean + (o.base - base)
            away = np.where((self.n > 0) & (o.n > 0), other - mine, 0.0)
            weight = self.n * o.n / per
            mean = np.where(self.n == 0, other, mine + away * o.n / per)
            return Moments(n, base, mean, self.square + o.square + away * away * weight, self.cross + o.cross + away * away.T * weight, np.minimum(self.low, o.low), np.maximum(self.high, o.high))

    def pack(self) -> bytes:
        return np.stack([self.n, self.base, self.mean, self.square, self.cross, self.low, self.high]).tobytes()

    @classmethod
    def unpack(cls, data: bytes, size: int) -> Moments:
        return cls(*np.frombuffer(data, dtype=np.float64).reshape(7, size, size))

    def correlation(self) -> np.ndarray:
        """NaN under three rows or where a side is constant."""
        varies = (self.n >= 3) & (self.low < self.high) & (self.low.T < self.high.T) & (self.square > 0) & (self.square.T > 0)
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            r = self.cross / (np.sqrt(self.square) * np.sqrt(self.square.T))
        return np.where(varies, r, np.nan)


def _partial(keys: int, size: int) -> Callable:
    """From rows (group, values) to records (group, moments) of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        named: dict[int, tuple] = {}

        def out() -> Iterator[pa.RecordBatch]:
            if held:
                columns = [pa.array([named[g][k] for g in held], kinds[k]) for k in range(keys)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([m.pack() for m in held.values()], pa.binary())], names=[f"k{k}" for k in range(keys)] + ["moments"])

        kinds: list = []
        for whole in batches:
            kinds = [whole.schema.field(k).type for k in range(keys)]
            for batch in (whole.slice(k, ROWS) for k in range(0, whole.num_rows, ROWS)):
                x = np.column_stack([batch.column(keys + k).fill_null(float("nan")).to_numpy(zero_copy_only=False) for k in range(size)]) if batch.num_rows else np.zeros((0, size))
                groups = list(zip(*(batch.column(k).to_pylist() for k in range(keys)), strict=True)) if keys else [()] * batch.num_rows
                places: dict[tuple, list[int]] = {}
                for k, g in enumerate(groups):
                    places.setdefault(g, []).append(k)
                for g, rows in places.items():
                    made = Moments.of(x if len(rows) == len(x) else x[rows])
                    held[g] = held[g].merge(made) if g in held else made
                    named[g] = g
                if len(held) > HELD:
                    yield from out()
                    held.clear()
                    named.clear()
        yield from out()

    return run


def moments(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """A record (keys, moments) for each group."""
    # The expressions of many columns make one method too large to be compiled; beyond this Spark generates several.
    df.sparkSession.conf.set("spark.sql.codegen.hugeMethodLimit", str(METHOD_BYTES))
    size = len(features)
    names = [f"k{k}" for k in range(len(keys))]
    kinds = [df.schema[k].dataType for k in keys]
    rows = df.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names, strict=True)], *[F.col(f"`{c}`").cast("double").alias(f"v{k}") for k, c in enumerate(features)])
    shape = T.StructType([*[T.StructField(n, t) for n, t in zip(names, kinds, strict=True)], T.StructField("moments", T.BinaryType())])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        total = Moments.unpack(pdf["moments"].iloc[0], size)
        for blob in pdf["moments"].iloc[1:]:
            total = total.merge(Moments.unpack(blob, size))
        return pdf.iloc[:1][[*names]].assign(moments=[total.pack()])

    parts = rows.mapInArrow(_partial(len(keys), size), shape)
    for salt in (F.pmod(F.spark_partition_id(), F.lit(PARTS)), F.lit(0)):
        parts = parts.withColumn("part", salt).groupBy(*names, "part").applyInPandas(merged, shape)
    return parts.toDF(*keys, "moments")


def correlations(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Rows (keys, feature_a, feature_b, n, r) of all pairs of features in their order; r is null under three rows or where a side is constant."""
    size, names = len(features), list(features)
    a, b = np.triu_indices(size, 1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for _, row in pdf.iterrows():
                m = Moments.unpack(row["moments"], size)
                r = m.correlation()[a, b]
                yield pd.DataFrame({**{k: [row[k]] * len(a) for k in keys}, "feature_a": [names[k] for k in a], "feature_b": [names[k] for k in b], "n": m.n[a, b].astype(np.int64), "r": r})

    shape = T.StructType([*[T.StructField(k, df.schema[k].dataType) for k in keys], *T.StructType.fromDDL("feature_a string, feature_b string, n long, r double")])
    return moments(df, keys, features).mapInPandas(run, shape).withColumn("r", F.nanvl("r", F.lit(None).cast("double")))
