"""Statistics of features by group: missingness, distribution, stability, correlation."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import finite, is_finite, join_on
from tickloom.operators.gram import correlations
from tickloom.operators.ranks import at_ranks

POINTS = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
HEAVY, OUTLIER, SMALL_SAMPLE, FEW = 5.0, 1.5, 5000, 2


def long_form(df: DataFrame, keys: Sequence[str], features: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """A row for each feature of each row: (keys, extra, feature, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    return df.select(*keys, *extra, F.explode(pairs).alias("p")).select(*keys, *extra, "p.feature", "p.value")


def missingness(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    v = F.col("value")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    out = long_form(df, keys, features).groupBy(*keys, "feature").agg(
        F.count(F.lit(1)).alias("rows"), F.count(v).alias("non_null"), n(v.isNull()).alias("nulls"), n(is_finite(v)).alias("finite_count"), n(F.abs(v) == float("inf")).alias("inf_count"),
        n(F.isnan(v)).alias("nan_count"), n(v == 0).alias("zero_count"), (F.count_distinct(v) + F.max(v.isNull().cast("int"))).alias("distinct_count"),
    )
    rate = lambda c: F.col(c) / F.col("rows")
    return out.withColumns({
        "null_rate": rate("nulls"), "finite_rate": rate("finite_count"), "zero_rate": rate("zero_count"), "is_near_constant": F.col("distinct_count") <= FEW,
        "is_all_null": F.col("non_null") == 0, "is_all_zero": (F.col("non_null") > 0) & (F.col("zero_count") == F.col("non_null")),
    })


def distribution(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Moments and linear percentiles of finite values, and the share outside the fences of the quartiles.

    One aggregate makes the moments; percentiles and outliers come from the counts of distinct values, which a shuffle
    carries once (``ranks``), so no group's values are held together.
    """
    rows = long_form(df, keys, features).withColumn("value", finite(F.col("value")))
    v, by = F.col("value"), [*keys, "feature"]
    d = rows.groupBy(*by).agg(F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"), F.var_pop(v).alias("m2"), F.skewness(v).alias("sk"), F.kurtosis(v).alias("ku"))
    points = {f"p{round(100 * q):02d}": q for q in POINTS}
    places = {k: f((F.col("__n") - 1) * F.lit(q)) for name, q in points.items() for k, f in ((f"lo_{name}", F.floor), (f"hi_{name}", F.ceil))}
    found = at_ranks(rows, by, "value", places)
    d = join_on(d, found, by, "left")
    share = lambda q: (F.col("n") - 1) * F.lit(q) - F.floor((F.col("n") - 1) * F.lit(q))
    d = d.select(*by, "n", "mean", "std", "min", "max", "m2", "sk", "ku", *[(F.col(f"lo_{name}") + (F.col(f"hi_{name}") - F.col(f"lo_{name}")) * share(q)).alias(name) for name, q in points.items()]).withColumn("iqr", F.col("p75") - F.col("p25"))
    shaped = (F.col("n") >= 4) & (F.col("m2") > 0)
    wide = F.abs("iqr") > 1e-12
    d = d.withColumns({"robust_scale": F.col("iqr"), "skew": F.when(shaped, F.col("sk")), "excess_kurtosis": F.when(shaped, F.col("ku")), "heavy_tail_score": F.when(wide, F.abs(F.col("p99") - F.col("p50")) / F.when(wide, F.abs("iqr"))), "sample_size_warning": F.col("n") < SMALL_SAMPLE})
    d = d.withColumn("is_heavy_tailed", F.coalesce(F.col("heavy_tail_score") >= HEAVY, F.lit(False))).drop("m2", "sk", "ku")
    counted = rows.where(v.isNotNull()).groupBy(*by, "value").agg(F.count(F.lit(1)).alias("__c"))
    fences = d.where("iqr > 0").select(*by, (F.col("p25") - OUTLIER * F.col("iqr")).alias("lo"), (F.col("p75") + OUTLIER * F.col("iqr")).alias("hi"))
    out = join_on(counted, fences, by).groupBy(*by).agg((F.sum(F.when((v < F.col("lo")) | (v > F.col("hi")), F.col("__c")).otherwise(0)) / F.sum("__c")).alias("outlier_rate"))
    return join_on(d, out, by, "left")


def stability(df: DataFrame, keys: Sequence[str], features: Sequence[str], order: str) -> DataFrame:
    """The first half of a group's rows by time against the rest."""
    w = Window.partitionBy(*keys)
    half = df.withColumn("__first", F.row_number().over(w.orderBy(order)) <= F.floor(F.count(F.lit(1)).over(w) / 2))
    rows, v = long_form(half, keys, features, ["__first"]), F.col("value")
    a, b = F.when(F.col("__first"), v), F.when(~F.col("__first"), v)
    out = rows.groupBy(*keys, "feature").agg(F.count(a).alias("n_first"), F.count(b).alias("n_second"), F.avg(a).alias("mean_first"), F.avg(b).alias("mean_second"), F.stddev_samp(a).alias("std_first"), F.stddev_samp(b).alias("std_second"))
    shift = F.col("mean_second") - F.col("mean_first")
    return out.withColumns({"abs_shift": F.abs(shift), "relative_shift": F.when(F.col("mean_first") != 0, shift / F.abs(F.when(F.col("mean_first") != 0, F.col("mean_first"))))})


def correlation(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Pairwise Pearson of all pairs over rows where both are finite, in one scan: (keys, feature_a, feature_b, n, r)."""
    return correlations(df, keys, features)


#: Level of significance, and rows below which a correlation is marked as of a small sample.
LEVEL, FEW_ROWS = 0.05, 5000


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function."""
    c, d = 1.0, 1 / max(1e-300, 1 - (a + b) * x / (a + 1)) if 1 - (a + b) * x / (a + 1) > 0 else 1 / min(-1e-300, 1 - (a + b) * x / (a + 1))
    f = d
    for k in range(1, 400):
        for top in (k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k)), -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))):
            d = 1 / ((1 + top * d) or 1e-300)
            c = (1 + top / c) or 1e-300
            f *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return f


def regularized_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def pearson_p(r: float | None, n: int) -> float | None:
    """Two-sided p-value of a correlation under Student's t; None under three rows."""
    if r is None or n < 3 or r != r:
        return None
    if abs(r) >= 1 - 1e-12:
        return 0.0
    return regularized_beta((n - 2) / 2, 0.5, 1 - r * r)


def with_p_value(corr: DataFrame, r: str = "r", n: str = "n") -> DataFrame:
    @F.pandas_udf("double")
    def run(r: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([pearson_p(None if pd.isna(a) else float(a), int(b)) for a, b in zip(r, n, strict=True)], dtype="float64")

    return corr.withColumn("p_value", run(r, n)).withColumn("p_value", F.when(~F.isnan("p_value"), F.col("p_value")))


def correlation_summary(df: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Correlations with strength, p-value, and two flags: significant at ``LEVEL``, and of a small sample."""
    out = with_p_value(correlations(df, keys, features))
    return out.withColumns({"abs_correlation": F.abs("r"), "pvalue_available": F.col("p_value").isNotNull(), "is_statistically_significant": F.coalesce(F.col("p_value") < LEVEL, F.lit(False)), "is_small_sample_warning": F.col("n") < FEW_ROWS})


def top_n(df: DataFrame, by: Column, ties: Sequence[str], n: int = 15) -> DataFrame:
    return df.orderBy(by.desc_nulls_last(), *ties).limit(n)
