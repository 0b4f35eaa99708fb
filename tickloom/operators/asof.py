"""Backward as-of match of trades to quotes with a tolerance, join-safe quotes only, and a reason for each miss.

One union of both streams and one ordered window answer every tolerance: the newest safe quote matches at a tolerance
iff its age is within it.  The window is partitioned by symbol and time slice, so that a few symbols still spread over
many tasks; each slice also gets the last quotes before it (their number is two a slice), so nothing is lost at its edge.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUOTE_FIELDS = ("mid", "spread_price", "spread_points", "residual_ms")
REASONS = ("no_overlap_window", "missing_required_columns", "no_mt5_rows_for_symbol", "no_prior_quote", "mt5_not_join_safe", "outside_tolerance")


def asof_match(trades: DataFrame, quotes: DataFrame, tolerance_ms: int, key: str = "symbol", tie: Sequence[str] = (), slice_ms: int = 86_400_000, fields: Sequence[str] = QUOTE_FIELDS, valid: str | None = "is_reference_trade_valid") -> DataFrame:
    """``trades`` with quote_ms, delta_ms, the quote's fields, is_matched and reason.

    Trades need ``event_ms`` and quotes ``quote_ms``, ``is_join_safe``; a quote of the trade's own millisecond counts.
    Of quotes of one time the last by ``tie`` wins.  A trade without a time, or one that the column ``valid`` marks as
    invalid, is never matched; without that column, or with ``valid=None``, no mark counts.
    """
    if tolerance_ms <= 0:
        raise ValueError("the tolerance must be positive")
    kept = [c for c in fields if c in quotes.columns]
    q = quotes.select(F.col(key).alias("__k"), F.col("quote_ms").alias("__t"), F.lit(0).alias("__kind"), F.struct(*[F.col(c) for c in tie], F.lit(0)).alias("__tie"), F.coalesce("is_join_safe", F.lit(False)).alias("__safe"), F.struct("quote_ms", *kept).alias("__q"))
    q = q.withColumn("__s", F.floor(F.col("__t") / slice_ms))
    # Of each slice its last quote and its last safe quote; those of all earlier slices' last are carried to the slices after.
    order = F.struct("__t", "__tie")
    ends = q.groupBy("__k", "__s").agg(F.max(F.col("__t")).alias("any_ms"), F.max(F.when(F.col("__safe"), F.struct(order.alias("o"), F.col("__q").alias("q")))).alias("safe"))
    e = trades.withColumn("__row", F.struct(*[F.col(c) for c in trades.columns])).select(F.col(key).alias("__k"), F.col("event_ms").alias("__t"), F.floor(F.col("event_ms") / slice_ms).alias("__s"), "__row")
    slices = e.select("__k", "__s").distinct().withColumn("__asked", F.lit(1)).unionByName(ends.select("__k", "__s").withColumn("__asked", F.lit(0))).groupBy("__k", "__s").agg(F.max("__asked").alias("asked"))
    before = Window.partitionBy("__k").orderBy("__s").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.join(ends, ["__k", "__s"], "left").select("__k", "__s", "asked", F.max("any_ms").over(before).alias("any0"), F.last("safe", ignorenulls=True).over(before).alias("safe0"), F.max(F.col("any_ms").isNotNull()).over(Window.partitionBy("__k")).alias("has_quotes")).where("asked = 1")
    both = q.select("__k", "__s", "__t", "__kind", "__tie", "__safe", "__q").unionByName(e.select("__k", "__s", "__t", F.lit(1).alias("__kind"), "__row"), allowMissingColumns=True)
    w = Window.partitionBy("__k", "__s").orderBy("__t", "__kind", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    seen = both.withColumns({"__any": F.max(F.when(F.col("__kind") == 0, F.col("__t"))).over(w), "__last": F.last(F.when(F.col("__safe"), F.col("__q")), ignorenulls=True).over(w)}).where("__kind = 1")
    done = seen.join(carried, ["__k", "__s"], "left")
    newest, quote = F.coalesce("__any", "any0"), F.coalesce("__last", "safe0.q")
    done = done.withColumns({"__n": newest, "__m": quote}).withColumn("__delta", F.col("__t") - F.col("__m.quote_ms"))
    usable = F.col("__t").isNotNull() & (F.coalesce(f"__row.{valid}", F.lit(False)) if valid in trades.columns else F.lit(True))
    hit = usable & F.coalesce(F.col("__delta") <= tolerance_ms, F.lit(False))
    reason = F.when(hit, None).when(~usable, "missing_required_columns").when(~F.coalesce("has_quotes", F.lit(False)), "no_mt5_rows_for_symbol").when(F.col("__n").isNull(), "no_prior_quote").when(F.col("__t") - F.col("__n") <= tolerance_ms, "mt5_not_join_safe").otherwise("outside_tolerance")
    at = lambda c: F.when(hit, F.col(f"__m.{c}"))
    return done.select("__row.*", at("quote_ms").alias("quote_ms"), F.when(hit, F.col("__delta")).alias("delta_ms"), *[at(c).alias(f"quote_{c}") for c in kept], hit.alias("is_matched"), reason.alias("reason"), F.when(usable, F.col("__delta")).alias("newest_safe_age_ms"))


def tolerance_table(matched: DataFrame, tolerances: Sequence[int], keys: Sequence[str], size: Column) -> DataFrame:
    """Matched count, rate and volume at each tolerance, from one match."""
    rows = matched.withColumn("tolerance_ms", F.explode(F.array(*[F.lit(t).cast("long") for t in tolerances])))
    hit = F.coalesce(F.col("newest_safe_age_ms") <= F.col("tolerance_ms"), F.lit(False))
    return rows.groupBy(*keys, "tolerance_ms").agg(F.count(F.lit(1)).alias("total"), F.sum(hit.cast("long")).alias("aligned"), F.sum(F.when(hit, size).otherwise(0)).alias("aligned_volume"))


def unmatched_sample(matched: DataFrame, n: int, key: str = "symbol", order: Sequence[str] = ("event_ms",)) -> DataFrame:
    """The first ``n`` unmatched trades of each symbol by time, valid ones only where trades are marked."""
    w = Window.partitionBy(key).orderBy(*order)
    if "is_reference_trade_valid" in matched.columns:
        matched = matched.where("is_reference_trade_valid")
    return matched.where("not is_matched").withColumn("sample_rank", F.row_number().over(w)).where(F.col("sample_rank") <= n)
