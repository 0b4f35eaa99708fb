"""Time bars of trades and of quotes, and their full join.

All bucket sizes are made in one job: each row meets a small table of sizes; one shuffle on (symbol, size, bucket).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import bucket_floor, quantile_nearest, require, sum0
from tickloom.operators.ranks import nearest_quantiles

TRADE_COLUMNS = ("symbol", "event_time_utc_ns", "price", "size", "aggressor_side", "is_reference_trade_valid")
QUOTE_COLUMNS = ("symbol", "time_msc_utc_ms", "is_join_safe", "mid", "spread_price", "spread_points", "residual_ms", "is_latency_outlier")


def with_buckets(df: DataFrame, t: Column, sizes: Sequence[tuple[str, int]], step: int = 1) -> DataFrame:
    """Each row once for each bucket size, with its label, start and end (in units of ``step`` nanoseconds)."""
    table = F.array(*[F.struct(F.lit(a).alias("bucket_size"), F.lit(n // step).cast("long").alias("n")) for a, n in sizes])
    out = df.withColumn("__b", F.explode(table)).select("*", "__b.bucket_size", F.col("__b.n").alias("__n")).drop("__b")
    start = bucket_floor(t, F.col("__n"))
    return out.withColumns({"bucket_start_utc_ns": start * step, "bucket_end_utc_ns": (start + F.col("__n")) * step})


#: Rows of a bar beyond which its quantiles come from counted values instead of a list of the bar's values.
LARGE_BAR = 1_000_000


class _Quantiles:
    """Nearest-rank quantiles of bars: in the bars' own aggregate from a list, for bars of more than ``limit`` rows by a distributed selection.

    ``wanted`` has (name, column, quantile).  Large bars are rows over ``limit`` of them at most.
    """

    def __init__(self, rows: DataFrame, by: Sequence[str], wanted: Sequence[tuple[str, str, float]], limit: int):
        self.by, self.wanted, self.large = list(by), wanted, None
        if rows.count() > limit:
            large = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > limit).select(*by, F.lit(True).alias("__large"))
            self.large = None if large.isEmpty() else large
        self.rows = rows if self.large is None else rows.join(F.broadcast(self.large), self.by, "left")

    def columns(self) -> list[Column]:
        kept = lambda c: F.col(c).cast("double") if self.large is None else F.when(F.col("__large").isNull(), F.col(c).cast("double"))
        return [quantile_nearest(kept(c), q).alias(name) for name, c, q in self.wanted]

    def fill(self, bars: DataFrame) -> DataFrame:
        if self.large is None:
            return bars
        some = self.rows.where("__large")
        for c in dict.fromkeys(c for _, c, _ in self.wanted):
            points = {f"__{name}": q for name, x, q in self.wanted if x == c}
            found = nearest_quantiles(some.withColumn("__value", F.col(c).cast("double")), self.by, "__value", points)
            bars = bars.join(F.broadcast(found), self.by, "left")
        return bars.withColumns({name: F.coalesce(F.col(name), F.col(f"__{name}")) for name, _, _ in self.wanted}).drop(*[f"__{name}" for name, _, _ in self.wanted])


def trade_bars(trades: DataFrame, sizes: Sequence[tuple[str, int]], tie: Sequence[str] = (), keys: Sequence[str] = ("symbol",), large_bar: int = LARGE_BAR) -> DataFrame:
    """Bars of valid trades with size summaries; ``tie`` orders trades of one time."""
    require(trades, TRADE_COLUMNS, "trades")
    rows = with_buckets(trades.where("is_reference_trade_valid"), F.col("event_time_utc_ns"), sizes)
    size, price, side = F.col("size"), F.col("price"), F.col("aggressor_side")
    order = F.struct("event_time_utc_ns", *tie)
    of = lambda s: F.when(side == s, size).otherwise(0)
    n_of = lambda s: F.sum(F.when(side == s, 1).otherwise(0))
    by = [*keys, "bucket_size", "bucket_start_utc_ns", "bucket_end_utc_ns"]
    quantiles = _Quantiles(rows, by, [("trade_size_p99", "size", 0.99)], large_bar)
    bars = quantiles.rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("trade_count"), sum0(size).alias("total_volume"), sum0(of("BUY")).alias("buy_volume"), sum0(of("SELL")).alias("sell_volume"),
        sum0(of("UNKNOWN")).alias("unknown_aggressor_volume"), n_of("BUY").alias("buy_trade_count"), n_of("SELL").alias("sell_trade_count"), n_of("UNKNOWN").alias("unknown_aggressor_count"),
        sum0(price * size).alias("__pv"), F.min_by(price, order).alias("first_trade_price"), F.max_by(price, order).alias("last_trade_price"),
        F.max(price).alias("high_trade_price"), F.min(price).alias("low_trade_price"),
        F.max(size).alias("max_single_trade_volume"), *quantiles.columns(), F.avg(size).alias("trade_size_mean"), F.stddev_samp(size).alias("trade_size_std"),
    )
    bars = quantiles.fill(bars)
    total = F.col("total_volume")
    per = lambda x: F.when(total > 0, x / F.when(total > 0, total))
    return bars.withColumns({"net_signed_volume": F.col("buy_volume") - F.col("sell_volume"), "has_cme_data": F.lit(True), "vwap": per(F.col("__pv"))}).withColumn("signed_volume_ratio", per(F.col("net_signed_volume"))).drop("__pv")


def quote_bars(quotes: DataFrame, sizes: Sequence[tuple[str, int]], tie: Sequence[str] = (), keys: Sequence[str] = ("symbol",), large_bar: int = LARGE_BAR) -> DataFrame:
    """Bars of all quotes with a time-weighted mid and nearest-rank quantiles."""
    require(quotes, QUOTE_COLUMNS, "quotes")
    rows = with_buckets(quotes, F.col("time_msc_utc_ms"), sizes, 1_000_000)
    t = F.col("time_msc_utc_ms") * 1_000_000
    inside = Window.partitionBy(*keys, "bucket_size", "bucket_start_utc_ns").orderBy("time_msc_utc_ms", *tie)
    weight = F.greatest(F.coalesce(F.lead(t).over(inside), F.col("bucket_end_utc_ns")) - t, F.lit(0))
    by = [*keys, "bucket_size", "bucket_start_utc_ns", "bucket_end_utc_ns"]
    wanted = [(f"{c}_{name}", c, q) for c in ("spread_price", "spread_points", "residual_ms") for name, q in (("p50", 0.5), ("p95", 0.95))]
    quantiles = _Quantiles(rows, by, wanted, large_bar)
    rows = quantiles.rows.withColumn("__w", weight)
    order, mid = F.struct("time_msc_utc_ms", *tie), F.col("mid")
    spread = [x for c in ("spread_price", "spread_points") for x in (F.min(c).alias(f"{c}_min"), F.avg(c).alias(f"{c}_mean"), F.max(c).alias(f"{c}_max"))]
    bars = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("tick_count"), F.sum(F.when(F.col("is_join_safe"), 1).otherwise(0)).alias("join_safe_tick_count"),
        F.min_by(mid, order).alias("mid_first"), F.max_by(mid, order).alias("mid_last"), F.min(mid).alias("mid_min"), F.max(mid).alias("mid_max"), F.avg(mid).alias("mid_mean"),
        sum0(mid * F.col("__w")).alias("__mw"), F.sum("__w").alias("__w"), *spread,
        *quantiles.columns(), F.max("residual_ms").alias("residual_ms_max"),
        F.sum(F.when(F.col("is_latency_outlier"), 1).otherwise(0)).alias("latency_outlier_count"),
    )
    bars = quantiles.fill(bars)
    twap = F.when(F.col("__w") > 0, F.col("__mw") / F.when(F.col("__w") > 0, F.col("__w"))).otherwise(F.col("mid_mean"))
    return bars.withColumns({"mid_twap": twap, "join_safe_tick_ratio": F.col("join_safe_tick_count") / F.col("tick_count"), "has_mt5_data": F.lit(True)}).drop("__mw", "__w")


def join_bars(trades: DataFrame, quotes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full join of bars; trade columns get ``cme_``, quote columns ``mt5_``, and both presence flags are set."""
    shared = [*keys, "bucket_size", "bucket_start_utc_ns", "bucket_end_utc_ns"]
    a = trades.select(*shared, *[F.col(c).alias(f"cme_{c}") for c in trades.columns if c not in (*shared, "has_cme_data")], F.lit(True).alias("__a"))
    b = quotes.select(*shared, *[F.col(c).alias(f"mt5_{c}") for c in quotes.columns if c not in (*shared, "has_mt5_data")], F.lit(True).alias("__b"))
    out = a.join(b, shared, "full")
    return out.withColumns({"has_cme_data": F.col("__a").isNotNull(), "has_mt5_data": F.col("__b").isNotNull()}).drop("__a", "__b")
