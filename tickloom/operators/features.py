"""Feature table from joined bars, the bar-alignment classifier and their metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import ieee_div, require, uuid5_url
from tickloom.plans.contract import ALL

BUILDER_VERSION, DATA_LAYER, DIAGNOSTIC_BUCKET = "0.2.0", "gold_candidate_features", "5s"
MIN_JOIN_SAFE, Z_WINDOW = 0.5, 20
RENAMED = {
    "cme_first_trade_price": "cme_open_price", "cme_last_trade_price": "cme_close_price", "cme_high_trade_price": "cme_high_price", "cme_low_trade_price": "cme_low_price",
    "mt5_mid_first": "mt5_mid_open", "mt5_mid_last": "mt5_mid_close", "mt5_mid_max": "mt5_mid_high", "mt5_mid_min": "mt5_mid_low",
}


def overlap_window(cme: DataFrame, cme_col: str, mt5: DataFrame, mt5_col: str, keys: Sequence[str]) -> DataFrame:
    """lo and hi of the time both sides cover, by key; null where they don't overlap."""
    a = cme.groupBy(*keys).agg(F.min(cme_col).alias("a0"), F.max(cme_col).alias("a1"))
    b = mt5.groupBy(*keys).agg(F.min(mt5_col).alias("b0"), F.max(mt5_col).alias("b1"))
    both = a.join(b, list(keys), "full")
    lo, hi = F.greatest("a0", "b0"), F.least("a1", "b1")
    known = F.col("a0").isNotNull() & F.col("b0").isNotNull() & (lo <= hi)
    return both.select(*keys, F.when(known, lo).alias("lo"), F.when(known, hi).alias("hi"))


def in_overlap(bars: DataFrame, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bars that touch the time which both sides of their key cover (bounds in nanoseconds); where there is none, all stay."""
    keep = F.col("__lo").isNull() | ((F.col("bucket_end_utc_ns") > F.col("__lo")) & (F.col("bucket_start_utc_ns") <= F.col("__hi")))
    return bars.join(windows.withColumnsRenamed({"lo": "__lo", "hi": "__hi"}), list(keys), "left").where(keep).drop("__lo", "__hi")


def ticks_in_overlap(ticks: DataFrame, time: str, windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ticks within the time which both sides of their key cover, both ends included; where there is none, all stay."""
    keep = F.col("__lo").isNull() | F.col(time).between(F.col("__lo"), F.col("__hi"))
    return ticks.join(windows.withColumnsRenamed({"lo": "__lo", "hi": "__hi"}), list(keys), "left").where(keep).drop("__lo", "__hi")


def _over(top: Column, below: Column, factor: float = 1.0) -> Column:
    """top / below * factor where below is positive, else null."""
    return F.when(below > 0, top / F.when(below > 0, below) * factor)


def reject_reason(max_spread: float | None = None, min_join_safe: float = MIN_JOIN_SAFE) -> Column:
    close, mid, spread = F.col("cme_close_price"), F.col("mt5_mid_close"), F.col("mt5_spread_price_max")
    wide = (spread.isNull() | (spread > max_spread)) if max_spread is not None else F.lit(False)
    bad_price = close.isNull() | mid.isNull() | (close <= 0)
    return (
        F.when(~F.col("has_cme_data"), "no_cme_data").when(~F.col("has_mt5_data"), "no_mt5_data").when(F.coalesce("cme_total_volume", F.lit(0)) <= 0, "zero_cme_volume").when(F.coalesce("mt5_tick_count", F.lit(0)) <= 0, "zero_mt5_ticks")
        .when(F.coalesce(F.col("mt5_join_safe_tick_ratio") < min_join_safe, F.lit(True)), "low_join_safe_tick_ratio").when(bad_price, "invalid_price").when(wide, "spread_too_wide")
    )


def quality_flag(max_spread: float | None = None, min_join_safe: float = MIN_JOIN_SAFE) -> Column:
    """Like the reason, except that an invalid price is named before a low ratio."""
    close, mid, spread = F.col("cme_close_price"), F.col("mt5_mid_close"), F.col("mt5_spread_price_max")
    wide = (spread.isNull() | (spread > max_spread)) if max_spread is not None else F.lit(False)
    return (
        F.when(~F.col("has_cme_data"), "MISSING_CME").when(~F.col("has_mt5_data"), "MISSING_MT5")
        .when((F.coalesce("cme_total_volume", F.lit(0)) <= 0) | (F.coalesce("mt5_tick_count", F.lit(0)) <= 0), "ZERO_VOLUME")
        .when(close.isNull() | mid.isNull() | (close <= 0), "INVALID_PRICE").when(F.coalesce(F.col("mt5_join_safe_tick_ratio") < min_join_safe, F.lit(True)), "LOW_JOIN_SAFE_RATIO")
        .when(wide, "SPREAD_EXTREME").when(F.col("bucket_size") == DIAGNOSTIC_BUCKET, "DIAGNOSTIC_ONLY").otherwise("OK")
    )


def trailing_zscore(x: Column, by: Sequence[str], order: str, rows: int = Z_WINDOW) -> Column:
    """Distance from the trailing mean in sample deviations over the last rows, this one included."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(-(rows - 1), 0)
    mean, std, n = F.avg(x).over(w), F.stddev_samp(x).over(w), F.count(x).over(w)
    return F.when((n >= 2) & (std > 0), (x - mean) / F.when(std > 0, std))


def row_id(app: str = "tickloom") -> Column:
    """Version-5 identifier of a feature row, from its identity alone."""
    return uuid5_url(F.concat_ws(":", F.lit(app), F.lit(BUILDER_VERSION), "date", "cme_symbol", "mt5_symbol", "bucket_size", F.col("bucket_start_utc_ns").cast("string")))


def build_features(joined: DataFrame, max_spread: float | None = None, min_join_safe: float = MIN_JOIN_SAFE) -> DataFrame:
    """The contract's columns from joined bars that carry date, symbol_pair, cme_symbol and mt5_symbol.

    Windows are partitioned by date, pair and bucket size: a day never looks into another.
    """
    by = ["date", "symbol_pair", "bucket_size"]
    d = joined.withColumnsRenamed({k: v for k, v in RENAMED.items() if k in joined.columns})
    w = Window.partitionBy(*by).orderBy("bucket_start_utc_ns")
    d = d.withColumns({
        "bar_reject_reason": reject_reason(max_spread, min_join_safe), "feature_quality_flag": quality_flag(max_spread, min_join_safe),
        "cme_volume_alignment_ratio": F.when(F.col("has_cme_data") & F.col("has_mt5_data") & (F.col("cme_total_volume") > 0) & (F.col("mt5_tick_count") > 0), 1.0).otherwise(0.0),
        "feature_timestamp_utc_ns": F.col("bucket_end_utc_ns"), "data_layer": F.lit(DATA_LAYER), "builder_version": F.lit(BUILDER_VERSION), "feature_row_id": row_id(),
        "cme_high_low_range_bps": _over(F.col("cme_high_price") - F.col("cme_low_price"), F.col("cme_low_price"), 10000.0),
        "mt5_mid_range_bps": _over(F.col("mt5_mid_high") - F.col("mt5_mid_low"), F.col("mt5_mid_low"), 10000.0),
        **{f"cme_{s}_volume_ratio": _over(F.col(f"cme_{s}_volume"), F.col("cme_total_volume")) for s in ("buy", "sell", "unknown_aggressor")},
        "cme_volume_per_trade": _over(F.col("cme_total_volume"), F.col("cme_trade_count")),
        "cme_trade_intensity": F.col("cme_trade_count") / ((F.col("bucket_end_utc_ns") - F.col("bucket_start_utc_ns")) / F.lit(1e9)),
        "basis_close": F.col("mt5_mid_close") - F.col("cme_close_price"), "diagnostic_basis_vwap_twap": F.col("mt5_mid_twap") - F.col("cme_vwap"),
    })
    d = d.withColumns({"basis_close_bps": _over(F.col("basis_close"), F.col("cme_close_price"), 10000.0), "diagnostic_basis_vwap_twap_bps": _over(F.col("diagnostic_basis_vwap_twap"), F.col("cme_vwap"), 10000.0)})
    back = lambda c: F.lag(c, 1).over(w)
    change = lambda c: ieee_div(F.col(c) - back(c), back(c))
    d = d.withColumns({
        "cme_return_close_to_close": change("cme_close_price"), "cme_vwap_return": change("cme_vwap"), "mt5_mid_return_close_to_close": change("mt5_mid_close"),
        "basis_change": F.col("basis_close") - back("basis_close"), "basis_change_bps": F.col("basis_close_bps") - back("basis_close_bps"),
        **{f"{n}_by_symbol_bucket": trailing_zscore(F.col(c), by, "bucket_start_utc_ns") for n, c in (("cme_volume_zscore", "cme_total_volume"), ("cme_trade_count_zscore", "cme_trade_count"), ("cme_range_zscore", "cme_high_low_range_bps"), ("mt5_spread_zscore", "mt5_spread_price_p95"), ("mt5_tick_count_zscore", "mt5_tick_count"))},
    })
    flag = F.col("feature_quality_flag")
    d = d.withColumns({
        "return_diff_close_to_close": F.col("mt5_mid_return_close_to_close") - F.col("cme_return_close_to_close"),
        "is_bar_aligned": F.col("bar_reject_reason").isNull(), "is_model_eligible_candidate": (flag == "OK") & (F.col("bucket_size") != DIAGNOSTIC_BUCKET),
    })
    require(d, ALL, "joined bars")
    return d.select(*ALL)


def classify_bars(joined: DataFrame, max_spread: float | None = None, min_join_safe: float = MIN_JOIN_SAFE) -> DataFrame:
    """The bar-alignment classifier: prices are VWAP and TWAP, zero volume is exactly zero."""
    v, t = F.col("cme_vwap"), F.col("mt5_mid_twap")
    reason = (
        F.when(~F.col("has_cme_data"), "no_cme_data").when(~F.col("has_mt5_data"), "no_mt5_data").when(F.col("cme_total_volume") == 0, "zero_cme_volume").when(F.col("mt5_tick_count") == 0, "zero_mt5_ticks")
        .when(F.col("mt5_join_safe_tick_ratio") < min_join_safe, "low_join_safe_tick_ratio").when(v.isNull() | t.isNull() | (v <= 0), "invalid_price")
    )
    if max_spread is not None:
        reason = reason.when(F.col("mt5_spread_price_max") > max_spread, "spread_too_wide")
    basis = t - v
    return joined.withColumns({"bar_reject_reason": reason, "is_bar_aligned": reason.isNull(), "basis": basis, "basis_abs": F.abs(basis), "basis_bps": _over(basis, v, 10000.0)})


def alignment_metrics(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coverage, alignment rate and volume ratio of classified bars."""
    ok, volume = F.col("is_bar_aligned"), F.coalesce("cme_total_volume", F.lit(0))
    out = classified.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_bars"), F.sum(F.col("has_cme_data").cast("long")).alias("cme_bars"), F.sum(F.col("has_mt5_data").cast("long")).alias("mt5_bars"),
        F.sum(ok.cast("long")).alias("aligned_bars"), F.sum(volume).alias("total_volume"), F.sum(F.when(ok, volume).otherwise(0)).alias("aligned_volume"),
    )
    return out.withColumns({"alignment_rate": F.col("aligned_bars") / F.col("total_bars"), "aligned_volume_ratio": _over(F.col("aligned_volume"), F.col("total_volume"))})
