"""Metrics of the quality stages: alignment, bar alignment, telemetry, reference and features.  Each is one pass over its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exprs import is_finite, session_hour
from tickloom.operators.asof import REASONS, asof_match
from tickloom.operators.quality import summary

BAR_REASONS = ("no_cme_data", "no_mt5_data", "zero_cme_volume", "zero_mt5_ticks", "low_join_safe_tick_ratio", "invalid_price", "spread_too_wide")
KEY_FEATURES = ("cme_total_volume", "cme_trade_count", "mt5_tick_count", "mt5_spread_points_max", "mt5_join_safe_tick_ratio", "basis_close_bps", "cme_high_low_range_bps")


def _count(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast("long")), F.lit(0))


def _volume(c: Column, size: str = "size") -> Column:
    return F.coalesce(F.sum(F.when(c, F.col(size))), F.lit(0))


def align(trades: DataFrame, quotes: DataFrame, tolerance_ms: int, key: str = "symbol", tie: Sequence[str] = (), valid: str | None = "is_reference_trade_valid") -> DataFrame:
    """The as-of match with all six reasons: without the columns that a match needs, or for symbols without common time, every trade says so."""
    lost = lambda reason: [F.lit(False).alias("is_matched"), F.lit(reason).alias("reason")]
    if not {key, "quote_ms", "is_join_safe"} <= set(quotes.columns):
        return trades.select("*", F.lit(None).cast("long").alias("quote_ms"), F.lit(None).cast("long").alias("delta_ms"), *lost("missing_required_columns"))
    a = trades.groupBy(key).agg(F.min("event_ms").alias("t0"), F.max("event_ms").alias("t1"))
    b = quotes.groupBy(key).agg(F.min("quote_ms").alias("q0"), F.max("quote_ms").alias("q1"))
    met = F.greatest(F.col("t0"), F.col("q0")) <= F.least(F.col("t1"), F.col("q1") + tolerance_ms)  # one row a symbol on either side
    apart = a.join(b, key).where(~met).select(F.col(key).alias("__apart"))
    matched = asof_match(trades, quotes, tolerance_ms, key, tie, valid=valid)
    done = matched.join(apart, matched[key] == F.col("__apart"), "left")
    return done.withColumn("reason", F.when(F.col("__apart").isNotNull() & ~F.col("is_matched") & (F.col("reason") != "missing_required_columns"), F.lit("no_overlap_window")).otherwise(F.col("reason"))).drop("__apart")


def alignment_statuses(trades: DataFrame, quotes: DataFrame, symbols: Sequence[str], tolerance_ms: int, key: str = "symbol") -> dict[str, str]:
    """For each required symbol OK, or what is missing: cme, mt5, columns or overlap.  A row a symbol is read."""
    if not {key, "quote_ms", "is_join_safe"} <= set(quotes.columns):
        return dict.fromkeys(symbols, "columns")
    span = lambda rows, c: {r[0]: (r[1], r[2]) for r in rows.where(F.col(key).isin(*symbols)).groupBy(key).agg(F.min(c), F.max(c)).collect()}
    a, b = span(trades, "event_ms"), span(quotes, "quote_ms")
    met = lambda s: max(a[s][0], b[s][0]) <= min(a[s][1], b[s][1] + tolerance_ms)
    return {s: "cme" if s not in a else "mt5" if s not in b else "OK" if met(s) else "overlap" for s in symbols}


def alignment_summary(matched: DataFrame, keys: Sequence[str] = ("symbol",), valid: str = "is_reference_trade_valid") -> DataFrame:
    """Totals over all trades, counts and volumes by reason, summaries of matched values and of all sizes and prices, and unknown aggressors among valid trades."""
    hit, none = F.col("is_matched"), ~F.col("is_matched")
    found = [c for c in ("delta_ms", "quote_mid", "quote_spread_price", "quote_residual_ms") if c in matched.columns]
    rows = matched.withColumns({f"__{c}": F.when(hit, F.col(c)) for c in found})
    unknown = F.col(valid) & (F.col("aggressor_side") == "UNKNOWN")
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), _count(hit).alias("aligned"), F.sum("size").alias("total_volume"), _volume(hit).alias("aligned_volume"), _count(unknown).alias("unknown_count"), _volume(unknown).alias("unknown_volume"),
        *[x for r in REASONS for x in (_count(none & (F.col("reason") == r)).alias(f"n_{r}"), _volume(none & (F.col("reason") == r)).alias(f"volume_{r}"))],
        *[m.alias(n) for c in (*(f"__{c}" for c in found), "size", "price") for m, n in zip(summary(c), [f"{c.lstrip('_')}_{k}" for k in ("min", "mean", "p50", "p95", "p99", "max")], strict=True)],
    )
    return out.withColumns({"match_rate": F.col("aligned") / F.col("total"), "unmatched_volume_ratio": F.when(F.col("total_volume") > 0, 1 - F.col("aligned_volume") / F.col("total_volume"))})


def alignment_by_hour(matched: DataFrame, keys: Sequence[str] = ("symbol",), valid: str = "is_reference_trade_valid") -> DataFrame:
    """Valid trades, how many matched, and the rate, by hour."""
    rows = matched.where(F.col(valid)).withColumn("hour", session_hour(F.col("event_ms")))
    out = rows.groupBy(*keys, "hour").agg(F.count(F.lit(1)).alias("total"), _count(F.col("is_matched")).alias("aligned"))
    return out.withColumn("rate", F.col("aligned") / F.col("total"))


def bar_reasons(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bars and volume by reject reason, every reason in every group."""
    volume = F.coalesce("cme_total_volume", F.lit(0))
    wide = classified.groupBy(*keys).agg(*[x for r in BAR_REASONS for x in (_count(F.col("bar_reject_reason") == r).alias(f"n_{r}"), F.coalesce(F.sum(F.when(F.col("bar_reject_reason") == r, volume)), F.lit(0)).alias(f"v_{r}"))])
    each = F.array(*[F.struct(F.lit(r).alias("reason"), F.col(f"n_{r}").alias("bars"), F.col(f"v_{r}").alias("volume")) for r in BAR_REASONS])
    return wide.select(*keys, F.inline(each))


def bar_summary(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Summaries over the aligned bars."""
    names = [c for c in ("basis", "basis_abs", "basis_bps", "mt5_spread_price_max", "cme_total_volume", "mt5_tick_count") if c in classified.columns]
    return classified.where("is_bar_aligned").groupBy(*keys).agg(*[m for c in names for m in summary(c)], F.avg("mt5_join_safe_tick_ratio").alias("mean_join_safe_ratio"))


def telemetry_summary(quotes: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Scaled violations, and how many ticks the de-duplicator held back, where the columns are there."""
    has = set(quotes.columns)
    scaled = _count(F.col("ask_scaled") < F.col("bid_scaled")) if {"bid_scaled", "ask_scaled"} <= has else F.lit(None).cast("long")
    held = F.col("suppressed_count") if "suppressed_count" in has else F.lit(None).cast("long")
    return quotes.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), scaled.alias("crossed_scaled"), F.coalesce(F.sum(held), F.lit(0)).alias("suppressed"), F.max(held).alias("suppressed_max"), _count(held > 0).alias("rows_after_suppression"))


def rows_by_hour(rows: DataFrame, time_ms: str, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return rows.groupBy(*keys, session_hour(F.col(time_ms)).alias("hour")).agg(F.count(F.lit(1)).alias("rows"))


def reference_summary(trades: DataFrame, keys: Sequence[str] = ("symbol",), event: str = "event_time_utc_ns", receive: str = "receive_time_utc_ns") -> DataFrame:
    """Bounds of event and receive time, latency, rows without a best bid or offer (``bid_px_00``, ``ask_px_00`` or ``bid``, ``ask``), and the spread."""
    has = set(trades.columns)
    null = F.lit(None).cast("double")
    late = (F.col(receive) - F.col(event)) / 1e6 if receive in has else null
    sides = next((p for p in (("bid_px_00", "ask_px_00"), ("bid", "ask")) if set(p) <= has), None)
    bid, ask = map(F.col, sides) if sides else (null, null)
    rows = trades.withColumns({"latency_ms": late, "bbo_spread": ask - bid})
    absent = ~F.col("is_bbo_available") if "is_bbo_available" in has else bid.isNull() | ask.isNull()  # the full layout says it by file
    missing = _count(absent) if sides else F.lit(None).cast("long")
    when = lambda f, c, n: (f(c) if c in has else F.lit(None).cast("long")).alias(n)
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), missing.alias("missing_bbo"), when(F.min, event, "first_event"), when(F.max, event, "last_event"), when(F.min, receive, "first_receive"), when(F.max, receive, "last_receive"), *summary("latency_ms"), *summary("bbo_spread"))


def feature_flags(features: DataFrame, keys: Sequence[str] = ("symbol_pair", "bucket_size")) -> DataFrame:
    """Rows by quality flag and by reject reason: (keys, kind, value, rows); a null reason isn't a reason."""
    each = F.array(F.struct(F.lit("flag").alias("kind"), F.col("feature_quality_flag").alias("value")), F.struct(F.lit("reason").alias("kind"), F.col("bar_reject_reason").alias("value")))
    return features.select(*keys, F.inline(each)).where("value is not null").groupBy(*keys, "kind", "value").agg(F.count(F.lit(1)).alias("rows"))


def candidate_rates(features: DataFrame, names: Sequence[str], keys: Sequence[str] = ("symbol_pair", "bucket_size")) -> DataFrame:
    """Share of nulls and of finite values of each candidate: one wide aggregate, then a row for each candidate."""
    wide = features.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), *[x for c in names for x in (F.count(c).alias(f"n_{c}"), _count(F.coalesce(is_finite(F.col(c).cast("double")), F.lit(False))).alias(f"f_{c}"))])
    each = F.array(*[F.struct(F.lit(c).alias("feature"), (1 - F.col(f"n_{c}") / F.col("rows")).alias("null_rate"), (F.col(f"f_{c}") / F.col("rows")).alias("finite_rate")) for c in names])
    return wide.select(*keys, "rows", F.inline(each))


def feature_summary(features: DataFrame, keys: Sequence[str] = ("symbol_pair", "bucket_size")) -> DataFrame:
    return features.groupBy(*keys).agg(*[m for c in KEY_FEATURES if c in features.columns for m in summary(c)])


def most_null(features: DataFrame, names: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` candidates with most nulls, names breaking ties."""
    return candidate_rates(features, names, []).orderBy(F.desc("null_rate"), "feature").limit(n)


def contract_errors(features: DataFrame, names: Sequence[str], forbidden: Sequence[str]) -> list[str]:
    """What keeps a feature table from the contract: columns missing or forbidden, repeated row identities."""
    errors = [f"missing column {c}" for c in names if c not in features.columns] + [f"forbidden column {c}" for c in forbidden if c in features.columns]
    if "feature_row_id" in features.columns:
        r = features.agg(F.count(F.lit(1)), F.count_distinct("feature_row_id")).first()
        errors += ["feature_row_id is not unique"] if r[0] != r[1] else []
    return errors
