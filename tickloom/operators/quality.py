"""Quality metrics by one aggregate each, and the pure decisions PASS, PARTIAL, FAIL made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exprs import percentiles

PASS, PARTIAL, FAIL = "PASS", "PARTIAL", "FAIL"
SUMMARY = (0.5, 0.95, 0.99)


def _n(c) -> F.Column:
    return F.sum(F.when(c, 1).otherwise(0))


def summary(x: str) -> list:
    """min, mean, p50, p95, p99 and max without nulls and NaN, percentiles linear."""
    v = F.when(~F.isnan(F.col(x).cast("double")), F.col(x).cast("double"))
    p = percentiles(v, SUMMARY)
    return [F.min(v).alias(f"{x}_min"), F.avg(v).alias(f"{x}_mean"), *[F.get(p, F.lit(k)).alias(f"{x}_p{round(100 * q)}") for k, q in enumerate(SUMMARY)], F.max(v).alias(f"{x}_max")]


def telemetry_metrics(quotes: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    out = quotes.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), _n(F.col("ask") < F.col("bid")).alias("crossed"), _n(F.col("spread_price") < 0).alias("negative_spread"), _n(F.col("is_join_safe")).alias("join_safe"), _n(F.col("is_latency_outlier")).alias("outliers"),
        *summary("spread_price"), *summary("residual_ms"),
    )
    return out.withColumns({"join_safe_pct": 100.0 * F.col("join_safe") / F.col("rows"), "outlier_pct": 100.0 * F.col("outliers") / F.col("rows")})


def reference_metrics(trades: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    return trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), _n(F.col("is_reference_trade_valid")).alias("valid"), _n(F.col("aggressor_side") == "UNKNOWN").alias("unknown_side"), _n(~F.coalesce("is_reference_trade_valid", F.lit(False))).alias("invalid"),
        F.min("event_time_utc_ns").alias("first_ns"), F.max("event_time_utc_ns").alias("last_ns"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("<null>")).alias("value")).agg(F.count(F.lit(1)).alias("n"))


def decide_telemetry(metrics: Mapping[str, Mapping], required: Sequence[str], spread_limits: Mapping[str, float] | None = None, unreadable: int = 0, ambiguous: bool = False) -> str:
    """``metrics`` by symbol, as ``telemetry_metrics`` gives them."""
    if unreadable or ambiguous or any(s not in metrics or not metrics[s]["rows"] for s in required):
        return FAIL
    if any(m["crossed"] or m["negative_spread"] or m.get("crossed_scaled") for m in metrics.values()):
        return FAIL
    limits = spread_limits or {}
    warned = any(m["join_safe_pct"] < 50 or m["outlier_pct"] > 5 or (s in limits and (m["spread_price_max"] or 0) > limits[s]) for s, m in metrics.items())
    return PARTIAL if warned else PASS


def decide_reference(rows: int, trade_rows: int, by_symbol: Mapping[str, Mapping], required: Sequence[str], schema_ok: bool = True, readable: bool = True, truncated: bool = False, missing_bbo: int = 0) -> str:
    if not rows or not schema_ok or not trade_rows or not readable or not any(by_symbol.get(s, {}).get("rows") for s in required):
        return FAIL
    unknown = any(m["rows"] and m["unknown_side"] / m["rows"] > 0.25 for m in by_symbol.values())
    missing = any(not by_symbol.get(s, {}).get("rows") for s in required)
    return PARTIAL if truncated or missing or unknown or missing_bbo else PASS


def decide_alignment(statuses: Mapping[str, str], match_rate: float | None, unmatched_volume_ratio: float | None, truncated: bool = False) -> str:
    """``statuses`` by symbol: OK, or what is missing (cme, mt5, columns, overlap)."""
    if not any(s == "OK" for s in statuses.values()):
        return FAIL
    weak = match_rate is None or match_rate < 0.5 or (unmatched_volume_ratio or 0) > 0.5
    return PARTIAL if weak or truncated or any(s != "OK" for s in statuses.values()) else PASS


def decide_bars(metrics: Mapping[tuple[str, str], Mapping], symbols: Sequence[str], bucket_ns: Mapping[str, int]) -> str:
    """PASS iff one bucket of 5 s or more has rate and volume ratio of at least 0.8 for all symbols; FAIL without bars."""
    if not metrics:
        return FAIL
    good = lambda m: m is not None and (m["alignment_rate"] or 0) >= 0.8 and (m["aligned_volume_ratio"] or 0) >= 0.8
    return PASS if any(ns >= 5_000_000_000 and all(good(metrics.get((s, b))) for s in symbols) for b, ns in bucket_ns.items()) else PARTIAL


def decide_features(errors: Sequence[str], rows: Mapping[tuple[str, str], Mapping], pairs: Sequence[str], buckets: Sequence[str] = ("15s", "60s")) -> str:
    """FAIL with errors or without rows of a required pair; PASS if each required pair has eligible rows in one of the required sizes."""
    of = lambda p, what, among=None: sum(m[what] or 0 for (q, b), m in rows.items() if q == p and (among is None or b in among))
    if errors or not any(of(p, "rows") for p in pairs):
        return FAIL
    return PASS if all(of(p, "rows") and of(p, "eligible", buckets) for p in pairs) else PARTIAL


def decide_eda(contract_ok: bool, rows: int, eligible: int, by_pair: Mapping[str, int], least: int = 5000) -> str:
    if not contract_ok or not rows:
        return FAIL
    return PARTIAL if eligible < least or any(not n for n in by_pair.values()) else PASS
