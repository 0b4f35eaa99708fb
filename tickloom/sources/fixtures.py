"""Deterministic raw quotes and vendor trades for tests and demonstrations, made by Spark expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCENARIOS = ("normal", "invalid-timestamps", "crossed-quotes")
START_MS = 1_767_614_400_000  # 2026-01-05 12:00 UTC
PAIRS = {"ES": ("SPX500", 5000.0), "NQ": ("NDX100", 18000.0)}
OFFSET_MIN = 120


def _noise(seed: int, *by) -> F.Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(1_000_000)) / 1e6


def raw_quotes(spark: SparkSession, seconds: int, seed: int = 42, scenario: str = "normal") -> DataFrame:
    """Four quotes a second for each pair, on the broker's clock."""
    if scenario not in SCENARIOS or seconds % 60 or not 120 <= seconds <= 3600:
        raise ValueError("unknown scenario, or seconds not a multiple of 60 in 120..3600")
    rows = None
    for mapped, base in PAIRS.values():
        n = spark.range(seconds * 4).withColumn("symbol", F.lit(mapped))
        utc = F.lit(START_MS) + F.col("id") * 250
        mid = F.lit(base) + F.sin(F.col("id") / 40.0) * base * 0.0005 + (_noise(seed, "symbol", "id") - 0.5) * base * 0.00002
        half = F.lit(base * 0.00002)
        crossed = F.lit(scenario == "crossed-quotes") & (F.col("id") % 5 == 0)
        one = n.select(
            "symbol", (utc + OFFSET_MIN * 60_000).alias("time_msc_raw"), (utc + 5 + F.floor(_noise(seed + 1, "symbol", "id") * 20).cast("long")).alias("recv_time_utc_ms"), (F.col("id") * 250_000_000).alias("monotonic_ns"),
            F.round(mid - half, 4).alias("bid"), F.when(crossed, F.round(mid - 2 * half, 4)).otherwise(F.round(mid + half, 4)).alias("ask"), F.lit(4).cast("long").alias("spread_points"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def vendor_trades(spark: SparkSession, seconds: int, seed: int = 42) -> DataFrame:
    """A trade 30 ms after each quote except every seventh."""
    rows = None
    for ticker, (_, base) in PAIRS.items():
        n = spark.range(seconds * 4).where("id % 7 != 0").withColumn("raw_symbol", F.lit(f"{ticker}H6"))
        t = (F.lit(START_MS) + F.col("id") * 250 + 30) * 1_000_000
        one = n.select(
            "raw_symbol", t.alias("ts_event"), (t + 1_000_000).alias("ts_recv"), F.lit("T").alias("action"), F.element_at(F.array(F.lit("B"), F.lit("A"), F.lit("N")), F.when(F.col("id") % 11 == 0, 3).otherwise(F.col("id") % 2 + 1).cast("int")).alias("side"),
            F.round(F.lit(base) + F.sin(F.col("id") / 40.0) * base * 0.0005 + (_noise(seed + 2, "raw_symbol", "id") - 0.5) * base * 0.00002, 2).alias("price"), (1 + F.floor(_noise(seed + 3, "raw_symbol", "id") * 9)).cast("long").alias("size"),
        )
        rows = one if rows is None else rows.unionByName(one)
    return rows


def tick_pattern(spark: SparkSession, pattern: str, n: int, step_ms: int = 10) -> DataFrame:
    """Synthetic ticks: normal, duplicate_burst, stale_burst, reconnect_gap or monday_open."""
    i = F.col("id")
    moves = {"normal": i, "duplicate_burst": F.lit(0), "stale_burst": F.floor(i / 50), "reconnect_gap": i, "monday_open": i * i}
    if pattern not in moves:
        raise ValueError(f"unknown pattern {pattern!r}")
    gap = F.when(i >= n // 2, 60_000).otherwise(0) if pattern == "reconnect_gap" else F.lit(0)
    t = F.lit(START_MS) + i * step_ms + gap
    price = F.pmod(moves[pattern].cast("long"), F.lit(1000))
    return spark.range(n).select(F.lit("SPX500").alias("symbol"), t.cast("long").alias("time_msc"), (t + 5).cast("long").alias("recv_ms"), (price + 500_000).alias("bid_scaled"), (price + 500_010).alias("ask_scaled"))
