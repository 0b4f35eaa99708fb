"""Quote and trade streams from the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.normalize import JOIN_SAFE_HIGH, RESIDUAL_HIGH, RESIDUAL_LOW, signed_size

TRADE_TYPES = ("purchase", "click")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    k = F.get_json_object("props", "$.k").cast("long")
    ms = (us - F.pmod(us, F.lit(1000))) / 1000  # a floor, also before 1970
    return e.select("event_id", "event_type", F.concat(F.lit("S"), F.pmod("user_id", F.lit(4)).cast("string")).alias("symbol"), us.alias("us"), ms.cast("long").alias("ms"), "value", k.alias("k"))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the other types as normalised quotes; ``monotonic_ns`` is the event number."""
    e = _events(spark, sf_dir).where(~F.col("event_type").isin(*TRADE_TYPES))
    r = F.col("k") * 13 - 200
    return e.select(
        "symbol", F.col("ms").alias("time_msc_utc_ms"), F.col("ms").alias("quote_ms"), F.col("event_id").alias("monotonic_ns"), F.col("value").alias("mid"), (F.col("value") * 0.001).alias("spread_price"),
        F.col("k").alias("spread_points"), r.alias("residual_ms"), r.between(RESIDUAL_LOW, JOIN_SAFE_HIGH).alias("is_join_safe"), ((r < RESIDUAL_LOW) | (r > RESIDUAL_HIGH)).alias("is_latency_outlier"),
        (F.col("value") - F.col("value") * 0.0005).alias("bid"), (F.col("value") + F.col("value") * 0.0005).alias("ask"),
    )


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the trade types as reference trades."""
    e = _events(spark, sf_dir).where(F.col("event_type").isin(*TRADE_TYPES))
    side = F.element_at(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("UNKNOWN")), F.pmod("event_id", F.lit(3)).cast("int") + 1)
    size = 1 + F.pmod("event_id", F.lit(20))
    return e.select(
        "symbol", (F.col("us") * 1000).alias("event_time_utc_ns"), F.col("ms").alias("event_ms"), "event_id", F.col("value").alias("price"), size.alias("size"),
        side.alias("aggressor_side"), signed_size(side, size).alias("signed_size"), (F.col("value") > 0).alias("is_reference_trade_valid"),
    )
