import math
import uuid

import pytest
from pyspark.sql import functions as F

from tickloom.functions import exprs as X


def test_bucket_sizes():
    assert [X.bucket_size_ns(x) for x in ("250ms", "1m", "15s")] == [250_000_000, 60_000_000_000, 15_000_000_000]
    for bad in ("", "s", "0s", "-1s", "1x", "abc"):
        with pytest.raises(ValueError):
            X.bucket_size_ns(bad)
    assert X.bucket_sizes("1s,1s,5s") == [("1s", 10**9), ("5s", 5 * 10**9)]
    with pytest.raises(ValueError):
        X.bucket_sizes(",,")


def test_scalar_expressions(spark):
    t = 1_767_614_400_123_456_789
    df = spark.createDataFrame([(t, 1.0, 0.0), (-1, -1.0, 0.0), (7, 0.0, 0.0), (8, 6.0, 3.0)], "t long, a double, b double")
    rows = df.select(X.bucket_floor(F.col("t"), 10).alias("f"), X.ieee_div(F.col("a"), F.col("b")).alias("d"), X.scaled_price(F.col("a") / 2, 1).alias("s"), X.session_hour(F.col("t")).alias("h"), X.uuid5_url(F.concat(F.lit("x:"), F.col("t").cast("string"))).alias("u")).collect()
    assert [r.f for r in rows] == [t - t % 10, -10, 0, 0]
    assert rows[0].d == math.inf and rows[1].d == -math.inf and math.isnan(rows[2].d) and rows[3].d == 2.0
    assert [r.s for r in rows] == [0, 0, 0, 3]
    assert [r.u for r in rows] == [str(uuid.uuid5(uuid.NAMESPACE_URL, f"x:{v}")) for v in (t, -1, 7, 8)]
    assert rows[1].h == 0


def test_aggregates(spark):
    df = spark.createDataFrame([(float(x), None if x > 3 else 1.0) for x in (1, 2, 3, 4, 10, 50)], "x double, y double")
    r = df.agg(X.quantile_nearest(F.col("x"), 0.5).alias("q"), F.get(X.percentiles(F.col("x"), [0.95]), F.lit(0)).alias("p"), X.sum0(F.when(F.lit(False), F.col("x"))).alias("z"), X.safe_corr(F.col("x"), F.col("y")).alias("c")).first()
    assert (r.q, r.p, r.z, r.c) == (4.0, 40.0, 0.0, None)
