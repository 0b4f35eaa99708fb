"""Correlations of many columns and exact quantiles, against DuckDB and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import bars, gram, ranks, stats
from tickloom.plans import registry
from tickloom.plans.contract import CANDIDATES

SF = "/root/testdata/sf0.001"


def plain_corr(rows, a, b):
    both = [(r[a], r[b]) for r in rows if r[a] is not None and r[b] is not None and math.isfinite(r[a]) and math.isfinite(r[b])]
    if len(both) < 3 or len({x for x, _ in both}) == 1 or len({y for _, y in both}) == 1:
        return len(both), None
    x, y = (np.array(v) - v[0] for v in zip(*both, strict=True))
    return len(both), float(np.corrcoef(x, y)[0, 1])


def test_correlations_with_odd_values(spark, monkeypatch):
    """Nulls, NaN, infinities, constant columns, a large offset, null keys, and groups handed on early."""
    monkeypatch.setattr(gram, "HELD", 1)
    rng = random.Random(4)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    value = lambda f: rng.choice(odd) if rng.random() < 0.2 else f()
    rows = [(rng.choice(["a", "b", None]), value(lambda: rng.gauss(0, 1)), value(lambda: 1e9 + rng.random()), 7.0, value(lambda: 0.1), value(lambda: float(rng.randrange(3)))) for _ in range(3000)]
    rows += [("few", 1.0, 2.0, 3.0, None, 5.0), ("few", 2.0, 5.0, 3.0, None, 5.0)]
    names = ["v", "w", "same", "almost", "d"]
    df = spark.createDataFrame(rows, "g string, v double, w double, same double, almost double, d double").repartition(5)
    got = {(r.g, r.feature_a, r.feature_b): (r.n, r.r) for r in gram.correlations(df, ["g"], names).collect()}
    assert len(got) == 4 * 10
    for (g, a, b), (n, r) in got.items():
        want = plain_corr([x[1:] for x in rows if x[0] == g], names.index(a), names.index(b))
        assert n == want[0] and (r == pytest.approx(want[1], abs=1e-9) if want[1] is not None else r is None), (g, a, b)
    assert gram.correlations(df.where("false"), ["g"], names).count() == 0
    assert gram.correlations(df, [], names[:2]).count() == 1


def test_all_pairs_of_the_contract(spark, tmp_path):
    """666 pairs a group, from one scan, as DuckDB has them."""
    import duckdb

    registry.QUERIES["feature_table"](spark, SF).write.parquet(str(tmp_path / "gold"))
    gold = spark.read.parquet(str(tmp_path / "gold"))
    found = stats.correlation(gold, ["symbol_pair", "bucket_size"], CANDIDATES)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 2
    got = {(r.symbol_pair, r.bucket_size, r.feature_a, r.feature_b): (r.n, r.r) for r in found.collect()}
    assert len(got) == 666 * gold.select("symbol_pair", "bucket_size").distinct().count()
    ok = lambda c: f"({c} IS NOT NULL AND isfinite({c}::DOUBLE))"
    for k in range(0, 666, 97):
        a, b = sorted({(x, y) for _, _, x, y in got})[k]
        sql = f"SELECT symbol_pair, bucket_size, count(*) FILTER (WHERE {ok(a)} AND {ok(b)}), corr({a}::DOUBLE, {b}::DOUBLE) FILTER (WHERE {ok(a)} AND {ok(b)}) FROM '{tmp_path}/gold/*.parquet' GROUP BY ALL"
        for pair, size, n, r in duckdb.sql(sql).fetchall():
            mine = got[pair, size, a, b]
            assert mine[0] == n and (n < 3 or r is None or math.isnan(r) or mine[1] is None or mine[1] == pytest.approx(r, abs=1e-9))


@pytest.mark.parametrize("slice_rows", [10**9, 500, 7])
def test_quantiles_by_selection(spark, slice_rows):
    rng = random.Random(slice_rows)
    rows = [(rng.choice(["hot", "hot", "hot", "cold", None]), rng.choice([None, 1.0, 1.0, rng.random(), float(rng.randrange(5))])) for _ in range(6000)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r for r in ranks.nearest_quantiles(df, ["g"], "v", {"a": 0.0, "b": 0.5, "c": 0.95, "d": 1.0}, slice_rows).collect()}
    linear = {r.g: r for r in ranks.linear_quantiles(df, ["g"], "v", {"a": 0.01, "b": 0.5, "c": 0.99}, slice_rows).collect()}
    for g in ("hot", "cold", None, "one"):
        v = sorted(x for k, x in rows if k == g and x is not None)
        assert [got[g][n] for n in "abcd"] == [v[math.floor((len(v) - 1) * q + 0.5)] for q in (0, 0.5, 0.95, 1)]
        assert [linear[g][n] for n in "abc"] == pytest.approx([float(np.quantile(v, q)) for q in (0.01, 0.5, 0.99)])
    assert set(got) == {"hot", "cold", None, "one"}


def test_large_bars_have_the_same_rows(spark):
    """Bars whose quantiles come from counted values equal those made from lists."""
    from tickloom.sources.adapters import quotes, trades

    def same(a, b):
        a, b = (sorted(map(str, x.collect())) for x in (a, b.select(*a.columns)))
        assert a == b and len(a) > 100

    same(bars.trade_bars(trades(spark, SF), registry.SIZES, ["event_id"]), bars.trade_bars(trades(spark, SF), registry.SIZES, ["event_id"], large_bar=2))
    cut = [c for c in ("symbol", "bucket_size", "bucket_start_utc_ns", "tick_count", "spread_price_p50", "spread_price_p95", "spread_points_p50", "spread_points_p95", "residual_ms_p50", "residual_ms_p95")]
    same(bars.quote_bars(quotes(spark, SF), registry.SIZES, ["monotonic_ns"]).select(*cut), bars.quote_bars(quotes(spark, SF), registry.SIZES, ["monotonic_ns"], large_bar=3).select(*cut))


def test_distribution_of_groups_with_null_keys_and_odd_values(spark):
    rows = [(None if k % 5 == 0 else "g", None if k % 7 == 0 else float("nan") if k % 11 == 0 else float(k % 50) ** 2, 1.0) for k in range(400)]
    got = {(r.g, r.feature): r for r in stats.distribution(spark.createDataFrame(rows, "g string, v double, same double"), ["g"], ["v", "same"]).collect()}
    for g in (None, "g"):
        v = np.array([x for k, x, _ in rows if k == g and x is not None and math.isfinite(x)])
        r = got[g, "v"]
        assert (r.n, r.p25, r.p75, r.p99) == (len(v), *(pytest.approx(float(np.quantile(v, q))) for q in (0.25, 0.75, 0.99)))
        lo, hi = r.p25 - 1.5 * r.iqr, r.p75 + 1.5 * r.iqr
        assert r.outlier_rate == pytest.approx(float(((v < lo) | (v > hi)).mean()))
        assert got[g, "same"].outlier_rate is None and got[g, "same"].p50 == 1.0


def test_summary_of_correlations(spark):
    df = spark.range(50).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("a"), (F.col("id") * 2 + F.pmod("id", F.lit(3))).cast("double").alias("b"), F.lit(1.0).alias("c"))
    got = {(r.feature_a, r.feature_b): r for r in stats.correlation_summary(df, ["g"], ["a", "b", "c"]).collect()}
    assert got["a", "b"].is_statistically_significant and got["a", "b"].is_small_sample_warning and got["a", "b"].abs_correlation > 0.99
    assert not got["a", "c"].pvalue_available and not got["a", "c"].is_statistically_significant


def test_bounds_only_where_a_pair_may_be_constant(spark):
    """Pairs that vary for certain need no bounds; those that are constant, or nearly, keep the exact ones."""
    rng = np.random.default_rng(6)
    n = 400
    x = np.column_stack([rng.normal(1e9, 1, n), rng.random(n), np.full(n, 7.0), np.where(np.arange(n) < 5, 1e8, 0.1), 3 + 1e-12 * rng.random(n), np.full(n, np.nan)])
    x[:5, 1] = np.nan  # over the rows of this column the one with two values is constant
    m = gram.Moments.of(x)
    assert m.low[0, 1] == -np.inf and m.high[0, 1] == np.inf and m.low[1, 2] == -np.inf
    assert (m.low[2, 0], m.high[2, 0]) == (7.0, 7.0) and (m.low[3, 1], m.high[3, 1]) == (0.1, 0.1) and m.low[4, 0] < m.high[4, 0]
    assert m.low[0, 5] == np.inf and m.high[5, 0] == -np.inf
    r = m.merge(gram.Moments.of(x[::-1])).correlation()
    assert np.isnan(r[1, 3]) and np.isnan(r[0, 2]) and not np.isnan(r[0, 3]) and not np.isnan(r[0, 4])
    spark.conf.unset("spark.sql.codegen.hugeMethodLimit")
    gram.moments(spark.createDataFrame([(1.0, 2.0)], "a double, b double"), [], ["a", "b"])
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000  # what the JVM compiles at most


def test_rows_meet_bounds_beside_wanted_ranks_only(spark):
    """However many slices a group could have, a row meets two bounds a rank, and small groups none."""
    df = spark.range(5000).select(F.when(F.col("id") < 4990, "hot").alias("g"), (F.col("id") * 7919 % 5003).cast("double").alias("v"))
    sliced, bounds = ranks._sliced(df, ["g"], "v", {"a": ranks.nearest(0.01), "b": ranks.nearest(0.5)}, 20)
    assert len(bounds.columns) == 1 + 2 * 2 and bounds.count() == 1
    got = {(r.g, r["__slice"]): r["count"] for r in sliced.groupBy("g", "__slice").count().collect()}
    assert {s for g, s in got if g == "hot"} == set(range(5)) and got[None, 0] == 10
    assert got["hot", 1] < 100 and got["hot", 3] < 100  # the slices that hold the ranks
