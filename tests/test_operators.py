import bisect
import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import asof, bars, export, features, normalize, quality, stats, ticks
from tickloom.plans import contract

S = 10**9


def _trades(spark, rows):
    return spark.createDataFrame([("ES", t, p, s, a, v) for t, p, s, a, v in rows], "symbol string, event_time_utc_ns long, price double, size long, aggressor_side string, is_reference_trade_valid boolean")


def _quotes(spark, rows):
    return spark.createDataFrame([("Q", t, safe, m, 0.5, 5, 10, False) for t, m, safe in rows], "symbol string, time_msc_utc_ms long, is_join_safe boolean, mid double, spread_price double, spread_points long, residual_ms long, is_latency_outlier boolean")


def test_trade_bars(spark):
    b = bars.trade_bars(_trades(spark, [(1, 100.0, 1, "BUY", True), (2, 200.0, 9, "SELL", True), (3, 5.0, 7, "BUY", False)]), [("1s", S)]).first()
    assert (b.vwap, b.trade_count, b.total_volume, b.net_signed_volume, b.first_trade_price, b.last_trade_price) == (190.0, 2, 10, -8, 100.0, 200.0)
    b = bars.trade_bars(_trades(spark, [(1, 1.0, 5, "BUY", True), (2, 1.0, 3, "SELL", True), (3, 1.0, 2, "UNKNOWN", True)]), [("1s", S)]).first()
    assert (b.net_signed_volume, b.total_volume, b.signed_volume_ratio) == (2, 10, 0.2)
    b = bars.trade_bars(_trades(spark, [(k, 1.0, s, "BUY", True) for k, s in enumerate((1, 1, 2, 5, 100))]), [("1s", S)]).first()
    assert b.max_single_trade_volume == 100 and b.trade_size_mean == 21.8 and b.trade_size_p99 >= 60


@pytest.mark.parametrize(("ticks_", "twap", "mean"), [([(0, 1.0), (100, 2.0), (900, 3.0)], 2.0, 2.0), ([(0, 1.0), (900, 10.0)], 1.9, 5.5), ([(500, 7.5)], 7.5, 7.5)])
def test_twap(spark, ticks_, twap, mean):
    b = bars.quote_bars(_quotes(spark, [(t, m, True) for t, m in ticks_]), [("1s", S)]).first()
    assert b.mid_twap == pytest.approx(twap) and b.mid_mean == pytest.approx(mean)


def _plain_asof(events, quotes, tolerance):
    """Each event against the quotes up to it, read backwards."""
    times = [q[0] for q in quotes]
    out = {}
    for i, t in events:
        k = bisect.bisect_right(times, t)
        if not quotes:
            out[i] = (None, "no_mt5_rows_for_symbol")
        elif not k:
            out[i] = (None, "no_prior_quote")
        else:
            near = [q for q in quotes[:k] if t - q[0] <= tolerance]
            safe = [q for q in near if q[2]]
            out[i] = (safe[-1][1], None) if safe else (None, "mt5_not_join_safe" if near else "outside_tolerance")
    return out


def test_asof_against_brute_force(spark):
    rng = random.Random(3)
    q = sorted((rng.randrange(0, 400_000), k, rng.random() < 0.3) for k in range(800))
    e = [(k, rng.randrange(-5000, 420_000)) for k in range(1500)]
    qd = spark.createDataFrame([("A", t, k, s) for t, k, s in q], "symbol string, quote_ms long, n long, is_join_safe boolean")
    ed = spark.createDataFrame([("A", t, k) for k, t in e], "symbol string, event_ms long, k long")
    want = _plain_asof(e, q, 700)
    for slice_ms in (10_000_000, 3_000):
        got = asof.asof_match(ed, qd, 700, tie=["n"], slice_ms=slice_ms, fields=["n"]).collect()
        assert {r.k: (r.quote_n, r.reason) for r in got} == want
    got = asof.asof_match(ed, qd.where("false"), 700, fields=["n"]).select("reason").distinct().collect()
    assert [r.reason for r in got] == ["no_mt5_rows_for_symbol"]
    with pytest.raises(ValueError):
        asof.asof_match(ed, qd, 0)


def test_asof_edges(spark):
    qd = spark.createDataFrame([("A", 1000, True)], "symbol string, quote_ms long, is_join_safe boolean")
    ed = spark.createDataFrame([("A", 1050), ("A", 1051), ("A", 999), ("A", 1000)], "symbol string, event_ms long")
    got = {r.event_ms: r.reason for r in asof.asof_match(ed, qd, 50, fields=[]).collect()}
    assert got == {1050: None, 1051: "outside_tolerance", 999: "no_prior_quote", 1000: None}


def _joined(spark, closes, mids):
    rows = [(f"{k}", k * 15 * S, (k + 1) * 15 * S, c, m) for k, (c, m) in enumerate(zip(closes, mids, strict=True))]
    d = spark.createDataFrame(rows, "x string, bucket_start_utc_ns long, bucket_end_utc_ns long, cme_last_trade_price double, mt5_mid_last double")
    fixed = {"date": "2026-01-05", "cme_symbol": "ES", "mt5_symbol": "SPX500", "symbol_pair": "ES_SPX500", "bucket_size": "15s"}
    d = d.withColumns({k: F.lit(v) for k, v in fixed.items()}).withColumns({"has_cme_data": F.lit(True), "has_mt5_data": F.lit(True), "mt5_join_safe_tick_ratio": F.lit(1.0), "mt5_tick_count": F.lit(4).cast("long"), "cme_trade_count": F.lit(3).cast("long")})
    zero = ["cme_total_volume", "cme_buy_volume", "cme_sell_volume", "cme_unknown_aggressor_volume"]
    prices = ["cme_vwap", "mt5_mid_twap", "cme_first_trade_price", "cme_high_trade_price", "cme_low_trade_price", "mt5_mid_first", "mt5_mid_max", "mt5_mid_min", "mt5_spread_price_p95", "mt5_spread_price_max"]
    unused = ["mt5_mid_mean", "cme_net_signed_volume", "cme_signed_volume_ratio", "cme_max_single_trade_volume", "cme_trade_size_p99", "cme_trade_size_mean", "cme_trade_size_std", "mt5_spread_price_mean", "mt5_spread_price_p50"]
    unused += ["mt5_spread_points_mean", "mt5_spread_points_p95", "mt5_spread_points_max", "mt5_residual_ms_p50", "mt5_residual_ms_p95", "mt5_residual_ms_max"]
    return d.withColumns({c: F.lit(10).cast("long") for c in zero}).withColumns({c: F.lit(100.0) for c in prices}).withColumns({c: F.lit(None).cast("double") for c in unused})


def test_features_need_all_columns(spark):
    with pytest.raises(ValueError, match="mt5_mid_mean"):
        features.build_features(_joined(spark, [100.0], [95.0]).drop("mt5_mid_mean"))


def test_features(spark):
    f = features.build_features(_joined(spark, [100.0, 101.0, 102.0], [95.0, 90.0, 91.0])).orderBy("bucket_start_utc_ns").collect()
    assert [r.cme_return_close_to_close for r in f] == [None, pytest.approx(0.01), pytest.approx(1 / 101)]
    assert [r.basis_change for r in f][:2] == [None, -6.0]
    assert len({r.feature_row_id for r in f}) == 3 and all(r.is_model_eligible_candidate for r in f)
    assert list(f[0].asDict()) == list(contract.ALL) and len(contract.ALL) == 74
    bad = features.build_features(_joined(spark, [0.0, 5.0], [1.0, 1.0])).orderBy("bucket_start_utc_ns").collect()
    assert bad[0].feature_quality_flag == "INVALID_PRICE" and bad[1].cme_return_close_to_close == float("inf")


def test_contract_columns():
    held = [c for names in contract.ROLES.values() for c in names]
    assert sorted({c for c in held if held.count(c) > 1}) == ["mt5_join_safe_tick_ratio"]  # a quality column that is a candidate too
    assert {"cme_vwap", "mt5_mid_twap"} <= set(contract.NON_FEATURE) and not set(contract.FORBIDDEN) & set(held)


def test_time_in_whole_milliseconds(spark):
    ns = [1767614400000999900, 1767614400000999999, 1767614400001000000, -1, -1_000_000, 0, None]
    from tickloom.functions.exprs import ns_to_ms

    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(ns)], "k long, t long").orderBy("k").select(ns_to_ms(F.col("t"))).collect()]
    assert got == [None if t is None else t // 1_000_000 for t in ns]


def test_invalid_trades_are_never_matched(spark):
    t = spark.createDataFrame([("A", 100, 1, True), ("A", 101, 2, False), ("A", None, 3, True), ("A", 102, 4, None)], "symbol string, event_ms long, k long, is_reference_trade_valid boolean")
    q = spark.createDataFrame([("A", 90, True)], "symbol string, quote_ms long, is_join_safe boolean")
    got = {r.k: (r.is_matched, r.reason, r.newest_safe_age_ms) for r in asof.asof_match(t, q, 50, fields=[]).collect()}
    lost = (False, "missing_required_columns", None)
    assert got == {1: (True, None, 10), 2: lost, 3: lost, 4: lost}


def test_full_tables(spark):
    v = spark.createDataFrame([(1, 9, "ESH6", "T", "B", 10.0, 2, 9.5, 10.5), (2, 9, "XX", "T", "A", 1.0, 1, 0.5, 1.0), (3, 9, "ESM6", "A", "A", 1.0, 1, None, 1.0), (4, 9, "ESH6", "T", "N", 0.0, 1, None, 1.0)], "ts_event long, ts_recv long, raw_symbol string, action string, side string, price double, size int, bid_px_00 double, ask_px_00 double")
    t = normalize.normalize_trades(v, ["ES"], ingest_date="2026-01-05", vendor="v")
    assert t.dtypes == [(f.name, f.dataType.simpleString()) for f in spark.createDataFrame([], normalize.TRADE_SCHEMA).schema] and len(t.columns) == 34
    r = t.orderBy("ts_event").collect()
    assert [(x.receive_time_utc_ns, x.spread, x.mid, x.is_aggressor_known, x.is_bbo_available, x.is_reference_trade_valid, x.vendor, x.bid_sz_00) for x in r] == [(9, 1.0, 10.0, True, True, True, "v", None), (9, None, None, False, True, False, "v", None)]
    assert normalize.ingest_counts(v, ["ES"]) == {"read": 4, "kept": 2, "rejected": 2, "unknown_side": 1}
    q = spark.createDataFrame([("Q", 7_200_000, 40, 1.0, 2.0, 3, 10, 20)], "symbol string, time_msc_raw long, recv_time_utc_ms long, bid double, ask double, spread_points int, bid_scaled long, ask_scaled long")
    s = normalize.quote_table(normalize.normalize_quotes(q, 120), "2026-01-05", {"broker_server": "b", "path": "p"})
    assert len(s.columns) == 35 and s.first().asDict() | {"mid": 1.5} == s.first().asDict()
    assert (s.first().source_date, s.first().source_hour, s.first().broker_server, s.first().data_layer, s.first().is_spread_valid, s.first().last) == ("2026-01-05", 0, "b", "silver", True, None)


def test_overlap_of_bars_and_ticks(spark):
    b = spark.createDataFrame([("A", k * 10, k * 10 + 10) for k in range(5)] + [("B", 0, 10)], "symbol string, bucket_start_utc_ns long, bucket_end_utc_ns long")
    a = spark.createDataFrame([("A", 10), ("A", 35), ("B", 1)], "symbol string, t long")
    w = features.overlap_window(a, "t", spark.createDataFrame([("A", 5), ("A", 30)], "symbol string, t long"), "t", ["symbol"])
    assert sorted((r.symbol, r.bucket_start_utc_ns) for r in features.in_overlap(b, w, ["symbol"]).collect()) == [("A", 10), ("A", 20), ("A", 30), ("B", 0)]
    assert sorted((r.symbol, r.t) for r in features.ticks_in_overlap(a, "t", w, ["symbol"]).collect()) == [("A", 10), ("B", 1)]


def test_normalize(spark):
    q = spark.createDataFrame([(7_200_000 + 1000, 1040, 100.0, 100.5), (7_200_000, 2000, 100.5, 100.0)], "time_msc_raw long, recv_time_utc_ms long, bid double, ask double")
    r = normalize.normalize_quotes(q, 120).orderBy("recv_time_utc_ms").collect()
    assert [(x.time_msc_utc_ms, x.residual_ms, x.is_join_safe, x.is_latency_outlier, x.is_bid_ask_valid) for x in r] == [(1000, 40, True, False, True), (0, 2000, False, True, False)]
    with pytest.raises(ValueError):
        normalize.normalize_quotes(q, None)
    with pytest.raises(normalize.VendorSchemaError, match="side, price, size, symbol"):
        normalize.bind_vendor_columns(["ts_event", "action"])
    assert normalize.iso_to_ms("2026-01-05T12:00:00") == 1767614400000 and normalize.iso_to_ms("x") is None
    v = spark.createDataFrame([(1, "ESH6", "T", "B", 10.0, 2), (2, "NQH6", "T", "A", 10.0, 3), (3, "ESH6", "A", "B", 1.0, 1), (4, "ESH6", "T", None, 1.0, 1)], "ts_event long, raw_symbol string, action string, side string, price double, size long")
    t = normalize.normalize_trades(v, ["ES"]).orderBy("event_time_utc_ns").collect()
    assert [(x.symbol, x.aggressor_side, x.signed_size) for x in t] == [("ES", "BUY", 2.0), ("ES", "UNKNOWN", None)]
    with pytest.raises(normalize.VendorSchemaError):
        normalize.to_ns(spark.sql("select timestamp_ntz'2026-01-05 00:00:00' as t"), "t")


def test_gates():
    ok = {"rows": 10, "crossed": 0, "negative_spread": 0, "join_safe_pct": 90, "outlier_pct": 0, "spread_price_max": 1}
    assert quality.decide_telemetry({"A": ok}, ["A"]) == "PASS"
    assert quality.decide_telemetry({"A": ok}, ["B"]) == "FAIL"
    assert quality.decide_telemetry({"A": ok | {"crossed": 1}}, ["A"]) == "FAIL"
    assert quality.decide_telemetry({"A": ok | {"join_safe_pct": 40}}, ["A"]) == "PARTIAL"
    assert quality.decide_alignment({"A": "OK"}, 0.9, 0.1) == "PASS" and quality.decide_alignment({"A": "OK"}, 0.4, 0.1) == "PARTIAL" and quality.decide_alignment({"A": "overlap"}, None, None) == "FAIL"
    good = {"alignment_rate": 0.9, "aligned_volume_ratio": 0.9}
    assert quality.decide_bars({("A", "5s"): good}, ["A"], {"5s": 5 * S}) == "PASS" and quality.decide_bars({("A", "1s"): good}, ["A"], {"1s": S}) == "PARTIAL"
    assert quality.decide_eda(True, 10, 10, {"p": 1}) == "PARTIAL" and quality.decide_eda(True, 9000, 6000, {"p": 1}) == "PASS"


def test_statistics(spark):
    inf = float("inf")
    d = spark.createDataFrame([("g", x) for x in (1.0, inf, -inf, float("nan"), 2.0, None)], "g string, x double")
    m = stats.missingness(d, ["g"], ["x"]).first()
    assert (m.finite_count, m.inf_count, m.nan_count, m.nulls, m.distinct_count) == (2, 2, 1, 1, 6)
    d = spark.createDataFrame([("g", float(x)) for x in range(1, 6)], "g string, x double")
    r = stats.distribution(d, ["g"], ["x"]).first()
    assert (r.p25, r.p50, r.p75, r.iqr, r.sample_size_warning) == (2.0, 3.0, 4.0, 2.0, True)
    assert stats.pearson_p(0.5, 2) is None and stats.pearson_p(1.0, 9) == 0.0
    assert stats.pearson_p(0.5, 20) == pytest.approx(0.02477, abs=1e-4)


def test_tick_dedup(spark):
    rows = [("A", 300 * k, 300 * k + 5, 7) for k in range(20)]
    d = spark.createDataFrame(rows, "symbol string, time_msc long, recv_ms long, v long")
    got = ticks.dedup_ticks(d, ["symbol"], "time_msc", ["v"], "recv_ms").orderBy("time_msc").collect()
    assert [r.time_msc // 300 for r in got] == [0, 4, 8, 12, 16] and got[1].suppressed_count == 3
    s = ticks.TickState()
    assert sum(s.offer(k, (1,), k) is not None for k in range(200)) == 1 and s.count == 199


def test_offset_calibration():
    s = ticks.OffsetState((-300, -240, 0, 60, 120, 180), required=20)
    for k in range(20):
        s.observe(120 * 60_000 + 1000 * k, 1000 * k + 40)
    assert s.status == ticks.OFFSET_VERIFIED and s.verified == 120
    assert s.tick_clock(19_040 + 30_000) == ticks.DOWNGRADED and s.cached == 120
    assert s.tick_clock(19_040 + 300_000) == ticks.MARKED_UNSAFE and s.status == ticks.UNSAFE
    s.observe(180 * 60_000 + 400_000, 400_040)
    assert s.status == ticks.PENDING
    events = [s.observe(180 * 60_000 + 400_000 + 1000 * k, 400_040 + 1000 * k) for k in range(1, 20)]
    assert events[-1] == "DST_SHIFT_DETECTED" and s.verified == 180


def test_export_refuses(spark):
    f = features.build_features(_joined(spark, [100.0, 101.0], [95.0, 90.0]))
    with pytest.raises(export.ExportError):
        export.export_rows(f, -1)
    assert export.export_rows(f, 10**18).count() == 2
    with pytest.raises(export.ExportError, match="not unique"):
        export.export_rows(f.union(f), 10**18)
    zero = features.build_features(_joined(spark, [100.0, 101.0], [0.0, 90.0]))
    with pytest.raises(export.ExportError, match="not finite"):
        export.export_rows(zero, 10**18)


def test_dataset_and_its_contract(spark, tmp_path):
    f = features.build_features(_joined(spark, [100.0, 101.0], [95.0, 90.0]))
    made = export.export_dataset(f, str(tmp_path / "d"), 10**18, origin="test")
    assert made == json.loads((tmp_path / "d" / "dataset_contract.json").read_text()) and made["rows"] == 2
    assert made["feature_columns"] == list(contract.CANDIDATES) and made["feature_dtypes"]["cme_trade_count"] == "bigint" and made["label_columns"] == []
    assert spark.read.parquet(str(tmp_path / "d" / "model_features.parquet")).columns == [*contract.IDENTITY, *contract.CANDIDATES, "data_origin"]
    with pytest.raises(FileExistsError):
        export.export_dataset(f, str(tmp_path / "d"), 10**18)


