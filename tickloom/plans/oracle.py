"""DuckDB SQL for the queries of ``registry``, built from shared table expressions."""

from __future__ import annotations

from itertools import combinations

FEATURE_SUBSET = ("cme_trade_count", "cme_total_volume", "cme_buy_volume_ratio", "cme_max_single_trade_volume", "mt5_spread_points_max", "mt5_tick_count")
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

#: Columns derived from ``lineitem`` with nulls, NaN, infinities and one constant, in SQL of both engines.
WIDE = {
    f"f{k:02d}": f"CASE WHEN (l_orderkey + {k}) % {5 + k % 7} = 0 THEN NULL WHEN (l_orderkey * 3 + {k}) % 101 = 0 THEN CAST('NaN' AS DOUBLE) WHEN (l_orderkey + l_linenumber) % 97 = {k} THEN CAST('Infinity' AS DOUBLE) "
    f"ELSE CAST({('l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'l_partkey')[k % 5]} AS DOUBLE) * {1 + k % 3} + (l_partkey * {k + 1}) % 13 END"
    for k in range(36)
} | {"f36": "CAST(7 AS DOUBLE)"}

_E = """
e AS (SELECT event_id, event_type, 'S' || (user_id % 4) AS symbol, epoch_us(ts) AS us, epoch_us(ts) // 1000 AS ms, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
q AS (SELECT *, k * 13 - 200 AS r, (k * 13 - 200) BETWEEN -250 AND 50 AS safe, ((k * 13 - 200) < -250 OR (k * 13 - 200) > 1000) AS outlier FROM e WHERE event_type NOT IN ('purchase', 'click')),
t AS (SELECT *, us * 1000 AS ns, 1 + event_id % 20 AS size, CASE event_id % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'UNKNOWN' END AS side, value > 0 AS valid FROM e WHERE event_type IN ('purchase', 'click')),
z AS (SELECT * FROM (VALUES ('6h', 21600000000000), ('1d', 86400000000000)) v(bucket_size, n))"""
_NEAR = "list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))[CAST(floor((count({x}) - 1) * {q} + 0.5) AS BIGINT) + 1]"


def _near(x: str, q: float) -> str:
    return _NEAR.format(x=x, q=q)


_TB = f"""
tb AS (SELECT symbol, bucket_size, ns // n * n AS s, ns // n * n + n AS f, count(*) AS trade_count, CAST(sum(size) AS BIGINT) AS total_volume,
  CAST(coalesce(sum(size) FILTER (WHERE side = 'BUY'), 0) AS BIGINT) AS buy_volume, CAST(coalesce(sum(size) FILTER (WHERE side = 'SELL'), 0) AS BIGINT) AS sell_volume,
  CAST(coalesce(sum(size) FILTER (WHERE side = 'UNKNOWN'), 0) AS BIGINT) AS unknown_volume, count(*) FILTER (WHERE side = 'BUY') AS buy_trade_count,
  sum(value * size) / sum(size) AS vwap, arg_min(value, ns) AS first_price, arg_max(value, ns) AS last_price, max(value) AS high, min(value) AS low,
  max(size) AS max_size, CAST({_near('size', 0.99)} AS DOUBLE) AS p99, avg(size) AS mean_size, stddev_samp(size) AS std_size
  FROM t, z WHERE valid GROUP BY ALL)"""
_QB = f"""
qw AS (SELECT *, ms * 1000000 // n * n AS s, ms * 1000000 // n * n + n AS f FROM q, z),
qx AS (SELECT *, greatest(coalesce(lead(ms) OVER (PARTITION BY symbol, bucket_size, s ORDER BY ms, event_id) * 1000000, f) - ms * 1000000, 0) AS w FROM qw),
qb AS (SELECT symbol, bucket_size, s, f, count(*) AS tick_count, count(*) FILTER (WHERE safe) AS safe_count, count(*) FILTER (WHERE safe) / count(*) AS safe_ratio,
  arg_min(value, ms) AS mid_first, arg_max(value, ms) AS mid_last, min(value) AS mid_min, max(value) AS mid_max, avg(value) AS mid_mean,
  CASE WHEN sum(w) > 0 THEN sum(value * w) / sum(w) ELSE avg(value) END AS twap,
  min(value * 0.001) AS sp_min, avg(value * 0.001) AS sp_mean, max(value * 0.001) AS sp_max, min(k) AS k_min, max(k) AS k_max,
  CAST({_near('k', 0.5)} AS DOUBLE) AS k50, CAST({_near('k', 0.95)} AS DOUBLE) AS k95, CAST({_near('r', 0.5)} AS DOUBLE) AS r50, CAST({_near('r', 0.95)} AS DOUBLE) AS r95, max(r) AS r_max, count(*) FILTER (WHERE outlier) AS outliers
  FROM qx GROUP BY ALL)"""
_J = """
j AS (SELECT coalesce(tb.symbol, qb.symbol) AS symbol, coalesce(tb.bucket_size, qb.bucket_size) AS bucket_size, coalesce(tb.s, qb.s) AS s, coalesce(tb.f, qb.f) AS f,
  tb.s IS NOT NULL AS has_cme, qb.s IS NOT NULL AS has_mt5, tb.* EXCLUDE (symbol, bucket_size, s, f), qb.* EXCLUDE (symbol, bucket_size, s, f)
  FROM tb FULL JOIN qb ON tb.symbol = qb.symbol AND tb.bucket_size = qb.bucket_size AND tb.s = qb.s)"""
_G = """
g0 AS (SELECT *, symbol || '_' || symbol AS symbol_pair, mid_last - last_price AS basis, CASE WHEN last_price > 0 THEN (mid_last - last_price) / last_price * 10000 END AS basis_bps,
  CASE WHEN low > 0 THEN (high - low) / low * 10000 END AS cme_range, CASE WHEN mid_min > 0 THEN (mid_max - mid_min) / mid_min * 10000 END AS mid_range,
  CASE WHEN NOT has_cme THEN 'MISSING_CME' WHEN NOT has_mt5 THEN 'MISSING_MT5' WHEN total_volume <= 0 OR tick_count <= 0 THEN 'ZERO_VOLUME'
       WHEN last_price IS NULL OR mid_last IS NULL OR last_price <= 0 THEN 'INVALID_PRICE' WHEN safe_ratio < 0.1 THEN 'LOW_JOIN_SAFE_RATIO' ELSE 'OK' END AS flag,
  CASE WHEN NOT has_cme THEN 'no_cme_data' WHEN NOT has_mt5 THEN 'no_mt5_data' WHEN total_volume <= 0 THEN 'zero_cme_volume' WHEN tick_count <= 0 THEN 'zero_mt5_ticks'
       WHEN safe_ratio < 0.1 THEN 'low_join_safe_tick_ratio' WHEN last_price IS NULL OR mid_last IS NULL OR last_price <= 0 THEN 'invalid_price' ELSE '' END AS reason FROM j),
g AS (SELECT *, flag = 'OK' AS eligible, last_price - lag(last_price) OVER w AS dl, lag(last_price) OVER w AS pl, mid_last - lag(mid_last) OVER w AS dm, lag(mid_last) OVER w AS pm, basis - lag(basis) OVER w AS basis_change,
  {z} FROM g0 WINDOW w AS (PARTITION BY symbol_pair, bucket_size ORDER BY s), w20 AS (PARTITION BY symbol_pair, bucket_size ORDER BY s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))"""
_G = _G.replace("{z}", ", ".join(f"CASE WHEN count({c}) OVER w20 >= 2 AND stddev_samp({c}) OVER w20 > 0 THEN ({c} - avg({c}) OVER w20) / stddev_samp({c}) OVER w20 END AS z_{c}" for c in ("total_volume", "trade_count", "tick_count")))
_M = """
lastq AS (SELECT t.*, a.ms AS any_ms, b.ms AS safe_ms, b.value AS safe_mid FROM t ASOF LEFT JOIN q a ON t.symbol = a.symbol AND t.ms >= a.ms ASOF LEFT JOIN (SELECT * FROM q WHERE safe) b ON t.symbol = b.symbol AND t.ms >= b.ms),
m AS (SELECT *, coalesce(ms - safe_ms <= 1800000, false) AS hit, ms - safe_ms AS age,
  CASE WHEN coalesce(ms - safe_ms <= 1800000, false) THEN NULL WHEN symbol NOT IN (SELECT symbol FROM q) THEN 'no_mt5_rows_for_symbol' WHEN any_ms IS NULL THEN 'no_prior_quote' WHEN ms - any_ms <= 1800000 THEN 'mt5_not_join_safe' ELSE 'outside_tolerance' END AS reason FROM lastq)"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join([_E, *parts]) + "\n" + select


def _gold(select: str) -> str:
    return _with(_TB, _QB, _J, _G, select=select)


_KEY = "symbol_pair, bucket_size, s AS bucket_start_utc_ns"
_COLS = {"cme_trade_count": "trade_count", "cme_total_volume": "total_volume", "cme_buy_volume_ratio": "buy_volume / total_volume", "cme_max_single_trade_volume": "max_size", "mt5_spread_points_max": "k_max", "mt5_tick_count": "tick_count"}
_LONG = ", l AS (" + " UNION ALL ".join(f"SELECT symbol_pair, bucket_size, s, '{k}' AS feature, CAST({v} AS DOUBLE) AS v FROM g" for k, v in _COLS.items()) + ")"
_MISS = "m AS (SELECT symbol_pair, bucket_size, feature, count(*) AS rows, count(v) AS non_null, count(*) FILTER (WHERE v IS NULL) AS nulls, count(*) FILTER (WHERE isfinite(v)) AS finite_count, count(*) FILTER (WHERE v = 0) AS zero_count, count(DISTINCT v) + max((v IS NULL)::INT) AS distinct_count FROM l GROUP BY ALL)"
_LINES = "l AS (" + " UNION ALL ".join(f"SELECT l_returnflag, '{c}' AS feature, {c} AS v FROM lineitem" for c in LINE_FEATURES) + ")"


def _gold_long(tail: str) -> str:
    return _gold("").rstrip() + _LONG + ", " + tail


def _corr(keys: str) -> str:
    one = "SELECT {k}, '{a}' AS feature_a, '{b}' AS feature_b, count(*) AS n, CASE WHEN count(*) >= 3 AND var_pop({a}) > 0 AND var_pop({b}) > 0 THEN round(covar_pop({a}, {b}) / sqrt(var_pop({a}) * var_pop({b})), 6) END AS r FROM lineitem GROUP BY {k}"
    return " UNION ALL ".join(one.format(k=keys, a=a, b=b) for a, b in combinations(LINE_FEATURES, 2))


SQL: dict[str, str] = {
    "trade_bars": _with(_TB, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, f AS bucket_end_utc_ns, trade_count, total_volume, buy_volume, sell_volume, unknown_volume AS unknown_aggressor_volume, buy_trade_count, buy_volume - sell_volume AS net_signed_volume, round((buy_volume - sell_volume) / total_volume, 6) AS signed_volume_ratio, round(vwap, 6) AS vwap, first_price AS first_trade_price, last_price AS last_trade_price, high AS high_trade_price, low AS low_trade_price FROM tb"),
    "trade_size_stats": _with(_TB, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, max_size AS max_single_trade_volume, p99 AS trade_size_p99, round(mean_size, 6) AS trade_size_mean, round(std_size, 6) AS trade_size_std FROM tb"),
    "quote_bars": _with(_QB, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, tick_count, safe_count AS join_safe_tick_count, round(safe_ratio, 6) AS join_safe_tick_ratio, mid_first, mid_last, mid_min, mid_max, round(mid_mean, 6) AS mid_mean, k_min AS spread_points_min, k_max AS spread_points_max, r_max AS residual_ms_max, outliers AS latency_outlier_count FROM qb"),
    "quote_twap": _with(_QB, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, round(twap, 6) AS mid_twap FROM qb"),
    "quantile_nearest": _with(_QB, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, k50 AS spread_points_p50, k95 AS spread_points_p95, r50 AS residual_ms_p50, r95 AS residual_ms_p95 FROM qb"),
    "bar_full_join": _with(_TB, _QB, _J, select="SELECT symbol, bucket_size, s AS bucket_start_utc_ns, has_cme AS has_cme_data, has_mt5 AS has_mt5_data, trade_count AS cme_trade_count, tick_count AS mt5_tick_count FROM j"),
    "bar_reject_reason": _with(_TB, _QB, _J, select="""SELECT symbol, bucket_size, s AS bucket_start_utc_ns, CASE WHEN NOT has_cme THEN 'no_cme_data' WHEN NOT has_mt5 THEN 'no_mt5_data' WHEN total_volume = 0 THEN 'zero_cme_volume' WHEN tick_count = 0 THEN 'zero_mt5_ticks' WHEN safe_ratio < 0.1 THEN 'low_join_safe_tick_ratio' WHEN vwap IS NULL OR twap IS NULL OR vwap <= 0 THEN 'invalid_price' ELSE '' END AS reason,
        coalesce(has_cme AND has_mt5 AND safe_ratio >= 0.1 AND vwap > 0, false) AS is_bar_aligned, CASE WHEN vwap > 0 THEN round((twap - vwap) / vwap * 10000, 4) END AS basis_bps FROM j"""),
    "bar_alignment_metrics": _with(_TB, _QB, _J, select="""SELECT symbol, bucket_size, count(*) AS total_bars, count(*) FILTER (WHERE has_cme) AS cme_bars, count(*) FILTER (WHERE has_mt5) AS mt5_bars, count(*) FILTER (WHERE ok) AS aligned_bars, CAST(sum(coalesce(total_volume, 0)) AS BIGINT) AS total_volume, CAST(coalesce(sum(total_volume) FILTER (WHERE ok), 0) AS BIGINT) AS aligned_volume,
        round(count(*) FILTER (WHERE ok) / count(*), 6) AS alignment_rate, CASE WHEN sum(coalesce(total_volume, 0)) > 0 THEN round(coalesce(sum(total_volume) FILTER (WHERE ok), 0) / sum(total_volume), 6) END AS aligned_volume_ratio
        FROM (SELECT *, coalesce(has_cme AND has_mt5 AND safe_ratio >= 0.1 AND vwap > 0, false) AS ok FROM j) GROUP BY symbol, bucket_size"""),
    "asof_match": _with(_M, select="SELECT event_id, symbol, CASE WHEN hit THEN safe_ms END AS quote_ms, CASE WHEN hit THEN age END AS delta_ms, CASE WHEN hit THEN safe_mid END AS quote_mid, hit AS is_matched FROM m"),
    "asof_reasons": _with(_M, select="SELECT symbol, coalesce(reason, 'matched') AS reason, count(*) AS n, CAST(sum(size) AS BIGINT) AS volume FROM m GROUP BY 1, 2"),
    "asof_tolerance_table": _with(_M, select="SELECT symbol, tolerance_ms, count(*) AS total, count(*) FILTER (WHERE age <= tolerance_ms) AS aligned, CAST(coalesce(sum(size) FILTER (WHERE age <= tolerance_ms), 0) AS BIGINT) AS aligned_volume FROM m, (VALUES (600000), (1800000), (7200000)) v(tolerance_ms) GROUP BY 1, 2"),
    "match_rate_by_hour": _with(_M, select="SELECT symbol, CAST(ms // 3600000 % 24 AS INT) AS hour, count(*) AS total, count(*) FILTER (WHERE hit) AS aligned, round(count(*) FILTER (WHERE hit) / count(*), 6) AS rate FROM m GROUP BY 1, 2"),
    "unmatched_sample": _with(_M, select="SELECT symbol, event_id, ms AS event_ms, reason, row_number() OVER (PARTITION BY symbol ORDER BY ms, event_id) AS sample_rank FROM m WHERE NOT hit AND valid QUALIFY sample_rank <= 50"),
    "normalize_ticks": _with(select="SELECT event_id AS monotonic_ns, symbol, ms AS time_msc_utc_ms, r AS residual_ms, round(((value - value * 0.0005) + (value + value * 0.0005)) / 2, 6) AS mid, round((value + value * 0.0005) - (value - value * 0.0005), 6) AS spread_price, (value + value * 0.0005) >= (value - value * 0.0005) AS is_bid_ask_valid, outlier AS is_latency_outlier, safe AS is_join_safe, CAST(ms // 3600000 % 24 AS INT) AS session_hour_utc FROM q"),
    "run_window": _with(select="SELECT symbol, count(*) AS n, min(ms + r) AS first_ms, max(ms + r) AS last_ms FROM q WHERE ms + r BETWEEN 1704499200000 AND 1704931200000 GROUP BY symbol"),
    "canonical_symbols": "SELECT event_id, CASE WHEN starts_with(event_type, 'view') THEN 'view' WHEN starts_with(event_type, 'pu') THEN 'pu' WHEN starts_with(event_type, 's') THEN 's' WHEN starts_with(event_type, 'p') THEN 'p' END AS ticker FROM events",
    "signed_size": "SELECT CASE WHEN l_linestatus = 'O' THEN 'BUY' WHEN l_returnflag = 'A' THEN 'SELL' ELSE 'UNKNOWN' END AS side, count(*) AS n, sum(CASE WHEN l_linestatus = 'O' THEN l_quantity WHEN l_returnflag = 'A' THEN -l_quantity END) AS signed FROM lineitem GROUP BY 1",
    "trade_validity": "SELECT count(*) FILTER (WHERE l_linestatus = 'O') AS is_trade_action, count(*) FILTER (WHERE l_extendedprice > 20000) AS is_price_valid, count(*) FILTER (WHERE l_quantity > 5) AS is_size_valid, count(*) FILTER (WHERE l_linestatus = 'O' AND l_extendedprice > 20000 AND l_quantity > 5) AS is_reference_trade_valid FROM lineitem",
    "telemetry_quality": _with(select="SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE value < 0) AS crossed, count(*) FILTER (WHERE value < 0) AS negative_spread, count(*) FILTER (WHERE safe) AS join_safe, count(*) FILTER (WHERE outlier) AS outliers, round(100.0 * count(*) FILTER (WHERE safe) / count(*), 6) AS join_safe_pct, round(100.0 * count(*) FILTER (WHERE outlier) / count(*), 6) AS outlier_pct, round(avg(r), 6) AS residual_ms_mean, round(quantile_cont(r, 0.5), 6) AS residual_ms_p50, round(quantile_cont(r, 0.95), 6) AS residual_ms_p95, round(quantile_cont(r, 0.99), 6) AS residual_ms_p99, round(max(value * 0.001), 6) AS spread_price_max FROM q GROUP BY symbol"),
    "reference_quality": _with(select="SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE valid) AS valid, count(*) FILTER (WHERE side = 'UNKNOWN') AS unknown_side, count(*) FILTER (WHERE NOT valid) AS invalid, min(ns) AS first_ns, max(ns) AS last_ns FROM t GROUP BY symbol"),
    "value_counts": "SELECT coalesce(event_type, '<null>') AS value, count(*) AS n FROM events GROUP BY 1",
    "close_returns": _gold(f"SELECT {_KEY}, round(dl / pl, 6) AS cme_return, round(dm / pm, 6) AS mid_return, round(dm / pm - dl / pl, 6) AS return_diff FROM g"),
    "basis_change": _gold(f"SELECT {_KEY}, round(basis, 6) AS basis_close, round(basis_change, 6) AS basis_change, round(basis_bps, 3) AS basis_close_bps FROM g"),
    "range_bps": _gold(f"SELECT {_KEY}, round(cme_range, 3) AS cme_range, round(mid_range, 3) AS mid_range FROM g"),
    "volume_ratios": _gold(f"SELECT {_KEY}, round(buy_volume / total_volume, 6) AS cme_buy_volume_ratio, round(sell_volume / total_volume, 6) AS cme_sell_volume_ratio, round(unknown_volume / total_volume, 6) AS cme_unknown_aggressor_volume_ratio, round(total_volume / trade_count, 6) AS cme_volume_per_trade, round(trade_count / ((f - s) / 1e9), 6) AS cme_trade_intensity, CASE WHEN has_cme AND has_mt5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS cme_volume_alignment_ratio FROM g"),
    "trailing_zscore": _gold(f"SELECT {_KEY}, round(z_total_volume, 5) AS cme_volume_zscore_by_symbol_bucket, round(z_trade_count, 5) AS cme_trade_count_zscore_by_symbol_bucket, round(z_tick_count, 5) AS mt5_tick_count_zscore_by_symbol_bucket FROM g"),
    "quality_flag": _gold(f"SELECT {_KEY}, flag AS feature_quality_flag, reason, eligible AS is_model_eligible_candidate FROM g"),
    "feature_row_ids": _gold(f"SELECT {_KEY}, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || substr('89ab', CAST(('0x' || substr(h, 17, 1))::INT % 4 AS INT) + 1, 1) || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS feature_row_id FROM (SELECT *, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(concat_ws(':', 'tickloom', '0.2.0', '2024-01-01', symbol, symbol, bucket_size, s))) AS h FROM g)"),
    "missingness": _gold_long(_MISS + " SELECT *, round(nulls / rows, 6) AS null_rate, distinct_count <= 2 AS is_near_constant, non_null = 0 AS is_all_null, non_null > 0 AND zero_count = non_null AS is_all_zero FROM m"),
    "top_missing": _gold_long(_MISS + " SELECT symbol_pair, bucket_size, feature, round(nulls / rows, 6) AS null_rate FROM m ORDER BY nulls / rows DESC NULLS LAST, symbol_pair, bucket_size, feature LIMIT 15"),
    "stability": _gold_long("h AS (SELECT *, row_number() OVER (PARTITION BY symbol_pair, bucket_size, feature ORDER BY s) <= count(*) OVER (PARTITION BY symbol_pair, bucket_size, feature) // 2 AS a FROM l), o AS (SELECT symbol_pair, bucket_size, feature, count(v) FILTER (WHERE a) AS n_first, count(v) FILTER (WHERE NOT a) AS n_second, avg(v) FILTER (WHERE a) AS m1, avg(v) FILTER (WHERE NOT a) AS m2, stddev_samp(v) FILTER (WHERE a) AS s1, stddev_samp(v) FILTER (WHERE NOT a) AS s2 FROM h GROUP BY ALL) SELECT symbol_pair, bucket_size, feature, n_first, n_second, round(m1, 5) AS mean_first, round(m2, 5) AS mean_second, round(s1, 5) AS std_first, round(s2, 5) AS std_second, round(abs(m2 - m1), 5) AS abs_shift, CASE WHEN m1 <> 0 THEN round((m2 - m1) / abs(m1), 5) END AS relative_shift FROM o"),
    "distribution": f"""WITH {_LINES}, c AS (SELECT l_returnflag, feature, count(*) AS n, avg(v) AS m, stddev_samp(v) AS sd, var_pop(v) AS m2, quantile_cont(v, 0.01) AS p01, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50, quantile_cont(v, 0.75) AS p75, quantile_cont(v, 0.99) AS p99 FROM l GROUP BY ALL),
        k AS (SELECT l_returnflag, feature, avg(power(v - m, 3)) / power(max(m2), 1.5) AS sk, avg(power(v - m, 4)) / power(max(m2), 2) - 3 AS ku, avg(CASE WHEN v < p25 - 1.5 * (p75 - p25) OR v > p75 + 1.5 * (p75 - p25) THEN 1.0 ELSE 0.0 END) AS o FROM l JOIN c USING (l_returnflag, feature) GROUP BY ALL)
        SELECT l_returnflag, feature, n, round(m, 5) AS mean, round(sd, 5) AS std, round(p01, 5) AS p01, round(p25, 5) AS p25, round(p50, 5) AS p50, round(p75, 5) AS p75, round(p99, 5) AS p99, round(p75 - p25, 5) AS iqr, round(sk, 5) AS skew, round(ku, 5) AS excess_kurtosis, round(abs(p99 - p50) / abs(p75 - p25), 5) AS heavy_tail_score, round(o, 5) AS outlier_rate, abs(p99 - p50) / abs(p75 - p25) >= 5 AS is_heavy_tailed, n < 5000 AS sample_size_warning FROM c JOIN k USING (l_returnflag, feature)""",
    "correlation": _corr("l_returnflag"),
    "top_abs_corr": f"SELECT * FROM ({_corr('l_returnflag, l_linestatus')}) ORDER BY abs(r) DESC NULLS LAST, l_returnflag, l_linestatus, feature_a, feature_b LIMIT 5",
    "watermark_export": _gold("SELECT symbol_pair, bucket_size, count(*) AS n, max(f) AS last_end FROM g WHERE eligible AND f <= 1705276800000000000 GROUP BY 1, 2"),
    "dataset_summary": _gold("SELECT symbol_pair, bucket_size, count(*) AS n_rows, min(f) AS first_ts, max(f) AS last_ts, round(avg(safe_ratio), 6) AS mean_join_safe_ratio FROM g GROUP BY 1, 2"),
    "overlap_window": _with(select="SELECT symbol, CASE WHEN greatest(a0, b0) <= least(a1, b1) THEN greatest(a0, b0) END AS lo, CASE WHEN greatest(a0, b0) <= least(a1, b1) THEN least(a1, b1) END AS hi FROM (SELECT symbol, min(ms) AS a0, max(ms) AS a1 FROM t GROUP BY 1) FULL JOIN (SELECT symbol, min(ms) AS b0, max(ms) AS b1 FROM q GROUP BY 1) USING (symbol)"),
    "symbol_pairs": _with(select="SELECT symbol, 'Q' || substr(symbol, 2) AS mapped, count(*) AS n FROM t WHERE symbol IN ('S0', 'S1', 'S3') GROUP BY 1, 2"),
    "eda_row_accounting": _gold("SELECT symbol_pair, bucket_size, count(*) FILTER (WHERE eligible) AS eligible, CAST(0 AS BIGINT) AS diagnostic, count(*) FILTER (WHERE flag <> 'OK') AS excluded FROM g GROUP BY 1, 2"),
    "scaled_prices": "SELECT event_id, CAST(round_even(value * 10, 0) AS BIGINT) AS scaled, substr(sha256(user_id::VARCHAR), 1, 16) AS login_hash FROM events",
    "union_all": _with(select="SELECT symbol, count(*) AS n, min(ms) AS first_ms, max(ms) AS last_ms FROM (SELECT symbol, ms FROM t UNION ALL SELECT symbol, ms FROM q) GROUP BY 1"),
}


def _spread(x: str, name: str, kinds: tuple[str, ...]) -> str:
    f = {"min": f"min({x})", "mean": f"avg({x})", "max": f"max({x})", **{f"p{k}": f"quantile_cont({x}, {k / 100})" for k in (50, 95, 99)}}
    return ", ".join(f"round({f[k]}, 6) AS {name}_{k}" for k in kinds)


_FIVE, _SIX = ("min", "mean", "p50", "p95", "max"), ("min", "mean", "p50", "p95", "p99", "max")
_REASONS = ("no_overlap_window", "missing_required_columns", "no_mt5_rows_for_symbol", "no_prior_quote", "mt5_not_join_safe", "outside_tolerance")
_BAR_REASONS = ("no_cme_data", "no_mt5_data", "zero_cme_volume", "zero_mt5_ticks", "low_join_safe_tick_ratio", "invalid_price", "spread_too_wide")
_BAR = "CASE WHEN NOT has_cme THEN 'no_cme_data' WHEN NOT has_mt5 THEN 'no_mt5_data' WHEN total_volume = 0 THEN 'zero_cme_volume' WHEN tick_count = 0 THEN 'zero_mt5_ticks' WHEN safe_ratio < 0.1 THEN 'low_join_safe_tick_ratio' WHEN vwap IS NULL OR twap IS NULL OR vwap <= 0 THEN 'invalid_price' END"
SQL |= {
    "alignment_totals": _with(_M, select="SELECT symbol, count(*) AS total, count(*) FILTER (WHERE hit) AS aligned, CAST(sum(size) AS BIGINT) AS total_volume, CAST(coalesce(sum(size) FILTER (WHERE hit), 0) AS BIGINT) AS aligned_volume, "
        "count(*) FILTER (WHERE valid AND side = 'UNKNOWN') AS unknown_count, CAST(coalesce(sum(size) FILTER (WHERE valid AND side = 'UNKNOWN'), 0) AS BIGINT) AS unknown_volume, round(count(*) FILTER (WHERE hit) / count(*), 6) AS match_rate, round(1 - coalesce(sum(size) FILTER (WHERE hit), 0) / sum(size), 6) AS unmatched_volume_ratio, "
        + ", ".join([_spread("CASE WHEN hit THEN age END", "delta_ms", _FIVE), _spread("CASE WHEN hit THEN safe_mid END", "quote_mid", _FIVE), _spread("size", "size", _FIVE), _spread("value", "price", _FIVE)])
        + "".join(f", count(*) FILTER (WHERE reason = '{r}') AS n_{r}, CAST(coalesce(sum(size) FILTER (WHERE reason = '{r}'), 0) AS BIGINT) AS volume_{r}" for r in _REASONS) + " FROM m GROUP BY symbol"),
    "alignment_by_hour": _with(_M, select="SELECT symbol, CAST(ms // 3600000 % 24 AS INT) AS hour, count(*) AS total, count(*) FILTER (WHERE hit) AS aligned, round(count(*) FILTER (WHERE hit) / count(*), 6) AS rate FROM m WHERE valid GROUP BY 1, 2"),
    "bar_reason_counts": _with(_TB, _QB, _J, select=f"SELECT symbol, bucket_size, r.reason, count(*) FILTER (WHERE b.reason = r.reason) AS bars, CAST(coalesce(sum(v) FILTER (WHERE b.reason = r.reason), 0) AS BIGINT) AS volume FROM (SELECT symbol, bucket_size, coalesce(total_volume, 0) AS v, {_BAR} AS reason FROM j) b, (VALUES {', '.join(f"('{r}')" for r in _BAR_REASONS)}) r(reason) GROUP BY ALL"),
    "quotes_by_hour": _with(select="SELECT symbol, CAST(ms // 3600000 % 24 AS INT) AS hour, count(*) AS rows FROM q GROUP BY 1, 2"),
    "reference_bounds": _with(select="SELECT symbol, count(*) AS rows, count(*) FILTER (WHERE size = 1) AS missing_bbo, min(ns) AS first_event, max(ns) AS last_event, min(ns + size * 1000000) AS first_receive, max(ns + size * 1000000) AS last_receive, " + _spread("CAST(size AS DOUBLE)", "latency_ms", _SIX) + ", " + _spread("CASE WHEN size > 1 THEN (value + size) - (value - 1) END", "bbo_spread", _SIX) + " FROM t GROUP BY symbol"),
    "feature_flag_counts": _gold("SELECT symbol_pair, bucket_size, kind, value, count(*) AS rows FROM (SELECT symbol_pair, bucket_size, 'flag' AS kind, flag AS value FROM g UNION ALL SELECT symbol_pair, bucket_size, 'reason', nullif(reason, '') FROM g) WHERE value IS NOT NULL GROUP BY ALL"),
    "candidate_rates": _gold_long("m AS (SELECT symbol_pair, bucket_size, feature, count(*) AS rows, round(1 - count(v) / count(*), 6) AS null_rate, round(count(*) FILTER (WHERE isfinite(v)) / count(*), 6) AS finite_rate FROM l GROUP BY ALL) SELECT * FROM m"),
    "most_null": _gold_long("m AS (SELECT feature, count(*) AS rows, round(1 - count(v) / count(*), 6) AS null_rate FROM l GROUP BY ALL) SELECT * FROM m ORDER BY null_rate DESC, feature LIMIT 3"),
    "offset_candidates": _with(select="SELECT symbol, offset_min, count(*) AS fresh_ticks, count(DISTINCT raw) AS raw_times, round(quantile_cont(CASE WHEN k <= 1024 THEN age END, 0.5), 6) AS age_p50, round(quantile_cont(CASE WHEN k <= 1024 THEN age END, 0.95), 6) AS age_p95 FROM ("
        "SELECT *, row_number() OVER (PARTITION BY symbol, offset_min ORDER BY recv DESC, raw DESC) AS k FROM (SELECT symbol, offset_min, ms + 7200000 AS raw, ms + r AS recv, CAST(r - 7200000 + offset_min * 60000 AS DOUBLE) AS age FROM q, (VALUES (-60), (0), (60), (120)) o(offset_min)) WHERE age BETWEEN -250 AND 5000) GROUP BY 1, 2"),
    "tick_dedup": "WITH RECURSIVE " + _E.strip() + """,
s AS (SELECT symbol, ms, event_id, CAST(floor(value / 40) AS BIGINT) AS step, row_number() OVER (PARTITION BY symbol ORDER BY ms, event_id) AS i FROM q),
f(symbol, i, since, step, held, a, b, emit) AS (
  SELECT symbol, i, ms, step, CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(0 AS BIGINT) FROM s WHERE i = 1
  UNION ALL SELECT s.symbol, s.i, CASE WHEN x THEN s.ms ELSE f.since END, s.step, CASE WHEN x THEN 0 ELSE f.held + 1 END, CASE WHEN x THEN NULL ELSE coalesce(f.a, s.event_id) END, CASE WHEN x THEN NULL ELSE s.event_id END, CASE WHEN x THEN f.held ELSE -1 END
  FROM f JOIN (SELECT * FROM s) s ON s.symbol = f.symbol AND s.i = f.i + 1, LATERAL (SELECT s.step <> f.step OR s.ms - f.since >= 3600000 AS x))
SELECT s.symbol, s.ms AS time_msc_utc_ms, s.event_id AS monotonic_ns, s.step, f.emit AS suppressed_count, p.a AS first_suppressed_ms, p.b AS last_suppressed_ms
FROM f JOIN s ON s.symbol = f.symbol AND s.i = f.i LEFT JOIN f p ON p.symbol = f.symbol AND p.i = f.i - 1 WHERE f.emit >= 0""",
    "asof_invalid_trades": _with("tt AS (SELECT event_id, event_id % 7 > 0 AS ok FROM t)", _M, select="SELECT symbol, CASE WHEN NOT ok THEN 'missing_required_columns' ELSE coalesce(reason, 'matched') END AS reason, count(*) AS n, CAST(sum(size) AS BIGINT) AS volume FROM m JOIN tt USING (event_id) GROUP BY ALL"),
    "bars_in_overlap": _with(_TB, _QB, _J, """
o AS (SELECT symbol, max(lo) AS lo, min(hi) AS hi FROM (SELECT symbol, min(ns) AS lo, max(ns) - 345600000000000 AS hi FROM t GROUP BY symbol UNION ALL SELECT symbol, min(ms) * 1000000 + 345600000000000, max(ms) * 1000000 FROM q GROUP BY symbol) GROUP BY symbol)""",
        select="SELECT symbol, bucket_size, count(*) AS bars, min(s) AS first_start, max(f) AS last_end FROM j JOIN o USING (symbol) WHERE f > lo AND s <= hi GROUP BY ALL"),
    "exact_quantiles": "WITH r AS (SELECT l_returnflag, l_extendedprice AS v, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) - 1 AS k, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem) "
        "SELECT l_returnflag, " + ", ".join(f"max(v) FILTER (WHERE k = CAST(floor((n - 1) * {q} + 0.5) AS BIGINT)) AS {name}" for name, q in (("p01", 0.01), ("p50", 0.5), ("p95", 0.95), ("p99", 0.99))) + " FROM r GROUP BY ALL",
    "footer_bounds": "SELECT count(*) AS n, " + ", ".join(f"{f}({c}) AS {f}_{c}" for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice") for f in ("min", "max", "count")) + " FROM lineitem",
    "correlation_wide": "WITH w AS (SELECT row_number() OVER () AS id, l_returnflag, " + ", ".join(f"{e} AS {c}" for c, e in WIDE.items()) + " FROM lineitem), "
        "l AS (SELECT * FROM (UNPIVOT w ON " + ", ".join(WIDE) + " INTO NAME f VALUE v) WHERE isfinite(v)), "
        "m AS (SELECT a.l_returnflag, a.f AS feature_a, b.f AS feature_b, count(*) AS n, CASE WHEN count(*) >= 3 AND min(a.v) < max(a.v) AND min(b.v) < max(b.v) THEN corr(a.v, b.v) END AS r "
        "FROM l a JOIN l b ON a.id = b.id AND a.f < b.f GROUP BY ALL) SELECT l_returnflag, feature_a, feature_b, n, round(r, 6) AS r FROM m",
    "reference_table": _with(select="SELECT symbol, aggressor_side, is_bbo_available, is_reference_trade_valid, count(*) AS n, sum(size) AS volume, round(sum(spread), 4) AS spread, round(avg(mid), 4) AS mid, min(late) AS least_latency FROM ("
        "SELECT symbol, size, coalesce(nullif(side, 'x'), '') AS aggressor_side, true AS is_bbo_available, value > 0 AS is_reference_trade_valid, CASE WHEN size > 1 THEN (value + size) - (value - 1) END AS spread, CASE WHEN size > 1 THEN ((value - 1) + (value + size)) / 2 END AS mid, size * 1000000 AS late FROM t) GROUP BY ALL"),
}
SQL["tick_dedup_slices"] = SQL["tick_dedup"]
SQL["quantile_large_bars"] = SQL["quantile_nearest"]
