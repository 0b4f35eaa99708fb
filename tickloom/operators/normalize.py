"""From raw quotes and vendor trades to normalised tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.exprs import require, session_hour

#: Latency limits in milliseconds.
RESIDUAL_LOW, RESIDUAL_HIGH, JOIN_SAFE_HIGH = -250, 1000, 50
#: Vendor column names by role, in order of preference (fixed values).
VENDOR_NAMES: dict[str, tuple[str, ...]] = {
    "event": ("ts_event", "event_ts", "timestamp"), "receive": ("ts_recv", "recv_ts"), "symbol": ("raw_symbol", "symbol"),
    "action": ("action",), "side": ("side",), "price": ("price",), "size": ("size",),
    "bid": ("bid_px_00", "best_bid_price"), "ask": ("ask_px_00", "best_ask_price"), "bid_size": ("bid_sz_00",), "ask_size": ("ask_sz_00",), "instrument": ("instrument_id",),
}
#: Columns and types of the normalised tables (fixed values: other programs read them).
QUOTE_SCHEMA = """
    symbol string, broker_server string, broker_company string, account_login_hash string, source_date string, source_hour int, time_msc_raw long, verified_offset_min int, verified_offset_ms long,
    time_msc_utc_ms long, recv_time_utc_ms long, residual_ms long, monotonic_ns long, bid double, ask double, mid double, spread_price double, spread_points long, bid_scaled long, ask_scaled long,
    last double, last_scaled long, volume long, flags long, suppressed_count long, suppressed_reason string, is_bid_ask_valid boolean, is_scaled_bid_ask_valid boolean, is_latency_outlier boolean,
    is_join_safe boolean, is_spread_valid boolean, session_hour_utc int, data_layer string, normalizer_version string, metadata_source_path string"""
TRADE_SCHEMA = """
    source string, vendor string, dataset string, schema string, symbol string, raw_symbol string, instrument_id long, ts_event long, ts_recv long, ts_event_ns long, ts_recv_ns long,
    event_time_utc_ns long, receive_time_utc_ns long, action string, side_raw string, aggressor_side string, signed_size double, price double, size long, bid_px_00 double, ask_px_00 double,
    bid_sz_00 long, ask_sz_00 long, spread double, mid double, is_trade boolean, is_aggressor_known boolean, is_bbo_available boolean, is_price_valid boolean, is_size_valid boolean,
    is_reference_trade_valid boolean, ingest_date string, ingest_version string, source_file string"""
NORMALIZER_VERSION, INGEST_VERSION, SILVER = "0.1.0", "0.1.0", "silver"
REQUIRED_ROLES = ("event", "action", "side", "price", "size")


class VendorSchemaError(ValueError):
    pass


def iso_to_ms(text: str | None) -> int | None:
    """Milliseconds of an ISO-8601 time; a time without a zone is UTC; anything else is None."""
    try:
        t = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except (AttributeError, ValueError):
        return None
    t = t if t.tzinfo else t.replace(tzinfo=timezone.utc)
    return int(t.timestamp() * 1000)


def in_run_window(df: DataFrame, start_ms: int | None, end_ms: int | None, column: str = "recv_time_utc_ms") -> DataFrame:
    """Rows received within a run, both ends included; an open end doesn't filter."""
    keep = F.lit(True)
    if start_ms is not None:
        keep = keep & (F.col(column) >= start_ms)
    if end_ms is not None:
        keep = keep & (F.col(column) <= end_ms)
    return df.where(keep)


def normalize_quotes(df: DataFrame, offset_min: int, join_safe_high: int = JOIN_SAFE_HIGH) -> DataFrame:
    """UTC times, mid, spread and validity flags under one verified offset from UTC."""
    if not isinstance(offset_min, int) or isinstance(offset_min, bool):
        raise ValueError("a verified whole-minute offset is needed")
    require(df, ("time_msc_raw", "recv_time_utc_ms", "bid", "ask"), "quotes")
    shift = offset_min * 60_000
    out = df.withColumns({"verified_offset_min": F.lit(offset_min), "verified_offset_ms": F.lit(shift).cast("long"), "time_msc_utc_ms": F.col("time_msc_raw") - shift})
    out = out.withColumns({"residual_ms": F.col("recv_time_utc_ms") - F.col("time_msc_utc_ms"), "mid": (F.col("bid") + F.col("ask")) / 2, "spread_price": F.col("ask") - F.col("bid")})
    r = F.col("residual_ms")
    flags = {
        "is_bid_ask_valid": F.col("ask") >= F.col("bid"), "is_latency_outlier": (r < RESIDUAL_LOW) | (r > RESIDUAL_HIGH),
        "is_join_safe": r.between(RESIDUAL_LOW, join_safe_high), "session_hour_utc": session_hour(F.col("time_msc_utc_ms")),
    }
    if {"bid_scaled", "ask_scaled"} <= set(df.columns):
        flags["is_scaled_bid_ask_valid"] = F.col("ask_scaled") >= F.col("bid_scaled")
    if "spread_points" in df.columns:
        flags["is_spread_valid"] = (F.col("spread_price") >= 0) & (F.col("spread_points") >= 0)
    return out.withColumns(flags)


def bind_vendor_columns(columns: Sequence[str], has_instrument_map: bool = False) -> dict[str, str]:
    """The column of each role; all roles that have none are reported together."""
    held = {role: next((n for n in names if n in columns), None) for role, names in VENDOR_NAMES.items()}
    missing = [r for r in REQUIRED_ROLES if held[r] is None]
    if held["symbol"] is None and not (has_instrument_map and held["instrument"]):
        missing.append("symbol")
    if missing:
        raise VendorSchemaError(f"no column for {', '.join(missing)}")
    return {r: n for r, n in held.items() if n}


def to_ns(df: DataFrame, name: str) -> Column:
    """Nanoseconds since the epoch; a timestamp without a zone and other types are errors."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.LongType, T.IntegerType)):
        return F.col(name).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(F.col(name)) * 1000
    raise VendorSchemaError(f"{name} has type {kind.simpleString()}; nanoseconds or a timestamp with a zone are needed")


def aggressor(side: Column) -> Column:
    return F.when(side == "B", "BUY").when(side == "A", "SELL").otherwise("UNKNOWN")


def signed_size(side: Column, size: Column) -> Column:
    """Size with the aggressor's sign; null where the aggressor or the size is unknown."""
    return F.when(side == "BUY", size.cast("double")).when(side == "SELL", -size.cast("double"))


def trade_validity(action: Column, price: Column, size: Column) -> dict[str, Column]:
    ok = {
        "is_trade_action": F.coalesce(action == "T", F.lit(False)),
        "is_price_valid": F.coalesce(price > 0, F.lit(False)),
        "is_size_valid": F.coalesce(size > 0, F.lit(False)),
    }
    return ok | {"is_reference_trade_valid": ok["is_trade_action"] & ok["is_price_valid"] & ok["is_size_valid"]}


def canonical_symbol(symbol: Column, requested: Sequence[str]) -> Column:
    """The longest requested ticker that the symbol equals or starts with, else null."""
    out = F.lit(None).cast("string")
    for ticker in sorted(requested, key=lambda x: (len(x), x)):
        out = F.when(symbol.startswith(ticker), F.lit(ticker)).otherwise(out)
    return out


def under_schema(df: DataFrame, schema: str, **constants: object) -> DataFrame:
    """``df`` as a table of exactly these columns and types; constants fill or replace columns, what is still missing is null."""
    fields = T.StructType.fromDDL(schema)
    held = {c: F.col(f"`{c}`") for c in df.columns} | {k: F.lit(v) for k, v in constants.items()}
    return df.select(*[held.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def quote_table(quotes: DataFrame, date: str, metadata: Mapping[str, object]) -> DataFrame:
    """Normalised quotes in the full layout, with what the run's metadata says of their origin."""
    known = {k: metadata.get(k) for k in ("broker_server", "broker_company", "account_login_hash")}
    hour = {} if "source_hour" in quotes.columns else {"source_hour": F.col("hour").cast("int") if "hour" in quotes.columns else session_hour(F.col("recv_time_utc_ms"))}
    return under_schema(quotes.withColumns(hour) if hour else quotes, QUOTE_SCHEMA, **known, source_date=date, data_layer=SILVER, normalizer_version=NORMALIZER_VERSION, metadata_source_path=str(metadata.get("path", "")))


def vendor_symbol(df: DataFrame, instruments: Mapping[int, str] | None = None) -> tuple[dict[str, str], Column]:
    """The column of each role, and the vendor's symbol: from its column, else through the map of instruments."""
    names = bind_vendor_columns(df.columns, bool(instruments))
    if "symbol" in names:
        return names, F.col(names["symbol"])
    pairs = [x for k, v in instruments.items() for x in (F.lit(k), F.lit(v))]
    return names, F.element_at(F.create_map(*pairs), F.col(names["instrument"]))


def normalize_trades(df: DataFrame, requested: Sequence[str], instruments: Mapping[int, str] | None = None, **constants: object) -> DataFrame:
    """Canonical trades of a vendor table in the full layout; rows of other symbols or actions are left out.

    ``constants`` are the columns that tell the origin: source, vendor, dataset, schema, ingest_date, source_file.
    """
    names, symbol = vendor_symbol(df, instruments)
    of = lambda role: F.col(names[role]) if role in names else F.lit(None)
    raw_side, price, size = of("side"), of("price").cast("double"), of("size").cast("long")
    side, event = aggressor(raw_side), to_ns(df, names["event"])
    receive = to_ns(df, names["receive"]) if "receive" in names else F.lit(None).cast("long")
    bbo = {"bid", "ask"} <= names.keys()
    bid, ask = (of(r).cast("double") if bbo else F.lit(None).cast("double") for r in ("bid", "ask"))
    flags = trade_validity(of("action"), price, size)
    out = df.select(
        canonical_symbol(symbol, requested).alias("symbol"), symbol.alias("raw_symbol"), of("instrument").cast("long").alias("instrument_id"),
        *[event.alias(c) for c in ("ts_event", "ts_event_ns", "event_time_utc_ns")], *[receive.alias(c) for c in ("ts_recv", "ts_recv_ns", "receive_time_utc_ns")],
        of("action").alias("action"), raw_side.alias("side_raw"), side.alias("aggressor_side"), signed_size(side, size).alias("signed_size"), price.alias("price"), size.alias("size"),
        bid.alias("bid_px_00"), ask.alias("ask_px_00"), of("bid_size").alias("bid_sz_00"), of("ask_size").alias("ask_sz_00"), (ask - bid).alias("spread"), ((bid + ask) / 2).alias("mid"),
        flags.pop("is_trade_action").alias("is_trade"), F.coalesce(raw_side.isin("A", "B"), F.lit(False)).alias("is_aggressor_known"), F.lit(bbo).alias("is_bbo_available"), *[v.alias(k) for k, v in flags.items()],
        *([F.col("source_file")] if "source_file" in df.columns else []),
    )
    kept = out.where(F.col("symbol").isNotNull() & (F.col("action") == "T"))
    return under_schema(kept, TRADE_SCHEMA, ingest_version=INGEST_VERSION, **constants)


def ingest_counts(df: DataFrame, requested: Sequence[str], instruments: Mapping[int, str] | None = None) -> dict:
    """Rows read, kept and rejected (another symbol, or no trade), and kept rows of unknown side: one aggregate over three columns."""
    names, symbol = vendor_symbol(df, instruments)
    kept = F.coalesce(canonical_symbol(symbol, requested).isNotNull() & (F.col(names["action"]) == "T"), F.lit(False))
    unknown = kept & (aggressor(F.col(names["side"])) == "UNKNOWN")
    n = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("read"), n(kept).alias("kept"), n(unknown).alias("unknown_side")).first()
    return {"read": r["read"], "kept": r["kept"], "rejected": r["read"] - r["kept"], "unknown_side": r["unknown_side"]}
