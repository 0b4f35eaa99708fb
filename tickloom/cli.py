"""Command line: one command for each stage.

0: PASS, 1: PARTIAL or FAIL of a quality stage, 2: input that can't be used, 3: the output is there already.
"""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    return SparkSession.builder.appName("tickloom").config("spark.sql.session.timeZone", "UTC").config("spark.sql.sources.partitionColumnTypeInference.enabled", "false").getOrCreate()


def demo(args: argparse.Namespace) -> int:
    from tickloom.plans.demo import run_demo

    m = run_demo(_session(), args.root, args.run_id, args.seconds, args.seed, args.scenario)
    print(json.dumps({"status": m["status"], "stages": {s["name"]: s["status"] for s in m["stages"]}}))
    return 0 if m["status"] == "PASS" else 2


def inspect(args: argparse.Namespace) -> int:
    from tickloom.plans.demo import inspect_run

    try:
        print(json.dumps(inspect_run(_session(), args.folder)))
    except (OSError, ValueError) as e:
        print(e, file=sys.stderr)
        return 2
    return 0


def bars(args: argparse.Namespace) -> int:
    """Trade bars of a canonical trade table."""
    from tickloom.functions.exprs import bucket_sizes
    from tickloom.operators.bars import trade_bars

    if Path(args.out).exists():
        print(f"{args.out} exists", file=sys.stderr)
        return 3
    try:
        sizes = bucket_sizes(args.buckets)
        out = trade_bars(_session().read.parquet(args.trades), sizes)
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2
    out.write.parquet(args.out)
    return 0


def _graded(status: str) -> int:
    return 0 if status == "PASS" else 1


def _guarded(run):
    def call(args: argparse.Namespace) -> int:
        try:
            return run(args)
        except FileExistsError as e:
            print(e, file=sys.stderr)
            return 3
        except (OSError, ValueError, LookupError) as e:
            print(e, file=sys.stderr)
            return 2

    return call


def _map(text: str) -> dict[str, str]:
    from tickloom.plans.lineage import parse_map

    return parse_map(text, "--map")


def _quotes(args: argparse.Namespace):
    from pyspark.sql import functions as F

    q = _session().read.parquet(args.quotes)
    return q if "quote_ms" in q.columns else q.withColumn("quote_ms", F.col("time_msc_utc_ms"))


def _trades(args: argparse.Namespace):
    """Trades under the quotes' symbols, where a map is given."""
    from pyspark.sql import functions as F

    from tickloom.functions.exprs import ns_to_ms

    t = _session().read.parquet(args.trades).withColumn("event_ms", ns_to_ms(F.col("event_time_utc_ns")))
    pairs = [x for k, v in _map(args.map).items() for x in (F.lit(k), F.lit(v))]
    return t.withColumn("symbol", F.coalesce(F.element_at(F.create_map(*pairs), F.col("symbol")), F.col("symbol"))) if pairs else t


@_guarded
def normalize_quotes(args: argparse.Namespace) -> int:
    """Raw quotes of a date under the verified offset of their run, into the silver tree."""
    from pyspark.sql import functions as F

    from tickloom.operators.normalize import in_run_window, iso_to_ms, normalize_quotes, quote_table
    from tickloom.plans.lineage import resolve_metadata
    from tickloom.sources.trees import write_tree

    found = resolve_metadata(Path(args.runs), args.date, run_id=args.run_id)
    raw = _session().read.parquet(args.source)
    ends = [iso_to_ms(found[k]) if found[k] else None for k in ("started", "ended")]
    layer = {"run_silver": {"run_id": F.lit(args.run_id)}, "silver": {}}["run_silver" if args.run_id else "silver"]
    out = quote_table(normalize_quotes(in_run_window(raw, *ends), found["offset_min"]), args.date, found).withColumns({"date": F.lit(args.date), **layer})
    done = write_tree(out, args.out, "run_silver" if args.run_id else "silver", args.force)
    before, rows = raw.count(), out.count()
    print(json.dumps(done | {"rows_before": before, "rows": rows, "excluded": before - rows}))
    return 0


@_guarded
def ingest_trades(args: argparse.Namespace) -> int:
    """Vendor files of a date as canonical trades, into the reference tree with a manifest."""
    from pyspark.sql import functions as F

    from tickloom.operators.normalize import ingest_counts, normalize_trades
    from tickloom.plans.lineage import write_once
    from tickloom.sources.selection import vendor_files
    from tickloom.sources.trees import concat_files, write_reference

    files = vendor_files(args.source, args.date)
    raw, symbols = concat_files(_session(), files, [], source="source_file"), args.symbols.split(",")
    out = normalize_trades(raw, symbols, ingest_date=args.date, source=args.vendor, vendor=args.vendor, dataset=args.dataset, schema=args.schema).withColumn("date", F.lit(args.date))
    write_once(Path(args.manifest), write_reference(out, args.out, args.source, args.force) | {"counts": ingest_counts(raw, symbols)})
    return 0


@_guarded
def telemetry_quality(args: argparse.Namespace) -> int:
    from tickloom.operators import metrics, quality
    from tickloom.plans.reports import table, write_report
    from tickloom.sources.trees import data_files, unreadable

    q = _quotes(args)
    rows = table(quality.telemetry_metrics(q).join(metrics.telemetry_summary(q).drop("rows"), "symbol"))
    limits = {k: float(v) for k, v in _map(args.spread_limits).items()}
    bad = unreadable(_session(), data_files(_session(), args.quotes))
    offsets = quality.value_counts(q, "verified_offset_min").count() if "verified_offset_min" in q.columns else 1
    status = quality.decide_telemetry({r["symbol"]: r for r in rows}, args.symbols.split(","), limits, len(bad), offsets > 1)
    write_report(Path(args.report), "telemetry_quality", status, {"symbols": rows, "hours": table(metrics.rows_by_hour(q, "quote_ms"))}, unreadable=bad, offsets=offsets)
    return _graded(status)


@_guarded
def reference_quality(args: argparse.Namespace) -> int:
    from tickloom.operators import metrics, quality
    from tickloom.plans.reports import table, write_report

    t = _trades(args)
    rows = table(quality.reference_metrics(t).join(metrics.reference_summary(t).drop("rows"), "symbol"))
    total, missing = sum(r["rows"] for r in rows), sum(r["missing_bbo"] or 0 for r in rows)
    status = quality.decide_reference(total, sum(r["valid"] for r in rows), {r["symbol"]: r for r in rows}, args.symbols.split(","), truncated=args.limit > 0 and total >= args.limit, missing_bbo=missing)
    write_report(Path(args.report), "reference_quality", status, {"symbols": rows, "sides": table(quality.value_counts(t, "aggressor_side"))})
    return _graded(status)


@_guarded
def tick_alignment(args: argparse.Namespace) -> int:
    from tickloom.operators import metrics, quality
    from tickloom.plans.reports import table, write_report

    trades, quotes = _trades(args), _quotes(args)
    matched = metrics.align(trades, quotes, args.tolerance_ms)
    rows = table(metrics.alignment_summary(matched))
    n, hit, volume, lost = (sum(r[c] for r in rows) for c in ("total", "aligned", "total_volume", "aligned_volume"))
    statuses = metrics.alignment_statuses(trades, quotes, args.symbols.split(",") if args.symbols else sorted(r["symbol"] for r in rows), args.tolerance_ms)
    status = quality.decide_alignment(statuses, hit / n if n else None, 1 - lost / volume if volume else None)
    write_report(Path(args.report), "tick_alignment", status, {"symbols": rows, "hours": table(metrics.alignment_by_hour(matched))}, tolerance_ms=args.tolerance_ms, statuses=statuses)
    return _graded(status)


def _bars(args: argparse.Namespace):
    from tickloom.functions.exprs import bucket_sizes
    from tickloom.operators import bars as b

    sizes = bucket_sizes(args.buckets)
    return b.join_bars(b.trade_bars(_trades(args), sizes), b.quote_bars(_quotes(args), sizes), ["symbol"]), sizes


@_guarded
def bar_alignment(args: argparse.Namespace) -> int:
    from tickloom.operators import features, metrics, quality
    from tickloom.plans.reports import table, write_report

    joined, sizes = _bars(args)
    keys, classified = ["symbol", "bucket_size"], features.classify_bars(joined)
    rows = table(features.alignment_metrics(classified, keys))
    status = quality.decide_bars({(r["symbol"], r["bucket_size"]): r for r in rows}, args.symbols.split(",") if args.symbols else sorted({r["symbol"] for r in rows}), dict(sizes))
    write_report(Path(args.report), "bar_alignment", status, {"bars": rows, "reasons": table(metrics.bar_reasons(classified, keys)), "aligned": table(metrics.bar_summary(classified, keys))})
    return _graded(status)


@_guarded
def build_features(args: argparse.Namespace) -> int:
    """Feature rows of a date, within the window that both streams cover, into the gold tree."""
    from pyspark.sql import functions as F

    from tickloom.operators import features
    from tickloom.sources.trees import write_tree

    joined, _ = _bars(args)
    covered = features.overlap_window(_trades(args), "event_time_utc_ns", _quotes(args).withColumn("quote_ns", F.col("quote_ms") * 1_000_000), "quote_ns", ["symbol"])
    joined = features.in_overlap(joined, covered, ["symbol"])
    back = {v: k for k, v in _map(args.map).items()}
    pairs = [x for k, v in back.items() for x in (F.lit(k), F.lit(v))]
    cme = F.coalesce(F.element_at(F.create_map(*pairs), F.col("symbol")), F.col("symbol")) if pairs else F.col("symbol")
    d = joined.withColumns({"date": F.lit(args.date), "mt5_symbol": F.col("symbol"), "cme_symbol": cme}).withColumn("symbol_pair", F.concat_ws("_", "cme_symbol", "mt5_symbol"))
    print(json.dumps(write_tree(features.build_features(d), args.out, "gold", args.force)))
    return 0


@_guarded
def feature_quality(args: argparse.Namespace) -> int:
    from tickloom.operators import metrics, quality
    from tickloom.plans.contract import ALL, CANDIDATES, FORBIDDEN
    from tickloom.plans.reports import table, write_report

    f = _session().read.parquet(args.features)
    errors = metrics.contract_errors(f, ALL, FORBIDDEN)
    if errors:
        write_report(Path(args.report), "feature_quality", "FAIL", {}, errors=errors)
        return 1
    from pyspark.sql import functions as F

    rows = table(f.groupBy("symbol_pair", "bucket_size").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_model_eligible_candidate").cast("long")).alias("eligible")))
    status = quality.decide_features(errors, {(r["symbol_pair"], r["bucket_size"]): r for r in rows}, args.pairs.split(",") if args.pairs else sorted({r["symbol_pair"] for r in rows}), args.buckets.split(","))
    write_report(Path(args.report), "feature_quality", status, {"groups": rows, "flags": table(metrics.feature_flags(f)), "candidates": table(metrics.candidate_rates(f, CANDIDATES)), "summary": table(metrics.feature_summary(f))})
    return _graded(status)


@_guarded
def eda(args: argparse.Namespace) -> int:
    """Tables and a report of the eligible feature rows; 1 where rows or pairs are too few or the contract is broken."""
    from tickloom.plans.contract import CANDIDATES
    from tickloom.plans.reports import explore, write_report

    names = args.candidates.split(",") if args.candidates else CANDIDATES
    pairs = args.pairs.split(",") if args.pairs else []
    status, found = explore(_session().read.parquet(args.features), args.out, names, pairs, args.least_rows, args.force)
    tables = {k: v for k, v in found.items() if isinstance(v, list)}
    write_report(Path(args.report), "feature_eda", status, tables, **{k: v for k, v in found.items() if k not in tables})
    print(json.dumps({"status": status} | {k: v for k, v in found.items() if k not in tables}))
    return _graded(status)


@_guarded
def compact(args: argparse.Namespace) -> int:
    """Fewer files in the leaves of days before today; a leaf whose content would change is left as it is."""
    from tickloom.sources.compaction import ContentChanged, compact_closed

    try:
        print(json.dumps(compact_closed(_session(), args.root, args.layer, args.today, args.order.split(","), args.target_mb << 20)))
    except ContentChanged as e:
        print(e, file=sys.stderr)
        return 1
    return 0


@_guarded
def export(args: argparse.Namespace) -> int:
    """The dataset of closed, eligible rows with its contract."""
    from tickloom.operators.export import export_dataset

    print(json.dumps(export_dataset(_session().read.parquet(args.features), args.out, args.watermark_ns, args.buckets.split(","), args.origin)))
    return 0


@_guarded
def plan(args: argparse.Namespace) -> int:
    """What a range of dates would need, nothing done: quotes by runs, trades by vendor files."""
    from tickloom.plans.lineage import dry_run_report, plan_days, read_runs, runs_by_date

    runs = read_runs(Path(args.runs))
    has = lambda d: runs_by_date(runs, [d])[d] is not None
    days = plan_days(args.first, args.last, has, lambda d: any((Path(args.vendor) / f"date={d}").glob("*.parquet")), lambda d, s: False, args.stages.split(","))
    report = dry_run_report(days, lambda d: (args.day_cost, args.day_records), args.max_cost, args.max_records)
    print(json.dumps(report))
    return _graded(report["status"])


#: Commands with their options: (name, default) with None for one that must be given.
COMMANDS = {
    "normalize-quotes": (normalize_quotes, {"source": None, "runs": None, "date": None, "out": None, "run-id": "", "force": False}),
    "ingest-trades": (ingest_trades, {"source": None, "date": None, "symbols": None, "out": None, "manifest": None, "vendor": "vendor", "dataset": "", "schema": "trades", "force": False}),
    "telemetry-quality": (telemetry_quality, {"quotes": None, "symbols": None, "report": None, "spread-limits": ""}),
    "reference-quality": (reference_quality, {"trades": None, "symbols": None, "report": None, "map": "", "limit": 0}),
    "tick-alignment": (tick_alignment, {"trades": None, "quotes": None, "report": None, "map": "", "symbols": "", "tolerance-ms": 250}),
    "bar-alignment": (bar_alignment, {"trades": None, "quotes": None, "report": None, "map": "", "symbols": "", "buckets": "15s,60s"}),
    "build-features": (build_features, {"trades": None, "quotes": None, "date": None, "out": None, "map": "", "buckets": "15s,60s", "force": False}),
    "feature-quality": (feature_quality, {"features": None, "report": None, "pairs": "", "buckets": "15s,60s"}),
    "eda": (eda, {"features": None, "out": None, "report": None, "candidates": "", "pairs": "", "least-rows": 5000, "force": False}),
    "compact": (compact, {"root": None, "layer": None, "today": None, "order": None, "target-mb": 256}),
    "export": (export, {"features": None, "out": None, "watermark-ns": 0, "buckets": "15s,60s", "origin": "synthetic"}),
    "plan": (plan, {"first": None, "last": None, "runs": None, "vendor": None, "stages": "normalize,quality,align,features", "day-cost": 0.0, "day-records": 0, "max-cost": 10.0, "max-records": 100_000_000}),
}


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="tickloom")
    sub = top.add_subparsers(dest="command", required=True)
    d = sub.add_parser("demo")
    d.add_argument("--root", default="runs")
    d.add_argument("--run-id", default="demo")
    d.add_argument("--seconds", type=int, default=120)
    d.add_argument("--seed", type=int, default=42)
    d.add_argument("--scenario", default="normal", choices=("normal", "invalid-timestamps", "crossed-quotes"))
    d.set_defaults(run=demo)
    i = sub.add_parser("inspect")
    i.add_argument("folder")
    i.set_defaults(run=inspect)
    b = sub.add_parser("bars")
    b.add_argument("trades")
    b.add_argument("out")
    b.add_argument("--buckets", default="15s,60s")
    b.set_defaults(run=bars)
    for name, (run, options) in COMMANDS.items():
        c = sub.add_parser(name)
        for option, value in options.items():
            if isinstance(value, bool):
                c.add_argument(f"--{option}", action="store_true")
            else:
                c.add_argument(f"--{option}", default=value, required=value is None, type=str if value is None else type(value))
        c.set_defaults(run=run)
    args = top.parse_args(argv)
    args.run_id = getattr(args, "run_id", None) or None
    return args.run(args)


if __name__ == "__main__":
    sys.exit(main())
