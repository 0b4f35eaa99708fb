"""End to end: fixtures, normalisation, quality, alignment, features, feature quality, export, with lineage."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.exprs import bucket_sizes, ns_to_ms
from tickloom.operators import asof, bars, export, features, metrics, normalize, quality
from tickloom.plans.contract import ALL, FORBIDDEN
from tickloom.plans.lineage import FAIL, PASS, Stage, new_run, write_once, run_stages, verify
from tickloom.sources import fixtures

SIZES = "15s,60s"


class GateError(RuntimeError):
    pass


def _need(status: str, what: str) -> None:
    if status != PASS:
        raise GateError(f"{what} is {status}")


def feature_frame(trades: DataFrame, quotes: DataFrame, day: str) -> DataFrame:
    """Feature table of canonical trades and normalised quotes; the mapping table is small and given."""
    spark = trades.sparkSession
    pairs = F.broadcast(spark.createDataFrame([(a, b, f"{a}_{b}") for a, (b, _) in fixtures.PAIRS.items()], "cme_symbol string, mt5_symbol string, symbol_pair string"))
    sizes = bucket_sizes(SIZES)
    a = bars.trade_bars(trades.join(pairs, trades["symbol"] == pairs["cme_symbol"]), sizes, keys=["symbol_pair"])
    b = bars.quote_bars(quotes.join(pairs, quotes["symbol"] == pairs["mt5_symbol"]), sizes, ["monotonic_ns"], keys=["symbol_pair"])
    joined = bars.join_bars(a, b, ["symbol_pair"]).join(pairs, "symbol_pair").withColumn("date", F.lit(day))
    return features.build_features(joined)


def run_demo(spark: SparkSession, root: str, run_id: str, seconds: int = 120, seed: int = 42, scenario: str = "normal") -> dict:
    """Run all stages in a new folder and return the manifest."""
    folder = new_run(Path(root), run_id, {"seconds": seconds, "seed": seed, "scenario": scenario})
    day = "2026-01-05"
    at = lambda name: folder / name
    read = lambda name: spark.read.parquet(str(at(name)))

    def write(df: DataFrame, name: str) -> Path:
        df.write.parquet(str(at(name)))
        return at(name)

    def ingestion():
        return [write(fixtures.raw_quotes(spark, seconds, seed, scenario), "bronze_quotes"), write(fixtures.vendor_trades(spark, seconds, seed), "bronze_trades")], {}

    def normalization():
        offset = None if scenario == "invalid-timestamps" else fixtures.OFFSET_MIN
        q = normalize.normalize_quotes(read("bronze_quotes"), offset)
        return [write(q, "silver_quotes"), write(normalize.normalize_trades(read("bronze_trades"), list(fixtures.PAIRS)), "silver_trades")], {}

    def checks():
        m = {r["symbol"]: r.asDict() for r in quality.telemetry_metrics(read("silver_quotes")).collect()}
        t = {r["symbol"]: r.asDict() for r in quality.reference_metrics(read("silver_trades")).collect()}
        _need(quality.decide_telemetry(m, [b for b, _ in fixtures.PAIRS.values()], {"NDX100": 50}), "telemetry quality")
        rows, valid = (sum(x[k] for x in t.values()) for k in ("rows", "valid"))
        missing = sum(r["missing_bbo"] or 0 for r in metrics.reference_summary(read("silver_trades").where("is_bbo_available")).collect())
        _need(quality.decide_reference(rows, valid, t, list(fixtures.PAIRS), missing_bbo=missing), "reference quality")
        return [], {"quotes": sum(x["rows"] for x in m.values()), "trades": rows}

    def alignment():
        mapped = F.create_map(*[F.lit(x) for a, (b, _) in fixtures.PAIRS.items() for x in (a, b)])
        t = read("silver_trades").withColumns({"event_ms": ns_to_ms(F.col("event_time_utc_ns")), "symbol": F.element_at(mapped, F.col("symbol"))})
        q = read("silver_quotes").withColumn("quote_ms", F.col("time_msc_utc_ms"))
        statuses = metrics.alignment_statuses(t, q, [b for b, _ in fixtures.PAIRS.values()], 250)
        r = asof.asof_match(t, q, 250, tie=["monotonic_ns"]).agg(F.avg(F.col("is_matched").cast("double")), F.sum(F.when(~F.col("is_matched"), F.col("size")).otherwise(0)) / F.sum("size")).first()
        _need(quality.decide_alignment(statuses, r[0], r[1]), "alignment")
        return [], {"match_rate": r[0]}

    def build():
        return [write(feature_frame(read("silver_trades"), read("silver_quotes"), day), "gold")], {}

    def feature_quality():
        g = read("gold").groupBy("symbol_pair", "bucket_size").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("is_model_eligible_candidate").cast("long")).alias("eligible")).collect()
        errors = metrics.contract_errors(read("gold"), ALL, FORBIDDEN)
        _need(quality.decide_features(errors, {(r[0], r[1]): {"rows": r[2], "eligible": r[3]} for r in g}, [f"{a}_{b}" for a, (b, _) in fixtures.PAIRS.items()]), "feature quality")
        return [], {}

    def publish():
        rows = export.export_rows(read("gold"), (fixtures.START_MS + seconds * 1000) * 1_000_000)
        export.write_dataset(rows, str(at("dataset")))
        return [at("dataset")], {"rows": read("dataset").count()}

    stages = [
        Stage("ingestion", (), ingestion), Stage("normalization", ("ingestion",), normalization), Stage("quality", ("normalization",), checks), Stage("alignment", ("quality",), alignment),
        Stage("features", ("alignment",), build), Stage("feature_quality", ("features",), feature_quality), Stage("export", ("feature_quality",), publish),
    ]
    records = run_stages(folder, stages)
    manifest = {"run_id": run_id, "status": PASS if all(r["status"] == PASS for r in records) else FAIL, "stages": records}
    write_once(folder / "manifest.json", manifest)
    return manifest


def inspect_run(spark: SparkSession, folder: str) -> list[dict]:
    """Verify all hashes of a run and summarise its dataset."""
    manifest = json.loads((Path(folder) / "manifest.json").read_text())
    verify(Path(folder), [a for s in manifest["stages"] for a in s["artifacts"]])
    return [r.asDict() for r in export.summarize_dataset(spark, spark.read.parquet(str(Path(folder) / "dataset"))).orderBy("symbol_pair", "bucket_size").collect()]
