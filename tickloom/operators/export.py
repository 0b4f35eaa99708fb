"""Export of closed, eligible feature rows with their contract, and the summary of a dataset."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.exprs import is_finite
from tickloom.plans.contract import CANDIDATES, IDENTITY
from tickloom.sources.publish import Store


class ExportError(ValueError):
    pass


def closed_rows(features: DataFrame, watermark_ns: int, buckets: Sequence[str] = ("15s", "60s")) -> DataFrame:
    return features.where(F.col("is_model_eligible_candidate") & (F.col("bucket_end_utc_ns") <= watermark_ns) & F.col("bucket_size").isin(*buckets))


def export_rows(features: DataFrame, watermark_ns: int, buckets: Sequence[str] = ("15s", "60s"), origin: str = "synthetic") -> DataFrame:
    """Closed rows with identity, candidates and origin; raises without rows, with repeated ids or non-finite values."""
    rows = closed_rows(features, watermark_ns, buckets).select(*IDENTITY, *CANDIDATES, F.lit(origin).alias("data_origin"))
    odd = [F.max((F.col(c).isNotNull() & ~is_finite(F.col(c).cast("double"))).cast("int")).alias(c) for c in CANDIDATES]
    found = rows.agg(F.count(F.lit(1)).alias("__n"), F.count_distinct("feature_row_id").alias("__ids"), *odd).first()
    if not found["__n"]:
        raise ExportError("no eligible closed rows")
    if found["__ids"] != found["__n"]:
        raise ExportError("feature_row_id is not unique")
    if bad := [c for c in CANDIDATES if found[c]]:
        raise ExportError(f"values that are not finite in {bad}")
    return rows


def write_dataset(rows: DataFrame, path: str) -> None:
    """One sorted zstd file; for data sets that fit a single writer."""
    rows.coalesce(1).sortWithinPartitions("symbol_pair", "bucket_size", "feature_timestamp_utc_ns").write.mode("errorifexists").option("compression", "zstd").parquet(path)


def dataset_contract(rows: DataFrame, watermark_ns: int, origin: str) -> dict:
    """What a reader of an exported dataset may rely on (the names and policies are fixed values)."""
    kinds = dict(rows.dtypes)
    return {
        "schema_version": "1.0", "data_origin": origin, "rows": rows.count(), "identity_columns": list(IDENTITY), "feature_columns": list(CANDIDATES), "provenance_columns": ["data_origin"],
        "feature_dtypes": {c: kinds[c] for c in CANDIDATES}, "feature_availability": "bucket_end_utc_ns", "watermark_utc_ns": watermark_ns,
        "null_policy": "retain_warmup_and_undefined_statistics; fit_imputation_on_training_only", "label_columns": [],
        "split_policy": "chronological; purge_overlapping_label_horizons_after_label_design",
    }


def export_dataset(features: DataFrame, folder: str, watermark_ns: int, buckets: Sequence[str] = ("15s", "60s"), origin: str = "synthetic") -> dict:
    """The dataset's file and its contract in a new folder; raises where there is nothing to export or a dataset already."""
    store = Store(features.sparkSession, folder)
    if store.exists("dataset_contract.json") or store.exists("model_features.parquet"):
        raise FileExistsError(f"{folder} holds a dataset already")
    write_dataset(export_rows(features, watermark_ns, buckets, origin), f"{store.root}/model_features.parquet")
    contract = dataset_contract(features.sparkSession.read.parquet(f"{store.root}/model_features.parquet"), watermark_ns, origin)
    store.write_text("dataset_contract.json", json.dumps(contract, indent=2, sort_keys=True))
    return contract


def summarize_dataset(spark: SparkSession, rows: DataFrame) -> DataFrame:
    return spark.sql("""
        SELECT symbol_pair, bucket_size, count(*) AS n_rows, min(feature_timestamp_utc_ns) AS first_ts, max(feature_timestamp_utc_ns) AS last_ts,
               round(avg(mt5_join_safe_tick_ratio), 6) AS mean_join_safe_ratio
        FROM {rows} GROUP BY symbol_pair, bucket_size""", rows=rows)
