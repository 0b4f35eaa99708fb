"""Reports of the quality stages: the same content as JSON and as text, both written once."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import stats
from tickloom.operators.metrics import contract_errors
from tickloom.operators.quality import decide_eda
from tickloom.plans.contract import ALL, FORBIDDEN
from tickloom.plans.lineage import write_once
from tickloom.plans.vocabulary import FAIL
from tickloom.sources.publish import Store

KINDS = ("telemetry_quality", "reference_quality", "tick_alignment", "bar_alignment", "feature_quality", "feature_eda")


def plain(value: object) -> object:
    """JSON values: numbers that aren't finite become null."""
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    if isinstance(value, float):
        return value if abs(value) < float("inf") else None
    return value if value is None or isinstance(value, bool | int | str) else str(value)


def table(frame: DataFrame) -> list[dict]:
    """Rows of a small table of metrics, sorted."""
    return sorted((r.asDict(recursive=True) for r in frame.collect()), key=str)


def _lines(value: object, depth: int = 0) -> list[str]:
    pad = "  " * depth
    if isinstance(value, Mapping):
        return [x for k, v in value.items() for x in ([f"{pad}{k}:", *_lines(v, depth + 1)] if isinstance(v, Mapping | list) else [f"{pad}{k}: {v}"])]
    if isinstance(value, list):
        return [x for v in value for x in (_lines(v, depth) + [f"{pad}--"] if isinstance(v, Mapping | list) else [f"{pad}{v}"])]
    return [f"{pad}{value}"]


def write_report(folder: Path, kind: str, status: str, metrics: Mapping[str, Sequence[Mapping]], **facts: object) -> dict:
    """``kind``.json and ``kind``.txt; raises where one is there already."""
    if kind not in KINDS:
        raise ValueError(f"{kind!r} is none of {KINDS}")
    report = plain({"report": kind, "status": status, **facts, "metrics": {k: list(v) for k, v in metrics.items()}})
    write_once(Path(folder) / f"{kind}.json", report)
    with open(Path(folder) / f"{kind}.txt", "x", encoding="utf-8") as f:
        f.write("\n".join([f"{kind.replace('_', ' ').upper()}: {status}", *_lines(report)]) + "\n")
        f.flush()
        os.fsync(f.fileno())
    return report


#: Tables of an exploration.
EDA = {"missingness": stats.missingness, "distribution": stats.distribution, "correlation": stats.correlation_summary}
TOP = 15


def write_eda(features: DataFrame, folder: str, keys: Sequence[str], names: Sequence[str], force: bool = False) -> dict[str, DataFrame]:
    """Missingness, distribution and correlation tables of an exploration, as written; raises where one is there already, unless forced."""
    spark = features.sparkSession
    there = Store(spark, folder)
    if not force and (taken := [name for name in EDA if there.exists(name)]):
        raise FileExistsError(f"{taken} are there already")
    for name, made in EDA.items():
        made(features, keys, names).write.mode("overwrite").parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in EDA}


def explore(features: DataFrame, folder: str, names: Sequence[str], pairs: Sequence[str] = (), least: int = 5000, force: bool = False) -> tuple[str, dict]:
    """An exploration of eligible feature rows: its status, and counts by pair with the columns that stand out (``TOP`` of each)."""
    keys = ["symbol_pair", "bucket_size"]
    errors = contract_errors(features, ALL, FORBIDDEN)
    if errors:
        return FAIL, {"errors": errors}
    ok = F.col("is_model_eligible_candidate")
    counts = table(features.groupBy("symbol_pair").agg(F.count(F.lit(1)).alias("rows"), F.sum(ok.cast("long")).alias("eligible")))
    by_pair = dict.fromkeys(pairs, 0) | {r["symbol_pair"]: r["eligible"] for r in counts}
    rows, eligible = sum(r["rows"] for r in counts), sum(r["eligible"] for r in counts)
    status = decide_eda(True, rows, eligible, by_pair, least)
    if not eligible:
        return status, {"pairs": counts, "rows": rows, "eligible": 0}
    made = write_eda(features.where(ok), folder, keys, names, force)
    top = lambda name, by, ties, cols: table(stats.top_n(made[name].where(by.isNotNull()), by, [*keys, *ties], TOP).select(*keys, *ties, *cols))
    corr = made["correlation"].agg(F.sum(F.col("is_statistically_significant").cast("long")).alias("a"), F.sum(F.col("is_small_sample_warning").cast("long")).alias("b")).first()
    return status, {
        "pairs": counts, "rows": rows, "eligible": eligible, "excluded": rows - eligible, "significant": corr["a"] or 0, "small_samples": corr["b"] or 0,
        "most_missing": top("missingness", F.col("null_rate"), ["feature"], ["null_rate"]), "heaviest_tails": top("distribution", F.col("heavy_tail_score"), ["feature"], ["heavy_tail_score"]),
        "strongest": top("correlation", F.col("abs_correlation"), ["feature_a", "feature_b"], ["abs_correlation", "p_value", "n"]),
    }
