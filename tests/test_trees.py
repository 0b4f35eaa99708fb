import json
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import metrics, ticks
from tickloom.plans import lineage, reports
from tickloom.sources import trees


def test_tree_is_written_once_and_replaced_with_force(spark, tmp_path):
    root = str(tmp_path / "silver")
    rows = lambda n: spark.createDataFrame([(s, "2026-01-05", k) for s in ("A", "B") for k in range(n)], "symbol string, date string, v long")
    assert trees.write_tree(rows(3), root, "silver")["leaves"] == ["symbol=A/date=2026-01-05", "symbol=B/date=2026-01-05"]
    with pytest.raises(FileExistsError):
        trees.write_tree(rows(5), root, "silver")
    assert spark.read.parquet(root).count() == 6
    assert len(trees.write_tree(rows(2).where("symbol = 'A'"), root, "silver", force=True)["replaced"]) == 1
    assert {r["symbol"]: r["count"] for r in spark.read.parquet(root).groupBy("symbol").count().collect()} == {"A": 2, "B": 3}
    assert not [p for p in (tmp_path / "silver").iterdir() if p.name.startswith(".draft")]
    assert trees.closed_leaves(spark, root, "silver", "2026-01-06") == ["symbol=A/date=2026-01-05", "symbol=B/date=2026-01-05"] and not trees.closed_leaves(spark, root, "silver", "2026-01-05")
    assert trees.write_tree(rows(0), root, "silver")["leaves"] == []


def test_reference_manifest_and_bronze_pruning(spark, tmp_path):
    t = spark.createDataFrame([("ES", "2026-01-05", 10), ("ES", "2026-01-06", 20), ("NQ", "2026-01-05", 30)], "symbol string, date string, event_time_utc_ns long")
    m = trees.write_reference(t, str(tmp_path / "ref"), "vendor")
    assert m["rows"] == 3 and len(m["partitions"]) == 3 and m["source"] == "vendor"
    q = t.withColumn("hour", F.lit("07"))
    trees.write_tree(q, str(tmp_path / "bronze"), "bronze")
    got = trees.read_bronze(spark, str(tmp_path / "bronze"), "event_time_utc_ns long, extra double, symbol string, date string, hour string", ["ES"], ["2026-01-06"], ["07"])
    assert [(r.event_time_utc_ns, r.extra) for r in got.collect()] == [(20, None)]
    assert "PartitionFilters: [isnotnull" in got._jdf.queryExecution().executedPlan().toString()


def test_files_together_and_their_footers(spark, tmp_path):
    a, b, c = (str(tmp_path / x) for x in "abc")
    spark.createDataFrame([(1, "x")], "t int, s string").coalesce(1).write.parquet(a)
    spark.createDataFrame([(1 << 40, 2.5)], "t long, p double").coalesce(1).write.parquet(b)
    got = trees.concat_files(spark, [a, b], ["t"])
    assert dict(got.dtypes) == {"t": "bigint", "s": "string", "p": "double"} and got.count() == 2
    with pytest.raises(ValueError):
        trees.concat_files(spark, [a, b], ["s"])
    assert trees.footers(spark, a).agg(F.sum("rows")).first()[0] == 1
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "part-0.parquet").write_bytes(b"PAR1 no parquet PAR1")
    assert trees.unreadable(spark, [a, c]) == [c]
    assert tuple(trees.time_bounds(got, "t").first()) == (1, 1 << 40, 2)


def test_reports_are_written_once(tmp_path):
    r = reports.write_report(tmp_path, "tick_alignment", "PASS", {"symbols": [{"symbol": "ES", "rate": 0.5, "odd": float("nan")}]}, day="2026-01-05")
    assert r["metrics"]["symbols"][0] == {"symbol": "ES", "rate": 0.5, "odd": None} and json.loads((tmp_path / "tick_alignment.json").read_text()) == r
    assert (tmp_path / "tick_alignment.txt").read_text().startswith("TICK ALIGNMENT: PASS\n")
    with pytest.raises(FileExistsError):
        reports.write_report(tmp_path, "tick_alignment", "PASS", {})
    with pytest.raises(ValueError):
        reports.write_report(tmp_path, "other", "PASS", {})


def test_all_reasons_of_a_match(spark):
    t = spark.createDataFrame([("A", 100, 2, 1.0, "BUY", True), ("B", 100, 3, 1.0, "UNKNOWN", True), ("C", 100, 4, 1.0, "SELL", True)], "symbol string, event_ms long, size long, price double, aggressor_side string, is_reference_trade_valid boolean")
    q = spark.createDataFrame([("A", 90, True, 1.5), ("B", 5000, True, 1.5)], "symbol string, quote_ms long, is_join_safe boolean, mid double")
    got = {r.symbol: r.reason for r in metrics.align(t, q, 50).collect()}
    assert got == {"A": None, "B": "no_overlap_window", "C": "no_mt5_rows_for_symbol"}
    assert {r.reason for r in metrics.align(t, q.drop("is_join_safe"), 50).collect()} == {"missing_required_columns"}
    m = {r.symbol: r for r in metrics.alignment_summary(metrics.align(t, q, 50)).collect()}
    assert m["A"].match_rate == 1 and m["B"].n_no_overlap_window == 1 and m["B"].volume_no_overlap_window == 3 and m["B"].unknown_volume == 3


def test_dedup_against_the_state_machine(spark):
    rng = random.Random(3)
    rows = [("A" if rng.random() < 0.7 else "B", rng.randrange(40_000) if rng.random() < 0.98 else None, k, rng.choice([1.0, 1.0, 1.0, 2.0, None, float("nan")]), rng.choice([None, "x"])) for k in range(600)]
    d = spark.createDataFrame(rows, "symbol string, t long, r long, v double, w string")
    got = sorted((x.symbol, x.r, x.suppressed_count, x.first_suppressed_ms, x.last_suppressed_ms) for x in ticks.dedup_ticks(d, ["symbol"], "t", ["v", "w"], "r", 1000).collect())
    want = []
    for s in "AB":
        state = ticks.TickState(1000)
        for _, t, r, v, w in sorted((x for x in rows if x[0] == s and x[1] is not None), key=lambda x: (x[1], x[2])):
            if (out := state.offer(t, (str(v), w), r)) is not None:
                want.append((s, r, *out))
    assert got == sorted(want)


@pytest.mark.parametrize("values", [[1.0], [1.0] * 30 + [2.0], [1.0, 1.0, None, float("nan"), -0.0, 0.0]])
def test_dedup_in_slices_equals_groups(spark, values):
    """Long chains over many slices, gaps, ties, bursts, quiet slices, null keys and changes of value."""
    rng = random.Random(len(values))
    rows, t = [], 0
    for k in range(5000):
        t += rng.choice([0, 1, 40, 90, 90, 130] + ([2500, 30_000] if k % 97 == 0 else []))
        rows.append((rng.choice(["A", "A", "A", None]), t - 100_000, k, rng.choice(values), "x"))
    rows += [("lone", 5, 1, 1.0, "x"), ("lone", None, 2, 1.0, "x")]
    d = spark.createDataFrame(rows, "symbol string, t long, r long, v double, extra string").repartition(4)
    run = lambda n: sorted(map(str, ticks.dedup_ticks(d, ["symbol"], "t", ["v"], "r", 100, n).collect()))
    whole = run(10**9)
    assert run(10) == whole and len(whole) > 500


def test_runs_from_manifests(tmp_path):
    """A run without a summary counts by its logger's manifest; a summary's word comes first."""
    clock = lambda state, offset: {"timestamp_semantics": {"status": state, "verified_offset_min": offset}}
    ok, pending = "OFFSET_VERIFIED_FOR_SESSION", "TIMESTAMP_SEMANTICS_PENDING"
    runs = {
        "run_20260105_a": (None, clock(ok, 120)), "run_20260105_b": (None, clock(pending, 120)), "run_20260105_c": (None, clock(ok, True)), "run_20260106_d": ({"metadata_verified_for_normalization": False}, clock(ok, 60)),
        "run_20260107_e": ({"metadata_verified_for_normalization": True, "timestamp_semantics_status": ok, "started_at_utc": "2026-01-07T23:00:00Z"}, clock(pending, 180)), "run_20260108_f": (None, None),
    }
    for name, (summary, manifest) in runs.items():
        folder = tmp_path / "logger_runs" / name
        folder.mkdir(parents=True)
        for file, doc in (("summary.json", summary), ("logger_manifest.json", manifest)):
            if doc is not None:
                (folder / file).write_text(json.dumps(doc))
    (tmp_path / "logger_runs" / "run_20260108_f" / "summary.json").write_text("{broken")
    got = {r.run_id: (r.verified, r.offset_min, r.day) for r in lineage.read_runs(tmp_path)}
    assert got == {"run_20260105_a": (True, 120, "2026-01-05"), "run_20260105_b": (False, None, "2026-01-05"), "run_20260105_c": (False, None, "2026-01-05"), "run_20260106_d": (False, None, "2026-01-06"), "run_20260107_e": (True, 180, "2026-01-07"), "run_20260108_f": (False, None, "2026-01-08")}
    assert lineage.resolve_metadata(tmp_path, "2026-01-05")["offset_min"] == 120 and lineage.resolve_metadata(tmp_path, "2026-01-07", run_id="run_20260107_e")["offset_min"] == 180
    for day in ("2026-01-06", "2026-01-08"):
        with pytest.raises(LookupError):
            lineage.resolve_metadata(tmp_path, day)
    with pytest.raises(ValueError):
        lineage.resolve_metadata(tmp_path, "2026-01-06", run_id="run_20260106_d")


def test_metadata_trust_and_days(tmp_path):
    good = {"started_at_utc": "2026-01-05T10:00:00Z", "ended_at_utc": "2026-01-05T11:00:00Z", "verified_offset_min": 120, "metadata_verified_for_normalization": True, "timestamp_semantics_status": "OFFSET_VERIFIED_FOR_SESSION"}
    for name, more in (("r1", {}), ("r2", {"timestamp_semantics_status": "TIMESTAMP_SEMANTICS_PENDING"}), ("r3", {"verified_offset_min": True})):
        lineage.write_once(tmp_path / name / "summary.json", good | more)
    assert lineage.resolve_metadata(tmp_path, "2026-01-05")["offset_min"] == 120
    for run in ("r2", "r3", "r4"):
        with pytest.raises((ValueError, LookupError)):
            lineage.resolve_metadata(tmp_path, "2026-01-05", run_id=run)
    with pytest.raises(LookupError):
        lineage.resolve_metadata(tmp_path, "2026-01-06")
    report = lineage.run_report(lineage.read_runs(tmp_path), "2026-01-05")
    assert report["run_id"] == "r1" and report["runs"] == {"r1": "selected", "r2": "not_verified", "r3": "not_verified"}
    (tmp_path / "a").write_text("x")
    record = {"status": "PASS", "started": 10, "ended": 20, "artifacts": [lineage.artifact(tmp_path / "a", tmp_path)]}
    state = lambda r, up=(), now=30: lineage.trust(r, up, tmp_path, now)
    assert [state(None), state(record), state(record, [{"ended": 15}]), state({"status": "FAIL"}), state({"status": "RUNNING", "started": 0}), state({"status": "RUNNING", "started": 0}, now=1e6)] == ["MISSING", "TRUSTED", "STALE", "FAILED", "RUNNING", "ZOMBIE"]
    (tmp_path / "a").write_text("y")
    assert state(record) == "CHANGED"
    plans = lineage.plan_days("2026-01-05", "2026-01-06", lambda d: True, lambda d: d.endswith("05"), lambda d, s: False, ["a", "b"])
    assert lineage.dry_run_report(plans, lambda d: (None, None), 10, 10)["status"] == "FAIL" and lineage.dry_run_report(plans, lambda d: (3.0, 5), 10, 10)["cost"] == 3.0
    done = lineage.run_days(plans, lambda d: "TRUNCATED", lambda d, s: "PASS")
    assert done["2026-01-05"]["status"] == "PASS" and done["2026-01-06"] == {"stages": {"download": "FAIL", "a": "SKIPPED", "b": "SKIPPED"}, "status": "FAIL"}
    tries, waits = [], []
    with pytest.raises(RuntimeError):
        lineage.retried(lambda: (tries.append(1), (_ for _ in ()).throw(RuntimeError("busy")))[0], sleep=waits.append)
    assert len(tries) == 3 and waits == [1.0, 2.0] and lineage.directory_completeness({"a": (1, 5), "b": (5, 5)}) == "TRUNCATED"
