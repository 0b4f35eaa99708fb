import json

import pytest

from tickloom.plans import demo, lineage
from tickloom.plans.registry import QUERIES, SQL
from tickloom.sources import selection

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, same, name):
    same(QUERIES[name](spark, SF), SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_demo_end_to_end(spark, tmp_path):
    m = demo.run_demo(spark, str(tmp_path), "run1", 120)
    assert m["status"] == "PASS", [s.get("error") for s in m["stages"]]
    rows = demo.inspect_run(spark, str(tmp_path / "run1"))
    assert [(r["symbol_pair"], r["bucket_size"], r["n_rows"]) for r in rows] == [("ES_SPX500", "15s", 8), ("ES_SPX500", "60s", 2), ("NQ_NDX100", "15s", 8), ("NQ_NDX100", "60s", 2)]
    part = next((tmp_path / "run1" / "dataset").glob("part-*"))
    part.write_bytes(part.read_bytes() + b"x")
    with pytest.raises(ValueError):
        demo.inspect_run(spark, str(tmp_path / "run1"))


@pytest.mark.parametrize(("scenario", "stage"), [("invalid-timestamps", "normalization"), ("crossed-quotes", "quality")])
def test_demo_rejects(spark, tmp_path, scenario, stage):
    m = demo.run_demo(spark, str(tmp_path), "bad", 120, scenario=scenario)
    status = {s["name"]: s["status"] for s in m["stages"]}
    assert m["status"] == "FAIL" and status[stage] == "FAIL" and status["export"] == "SKIPPED"
    assert not (tmp_path / "bad" / "gold").exists()


def test_stage_runner(tmp_path):
    def boom():
        raise RuntimeError("no")

    r = lineage.run_stages(tmp_path, [lineage.Stage("a", (), boom), lineage.Stage("b", ("a",), boom), lineage.Stage("c", (), lambda: ([], {"n": 1}))])
    assert [x["status"] for x in r] == ["FAIL", "SKIPPED", "PASS"] and r[1]["blocked_by"] == ["a"]
    with pytest.raises(ValueError):
        lineage.run_stages(tmp_path / "x", [lineage.Stage("b", ("a",), boom)])
    lineage.write_once(tmp_path / "one.json", {"a": 1})
    with pytest.raises(FileExistsError):
        lineage.write_once(tmp_path / "one.json", {"a": 2})
    with pytest.raises(ValueError):
        lineage.artifact(tmp_path / ".." / "x", tmp_path)


def test_run_selection(tmp_path):
    for name, a, b in (("r1", "2026-01-05T10:00:00Z", "2026-01-05T11:00:00Z"), ("r2", "2026-01-05T20:00:00Z", "2026-01-06T03:00:00Z")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "summary.json").write_text(json.dumps({"started_at_utc": a, "ended_at_utc": b, "verified_offset_min": 120, "metadata_verified_for_normalization": True, "timestamp_semantics_status": "OFFSET_VERIFIED_FOR_SESSION"}))
    runs = lineage.read_runs(tmp_path)
    assert lineage.select_run(runs, "2026-01-05", "longest").run_id == "r2" and lineage.select_run(runs, "2026-01-05", "explicit", "r1").run_id == "r1"
    with pytest.raises(LookupError):
        lineage.select_run(runs, "2026-01-05")
    with pytest.raises(LookupError):
        lineage.select_run(runs, "2026-01-06")


def test_plans_and_gates():
    p = lineage.plan_days("2026-01-05", "2026-01-06", lambda d: d.endswith("05"), lambda d: False, lambda d, s: s == "normalize", ["normalize", "quality", "align"])
    assert p[0].download and p[0].stages == ("quality", "align") and p[1].reasons == ("no quotes",)
    assert lineage.completeness(10, 10) == "TRUNCATED" and lineage.completeness(9, 10) == "COMPLETE"
    assert lineage.cost_gate(None, 1, 1, 1) == "FAIL" and lineage.cost_gate(0.5, 1, 1, 1) == "PASS"
    assert lineage.parse_map("a=1, b=2") == {"a": "1", "b": "2"}
    with pytest.raises(ValueError):
        lineage.parse_map("a")


def test_selection(spark, tmp_path):
    day = tmp_path / "symbol=A" / "date=2026-01-05"
    assert selection.select_silver(tmp_path, "A", "2026-01-05").layout == "missing"
    for run in ("r1", "r2"):
        (day / f"run_id={run}").mkdir(parents=True)
        spark.range(3).coalesce(1).write.mode("overwrite").parquet(str(day / f"run_id={run}"))
    assert not selection.select_silver(tmp_path, "A", "2026-01-05").ok
    one = selection.select_silver(tmp_path, "A", "2026-01-05", "r1")
    assert one.ok and selection.read_selection(spark, tmp_path, one).count() == 3
    assert selection.dates(tmp_path, "A") == ["2026-01-05"] and selection.symbols(tmp_path) == ["A"]


def test_streaming_dedup(spark, tmp_path):
    from tickloom.sources.fixtures import tick_pattern
    from tickloom.streaming.dedup import dedup_stream

    tick_pattern(spark, "duplicate_burst", 200).coalesce(1).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    q = dedup_stream(source, ["bid_scaled", "ask_scaled"]).writeStream.format("memory").queryName("deduped").outputMode("append").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.time_msc for r in spark.sql("select time_msc from deduped order by 1").collect()] == [1_767_614_400_000, 1_767_614_401_000]
