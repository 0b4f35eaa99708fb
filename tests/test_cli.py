import json

import pytest

from tickloom import cli
from tickloom.plans import demo
from tickloom.sources import fixtures


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cli")
    assert demo.run_demo(spark, str(root), "r", 120)["status"] == "PASS"
    return root / "r"


def test_commands_of_all_stages(spark, run, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(cli, "_session", lambda: spark)
    pairs = ",".join(f"{a}={b}" for a, (b, _) in fixtures.PAIRS.items())
    cme, mt5 = ",".join(fixtures.PAIRS), ",".join(b for b, _ in fixtures.PAIRS.values())
    at = {"trades": str(run / "silver_trades"), "quotes": str(run / "silver_quotes"), "report": str(tmp_path / "reports")}
    call = lambda name, **k: cli.main([name, *[x for o, v in k.items() for x in (f"--{o.replace('_', '-')}", str(v))]])
    both = {k: at[k] for k in ("trades", "quotes")}
    assert call("telemetry-quality", quotes=at["quotes"], symbols=mt5, report=at["report"]) == 0
    assert call("telemetry-quality", quotes=at["quotes"], symbols=mt5, report=at["report"]) == 3
    assert call("reference-quality", trades=at["trades"], symbols=cme, report=at["report"]) in (0, 1)
    assert call("tick-alignment", **both, report=at["report"], map=pairs) == 0
    assert call("bar-alignment", **both, report=at["report"], map=pairs) in (0, 1)
    assert call("build-features", **both, date="2026-01-05", out=tmp_path / "gold", map=pairs) == 0
    assert call("build-features", **both, date="2026-01-05", out=tmp_path / "gold", map=pairs) == 3
    assert call("feature-quality", features=tmp_path / "gold", report=at["report"]) == 0
    assert call("feature-quality", features=tmp_path / "gold", report=tmp_path / "other", pairs="NQ_NDX100,ES_SPX500,YM_US30") == 1
    assert call("feature-quality", features=tmp_path / "gold", report=tmp_path / "third", buckets="15s,60s,5m") == 0  # one of the required sizes is enough
    assert call("bar-alignment", **both, report=tmp_path / "other", map=pairs, symbols=f"{mt5},US30") == 1
    assert call("tick-alignment", **both, report=tmp_path / "other", map=pairs, symbols=f"{mt5},US30") == 1
    assert json.loads((tmp_path / "other" / "tick_alignment.json").read_text())["statuses"]["US30"] == "cme"
    three = {"features": tmp_path / "gold", "candidates": "cme_trade_count,mt5_tick_count,basis_close_bps"}
    assert call("eda", **three, out=tmp_path / "eda", report=at["report"], least_rows=5) == 0
    assert spark.read.parquet(str(tmp_path / "eda" / "missingness")).count() == 3 * 4
    found = json.loads((tmp_path / "reports" / "feature_eda.json").read_text())
    assert found["eligible"] + found["excluded"] == found["rows"] and len(found["metrics"]["strongest"]) > 0
    assert call("eda", **three, out=tmp_path / "eda", report=tmp_path / "third", least_rows=5) == 3
    assert call("eda", **three, out=tmp_path / "eda2", report=tmp_path / "third", pairs="YM_US30", least_rows=5) == 1
    assert call("export", features=tmp_path / "gold", out=tmp_path / "dataset", watermark_ns=2 * 10**18) == 0
    assert call("export", features=tmp_path / "gold", out=tmp_path / "dataset", watermark_ns=2 * 10**18) == 3
    assert call("compact", root=tmp_path / "gold", layer="gold", today="2026-01-06", order="bucket_start_utc_ns") == 0
    assert sorted(p.stem for p in (tmp_path / "reports").glob("*.json")) == ["bar_alignment", "feature_eda", "feature_quality", "reference_quality", "telemetry_quality", "tick_alignment"]
    capsys.readouterr()
    assert call("plan", first="2026-01-05", last="2026-01-06", runs=tmp_path, vendor=tmp_path) == 0
    assert [d["reasons"] for d in json.loads(capsys.readouterr().out)["days"]] == [["no quotes"]] * 2
    assert call("normalize-quotes", source=run / "bronze_quotes", runs=tmp_path, date="2026-01-05", out=tmp_path / "silver") == 2
    assert call("demo", root=run.parent, run_id="again", seconds=120) == 0 and cli.main(["inspect", str(run)]) == 0
