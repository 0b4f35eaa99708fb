"""Streams: batches that are repeated or interrupted, repeated times, health, and calibration by replay."""

import json
import random

import pytest

from tickloom.operators import ticks
from tickloom.sources.publish import Store
from tickloom.streaming import calibration, dedup, health, poll, sink

QUOTES = "symbol string, time_msc long, recv_time_utc_ms long, recv_ms long, bid double, ask double"


class Crash(RuntimeError):
    pass


def source(spark, folder, batches, schema=QUOTES):
    """A stream with one file a batch."""
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{k:03d}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def quote(k, symbol="A", bid=1.0, ask=2.0):
    return (symbol, 1000 * k, 1_767_614_400_000 + 1_700_000 * k, 1000 * k + 5, bid, ask)


def test_each_step_of_a_batch_may_fail(spark, tmp_path):
    rows = lambda ks: spark.createDataFrame([quote(k) for k in ks], QUOTES)
    steps = []
    sink.append_batch(rows(range(4)), 0, str(tmp_path / "whole"), step=steps.append)
    for at in range(1, len(steps) + 1):
        root, seen = str(tmp_path / f"t{at}"), []

        def step(name, seen=seen, at=at):
            seen.append(name)
            if len(seen) == at:
                raise Crash(name)

        with pytest.raises(Crash):
            sink.append_batch(rows(range(4)), 0, root, step=step)
        sink.append_batch(rows(range(4)), 0, root)  # the same batch again
        assert sink.append_batch(rows(range(4)), 0, root) is False
        assert sorted(r.time_msc for r in spark.read.parquet(root).collect()) == [0, 1000, 2000, 3000], seen[-1]
        assert sink.written(spark, root) == {"batch": 0, "rows": 4}
        assert [n for n in Store(spark, root).names(".") if n.startswith(sink.PLAN)] == []


def test_a_killed_stream_writes_each_row_once(spark, tmp_path):
    stream = source(spark, tmp_path / "in", [[quote(3 * b + k) for k in range(3)] for b in range(4)])
    root, checkpoint, flushes = str(tmp_path / "out"), str(tmp_path / "ck"), []

    def dies(facts):
        flushes.append(facts)
        if len(flushes) == 3:
            raise Crash("killed before the flush")

    for hook in (dies, flushes.append):
        q = sink.quote_sink(stream, root, checkpoint, "0 seconds", flush_rows=2, before_flush=hook).start()
        try:
            q.processAllAvailable()
        except Exception as e:
            assert "killed" in str(e)
        q.stop()
    got = spark.read.parquet(root)
    assert sorted(r.time_msc for r in got.collect()) == [1000 * k for k in range(12)]
    assert {"symbol", "date", "hour"} <= set(got.columns) and sink.written(spark, root)["batch"] == 3
    assert [f["batch"] for f in flushes] == [0, 1, 2, 2, 3] and all(f["rows"] == 3 for f in flushes)
    for leaf in Store(spark, root).leaves(""):
        assert all(spark.read.parquet(f"{root}/{leaf}/{f}").count() <= 2 for f in Store(spark, root).files(leaf))


def test_repeated_times_and_the_stop_flag(spark, tmp_path):
    rng = random.Random(1)
    rows = [[quote(1 + rng.randrange(20), rng.choice("AB")) for _ in range(15)] + [("A", None, 0, 0, 1.0, 1.0)] for _ in range(3)]
    stream = source(spark, tmp_path / "in", rows)
    writer = poll.first_of_time(stream).writeStream.format("memory").queryName("first_of_time").option("checkpointLocation", str(tmp_path / "ck"))
    want = {(r[0], r[1]) for b in rows for r in b if r[1] is not None}
    poll.poll(writer, lambda: spark.table("first_of_time").count() >= len(want) if spark.catalog.tableExists("first_of_time") else False, longest_s=90)
    got = [(r.symbol, r.time_msc) for r in spark.table("first_of_time").collect()]
    assert sorted(got) == sorted(want)
    stopped = poll.poll(stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck2")), lambda: True)
    assert not stopped.isActive


def test_health_of_a_stream(spark, tmp_path):
    listener = health.watch(spark, health.publish_to(tmp_path / "health"))
    try:
        stream = source(spark, tmp_path / "in", [[quote(0), quote(1, bid=3.0)], [quote(2, None), quote(5)], [quote(4)]])
        q = health.observed(stream).writeStream.format("noop").queryName("watched").option("checkpointLocation", str(tmp_path / "ck")).start()
        q.processAllAvailable()
        run = str(q.runId)
        q.stop()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
        for _ in range(100):
            if listener.snapshots.get(run, {}).get("state") == "STOPPED":
                break
            import time

            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    seen = json.loads((tmp_path / "health" / f"{run}.json").read_text())
    assert (seen["rows"], seen["crossed"], seen["without_symbol"], seen["last_time_ms"], seen["state"]) == (5, 1, 1, 5000, "STOPPED")
    assert seen["batches"] >= 3 and seen == listener.snapshots[run]


def test_calibration_state_goes_through_json():
    s = ticks.OffsetState((0, 120), required=5)
    for k in range(7):
        s.observe(120 * 60_000 + 1000 * k, 1000 * k + 40)
    again = calibration.unpacked(calibration.packed(s))
    assert again == s and again.verified == 120


def test_calibration_of_a_stream_equals_a_replay(spark, tmp_path):
    offset = lambda o, a, b: [(o * 60_000 + 1000 * k, 1000 * k + 40) for k in range(a, b)]
    rows = offset(120, 0, 30) + offset(180, 100, 140)  # verified, silent, then an hour later: a shift
    batches = [[("s", *r) for r in rows[k : k + 10]] + [("other", 0, rows[k][1])] for k in range(0, len(rows), 10)]
    batches += [[("clock", 0, 1_000_000)], [("clock", 0, 1_000_001)]]  # the watermark passes: the first session falls silent
    stream = source(spark, tmp_path / "in", batches, "session string, time_msc_raw long, recv_time_utc_ms long")
    q = calibration.calibration_stream(stream, (0, 120, 180)).writeStream.format("memory").queryName("calibrated").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    got = [(r.at_ms, r.status, r.verified_offset_min, r.event) for r in spark.table("calibrated").where("session = 's'").orderBy("at_ms").collect()]
    state = ticks.OffsetState((0, 120, 180))
    want = list(calibration.replay(state, rows))
    names = [(s, o, e) for _, s, o, e in want]
    assert names[0] == (ticks.OFFSET_VERIFIED, 120, None) and (ticks.OFFSET_VERIFIED, 180, "DST_SHIFT_DETECTED") in names
    late = [x for x in got if x not in want]
    assert [x for x in got if x in want] == want  # what the ticks decide
    assert [(s, e) for _, s, _, e in late] == [(ticks.PENDING, "DOWNGRADED_AFTER_STALE_GAP")] or [e for *_, e in late] == ["DOWNGRADED_AFTER_STALE_GAP", "MARKED_UNSAFE_FOR_JOIN"]  # what silence decides


def test_dedup_of_a_stream_without_times(spark, tmp_path):
    rows = [[("A", 0, 1, 7), ("A", None, 2, 7)], [("A", 500, 3, 7), ("A", 1000, 4, 7)]]
    stream = source(spark, tmp_path / "in", rows, "symbol string, time_msc long, recv_ms long, v long")
    q = dedup.dedup_stream(stream, ["v"]).writeStream.format("memory").queryName("no_times").option("checkpointLocation", str(tmp_path / "ck")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.time_msc, r.suppressed_count) for r in spark.table("no_times").collect()) == [(0, 0), (1000, 1)]
