"""Calibration of a quote source's clock as keyed state of a stream, with a timeout for a source that falls silent."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from tickloom.operators.ticks import Evidence, OffsetState

OUT = "session string, at_ms long, status string, verified_offset_min int, event string"


def packed(s: OffsetState) -> str:
    plain = {k: getattr(s, k) for k in ("offsets_min", "required", "stale_ms", "unsafe_ms", "cached", "status", "verified", "seen_ms", "fresh_ms")}
    return json.dumps(plain | {"evidence": [[o, e.count, e.raw_ms, e.several, list(e.ages)] for o, e in s.evidence.items()]})


def unpacked(text: str) -> OffsetState:
    d = json.loads(text)
    evidence = {o: Evidence(n, raw, several, deque(ages, maxlen=1024)) for o, n, raw, several, ages in d.pop("evidence")}
    return OffsetState(**d | {"offsets_min": tuple(d["offsets_min"])}, evidence=evidence)


def replay(state: OffsetState, rows: list[tuple[int, int]], now_ms: int | None = None) -> Iterator[tuple[int, str, int | None, str | None]]:
    """Transitions (time, status, offset, event) of a session over ticks (raw time, receipt) in order of receipt, and at ``now_ms`` if it is given."""
    for raw, recv in [*rows, *([] if now_ms is None else [(None, now_ms)])]:
        for act in (lambda: state.tick_clock(recv), lambda: None if raw is None else state.observe(raw, recv)):  # noqa: B023
            before = (state.status, state.verified)
            event = act()
            if event or (state.status, state.verified) != before:
                yield recv, state.status, state.verified, event


def calibration_stream(ticks: DataFrame, offsets_min: tuple[int, ...], session: str = "session", raw: str = "time_msc_raw", recv: str = "recv_time_utc_ms", delay: str = "5 seconds", required: int = 20) -> DataFrame:
    """Transitions of each session's state; a silent session moves on when the watermark passes its next limit.

    Ticks without a time or receipt are left out.  Within a batch ticks are taken in order of receipt.
    """
    known = ticks.where(F.col(raw).isNotNull() & F.col(recv).isNotNull()).select(F.col(session).alias("session"), F.col(raw).alias("raw"), F.col(recv).alias("recv"), F.timestamp_millis(recv).alias("at")).withWatermark("at", delay)

    def run(key: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        state = unpacked(held.get[0]) if held.exists else OffsetState(offsets_min, required)
        if held.hasTimedOut:
            moves = list(replay(state, [], held.getCurrentWatermarkMs()))
        else:
            rows = sorted((int(r), int(t)) for b in batches for t, r in zip(b["raw"], b["recv"], strict=True))
            moves = list(replay(state, [(t, r) for r, t in rows]))
        held.update((packed(state),))
        since = state.fresh_ms if state.fresh_ms is not None else state.seen_ms
        limits = [since + ms for ms in (state.stale_ms, state.unsafe_ms) if since is not None and since + ms > held.getCurrentWatermarkMs()]
        if limits:
            held.setTimeoutTimestamp(min(limits))
        yield pd.DataFrame([(key[0], *m) for m in moves], columns=["session", "at_ms", "status", "verified_offset_min", "event"]).astype({"session": object, "status": object, "event": object, "verified_offset_min": "Int32", "at_ms": "int64"})

    return known.groupBy("session").applyInPandasWithState(run, OUT, "state string", "append", "EventTimeTimeout")
