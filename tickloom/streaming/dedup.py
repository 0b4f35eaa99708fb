"""Streaming form of tick de-duplication: keyed state, one tick of memory a symbol."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from tickloom.operators.ticks import HEARTBEAT_MS, TickState, packed

STATE = "value string, at long, count long, first_ms long, last_ms long"
OUT = "symbol string, time_msc long, value string, suppressed_count long, first_suppressed_ms long, last_suppressed_ms long"


def dedup_stream(ticks: DataFrame, values: list[str], heartbeat_ms: int = HEARTBEAT_MS) -> DataFrame:
    """Emitted ticks of a stream (symbol, time_msc, recv_ms, values); one state a symbol, kept between batches.

    A tick without a time is left out, as in the batch form.  Within a batch ticks are taken in order of time.
    """

    def run(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        s = TickState(heartbeat_ms)
        if state.exists:
            value, s.at, s.count, first, last = state.get
            s.last, s.first_ms, s.last_ms = (value,), None if first < 0 else first, None if last < 0 else last
        rows = []
        for t, r, v in pd.concat(list(batches)).sort_values(["time_msc", "recv_ms"], kind="stable")[["time_msc", "recv_ms", "value"]].itertuples(index=False):
            if (out := s.offer(int(t), (v,), int(r))) is not None:
                rows.append((key[0], int(t), v, *out))
        if s.last is not None:
            state.update((s.last[0], s.at, s.count, -1 if s.first_ms is None else s.first_ms, -1 if s.last_ms is None else s.last_ms))
        yield pd.DataFrame(rows, columns=["symbol", "time_msc", "value", "suppressed_count", "first_suppressed_ms", "last_suppressed_ms"]).astype({"first_suppressed_ms": "Int64", "last_suppressed_ms": "Int64"})

    known = ticks.where("time_msc is not null").select("symbol", "time_msc", "recv_ms", packed(values, ticks).alias("value"))
    return known.groupBy("symbol").applyInPandasWithState(run, OUT, STATE, "append", "NoTimeout")
