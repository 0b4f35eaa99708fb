"""Health of running streams: counts observed in the rows as they pass, published after each batch."""

from __future__ import annotations

import json
import os
import threading
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAME = "health"


def observed(ticks: DataFrame, symbol: str = "symbol", time_ms: str = "time_msc", recv_ms: str = "recv_ms") -> DataFrame:
    """``ticks`` with the batch's rows, crossed quotes and newest times measured on the way, without another pass."""
    crossed = F.col("ask") < F.col("bid") if {"bid", "ask"} <= set(ticks.columns) else F.lit(False)
    n = lambda c: F.sum(F.when(c, 1).otherwise(0))
    return ticks.observe(NAME, F.count(F.lit(1)).alias("rows"), n(F.col(symbol).isNull()).alias("without_symbol"), n(F.col(time_ms).isNull()).alias("without_time"), n(crossed).alias("crossed"), F.max(time_ms).alias("last_time_ms"), F.max(recv_ms).alias("last_recv_ms"))


def _written_whole(path: Path, snapshot: dict) -> None:
    draft = path.with_suffix(".part")
    draft.write_text(json.dumps(snapshot, sort_keys=True))
    os.replace(draft, path)


class HealthListener(StreamingQueryListener):
    """Snapshots of each stream's progress: totals since the start and the last batch, given to ``publish`` and kept in ``snapshots``."""

    def __init__(self, publish: Callable[[dict], None] | None = None):
        self.publish, self.snapshots, self.lock = publish, {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._tell(str(event.runId), {"query": event.name, "state": "RUNNING", "batches": 0, "rows": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        seen = p.observedMetrics.get(NAME)
        now = {"state": "RUNNING", "batch": p.batchId, "input_rows_per_s": p.inputRowsPerSecond, "batch_ms": p.batchDuration}
        if seen is not None:
            now |= seen.asDict()
        with self.lock:
            before = self.snapshots.get(str(p.runId), {"batches": 0, "rows": 0})
            total = {"batches": before["batches"] + 1} | {k: (before.get(k) or 0) + (now.get(k) or 0) for k in ("rows", "crossed", "without_symbol", "without_time")}
        self._tell(str(p.runId), now | total | {k: max(filter(None, (before.get(k), now.get(k))), default=None) for k in ("last_time_ms", "last_recv_ms")})

    def onQueryIdle(self, event) -> None:
        self._tell(str(event.runId), {"state": "IDLE"})

    def onQueryTerminated(self, event) -> None:
        self._tell(str(event.runId), {"state": "FAILED" if event.exception else "STOPPED", "error": event.exception})

    def _tell(self, run: str, new: dict) -> None:
        with self.lock:
            snapshot = self.snapshots[run] = self.snapshots.get(run, {}) | {"run": run} | new
        if self.publish:
            self.publish(snapshot)


def publish_to(folder: str | Path) -> Callable[[dict], None]:
    """Write each snapshot over the last one of its run, as a whole file."""
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    return lambda snapshot: _written_whole(folder / f"{snapshot['run']}.json", snapshot)


def watch(spark: SparkSession, publish: Callable[[dict], None] | None = None) -> HealthListener:
    listener = HealthListener(publish)
    spark.streams.addListener(listener)
    return listener
