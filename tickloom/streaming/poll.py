"""Polling a quote source as a stream: repeated times are left out, and a stop flag ends it between batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def first_of_time(ticks: DataFrame, keys: Sequence[str] = ("symbol", "time_msc"), time_ms: str = "time_msc", delay: str = "10 minutes") -> DataFrame:
    """One tick of each key and time: a poll that returns the tick of the last one again adds nothing.

    Of repeated ones the first to arrive stays.  State is kept for ``delay`` behind the newest time; a tick without a time,
    or of 1970's first millisecond or before (where a stream's watermark begins), is left out.
    """
    known = ticks.where(F.col(time_ms).isNotNull()).withColumn("__at", F.timestamp_millis(time_ms)).withWatermark("__at", delay)
    return known.dropDuplicatesWithinWatermark(list(keys)).drop("__at")


def poll(writer: DataStreamWriter, stop: Callable[[], bool], every_s: float = 0.2, longest_s: float | None = None) -> StreamingQuery:
    """Run a stream until the flag is set, its source ends, or the time is over; a failure of the stream is raised."""
    query, began = writer.start(), time.monotonic()
    try:
        while query.isActive and not stop() and (longest_s is None or time.monotonic() - began < longest_s):
            query.awaitTermination(every_s)
    finally:
        query.stop()
    if (e := query.exception()) is not None:
        raise e
    return query
