"""Sink of raw quotes: buffered batches, each flushed once into the partition tree, whatever is repeated.

The trigger interval is the flush age and the rows of a file the flush size.  A batch is written aside under its number
and published by a journal that names its files; their final names hold the number too, so putting them in place can be
repeated.  A pointer file remembers the last finished batch: a batch that a restarted stream delivers again is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.sources.publish import Store

FLUSH_ROWS = 100_000
BY = ("symbol", "date", "hour")
LAST, PLAN = ".last-batch.json", ".batch-"


def with_partitions(quotes: DataFrame) -> DataFrame:
    """Date and hour of receipt."""
    at = F.timestamp_millis("recv_time_utc_ms")
    return quotes.withColumns({"date": F.date_format(at, "yyyy-MM-dd"), "hour": F.date_format(at, "HH")})


def _place(store: Store, batch: int) -> None:
    """Put a published batch's files in their leaves and remember the batch; every step may be repeated."""
    plan = json.loads(store.read_text(f"{PLAN}{batch}.json"))
    for source, target in plan["files"]:
        if store.exists(f"{PLAN}{batch}/{source}"):
            store.rename(f"{PLAN}{batch}/{source}", target)
    if store.exists(LAST):
        store.delete(LAST)
    store.write_text(LAST, json.dumps({"batch": batch, "rows": plan["rows"]}))
    for name in (f"{PLAN}{batch}", f"{PLAN}{batch}.json"):
        store.delete(name)


def recover(store: Store) -> int:
    """Finish a batch that was published but not placed; returns the last finished batch, -1 before the first."""
    for name in store.names(PLAN):
        if name.endswith(".json"):
            _place(store, int(name.removeprefix(PLAN).removesuffix(".json")))
    return json.loads(store.read_text(LAST))["batch"] if store.exists(LAST) else -1


def append_batch(rows: DataFrame, batch: int, root: str, flush_rows: int = FLUSH_ROWS, before_flush: Callable[[dict], None] | None = None, step: Callable[[str], None] = lambda _: None) -> bool:
    """Append one batch to the tree, or pass it over where it is there already.  ``before_flush`` is told the batch and its rows."""
    store = Store(rows.sparkSession, root, step)
    if batch <= recover(store):
        return False
    draft = f"{PLAN}{batch}"
    store.delete(draft)  # of an attempt that wasn't published
    dealt = with_partitions(rows).repartition(*BY)
    dealt.write.option("maxRecordsPerFile", flush_rows).partitionBy(*BY).parquet(f"{store.root}/{draft}")
    files = [(f"{leaf}/{f}", f"{leaf}/batch-{batch:012d}-{k:05d}.parquet") for leaf in store.leaves(draft) for k, f in enumerate(store.files(f"{draft}/{leaf}"))]
    n = rows.sparkSession.read.parquet(*[f"{store.root}/{draft}/{f}" for f, _ in files]).count() if files else 0  # from the footers
    if before_flush:
        before_flush({"batch": batch, "rows": n, "files": len(files)})
    store.write_text(f"{PLAN}{batch}.json", json.dumps({"files": files, "rows": n}))
    _place(store, batch)
    return True


def quote_sink(quotes: DataFrame, path: str, checkpoint: str, interval: str = "10 seconds", flush_rows: int = FLUSH_ROWS, before_flush: Callable[[dict], None] | None = None) -> DataStreamWriter:
    """Raw quotes of a stream by symbol, date and hour of receipt."""
    return quotes.writeStream.foreachBatch(lambda rows, batch: append_batch(rows, batch, path, flush_rows, before_flush) and None).option("checkpointLocation", checkpoint).trigger(processingTime=interval)


def written(spark: SparkSession, root: str) -> dict:
    """The last finished batch of a sink."""
    store = Store(spark, root)
    recover(store)
    return json.loads(store.read_text(LAST)) if store.exists(LAST) else {"batch": -1, "rows": 0}
