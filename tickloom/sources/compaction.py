"""Compaction of closed leaves: few large files instead of many, put in place only if their content is the same.

Files are packed into bins by their bytes.  The content's digest doesn't depend on the order of rows: their number, the
sum of a 64-bit hash of each, and the exclusive or of another.  The sources and the new files are read once each to be
compared; only then the leaf is switched (``publish``) and the sources go.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources import publish
from tickloom.sources.trees import PARTITIONS, closed_leaves

TARGET_BYTES = 256 << 20


class ContentChanged(RuntimeError):
    """The rewritten files don't hold the rows of the sources; these are kept."""


def bins(sizes: Sequence[tuple[str, int]], target: int) -> list[list[str]]:
    """Files packed by first fit, the largest first; a file beyond the target has a bin of its own."""
    free: list[int] = []
    out: list[list[str]] = []
    for name, size in sorted(sizes, key=lambda x: (-x[1], x[0])):
        k = next((k for k, room in enumerate(free) if size <= room), len(out))
        if k == len(out):
            free.append(target)
            out.append([])
        free[k] -= size
        out[k].append(name)
    return out


def digest(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell tables of other rows apart, whatever their order."""
    cols = [F.col(f"`{c}`") for c in sorted(columns)]
    return [F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*cols).cast("decimal(38,0)")).alias("total"), F.bit_xor(F.xxhash64(F.lit(7), *cols)).alias("parity")]


def content(df: DataFrame) -> dict:
    return df.agg(*digest(df.columns)).first().asDict()


def compact_leaf(spark: SparkSession, root: str, leaf: str, order: Sequence[str], target_bytes: int = TARGET_BYTES, step: Callable[[str], None] = lambda _: None) -> dict:
    """Rewrite one leaf's files; returns the files and bytes before, the files after, and the rows."""
    store = publish.Store(spark, root, step)
    draft = publish.begin(store)
    sizes = store.sizes(leaf)
    packed = bins(sizes, target_bytes)
    if len(packed) >= len(sizes):
        return {"leaf": leaf, "files": len(sizes), "bytes": sum(s for _, s in sizes), "after": len(sizes), "rows": None}
    whole = spark.read.parquet(*[f"{store.root}/{leaf}/{f}" for f, _ in sizes])
    dealt = spark.createDataFrame([(f, k) for k, names in enumerate(packed) for f in names], "__file string, __bin int")  # a row a file
    before = content(whole)
    rows = whole.withColumn("__file", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))
    rows = rows.join(F.broadcast(dealt), "__file").repartitionByRange(len(packed), "__bin").sortWithinPartitions("__bin", *order)
    rows.select(*[F.col(f"`{c}`") for c in whole.columns]).write.option("compression", "zstd").parquet(f"{store.root}/{draft}/{leaf}")
    step("verify")
    now = content(spark.read.schema(whole.schema).parquet(f"{store.root}/{draft}/{leaf}"))
    if now != before:
        store.delete(draft)
        raise ContentChanged(f"{leaf}: {before} became {now}")
    publish.commit(store, draft)
    return {"leaf": leaf, "files": len(sizes), "bytes": sum(s for _, s in sizes), "after": len(store.files(leaf)), "rows": now["rows"]}


def compact_closed(spark: SparkSession, root: str, layer: str, today: str, order: Sequence[str], target_bytes: int = TARGET_BYTES) -> list[dict]:
    """Compact all leaves of days before today that have more files than they need."""
    if layer not in PARTITIONS:
        raise ValueError(f"no layer {layer!r}")
    return [compact_leaf(spark, root, leaf, order, target_bytes) for leaf in closed_leaves(spark, root, layer, today)]
