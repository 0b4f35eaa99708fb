"""Exact deduplication by a stateful stream.

A Structured Streaming query reads the files once and keeps, in the disk-backed (RocksDB) state store and without any
expiry, one entry for each digest: the count of its rows, the stable identifier that stays (the largest), and the
content locator (file and row) of that row's bytes.  The aggregate combines on the map side, so one text that makes up
a third of all rows reaches its state partition as one row a task.  After the available files are taken in, the state
is read back as a table.  Each hit (a digest with several rows) is checked on full bytes against the row that the
locator names; rows that differ are grouped by their full bytes instead, so a digest collision can't join two texts.

Defined results: a null text counts as empty; no normalisation; a null identifier is smaller than any other; rows that
share identifier and text are one group like other copies and only one of them stays; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import broadcast_within, cut, fresh_path

#: While the stream runs: RocksDB holds the state, without files of a fixed size set aside for each partition.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
_LEAST = -(2**63)
#: Hits of one group that one verifying key takes; the kept text is repeated for each such block.
BLOCK = 2000
#: Digests of groups that are broadcast at most (about 200 bytes each); beyond it the join is shuffled.
BROADCAST_ROWS = 200_000


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _rows(read: DataFrame, id_col: str, text_col: str, digest: Callable[[Column], Column]) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return read.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("id"), text.alias("text"), digest(text).alias("digest"),
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"),
    )


def build_state(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha, checkpoint: str | None = None, files_per_batch: int = 4096) -> DataFrame:
    """Take in all files of ``path`` not yet taken in (by ``checkpoint``) and return the state: digest, id, file, row, n."""
    checkpoint = checkpoint or fresh_path(spark, "dedup-state")
    schema = spark.read.parquet(path).schema
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    try:
        # As a glob: the stream source takes a single file only so, and a folder of files as well.
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(f"{path[:-1]}[{path[-1]}]")
        rows = _rows(source, id_col, text_col, digest).select("digest", F.struct("id", "file", "row").alias("at"))
        kept = rows.groupBy("digest").agg(F.max("at").alias("at"), F.count(F.lit(1)).alias("n"))
        query = kept.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
        if query.lastProgress is None:  # an empty table makes no batch, and so no state
            return spark.createDataFrame([], "digest string, id long, file string, row long, n long")
        state = spark.read.format("statestore").load(checkpoint)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    best, count = state.schema["value"].dataType.names
    return state.select(F.col("key.digest").alias("digest"), *[F.col(f"value.{best}.{x}").alias(x) for x in ("id", "file", "row")], F.col(f"value.{count}").alias("n"))


def _verified(rows: DataFrame, state: DataFrame, block: int) -> DataFrame:
    """For each row of a digest with several rows: whether its bytes equal those at the locator."""
    many = cut(state.where(F.col("n") > 1).select("digest", F.col("file").alias("kf"), F.col("row").alias("kr"), F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")), "dedup-many")
    met = rows.join(broadcast_within(many, many.count(), BROADCAST_ROWS), "digest")  # only texts of hits are moved
    at = F.when((F.col("file") == F.col("kf")) & (F.col("row") == F.col("kr")), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(F.pmod(F.xxhash64("file", "row"), F.col("blocks")).cast("int")))
    dealt = met.select("digest", F.explode(at).alias("b"), "text", ((F.col("file") == F.col("kf")) & (F.col("row") == F.col("kr"))).alias("stays"))
    kept = dealt.where("stays").select("digest", "b", F.col("text").alias("kept_text"))
    return dealt.where("not stays").join(kept, ["digest", "b"]).select("digest", (F.col("text") == F.col("kept_text")).alias("same"))


def stream_dedup(spark: SparkSession, path: str, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha, checkpoint: str | None = None, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``path``: id, keep_id, group_size, kept, digest, file, row."""
    state = cut(build_state(spark, path, id_col, text_col, digest, checkpoint), "dedup-kept")
    read = spark.read.parquet(path)
    rows = _rows(read, id_col, text_col, digest)
    differ = cut(_verified(rows, state, block).where(~F.col("same")).select("digest").distinct(), "dedup-differ")
    found = rows.select("id", "digest", "file", "row").join(state.select("digest", F.col("id").alias("keep_id"), F.col("file").alias("kf"), F.col("row").alias("kr"), F.col("n").alias("group_size")), "digest")
    out = found.select("id", "keep_id", "group_size", ((F.col("file") == F.col("kf")) & (F.col("row") == F.col("kr"))).alias("kept"), "digest", "file", "row")
    if differ.isEmpty():
        return out
    # Texts that share a digest and differ: grouped by the bytes themselves.
    odd = rows.join(differ, "digest")
    true = odd.groupBy("digest", "text").agg(F.max(F.struct("id", "file", "row")).alias("at"), F.count(F.lit(1)).alias("group_size"))
    redone = odd.join(true, ["digest", "text"]).select("id", F.col("at.id").alias("keep_id"), "group_size", ((F.col("file") == F.col("at.file")) & (F.col("row") == F.col("at.row"))).alias("kept"), "digest", "file", "row")
    return out.join(differ, "digest", "left_anti").select(*redone.columns).unionByName(redone)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = stream_dedup(spark, f"{sf_dir}/documents.parquet")
    back = lambda c: F.when(F.col(c) != F.lit(_LEAST), F.col(c))
    return d.select(back("id").alias("doc_id"), back("keep_id").alias("keep_id"), "group_size", "kept", F.col("digest").alias("text_sha256"))


SQL = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""
