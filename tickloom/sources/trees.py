"""Partition trees: ``symbol=/date=/hour=`` of raw quotes, ``symbol=/date=[/run_id=]`` of normalised ones, ``symbol_pair=/date=/bucket=`` of features.

Written aside and published by one switch (``publish``): a leaf that is there is replaced only with ``force``, and its
old rows go only after the new ones are in place.  Paths may be in any store that Spark reads.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.sources import publish

PARTITIONS = {"bronze": ("symbol", "date", "hour"), "silver": ("symbol", "date"), "run_silver": ("symbol", "date", "run_id"), "reference": ("symbol", "date"), "gold": ("symbol_pair", "date", "bucket")}
#: Columns of the rows whose folders have another name: the column stays in the files.
FOLDERS = {"gold": {"bucket": "bucket_size"}}


def read_bronze(spark: SparkSession, root: str, schema: T.StructType | str, symbols: Sequence[str] | None = None, dates: Sequence[str] | None = None, hours: Sequence[str] | None = None) -> DataFrame:
    """Raw quotes under a given schema (columns that a file lacks are null); partitions are pruned before files are listed for reading.

    Partition columns are strings, as their folders are named: hour 02 stays 02 where the schema leaves them out.
    """
    given = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = [f for f in given if f.name not in PARTITIONS["bronze"]]
    full = T.StructType([*known, *[T.StructField(c, T.StringType()) for c in PARTITIONS["bronze"]]])
    out = publish.read_tree(spark, root, full)
    for name, wanted in (("symbol", symbols), ("date", dates), ("hour", hours)):
        if wanted is not None:
            out = out.where(F.col(name).isin(*wanted))
    return out


def concat_files(spark: SparkSession, files: Sequence[str], required: Sequence[str], source: str = "") -> DataFrame:
    """Files of one kind together, by name: each must have the required columns; numbers of differing types are widened, other columns may be absent.

    A column whose types have no common wider one (say a number and a text) raises: a cast would change its values.  Files
    of the same schema are read by one scan, so the plan grows with the number of schemas and not of files.  A column
    ``source`` gets the path of each row's file, if it is named.
    """
    if not files:
        raise FileNotFoundError("no files")
    by_schema: dict[str, list[str]] = {}
    for f in files:
        table = spark.read.parquet(f)
        if missing := [c for c in required if c not in table.columns]:
            raise ValueError(f"{f} lacks {missing}")
        by_schema.setdefault(table.schema.json(), []).append(f)
    tables = [spark.read.schema(T.StructType.fromJson(json.loads(kind))).parquet(*some) for kind, some in by_schema.items()]
    if source:
        tables = [t.withColumn(source, F.col("_metadata.file_path")) for t in tables]
    order = {"tinyint": 0, "smallint": 1, "int": 2, "bigint": 3, "float": 4, "double": 5}
    kinds: dict[str, str] = {}
    for name, kind in (x for t in tables for x in t.dtypes):
        old = kinds.setdefault(name, kind)
        if kind != old:
            if not {kind, old} <= order.keys():
                raise ValueError(f"{name} is {old} in one file and {kind} in another")
            kinds[name] = "double" if {kind, old} == {"bigint", "float"} else max(kind, old, key=order.__getitem__)
    cast = [t.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in t.columns]) for t in tables]
    out = cast[0]
    for t in cast[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def footers(spark: SparkSession, *paths: str) -> DataFrame:
    """Rows of each file without reading columns: the scan has an empty schema, so Spark takes the counts from the footers."""
    return spark.read.parquet(*paths).groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count(F.lit(1)).alias("rows"))


def footer_statistics(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row with n, and the min, max and number of values of each column, answered from the files' footers alone.

    Spark pushes these aggregates into the scan of its newer reader (PushedAggregation in the plan), so no row is read.
    Numbers, dates and booleans have footers that may be trusted for this; text has not and raises.
    """
    switches = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}
    with configured(spark, switches):
        table = spark.read.parquet(path)
        kinds = dict(table.dtypes)
        if odd := [c for c in columns if kinds[c] not in ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "boolean")]:
            raise ValueError(f"footers don't hold exact bounds of {odd}")
        out = table.agg(F.count(F.lit(1)).alias("n"), *[f(F.col(f"`{c}`")).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max), ("count", F.count))])
        out._jdf.queryExecution().executedPlan()  # planned while the switches hold
    return out


@contextmanager
def configured(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for a while."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Data files below a path, or the path of a single file."""
    store = publish.Store(spark, path)
    if store.fs.getFileStatus(store._path("")).isFile():
        return [path]
    return [f"{store.root}/{leaf}/{f}" for leaf in ["", *store.leaves("")] for f in store.files(leaf)]


def unreadable(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Files that one of two readers can't open: the footer, or a scan of every column.

    All files are scanned by one job that skips what it can't read; only those whose counted rows differ from their
    footers' (or that have no footer) are looked at one by one.
    """
    suspects = set(files)
    try:
        held = {r["file"].split("/")[-1]: r["rows"] for r in footers(spark, *files).collect()}
        rows = spark.read.option("ignoreCorruptFiles", "true").parquet(*files)
        scanned = rows.select(F.col("_metadata.file_name").alias("file"), F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).alias("h")).groupBy("file").agg(F.count("h").alias("n")).collect()
        sound = {r["file"] for r in scanned if held.get(r["file"]) == r["n"]}
        suspects = {f for f in files if f.split("/")[-1] not in sound}
    except Exception as e:
        if not _of_spark(e):
            raise
    bad = []
    for f in sorted(suspects):
        try:
            t = spark.read.parquet(f)
            t.count()
            t.write.format("noop").mode("overwrite").save()
        except Exception as e:
            if not _of_spark(e):
                raise
            bad.append(f)
    return bad


def _of_spark(e: Exception) -> bool:
    """Whether reading failed, and not this program."""
    return isinstance(e, AnalysisException | Py4JJavaError | OSError | ValueError) or "pyspark" in type(e).__module__


def time_bounds(rows: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """First and last time by key, from one column."""
    return rows.groupBy(*keys).agg(F.min(column).alias("first"), F.max(column).alias("last"), F.count(F.lit(1)).alias("rows"))


def write_tree(rows: DataFrame, root: str, layer: str, force: bool = False, files_per_leaf: int = 1, step: Callable[[str], None] = lambda _: None) -> dict:
    """Write rows into a layer's tree, a leaf for each combination of its partition columns, all leaves at once.

    Without ``force`` a leaf that is there raises before anything is published; with it only the leaves written are
    replaced.  A large leaf may have several files, each written by a task of its own.  ``step`` is told each action.
    """
    spark, by = rows.sparkSession, PARTITIONS[layer]
    rows = rows.withColumns({k: F.col(v) for k, v in FOLDERS.get(layer, {}).items()})
    store = publish.Store(spark, root, step)
    draft = publish.begin(store)
    dealt = rows.repartition(*by) if files_per_leaf <= 1 else rows.repartition(*by, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns if c not in by]), F.lit(files_per_leaf)))
    dealt.sortWithinPartitions(*by).write.partitionBy(*by).parquet(f"{root.rstrip('/')}/{draft}")
    leaves = store.leaves(draft)
    taken = [x for x in leaves if store.exists(x)]
    if taken and not force:
        store.delete(draft)
        raise FileExistsError(f"{taken} are there already")
    publish.commit(store, draft)
    return {"layer": layer, "leaves": leaves, "replaced": taken}


def write_reference(trades: DataFrame, root: str, source: str, force: bool = False) -> dict:
    """The reference tree and its manifest: rows, bounds and leaves by symbol and date."""
    done = write_tree(trades, root, "reference", force)
    counts = time_bounds(trades, "event_time_utc_ns", ("symbol", "date")).orderBy("symbol", "date").collect()
    return done | {"source": source, "partitions": [r.asDict() for r in counts], "rows": sum(r["rows"] for r in counts)}


def closed_leaves(spark: SparkSession, root: str, layer: str, today: str) -> list[str]:
    """Leaves of days before today: nothing is added to them any more."""
    parts = lambda leaf: dict(x.split("=", 1) for x in leaf.split("/") if "=" in x)
    return [x for x in publish.Store(spark, root).leaves("") if set(p := parts(x)) == set(PARTITIONS[layer]) and p["date"] < today]
