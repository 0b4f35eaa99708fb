"""Compaction keeps every row, notices a changed one, and deletes sources only after that."""

import pytest
from pyspark.sql import functions as F

from tickloom.sources import compaction, publish, trees


def test_bins():
    sizes = [("a", 50), ("b", 60), ("c", 200), ("d", 30), ("e", 10)]
    got = compaction.bins(sizes, 100)
    assert sorted(x for b in got for x in b) == list("abcde") and ["c"] in got and len(got) == 3
    assert compaction.bins([], 100) == []


def _many(spark, root, files=500):
    """A tree with one closed leaf of many small files and one of today."""
    rows = spark.range(2 * files).select(F.pmod("id", F.lit(files)).alias("k"), "id", (F.col("id") * 0.5).alias("v"), F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("s"))
    rows.repartition(files, "k").drop("k").write.parquet(f"{root}/symbol=A/date=2026-01-05")
    rows.limit(3).drop("k").write.parquet(f"{root}/symbol=A/date=2026-01-06")
    return publish.Store(spark, root)


def test_five_hundred_files_become_few(spark, tmp_path):
    root = str(tmp_path / "tree")
    store = _many(spark, root)
    leaf, before = "symbol=A/date=2026-01-05", compaction.content(spark.read.parquet(f"{root}/symbol=A/date=2026-01-05"))
    files = len(store.files(leaf))
    target = sum(s for _, s in store.sizes(leaf)) // 4
    assert trees.closed_leaves(spark, root, "silver", "2026-01-06") == [leaf]
    done = compaction.compact_closed(spark, root, "silver", "2026-01-06", ["id"], target)
    assert [(d["leaf"], d["files"], d["rows"]) for d in done] == [(leaf, files, 1000)] and files > 300
    assert done[0]["after"] == len(store.files(leaf)) <= 5
    assert compaction.content(spark.read.parquet(f"{root}/{leaf}")) == before
    assert spark.read.parquet(root).count() == 1003
    assert compaction.compact_leaf(spark, root, leaf, ["id"], 1)["after"] == done[0]["after"]  # nothing to gain


@pytest.mark.parametrize("damage", ["row", "lost", "twice"])
def test_changed_content_keeps_the_sources(spark, tmp_path, damage):
    root = str(tmp_path / "tree")
    store = _many(spark, root, 20)
    leaf = "symbol=A/date=2026-01-05"
    before, sources = compaction.content(spark.read.parquet(f"{root}/{leaf}")), store.files(leaf)

    def step(name):
        if name == "verify":
            draft = f"{root}/{store.names(publish.DRAFT)[0]}/{leaf}"
            rows = spark.read.parquet(draft)
            odd = {"row": rows.withColumn("v", F.when(F.col("id") == 7, 0.0).otherwise(F.col("v"))), "lost": rows.where("id <> 7"), "twice": rows.union(rows.where("id = 7"))}[damage]
            odd.coalesce(1).write.parquet(f"{draft}-odd")
            store.delete(draft.removeprefix(f"{root}/"))
            store.rename(f"{draft}-odd".removeprefix(f"{root}/"), draft.removeprefix(f"{root}/"))

    with pytest.raises(compaction.ContentChanged):
        compaction.compact_leaf(spark, root, leaf, ["id"], step=step)
    assert store.files(leaf) == sources and compaction.content(spark.read.parquet(f"{root}/{leaf}")) == before
    assert store.names(publish.DRAFT) == []


def test_a_fault_at_each_step(spark, tmp_path):
    leaf, at = "symbol=A/date=2026-01-05", 0
    while True:
        at += 1
        root, seen = str(tmp_path / f"t{at}"), []
        _many(spark, root, 6)

        def step(name, seen=seen, at=at):
            seen.append(name)
            if len(seen) == at:
                raise RuntimeError(name)

        try:
            compaction.compact_leaf(spark, root, leaf, ["id"], step=step)
        except RuntimeError:
            assert publish.read_tree(spark, root).where("date = '2026-01-05'").count() == 12, seen[-1]
            compaction.compact_leaf(spark, root, leaf, ["id"])
            assert spark.read.parquet(f"{root}/{leaf}").count() == 12
        else:
            break
    assert at > 6


def test_bounds_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") - 500).alias("a"), (F.col("id") * 0.25).alias("b"), F.when(F.col("id") > 9, F.col("id")).alias("c"), F.col("id").cast("string").alias("s")).repartition(7).write.parquet(path)
    got = trees.footer_statistics(spark, path, ["a", "b", "c"])
    assert "PushedAggregation: [COUNT(*), MIN(a), MAX(a), COUNT(a)" in got._jdf.queryExecution().executedPlan().toString()
    assert got.first().asDict() == {"n": 1000, "min_a": -500, "max_a": 499, "count_a": 1000, "min_b": 0.0, "max_b": 249.75, "count_b": 1000, "min_c": 10, "max_c": 999, "count_c": 990}
    with pytest.raises(ValueError, match="footers"):
        trees.footer_statistics(spark, path, ["s"])
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
