"""Publishing survives a fault at every step: the rows are always the old or the new ones, once."""

import pytest
from pyspark.sql import functions as F

from tickloom.sources import publish, trees


class Crash(RuntimeError):
    pass


def faults(at):
    """A hook that fails before the ``at``-th action."""
    seen = []

    def step(name):
        seen.append(name)
        if len(seen) == at:
            raise Crash(name)

    return step, seen


def rows_of(spark, root):
    return sorted((r.symbol, str(r.date), r.v) for r in publish.read_tree(spark, root).collect())


def test_a_fault_at_each_step_of_a_forced_write(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([(s, "2026-01-05", v) for s in "AB"], "symbol string, date string, v long").coalesce(1)
    want = lambda v: [(s, "2026-01-05", v) for s in "AB"]
    root = str(tmp_path / "whole")
    trees.write_tree(rows(0), root, "silver")
    step, steps = faults(0)
    trees.write_tree(rows(1), root, "silver", force=True, step=step)
    assert rows_of(spark, root) == want(1) and len(steps) >= 9
    switched = []
    root = str(tmp_path / "tree")
    trees.write_tree(rows(0), root, "silver")
    now = 0
    for k in range(1, len(steps) + 1):
        step, seen = faults(k)
        with pytest.raises(Crash):
            trees.write_tree(rows(k), root, "silver", force=True, step=step)
        got = rows_of(spark, root)
        assert got in (want(now), want(k)), seen[-1]
        switched.append(got == want(k))
        publish.recover(publish.Store(spark, root))
        assert rows_of(spark, root) == got and sorted((r.symbol, str(r.date), r.v) for r in spark.read.parquet(root).collect()) == got
        now = k if switched[-1] else now
    assert switched == sorted(switched) and True in switched and False in switched  # one switch, and no way back
    trees.write_tree(rows(99), root, "silver", force=True)
    assert rows_of(spark, root) == want(99)
    publish.sweep(publish.Store(spark, root))
    assert sorted(p.name for p in (tmp_path / "tree").iterdir()) == ["symbol=A", "symbol=B"]


def test_a_store_that_refuses_loses_nothing(spark, tmp_path):
    rows = lambda v: spark.createDataFrame([("A", "2026-01-05", v)], "symbol string, date string, v long")
    root = str(tmp_path / "tree")
    trees.write_tree(rows(1), root, "silver")
    store = publish.Store(spark, root, attempts=2, wait_s=0)
    draft = publish.begin(store)
    rows(2).write.partitionBy("symbol", "date").parquet(f"{root}/{draft}")
    refused = []

    def rename(old, new, put=store.rename):
        if old.startswith(publish.DRAFT):
            refused.append(old)
            raise OSError("refused")
        put(old, new)

    store.rename = rename
    with pytest.raises(OSError, match="refused"):
        publish.commit(store, draft)
    assert refused and rows_of(spark, root) == [("A", "2026-01-05", 2)]  # switched, not yet in place
    with pytest.raises(publish.Busy):
        publish.commit(publish.Store(spark, root), f"{publish.DRAFT}other")
    assert publish.recover(publish.Store(spark, root)) and spark.read.parquet(root).first().v == 2


def test_a_leaf_that_goes_and_one_that_stays(spark, tmp_path):
    root = str(tmp_path / "tree")
    spark.range(6).select("id", F.pmod("id", F.lit(3)).alias("part")).write.partitionBy("part").parquet(root)
    for k in range(1, 12):
        step, seen = faults(k)
        store = publish.Store(spark, root, step)
        draft = f"{publish.DRAFT}{k}"
        spark.createDataFrame([(100, 0)], "id long, part int").write.partitionBy("part").parquet(f"{root}/{draft}")
        try:
            publish.commit(store, draft, ["part=1"])
        except Crash:
            got = sorted(r.id for r in publish.read_tree(spark, root).collect())
            assert got in ([0, 1, 2, 3, 4, 5], [2, 5, 100]), seen[-1]
            publish.recover(publish.Store(spark, root))
            if got == [2, 5, 100]:
                break
        else:
            break
    assert sorted(r.id for r in publish.read_tree(spark, root).collect()) == [2, 5, 100]


def test_text_files_are_whole(spark, tmp_path):
    step, _ = faults(2)
    with pytest.raises(Crash):
        publish.Store(spark, str(tmp_path), step).write_text(".journal-x.json", "{}")
    store = publish.Store(spark, str(tmp_path))
    assert store.names(publish.JOURNAL) == [".journal-x.json.part"] and publish.recover(store) == [] and store.names(publish.JOURNAL) == []
    store.write_text("a", "é")
    assert store.read_text("a") == "é"
