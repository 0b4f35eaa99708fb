"""Publish folders of a tree all at once: written aside, switched by one journal file, put in place so that any step may fail.

A publication has a draft folder with the new leaves beside the tree.  Writing its journal is the switch: before that
the old rows count, after that the new ones.  What follows only tidies up and can be repeated from any point: for each
leaf the old folder moves aside, the draft's leaf takes its place, and at last what was moved aside goes, then the
journal.  ``recover`` repeats it after a crash, and ``read_tree`` reads the right rows at any time: leaves that a journal
names are read from the draft while they are still there.  One writer publishes to a tree at a time; nothing is ever
deleted before its successor is complete.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRAFT, ASIDE, JOURNAL = ".draft-", ".aside-", ".journal-"


class Busy(RuntimeError):
    """Another publication of the tree has begun and isn't finished."""


class Store:
    """The file system of a path, as far as publishing needs it; ``step`` is told each action before it is done."""

    def __init__(self, spark: SparkSession, root: str, step: Callable[[str], None] = lambda _: None, attempts: int = 5, wait_s: float = 0.05):
        self.jvm, self.root = spark._jvm, root.rstrip("/")
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())
        self.step, self.attempts, self.wait_s = step, attempts, wait_s

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self._path(name))

    def names(self, prefix: str) -> list[str]:
        if not self.fs.exists(self._path("")):
            return []
        return sorted(n for s in self.fs.listStatus(self._path("")) if (n := s.getPath().getName()).startswith(prefix))

    def leaves(self, under: str) -> list[str]:
        """Folders that hold data files, by their path below ``under`` (a name may look like a number)."""
        if not self.exists(under):
            return []
        top, found = self.fs.makeQualified(self._path(under)).toUri().getPath(), set()
        files = self.fs.listFiles(self._path(under), True)
        while files.hasNext():
            f = files.next().getPath()
            folder = f.getParent().toUri().getPath()[len(top) :].strip("/")
            if not f.getName().startswith(("_", ".")) and not folder.startswith("."):
                found.add(folder)
        return sorted(found - {""})

    def sizes(self, leaf: str) -> list[tuple[str, int]]:
        """Names and bytes of the data files of one folder."""
        found = [(s.getPath().getName(), s.getLen()) for s in self.fs.listStatus(self._path(leaf)) if s.isFile()]
        return sorted(x for x in found if not x[0].startswith(("_", ".")))

    def files(self, leaf: str) -> list[str]:
        return [name for name, _ in self.sizes(leaf)]

    def rename(self, old: str, new: str) -> None:
        """Move a folder to a free place; where the store refuses, again after twice the wait."""
        self.step(f"rename {old}")
        for k in range(self.attempts):
            try:
                self.fs.mkdirs(self._path(new).getParent())
                if self.fs.rename(self._path(old), self._path(new)):
                    return
            except Py4JJavaError:
                if k == self.attempts - 1:
                    raise
            time.sleep(self.wait_s * 2**k)
        raise OSError(f"{self.root}/{old} could not be moved to {new}")

    def delete(self, name: str) -> None:
        self.step(f"delete {name}")
        self.fs.delete(self._path(name), True)

    def write_text(self, name: str, text: str) -> None:
        """A whole file or none: written under another name, then renamed."""
        self.step(f"write {name}")
        out = self.fs.create(self._path(f"{name}.part"), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.rename(f"{name}.part", name)

    def read_text(self, name: str) -> str:
        source = self.fs.open(self._path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


def begin(store: Store) -> str:
    """A new draft folder of the tree; finishes what an interrupted publication has left."""
    recover(store)
    return f"{DRAFT}{uuid.uuid4().hex}"


def commit(store: Store, draft: str, drop: Sequence[str] = ()) -> list[str]:
    """Publish all leaves of a written draft, and take away the leaves ``drop``; returns the leaves put in place."""
    key = draft.removeprefix(DRAFT)
    if store.names(JOURNAL):
        raise Busy(f"{store.root} has an unfinished publication")
    put = store.leaves(draft)
    store.write_text(f"{JOURNAL}{key}.json", json.dumps({"put": put, "drop": sorted(set(drop) - set(put))}))
    _settle(store, key)
    return put


def _settle(store: Store, key: str) -> None:
    """Put a switched publication in place; every step may be repeated."""
    plan = json.loads(store.read_text(f"{JOURNAL}{key}.json"))
    for leaf in plan["put"]:
        new, old = f"{DRAFT}{key}/{leaf}", f"{ASIDE}{key}/{leaf}"
        if store.exists(new):  # else it is in its place already
            if store.exists(leaf):
                store.rename(leaf, old)
            store.rename(new, leaf)
    for leaf in plan["drop"]:
        if store.exists(leaf):
            store.rename(leaf, f"{ASIDE}{key}/{leaf}")
    for name in (f"{ASIDE}{key}", f"{DRAFT}{key}", f"{JOURNAL}{key}.json"):  # the journal last
        store.delete(name)


def recover(store: Store) -> list[str]:
    """Finish publications whose switch was made; returns their keys.  Drafts without a journal were never published and stay hidden."""
    done = []
    for name in store.names(JOURNAL):
        if name.endswith(".json"):
            done.append(name.removeprefix(JOURNAL).removesuffix(".json"))
            _settle(store, done[-1])
        else:
            store.delete(name)  # a journal that was never completed
    return done


def sweep(store: Store) -> list[str]:
    """Delete drafts that no journal names: only when no writer is at work."""
    recover(store)
    gone = store.names(DRAFT) + store.names(ASIDE)
    for name in gone:
        store.delete(name)
    return gone


def read_tree(spark: SparkSession, root: str, schema: StructType | str | None = None) -> DataFrame:
    """The rows of a tree as last published, also between a switch and its end.  Partition columns are read as their folders' names say, or under ``schema``."""
    store = Store(spark, root)
    put, drop, parts = [], set(), []
    for name in store.names(JOURNAL):
        if name.endswith(".json"):
            plan = json.loads(store.read_text(name))
            draft = f"{DRAFT}{name.removeprefix(JOURNAL).removesuffix('.json')}"
            waiting = [leaf for leaf in plan["put"] if store.exists(f"{draft}/{leaf}")]
            put += [(draft, waiting)] if waiting else []
            drop |= {*waiting, *plan["drop"]}
    settled = [leaf for leaf in store.leaves("") if leaf not in drop]

    def read(base: str, leaves: list[str]) -> DataFrame:
        how = spark.read if schema is None else spark.read.schema(schema)
        return how.option("basePath", base).parquet(*[f"{base}/{leaf}" for leaf in leaves])

    if not put and not drop:
        how = spark.read if schema is None else spark.read.schema(schema)
        return how.option("basePath", root).parquet(root)
    for base, leaves in [(store.root, settled), *((f"{store.root}/{d}", w) for d, w in put)]:
        if leaves:
            parts.append(read(base, leaves))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out
