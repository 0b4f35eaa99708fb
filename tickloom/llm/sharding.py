"""Resharding by minimum-cost flow.

Rows lie in old shards; each old shard is dealt into blocks by a hash of the identifier, and Spark gives each block's
rows and bytes.  From these sizes and the row capacities of the new shards (at most one apart) a minimum-cost flow with
successive shortest paths settles how many rows of each block go to which new shard: a row that stays costs nothing, a
moved one the mean bytes of its block, so the fewest bytes move.  Within a block the shortest rows leave first.  The
plan has a bounded size (``BLOCKS`` blocks at any input), so it is solved on the driver; the rows are placed by one
window over block and size, and each row's slot follows from the plan's offsets without a global sort.

Defined results: a null text has size 1; a row is dealt by identifier and size, so that null identifiers spread too; rows that share an identifier are
placed on their own (equal rows are interchangeable); equal texts form groups that this law doesn't keep together; an
empty table gives no row; extra columns pass through.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm.common import P, cut, discard
from tickloom.sources import publish

OLD_SHARDS, NEW_SHARDS = 12, 16
#: Blocks over all old shards at most; bounds the plan.
BLOCKS = 768


def capacities(rows: int, shards: int) -> list[int]:
    """Row counts of new shards, at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def min_cost_flow(nodes: int, arcs: list[tuple[int, int, int, float]], source: int, sink: int) -> list[int]:
    """Flow on each arc (from, to, capacity, cost >= 0) of a maximum flow of least cost: successive shortest paths with potentials."""
    graph: list[list[int]] = [[] for _ in range(nodes)]
    to, left, cost = [], [], []
    for a, b, capacity, c in arcs:
        for u, v, cap, price in ((a, b, capacity, c), (b, a, 0, -c)):
            graph[u].append(len(to))
            to.append(v)
            left.append(cap)
            cost.append(price)
    height = [0.0] * nodes
    while True:
        dist, via = [float("inf")] * nodes, [-1] * nodes
        dist[source] = 0.0
        heap = [(0.0, source)]
        while heap:
            d, u = heapq.heappop(heap)
            if d > dist[u]:
                continue
            for e in graph[u]:
                if left[e] and (nd := d + max(0.0, cost[e] + height[u] - height[to[e]])) < dist[to[e]] - 1e-12:
                    dist[to[e]], via[to[e]] = nd, e
                    heapq.heappush(heap, (nd, to[e]))
        if dist[sink] == float("inf"):
            return [left[2 * k + 1] for k in range(len(arcs))]
        height = [h + d if d < float("inf") else h for h, d in zip(height, dist, strict=True)]
        push, v = None, sink
        while v != source:
            push = left[via[v]] if push is None else min(push, left[via[v]])
            v = to[via[v] ^ 1]
        v = sink
        while v != source:
            left[via[v]] -= push
            left[via[v] ^ 1] += push
            v = to[via[v] ^ 1]


def plan_transfers(blocks: list[tuple[int, int, int, int]], caps: list[int]) -> list[tuple[int, int, int, int]]:
    """From blocks (old shard, block, rows, bytes) and capacities: (old shard, block, new shard, rows), those that stay included.

    Rows that have to move pass one hub, since a move costs the same to any shard: arcs grow with blocks, not with blocks times shards.
    """
    n, m = len(blocks), len(caps)
    source, hub, sink = n + m, n + m + 1, n + m + 2
    arcs: list[tuple[int, int, int, float]] = []
    for k, (old, _, rows, size) in enumerate(blocks):
        arcs.append((source, k, rows, 0.0))
        if old < m:
            arcs.append((k, n + old, rows, 0.0))
        arcs.append((k, hub, rows, size / max(rows, 1)))
    arcs += [(hub, n + j, cap, 0.0) for j, cap in enumerate(caps)]
    arcs += [(n + j, sink, cap, 0.0) for j, cap in enumerate(caps)]
    flow = min_cost_flow(n + m + 3, arcs, source, sink)
    stay, leave, enter = [0] * n, [0] * n, [0] * m
    for (a, b, _, _), f in zip(arcs, flow, strict=True):
        if a < n and b == hub:
            leave[a] = f
        elif a < n:
            stay[a] = f
        elif a == hub:
            enter[b - n] = f
    out, j = [], 0
    for k, (old, block, _, _) in enumerate(blocks):
        while leave[k]:
            while not enter[j]:
                j += 1
            moved = min(leave[k], enter[j])
            out.append((old, block, j, moved))
            leave[k] -= moved
            enter[j] -= moved
        if stay[k]:
            out.append((old, block, old, stay[k]))
    return out


def size_of(text_col: str) -> Column:
    return F.coalesce(F.octet_length(F.col(text_col)), F.lit(0)).cast("long") + 1


def old_layout(id_col: str, old_shards: int) -> Column:
    """The old shard where the table doesn't say: a hash of the identifier."""
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(old_shards)).cast("int")


def reshard(docs: DataFrame, shard: Column, size: Column, new_shards: int = NEW_SHARDS, id_col: str = "doc_id", blocks: int = BLOCKS, old_shards: int = OLD_SHARDS) -> DataFrame:
    """``docs`` (old shard and size as given) with ``__tl_size``, ``__tl_old``, ``__tl_block``, ``__tl_shard`` and ``__tl_slot`` (gapless from 0 in each new shard)."""
    spark = docs.sparkSession
    each = max(1, blocks // old_shards)
    placed = docs.withColumn(f"{P}size", size).withColumn(f"{P}old", shard)
    placed = placed.withColumn(f"{P}block", F.pmod(F.hash(F.col(id_col), F.col(f"{P}size"), F.lit(1)), F.lit(each)).cast("int"))
    sizes = sorted(tuple(r) for r in placed.groupBy(f"{P}old", f"{P}block").agg(F.count(F.lit(1)), F.sum(f"{P}size")).collect())  # ``blocks`` rows at most
    moves = plan_transfers(sizes, capacities(sum(s[2] for s in sizes), new_shards))
    segments, offset, rank, last = [], [0] * new_shards, 0, None
    for old, block, new, rows in moves:
        rank = rank if (old, block) == last else 0
        last = (old, block)
        segments.append((old, block, rank, rank + rows, new, offset[new] - rank))
        rank += rows
        offset[new] += rows
    by_block: dict[tuple[int, int], list] = {}
    for old, block, lo, hi, new, shift in segments:
        by_block.setdefault((old, block), []).append((lo, hi, new, shift))
    plan = spark.createDataFrame([(o, b, s) for (o, b), s in by_block.items()], f"{P}old int, {P}block int, {P}parts array<struct<lo:long,hi:long,new:int,shift:long>>")
    inside = Window.partitionBy(f"{P}old", f"{P}block").orderBy(f"{P}size", F.col(id_col))
    ranked = placed.withColumn(f"{P}rank", F.row_number().over(inside) - F.lit(1)).join(F.broadcast(plan), [f"{P}old", f"{P}block"])
    part = F.element_at(F.filter(f"{P}parts", lambda s: (s["lo"] <= F.col(f"{P}rank")) & (F.col(f"{P}rank") < s["hi"])), 1)
    at = ranked.withColumn(f"{P}at", part)
    return at.select(*docs.columns, f"{P}size", f"{P}old", f"{P}block", F.col(f"{P}at.new").alias(f"{P}shard"), (F.col(f"{P}rank") + F.col(f"{P}at.shift")).alias(f"{P}slot"))


def rewrite(spark: SparkSession, root: str, new_shards: int, id_col: str = "doc_id", text_col: str = "text", blocks: int = BLOCKS, step: Callable[[str], None] = lambda _: None) -> dict:
    """Reshard a folder of ``shard=K`` Parquet folders in place; only shards that lose or gain rows are written anew.

    The new files of all affected shards are written beside the old ones and published by one switch, so a job that is
    interrupted at any point leaves the old rows or the new ones, and can run again (``publish.read_tree`` reads the
    right ones even in between).  Returns the affected shards and the rows moved.
    """
    store = publish.Store(spark, root, step)
    draft = publish.begin(store)
    table = publish.read_tree(spark, root)
    last = table.agg(F.max("shard")).first()[0]
    if last is None:  # no rows: nothing to move
        return {"affected": [], "moved": 0}
    old_shards = int(last) + 1
    columns = [c for c in table.columns if c != "shard"]
    done = reshard(table, F.col("shard").cast("int"), size_of(text_col), new_shards, id_col, blocks, old_shards)
    done = cut(done.select(*[F.col(f"`{c}`") for c in columns], f"{P}old", f"{P}shard", f"{P}slot"), "reshard")
    pairs = done.groupBy(f"{P}old", f"{P}shard").count().collect()  # shards squared at most
    moved = [r for r in pairs if r[0] != r[1]]
    affected = sorted({r[0] for r in moved} | {r[1] for r in moved})
    if affected:
        new = done.where(F.col(f"{P}shard").isin(affected)).select(*[F.col(f"`{c}`") for c in columns], F.col(f"{P}shard").alias("shard"))
        new.repartition(max(1, len(affected)), "shard").write.partitionBy("shard").parquet(f"{store.root}/{draft}")
        kept = {r[1] for r in pairs}
        publish.commit(store, draft, [f"shard={k}" for k in set(affected) - kept])
    discard(done)
    return {"affected": affected, "moved": sum(r[2] for r in moved)}


def query(docs: DataFrame) -> DataFrame:
    d = docs.select("doc_id", size_of("text").alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    spread = reshard(d, old_layout("doc_id", OLD_SHARDS), F.col("size"))
    return spread.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col(f"{P}shard").alias("shard"), F.col(f"{P}slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
