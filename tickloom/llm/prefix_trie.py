"""Prefix trie of conversations by partition refinement.

A node is a distinct sequence of first turns (role, text); its name is its depth and the smallest conversation that
begins with it.  All conversations start in one class, the root.  Each round splits the active classes by their next
turn: one aggregate over (class, turn) names the new classes, and one join gives the conversations theirs.  A class of
one conversation retires: its tail is a unary chain, written from its own turns.  A class of at most ``LOCAL`` turns
retires too and is refined to its end in one task, many classes at a time, by the same splitting in numpy; so Spark goes
on only with large classes, whose number is at most the turns over ``LOCAL`` a round.  At last the subtree sums are
folded back, in the tasks for what was refined there and level by level in Spark above it.

A turn is known by 128 bits of the SHA-256 of role and text; texts are neither shuffled nor kept.  A conversation's
turns are numbered in slices of turn numbers, so that a very long conversation isn't sorted by one task, and a node at
which very many conversations end hashes their identifiers in pieces of ``PIECE`` identifiers.

Defined results: rows without conv_id are left out; a null turn comes first, equal turns of a conversation are ordered
by role and then by the digest of role and text; repeated rows are repeated turns; a null role or text is empty; a conversation without turns
after rebuilding is a member of the root only; an empty table has no node, not even the root; extra columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, broadcast_within, cut, discard

#: Turns of a class that one task refines to its end.
LOCAL = 200_000
#: Turn numbers of a slice, and identifiers of a piece of a node's ends.
SLICE, PIECE = 4096, 65_536
#: Rows of slices that are broadcast at most (some 50 bytes each).
BROADCAST_ROWS = 1_000_000
#: Each conversation begins with turns of the conversation at the multiple of ``STEP`` below it, fewer than ``HEADS``.
STEP, HEADS = 100, 6

NOTHING = hashlib.sha256(b"").hexdigest()
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string, top boolean"


def number_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, pos, key, chars), turns numbered from 1, and rows (conv_id, n)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    key = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32))
    turn = F.col("turn").cast("long")
    rows = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce(F.expr(f"cast(turn as long) div {SLICE}"), F.lit(-(1 << 62))).alias("slice"), role.alias("role"), key.alias("key"), F.length(text).alias("chars"))
    per = cut(rows.groupBy("conv_id", "slice").agg(F.count(F.lit(1)).alias("n")), "slices")
    earlier = Window.partitionBy("conv_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    later = per.withColumn("before", F.sum("n").over(earlier)).where("before is not null").drop("n")
    number = F.row_number().over(Window.partitionBy("conv_id", "slice").orderBy(F.col("turn").asc_nulls_first(), "role", "key"))
    placed = rows.withColumn("number", number).join(broadcast_within(later, later.count(), BROADCAST_ROWS), ["conv_id", "slice"], "left")
    turns = placed.select("conv_id", (F.col("number") + F.coalesce("before", F.lit(0))).alias("pos"), "key", "chars")
    return turns, per.groupBy("conv_id").agg(F.sum("n").alias("n"))


def graft_heads(turns: DataFrame, sizes: DataFrame, step: int = STEP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Each conversation c with its first h turns replaced by those of c - c % step, h being crc32(c) % heads: rows (conv_id, pos, key, chars, len) and rows (conv_id, len)."""
    c = F.col("conv_id")
    own = sizes.withColumn("base", c - c % step).withColumn("h", F.crc32(c.cast("string").cast("binary")) % heads)
    bases = sizes.where(c % step == 0).select(c.alias("base"), F.col("n").alias("base_n"))
    plan = own.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    plan = cut(plan.select("conv_id", "base", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")), "grafts")
    kept = turns.join(plan, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "key", "chars", "len")
    first = turns.where((c % step == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    given = plan.where("taken > 0").join(first, "base").where("pos <= taken").select("conv_id", "pos", "key", "chars", "len")
    return kept.union(given), plan.select("conv_id", "len")


def _digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest()


def refine(node: np.ndarray, parent: np.ndarray, depth: np.ndarray, conv: np.ndarray, key: np.ndarray, chars: np.ndarray) -> list[tuple]:
    """All nodes of whole classes, from turns sorted by (node, conv, position), each conversation's from the class's last turn on: columns of ``NODES``."""
    first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
    size = np.diff(np.append(first, len(conv)))
    name, at = conv[first], depth[first]
    top = np.concatenate(([True], node[first][1:] != node[first][:-1]))
    cls, live = np.cumsum(top) - 1, np.arange(len(first))
    levels, chains, over = [], [], parent[first][top]
    while len(live):
        step = len(levels)
        if step:
            rows = first[live] + step
            order = np.lexsort((key[rows, 1], key[rows, 0], cls))
            live, cls, rows = live[order], cls[order], rows[order]
            new = np.concatenate(([True], (cls[1:] != cls[:-1]) | (key[rows[1:]] != key[rows[:-1]]).any(axis=1)))
            over = cls[new]
            cls = np.cumsum(new) - 1
        else:
            new = top
        starts = np.flatnonzero(new)
        n = np.diff(np.append(starts, len(cls)))
        lead = live[starts]  # conversations are in order within a class, so its first has the smallest name
        ends: list[str | None] = [None] * len(starts)
        done = size[live] == step + 1
        gone, ids = cls[done], name[live[done]]
        edges = np.flatnonzero(np.concatenate(([True], gone[1:] != gone[:-1]))) if len(gone) else gone
        for a, b in zip(edges.tolist(), [*edges[1:].tolist(), len(gone)], strict=False):
            ends[int(gone[a])] = _digest(ids[a:b])
        alone = n == 1
        tail = alone & (size[lead] > step + 1)
        levels.append({"id": name[lead], "depth": at[lead] + step, "over": over, "n": n, "children": tail.astype(np.int64), "leaves": tail.astype(np.int64), "saved": (n - 1) * chars[first[lead] + step], "ends": ends})
        for k in lead[tail].tolist():
            chains.append((k, step + 1))
        go = ~done & ~alone[cls]
        live, cls = live[go], cls[go]
    for k in range(len(levels) - 1, -1, -1):
        x = levels[k]
        x["leaves"] = np.where(x["children"] == 0, 1, x["leaves"])
        if k:
            y = levels[k - 1]
            np.add.at(y["children"], x["over"], 1)
            np.add.at(y["leaves"], x["over"], x["leaves"])
            np.add.at(y["saved"], x["over"], x["saved"])
            x["parent"] = y["id"][x["over"]]
        else:
            x["parent"] = x["over"]
    out = [(x["id"], x["depth"], x["parent"], x["n"], x["children"], x["leaves"], x["saved"], x["ends"], np.full(len(x["id"]), k == 0)) for k, x in enumerate(levels)]
    for k, step in chains:
        m = int(size[k]) - step
        ids, ones = np.full(m, name[k]), np.ones(m, dtype=np.int64)
        children = ones.copy()
        children[-1] = 0
        out.append((ids, at[k] + np.arange(step, step + m), ids, ones, children, ones, ones * 0, [None] * (m - 1) + [_digest(ids[:1])], np.zeros(m, dtype=bool)))
    return out


def _refined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Classes of sorted rows (node, parent, depth, conv_id, key, chars), as many at a time as ``LOCAL`` turns hold."""
    kinds = [pa.int64()] * 7 + [pa.string(), pa.bool_()]
    names = [x.split()[0] for x in NODES.split(", ")]

    def made(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts)
        if t.num_rows:
            longs = [t.column(k).to_numpy().astype(np.int64) for k in (0, 1, 2, 3, 5)]
            key = np.frombuffer(b"".join(t.column(4).to_pylist()), dtype=np.uint64).reshape(-1, 2)
            done = refine(*longs[:4], key, longs[4])
            for k in range(0, len(done), 1000):
                some = done[k : k + 1000]
                columns = [sum((c[7] for c in some), []) if j == 7 else np.concatenate([c[j] for c in some]) for j in range(9)]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names=names)

    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        node = batch.column(0).to_numpy()
        edges = np.flatnonzero(node[1:] != node[:-1]) + 1
        if held and len(node) and held[-1].column(0)[-1].as_py() != node[0]:
            edges = np.concatenate(([0], edges))
        if len(edges) and rows + int(edges[-1]) >= LOCAL:
            yield from made([*held, batch.slice(0, int(edges[-1]))])
            held, rows, batch = [], 0, batch.slice(int(edges[-1]))
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
    if held:
        yield from made(held)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests (conv_id, depth, ends) of nodes from sorted pieces (conv_id, depth, piece, ids)."""
    at, digest = None, hashlib.sha256()

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([at[0]]), pa.array([at[1]]), pa.array([digest.hexdigest()])], names=["conv_id", "depth", "ends"])

    for batch in batches:
        for node, depth, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3)), strict=True):
            if (node, depth) == at:
                digest.update(b",")
            else:
                if at:
                    yield made()
                at, digest = (node, depth), hashlib.sha256()
            digest.update(ids.encode())
    if at:
        yield made()


def _large_ends(ended: DataFrame) -> DataFrame:
    """Digests of the identifiers (member) that end at a node (conv_id, depth): joined by pieces, then hashed in order."""
    pieces = ended.groupBy("conv_id", "depth", F.expr(f"member div {PIECE}").alias("piece")).agg(F.sort_array(F.collect_list("member")).alias("ids"))  # identifiers are distinct: a piece is bounded
    joined = pieces.withColumn("ids", F.array_join(F.transform("ids", lambda x: x.cast("string")), ","))
    return joined.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "piece").mapInArrow(_ends, "conv_id long, depth long, ends string")


def build_trie(turns: DataFrame, members: DataFrame, local: int = LOCAL) -> DataFrame:
    """Nodes of the trie over turns (conv_id, pos, key, chars, len) of conversations (conv_id, len), turnless ones included."""
    bound_batches(turns.sparkSession)
    turns, members = cut(turns, "turns"), cut(members, "members")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")).where("n > 0")
    large = [cut(root.select("conv_id", F.lit(None).cast("long").alias("parent"), "n", F.lit(0).alias("chars")), "root")]
    start = large[0].first()
    if start is None:
        return turns.sparkSession.createDataFrame([], NODES.replace("ends string, top boolean", "ends_sha256 string"))
    live = members.withColumn("node", F.lit(start["conv_id"]).cast("long"))
    handed, ended = [], []
    while True:
        depth = len(large)
        ended.append(live.where(F.col("len") == depth - 1).select(F.col("node").alias("conv_id"), F.lit(depth - 1).cast("long").alias("depth"), F.col("conv_id").alias("member")))
        step = turns.where(F.col("pos") == depth).join(live.select("conv_id", F.col("node").alias("parent")), "conv_id")
        groups = step.groupBy("parent", "key").agg(F.min("conv_id").alias("node"), F.count(F.lit(1)).alias("n"), F.first("chars").alias("chars"), F.sum(F.col("len") - depth + 1).alias("turns"))
        groups = cut(groups.withColumn("large", (F.col("n") > 1) & (F.col("turns") > local)), "classes")
        named = cut(step.select("conv_id", "len", "parent", "key").join(groups.drop("chars", "turns"), ["parent", "key"]).drop("key"), "named")
        handed.append(named.where("not large").select("conv_id", "node", "parent", "n", F.lit(depth).cast("long").alias("depth")))
        more = groups.where("large").select(F.col("node").alias("conv_id"), "parent", "n", "chars")
        if more.isEmpty():
            break
        large.append(more)
        live = named.where("large").select("conv_id", "len", "node")

    retired = handed[0]
    for x in handed[1:]:
        retired = retired.union(x)
    tails = turns.join(retired, "conv_id").where("pos >= depth")
    classes = tails.where("n > 1").select("node", "parent", "depth", "conv_id", "key", "chars", "pos")
    below = cut(classes.repartition("node").sortWithinPartitions("node", "conv_id", "pos").mapInArrow(_refined, NODES), "nodes")
    top, end = F.col("pos") == F.col("depth"), F.col("pos") == F.col("len")
    chain = tails.where("n = 1").select("conv_id", F.col("pos").cast("long").alias("depth"), F.when(top, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"), F.lit(1).cast("long").alias("n_convs"), (~end).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.when(end, F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)).alias("ends"), top.alias("top"))
    single = retired.where("n = 1").select("parent", "depth", F.lit(1).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"))

    # Fold back the large classes, the deepest first; they are few.
    children = single.union(below.where("top").select(F.col("parent_conv_id").alias("parent"), "depth", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    nodes, last = below.union(chain), None
    gone = ended[0]
    for x in ended[1:]:
        gone = gone.union(x)
    ends = _large_ends(gone)
    folded = []
    for k in range(len(large) - 1, -1, -1):
        under = children.where(F.col("depth") == k + 1).select("parent", "leaves", "saved")
        if last is not None:
            under = under.union(last.select(F.col("parent_conv_id").alias("parent"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
        sums = under.groupBy(F.col("parent").alias("conv_id")).agg(F.count(F.lit(1)).alias("kids"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        here = large[k].join(sums, "conv_id", "left")
        last = cut(here.select("conv_id", F.lit(k).cast("long").alias("depth"), F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), F.coalesce("kids", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"), (F.coalesce("saved", F.lit(0)) + (F.col("n") - 1) * F.col("chars")).alias("saved_tokens")), "folded")
        folded.append(last)
    whole = folded[0]
    for x in folded[1:]:
        whole = whole.union(x)
    nodes = nodes.drop("top").union(whole.join(ends, ["conv_id", "depth"], "left"))
    return nodes.select(*nodes.columns[:-1], F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))


def node_texts(nodes: DataFrame, conversations: DataFrame) -> DataFrame:
    """``nodes`` of plain conversations (not rebuilt) with the role and text of their last turn; the root has none."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), role, text)
    said = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.row_number().over(order).cast("long").alias("depth"), role.alias("role"), text.alias("text"))
    return nodes.join(said, ["conv_id", "depth"], "left")


def conversation_trie(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """Nodes of the trie of conversations as they are."""
    turns, sizes = number_turns(conversations)
    members = sizes.select("conv_id", F.col("n").alias("len"))
    return build_trie(turns.join(members, "conv_id"), members, local)


def query(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    turns, sizes = number_turns(conversations)
    turns = cut(turns, "numbered")
    found = build_trie(*graft_heads(turns, sizes), local)
    discard(turns)
    return found


SQL = r"""
WITH o AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                            sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base,
             xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                 lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda v, i: xor(v >> 1, 3988292384 * (v & 1))))) % 6 AS h
      FROM (SELECT DISTINCT conv_id FROM o)),
t AS (SELECT c.conv_id, 0 AS own, p, role, text FROM c JOIN o ON o.conv_id = c.base WHERE p <= h
      UNION ALL SELECT conv_id, 1, p, role, text FROM c JOIN o USING (conv_id) WHERE p > h),
r AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY own, p) AS d, length(text) AS chars,
             md5(length(role) || ':' || role || text) AS k FROM t),
x AS (SELECT conv_id, d, chars, md5(string_agg(k, '') OVER (PARTITION BY conv_id ORDER BY d)) AS pre FROM r
      UNION ALL SELECT conv_id, 0, 0, '' FROM c),
y AS (SELECT *, max(d) OVER (PARTITION BY conv_id) AS len FROM x),
n AS (SELECT d, pre, min(conv_id) AS node, count(*) AS n, any_value(chars) AS chars,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE d = len), '')) AS ends
      FROM y GROUP BY d, pre),
m AS (SELECT conv_id, d, node FROM y JOIN n USING (d, pre)),
e AS (SELECT DISTINCT b.d, b.node, a.node AS parent FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d = a.d + 1),
k AS (SELECT d - 1 AS d, parent AS node, count(*) AS kids FROM e GROUP BY ALL),
s AS (SELECT DISTINCT a.d, a.node, b.d AS d2, b.node AS node2 FROM m a JOIN m b ON a.conv_id = b.conv_id AND b.d >= a.d),
f AS (SELECT s.d, s.node, sum(CASE WHEN k.kids IS NULL THEN 1 ELSE 0 END) AS leaves, sum((n.n - 1) * n.chars) AS saved
      FROM s JOIN n ON n.d = s.d2 AND n.node = s.node2 LEFT JOIN k ON k.d = s.d2 AND k.node = s.node2 GROUP BY ALL)
SELECT n.node AS conv_id, n.d::BIGINT AS depth, e.parent AS parent_conv_id, n.n AS n_convs, coalesce(k.kids, 0)::BIGINT AS n_children,
       f.leaves::BIGINT AS n_leaves, f.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM n JOIN f ON f.d = n.d AND f.node = n.node LEFT JOIN k ON k.d = n.d AND k.node = n.node LEFT JOIN e ON e.d = n.d AND e.node = n.node
"""
