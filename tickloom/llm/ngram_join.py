"""N-gram Jaccard join by filters under several global token orders.

A document is the set of its distinct five-word shingles (64-bit hashes).  Two sets of Jaccard similarity t share, under
any total order of all tokens, a token of their prefixes (the first n - ceil(t n) + 1 of n).  Three orders are used; all
put tokens that are frequent over all documents last (frequency by hashed slot, a table of fixed size) and differ in the
order within a frequency level.  Equal sets are one class from the start.

1. First order: prefix tokens are counted, and each token that several classes hold names its least class as leader.
   What is kept of that is only (leader, class): two classes that share a prefix token are in a group of one leader.
2. A candidate is a pair of one group whose sizes and parity bitmaps (which grow with the set; their Hamming distance is
   at most the symmetric difference) allow the similarity, and whose prefixes under the second and under the third order
   meet too.  All these filters are intersected before any set is moved; the sets of what is left are intersected.
3. Since the result is what links reach, groups aren't expanded into pairs.  First each class meets its leader, and links
   become components.  Then, in blocks of bounded size, classes outside the leader's component are held against all
   others by bitmap; of each two components only the nearest pair is verified, for a few rounds, and at last all pairs
   of different components that pass the filters.  No pair that could join two components is left out; there is no cap.

Defined results: a null or empty text, or one without words, has the empty set and links with nothing; with fewer than
five words the whole sequence is the one shingle; each row is a document; a null identifier gets the component of the
others or null; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, broadcast_within, cut, discard, join_null_safe, release
from tickloom.llm.components import connected_components
from tickloom.llm.hashing import mix, shingle_sets

WORDS = 5
PERCENT = 80
#: Slots of the frequency table (one byte each when sent to the tasks) and of the parts it is summed in.
SLOT_BITS, PART_BITS = 20, 14
SLOTS = 1 << SLOT_BITS
#: Rounds in which two components of a group meet by their nearest pair only.
ROUNDS = 3
#: Classes of a block; two blocks are compared in one task.
BLOCK = 1024
#: Rows of (doc_id, mark, class), or of pairs, that are broadcast at most (some 100 bytes each); beyond it joins are shuffled.
BROADCAST_ROWS = 1_000_000


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - -(-percent * n // 100) + 1


def _slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def prefix(s: np.ndarray, level: np.ndarray, order: int, percent: int = PERCENT) -> np.ndarray:
    """The prefix of a set under one of the global orders: by frequency level, then by a hash that differs in each order."""
    p = prefix_length(len(s), percent)
    key = level[_slot(s)].astype(np.uint64) << np.uint64(56) | mix(s, order) >> np.uint64(8)
    return s[np.argpartition(key, p - 1)[:p]] if p < len(s) else s


def _class(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def _map(s: np.ndarray) -> bytes:
    """A parity bitmap whose bits grow with the set (a power of two from 2 n up); halves folded by XOR give the shorter ones."""
    bits = 1 << max(8, int(2 * len(s) - 1).bit_length())
    odd = (np.bincount((s & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def _sets(words: int):
    """Rows of the texts (``part`` holds their mark) and of the task's frequency table, in pieces."""
    longs = ["doc_id", "cls", "n", "piece", "part"]
    schema = pa.schema([*[(x, pa.int64()) for x in longs], ("map", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        counts = np.zeros(SLOTS, dtype=np.uint32)
        for batch in batches:
            classes, sizes, maps, slots = [], [], [], []
            for s in shingle_sets(_texts(batch.column(1)), words):
                slots.append(_slot(s))
                classes.append(_class(s) if len(s) else None)
                sizes.append(len(s))
                maps.append(_map(s) if len(s) else None)
                if len(slots) == 256:
                    np.add.at(counts, np.concatenate(slots), np.uint32(1))
                    slots = []
            if slots:
                np.add.at(counts, np.concatenate(slots), np.uint32(1))
            none = pa.nulls(len(sizes), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(classes, pa.int64()), pa.array(sizes, pa.int64()), none, batch.column(2), pa.array(maps, pa.binary()), pa.nulls(len(sizes), pa.binary())], schema=schema)
        if counts.any():
            from pyspark import TaskContext

            pieces = [k for k in range(SLOTS >> PART_BITS) if counts[k << PART_BITS : (k + 1) << PART_BITS].any()]
            none, part = pa.nulls(len(pieces), pa.int64()), TaskContext.get().partitionId() % 64
            blobs = [zlib.compress(counts[k << PART_BITS : (k + 1) << PART_BITS].astype(np.uint64).tobytes(), 1) for k in pieces]
            yield pa.RecordBatch.from_arrays([none, none, none, pa.array(pieces, pa.int64()), pa.array([part] * len(pieces), pa.int64()), pa.nulls(len(pieces), pa.binary()), pa.array(blobs, pa.binary())], schema=schema)

    return run


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(zlib.decompress(x), np.uint64) for x in pdf["counts"])
    return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "part": [pdf["part"].iloc[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def _levels(counted: DataFrame) -> np.ndarray:
    """Frequency level of each slot over all documents, in half powers of two of the mean; parts are summed in Spark in two steps."""
    shape = "piece long, part long, counts binary"
    some = counted.groupBy("piece", "part").applyInPandas(_summed, shape).withColumn("part", F.lit(0).cast("long"))
    counts = np.zeros(SLOTS, dtype=np.float64)
    for r in some.groupBy("piece", "part").applyInPandas(_summed, shape).collect():  # the table: 8 MB at most
        counts[r["piece"] << PART_BITS : (r["piece"] + 1) << PART_BITS] = np.frombuffer(zlib.decompress(r["counts"]), np.uint64)
    usual = max(1.0, counts.mean())
    return np.clip(2 * np.log2(np.maximum(counts / usual, 1.0)), 0, 255).astype(np.uint8)


def _postings(words: int, percent: int, level: np.ndarray):
    """Rows (tok, cls) of the first order's prefixes."""
    schema = pa.schema([("tok", pa.int64()), ("cls", pa.int64())])

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            toks, classes = [], []
            for s in shingle_sets(_texts(batch.column(0)), words):
                if len(s) and (c := _class(s)) not in done:
                    done.add(c)
                    toks.append(prefix(s, level, 1, percent))
                    classes.append(c)
            if toks:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(toks).view(np.int64)), pa.array(np.repeat(np.array(classes, dtype=np.int64), [len(t) for t in toks]))], schema=schema)

    return run


SIDE = "cls long, n long, second array<int>, third array<int>, toks array<long>"


def _sides(words: int, percent: int, level: np.ndarray):
    """For asked rows (text, class): size, prefixes under the other orders (halves of their hashes), and the set."""
    ints, longs = pa.list_(pa.int32()), pa.list_(pa.int64())
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("second", ints), ("third", ints), ("toks", longs)])

    def half(s: np.ndarray) -> np.ndarray:
        return (mix(s, 9) >> np.uint64(32)).astype(np.uint32).view(np.int32)

    def run(batches):
        done: set[int] = set()
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                rows = []
                for s, cls in zip(shingle_sets(_texts(part.column(0)), words), part.column(1).to_pylist(), strict=True):
                    if len(s) and cls not in done and _class(s) == cls:
                        done.add(cls)
                        rows.append((cls, len(s), half(prefix(s, level, 2, percent)), half(prefix(s, level, 3, percent)), s.view(np.int64)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def _folded(words: np.ndarray, length: int) -> np.ndarray:
    while len(words) > length:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def _leader_rows(percent: int):
    """Of rows (cls, lead, sizes and bitmaps of both), the pairs whose sizes and bitmaps allow the similarity."""
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        for batch in batches:
            x, y = [], []
            for cls, lead, n, m, a, b in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
                if min(n, m) * 100 >= max(n, m) * percent:
                    a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                    size = min(len(a), len(b))
                    if int(np.bitwise_count(_folded(a, size) ^ _folded(b, size)).sum()) * (100 + percent) <= (n + m) * (100 - percent):
                        x.append(cls)
                        y.append(lead)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], schema=schema)

    return run


def close_pairs(rows: list[dict], crossed: bool, percent: int, nearest: bool) -> list[tuple[int, int]]:
    """Pairs of classes of different components whose sizes and bitmaps allow the similarity; ``crossed`` pairs only across blocks.

    With ``nearest``, of each two components the pair whose bitmaps differ least.
    """
    n, comp, block = (np.array([r[k] for r in rows], dtype=np.int64) for k in ("n", "comp", "block"))
    maps = [np.frombuffer(r["map"], np.uint64) for r in rows]
    by_length: dict[int, list[int]] = {}
    for k, m in enumerate(maps):
        by_length.setdefault(len(m), []).append(k)
    best: dict[tuple[int, int], tuple[float, int, int]] = {}
    out: list[tuple[int, int]] = []
    for length, own in by_length.items():
        longer = by_length.get(2 * length, [])  # sizes are within 100 : percent, so bitmaps are of one length or of two neighbouring ones
        ids = np.array([*own, *longer])
        pool = np.stack([_folded(maps[k], length) for k in ids.tolist()])
        for t, a in enumerate(own):
            others = ids[t + 1 :]
            both = np.minimum(n[others], n[a]) * 100 >= np.maximum(n[others], n[a]) * percent
            both &= comp[others] != comp[a]
            if crossed:
                both &= block[others] != block[a]
            at = np.flatnonzero(both)
            if not len(at):
                continue
            apart = np.bitwise_count(pool[t + 1 :][at] ^ pool[t]).sum(axis=1, dtype=np.int64)
            total = n[others[at]] + n[a]
            for k in np.flatnonzero(apart * (100 + percent) <= total * (100 - percent)).tolist():
                b = int(others[at[k]])
                if nearest:
                    two = (min(comp[a], comp[b]), max(comp[a], comp[b]))
                    far = apart[k] / total[k]
                    if two not in best or far < best[two][0]:
                        best[two] = (far, a, b)
                else:
                    out.append((a, b))
    return [(rows[a]["cls"], rows[b]["cls"]) for a, b in [*out, *((a, b) for _, a, b in best.values())]]


def _block_rows(percent: int, nearest: bool):
    schema = pa.schema([("lead", pa.int64()), ("x", pa.int64()), ("y", pa.int64())])

    def run(batches):
        for batch in batches:
            lead, x, y = [], [], []
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                pairs = close_pairs(row.column(1).to_pylist()[0], row.column(0).to_pylist()[0], percent, nearest)
                lead += [row.column(2)[0].as_py()] * len(pairs)
                x += [min(p) for p in pairs]
                y += [max(p) for p in pairs]
            if lead:
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (lead, x, y)], schema=schema)

    return run


def _across(groups: DataFrame, known: DataFrame, small: DataFrame, percent: int, nearest: bool, block: int) -> DataFrame:
    """Close pairs (lead, x, y) of different components within a group, without its leader; inside the leader's component nothing is compared."""
    label = known.withColumnRenamed("node", "cls")
    of = groups.join(label, "cls", "left").withColumn("comp", F.coalesce("label", "cls")).drop("label")
    main = known.select(F.col("node").alias("lead"), F.col("label").alias("main"))
    of = of.join(main, "lead", "left").withColumn("out", (F.col("comp") != F.coalesce("main", "lead")).cast("int")).drop("main")
    blocks = lambda c: F.ceil(c / F.lit(block)).cast("int")
    sizes = of.groupBy("lead").agg(blocks(F.sum("out")).alias("outer"), blocks(F.sum(1 - F.col("out"))).alias("inner"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").drop("lo", "hi")
    b = F.pmod(F.xxhash64("cls"), F.when(F.col("out") == 1, F.col("outer")).otherwise(F.col("inner"))).cast("int")
    placed = of.join(sizes, "lead").withColumn("block", F.when(F.col("out") == 1, b).otherwise(F.col("outer") + b))
    met = F.when(F.col("out") == 1, F.sequence(F.lit(0), F.col("outer") + F.col("inner") - 1)).otherwise(F.sequence(F.lit(0), F.col("outer") - 1))
    keys = F.transform(met, lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    dealt = placed.withColumn("key", F.explode(keys)).join(small, "cls")
    held = dealt.groupBy("lead", "key").agg(F.collect_list(F.struct("cls", "comp", "n", "map", "block")).alias("rows"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")  # two blocks at most
    return held.select((F.col("key.i") != F.col("key.j")).alias("crossed"), "rows", "lead").mapInArrow(_block_rows(percent, nearest), "lead long, x long, y long")


def _verify(pairs: DataFrame, read: DataFrame, reps: DataFrame, sides, percent: int) -> DataFrame:
    """Of candidate pairs (x, y), those that share prefix tokens under the second and the third order and then are similar.

    Prefixes and sets are made from the texts of the classes concerned; sets move only for pairs that pass the prefixes.
    """
    few = pairs.count()
    need = pairs.select(F.col("x").alias("cls")).union(pairs.select("y")).distinct().join(reps.select("cls", "at.doc_id", "at.mark"), "cls")
    texts = join_null_safe(read, need, ["doc_id", "mark"], 2 * few <= BROADCAST_ROWS).select("text", "cls")
    side = cut(texts.mapInArrow(sides, SIDE), "sides")

    def both(of: DataFrame, n: int, *cols: str) -> DataFrame:
        for key in ("x", "y"):
            of = side.select(F.col("cls").alias(key), *[F.col(c).alias(f"{c}_{key}") for c in cols]).join(broadcast_within(of, n, BROADCAST_ROWS) if key == "x" else of, key)
        return of

    near = both(pairs, few, "second", "third").where(F.arrays_overlap("second_x", "second_y") & F.arrays_overlap("third_x", "third_y"))
    near = cut(near.select("x", "y"), "near")
    whole = both(near, few, "n", "toks")
    same = F.size(F.array_intersect("toks_x", "toks_y")) * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent
    found = cut(whole.where(same).select("x", "y").distinct(), "links")
    discard(near, side)
    return found


def similarity_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, n_shingles, cls, component_id): one for each row of ``docs``."""
    bound_batches(docs.sparkSession)
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).withColumn("mark", F.xxhash64("text"))
    both = cut(read.mapInArrow(_sets(words), "doc_id long, cls long, n long, piece long, part long, map binary, counts binary"), "sets")
    sets = both.where("piece is null")
    level = _levels(both.where("piece is not null").select("piece", "part", "counts"))
    reps = cut(sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", F.col("part").alias("mark"))).alias("at"), F.first("n").alias("n"), F.first("map").alias("map")), "classes")
    small = reps.select("cls", "n", "map")

    # First order: the groups of classes that share a prefix token.
    postings = cut(read.select("text").mapInArrow(_postings(words, percent, level), "tok long, cls long"), "postings")
    shared = postings.groupBy("tok").agg(F.min("cls").alias("lead"), F.max("cls").alias("hi")).where("lead < hi").select("tok", "lead")
    shared = cut(shared, "shared")
    release(docs.sparkSession)  # the counted postings' shuffle goes before they are shuffled again
    groups = cut(postings.join(shared, "tok").select("lead", "cls").distinct(), "groups")
    discard(postings, shared)
    release(docs.sparkSession)

    # Each class with its leaders; then what could still join two components.
    sides = _sides(words, percent, level)
    led = groups.where("cls != lead").join(small, "cls").join(small.toDF("lead", "m", "lead_map"), "lead")
    tested = cut(led.select("cls", "lead", "n", "m", "map", "lead_map").mapInArrow(_leader_rows(percent), "x long, y long").distinct(), "pairs")
    links = _verify(tested, read, reps, sides, percent)
    known = connected_components(links, "x", "y")
    nearest, held = rounds, groups.where("cls != lead")  # leaders have met all
    while True:
        close = cut(_across(held, known, small, percent, nearest > 0, block), "close")
        if close.isEmpty():
            break  # components only grow, so no later round has a pair either
        fresh = cut(close.select("x", "y").distinct().join(_either_way(tested), ["x", "y"], "left_anti"), "pairs")
        if fresh.isEmpty():
            if not nearest:
                break
            nearest = 0  # what is nearest is tested: on to all pairs
            continue
        if nearest:  # groups without a close pair have none later
            held = cut(held.join(close.select("lead").distinct(), "lead", "left_semi"), "held")
        found = _verify(fresh, read, reps, sides, percent)
        tested, none = tested.union(fresh), found.isEmpty()
        if not none:
            known = _joined(known, found)
        release(docs.sparkSession)
        if not nearest:
            break
        nearest = 0 if none else nearest - 1

    least = cut(reps.select("cls", "rep").join(known.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls")), "labels")
    comp = least.groupBy("label").agg(F.min("rep").alias("component_id"))
    named = least.join(comp, "label").select("cls", "component_id")
    discard(groups)
    return sets.select("doc_id", "n", "cls").join(named, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), "cls", F.coalesce("component_id", "doc_id").alias("component_id"))


def _joined(known: DataFrame, found: DataFrame) -> DataFrame:
    """``known`` labels after the links ``found``, of which only the components that they tie are worked out anew."""
    label = lambda c: known.select(F.col("node").alias(c), F.col("label").alias(f"{c}_label"))
    tied = found.join(label("x"), "x", "left").join(label("y"), "y", "left").select(F.coalesce("x_label", "x").alias("x"), F.coalesce("y_label", "y").alias("y"))
    more = connected_components(tied, "x", "y").select(F.col("node").alias("label"), F.col("label").alias("least"))
    ends = _either_way(found).select(F.col("x").alias("node"), F.col("x").alias("label")).join(known, "node", "left_anti").distinct()  # had no link before
    return cut(known.union(ends).join(more, "label", "left").select("node", F.coalesce("least", "label").alias("label")), "components")


def _either_way(pairs: DataFrame) -> DataFrame:
    return pairs.union(pairs.select("y", "x"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose component has a smaller identifier.

    Rows with a null identifier stay; rows that share an identifier go together.
    """
    found = similarity_components(docs, id_col, text_col)
    gone = cut(found.where(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias(id_col)).distinct(), "near-copies")
    return docs.join(gone, id_col, "left_anti").select(*docs.columns)


def query(docs: DataFrame) -> DataFrame:
    return similarity_components(docs).select("doc_id", "n_shingles", "component_id")


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
             WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
      FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, n, md5(string_agg(g, chr(10) ORDER BY g)) AS c FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
r AS (SELECT c, min(doc_id) AS doc_id FROM k GROUP BY c),
f AS (SELECT g FROM s SEMI JOIN r ON s.doc_id = r.doc_id GROUP BY g HAVING count(*) > 1),
q AS (SELECT s.doc_id, s.g FROM s SEMI JOIN r ON s.doc_id = r.doc_id SEMI JOIN f ON s.g = f.g),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM q a JOIN q b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM i JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 180 * o >= 80 * (a.n + b.n)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
t(node, reach) AS (SELECT doc_id, doc_id FROM r UNION SELECT e.y, t.reach FROM t JOIN e ON t.node = e.x WHERE t.reach < e.y),
m AS (SELECT node, min(reach) AS m FROM t GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.m, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
LEFT JOIN r ON r.c = k.c LEFT JOIN m ON m.node = r.doc_id
"""
