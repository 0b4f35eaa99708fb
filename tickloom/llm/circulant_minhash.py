"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is the set of its distinct two-word shingles, each a position of a universe of 2^32.  One permutation scatters
the positions; a second one, shifted circularly by 0, 1, 2, ... makes all coordinates of the signature: coordinate k is
the least of pi(sigma(x) - k) over the set.  Both permutations are fixed bijections of 32-bit integers, so no table of
them is kept.  ``BANDS`` bands of ``ROWS`` coordinates each are hashed; two sets of similarity J miss all bands with
probability (1 - J^ROWS)^BANDS, 2.4e-9 at 0.8 and less above.

1. Equal sets are one class from the start.  Classes that share a band are a group, named by its least class (leader).
2. Each class meets the least of its leaders, links become components, then it meets those other leaders that are in
   another component.  Pairs whose sizes or parity bitmaps rule the similarity out aren't compared; all others are, on the full sets.
3. What a group still holds in different components is compared in blocks of bounded size, nearest pairs first and at
   last all; there is no cap on a group or on partners.

Defined results: a null or empty text, or one without words, has the empty set and links with nothing; one word is the
one shingle; each row is a document; a null identifier gets the component of the others or null, and is kept only then;
rows that share an identifier are kept or dropped together; extra columns aren't read; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, broadcast_within, cut, discard, join_null_safe, release
from tickloom.llm.components import connected_components
from tickloom.llm.hashing import mix, shingle_sets
from tickloom.llm.ngram_join import BLOCK, BROADCAST_ROWS, _across, _class, _either_way, _leader_rows, _map

WORDS, PERCENT = 2, 80
BANDS, ROWS = 50, 5
#: Shingles whose coordinates are made at once.
CHUNK = 512
#: Rounds in which two components of a group meet by their nearest pair only.
ROUNDS = 3


def permute(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A bijection of 32-bit integers, in place: odd multipliers and shifted exclusive ors."""
    t = np.right_shift(x, np.uint32(16))
    x ^= t
    x *= np.uint32(a)
    x ^= np.right_shift(x, np.uint32(15), out=t)
    x *= np.uint32(b)
    x ^= np.right_shift(x, np.uint32(16), out=t)
    return x


def sigma(x: np.ndarray) -> np.ndarray:
    return permute(x, 0x9E3779B1, 0x85EBCA77)


def pi(x: np.ndarray) -> np.ndarray:
    return permute(x, 0x7FEB352D, 0x846CA68B)


def signature(s: np.ndarray, size: int) -> np.ndarray:
    """All coordinates of a set of 64-bit hashes: one permutation, then the other shifted by the coordinate's number."""
    at = sigma((mix(s, 31) >> np.uint64(32)).astype(np.uint32))
    shifts = np.arange(size, dtype=np.uint32)[:, None]
    least = np.full(size, 0xFFFFFFFF, dtype=np.uint32)
    for k in range(0, len(at), CHUNK):
        np.minimum(least, pi(at[None, k : k + CHUNK] - shifts).min(axis=1), out=least)
    return least


def bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """A 64-bit key for each band of a signature."""
    parts = sig.reshape(-1, rows).astype(np.uint64)
    key = np.arange(len(parts), dtype=np.uint64)
    for k in range(rows):
        key = mix(key ^ parts[:, k] << np.uint64(20), 40 + k)
    return key.view(np.int64)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


SETS = "doc_id long, mark long, cls long, n long, map binary, bands array<long>"


def _sketch(words: int, count: int, rows: int) -> Callable:
    """Rows (doc_id, mark, class, size, bitmap, bands) of documents; a task makes the bands of neighbouring equal sets once."""
    schema = pa.schema([*[(x, pa.int64()) for x in ("doc_id", "mark", "cls", "n")], ("map", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None, None)
        for batch in batches:
            out: list[tuple] = []
            for s in shingle_sets(_texts(batch.column(1)), words):
                if not len(s):
                    out.append((None, 0, None, None))
                    continue
                cls = _class(s)
                if cls != last[0]:
                    last = (cls, _map(s), bands(signature(s, count * rows), rows))
                out.append((cls, len(s), *last[1:]))
            columns = [pa.array([x[k] for x in out], schema.field(k + 2).type) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], schema=schema)

    return run


def _asked(words: int) -> Callable:
    """Sets of asked rows (text, class), each class once a task."""
    schema = pa.schema([("cls", pa.int64()), ("n", pa.int64()), ("toks", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                rows = [(cls, len(s), s.view(np.int64)) for s, cls in zip(shingle_sets(_texts(part.column(0)), words), part.column(1).to_pylist(), strict=True) if len(s) and _class(s) == cls]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    return run


def verify(pairs: DataFrame, read: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame:
    """Of pairs of classes (x, y), those whose full sets are similar; the sets are made again from one text of each class concerned."""
    few = pairs.count()
    need = pairs.select(F.col("x").alias("cls")).union(pairs.select("y")).distinct().join(classes.select("cls", "at.doc_id", "at.mark"), "cls")
    texts = join_null_safe(read, need, ["doc_id", "mark"], 2 * few <= BROADCAST_ROWS).select("text", "cls")
    sets = cut(texts.mapInArrow(_asked(words), "cls long, n long, toks array<long>").dropDuplicates(["cls"]), "sets")
    one = broadcast_within(pairs, few, BROADCAST_ROWS).join(sets.toDF("x", "n_x", "toks_x"), "x")
    both = one.join(sets.toDF("y", "n_y", "toks_y"), "y")
    found = cut(both.where(F.size(F.array_intersect("toks_x", "toks_y")) * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent).select("x", "y"), "links")
    discard(sets)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, count: int = BANDS, rows: int = ROWS, rounds: int = ROUNDS, block: int = BLOCK) -> DataFrame:
    """Rows (doc_id, n_shingles, cls, component_id): one for each row of ``docs``."""
    spark = docs.sparkSession
    bound_batches(spark)
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")).withColumn("mark", F.xxhash64("text"))
    sets = cut(read.select("doc_id", "text", "mark").mapInArrow(_sketch(words, count, rows), SETS), "sketches")
    classes = cut(sets.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min(F.struct("doc_id", "mark")).alias("at"), F.first("n").alias("n"), F.first("map").alias("map"), F.first("bands").alias("bands")), "classes")
    small = classes.select("cls", "n", "map")

    postings = classes.select("cls", F.explode("bands").alias("band"))
    shared = cut(postings.groupBy("band").agg(F.min("cls").alias("lead"), F.max("cls").alias("hi")).where("lead < hi").select("band", "lead"), "shared")
    release(spark)  # the shuffle of the counted bands goes before they are shuffled again
    groups = cut(postings.join(broadcast_within(shared, shared.count(), BROADCAST_ROWS), "band").where("cls != lead").groupBy("lead", "cls").count().select("lead", "cls"), "groups")
    discard(shared)
    release(spark)

    def could(led: DataFrame) -> DataFrame:
        """Of rows (cls, lead), the pairs that sizes and bitmaps allow."""
        wide = led.join(small, "cls").join(small.toDF("lead", "m", "lead_map"), "lead")
        return cut(wide.select("cls", "lead", "n", "m", "map", "lead_map").mapInArrow(_leader_rows(percent), "x long, y long"), "pairs")

    def named(known: DataFrame, col: str) -> DataFrame:
        return known.select(F.col("node").alias(col), F.col("label").alias(f"{col}_label"))

    tested = could(groups.groupBy("cls").agg(F.min("lead").alias("lead")))
    links = verify(tested, read, classes, words, percent)
    known = connected_components(links, "x", "y")
    apart = groups.join(named(known, "cls"), "cls", "left").join(named(known, "lead"), "lead", "left")
    apart = apart.where(F.coalesce("cls_label", "cls") != F.coalesce("lead_label", "lead")).select("cls", "lead")
    more = cut(could(apart).join(_either_way(tested), ["x", "y"], "left_anti"), "pairs")
    tested, links = tested.union(more), links.union(verify(more, read, classes, words, percent))
    known = connected_components(links, "x", "y")
    release(spark)
    nearest = rounds
    while True:
        close = _across(groups, known, small, percent, nearest > 0, block).select("x", "y").distinct()  # several groups may hold a pair
        fresh = cut(close.join(_either_way(tested), ["x", "y"], "left_anti"), "pairs")
        if not fresh.isEmpty():
            found = verify(fresh, read, classes, words, percent)
            tested, links = tested.union(fresh), links.union(found)
            known = connected_components(links, "x", "y")
            release(spark)
            last, nearest = not nearest, 0 if found.isEmpty() else max(0, nearest - 1)
        else:
            last, nearest = not nearest, 0  # what is nearest is tested: on to all pairs
        if last:
            break

    label = cut(classes.select("cls", "rep").join(known.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls")), "labels")
    least = label.groupBy("label").agg(F.min("rep").alias("component_id"))
    discard(groups)
    of = label.join(least, "label").select("cls", "component_id")
    return sets.select("doc_id", "n", "cls").join(of, "cls", "left").select("doc_id", F.col("n").alias("n_shingles"), "cls", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` without the rows whose component has a smaller identifier; rows with a null identifier stay."""
    found = near_duplicates(docs, id_col, text_col, **how)
    gone = found.where("component_id != doc_id").select(F.col("doc_id").alias("__tl_gone")).distinct()
    return docs.join(gone, F.col(f"`{id_col}`").cast("long") == F.col("__tl_gone"), "left_anti")


def query(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
             ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
      FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
k AS (SELECT doc_id, n, md5(string_agg(g, chr(10) ORDER BY g)) AS c FROM s JOIN n USING (doc_id) GROUP BY doc_id, n),
r AS (SELECT c, any_value(n) AS n, min(doc_id) AS doc_id FROM k GROUP BY c),
q AS (SELECT s.doc_id, s.g, r.n FROM s JOIN r ON s.doc_id = r.doc_id),
i AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o, any_value(a.n + b.n) AS n FROM q a JOIN q b
      ON a.g = b.g AND a.doc_id < b.doc_id AND a.n * 100 >= b.n * 80 AND b.n * 100 >= a.n * 80 GROUP BY 1, 2),
l AS (SELECT x, y FROM i WHERE 180 * o >= 80 * n),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
t(node, reach) AS (SELECT doc_id, doc_id FROM r UNION SELECT e.y, t.reach FROM t JOIN e ON t.node = e.x WHERE t.reach < e.y),
m AS (SELECT node, min(reach) AS m FROM t GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.m, d.doc_id) AS component_id,
       d.doc_id IS NOT DISTINCT FROM coalesce(m.m, d.doc_id) AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
LEFT JOIN r ON r.c = k.c LEFT JOIN m ON m.node = r.doc_id
"""
