"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.  DataFrame functions only.

A test item is the set of its distinct five-word shingles; a document holds it when at least 80 % of them occur in the
document.  Both are sketched by the shingles of least hash.  Of an item of q shingles of which c = ceil(0.8 q) must occur,
the sketch takes the s = q - c + 1 + slack least hashes; at most q - c of them can be missing, so a document that holds the
item has at least s - (q - c) of them, and none is lost, however long the document is.  Documents are dealt by size
(powers of two of their shingle count).  An item can only be held from the partition of its c on; the sketch of a document
is its hashes up to the greatest that any item open to its partition asks for, which cuts most of a document away.

Candidates are then verified on the shingles' text, not on hashes.

Defined results: words are runs of characters other than 0x20 and 0x09-0x0D, with A-Z lower-cased; a null or empty text,
or one of fewer than five words, has no shingles, so it holds nothing and is held by nothing; a document row with a null
identifier is searched and reported with null; rows that share an identifier are verified on their own and reported once
with the largest overlap; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import broadcast_within, cut

WORDS = 5
PERCENT = 80
#: Sketch shingles beyond the fewest that lose nothing; so many more hits are asked for.
SLACK = 4
#: Rows of sketch shingles (20 bytes each) broadcast at most; beyond that the join is shuffled.
SKETCH_ROWS = 500_000
#: Candidate documents broadcast at most.
CANDIDATE_ROWS = 500_000
#: Bytes of item shingles broadcast at most.
ITEM_BYTES = 64_000_000
#: Size partitions (powers of two of a shingle count).
PARTS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEAST = -(2**63)


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def _places(w: Column, width: int) -> Column:
    """Places where a run of ``width`` words starts."""
    return F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - width)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(w: Column, width: int = WORDS) -> Column:
    """Distinct hashes of the shingles of a column of word hashes (a column, so that a place reads it and doesn't make it anew)."""
    return F.array_distinct(F.transform(_places(w, width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])))


def shingle_texts(w: Column, width: int = WORDS) -> Column:
    return F.array_distinct(F.transform(_places(w, width), lambda i: F.concat_ws(" ", F.slice(w, i + 1, F.lit(width)))))


def _hashed(text: Column, width: int) -> Column:
    # Word hashes first, as an array of their own, so that each word is hashed once.
    return F.transform(words(text), lambda w: F.xxhash64(w))


def item_table(items: DataFrame, item_col: str = "item_id", text_col: str = "text", width: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Rows (item, grams, q, need) of the items that have shingles."""
    t = items.select(F.col(item_col).alias("item"), words(F.col(text_col)).alias("w")).select("item", shingle_texts(F.col("w"), width).alias("grams"))
    # Written before any filter: a filter on the shingles would be pushed below the words and split them for each shingle.
    t = cut(t, "item-shingles").withColumn("q", F.size("grams")).where("q > 0")
    return t.withColumn("need", F.ceil(F.col("q") * percent / F.lit(100.0)).cast("int")).dropDuplicates(["item", "grams"])


def sketches(table: DataFrame, slack: int = SLACK) -> DataFrame:
    """Rows (h, item, asked, part, tau): bottom-k shingle hashes of each item, hits asked for, least size partition, greatest hash."""
    width_of = lambda g: F.split(g, " ")
    hashes = F.array_sort(F.transform("grams", lambda g: F.xxhash64(*[F.xxhash64(F.get(width_of(g), k)) for k in range(WORDS)])))
    s = F.least(F.col("q"), F.col("q") - F.col("need") + 1 + slack)
    least = table.select("item", F.slice(hashes, F.lit(1), s).alias("hs"), (s - (F.col("q") - F.col("need"))).alias("asked"), F.floor(F.log2(F.col("need"))).cast("int").alias("part"))
    return least.select("item", F.explode("hs").alias("h"), "asked", "part", F.element_at("hs", -1).alias("tau"))


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", percent: int = PERCENT, slack: int = SLACK) -> DataFrame:
    """Rows (doc, item, n_item, n_shared) of the items that documents hold."""
    table = cut(item_table(items, item_col, "text", WORDS, percent), "items")
    sketch = cut(sketches(table, slack), "sketches")
    n_sketch, item_bytes = sketch.count(), table.agg(F.coalesce(F.sum(F.octet_length(F.array_join("grams", " "))), F.lit(0))).first()[0]
    most = {r[0]: r[1] for r in sketch.groupBy("part").agg(F.max("tau")).collect()}  # one row a size partition: 31 at most
    # The sketch of a document: its hashes up to the greatest that an item which fits into its size partition asks for.
    tops = [max((t for q, t in most.items() if q <= p), default=None) for p in range(PARTS)]
    top = F.element_at(F.array(*[F.lit(t).cast("long") for t in tops]), F.col("size_part") + 1)
    read = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST)).alias("doc"), F.col(text_col).alias("text"))
    grams = read.select("doc", _hashed(F.col("text"), WORDS).alias("w")).select("doc", shingle_hashes(F.col("w")).alias("hs"))
    grams = grams.select("doc", "hs", F.coalesce(F.floor(F.log2(F.greatest(F.size("hs"), F.lit(1)))).cast("int"), F.lit(0)).alias("size_part"))
    seen = grams.select("doc", "size_part", F.explode_outer(F.filter("hs", lambda h: h <= top)).alias("h"))  # outer and coalesce: no filter on the array, which would be evaluated again
    hits = seen.join(broadcast_within(sketch.drop("tau"), n_sketch, SKETCH_ROWS), "h").where("size_part >= part")
    candidates = hits.groupBy("doc", "item").agg(F.count_distinct("h").alias("hits"), F.first("asked").alias("asked")).where("hits >= asked")
    asked = cut(candidates.select("doc").distinct(), "asked")
    # Exact: the shingles' texts of candidate rows meet those of the items; a row is verified on its own.
    found = read.withColumn("row", F.monotonically_increasing_id()).join(broadcast_within(asked, asked.count(), CANDIDATE_ROWS), "doc", "left_semi")
    held = found.select("row", "doc", words(F.col("text")).alias("w")).select("row", "doc", F.explode(shingle_texts(F.col("w"))).alias("gram"))
    parts = table.select("item", "q", "need", F.explode("grams").alias("gram"))
    exact = held.join(F.broadcast(parts) if item_bytes <= ITEM_BYTES else parts, "gram").groupBy("row", "doc", "item", "q", "need").agg(F.count(F.lit(1)).alias("n_shared")).where("n_shared >= need")
    best = exact.groupBy("doc", "item", F.col("q").alias("n_item")).agg(F.max("n_shared").alias("n_shared"))
    return best.withColumn("doc", F.when(F.col("doc") != F.lit(_LEAST), F.col("doc")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose identifier holds an item; rows with a null identifier go where any such row holds one."""
    bad = cut(contained_items(docs, items, id_col, text_col).select(F.col("doc").alias("__tl_bad")).distinct(), "leaks")
    return docs.join(bad, F.col(id_col).eqNullSafe(F.col("__tl_bad")), "left_anti")


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contained_items(docs, items).select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("n_item").cast("long").alias("n_item"), F.col("n_shared").cast("long").alias("n_shared"))


SQL = r"""
WITH t AS (SELECT 0 AS k, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark),
w AS (SELECT k, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x20\x09-\x0D]+') AS w FROM t),
s AS (SELECT DISTINCT k, id, unnest(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' '))) AS g
      FROM w WHERE len(w) >= 5),
q AS (SELECT id, g, count(*) OVER (PARTITION BY id) AS n FROM s WHERE k = 1)
SELECT s.id AS doc_id, q.id AS item_id, q.n AS n_item, count(*) AS n_shared
FROM s JOIN q ON s.g = q.g WHERE s.k = 0 GROUP BY s.id, q.id, q.n HAVING 100 * count(*) >= 80 * q.n
"""
