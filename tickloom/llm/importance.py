"""Importance resampling towards a target distribution, with an integer dictionary of words.

A task maps the distinct words it meets to integers and writes a text as an array of these; an n-gram is a tuple of
them.  Each distinct tuple is hashed once: its words are put together again, joined by one space, and the CRC-32 of these
bytes gives its bucket.  The counts of a batch's distinct tuples are then joined to the buckets by index.  A dictionary
is a task's own and starts anew at ``KEPT`` entries, so its memory is bounded and no words are shuffled; a tuple's
bucket doesn't depend on the dictionary.

1. Over all documents and over all target texts: features of each bucket, summed in the tasks and then in Spark.
2. The gain of a bucket is the logarithm of its smoothed share in the target over that in the documents; a document's
   weight is the sum over its features.  With Gumbel noise from a hash of the identifier the highest scores are a
   sample without replacement in proportion to exp(weight / 1000).
3. The draw is an exact global order without one task: rows are range-partitioned and sorted, numbered within their
   partition, and partitions' counts give the offset.

Defined results: a null or empty text, or one without words, has no feature and weight 0; each row is a document, and
rows that share an identifier share the noise; a null identifier is hashed as the empty word and comes last among equal
scores; an empty table gives no row; with an empty target all buckets have the smoothed share; extra columns aren't read.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, cut

LOW, HIGH = 1, 1
BUCKETS = 10_000
LEAST_WORDS, PERCENT, SEED = 20, 10, "2024"
#: Entries at which a task's dictionary starts anew.
KEPT = 500_000
#: Bytes of a text that become words at once, and words of a run of texts.
PIECE, RUN = 1 << 20, 1 << 18

#: Bytes of words: digits, letters (A-Z lower-cased) and all of characters beyond ASCII; every other byte is a blank.
_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_BLANK = re.compile(rb"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]")


class _Ids(dict):
    """Integers of keys, in the order in which they are met; ``keys_met`` lists the keys by their integers."""

    def __init__(self):
        self.keys_met: list = []

    def __missing__(self, key) -> int:
        self[key] = n = len(self)
        self.keys_met.append(key)
        return n


class Dictionary:
    """Words and n-grams of a task as integers.  For each length of n-grams ``buckets_of`` holds the buckets of the distinct tuples; that of a single word is its integer's."""

    def __init__(self, low: int, high: int, buckets: int):
        self.lengths, self.buckets = range(low, high + 1), buckets
        self._forget()

    def _forget(self) -> None:
        self.words = _Ids()
        self.grams = {n: _Ids() for n in self.lengths if n > 1}
        self.buckets_of = {n: np.zeros(0, dtype=np.int32) for n in self.lengths}

    def _hashed(self, n: int) -> np.ndarray:
        """Buckets of all tuples of a length; those met since the last call are hashed from their words' bytes, once."""
        spelt, known = self.words.keys_met, self.buckets_of[n]
        met = spelt if n == 1 else self.grams[n].keys_met
        if len(met) > len(known):
            new = met[len(known) :]
            crcs = map(zlib.crc32, new if n == 1 else (b" ".join([spelt[w] for w in gram]) for gram in new))
            known = self.buckets_of[n] = np.concatenate([known, np.fromiter(crcs, np.int64, len(new)) % self.buckets]).astype(np.int32)
        return known

    def _pieces(self, texts: Iterable[bytes]) -> Iterator[tuple[int, bytes, bool]]:
        """Pieces of texts, cut at blanks: (text number, piece, whether it begins the text)."""
        for k, text in enumerate(texts):
            at = 0
            while at < len(text):
                blank = _BLANK.search(text, at + PIECE) if at + PIECE < len(text) else None
                end = blank.start() if blank else len(text)
                yield k, text[at:end], not at
                at = end

    def features(self, texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For runs of texts: the buckets of their n-grams, the number of the text of each, and those of each word's text."""
        ids: list[int] = []
        of: list[tuple[int, int]] = []  # (text, words) of each piece
        before: list[int] = []

        def done() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            word, owner = np.array(ids, dtype=np.int64), np.repeat(*np.array(of, dtype=np.int64).reshape(-1, 2).T)
            found, owners = [], []
            for n in self.lengths:
                if n == 1:
                    gram, whose = word[len(before) :], owner[len(before) :]
                else:
                    tuples = zip(*(ids[k:] for k in range(n)), strict=False)
                    same = owner[n - 1 :] == owner[: max(0, len(owner) - n + 1)]
                    same[: max(0, len(before) - n + 1)] = False  # counted with the run before
                    gram = np.fromiter(map(self.grams[n].__getitem__, itertools.compress(tuples, same.tolist())), np.int64)
                    whose = owner[n - 1 :][same]
                found.append(self._hashed(n)[gram])
                owners.append(whose)
            return np.concatenate(found), np.concatenate(owners), owner[len(before) :]

        for k, piece, _ in self._pieces(texts):
            some = list(map(self.words.__getitem__, piece.translate(_BYTES).split()))
            ids += some
            of.append((k, len(some)))
            if len(ids) > RUN:
                yield done()
                held, owner = ids[max(0, len(ids) - self.lengths[-1] + 1) :] if self.lengths[-1] > 1 else [], k
                short = min(len(held), len(some))  # only this text's words can go on
                held = held[len(held) - short :]
                if len(self.words) + sum(map(len, self.grams.values())) > KEPT:
                    spelt = [self.words.keys_met[w] for w in held]
                    self._forget()
                    held = [self.words[w] for w in spelt]
                before[:], ids[:], of[:] = held, held, [(owner, len(held))]
        if len(ids) > len(before):
            yield done()


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _counts(low: int, high: int, buckets: int) -> Callable:
    """Rows (bucket, n) of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Dictionary(low, high, buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for found, _, _ in known.features(_texts(batch.column(0))):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", low: int = LOW, high: int = HIGH, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts in each bucket; ``buckets`` rows at most reach the driver."""
    parts = texts.select(F.col(f"`{text_col}`")).mapInArrow(_counts(low, high, buckets), "bucket long, n long")
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in parts.groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t, k = float(documents.sum()), float(target.sum()), len(documents)
    return np.array([math.floor(1000 * math.log((b + 1.0) * (s + k) / ((a + 1.0) * (t + k)))) for a, b in zip(documents.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def _weigh(low: int, high: int, gain: np.ndarray) -> Callable:
    """Rows (id, n_words, n_features, weight)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Dictionary(low, high, len(gain))
        for batch in batches:
            rows = np.zeros((3, batch.num_rows), dtype=np.int64)
            for found, whose, words in known.features(_texts(batch.column(1))):
                np.add.at(rows[2], whose, gain[found])
                for row, of in zip(rows, (words, whose), strict=False):
                    row += np.bincount(of, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, rows)], names=["doc_id", "n_words", "n_features", "weight"])

    return run


def noise(id_col: str, seed: str) -> Column:
    """Standard Gumbel noise of an identifier in thousandths, rounded down."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def ranked(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place``, their number from 1 in a global order, from a range-partitioned sort."""
    at = F.monotonically_increasing_id()  # partition << 33 | row of the partition, in sorted order
    placed = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", at), "ordered")
    counts = placed.groupBy(F.shiftright("at", 33).alias("part")).count().orderBy("part").collect()  # a row a partition
    offsets, total = [], 0
    for part, n in counts:
        offsets.append((part, total))
        total += n
    table = rows.sparkSession.createDataFrame(offsets, "part long, before long")
    joined = placed.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(table), "part", "left")  # as few rows as partitions
    return joined.withColumn("place", F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at", "part", "before")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", low: int = LOW, high: int = HIGH, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score, rank), the rank null where the document isn't drawn."""
    bound_batches(docs.sparkSession)
    gain = gains(bucket_counts(docs, text_col, low, high, buckets), bucket_counts(target, text_col, low, high, buckets))
    read = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    weighed = read.mapInArrow(_weigh(low, high, gain), "doc_id long, n_words long, n_features long, weight long")
    scored = weighed.withColumn("score", F.col("weight") + noise("doc_id", seed))
    could = (F.col("n_words") >= least_words).alias("could")
    placed = ranked(scored.select("*", could), F.col("could").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    placed = cut(placed, "ranked")
    drawn = percent * placed.where("could").count() // 100
    return placed.select("doc_id", "n_words", "n_features", "weight", "score", F.when(F.col("could") & (F.col("place") <= drawn), F.col("place")).alias("rank"))


def draw(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose identifier is drawn; of rows that share an identifier all or none."""
    chosen = resample(docs, target, id_col, text_col, **how).where("rank is not null").select(F.col("doc_id").alias("__tl_id")).distinct()
    return docs.join(chosen, F.col(f"`{id_col}`").eqNullSafe(F.col("__tl_id")), "left_semi")


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return resample(docs, benchmark).select("doc_id", "n_features", "weight", "score", "rank")


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
a AS (SELECT row, unnest(w) AS w FROM d),
v AS (SELECT w, (xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(strlen(w)), lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::BIGINT)),
             lambda x, y: list_reduce(list_prepend(xor(x, y), range(8)), lambda z, i: xor(z >> 1, 3988292384 * (z & 1))))) % 10000)::INTEGER AS k
      FROM (SELECT w FROM a UNION SELECT w FROM b)),
s AS (SELECT k, count(*) AS s FROM a JOIN v USING (w) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM b JOIN v USING (w) GROUP BY k),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS t),
g AS (SELECT k, floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (n.s + 10000) / ((coalesce(s.s, 0) + 1)::DOUBLE * (n.t + 10000))))::BIGINT AS g
      FROM (SELECT DISTINCT k FROM v) LEFT JOIN s USING (k) LEFT JOIN t USING (k) CROSS JOIN n),
m AS (SELECT row, sum(g) AS weight FROM a JOIN v USING (w) JOIN g USING (k) GROUP BY row),
r AS (SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(m.weight, 0)::BIGINT AS weight,
             coalesce(m.weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
      FROM d LEFT JOIN m USING (row)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS p FROM r)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND p <= (SELECT 10 * count(*) // 100 FROM r WHERE n_features >= 20) THEN p END AS rank
FROM o
"""
