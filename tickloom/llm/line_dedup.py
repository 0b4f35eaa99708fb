"""Line deduplication through a sharded minimal perfect hash.

Distinct line hashes are counted with map-side combine; those found in enough documents go, by hash shard, into a
minimal perfect hash (hash and displace; a lone key of a bucket takes a free slot directly) over three compact arrays:
fingerprint, document count and keeping document.  Documents then probe the arrays: each line hash meets the one row
that holds the arrays of its shard (a shuffled hash join on the shard number, which Spark can split where a line is
frequent) and reads one slot of them.  No line is joined with another line.

Defined results: a null or empty text is one empty line; each row is a document (rows that share a doc_id count
separately, and the largest doc_id keeps a line in all its rows); a null doc_id is smaller than any other; extra
columns pass through.  A line is placed by 128 bits of hash; a probe compares 64 of them, so does the dropping.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import P, bound_batches, cut

MIN_POINTS = 20
MIN_DOCS = 3
#: Keys of a shard; bounds the memory of the task that builds it.
SHARD_KEYS = 20_000
#: So many shards at least, so that probes spread over the tasks where keys are few.
LEAST_SHARDS = 256
_MASK = 0x7FFFFFFF
_BLANK = b" \t\n\x0b\x0c\r"
_LEAST = -(2**63)


def line_key(line: bytes) -> bytes:
    return line.strip(_BLANK).lower()


def _long_enough(key: bytes, points: int) -> bool:
    return len(key) >= points and (len(key) >= 4 * points or len(key.decode("utf-8", "replace")) >= points)


def _digest(key: bytes) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(key)
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _hashes(points: int):
    schema = pa.schema([("rid", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches):
        for batch in batches:
            rid, one, two = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True):
                keys = {line_key(x) for x in (text or b"").split(b"\n")}
                for k in keys:
                    if _long_enough(k, points):
                        a, b = _digest(k)
                        rid.append(doc)
                        one.append(a)
                        two.append(b)
            yield pa.RecordBatch.from_arrays([pa.array(rid, pa.int64()), pa.array(one, pa.int64()), pa.array(two, pa.int64())], schema=schema)

    return run


def place(h1: np.ndarray, h2: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Minimal perfect hash of distinct keys: (seed, displacement by bucket, slot by key)."""
    n = len(h1)
    for seed in range(1000):
        start = ((h2 >> (seed % 32)) & _MASK).tolist()  # a seed reads other bits of the 128
        step = ((h1 >> (12 + seed // 3 % 20)) & _MASK).tolist()
        bucket = (((h2 >> (31 - seed // 5 % 31)) & _MASK) % n).tolist()
        members: dict[int, list[int]] = {}
        for k, b in enumerate(bucket):
            members.setdefault(b, []).append(k)
        shift, slot, taken, lone = [0] * n, [0] * n, bytearray(n), []
        for b, keys in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(keys) == 1:
                lone.append((b, keys[0]))
                continue
            for d in range(8 * n + 64):
                at = [(start[k] + d * step[k]) % n for k in keys]
                if len(set(at)) == len(at) and not any(taken[x] for x in at):
                    break
            else:
                break
            shift[b] = d
            for k, x in zip(keys, at, strict=True):
                taken[x], slot[k] = 1, x
        else:
            free = iter([x for x in range(n) if not taken[x]])
            for b, k in lone:
                slot[k] = x = next(free)
                shift[b] = -x - 1
            return seed, np.array(shift, dtype=np.int32), np.array(slot, dtype=np.int64)
    raise ValueError("no displacement found: keys are not distinct")


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = pdf["h1"].to_numpy(), pdf["h2"].to_numpy()
    seed, shift, slot = place(h1, h2)
    order = np.empty(len(slot), dtype=np.int64)
    order[slot] = np.arange(len(slot))
    return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "seed": [seed], "n": [len(slot)], "shift": [shift], "prints": [h1[order]], "counts": [pdf["n_docs"].to_numpy()[order]], "keeps": [pdf["keep"].to_numpy()[order]]})


def build_index(hashes: DataFrame, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS, least_shards: int = LEAST_SHARDS) -> tuple[DataFrame, int]:
    """One row of arrays for each shard of the lines found in at least ``min_docs`` documents, and the shard count."""
    keys = cut(hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("rid").alias("keep")).where(F.col("n_docs") >= min_docs), "lines")
    shards = max(least_shards, -(-keys.count() // shard_keys))
    kept = keys.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))
    return kept.groupBy("shard").applyInPandas(_build, "shard int, seed long, n long, shift array<int>, prints array<long>, counts array<long>, keeps array<long>"), shards


def _slot() -> Column:
    h1, h2, n = F.col("h1"), F.col("h2"), F.col("n")
    seed = F.col("seed").cast("int")
    low = lambda h, by: F.call_function("shiftright", h, by).bitwiseAND(F.lit(_MASK))
    bucket = F.pmod(low(h2, 31 - F.floor(seed / 5).cast("int") % 31), n)
    d = F.get("shift", bucket.cast("int")).cast("long")
    start = low(h2, seed % 32)
    step = low(h1, 12 + F.floor(seed / 3).cast("int") % 20)
    return F.when(d < 0, -d - 1).otherwise(F.pmod(start + d * step, n)).cast("int")


def probe(hashes: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Rows (rid, h1, n_docs, keep) of the line hashes that the arrays hold."""
    asked = hashes.withColumn("shard", F.pmod(F.col("h1"), F.lit(shards)).cast("int"))
    met = asked.join(index.hint("shuffle_hash"), "shard")
    at = met.select("rid", "h1", F.struct(_slot().alias("s")).alias("at"), "prints", "counts", "keeps")
    s = F.col("at.s")
    return at.where(F.get("prints", s) == F.col("h1")).select("rid", "h1", F.get("counts", s).alias("n_docs"), F.get("keeps", s).alias("keep"))


def _drop_lines(points: int):
    @F.pandas_udf("kept string, n_lines long, n_dropped long")
    def run(text: pd.Series, drops: pd.Series) -> pd.DataFrame:
        rows = []
        for t, gone in zip(text, drops, strict=True):
            raw = (t or "").encode("utf-8", "surrogatepass")
            lines = raw.split(b"\n")
            left = lines
            if gone is not None and len(gone):
                gone = set(gone.tolist())
                left = [x for x in lines if not (_long_enough(k := line_key(x), points) and _digest(k)[0] in gone)]
            rows.append((t or "" if left is lines else b"\n".join(left).decode("utf-8", "surrogatepass"), len(lines), len(lines) - len(left)))
        return pd.DataFrame(rows, columns=["kept", "n_lines", "n_dropped"])

    return run


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_points: int = MIN_POINTS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with ``__tl_kept`` (text without its frequent lines), ``__tl_n_lines`` and ``__tl_n_dropped``."""
    bound_batches(docs.sparkSession)
    rid = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    hashes = cut(docs.select(rid.alias("rid"), F.col(text_col).alias("text")).mapInArrow(_hashes(min_points), "rid long, h1 long, h2 long"), "line-hashes")
    index, shards = build_index(hashes, min_docs, shard_keys)
    index = cut(index, "line-index")
    drops = probe(hashes, index, shards).where((F.col("n_docs") >= min_docs) & (F.col("keep") != F.col("rid"))).groupBy(F.col("rid").alias(f"{P}rid")).agg(F.collect_set("h1").alias(f"{P}drops"))
    joined = docs.withColumn(f"{P}rid", rid).join(drops, f"{P}rid", "left")
    done = joined.withColumn(f"{P}out", _drop_lines(min_points)(F.col(text_col), F.col(f"{P}drops")))
    return done.select(*docs.columns, *[F.col(f"{P}out.{x}").alias(f"{P}{x}") for x in ("kept", "n_lines", "n_dropped")])


def query(docs: DataFrame) -> DataFrame:
    d = dedup_lines(docs.select("doc_id", "text"))
    return d.select("doc_id", F.col(f"{P}n_lines").alias("n_lines"), F.col(f"{P}n_dropped").alias("n_dropped"), F.sha2(F.col(f"{P}kept").cast("binary"), 256).alias("kept_sha256"))


SQL = r"""
WITH l AS (
  SELECT doc_id, n, part,
         translate(regexp_replace(regexp_replace(part, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS part,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
        FROM documents)),
f AS (SELECT k, max(doc_id) AS keep FROM l WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT l.doc_id, l.n, l.part, f.k IS NOT NULL AND f.keep <> l.doc_id AS gone FROM l LEFT JOIN f ON l.k = f.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(part, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
