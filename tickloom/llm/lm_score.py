"""Document scores from a gated recurrent language model in numpy.

Word counts over all training documents (each word once a task, then summed by Spark) give the vocabulary, a unigram
base score, and the model's word list: the ``LIST`` most frequent words, dealt into classes of about equal weight.  The
model is a GRU whose output is factored: class given state, then word given class and state.  A word off the list is the
list's unknown word times its share of the remaining unigram mass, so probabilities over all words sum to one.  Words
are known by 64 bits of hash (``hashing``).

Training starts from the unigram distribution.  The training documents are dealt into ``ROUNDS`` parts.  In each round
every task trains on its documents of that part by truncated backpropagation (every window of ``STEPS`` tokens of each
document, with the state carried from one window to the next; a lane whose document ends takes the next one with a fresh
state); then the tasks' weights are averaged in Spark by the tokens that each has seen, so what is sent grows with the
tasks and what reaches the driver is one model.  Scoring runs through whole documents in windows and carries the state,
so a score is the log-likelihood of the complete document.

Counts of the most frequent words, ``HEAD`` at most, go to the tasks; the others are joined in Spark.

Defined results: a null text is empty and has the end token alone; a null identifier isn't in the held-out fold; rows
that share an identifier are scored on their own; without training documents counts are 0 and the model is uniform over
its one word; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import bound_batches, cut
from tickloom.llm.hashing import word_hashes

FOLDS, FOLD = 7, 2
#: Words of the model; words whose counts go to every task (some 30 bytes each); both bound memory.
LIST, HEAD = 1024, 200_000
EMBED, STATE, CLASSES = 16, 24, 32
STEPS, LANES, RATE = 16, 256, 0.2
#: Parts of the training documents; the tasks' models are averaged after each.
ROUNDS = 2
#: Weights in one row while models are averaged.
PIECE = 4096
#: Distinct words that a task counts before it hands them on.
COUNTED = 400_000
END = b""
_END = 0x2545F4914F6CDD1D


def tokens(text: bytes | None) -> list[bytes]:
    """Words (ASCII lower case) and one end token."""
    return [*(text or b"").lower().split(), END]


def word_id(word: bytes) -> int:
    """The 64 bits by which a word, or the end token, is known."""
    return _END if word == END else int(next(word_hashes([word]))[0][0])


class Index:
    """Places of hashes in a list, by open addressing in two arrays."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.bits = max(4, int(4 * len(hashes)).bit_length())
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.at = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.arange(len(hashes), dtype=np.int32)
        where = self._home(hashes)
        while len(left):
            free = self.at[where] < 0
            first = np.unique(where[free], return_index=True)[1]
            take = np.flatnonzero(free)[first]
            self.keys[where[take]], self.at[where[take]] = hashes[left[take]], left[take]
            stay = np.ones(len(left), dtype=bool)
            stay[take] = False
            left, where = left[stay], (where[stay] + 1) & ((1 << self.bits) - 1)

    def _home(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, hashes: np.ndarray, none: int) -> np.ndarray:
        out = np.full(len(hashes), none, dtype=np.int64)
        left, where = np.arange(len(hashes)), self._home(hashes)
        while len(left):
            at = self.at[where]
            same = (self.keys[where] == hashes[left]) & (at >= 0)
            out[left[same]] = at[same]
            more = ~same & (at >= 0)
            left, where = left[more], (where[more] + 1) & ((1 << self.bits) - 1)
        return out

    def __getitem__(self, word: bytes) -> int:
        return int(self.find(np.array([word_id(word)], dtype=np.uint64), -1)[0])


class Vocabulary:
    """Head words with counts, of which the first ``size`` are the model's list, grouped by class."""

    def __init__(self, head: list[tuple[bytes | int, int]], total: int, distinct: int, size: int = LIST, classes: int = CLASSES) -> None:
        self.total, self.distinct = total, distinct
        self.index = Index(np.array([w & (1 << 64) - 1 if isinstance(w, int) else word_id(w) for w, _ in head], dtype=np.uint64))
        self.counts = np.array([*[c for _, c in head], 0], dtype=np.float64)
        self.size = min(size, len(head))
        listed = np.sqrt(self.counts[: self.size])
        share = np.cumsum(listed) / max(listed.sum(), 1e-9)
        group = np.minimum((share * classes * 0.999999).astype(int), classes - 1)
        group = np.unique(group, return_inverse=True)[1] if self.size else np.zeros(0, dtype=int)  # words are by falling count, so classes are runs
        self.classes = (int(group[-1]) + 1 if self.size else 0) + 1  # the unknown word is a class of its own
        self.group = np.append(group, self.classes - 1).astype(np.int32)
        self.first = np.searchsorted(self.group, np.arange(self.classes + 1))
        self.whole = total + distinct + 1
        self.rest = self.whole - (self.counts[: self.size] + 1).sum()

    def places(self, texts: Iterable[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each text the hashes of its tokens and their places in the head (``len(counts) - 1``: none)."""
        end = np.array([_END], dtype=np.uint64)
        last, none = self.index.find(end, len(self.counts) - 1), len(self.counts) - 1
        for h, edges in word_hashes(texts):
            at = self.index.find(h, none)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                yield np.append(h[a:b], end), np.append(at[a:b], last)

    def model_ids(self, at: np.ndarray) -> np.ndarray:
        return np.minimum(at, self.size)


def start(v: Vocabulary, seed: int = 3) -> dict[str, np.ndarray]:
    """Weights that give about the unigram distribution at any state; small ones on the output, so that the first window moves all others."""
    rng = np.random.default_rng(seed)
    mass = np.append(v.counts[: v.size] + 1, max(v.rest, 1.0)) / max(v.whole, 1)
    by_class = np.add.reduceat(mass, v.first[:-1])
    small = lambda *s: (rng.standard_normal(s) * 0.15).astype(np.float32)
    return {
        "embed": small(v.size + 1, EMBED), "wx": small(EMBED, 3 * STATE), "wh": small(STATE, 3 * STATE), "b": np.zeros(3 * STATE, np.float32),
        "wc": small(STATE, v.classes) / 10, "bc": np.log(by_class).astype(np.float32),
        "wo": small(v.size + 1, STATE) / 10, "bo": np.log(mass).astype(np.float32),
    }


def _fed(m: dict, ids: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """What words (all without ``ids``) give to the GRU's gates, and the weights of its state; both halved where a sigmoid follows, as it is a tanh of half its input."""
    half = np.ones(3 * STATE, m["wx"].dtype)
    half[: 2 * STATE] = 0.5
    embed = m["embed"] if ids is None else m["embed"][ids]
    return embed @ (m["wx"] * half) + m["b"] * half, m["wh"] * half


def _forward(x: np.ndarray, wh: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """Steps of the GRU from inputs and weights of ``_fed``: the states before each, the last state, and what the way back needs."""
    steps, lanes = x.shape[:2]
    states, n, rn, zg = (np.empty((steps, lanes, k * STATE), x.dtype) for k in (1, 1, 1, 2))
    for t in range(steps):
        states[t] = h
        r, both, new = h @ wh, zg[t], n[t]
        np.add(x[t, :, : 2 * STATE], r[:, : 2 * STATE], out=both)
        np.tanh(both, out=both)
        both *= 0.5
        both += 0.5
        rn[t] = r[:, 2 * STATE :]
        np.multiply(both[:, STATE:], rn[t], out=new)
        new += x[t, :, 2 * STATE :]
        np.tanh(new, out=new)
        h = h - new
        h *= both[:, :STATE]
        h += new
    return states, h, zg, n, rn


def _output(m: dict, v: Vocabulary, h: np.ndarray, ids: np.ndarray, grads: list | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of ids at states, and with ``grads`` the gradient of the mean loss by state.

    ``grads`` gets rows (weight, which part of it, gradient); what no id touches isn't in it.
    """
    n, group = len(ids), v.group[ids]
    # Tokens are sorted by class once, so a class is a run of them; they lie along the last axis, where numpy reduces and indexes fast.
    order = np.argsort(group, kind="stable")
    h, ids, group = h[order], ids[order], group[order]
    rows = np.arange(n)
    logits = m["wc"].T @ h.T + m["bc"][:, None]
    logits -= logits.max(axis=0)
    own = logits[group, rows]
    e = np.exp(logits, out=logits)
    total = e.sum(axis=0)
    found, back = own - np.log(total), None
    if grads is not None:
        e *= 1 / (total * n)
        e[group, rows] -= 1 / n
        grads += [("wc", slice(None), h.T @ e.T), ("bc", slice(None), e.sum(axis=1))]
        back = e.T @ m["wc"].T
    edges, parts = np.searchsorted(group, np.arange(v.classes + 1)).tolist(), []
    for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        lo, hi = v.first[c], v.first[c + 1]
        if a == b or hi - lo == 1:
            continue
        hc, wo = h[a:b], m["wo"][lo:hi]
        logit = wo @ hc.T + m["bo"][lo:hi, None]
        logit -= logit.max(axis=0)
        k, r = ids[a:b] - lo, rows[: b - a]
        own = logit[k, r]
        e = np.exp(logit, out=logit)
        total = e.sum(axis=0)
        found[a:b] += own - np.log(total)
        if grads is not None:
            e *= 1 / (total * n)
            e[k, r] -= 1 / n
            parts.append((np.arange(lo, hi), e @ hc, e.sum(axis=1)))
            back[a:b] += e.T @ wo
    if parts:
        touched, wo, bo = (np.concatenate(x) for x in zip(*parts, strict=True))
        grads += [("wo", touched, wo), ("bo", touched, bo)]
    out = np.empty_like(found)
    out[order] = found
    if back is not None:
        sorted_back, back = back, np.empty_like(back)
        back[order] = sorted_back
    return out, back


def train_window(m: dict, v: Vocabulary, h: np.ndarray, ids: np.ndarray, memory: dict, real: np.ndarray | None = None) -> np.ndarray:
    """One step of truncated backpropagation (Adagrad) on ids of shape (steps, lanes); returns the state to carry.

    ``real`` is false after a lane's end: what lies there has no loss.
    """
    steps, lanes = ids.shape
    few = ids.size < len(m["embed"])
    x, wh = _fed(m, ids if few else None)
    states, h, zg, n, rn = _forward(x if few else x[ids], wh, h)
    grads: list[tuple] = []
    flat, wanted = states.reshape(-1, STATE), ids.reshape(-1)
    if real is None or real.all():
        back = _output(m, v, flat, wanted, grads)[1].reshape(steps, lanes, STATE)
    else:
        back = np.zeros_like(flat)
        at = real.reshape(-1)
        back[at] = _output(m, v, flat[at], wanted[at], grads)[1]
        back = back.reshape(steps, lanes, STATE)
    if steps > 1:
        # What multiplies a state's gradient is worked out for all steps at once; only the gradient itself goes back step by step.
        z, g, n, rn = zg[:-1, :, :STATE], zg[:-1, :, STATE:], n[:-1], rn[:-1]
        rest = 1 - z
        new = rest * (1 - n * n)
        by = np.empty((steps - 1, lanes, 3, STATE), states.dtype)
        by[:, :, 0] = rest * z * (states[:-1] - n)
        np.multiply(new, g, out=by[:, :, 2])
        by[:, :, 1] = by[:, :, 2] * rn * (1 - g)
        dhs = np.empty((steps - 1, lanes, STATE), states.dtype)
        dh, wt = back[steps - 1], np.ascontiguousarray(m["wh"].T)
        for t in range(steps - 2, -1, -1):
            dhs[t] = dh
            by[t] *= dh[:, None]
            dh = dh * z[t]
            dh += by[t].reshape(lanes, -1) @ wt
            dh += back[t]
        fed, dr = ids[:-1].reshape(-1), by.reshape(-1, 3 * STATE)
        grads.append(("wh", slice(None), flat[: len(fed)].T @ dr))
        dr[:, 2 * STATE :] = (new * dhs).reshape(-1, STATE)  # from here on by input
        order = np.argsort(fed, kind="stable")  # rows of one word are summed
        words, first = np.unique(fed[order], return_index=True)
        grads += [("b", slice(None), dr.sum(axis=0)), ("wx", slice(None), m["embed"][fed].T @ dr), ("embed", words, np.add.reduceat((dr @ m["wx"].T)[order], first))]
    size = math.sqrt(sum(float(np.vdot(x, x)) for _, _, x in grads))
    share = 1.0 if real is None else float(real.sum()) / (STEPS * LANES)  # a window with few lanes left weighs as little as its tokens
    for k, part, x in grads:
        x *= share * min(1.0, 1.0 / max(size, 1e-9))
        seen = memory[k][part] + x * x
        memory[k][part] = seen
        m[k][part] -= RATE * x / (np.sqrt(seen) + 1e-6)
    return h


def _windows(docs: Iterable[tuple], lanes: int, steps: int, stretch: bool = False):
    """Windows over id sequences, ``lanes`` side by side; a lane whose document ends takes the next one with a fresh state.

    With ``stretch``, when the sequences run out and few lanes are left, their windows get longer, up to the tokens of a full one.
    Yields (keys of the live lanes, ids, which of them are real, whether a lane ends here, states); the receiver puts the states to carry into the last.
    """
    docs, live, keys, h = iter(docs), [], [], np.zeros((0, STATE), np.float32)
    while True:
        new = list(islice(docs, lanes - len(live)))
        if not live and not new:
            return
        keys += [k for k, _ in new]
        live += [x for _, x in new]
        h = np.concatenate([h, np.zeros((len(new), STATE), np.float32)])
        left = np.array([len(x) for x in live])
        width = steps * (lanes // len(live)) if stretch else steps
        n = np.minimum(left, width)
        real = np.arange(n.max())[:, None] < n
        ids = np.zeros(real.shape, dtype=np.int64)
        for j, x in enumerate(live):
            ids[: n[j], j] = x[:width]
        ends = left <= width
        state = [h]
        yield keys, ids, real, ends, state
        keep = np.flatnonzero(~ends).tolist()
        live, keys, h = [live[j][width:] for j in keep], [keys[j] for j in keep], state[0][keep]


def score_stream(m: dict, v: Vocabulary, docs: Iterable[tuple], lanes: int = 512, steps: int = 16) -> Iterator[tuple]:
    """(key, natural log-likelihood) of each (key, id sequence), as they end; state is carried from window to window."""
    table, wh = _fed(m)
    total: dict = {}
    for keys, ids, real, ends, state in _windows(docs, lanes, steps, True):
        states, state[0] = _forward(table[ids], wh, state[0].astype(table.dtype, copy=False))[:2]
        at = real.reshape(-1)
        logs = np.zeros(at.shape)
        logs[at] = _output(m, v, states.reshape(-1, STATE)[at], ids.reshape(-1)[at])[0]
        for key, found, end in zip(keys, logs.reshape(ids.shape).sum(axis=0).tolist(), ends.tolist(), strict=True):
            found += total.pop(key, 0.0)
            if end:
                yield key, found
            else:
                total[key] = found


def score_lanes(m: dict, v: Vocabulary, lanes: list[np.ndarray], steps: int = 16) -> np.ndarray:
    """Natural log-likelihood of each id sequence."""
    out = np.zeros(len(lanes))
    for k, x in score_stream(m, v, enumerate(lanes), steps=steps):
        out[k] = x
    return out


def _counted(batches):
    """Rows (word, n) of the task's tokens; Spark sums them."""
    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
    words, counts, ends = [], [], 0

    def summed() -> tuple[np.ndarray, np.ndarray]:
        all_words, all_counts = np.concatenate(words), np.concatenate(counts)
        got, where = np.unique(all_words, return_inverse=True)
        return got, np.bincount(where, weights=all_counts, minlength=len(got)).astype(np.int64)

    def rows(w: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n)], schema=schema)

    held = 0
    for batch in batches:
        ends += batch.num_rows
        for h, _ in word_hashes(batch.column(0).cast(pa.binary()).to_pylist()):
            w, n = np.unique(h, return_counts=True)
            words.append(w)
            counts.append(n)
            held += len(w)
            if held > 2 * COUNTED:  # memory of the task
                w, n = summed()
                words, counts, held = [w], [n], len(w)
                if held > COUNTED:
                    yield rows(w, n)
                    words, counts, held = [], [], 0
    if ends:
        words.append(np.array([_END], dtype=np.uint64))
        counts.append(np.array([ends]))
        yield rows(*summed())


def learn(m: dict, v: Vocabulary, docs: Iterable[np.ndarray], memory: dict) -> int:
    """Train on all windows of all id sequences, ``LANES`` of them side by side; returns the tokens learnt from."""
    used = 0
    for _, ids, real, _, state in _windows(((None, x) for x in docs), LANES, STEPS):
        state[0] = train_window(m, v, state[0], ids, memory, real)
        used += int(real.sum())
    return used


def _trainer(shared):
    schema = pa.schema([("piece", pa.int32()), ("part", pa.int32()), ("w", pa.binary()), ("tokens", pa.int64())])

    def run(batches):
        v, m = shared.value
        m = {k: w.copy() for k, w in m.items()}
        memory = {k: np.full_like(w, 1e-4) for k, w in m.items()}
        texts = (text for batch in batches for text in batch.column(0).cast(pa.binary()).to_pylist())
        seen = learn(m, v, (v.model_ids(at) for _, at in v.places(texts)), memory)
        if seen:
            from pyspark import TaskContext

            flat = np.concatenate([w.reshape(-1) for w in m.values()])
            pieces = range(0, len(flat), PIECE)
            part = TaskContext.get().partitionId() % 64
            yield pa.RecordBatch.from_arrays([pa.array([k // PIECE for k in pieces], pa.int32()), pa.array([part] * len(pieces), pa.int32()), pa.array([flat[k : k + PIECE].tobytes() for k in pieces], pa.binary()), pa.array([seen] * len(pieces), pa.int64())], schema=schema)

    return run


def _mean(pdf: pd.DataFrame) -> pd.DataFrame:
    total = int(pdf["tokens"].sum())
    w = sum(np.frombuffer(x, np.float32).astype(np.float64) * t for x, t in zip(pdf["w"], pdf["tokens"], strict=True)) / total
    return pd.DataFrame({"piece": [pdf["piece"].iloc[0]], "part": [pdf["part"].iloc[0]], "w": [w.astype(np.float32).tobytes()], "tokens": [total]})


def train(texts: DataFrame, v: Vocabulary, rounds: int = ROUNDS) -> dict[str, np.ndarray]:
    """The model of one pass over all training texts (column 0), dealt into ``rounds`` parts with an average after each."""
    sc = texts.sparkSession.sparkContext
    m = start(v)
    shape = "piece int, part int, w binary, tokens long"
    part = F.pmod(F.xxhash64(F.col(texts.columns[0]), F.lit(5)), F.lit(rounds))
    for r in range(rounds):
        local = texts.where(part == r).mapInArrow(_trainer(sc.broadcast((v, m))), shape)
        some = local.groupBy("piece", "part").applyInPandas(_mean, shape).withColumn("part", F.lit(0))
        rows = sorted(some.groupBy("piece", "part").applyInPandas(_mean, shape).select("piece", "w").collect())  # one model
        if rows:
            flat, at = np.frombuffer(b"".join(bytes(r[1]) for r in rows), np.float32), 0
            for k, w in m.items():
                m[k] = flat[at : at + w.size].reshape(w.shape).copy()
                at += w.size
    return m


SCORED = [("known", pa.int64()), ("base", pa.float64()), ("model", pa.float64()), ("words", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))]


def _scorer(shared):
    """Rows (rid, doc_id, held_out, text) to rows with counts, sums over the head, the model's sum, and the words off the head."""

    def run(batches):
        v, m = shared.value
        logs = np.log10((v.counts + 1) / max(v.whole, 1))
        off = np.log10((v.counts + 1) / max(v.rest, 1e-9))
        none = len(v.counts) - 1
        kept: dict = {}
        kind = None

        def docs():
            nonlocal kind
            for batch in batches:
                kind = batch.column(1).type
                rids, ids, held = (batch.column(k).to_pylist() for k in range(3))
                for rid, i, out, (h, at) in zip(rids, ids, held, v.places(batch.column(3).cast(pa.binary()).to_pylist()), strict=True):
                    head = at[at != none]
                    words, times = np.unique(h[at == none].view(np.int64), return_counts=True)
                    kept[rid] = (i, out, len(at), len(head), float(logs[head].sum()), float(off[head[head >= v.size]].sum()), words, times)
                    yield rid, v.model_ids(at)

        def rows(done: list[tuple]) -> pa.RecordBatch:
            schema = pa.schema([("rid", pa.int64()), ("doc_id", kind), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), *SCORED])
            full = [(rid, *(k := kept.pop(rid))[:5], k[5] + s / math.log(10), *k[6:]) for rid, s in done]
            return pa.RecordBatch.from_arrays([pa.array([r[j] for r in full], f.type) for j, f in enumerate(schema)], schema=schema)

        done = []
        for got in score_stream(m, v, docs()):
            done.append(got)
            if len(done) == 512:
                yield rows(done)
                done = []
        if done:
            yield rows(done)

    return run


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = LIST, head: int = HEAD) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each row of ``docs``."""
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == FOLD, F.lit(False))
    seen = docs.where(~out).select(text_col)
    counts = cut(seen.mapInArrow(_counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    # The words above a level of counts such that they are ``head`` at most; a top-k would send so many rows from each task.
    level, least, held = F.floor(F.log2("n") * 64), 1 << 20, 0
    for r in sorted(counts.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):  # a few thousand levels at most
        if (held := held + r["words"]) > head:
            break
        least = r["level"]
    top = sorted(((r[0], r[1]) for r in counts.where(level >= least).select("word", "n").collect()), key=lambda x: (-x[1], x[0]))
    v = Vocabulary(top, total, distinct, size)
    shared = spark.sparkContext.broadcast((v, train(seen, v)))
    named = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("doc_id"), out.alias("held_out"), F.col(text_col).alias("text"))
    kind = named.schema["doc_id"].dataType.simpleString()
    done = cut(named.mapInArrow(_scorer(shared), f"rid long, doc_id {kind}, held_out boolean, n_tokens long, known long, base double, model double, words array<long>, times array<long>"), "scored")
    tail = done.select("rid", F.explode(F.arrays_zip("words", "times")).alias("t")).select("rid", F.col("t.words").alias("word"), F.col("t.times").alias("m"))
    c = F.coalesce("n", F.lit(0))
    rest = tail.join(counts, "word", "left").groupBy("rid").agg(
        F.sum(F.when(c > 0, F.col("m")).otherwise(0)).alias("known_tail"), F.sum(F.col("m") * F.log10((c + 1) / F.lit(float(v.whole)))).alias("base_tail"), F.sum(F.col("m") * F.log10((c + 1) / F.lit(float(max(v.rest, 1.0))))).alias("model_tail")
    )
    zero = lambda x: F.coalesce(F.col(x), F.lit(0))
    return done.join(rest, "rid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + zero("known_tail")).cast("long").alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + zero("base_tail")).alias("base_score"), (F.col("model") + zero("model_tail")).alias("score"),
    )


def query(docs: DataFrame) -> DataFrame:
    return score_documents(docs.select("doc_id", "text"))
