import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.llm import components, decontamination, exact_dedup, hashing, line_dedup, lm_score, ngram_join, quality, registry, secrets, sentencepiece_bpe, sharding, substring_dedup

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string"


@pytest.fixture
def make(spark):
    """A documents table from (doc_id, text) rows, with a column whose name could clash."""
    return lambda rows: spark.createDataFrame([(i, t, None, None, None, "x") for i, t in rows], SCHEMA).coalesce(2)


WORDS = [f"w{k}" for k in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_matches_sql(spark, same, name):
    same(registry.QUERIES[name](spark, SF), registry.SQL[name])


EDGE = [(1, None), (2, ""), (None, "x"), (3, "a b"), (4, "a b"), (4, "a b"), (5, " \n\t"), (6, "é" * 30 + "\n" + "é" * 30), (7, "é" * 30), (8, "É" * 30 + "\n"), (None, "é" * 30)]
RUNS = {
    "lines": line_dedup.query, "ngram": ngram_join.query, "sentencepiece": sentencepiece_bpe.query, "sharding": sharding.query, "lm": lm_score.query, "secrets": secrets.query, "substring": substring_dedup.query,
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_edge_rows_and_empty_tables(spark, make, name):
    got = RUNS[name](make(EDGE)).collect()
    if name not in ("secrets", "substring"):
        assert len(got) == len(EDGE)
    assert RUNS[name](make([])).count() == 0


def test_exact_dedup_collisions_and_edges(spark, make, tmp_path):
    make(EDGE).write.parquet(str(tmp_path / "documents.parquet"))
    got = exact_dedup.query(spark, str(tmp_path)).collect()
    assert len(got) == len(EDGE) and sum(r.kept for r in got) == len({t or "" for _, t in EDGE})
    same_digest = exact_dedup.stream_dedup(spark, str(tmp_path / "documents.parquet"), digest=lambda t: F.substring(F.sha2(t.cast("binary"), 256), 1, 0), block=2).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in same_digest) == sorted((r.doc_id if r.doc_id is not None else -(2**63), r.keep_id if r.keep_id is not None else -(2**63), r.group_size) for r in got)
    make([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert exact_dedup.query(spark, str(tmp_path / "none")).count() == 0


def test_exact_dedup_state_goes_on(spark, make, tmp_path):
    path, ck = str(tmp_path / "d.parquet"), str(tmp_path / "ck")
    make([(1, "a"), (2, "b")]).write.parquet(path)
    exact_dedup.build_state(spark, path, checkpoint=ck).count()
    make([(9, "a")]).write.mode("append").parquet(path)
    state = {(r.id, r.n) for r in exact_dedup.build_state(spark, path, checkpoint=ck).collect()}
    assert state == {(9, 2), (2, 1)}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 64, 1000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    h = rng.integers(-(2**63), 2**63 - 1, (2, n))
    assert sorted(line_dedup.place(h[0], h[1])[2]) == list(range(n))


def test_lines(make):
    long, other = "A line that is long enough", "Another line of the same sort"
    rows = [(k, f"{long} \n{k}\n{other if k < 2 else ''}") for k in range(4)]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(make(rows)).collect()}
    assert [got[k]["__tl_n_dropped"] for k in range(4)] == [1, 1, 1, 0]
    assert got[0]["__tl_kept"] == f"0\n{other}" and got[3]["__tl_kept"] == f"{long} \n3\n"


def _brute_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    comp = {i: i for i in sets}
    for a, b in itertools.combinations(sets, 2):
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            x, y = comp[a], comp[b]
            comp = {k: min(x, y) if v in (x, y) else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i]) for i in sets}


def test_ngram_join_against_brute_force(make):
    rng = random.Random(5)
    common = prose(rng, 30)
    rows = []
    for base in range(12):
        text = prose(rng, rng.choice([3, 8, 40, 90])).split()
        for _ in range(rng.choice([1, 4, 12])):
            t = [rng.choice(WORDS) if rng.random() < 0.02 else w for w in text]
            rows.append((len(rows) * 7 % 1009, " ".join(t) + (" " + common if base % 3 == 0 else "")))
    rows = list({i: (i, t) for i, t in rows}.values())
    for rounds in (0, 1, 3):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_components(make(rows), rounds=rounds).collect()}
        assert got == _brute_components(rows)


def test_components(spark):
    e = [(k, k + 1) for k in range(20)] + [(100, 101), (101, 100), (7, 7)]
    got = {r.node: r.label for r in components.connected_components(spark.createDataFrame(e, "a long, b long"), "a", "b").collect()}
    assert got == {**{k: 0 for k in range(21)}, 100: 100, 101: 100}


def test_decontamination(spark, make):
    rng = random.Random(1)
    item = prose(rng, 30)
    cut = " ".join(item.split()[:-3])
    rows = [(1, prose(rng, 3000) + " " + item.upper() + " " + prose(rng, 3000)), (2, cut), (3, prose(rng, 500)), (4, " ".join(item.split()[:15])), (5, None), (None, item)]
    items = spark.createDataFrame([(1, item), (2, "too few words"), (3, None)], "item_id long, text string")
    got = {r.doc: r.n_shared for r in decontamination.contained_items(make(rows), items).collect()}
    assert got == {1: 26, 2: 23, None: 26}
    assert sorted(r.doc_id for r in decontamination.clean(make(rows), items).collect()) == [3, 4, 5]
    assert decontamination.contained_items(make([]), items).count() == 0
    assert decontamination.contained_items(make(rows), items.where("false")).count() == 0


def test_quality(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.query(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.9 * len(got)
    none = quality.query(docs, labels.where("false")).select("score").distinct().collect()
    assert [r.score for r in none] == [0.5]
    assert not quality.features("").any() and not quality.features(None).any()
    assert quality.query(docs.where("false"), labels).count() == 0


def test_sentencepiece_equals_library():
    sp = pytest.importorskip("sentencepiece")
    t, lib = sentencepiece_bpe.tokenizer(sentencepiece_bpe.default_model()), sp.SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    rng = random.Random(2)
    parts = [*"abcdeé  ▁\n\t<s>,.!?漢字ß😀", "   ", "the", "ation", "\r\n", "</s>", "İ", "n't", "http://"]
    for k in range(4000):
        x = "".join(rng.choices(parts, k=k % 15))
        ids = lib.encode(x)
        n, joined, back = t.encode_decode(x)
        assert (n, joined.decode(), back) == (len(ids), ",".join(map(str, ids)), lib.decode(ids)) and t.encode(x) == ids
        odd = [rng.randrange(32000) if rng.random() < 0.4 else rng.randrange(262) for _ in range(k % 9)]
        assert t.decode(odd) == lib.decode(odd)


def test_sentencepiece_long_runs_of_spaces():
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    t = sentencepiece_bpe.Tokenizer(sentencepiece_bpe.default_model())
    for x in (" " * 100_000, "a" + " " * 33_333 + "the end" + " " * 7 + "\n" + " " * 50, "é☃" * 3000 + "z" * 5000):
        ids = lib.encode(x)
        assert t.encode_decode(x) == (len(ids), ",".join(map(str, ids)).encode(), lib.decode(ids))
    assert max(map(len, t.words)) <= sentencepiece_bpe.LONGEST


def test_sentencepiece_forgets_odd_words(monkeypatch):
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    t = sentencepiece_bpe.Tokenizer(sentencepiece_bpe.default_model())
    monkeypatch.setattr(sentencepiece_bpe, "ODD", 20)
    for k in range(200):
        x = f"a{k}▁b word ▁▁{k} " * 3
        ids = lib.encode(x)
        assert t.encode_decode(x) == (len(ids), ",".join(map(str, ids)).encode(), lib.decode(ids)) and t.odd_size < 80


def test_sharding_law_and_least_bytes(spark, make):
    rng = random.Random(4)
    rows = [(k, "x" * rng.randrange(60)) for k in range(301)]
    got = sharding.query(make(rows)).collect()
    counts = Counter(r.shard for r in got)
    assert len(counts) == 16 and max(counts.values()) - min(counts.values()) <= 1
    assert all(sorted(r.slot for r in got if r.shard == s) == list(range(counts[s])) for s in counts)
    assert all(r.size == len(dict(rows)[r.doc_id]) + 1 and r.text_crc32 == zlib.crc32(dict(rows)[r.doc_id].encode()) for r in got)
    for seed in range(30):  # least cost against trying every choice of rows that leave
        r = random.Random(seed)
        blocks = [(k % 2, k, r.randrange(1, 4), r.randrange(1, 50)) for k in range(4)]
        caps = sharding.capacities(sum(b[2] for b in blocks), 3)
        plan = sharding.plan_transfers(blocks, caps)
        cost = sum(n * next(b[3] / b[2] for b in blocks if b[1] == k) for o, k, s, n in plan if s != o)
        best = min(sum(x * b[3] / b[2] for x, b in zip(leave, blocks, strict=True)) for leave in itertools.product(*[range(b[2] + 1) for b in blocks]) if all(sum(b[2] - x for x, b in zip(leave, blocks, strict=True) if b[0] == s) <= caps[s] for s in (0, 1)))
        assert cost == pytest.approx(best)
        assert [sum(n for _, _, s, n in plan if s == j) for j in range(3)] == caps


def test_shard_rewrite(spark, make, tmp_path):
    root = str(tmp_path / "shards")
    make([(k, "t" * k) for k in range(40)]).withColumn("shard", F.lit(0)).write.partitionBy("shard").parquet(root)
    done = sharding.rewrite(spark, root, 4)
    assert done["moved"] == 30 and sorted(r["count"] for r in spark.read.parquet(root).groupBy("shard").count().collect()) == [10] * 4
    assert spark.read.parquet(root).select("doc_id").distinct().count() == 40


def test_shard_rewrite_of_an_empty_folder(spark, make, tmp_path):
    root = str(tmp_path / "shards")
    make([]).withColumn("shard", F.lit(0)).write.parquet(root)
    assert sharding.rewrite(spark, root, 3) == {"affected": [], "moved": 0}


@pytest.mark.parametrize(("old", "new"), [(12, 8), (3, 5)])
def test_shard_rewrite_keeps_all_rows(spark, make, tmp_path, old, new):
    root = str(tmp_path / "shards")
    rows = [(k if k % 3 else None, "t" * (k % 17)) for k in range(90)]
    make(rows).withColumn("shard", (F.length("text") % old).cast("int")).write.partitionBy("shard").parquet(root)
    sharding.rewrite(spark, root, new)
    got = spark.read.parquet(root).select("doc_id", "text", "shard").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    counts = Counter(r.shard for r in got)
    assert len(counts) == new and max(counts.values()) - min(counts.values()) <= 1


def test_shard_rewrite_survives_a_fault_at_each_step(spark, make, tmp_path):
    """Whatever step fails, the rows are the old or the new ones, each once, and the rewrite can run again."""
    from tickloom.sources import publish

    rng = random.Random(2)
    docs = make([(k, "x" * rng.randrange(50)) for k in range(40)])
    docs.withColumn("shard", F.pmod("doc_id", F.lit(5))).write.partitionBy("shard").parquet(str(tmp_path / "old"))

    class Crash(RuntimeError):
        pass

    at = 0
    while True:
        at += 1
        root, seen = str(tmp_path / f"tree{at}"), []
        spark.read.parquet(str(tmp_path / "old")).write.partitionBy("shard").parquet(root)

        def step(name, seen=seen, at=at):
            seen.append(name)
            if len(seen) == at:
                raise Crash(name)

        try:
            sharding.rewrite(spark, root, 3, step=step)
        except Crash:
            assert sorted(r.doc_id for r in publish.read_tree(spark, root).collect()) == list(range(40)), seen[-1]
            sharding.rewrite(spark, root, 3)
            done = False
        else:
            done = True
        rows = spark.read.parquet(root).collect()
        assert sorted(r.doc_id for r in rows) == list(range(40)) and {r.shard for r in rows} == {0, 1, 2}
        if done or at > 20:
            break
    assert at > 6


def test_shard_rewrite_shrinks(spark, make, tmp_path):
    root = str(tmp_path / "shards")
    make([(k, "t" * k) for k in range(40)]).withColumn("shard", (F.col("doc_id") % 4).cast("int")).write.partitionBy("shard").parquet(root)
    sharding.rewrite(spark, root, 2)
    got = spark.read.parquet(root).select("doc_id", "shard").collect()
    assert sorted(r.doc_id for r in got) == list(range(40)) and Counter(r.shard for r in got) == {0: 20, 1: 20}


def test_language_model(make):
    rows = [(k, "the cat sat on the mat " * (k % 5)) for k in range(60)]
    got = {r.doc_id: r for r in lm_score.query(make(rows)).collect()}
    c = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            c.update(lm_score.tokens(t.encode()))
    n, v = sum(c.values()), len(c)
    for i, t in rows:
        w = lm_score.tokens(t.encode())
        assert got[i].base_score == pytest.approx(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) and got[i].n_tokens == len(w)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_language_model_learns_from_all_tokens(make):
    rng = random.Random(7)
    body = lambda: [f"w{rng.randrange(20)}" for _ in range(400)]
    texts = [" ".join(["first", *body(), "middle", *body(), "late", "w1"]) for _ in range(80)] + ["tiny w1"] * 80
    c = Counter(w for t in texts for w in lm_score.tokens(t.encode()))
    v = lm_score.Vocabulary(sorted(c.items(), key=lambda x: (-x[1], x[0])), sum(c.values()), len(c))
    got, began = lm_score.train(make([(k, t) for k, t in enumerate(texts)]).select("text"), v), lm_score.start(v)
    for w in (b"first", b"middle", b"late", b"tiny"):
        assert (got["embed"][v.index[w]] != began["embed"][v.index[w]]).any()
    ids = [v.model_ids(np.array([v.index[w] for w in lm_score.tokens(t.encode())])) for t in texts]
    assert lm_score.learn(began, v, ids, {k: np.full_like(w, 1e-4) for k, w in began.items()}) == sum(c.values())


def test_language_model_sums_to_one_and_gradient():
    v = lm_score.Vocabulary([(f"w{k}".encode(), 100 - k) for k in range(40)], 4000, 60, size=20, classes=4)
    m = {k: x.astype(np.float64) + np.random.default_rng(1).standard_normal(x.shape) * 0.3 for k, x in lm_score.start(v).items()}
    h = np.random.default_rng(2).standard_normal((1, lm_score.STATE))
    logs = [lm_score._output(m, v, h, np.array([k]))[0][0] for k in range(v.size + 1)]
    assert sum(math.exp(x) for x in logs) == pytest.approx(1)
    ids = np.random.default_rng(3).integers(0, 21, (5, 3))
    h0 = np.zeros((3, lm_score.STATE))

    def loss(w):
        return -lm_score.score_lanes(w, v, [ids[:, j] for j in range(3)]).sum() / ids.size

    before = {k: x.copy() for k, x in m.items()}
    memory = {k: np.zeros_like(x) for k, x in m.items()}
    work = {k: x.copy() for k, x in m.items()}
    lm_score.train_window(work, v, h0, ids, memory)
    for k in ("wh", "wx", "wc", "wo", "embed", "b"):
        at = np.unravel_index(np.abs(memory[k]).argmax(), memory[k].shape)
        grad = math.copysign(math.sqrt(memory[k][at]), before[k][at] - work[k][at])
        up, down = ({n: x.copy() for n, x in before.items()} for _ in range(2))
        up[k][at] += 1e-3
        down[k][at] -= 1e-3
        exact = (loss(up) - loss(down)) / 2e-3
        scale = math.sqrt(sum(float(x.sum()) for x in memory.values()))
        assert grad / scale == pytest.approx(exact / scale, abs=0.02) if scale < 0.999 else math.copysign(1, grad) == math.copysign(1, exact)
    one = lm_score.score_lanes(m, v, [ids[:, 0]], steps=2)
    assert one == pytest.approx(lm_score.score_lanes(m, v, [ids[:, 0]], steps=64), rel=1e-5)


def test_long_texts_left_alone_are_scored_in_few_windows(monkeypatch):
    v = lm_score.Vocabulary([(f"w{k}".encode(), 100 - k) for k in range(40)], 4000, 60, size=20, classes=4)
    m, rng = lm_score.start(v), np.random.default_rng(6)
    docs = [rng.integers(0, 21, n) for n in (20_000, 3, 1, 700, 33, 9_000)]
    want = {k: x for k, x in lm_score.score_stream(m, v, enumerate(docs), lanes=1)}  # one lane is a full one
    calls, output = [], lm_score._output
    monkeypatch.setattr(lm_score, "_output", lambda *a: (calls.append(len(a[3])), output(*a))[1])
    got = dict(lm_score.score_stream(m, v, enumerate(docs)))
    assert got == pytest.approx(want, rel=1e-5) and sum(calls) == sum(map(len, docs))
    assert len(calls) < 20 and max(calls) <= 512 * 16  # not one for each 16 tokens of the longest


def test_secrets(spark, make):
    f = secrets.labelled_findings(spark)
    part = F.pmod(F.xxhash64("found"), F.lit(5)) == 0
    model = secrets.train(f.where(~part))
    from pyspark.ml.feature import VectorAssembler

    got = model.transform(VectorAssembler(inputCols=secrets.NAMES, outputCol="features").transform(secrets.features(f.where(part)))).select("label", "prediction").collect()
    assert sum(r.label == r.prediction for r in got) >= 0.95 * len(got)
    key = hashlib.sha1(b"k").hexdigest()
    rows = [(1, f'abc token = "{key}" de'), (2, f"commit {key} by x"), (3, 'secret = "your_api_key_1234567890"'), (4, None), (5, "no candidate here")]
    found = {r.doc: r.p >= 0.5 for r in secrets.scan(make(rows), model).collect()}
    assert found == {1: True, 2: False, 3: False}


def test_secret_candidates_with_blanks_quotes_and_without_digits(make):
    long, letters = "p!" + "x9" * 60, "abcdefghijKLMNOPqrstuvwx"
    held = ["password=hunter2!x", "password: hunter2!x", 'password = "hunter2!x"', 'password="hunter2!x"', "'PassWord': 'hunter2!x'", "PWD=hunter2!x", f"passwd = {long}", f'api_key = "{letters}"', f"token: {letters}", "x" * 80 + "7"]
    want = ["hunter2!x"] * 6 + [long, letters, letters, "x" * 80 + "7"]
    rows = [(k, f"some text {t} after") for k, t in enumerate([*held, letters, "password hint"])]
    got = {r.doc: (r.found, r.start) for r in secrets.candidates(make(rows)).collect()}
    assert got == {k: (w, rows[k][1].index(w)) for k, w in enumerate(want)}


def test_secrets_of_a_text_of_many_candidates(make):
    key = lambda k: hashlib.sha1(str(k).encode()).hexdigest()[: 16 + k % 20]
    text = "".join(f'{"é" * (k % 5)} token{k} = "{key(k)}" ' for k in range(20_000))
    got = secrets.candidates(make([(1, text), (2, None), (3, "")])).orderBy("k").collect()
    want = [(m.group(), m.start()) for m in re.finditer(r"(?<![0-9A-Za-z+/_-])[0-9a-f]{16,}", text)]
    assert [(r.found, r.start) for r in got] == want and [r.k for r in got] == list(range(len(want))) and len(want) == 20_000
    assert all(text[: r.start].endswith(r.before) and text[r.start + len(r.found) :].startswith(r.after) for r in got[::97])


def test_passages(make):
    rng = random.Random(9)
    passage = prose(rng, 70).split()
    fuzzy = [w if k % 17 else "other" for k, w in enumerate(passage)]
    rows = [(1, prose(rng, 200) + " " + " ".join(passage) + " " + prose(rng, 90)), (2, prose(rng, 30) + " " + " ".join(fuzzy)), (3, prose(rng, 300)), (4, " ".join(passage[:30])), (5, prose(rng, 60)), (6, None)]
    rows += [(7, rows[4][1])]
    got = {(r.doc, r.start): r for r in substring_dedup.repeated_passages(make(rows)).collect()}
    assert {d for d, _ in got} == {1, 2, 5, 7}
    one = next(r for r in got.values() if r.doc == 1)
    assert one.other == 2 and one.start <= 202 and one.end >= 268 and one.end - one.start <= 80


def test_equal_runs_with_decoy_leaders_against_brute_force(make):
    rng = random.Random(21)
    passages = [prose(rng, n).split() for n in (50, 51, 60, 75, 90, 120)]
    texts = []
    for p in passages:
        near = [p, p, p if len(p) < 60 else p[:55]]
        texts += [prose(rng, rng.randrange(40)).split() + x + prose(rng, rng.randrange(40)).split() for x in near]
        texts += [prose(rng, 9).split() + p[k : k + 20] + prose(rng, 9).split() for k in range(0, len(p) - 19, 5) for _ in range(4)]
        texts += [prose(rng, 9).split() + p[k : k + 49] + prose(rng, 9).split() for k in (0, 1, len(p) - 49) for _ in range(4)]
    texts.append(passages[3] + prose(rng, 80).split() + passages[3] + passages[4] + prose(rng, 5).split() + passages[4])
    rng.shuffle(texts)
    held = {}
    for i, w in enumerate(texts):
        for k in range(len(w) - 49):
            held.setdefault(tuple(w[k : k + 50]), set()).add(i)
    got = {}
    for r in substring_dedup.repeated_passages(make([(i, " ".join(w)) for i, w in enumerate(texts)])).collect():
        got.setdefault(r.doc, []).append(r)
        assert r.doc != r.other and r.same >= 0.8 * (r.end - r.start) and r.end - r.start >= 50
    missed = [(i, k) for i, w in enumerate(texts) for k in range(len(w) - 49) if len(held[tuple(w[k : k + 50])]) > 1 and not any(r.start <= k and k + 50 <= r.end for r in got.get(i, []))]
    assert not missed


def _pair_has_passage(a, b):
    """Whether the chainer finds a passage between two arrays of word hashes, each against the other."""
    s = substring_dedup
    (ha, pa_), (hb, pb) = s.seeds(a), s.seeds(b)
    first = {}
    for h, p in zip(hb.tolist(), pb.tolist(), strict=True):
        first.setdefault(h, p)
    m = [(p, first[h]) for h, p in zip(ha.tolist(), pa_.tolist(), strict=True) if h in first]
    if len(m) < 2:
        return False
    px, py = np.array([x for x, _ in m]), np.array([y for _, y in m])
    for line in s.chain(px, py):
        for ends in (True, False):
            x0, x1, y0, y1, same = s.align(a, b, [int(px[i]) for i in line], [int(py[i]) for i in line], ends=ends)
            if len(line) >= 2 and min(x1 - x0, y1 - y0) >= 50 and same >= 0.8 * max(x1 - x0, y1 - y0):
                return True
    return False


@pytest.mark.parametrize("identity", [0.95, 0.9])
def test_fuzzy_passages_among_strays_against_all_pairs(make, identity):
    """Texts that hold short pieces of the same passages hide no link that an all-pairs run of the same chainer finds."""
    rng = random.Random(int(100 * identity))
    texts, stray = [], []
    for _ in range(8):
        p = [f"p{rng.randrange(10**6)}" for _ in range(120)]
        changed = lambda p=p: [w if rng.random() < identity else f"c{rng.randrange(10**6)}" for w in p]
        texts += [prose(rng, 40).split() + changed() + prose(rng, 40).split() for _ in range(2)]
        stray += [prose(rng, 12).split() + p[k : k + 14] + prose(rng, 12).split() for k in range(0, 107, 3) for _ in range(2)]
    hashes = list(hashing.of_each(" ".join(t).encode() for t in texts))
    want = {i for i in range(0, len(texts), 2) if _pair_has_passage(hashes[i], hashes[i + 1]) or _pair_has_passage(hashes[i + 1], hashes[i])}
    want |= {i + 1 for i in want}
    rows = list(enumerate(" ".join(t) for t in texts + stray))
    got = {r.doc for r in substring_dedup.repeated_passages(make(rows)).collect()}
    assert got <= set(range(len(texts))) and len(got & want) >= 0.9 * len(want) and len(want) >= 10


def test_passages_among_many_holders_of_the_same_seed_pairs(make):
    """Texts whose every pair of seeds is held by many others too: no bound on partners hides the two that share a passage."""
    rng = random.Random(17)
    texts, stray = [], []
    for _ in range(6):
        p = [f"p{rng.randrange(10**6)}" for _ in range(61)]
        texts += [prose(rng, 20).split() + p[:30] + [f"c{rng.randrange(10**6)}"] + p[31:] + prose(rng, 20).split() for _ in range(2)]
        stray += [prose(rng, 12).split() + half + prose(rng, 12).split() for half in (p[:30], p[31:]) for _ in range(30)]
    got = {r.doc for r in substring_dedup.repeated_passages(make(list(enumerate(" ".join(t) for t in texts + stray)))).collect()}
    assert got == set(range(len(texts)))


def test_long_alignments_only_where_a_passage_can_be(monkeypatch):
    """Chains too short for a passage, with their ends, aren't compared word by word; a link of two matches is as in a chain."""
    s, calls = substring_dedup, []
    whole = s._edit
    monkeypatch.setattr(s, "_edit", lambda a, b: calls.append(1) or whole(a, b))
    a = list(range(100, 220))
    stray, near = [*range(1000, 1050), *a[50:56], *range(2000, 2011), *a[66:72], *range(3000, 3050)], [*a[:58], 7, 8, *a[59:]]
    batch = [pa.array([1, 1]), pa.array([2, 3]), pa.array([[50, 66], [50, 66]], pa.list_(pa.int32())), pa.array([[50, 67], [50, 67]], pa.list_(pa.int32())), pa.array([0, 0]), pa.array([a, a]), pa.array([0, 0]), pa.array([stray, near])]
    got = [r for b in s._align_rows(s.K, 50, 0.8)([pa.RecordBatch.from_arrays(batch, names=list("abcdefgh"))]) for r in b.to_pylist()]
    assert [r["lead"] for r in got] == [3] and len(calls) == 1
    rng = random.Random(5)
    for _ in range(500):
        px, py = sorted(rng.randrange(60) for _ in range(2)), [rng.randrange(60) for _ in range(2)]
        if px[0] < px[1]:
            assert s._linked(px[1] - px[0], py[1] - py[0], 6) == any(len(x) == 2 for x in s.chain(np.array(px), np.array(py), 6))


def test_chain_against_brute_force():
    rng = random.Random(6)
    for _ in range(40):
        n = rng.randrange(1, 9)
        p = sorted({(rng.randrange(30), rng.randrange(30)) for _ in range(n)})
        px, py = np.array([a for a, _ in p]), np.array([b for _, b in p])
        lines = substring_dedup.chain(px, py, 3)
        assert sorted(i for x in lines for i in x) == list(range(len(p)))
        assert all(px[a] < px[b] and py[a] < py[b] for x in lines for a, b in itertools.pairwise(x))


def test_chain_scores_against_quadratic_version():
    rng, s = random.Random(8), substring_dedup
    for n in range(120):
        k, wide = rng.choice([3, 6]), rng.choice([20, 80, 300])
        p = sorted({(rng.randrange(wide), rng.randrange(wide)) for _ in range(n)} | {(x, x + 5) for x in range(0, 90, 4)} | {(x, x - 3) for x in range(150, 250, 4)})
        link = lambda a, b, k=k: s.GAIN * min(k, b[0] - a[0], b[1] - a[1]) - s.GAP * (b[0] - a[0] + b[1] - a[1])
        best = []
        for i, b in enumerate(p):
            near = [best[j] + link(a, b) for j, a in enumerate(p[:i]) if 0 < b[0] - a[0] <= s.MAX_GAP + k and 0 < b[1] - a[1] <= s.MAX_GAP + k]
            best.append(max([s.GAIN * k, *near]))
        line = [p[i] for i in s.chain(np.array([a for a, _ in p]), np.array([b for _, b in p]), k)[0]]
        assert s.GAIN * k + sum(link(a, b) for a, b in itertools.pairwise(line)) == pytest.approx(max(best))


@pytest.mark.parametrize(("first", "gap", "second"), [(200, 60, 80), (300, 100, 100), (1000, 100, 500)])
def test_chain_of_a_second_passage_after_a_long_one(first, gap, second):
    rng = random.Random(first)
    words = lambda n: [rng.randrange(1, 2**62) for _ in range(n)]
    a, b = words(first), words(second)
    found = [substring_dedup.seeds(np.array(a + words(gap) + b, dtype=np.uint64)) for _ in range(2)]
    at = {int(h): int(p) for h, p in zip(*found[1], strict=True)}
    m = [(int(p), at[int(h)]) for h, p in zip(*found[0], strict=True) if int(h) in at]
    px, py = np.array([x for x, _ in m]), np.array([y for _, y in m])
    lines = [x for x in substring_dedup.chain(px, py) if len(x) >= 2]
    assert any(px[x[0]] >= first + gap and px[x[-1]] - px[x[0]] >= second - 30 for x in lines)
    assert any(px[x[-1]] < first and px[x[-1]] - px[x[0]] >= first - 30 for x in lines)


def test_texts_of_null_identifiers_join_others(make):
    rng = random.Random(12)
    base = prose(rng, 200).split()
    changed = lambda *at: " ".join("new" if k in at else w for k, w in enumerate(base))
    rows = [(1, changed(5, 15, 25)), (None, changed()), (3, changed(105, 115, 125)), (None, prose(rng, 30)), (None, None)]
    sets = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (t.split() for _, t in rows[:3])]
    close = [100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]) for a, b in ((0, 1), (1, 2), (0, 2))]
    assert close == [True, True, False]  # 1 and 3 meet through the null row alone
    got = ngram_join.similarity_components(make(rows)).collect()
    assert {r.component_id for r in got if r.n_shingles > 30} == {1}
    passage = prose(rng, 70)
    rows = [(1, prose(rng, 60) + " " + passage), (None, passage + " " + prose(rng, 60)), (None, prose(rng, 90))]
    found = substring_dedup.repeated_passages(make(rows)).collect()
    assert sorted((str(r.doc), r.other, r.end - r.start >= 70) for r in found) == [("1", None, True), ("None", 1, True)]


def test_pipeline(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs, columns = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        columns = columns or docs.columns
        docs = stage(spark, docs, SF)
        docs.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name != "tokens":
            assert docs.columns == columns
    texts = {r.doc_id: r.text for r in spark.read.parquet(str(tmp_path / "leaks")).collect()}
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    assert {r.doc_id: r.n_tokens for r in docs.collect()} == {i: len(lib.encode(t)) for i, t in texts.items()}
    assert len(texts) > 100
