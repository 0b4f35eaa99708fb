"""Each stage of the pipeline against a brute-force version, over nulls, empties, repeats, ties and a clashing column."""

import itertools
import random
import re

import numpy as np
import pytest

from tickloom.llm import quality, sentencepiece_bpe

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, word string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def grams(text, short=True):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w and short else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def rated(rows, model):
    """Rows whose score reaches one half, from the model's weights."""
    z = lambda t: np.clip((quality.features(t) - model["centre"]) / model["scale"], -8, 8)
    return [r for r in rows if 1 / (1 + np.exp(-np.clip(z(r[1]) @ model["w"] - model["at"], -40, 40))) >= 0.5]


def without_lines(rows):
    key = lambda line: re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for n, r in enumerate(rows):
        for x in {key(x) for x in (r[1] or "").split("\n")}:
            held.setdefault(x, []).append(n)
    last = {x: max((rows[n][0] is not None, rows[n][0] or 0) for n in ns) for x, ns in held.items() if len(x) >= 20 and len(ns) >= 3}
    kept = lambda r: "\n".join(x for x in (r[1] or "").split("\n") if key(x) not in last or last[key(x)] == (r[0] is not None, r[0] or 0))
    return [(r[0], kept(r)) for r in rows]


def one_of_each(rows):
    comp = list(range(len(rows)))
    sets = [grams(t) for _, t in rows]
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and comp[a] != comp[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            comp = [comp[a] if c == comp[b] else c for c in comp]
    least = {}
    for c, (i, _) in zip(comp, rows, strict=True):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    gone = {i for c, (i, _) in zip(comp, rows, strict=True) if i is not None and least[c] != i}
    return [r for r in rows if r[0] not in gone]


def unleaked(rows, items):
    bad = {i for i, t in rows for q in items if (g := grams(q, False)) and 100 * len(g & grams(t, False)) >= 80 * len(g)}
    return [r for r in rows if r[0] not in bad]


def table(rng):
    vocabulary = [f"{rng.choice('abcdefgh')}{k}" for k in range(300)]
    prose = lambda n: " ".join(rng.choices(vocabulary, k=n)).capitalize() + "."
    item, line = prose(20), "A line that many documents have in common"
    rows = [(None, None), (1, ""), (2, " \n\n"), (3, "one"), (4, "ONE"), (None, "one"), (5, prose(9000))]
    rows += [(10 + k, f"{prose(40)}\n{line}  \n{prose(12)}") for k in range(6)]
    rows += [(30, prose(30) + " " + item.upper() + " " + prose(30)), (31, item)]
    for base in range(8):
        text = prose(50).split()
        rows += [(100 + 10 * base + k, " ".join(rng.choice(vocabulary) if rng.random() < 0.02 else w for w in text)) for k in range(4)]
    rows += [(100, rows[-1][1]), (None, rows[-1][1]), (7, "!!! $$$ ### @@@ " * 40), (8, "spam spam spam " * 90)]
    return rows, [item, "too short", None]


def test_stages_against_brute_force(spark, tmp_path):
    rng = random.Random(12)
    rows, items = table(rng)
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x") for i, t in rows], SCHEMA)
    spark.createDataFrame([(k, t) for k, t in enumerate(items)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    labels = spark.createDataFrame([(i, 0 if i in (7, 8) else 1, 0) for i, _ in rows if i is not None], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    model = quality.train(docs, labels)
    want = {"quality": lambda r: rated(r, model), "lines": without_lines, "near_copies": one_of_each, "leaks": lambda r: unleaked(r, items)}
    plain = lambda rs: sorted(rs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [name for name, _ in corpus_pipeline.STAGES] == [*want, "tokens"]
    lost = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        columns = docs.columns
        stage(spark, docs, str(tmp_path)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert docs.columns == columns and plain(after) == plain(want[name](before)), name
        lost[name] = len(before) - len(after)
    assert lost["near_copies"] > 5 and lost["leaks"] >= 1
    lib = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=sentencepiece_bpe.default_model())
    got = sorted((str(r.doc_id), r.n_tokens) for r in corpus_pipeline.run(spark, str(tmp_path)).collect())
    assert got == sorted((str(i), len(lib.encode(t or ""))) for i, t in after)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
