import hashlib
import math
import random
import zlib

import pytest

from tickloom.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string"


def brute(rows):
    """Nodes of the rebuilt conversations, from sequences of turns in a dictionary."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [x[2:] for x in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = convs.get(c - int(math.fmod(c, 100)), [])[:h] + own[h:]
    nodes = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            nodes.setdefault(tuple(v[:d]), []).append(c)
    kids, leaves, saved = (dict.fromkeys(nodes, 0) for _ in range(3))
    for k in nodes:
        if k:
            kids[k[:-1]] += 1
    for k, members in nodes.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(members) - 1) * len(k[-1][1]) if k else 0
    ends = lambda k: ",".join(map(str, sorted(c for c in nodes[k] if len(built[c]) == len(k))))
    return sorted((min(m), len(k), min(nodes[k[:-1]]) if k else -(10**9), len(m), kids[k], leaves[k], saved[k], hashlib.sha256(ends(k).encode()).hexdigest()) for k, m in nodes.items())


def found(spark, rows, local):
    got = prefix_trie.query(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA), local).collect()
    return sorted(tuple(-(10**9) if x is None else x for x in r) for r in got)


@pytest.mark.parametrize("local", [20, prefix_trie.LOCAL])
def test_random_conversations(spark, local):
    rng = random.Random(local)
    rows = []
    for c in [0, 100, 200, -3, -100, *rng.sample(range(1, 420), 60)]:
        rows += [(c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bé", "longer text"])) for t in range(rng.choice([1, 2, 3, 5, 9]))]
    rows += [(c, t, "user", f"copy {t}") for c in range(500, 540) for t in range(7)]  # one large group of copies
    assert found(spark, rows, local) == brute(rows)


def test_edges(spark):
    """Null turns, roles, texts and identifiers, repeated turns, a conversation that ends at the root, and a very long one."""
    rows = [(7, None, None, None), (7, 1, "", ""), (7, 1, "", ""), (8, None, "user", None), (None, 0, "user", "x"), (8, 3, None, "x"), (108, 1, "user", "x")]
    rows += [(9, t, "user", "é" * (t % 3)) for t in range(9000)]
    rows += [(300, t * 5000, "user", str(t)) for t in range(6)]
    rows += [(c, 0, "user", "only") for c in range(1001, 1040)]  # no conversation 1000: most of these lose their only turn
    for local in (50, prefix_trie.LOCAL):
        small = [r for r in rows if r[0] != 9]
        assert found(spark, small, local) == brute(small)
    got = prefix_trie.conversation_trie(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    last = got.where("conv_id = 9").orderBy("depth", ascending=False).first()
    assert last.depth == 9000 and last.n_children == 0 and last.ends_sha256 == hashlib.sha256(b"9").hexdigest()
    assert found(spark, [], 50) == []


def test_texts_of_nodes(spark):
    rows = [(1, 0, "user", "a", "x"), (1, 1, "assistant", "b", "x"), (2, 0, "user", "a", "x"), (2, 1, None, "c", "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {(r.depth, r.role, r.text, r.n_convs) for r in prefix_trie.node_texts(prefix_trie.conversation_trie(df), df).collect()}
    assert got == {(0, None, None, 2), (1, "user", "a", 2), (2, "assistant", "b", 1), (2, "", "c", 1)}
