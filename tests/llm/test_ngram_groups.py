"""What the n-gram join keeps of its groups from round to round."""

import random

import numpy as np
from test_llm import _brute_components, make, prose  # noqa: F401

from tickloom.llm import ngram_join


def test_groups_without_a_close_pair_are_held_against_each_other_once(make, monkeypatch):  # noqa: F811
    rng = random.Random(11)
    shared = [prose(rng, 12) for _ in range(10)]
    texts = [f"{shared[k % 10]} {prose(rng, 14)}" for k in range(80)]  # meet by a passage, are not similar
    base = prose(rng, 60).split()
    for k in range(24):  # near copies, of which not all are similar to the leader
        texts.append(" ".join(rng.choice(base) if rng.random() < 0.02 else w for w in base))
    rows = list(enumerate(texts))
    seen, across = [], ngram_join._across

    def counted(groups, *rest):
        seen.append(groups.where("cls != lead").count())
        return across(groups, *rest)

    monkeypatch.setattr(ngram_join, "_across", counted)
    monkeypatch.setattr(ngram_join, "_levels", lambda _: np.zeros(ngram_join.SLOTS, np.uint8))  # as in a large table, where slots are shared
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similarity_components(make(rows)).collect()}
    assert got == _brute_components(rows)
    assert len(seen) > 1 and max(seen[1:]) < seen[0] / 2
