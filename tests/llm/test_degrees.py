"""Every link is counted, also of sets that a component joins without it."""

import numpy as np
import pytest

from tamra.llm import degrees, jaccard
from tests.llm.test_llm import SCHEMA, near_copies, rows


def brute_links(docs, words=4, percent=85):
    sets = {}
    for i, text in docs:
        w = text.split()
        sets[i] = frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1)))
    different = set(sets.values())
    links = {s: sum(100 * len(s & t) >= percent * len(s | t) for t in different if t != s) for s in different}
    return {i: links[s] for i, s in sets.items()}


@pytest.mark.parametrize("members", [1_024, 7])
def test_all_links_are_counted(spark, monkeypatch, members):
    monkeypatch.setattr(degrees, "MEMBERS", members)
    docs = near_copies(3, groups=2, size=40)
    docs += [(1_000 + i, t) for i, t in docs[:5]]  # copies count none
    got = jaccard.join(spark.createDataFrame(rows(docs), SCHEMA)).toPandas()
    want = brute_links(docs)
    assert max(want.values()) > 10
    assert dict(zip(got.doc_id, got.n_verified)) == want


@pytest.mark.parametrize("few, width", [(64, 4_096), (2, 5), (1_000, 1)])
def test_overlaps_are_exact(monkeypatch, few, width):
    monkeypatch.setattr(degrees, "FEW", few)
    monkeypatch.setattr(degrees, "WIDTH", width)
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 40, 12).astype(np.uint64)) for _ in range(30)]
    for first in (30, 11):
        others = sets if first == 30 else sets[first:]
        got = degrees.overlaps(sets, first)
        for a in range(first):
            for b in range(len(others)):
                if first < 30 or a != b:
                    assert got[a, b] == len(np.intersect1d(sets[a], others[b]))
