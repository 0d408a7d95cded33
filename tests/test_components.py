"""Components of chains, stars and cliques; their plans stay small however many rounds there are."""

import random

import pytest

from tamra.operators import dedup


def by_hand(pairs):
    label = {x: x for p in pairs for x in p}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {x: root(x) for x in label}


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_components_of_chains_stars_and_cliques(spark, kind):
    rng = random.Random(4)
    shuffled = rng.sample(range(1000, 1300), 300)
    pairs = [(i, i + 1) for i in range(300)] + list(zip(shuffled, shuffled[1:])) + [(2000, i) for i in range(2001, 2100)]
    pairs += [(i, j) for i in range(3000, 3010) for j in range(i + 1, 3010)] + [(4000, 4001), (5000, 5000)]
    pairs = [(min(p), max(p)) for p in pairs]
    if kind == "string":
        pairs = [tuple(sorted(map(str, p))) for p in pairs]
    found = dedup.components(spark.createDataFrame(pairs, f"leader {kind}, member {kind}"))
    got = {r.doc_id: r.cluster_id for r in found.collect()}
    assert got == by_hand(pairs) and found.count() == len(got)
    size = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    assert len(str(size)) < 20  # its digits doubled in every round


def test_components_of_nothing(spark):
    assert dedup.components(spark.createDataFrame([], "leader bigint, member bigint")).count() == 0
