"""Hard negatives and the packed products against plain sums."""

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamra.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, id long, dim int, v string, ask int, score int, block int, shard int, h int, place int"


def table(spark, vectors):
    return spark.createDataFrame([(i, e, y, 1, 2, "v", 3, 4, 5, 6, 7, 8) for i, e, y in vectors], SCHEMA)


def plainly(vectors, every=3, positives=5, n=3):
    ok = [(i, [math.floor(256 * x) for x in e], y) for i, e, y in vectors
          if i is not None and y is not None and e and all(x is not None and math.isfinite(x) for x in e)]
    found, seen = [], set()
    for i, e, y in ok:
        if i % every or (i, y, tuple(e)) in seen:
            continue
        seen.add((i, y, tuple(e)))
        scored = sorted((-sum(a * b for a, b in zip(e, f)), j, z == y) for j, f, z in ok if j != i and len(f) == len(e))
        for s, j, _ in [x for x in scored if x[2]][:positives]:
            fits = [x for x in scored if not x[2] and -50 * s <= -100 * x[0] <= -95 * s]
            found += [(i, j, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits[:n])]
    return sorted(found)


def mined(spark, vectors):
    got = negatives.mine(table(spark, vectors), F.col("vec_id") % 3 == 0)
    return sorted(map(tuple, got.collect()))


def some(seed, n=120, dim=6):
    rng = random.Random(seed)
    return [(i, [rng.choice([0.5, -0.25, 1.0, rng.uniform(-1, 1)]) for _ in range(dim)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("rows", [8_192, 16])
def test_equal_to_plain_search(spark, rows, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATE_ROWS", rows)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", rows)
    monkeypatch.setattr(negatives, "WORDS_AT_ONCE", 100)
    vectors = some(1) + some(2, 30) + [(200 + i, [0.5] * 6, i % 3) for i in range(12)]  # repeated ids, ties
    assert mined(spark, vectors) == plainly(vectors) != []


def test_odd_rows(spark):
    odd = [(None, [1.0, 1.0], 1), (3, None, 1), (6, [], 1), (9, [1.0, None], 1), (12, [float("nan"), 1.0], 1), (15, [float("inf"), 1.0], 1),
           (18, [1.0, 0.0], None), (21, [1.0, 0.0], 1), (21, [1.0, 0.0], 1), (22, [1.0, 0.0], 1), (23, [0.75, 0.0], 2), (23, [0.75, 0.0], 2), (24, [1.0, 0.0, 2.0], 2)]
    assert mined(spark, odd) == plainly(odd) == [(21, 22, 1, 23, 65536, 49152), (21, 22, 2, 23, 65536, 49152)]
    assert mined(spark, []) == []


def test_large_components_take_wide_integers(spark):
    vectors = [(i, [x * 1e6 for x in e], y) for i, e, y in some(3, 60)]
    assert mined(spark, vectors) == plainly(vectors) != []
    assert mined(spark, [(0, [1e300], 1), (1, [1e300], 1), (2, [7e299], 2)]) == []  # the window ends at 64 bits


@given(st.integers(1, 40), st.integers(1, 9), st.integers(1, 70), st.integers(0, 1000))
@settings(max_examples=120, deadline=None)
def test_packed_products_are_exact(n, dim, bits, seed):
    rng = random.Random(seed)
    draw = lambda: rng.randint(-(1 << bits), 1 << bits)
    kind = np.int64 if bits < 30 else object
    candidates, anchors = (np.array([[draw() for _ in range(dim)] for _ in range(m)], kind) for m in (n, 5))
    got = np.concatenate([s for _, s in negatives._blocks(anchors, candidates)])
    assert [[int(x) for x in r] for r in got] == [[sum(int(a) * int(b) for a, b in zip(q, c)) for c in candidates] for q in anchors]
