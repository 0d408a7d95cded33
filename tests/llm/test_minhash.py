"""Tensored MinHash against brute force over all pairs, odd rows, and its recall."""

import random

import numpy as np
import pytest

from tamra.llm import meet, minhash
from tamra.llm.words import mix
from tests.llm.test_llm import LONG, ODD, SCHEMA, brute_components, near_copies, rows


def found(spark, docs, **options):
    got = minhash.near_copies(spark.createDataFrame(rows(docs), SCHEMA), **options).toPandas()
    assert (got.kept == (got.doc_id == got.component_id)).all()
    return got


def family(seed, size=260, words=150, edits=(3, 9)):
    """Copies of one text with several changed words each: many pairs near the threshold, few above it."""
    rng = random.Random(seed)
    base = [f"b{k}" for k in range(words)]
    docs = []
    for i in range(size):
        text = list(base)
        for _ in range(rng.randint(*edits)):
            text[rng.randrange(words)] = f"e{i}x{rng.random()}"
        docs.append(text)
    return [(i, " ".join(t)) for i, t in enumerate(docs)]


@pytest.mark.parametrize("docs", [near_copies(1), family(2)], ids=["groups", "family"])
@pytest.mark.parametrize("block", [1_024, 40])
def test_components_equal_brute_force(spark, docs, block, monkeypatch):
    monkeypatch.setattr(meet, "BLOCK", block)
    got = found(spark, docs)
    assert dict(zip(got.doc_id, got.component_id)) == brute_components(docs, 85, 5)


def test_odd_rows(spark):
    docs = ODD + [(30, LONG + " one word more"), (31, "a b c d e f g h i j k l m n"), (32, "A b c d e f g h i j k l m n o"), (33, "a b c"), (34, "A  B\tC")]
    got = found(spark, docs)
    kept = [(i, t) for i, t in docs if i is not None]
    want = brute_components(kept, 85, 5)
    assert sorted(got.doc_id) == sorted(i for i, _ in kept)
    assert dict(zip(got.doc_id, got.component_id)) == want
    assert got[got.doc_id.isin([0, 1, 2])].n_shingles.tolist() == [0, 0, 0]
    assert got[got.doc_id == 8].n_shingles.tolist() == [1]
    assert want[30] == 5 and want[34] == 33 and want[32] == 31
    assert len(minhash.near_copies(spark.createDataFrame([], SCHEMA)).toPandas()) == 0


def test_recall_is_as_stated():
    """Pairs of the threshold's similarity share a hash in both collections."""
    rng = np.random.default_rng(1)
    signer = minhash.Signer(minhash.HALVES, minhash.ROWS, 1)
    lost, met, each = 0, 0, 3_000
    for _ in range(each):
        s = np.unique(mix(rng.integers(1, 1 << 62, 215).astype(np.uint64)))
        a, b = signer.of(np.sort(s[15:])), signer.of(np.sort(s[:200]))  # 185 of 215 shared: 0.860
        same = a == b
        met += int(same.sum())
        lost += not (same[:minhash.HALVES].any() and same[minhash.HALVES:].any())
    assert lost == 0 and minhash.missed(0.85) < 1e-5
    assert abs(met / each / (2 * minhash.HALVES) - (185 / 215) ** minhash.ROWS) < 0.01


def test_both_joins_agree_on_a_family_with_few_first_level_members(spark):
    """A family whose members rarely stand in each other's plain prefixes, by two methods and brute force."""
    from tamra.llm import jaccard
    docs = family(5, 220, 150, (2, 6)) + [(1_000 + i, t) for i, t in family(6, 60, 40, (0, 2))]
    want = brute_components(docs, 85, 4)
    for got in (found(spark, docs, words=4), jaccard.join(spark.createDataFrame(rows(docs), SCHEMA)).toPandas()):
        assert dict(zip(got.doc_id, got.component_id)) == want
