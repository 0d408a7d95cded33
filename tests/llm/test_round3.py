"""Small sources, repeated queries, rows that share an id, long texts in pieces, chains and bags recomputed."""

import itertools
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tamra.llm import jaccard, kdtree, mixing, quality, toxicity
from tamra.llm.samples import labelled
from tamra.llm.words import SLICE_BYTES, word_hashes
from tests.llm.test_llm import SCHEMA, rows


@pytest.mark.parametrize("sizes", [[10] * 300, [1] * 40 + [10] * 10 + [100] * 5 + [129, 1_000, 5_000]], ids=["tens", "mixed"])
def test_small_sources_come_near_their_targets(spark, sizes):
    docs = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate(sizes)]
    frame = spark.createDataFrame(rows(docs, [f"s{i:04d}" for i in range(len(sizes))]), SCHEMA)
    got = mixing.totals(mixing.mix(frame, [3.0, 1.0, 2.0])).toPandas()
    assert len(got) == len(sizes)
    block = got.source_size / np.ceil(got.source_size / 128)
    assert (abs(got.taken - got.target) <= block).all()
    assert (got.taken <= 2 * got["size"]).all()
    assert abs(got.target.sum() - 1.5 * sum(sizes)) < 1e-6


@pytest.mark.parametrize("shard_rows", [8_192, 9])
def test_repeated_queries_ask_once(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard_rows)
    rng = np.random.default_rng(2)
    vectors = [(i, rng.integers(-9, 9, 4).astype(float).tolist()) for i in range(60)]
    vectors += [vectors[0], vectors[0], (0, [1.0, 2.0, 3.0, 4.0])]
    got = kdtree.top_k(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, 5, scale=1.0).collect()
    want = []
    for i, q in [vectors[0], vectors[20], vectors[40], vectors[-1]]:
        scored = sorted((-sum(a * b for a, b in zip(q, e)), j) for j, e in vectors if j != i)[:5]
        want += [(i, r + 1, j, int(-s)) for r, (s, j) in enumerate(scored)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_one_row_of_each_component_stays(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = [(5, text), (5, "quite another text with the same id"), (2, text + " end"), (2, text + " end"), (2, "and a third one of its own here"),
            (9, text.upper()), (None, text), (7, None), (7, None), (3, "one"), (4, "one")]
    frame = spark.createDataFrame(rows(docs), SCHEMA)
    got = jaccard.one_of_each(frame).select("doc_id", "text").collect()
    want = [docs[i] for i in (1, 2, 4, 6, 7, 8, 9)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_sample_says_what_it_leaves_out(spark):
    docs = [(i, "x " * (50 if i % 4 else 500)) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    frame = spark.createDataFrame(rows(docs), SCHEMA)
    all_of = labelled(frame, labels, "quality", most_bytes=400)
    assert 0 < all_of.attrs["too_long"] < all_of.attrs["labelled"] and len(all_of) == all_of.attrs["labelled"] - all_of.attrs["too_long"]
    some = labelled(frame, labels, "quality", class_bytes=1_050, most_bytes=400)
    assert some.groupby("label").size().tolist() == [10, 10]
    assert labelled(frame, labels.limit(0), "quality").empty


@pytest.fixture(scope="module")
def models():
    rng = np.random.default_rng(4)
    words = ["good", "Bad", "ugly", "##", "der", "The", "end.", "a", "123", "?", "\n", "\n\n", "badword"]
    texts = [" ".join(rng.choice(words, rng.integers(1, 200))) + (" badword" if i % 2 else "") for i in range(200)]
    sample = pd.DataFrame({"text": texts, "label": [i % 2 for i in range(200)]})
    return quality.fit(sample), toxicity.fit(sample)


def test_marginals_equal_enumeration(models):
    model = quality.Model(models[0].mean, models[0].spread, models[0].weights, np.array([0.7, -0.4]))
    raw = np.frombuffer(b"One line.\nTwo ## lines\nand 3\nDER end?", np.uint8)
    found = quality.lines(raw, np.array([0, len(raw)]))
    x = quality.neighbours(quality._scaled(model, found), found.row)
    weight = {}
    for state in itertools.product((0, 1), repeat=len(x)):
        energy = sum(float(x[i] @ model.weights) for i, y in enumerate(state) if y)
        energy += sum(model.stay[0] if a and b else model.stay[1] if not (a or b) else 0.0 for a, b in zip(state, state[1:]))
        weight[state] = math.exp(energy)
    want = [sum(w for s, w in weight.items() if s[i]) / sum(weight.values()) for i in range(len(x))]
    assert np.allclose(quality.marginals(model, found), want, atol=1e-12)
    lengths = found.length + 1.0
    assert np.isclose(quality._values(model, raw, np.array([0, len(raw)]))[0], (np.array(want) * lengths).sum() / lengths.sum())


def test_noisy_or_recomputed(models):
    weights = models[1]
    texts = ["A badword here. Nothing there!\nbadword badword? der", "", "good", "a.b"]
    data = "".join(texts).encode()
    offsets = np.cumsum([0] + [len(t.encode()) for t in texts])
    got = toxicity._values(weights, np.frombuffer(data, np.uint8), offsets)
    for text, score in zip(texts, got):
        clean = 1.0
        for said in re.split(r"(?<=[.!?\n])", text) or [""]:
            raw = np.frombuffer(said.encode(), np.uint8)
            s = toxicity.sentences(raw, np.array([0, len(raw)]))
            each = {int(w): sum(float(weights[f]) for f in row if f >= 0) for w, row in zip(s.word, s.features)}
            if said or not text:
                clean *= 1 - 1 / (1 + math.exp(-(toxicity.BASE_LOGIT + sum(each.values()))))
        assert np.isclose(score, 1 - clean, rtol=1e-5)


@pytest.mark.parametrize("text", ["One line. Two ##\nbadword  \n \n\nder 12 end.\n" * 60_000, "\n" * 3_000_000 + "abc.\n", "x" * 5_000_000, " " * 4_000_000], ids=["lines", "blank", "word", "spaces"])
def test_long_texts_in_pieces_score_as_a_whole(models, monkeypatch, text):
    raw = np.frombuffer(text.encode(), np.uint8)
    offsets = np.array([0, len(raw)])
    assert len(raw) > 2 * SLICE_BYTES
    read = lambda: (quality._values(models[0], raw, offsets)[0], toxicity._values(models[1], raw, offsets)[0])
    pieces = read()
    for module in (quality, toxicity):
        monkeypatch.setattr(module, "SLICE_BYTES", 1 << 40)
    assert np.allclose(pieces, read(), rtol=1e-9)
    hashes, before = word_hashes(raw, offsets)
    assert before.tolist() == [0, len(hashes)] and len(hashes) == len(text.split())
    if "line" in text:
        assert (hashes.reshape(60_000, -1) == hashes[:len(hashes) // 60_000]).all()
    assert 0 <= pieces[0] <= 1 and 0 <= pieces[1] <= 1


def test_arrow_columns_of_any_layout_are_kept_whole(spark, models):
    texts = [None, "", "badword. " * 5, "good line\n" * 30]
    frame = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, good string")
    scores = dict(quality.score(frame, models[0]).collect())
    assert {r.doc_id for r in quality.keep(frame, models[0]).collect()} == {i for i, s in scores.items() if s >= 0.5}
    scores = dict(toxicity.score(frame, models[1]).collect())
    assert {r.doc_id for r in toxicity.keep(frame, models[1]).collect()} == {i for i, s in scores.items() if s < 0.7}
    assert quality.keep(frame, models[0]).schema == frame.schema
