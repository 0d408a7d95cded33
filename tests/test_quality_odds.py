import math

import pytest

from tamra.operators import chat, clean


def test_bayes_quality_is_the_count_formula(spark):
    texts = {1: "good good plain", 2: "bad plain", 3: "bad worse bad", 4: "good unseen", 5: "", 6: None}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (5, 1), (6, None), (99, 1)], "doc_id bigint, quality bigint")
    odds, prior = clean.word_odds(docs, labels)
    good, bad = {"good": 2, "plain": 1}, {"bad": 3, "plain": 1, "worse": 1}
    terms = set(good) | set(bad)
    size = (5 + len(terms)) / (3 + len(terms))
    want = {t: math.log((good.get(t, 0) + 1) / (bad.get(t, 0) + 1) * size) for t in terms}
    assert {r.term: pytest.approx(r.odds) for r in odds.collect()} == want
    assert prior == pytest.approx(math.log(3 / 3))
    got = {r.doc_id: r.log_odds for r in clean.bayes_quality(docs, odds, prior).collect()}
    for i, text in texts.items():
        found = (text or "").split()
        expected = (prior + sum(want.get(t, 0.0) for t in found)) / len(found) if found else prior
        assert got[i] == pytest.approx(expected)


def test_bayes_quality_without_labels_or_rows(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    none = spark.createDataFrame([], "doc_id bigint, quality bigint")
    odds, prior = clean.word_odds(docs, none)
    assert odds.count() == 0 and prior == 0.0
    assert [r.log_odds for r in clean.bayes_quality(docs, odds, prior).collect()] == [0.0]
    assert clean.bayes_quality(docs.filter("doc_id < 0"), odds, prior).count() == 0


def test_reasoning_content_stands_in_for_reasoning(spark):
    def text(**extra):
        columns = ["conv_id bigint", "turn bigint", "role string", "text string", f"tool_calls {chat.CALL_TYPE}", *[f"{c} string" for c in extra]]
        call = [("1", "look", "{}")]
        rows = [(1, 0, "user", "hi", None, *[None] * len(extra)), (1, 1, "assistant", "", call, *extra.values())]
        return chat.render(spark.createDataFrame(rows, ", ".join(columns))).first()["text"]

    assert "thought\nfirst\n" in text(reasoning="first", reasoning_content="second")
    assert "thought\nsecond\n" in text(reasoning="", reasoning_content="second")
    assert "thought\nsecond\n" in text(reasoning_content="second")
    assert "thought" not in text(reasoning=None, reasoning_content=None)
