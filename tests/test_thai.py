import random

import pytest

from tamra.functions import thai
from tamra.functions.text import surface_tokens, words
from tamra.operators import chunk, index, retrieve, tokens


def dictionary(spark, found):
    return spark.createDataFrame([(w,) for w in found], "word string")


def cut_by_hand(text, known):
    """Longest dictionary word, else a run of digits, else a cluster, else a run of other letters, else a symbol."""
    lead, consonant = "เแโใไ", [chr(c) for c in range(0xE01, 0xE2F)]
    follow = [chr(c) for c in [*range(0xE30, 0xE3B), 0xE45, *range(0xE47, 0xE4F)]]
    digit, letter = "๐๑๒๓๔๕๖๗๘๙", [chr(c) for c in [*range(0xE01, 0xE3B), *range(0xE40, 0xE4F)]]
    out, at = [], 0
    while at < len(text):
        hits = [n for n in range(1, 8) if at + n <= len(text) and text[at:at + n] in known]
        if hits:
            end = at + max(hits)
        elif text[at] in digit:
            end = at
            while end < len(text) and text[end] in digit:
                end += 1
        elif text[at] in letter:
            end = at + (1 if text[at] in lead and text[at + 1:at + 2] in consonant and at + 1 < len(text) else 0)
            start = end
            if text[end] in consonant:
                end += 1
                while end < len(text) and end - start < 6 and text[end] in follow:
                    end += 1
            else:
                end += 1
        elif text[at].isalnum():
            end = at
            while end < len(text) and text[end].isalnum() and text[end] not in digit and text[end] not in letter:
                end += 1
        elif text[at].isspace():
            at += 1
            continue
        else:
            end = at + 1
        out.append(text[at:end])
        at = end
    return out


def test_thai_tokens_agree_with_a_walk_by_hand(spark):
    rng = random.Random(3)
    known = ["กา", "กาแฟ", "แฟ", "น้ำ", "น้ำตาล", "ตา", "ตาล", "คน", "เขา", "ไป"]
    parts = [*known, "เ", "ก", "ะ", "้", "แ", "ซ", "๑", "๒๓", "abc", "7", "é", " ", "-", "฿", "\n", "ำ", "ฯ", "ๆ"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(400)] + ["", "กาแฟน้ำตาล"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rules = thai.rules(dictionary(spark, [*known, "abc", None, "กา", ""]))
    got = {r.doc_id: r.t for r in df.select("doc_id", surface_tokens(df.text, rules).alias("t")).collect()}
    for i, text in enumerate(texts):
        assert got[i] == cut_by_hand(text, set(known)), text
    assert got[401] == ["กาแฟ", "น้ำตาล"]


def test_thai_chunks_stay_below_their_size_and_keep_offsets(spark):
    rows = [(1, "กาแฟน้ำตาล" * 840), (2, "ซฌญ" * 3000), (3, "ก" + "้" * 9000), (4, None), (5, ""), (6, " " * 50)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    rules = thai.rules(dictionary(spark, ["กาแฟ", "น้ำตาล"]))
    out = chunk.chunk(df, 64, 0.15, rules=rules).collect()
    text = dict(rows)
    assert {r.doc_id for r in out} == {1, 2, 3}
    assert all(r.n_tokens <= 64 and len(r.text) <= 64 * 7 and text[r.doc_id][r.start:r.end] == r.text for r in out)
    for doc in (1, 2, 3):
        covered = sorted((r.start, r.end) for r in out if r.doc_id == doc)
        assert covered[0][0] == 0 and covered[-1][1] == len(text[doc])
        assert all(b[0] <= a[1] for a, b in zip(covered, covered[1:]))
    swept = chunk.chunk_sweep(df, [64], 0.15, rules).first()
    assert swept.n_chunks == len(out)


def test_thai_words_reach_vocabulary_tokens_and_retrieval(spark):
    df = spark.createDataFrame([(1, "กาแฟน้ำตาล"), (2, "น้ำตาลน้ำตาลคน"), (3, None)], "doc_id bigint, text string")
    rules = thai.rules(dictionary(spark, ["กาแฟ", "น้ำตาล", "คน"]))
    vocab = tokens.build_vocab(df, 10, rules)
    assert [r.token for r in vocab.orderBy("token_id").collect()] == ["น้ำตาล", "กาแฟ", "คน"]
    ids = {r.doc_id: r.input_ids for r in tokens.tokenise(df, vocab, rules=rules).collect()}
    assert ids[1] == [5, 4, tokens.EOS] and ids[2] == [4, 4, 6, tokens.EOS]
    postings = index.build_postings(chunk.chunk(df, 16, 0.0, rules=rules), rules)
    asked = spark.createDataFrame([(9, "กาแฟ"), (8, "ซื้อ")], "query_id bigint, text string")
    assert [r.query_id for r in retrieve.bm25_topk(asked, postings, 5, rules=rules).collect()] == [9]


def test_thai_rules_without_words_and_beyond_the_bound(spark):
    rules = thai.rules(dictionary(spark, []))
    df = spark.createDataFrame([("เขาไป ok",)], "text string")
    assert df.select(words(df.text, rules).alias("w")).first().w == ["เขา", "ไป", "ok"]
    with pytest.raises(ValueError):
        thai.rules(dictionary(spark, ["กา", "ตา"]), most=1)
