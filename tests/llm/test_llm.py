"""The training-data operators against brute force, round trips and odd inputs."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tamra.llm import bpe, jaccard, kdtree, mixing, packed, quality, sharding, spots, toxicity, urls
from tamra.llm.pretokens import pretokens
from tamra.llm.queries import QUERIES
from tamra.llm.tables import tokenizer_path
from tamra.llm.words import shingles, slices, word_hashes

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, key string, size int, score double, hash long, "
          "token string, part int, row_number int, n int, `class` int, ids string, shard int, _row int, `before` int, set string, bit int")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(texts, sources=None):
    """Rows of documents with columns whose names the operators use themselves."""
    extra = ["x", 7, 0.5, 1, "t", 3, 9, 4, 5, "i", 2, 8, 6, "s", 0]
    return [(i, t, "en", (sources or ["a"] * len(texts))[n], len(t or ""), *extra) for n, (i, t) in enumerate(texts)]


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(120_000))
ODD = [(0, None), (1, ""), (2, " \n\t "), (3, "one two three four five six"), (3, "one two three four five six"), (3, "another text of the same id"),
       (4, "ONE two three four five six"), (None, "a row without an id"), (None, None), (5, LONG), (6, "ไทย ภาษา 你好 🙂"), (7, "<|endoftext|> it's  two"),
       (8, "no."), (9, "The end of the line.\n\nAnd of the page it is said that the end is near.")]


@pytest.fixture(scope="module")
def odd(spark):
    sources = [None if i % 5 == 0 else f"s{i % 3}" for i in range(len(ODD))]
    return spark.createDataFrame(rows(ODD, sources), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(10)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


# --- words and shingles

@given(st.lists(st.text(alphabet="aB \n\té你", max_size=25), max_size=6))
@settings(max_examples=60, deadline=None)
def test_word_hashes_tell_words_apart(texts):
    import pyarrow as pa
    seen = {}
    for first, raw, offsets in slices(pa.array(texts, pa.string())):
        hashes, before = word_hashes(raw, offsets)
        for i in range(len(offsets) - 1):
            words = [w.translate(LOWER) for w in WORD.findall(texts[first + i])]
            assert len(words) == before[i + 1] - before[i]
            for w, h in zip(words, hashes[before[i]:before[i + 1]].tolist()):
                assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


# --- 1 near copies

def brute_components(docs, percent=85, n=4):
    sets, parent = {}, {}
    for i, text in docs:
        w = WORD.findall((text or "").translate(LOWER))
        found = frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
        sets.setdefault(i, []).append(found)
        parent[i] = i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    flat = [(i, s) for i, group in sets.items() for s in group if s]
    for k, (i, a) in enumerate(flat):
        for j, b in flat[:k]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in sets}


def near_copies(seed, groups=6, size=60, words=60):
    rng = random.Random(seed)
    docs = []
    shared = [f"s{k}" for k in range(40)]
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(words)]
        for _ in range(size):
            edited = [w if rng.random() > 0.01 else f"e{rng.random()}" for w in base]
            docs.append(edited + (shared if rng.random() < 0.3 else []))
    docs += [shared + [f"u{g}x{k}" for k in range(30)] for g in range(80)]
    rng.shuffle(docs)
    return [(i, " ".join(d)) for i, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_components_equal_brute_force(spark, seed):
    docs = near_copies(seed)
    got = jaccard.join(spark.createDataFrame(rows(docs), SCHEMA)).toPandas()
    want = brute_components(docs)
    assert dict(zip(got.doc_id, got.component_id)) == want
    assert got.n_shingles.min() > 0


def test_jaccard_odd_rows(odd, empty):
    got = jaccard.join(odd).toPandas()
    assert len(got) == len(ODD) - 2  # rows without an id are left out
    assert set(got[got.doc_id.isin([0, 1, 2])].n_shingles) == {0}
    want = brute_components([d for d in ODD if d[0] is not None])
    assert all(want[i] == c for i, c in zip(got.doc_id, got.component_id))
    assert jaccard.join(empty).count() == 0


def test_prefix_levels_bound_the_overlap():
    rng = np.random.default_rng(3)
    prefixes = jaccard.Prefixes(np.arange(0, 50, dtype=np.int64), np.full(50, 9, np.int64), 0.2, 85)
    for _ in range(200):
        base = rng.choice(400, 60, replace=False).astype(np.uint64)
        other = np.where(rng.random(60) < 0.05, base + np.uint64(1000), base)
        a, b = np.unique(base), np.unique(other)
        if 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
            continue
        (ta, la, asked_a), (tb, lb, asked_b) = prefixes.of(a), prefixes.of(b)
        asked = min(asked_a, asked_b)
        assert len(set(ta[la <= asked]) & set(tb[lb <= asked])) >= asked


# --- 2 url filters

def brute_verdict(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(LOWER)
    fits = [(len(h) + len(p or ""), len(h), h + (p or ""), v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    if not fits:
        return host, path, None, default
    top = max(f[:2] for f in fits)
    best = min((f for f in fits if f[:2] == top), key=lambda f: f[3])
    return host, path, best[2], best[3]


def test_urls_equal_brute_force(spark):
    rng = random.Random(4)
    labels = ["a", "b", "com", "net", "x-y", "www"]
    make = lambda: "http://" + ".".join(rng.choices(labels, k=rng.randint(1, 4))) + rng.choice(["", "/", "/e", "/en/1?x=/", "/en#q", "?/en/"])
    found = [make() for _ in range(800)] + ["HTTP://WWW.A.Com/En", "http://hot.com/en/"] * 300 + ["", "no scheme", "x://", "a://b://c/d", None]
    rules = list({(".".join(rng.choices(labels, k=rng.randint(1, 3))), rng.choice(["/", "/e", "/en/", ""]), rng.choice(["allow", "block"])) for _ in range(60)})
    rules += [("", "/", "block"), ("com", None, "allow")]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(found)], "page_id long, url string, host string, `range` string")
    got = urls.judge(pages, spark.createDataFrame(rules + [(None, "/", "block")], "host string, path string, verdict string"), "other").toPandas()
    assert len(got) == len(found)
    for row in got.itertuples(index=False):
        assert tuple(row[1:]) == brute_verdict(found[row.page_id], rules, "other")
    none = urls.judge(pages.limit(0), spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert none.count() == 0


# --- 3 packed ids

@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70), st.data())
@settings(max_examples=80, deadline=None)
def test_pack_round_trip(width, values, data):
    ids = np.array(values, np.uint64) & np.uint64((1 << width) - 1)
    packed_bytes = packed.pack(ids, width)
    assert len(packed_bytes) == (len(ids) * width + 7) // 8
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert packed.unpack(packed_bytes, width, a, b - a).tolist() == ids[a:b].tolist()


def library_ids(text):
    from tokenizers import Tokenizer
    library_ids.t = getattr(library_ids, "t", None) or Tokenizer.from_file(tokenizer_path())
    return library_ids.t.encode(text or "", add_special_tokens=False).ids


def test_packed_files_hold_all_ids(spark, odd, empty, tmp_path):
    out = str(tmp_path / "ids")
    packed.write(odd, out, tokenizer_path())
    got = packed.documents(spark, out).orderBy("start").toPandas()
    order = sorted(ODD, key=lambda d: (-1 if d[0] is None else d[0], zlib.crc32((d[1] or "").encode())))
    ids = [[*library_ids(t), 0] for _, t in order]
    assert got.n_tokens.tolist() == [len(i) for i in ids]
    assert got.start.tolist() == np.cumsum([0, *map(len, ids)])[:-1].tolist()
    assert got.ids_crc32.tolist() == [zlib.crc32(np.array(i, "<u4").tobytes()) for i in ids]
    whole = [x for i in ids for x in i]
    part = sorted((r["start"], r["ids"]) for r in packed.read_range(spark, out, 5, 400).collect())
    assert part[0][0] == 5 and [x for _, p in part for x in p] == whole[5:400]
    packed.write(empty, str(tmp_path / "none"), tokenizer_path())
    assert packed.documents(spark, str(tmp_path / "none")).count() == 0


def test_packed_words_are_asked_for_once():
    encoder, asked = packed._library.__wrapped__(tokenizer_path())[0], []
    library = encoder.new_words
    encoder.new_words = lambda words: asked.extend(words) or library(words)
    text = " ".join(map(str, range(150_000))) + "<|endoftext|>"
    first, again = encoder.encode([text]), encoder.encode([text, text])
    assert again == first * 2 and np.frombuffer(first[0], "<u4").tolist() == library_ids(text)
    assert len(asked) == len(set(asked)) == 150_000


def test_a_full_word_cache_changes_no_ids():
    library = packed._library(tokenizer_path())[0]
    encoder = bpe.Encoder(library.new_words, {"<|endoftext|>": 50256}, 2)
    for texts in ([], [""], ["one two"], ["é ก🙂's", "<|endoftext|><|endoftext|>é", "one two three", "", "three<|endoftext|>three 4", "two"], ["three four", "one"]):
        assert [np.frombuffer(i, "<u4").tolist() for i in encoder.encode(texts)] == [library_ids(t) for t in texts]
        assert len(encoder.words) <= 3
    assert len(encoder.words) == 3


# --- 4 fingerprints

def test_fingerprints(spark, odd, empty):
    got = spots.edited_fingerprints(odd).toPandas()
    assert len(got) == len(ODD) and got.near_edited.between(0, 1).all() and got.near_next.between(0, 1).all()
    order = sorted(ODD, key=lambda d: (-1 if d[0] is None else d[0], zlib.crc32((d[1] or "").encode()), d[1] or ""))
    texts = [t or "" for _, t in order]
    edited = [t[:len(t) - len(t) // 2] + texts[(i + 1) % len(texts)][:len(t) // 2] for i, t in enumerate(texts)]
    assert sorted(got.edited_sha256) == sorted(hashlib.sha256(e.encode()).hexdigest() for e in edited)
    assert sorted(got.n_chars) == sorted(map(len, texts))
    assert set(got[got.n_chars == 0].fingerprint) == {""}
    assert (got[got.doc_id == 3].near_next == 1).any()
    assert spots.edited_fingerprints(empty).count() == 0


def test_equal_texts_have_equal_fingerprints_and_near_ones_are_near(spark):
    base = [f"word{i} the thing{i % 7} of" for i in range(80)]
    texts = [" ".join(base), " ".join(base), " ".join(base[:-2] + ["quite other ends"]), "nothing of the kind " * 3]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = spots.edited_fingerprints(frame).orderBy("doc_id").toPandas()
    assert got.fingerprint[0] == got.fingerprint[1] and got.near_next[0] == 1
    assert 0.9 < got.near_next[1] < 1 and got.near_next[2] < 0.1


# --- 5 mixing

def test_mix_follows_its_targets(spark, odd, empty):
    rng = random.Random(5)
    docs = [(i, " ".join(["w"] * rng.randint(0, 900))) for i in range(700)]
    sources = ["hot" if rng.random() < 0.4 else rng.choice(["a", "é", "z", None]) for _ in docs]
    frame = spark.createDataFrame(rows(docs, sources), SCHEMA)
    got = mixing.totals(mixing.mix(frame, [3.0, 1.0, 2.0])).toPandas()
    got["source"] = [sources[i] for i in got.doc_id]
    assert len(got) == len(docs) and (got.taken <= 2 * got["size"]).all()
    size = defaultdict(int)
    for (_, t), s in zip(docs, sources):
        size[s] += len(WORD.findall(t))
    names = sorted([s for s in size if s is not None]) + [None]
    weight, want, stopped = dict(zip(names, [3, 1, 2, 3, 1])), {}, set()
    total = sum(size.values())
    while True:
        level = (1.5 * total - sum(2 * size[s] for s in stopped)) / sum(weight[s] for s in names if s not in stopped)
        want = {s: 2 * size[s] if s in stopped else level * weight[s] for s in names}
        more = {s for s in names if want[s] > 2 * size[s]}
        if not more:
            break
        stopped |= more
    for s in names:
        mine = got[got.source.isna()] if s is None else got[got.source == s]
        assert set(mine.source_size) == {size[s]} and abs(mine.target.iloc[0] - want[s]) < 1e-6 * total
        assert abs(mine.taken.sum() - want[s]) < 4 * 128
    again = mixing.totals(mixing.mix(frame.repartition(3), [3.0, 1.0, 2.0])).toPandas()
    assert dict(zip(again.doc_id, again.taken)) == dict(zip(got.doc_id, got.taken))
    strange = mixing.totals(mixing.mix(odd, [3.0, 1.0, 2.0])).toPandas()
    assert len(strange) == len(ODD) and (strange[strange["size"] == 0].taken == 0).all()
    assert mixing.totals(mixing.mix(empty, [1.0])).count() == 0


# --- 6 sharding

@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 1000])
def test_permutation_is_one_to_one(spark, n):
    got = sharding.permuted(spark.range(n), "id", n, 9).toPandas()
    assert sorted(got.permuted) == list(range(n))


def test_shards_are_even_and_reproducible(odd, empty):
    got = sharding.shard(odd, 4).toPandas()
    for _, group in got.groupby("shard"):
        assert sorted(group.slot) == list(range(len(group)))
    counts = got.groupby("shard").size()
    assert counts.max() - counts.min() <= 1 and len(got) == len(ODD)
    again = sharding.shard(odd.repartition(5), 4).toPandas()
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert got[columns].sort_values(columns).values.tolist().__repr__() == again[columns].sort_values(columns).values.tolist().__repr__()
    assert sharding.shard(empty, 4).count() == 0


# --- 7 BPE

@given(st.text(alphabet="ab'stl er\n\t1²é你ก!-\x85\u3000🙂", max_size=40))
@settings(max_examples=300, deadline=None)
def test_bpe_equals_the_library(text):
    ids = bpe._encoder(tokenizer_path()).encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library_ids(text)
    assert bpe.decode(ids, bpe.load(tokenizer_path())) == text
    assert "".join(pretokens(text)) == text


def test_bpe_round_trip_of_odd_rows(odd, empty):
    got = bpe.digests(odd, tokenizer_path()).toPandas()
    want = sorted((hashlib.sha256(np.array(library_ids(t), "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for _, t in ODD)
    assert sorted(zip(got.ids_sha256, got.decoded_sha256)) == want
    back = bpe.decode_ids(bpe.encode_text(odd, tokenizer_path()), tokenizer_path()).toPandas()
    assert sorted(back.text) == sorted(t or "" for _, t in ODD)
    assert bpe.digests(empty, tokenizer_path()).count() == 0


# --- 8 and 9 classifiers

def test_classifiers_take_odd_rows(odd, empty, labels):
    for predict, other in ((quality.predict, labels.where("quality = 1")), (toxicity.predict, labels.where("toxic = 1"))):
        got = predict(odd, labels).toPandas()
        assert len(got) == len(ODD) and got.score.between(0, 1).all() and not got.score.isna().any()
        assert predict(empty, labels).count() == 0
        assert predict(odd, other).count() == len(ODD) == predict(odd, labels.limit(0)).count()


@pytest.mark.parametrize("name,column,least", [("op8_line_crf_quality", "quality", 0.97), ("op9_noisy_or_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    sf = "/root/testdata/sf0.1"
    got = QUERIES[name].run(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").toPandas()
    assert (got.predicted == got[column]).mean() >= least


def test_held_out_labels_are_never_seen(spark, labels):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(10)], "doc_id long, text string")
    from tamra.llm.samples import labelled
    used = labelled(docs, labels, "quality")
    assert not {int(t.split()[1]) for t in used.text} & {i for i in range(10) if zlib.crc32(str(i).encode()) % 3 == 1}


def test_offending_sentences_are_located(spark):
    neutral = "the day was long and the road was dry"
    sample = pd.DataFrame({"text": [f"{neutral}. {neutral} {'nasty' if i % 2 else 'kind'} {i}. {neutral}" for i in range(80)], "label": [i % 2 for i in range(80)]})
    weights = toxicity.fit(sample)
    frame = spark.createDataFrame([(1, f"{neutral}. so nasty it was! {neutral}"), (2, neutral), (3, None)], "doc_id long, text string")
    hits = toxicity.offending(frame, weights).toPandas()
    assert hits.doc_id.tolist() == [1] and "nasty" in hits.sentence[0]
    said = f"{neutral}. so nasty it was! {neutral}".encode()
    assert said[hits.first_byte[0]:hits.first_byte[0] + hits.n_bytes[0]].decode() == hits.sentence[0]


def test_line_labels_use_neighbours(spark):
    good, bad = "A plain line of words that says a thing.", "$$$ BUY!! NOW!! $$$ ||| $$$"
    sample = pd.DataFrame({"text": ["\n".join([good] * 4), "\n".join([bad] * 4)] * 30, "label": [1, 0] * 30})
    model = quality.fit(sample)
    frame = spark.createDataFrame([(1, "\n".join([good] * 5)), (2, "\n".join([bad] * 5)), (3, "")], "doc_id long, text string")
    scores = dict(quality.score(frame, model).collect())
    assert scores[1] > 0.8 > 0.2 > scores[2]
    assert quality.line_labels(frame, model).where("doc_id = 1").count() == 5


# --- 10 top-k search

@pytest.mark.parametrize("dim,n,shard_rows", [(3, 300, 40), (8, 120, 1000)])
def test_top_k_equals_brute_force(spark, monkeypatch, dim, n, shard_rows):
    rng = np.random.default_rng(dim)
    vectors = [(i, rng.integers(-3, 4, dim).astype(float).tolist(), "x", 1) for i in range(n)]
    vectors += [(n, None, "x", 1), (n + 1, [], "x", 1), (n + 2, [1.0] * (dim + 1), "x", 1), (n + 3, [float("nan")] * dim, "x", 1),
                (n + 4, [None] * dim, "x", 1), (None, [1.0] * dim, "x", 1), (n + 5, [float("inf")] * dim, "x", 1), (n + 6, [1e9] * dim, "x", 1)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, id string, shard int")
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(kdtree, "QUERY_ROWS", 7)
    got = kdtree.top_k(frame, F.col("vec_id") % 5 == 0, 4, scale=1.0).toPandas()
    usable = [(i, [int(x) for x in np.array(v, np.float32)]) for i, v, *_ in vectors if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    for i, q in usable:
        if i % 5:
            continue
        near = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i and len(v) == len(q))[:4]
        mine = got[got.query_id == i].sort_values("rank")
        assert list(zip(-mine.score, mine.vec_id)) == near
    assert kdtree.top_k(frame.limit(0), F.col("vec_id") % 5 == 0).count() == 0


# --- pipeline

def test_pipeline_stages_take_odd_rows(spark, odd, empty, labels, tmp_path):
    odd.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (odd, empty):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, str(tmp_path)).columns == docs.columns
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    kept = corpus_pipeline.drop_near_copies(spark, odd, str(tmp_path)).toPandas()
    assert sorted(kept.doc_id.dropna().astype(int)) == [0, 1, 2, 3, 3, 5, 6, 7, 8, 9] and kept.doc_id.isna().sum() == 2


@pytest.mark.parametrize("name", [n for n in QUERIES if QUERIES[n].sql])
def test_queries_agree_with_sql(spark, name):
    import duckdb
    connection = duckdb.connect()
    for table in ("pages", "embeddings"):
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    got, want = QUERIES[name].run(spark, SF).toPandas(), connection.execute(QUERIES[name].sql).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    as_text = lambda f: sorted(map(tuple, f[columns].astype(object).where(f[columns].notna(), None).astype(str).values))
    assert as_text(got) == as_text(want)
