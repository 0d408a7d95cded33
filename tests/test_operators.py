import random

from pyspark.sql import functions as F

from tamra.functions import calendar
from tamra.functions.personal import card_ok, ip_ok, thai_id_ok
from tamra.operators import chat, chunk, dedup, evaluate, ordering, pii, retrieve, shape, tokens
from tamra.streaming import streams


def test_row_numbers_and_running_sums_agree_with_one_window(spark):
    rng = random.Random(5)
    rows = [(i * 17 % 1009, "hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", rng.randrange(9)) for i in range(1000)]
    df = spark.createDataFrame(rows, "id bigint, k string, v bigint")
    got = {r.id: (r.rn, r.before) for r in ordering.running(
        ordering.rank_by_value(df, "id", ["k"], buckets=16), F.col("v"), "id", ["k"], buckets=16).collect()}
    seen = {}
    for i, k, v in sorted(rows):
        n, total = seen.get(k, (0, 0))
        assert got[i] == (n + 1, total)
        seen[k] = (n + 1, total + v)


def test_interleave_restarts_short_sources(spark):
    rows = [(0, i) for i in range(5)] + [(1, 100), (1, 101)]
    out = shape.interleave(spark.createDataFrame(rows, "source_ord int, doc_id bigint")).orderBy("pos").collect()
    assert [r.pos for r in out] == list(range(10))
    assert [r.doc_id for r in out] == [0, 100, 1, 101, 2, 100, 3, 101, 4, 100]


def test_pack_keeps_order_and_loses_less_than_a_block(spark):
    rng = random.Random(1)
    docs, flat, at = [], [], 0
    for i in range(60):
        n = rng.choice([1, 3, 8, 40])
        ids = list(range(at, at + n))
        at += n
        flat += ids
        docs.append((i, n, ids))
    df = spark.createDataFrame(docs, "doc_id bigint, n_tokens int, input_ids array<int>")
    blocks = tokens.pack(df, 8).orderBy("block_id").collect()
    joined = [x for b in blocks for x in b.input_ids]
    assert joined == flat[: len(flat) // 8 * 8]
    assert all(b.labels == b.input_ids for b in blocks)


def test_tokenise_by_lookup_and_by_join_agree(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b a."), (2, "unknownword b"), (3, "")], "doc_id bigint, text string")
    vocab = tokens.build_vocab(docs.filter("doc_id = 1"), 10)
    fast = sorted(map(tuple, tokens.tokenise(docs, vocab).collect()))
    monkeypatch.setattr(tokens, "MAX_LOOKUP", 0)
    assert sorted(map(tuple, tokens.tokenise(docs, vocab).collect())) == fast


def test_numbers_with_check_digits(spark):
    row = spark.range(1).select(
        thai_id_ok(F.lit("1-1017-00230-70-8")), thai_id_ok(F.lit("1101700230709")), card_ok(F.lit("4111 1111 1111 1111")),
        card_ok(F.lit("4111 1111 1111 1112")), ip_ok(F.lit("300.1.1.1")), ip_ok(F.lit("10.0.0.255"))).first()
    assert tuple(row) == (True, False, True, False, False, True)


def test_redaction_leaves_nothing_to_detect(spark):
    text = "mail a.b@c.de or 4111 1111 1111 1111, tel 081-234-5678, host 10.1.2.3, id 1101700230708"
    df = spark.createDataFrame([(1, text), (2, "nothing here")], "doc_id bigint, text string")
    assert pii.pii_hits(df).count() == 5
    for hit in pii.raw_spans(df).collect():
        assert text[hit.start:hit.end] == hit.value
    clean = pii.redact(df)
    assert {r.n_leaks for r in pii.leak_check(clean).collect()} == {0}
    assert clean.filter("doc_id = 2").first().text == "nothing here"
    hashed = pii.redact(df, "hash", "s").first().text
    assert hashed == pii.redact(df, "hash", "s").first().text and "a.b@c.de" not in hashed


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * 2 + str(rng.randrange(50)) for _ in range(60)) for _ in range(6)]
    texts = base + [b + " tail" for b in base] + [base[0]] * 20 + [base[0] + f" x{i}" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")

    def shingles(t):
        w = t.split()
        return {" ".join(w[i:i + 3]) for i in range(len(w) - 2)}

    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.7:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    pairs = dedup.minhash_pairs(df)
    assert pairs.filter("jaccard < 0.7").isEmpty()
    got = {r.doc_id: r.cluster_id for r in dedup.dedup_clusters(pairs, df.select("doc_id")).collect()}
    assert got == {i: root(i) for i in range(len(texts))}


def test_long_chain_is_one_component(spark):
    pairs = spark.createDataFrame([(i, i + 1) for i in range(40)], "leader bigint, member bigint")
    assert {r.cluster_id for r in dedup.components(pairs).collect()} == {0}


def test_exact_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(1, "A  b"), (2, "a b"), (3, "c")], "doc_id bigint, text string")
    once = dedup.exact_dedup(df).drop("n_copies")
    assert sorted(r.doc_id for r in once.collect()) == [1, 3]
    assert dedup.exact_dedup(once).count() == 2


def test_exact_dedup_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(None, "a b c"), (1, "a b c"), (2, None), (2, "x"), (2, "x"), (None, "y")], "doc_id bigint, text string")
    assert sorted(map(repr, map(tuple, dedup.exact_dedup(df).collect()))) == sorted(map(repr, [(1, "a b c", 2), (2, None, 1), (2, "x", 2), (None, "y", 1)]))


def test_preference_pairs_are_all_ordered_pairs(spark):
    ranked = spark.createDataFrame([(1, "a", 1), (1, "b", 3), (1, "c", 3), (1, "d", 7), (2, "e", 1), (1, "f", None)], "prompt_id int, answer_id string, rank int")
    got = sorted((r.chosen, r.rejected) for r in evaluate.preference_pairs(ranked).collect())
    assert got == [("a", "b"), ("a", "c"), ("a", "d"), ("b", "d"), ("c", "d")]


def test_whole_names_are_redacted(spark):
    said = ["Dr. Jane Smith called", "คุณสมชาย ใจดี 5", "Mr. X. is short", "Mrs. Ann went"]
    got = pii.redact(spark.createDataFrame(list(enumerate(said)), "doc_id int, text string"), kinds=["NAME"]).orderBy("doc_id").collect()
    assert [r.text for r in got] == ["<NAME> called", "<NAME> 5", "Mr. X. is short", "<NAME> went"]


def test_a_late_old_version_loses(spark, tmp_path):
    table = str(tmp_path / "table")
    empty = spark.createDataFrame([], "doc_id long, text string, version int, content_sha string, changed boolean")
    empty.write.parquet(f"{table}/batch=-1")
    write = streams.upsert_batch(table)
    batches = [[(1, "a", 1), (2, "p", 1), (2, "q", 1)], [(1, "b", 5)], [(1, "c", 3)], [(2, "q", 4), (2, "p", 4)], [(2, "z", 2)]]
    for i, rows in enumerate(batches):
        write(spark.createDataFrame(rows, "doc_id long, text string, version int"), i)
    write(spark.createDataFrame(batches[-1], "doc_id long, text string, version int"), len(batches) - 1)  # tried again
    got = {r.doc_id: (r.text, r.version) for r in streams.current(spark.read.parquet(table)).collect()}
    assert got[1] == ("b", 5)
    assert got[2][0] in ("p", "q") and len(got) == 2


def test_segmentation_by_pattern_and_by_join_agree(spark):
    words = spark.createDataFrame([("ตา",), ("ตาก",), ("กลม",), ("ลม",), ("นาน",)], "word string")
    df = spark.createDataFrame([(1, "ตากลม abc ตาขขกลมนาน๑๒"), (2, ""), (3, "no thai")], "doc_id bigint, text string")
    fast = {r.doc_id: r.tokens for r in chunk.segment(df, words).collect()}
    assert fast[1] == ["ตาก", "ลม", "abc", "ตา", "ขข", "กลม", "นาน", "๑๒"]
    assert fast == {r.doc_id: r.tokens for r in chunk.segment_by_join(df, words).collect()}


def test_chunks_overlap_and_carry_offsets(spark):
    text = "  " + " ".join(f"w{i}," for i in range(30)) + " "
    df = spark.createDataFrame([(1, text, False), (2, "  ", True)], "doc_id bigint, text string, sanitized boolean")
    rows = chunk.chunk(df, 20, 0.2).orderBy("chunk_no").collect()
    assert [r.n_tokens for r in rows] == [20, 20, 20, 12]
    assert all(text[r.start:r.end] == r.text and r.sanitized is False for r in rows)
    assert rows[0].end > rows[1].start


def test_calendar(spark):
    cases = {"๑ มกราคม ๒๕๖๗": ("2024-01-01", "day"), "พ.ศ. 2567": ("2024-01-01", "year"), "2024-02-30": (None, None),
             "มี.ค. 67": (None, None), "2024-05-06": ("2024-05-06", "day"), "06/05/2567": ("2024-05-06", "day"),
             "มิ.ย. 2566": ("2023-06-01", "month"), "ค.ศ. 2500": ("2500-01-01", "year"), "พ.ศ. 2567 ค.ศ. 2024": (None, None)}
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", calendar.parse_date(F.col("t")).alias("d"))
    assert {r.t: (r.d.ce_date and r.d.ce_date.isoformat(), r.d.precision) for r in df.collect()} == cases


def test_as_of_when_times_disagree(spark):
    facts = spark.createDataFrame([
        ("p", "10", "2024-01-01", "2024-03-01", "2024-01-01", "2024-02-10"), ("p", "12", "2024-01-01", "2024-03-01", "2024-02-10", None),
        ("p", "15", "2024-03-01", None, "2024-03-05", None)],
        "key string, value string, valid_from string, valid_to string, sys_from string, sys_to string")
    facts = facts.select("key", "value", *[F.col(c).cast("timestamp").alias(c) for c in ("valid_from", "valid_to", "sys_from", "sys_to")])
    asked = [(1, "2024-01-15", "2024-02-01"), (2, "2024-01-15", "2024-02-20"), (3, "2024-03-02", "2024-03-04"), (4, "2024-03-02", "2025-01-01"),
             (5, "2023-12-31", "2025-01-01"), (6, "2090-01-01", "2091-01-01")]
    queries = spark.createDataFrame(asked, "query_id int, v string, k string").select(
        "query_id", F.lit("p").alias("key"), F.col("v").cast("timestamp").alias("valid_at"), F.col("k").cast("timestamp").alias("known_at"))
    got = {r.query_id: r.value for r in retrieve.as_of(queries, facts).collect()}
    assert got == {1: "10", 2: "12", 3: None, 4: "15", 5: None, 6: "15"}


def test_dense_search_in_blocks(spark):
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(50)]
    queries = spark.createDataFrame(rows, "query_id bigint, embedding array<float>")
    vectors = queries.select(F.col("query_id").cast("string").alias("chunk_id"), "embedding")
    whole = sorted(map(tuple, retrieve.dense_topk(queries, vectors, 4).collect()))
    assert whole == sorted(map(tuple, retrieve.dense_topk(queries, vectors, 4, block=8).collect()))


def test_ranking_scores(spark):
    ranked = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "x", 1)], "query_id bigint, chunk_id string, rank int")
    truth = spark.createDataFrame([(1, "b"), (1, "z"), (2, "y")], "query_id bigint, chunk_id string")
    rows = {r.query_id: r for r in evaluate.retrieval_at_k(ranked, truth, 10).collect()}
    assert (rows[1].recall, rows[1].rr, rows[2].recall, rows[2].ndcg) == (0.5, 0.5, 0.0, 0.0)


def conversation(spark, rows):
    return spark.createDataFrame(rows, f"conv_id bigint, turn bigint, role string, text string, reasoning string, tool_calls {chat.CALL_TYPE}, "
                                       f"tool_call_id string, name string, parts {chat.PART_TYPE}")


def test_render_tools_and_thinking(spark):
    call = [("c1", "find", '{"b": [1, true], "A": "x"}')]
    rows = [
        (1, 0, "system", " be kind ", None, None, None, None, None), (1, 1, "user", "hi", None, None, None, None, None),
        (1, 2, "assistant", "", "why", call, None, None, None), (1, 3, "tool", "42", None, None, "c1", None, None),
        (1, 4, "assistant", "<|channel>thought\nz<channel|>done", None, None, None, None, None),
        (2, 0, "user", None, None, None, None, None, [("text", " look "), ("image", None)]), (2, 1, "assistant", "", None, call, None, None, None)]
    text = {r.conv_id: r.text for r in chat.render(conversation(spark, rows), generation_prompt=True).collect()}
    assert text[1] == (
        "<bos><|turn>system\nbe kind<turn|>\n<|turn>user\nhi<turn|>\n<|turn>model\n<|channel>thought\nwhy\n<channel|>"
        '<|tool_call>call:find{A:<|"|>x<|"|>,b:[1,true]}<tool_call|><|tool_response>response:find{value:<|"|>42<|"|>}<tool_response|>'
        "done<turn|>\n<|turn>model\n")
    assert text[2] == ("<bos><|turn>user\nlook<|image|><turn|>\n<|turn>model\n"
                       '<|tool_call>call:find{A:<|"|>x<|"|>,b:[1,true]}<tool_call|><|tool_response>')


def test_tool_declaration(spark):
    tool = {"function": {"name": "f", "description": "d", "parameters": {"type": "object", "required": ["q"], "properties": {
        "q": {"type": "string", "description": "what", "enum": ["a", "b"]}, "n": {"type": "array", "items": {"type": "integer"}, "nullable": True}}}}}
    q = '<|"|>'
    assert chat.declare_tool(tool) == (
        f"<|tool>declaration:f{{description:{q}d{q},parameters:{{properties:{{n:{{items:{{type:{q}INTEGER{q}}},nullable:true,type:{q}ARRAY{q}}},"
        f"q:{{description:{q}what{q},enum:[{q}a{q},{q}b{q}],type:{q}STRING{q}}}}},required:[{q}q{q}],type:{q}OBJECT{q}}}}}<tool|>")


def test_parse_responses(spark):
    raw = ["plain answer<turn|>tail", "<|channel>thought\nhm<channel|>yes", '<|tool_call>call:f{a:1}<tool_call|><|tool_call>call:g{}<tool_call|><|tool_response>']
    df = spark.createDataFrame(list(enumerate(raw)), "i int, completion string")
    rows = chat.parse_responses(df).orderBy("i").collect()
    assert (rows[0].content, rows[1].thinking, rows[1].content, rows[2].content) == ("plain answer", "hm", "yes", "")
    assert [(c.name, c.arguments) for c in rows[2].tool_calls] == [("f", "{a:1}"), ("g", "{}")]
