"""Retrieval as batch jobs: a table of queries in, ranked rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.functions.text import PLAIN, Rules, let, ngrams, words
from tamra.operators.index import Dealt, bm25_weight, corpus_size, matched, term_statistics
from tamra.operators.ordering import following
from tamra.operators.search import BLOCK, SHARD, nearest, top
from tamra.session import cut

RRF = 60
ASKED = 500_000  # terms of queries that are sent to every task at once
CELLS = 1_000_000  # scores, and postings met with queries, that a task holds at once


def dense_topk(queries: DataFrame, vectors: DataFrame, k: int, where: Column | None = None,
               block: int = BLOCK, shard: int = SHARD, places: int = 6) -> DataFrame:
    """Exact cosine top-k: ``query_id, chunk_id, score, rank``.

    Every query meets every vector, ``block`` queries with ``shard`` vectors at a time, and only rows
    that reach the kth score so far leave a task. ``where`` filters vectors before the search.
    """
    base = vectors if where is None else vectors.filter(where)
    found = nearest(queries.select("query_id", "embedding"), base.select(F.col("chunk_id").alias("item"), "embedding"),
                    k, places=places, block=block, shard=shard)
    return found.withColumnRenamed("item", "chunk_id")


def nearest_cells(queries: DataFrame, cells: DataFrame, nprobe: int, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """``query_id, embedding, cell``: the ``nprobe`` cells with the closest centroids, of a table of any size."""
    asked = queries.select("query_id", "embedding")
    closest = nearest(asked, cells.select(F.col("cell").alias("item"), F.col("centroid").alias("embedding")), nprobe, "distance", 9, block, shard)
    return asked.join(closest.select("query_id", F.col("item").alias("cell")), "query_id")


def ann_topk(queries: DataFrame, vectors: DataFrame, cells: DataFrame, k: int, nprobe: int, places: int = 6,
             block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Approximate top-k: only the vectors of the ``nprobe`` closest cells are scored; a large cell is met in shards."""
    probes = cut(nearest_cells(queries, cells, nprobe, block, shard))  # read for the sizes and for the search
    found = nearest(probes, vectors.select(F.col("chunk_id").alias("item"), "cell", "embedding"), k, places=places, block=block, shard=shard)
    return found.withColumnRenamed("item", "chunk_id")


def query_terms(queries: DataFrame, rules: Rules = PLAIN) -> DataFrame:
    found = F.array_distinct(words(F.col("text"), rules))
    return queries.select("query_id", F.explode_outer(found).alias("term")).filter("term IS NOT NULL")


def bm25_topk(queries: DataFrame, postings: DataFrame, k: int, where: Column | None = None, places: int = 6,
              rules: Rules = PLAIN, chunks: Dealt | None = None) -> DataFrame:
    """Lexical top-k: ``query_id, chunk_id, score, rank``. Statistics are those of the whole table of postings, built by the same ``rules``.

    They are taken from the ``dealt`` chunks the postings are made of, if those are given. The terms of ``ASKED`` queries' rows at a time go to every task with their statistics. Postings of
    ``dealt`` chunks are scored where they lie, and only the best ``k`` of each task are shuffled.
    """
    n, mean = corpus_size(postings) if chunks is None else chunks.size
    terms = cut(query_terms(queries, rules))
    statistics = term_statistics(postings) if chunks is None else chunks.statistics
    asked = cut(terms.join(statistics, "term").select("query_id", "term", "df"))
    base = postings if where is None else postings.filter(where)
    blocks = max(1, -(-asked.count() // ASKED))
    if chunks is not None and chunks.once and where is None:
        found = [_scored(chunks, asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b), n, mean, k, places) for b in range(blocks)]
        return top(reduce(DataFrame.unionByName, found), k)

    def block(b: int) -> DataFrame:
        of_block = asked.filter(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == b)
        weights = base.join(F.broadcast(of_block), "term").select("query_id", "chunk_id", bm25_weight(n, mean).alias("w"))
        return top(weights.groupBy("query_id", "chunk_id").agg(F.round(F.sum("w"), places).alias("score")), k)

    return reduce(DataFrame.unionByName, [block(b) for b in range(blocks)])


def _scored(chunks: Dealt, asked: DataFrame, n: int, mean: float, k: int, places: int, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """``query_id, chunk_id, score``: of each task the ``k`` best chunks for each query, by the terms of ``asked`` (``query_id, term, df``)."""
    table = asked.toArrow().combine_chunks()  # about ``ASKED`` rows
    query, term = (table.column(c).combine_chunks().dictionary_encode(null_encoding="encode") for c in ("query_id", "term"))
    order = np.argsort(term.indices.to_numpy(), kind="stable")
    of_term = np.searchsorted(term.indices.to_numpy()[order], np.arange(len(term.dictionary) + 1))  # the queries of a term lie side by side
    df = np.ones(len(term.dictionary))
    df[term.indices.to_numpy()] = table.column("df").to_numpy()
    idf = np.log((n - df + 0.5) / (df + 0.5) + 1) * (k1 + 1)
    sent = asked.sparkSession.sparkContext.broadcast((query.dictionary, term.dictionary, query.indices.to_numpy()[order].astype(np.int64), of_term, idf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, terms, asking, begins, idf = sent.value
        many = len(queries)
        best = Best(k, many)
        for batch in batches if many else ():
            row, at, tf = matched(batch.column(2), batch.column(3), terms)
            norm = k1 * (1 - b + b * batch.column(1).to_numpy() / mean)
            weight = idf[at] * tf / (tf + norm[row])
            each = begins[at + 1] - begins[at]
            ends = np.cumsum(np.bincount(row, weights=each, minlength=batch.num_rows)).astype(np.int64)
            first = 0
            while first < batch.num_rows:  # rows whose scores, and whose postings met with queries, fit into arrays of bounded size
                before = int(ends[first - 1]) if first else 0
                last = max(first + 1, min(first + max(1, CELLS // many), int(np.searchsorted(ends, before + CELLS, "right"))))
                some = slice(*np.searchsorted(row, (first, last)))
                times = each[some]
                start = np.repeat(begins[at[some]] - (np.cumsum(times) - times), times)
                cell = np.repeat((row[some] - first) * many, times) + asking[start + np.arange(len(start))]
                scores = np.bincount(cell, weights=np.repeat(weight[some], times), minlength=(last - first) * many)
                best.add(scores.reshape(-1, many), batch.column(0).slice(first, last - first), places)
                first = last
        if len(best.score):
            yield pa.RecordBatch.from_arrays([queries.take(pa.array(best.query)), pa.concat_arrays(best.names), pa.array(best.score)],
                                             names=["query_id", "chunk_id", "score"])

    kind = asked.schema["query_id"].dataType.simpleString()
    rows = chunks.rows.where("doc_len > 0").select("chunk_id", "doc_len", "terms", "tfs")
    return rows.mapInArrow(run, f"query_id {kind}, chunk_id {chunks.kind}, score double")


class Best:
    """The ``k`` best items of each of ``many`` queries so far: ``query``, ``names`` and ``score``; ties by name, null first."""

    def __init__(self, k: int, many: int) -> None:
        self.k, self.least = k, np.zeros(many)
        self.query, self.score, self.names = np.zeros(0, np.int64), np.zeros(0), []

    def add(self, scores: np.ndarray, names: pa.Array, places: int) -> None:
        """``scores`` has a row for each of ``names`` and a column for each query; 0 is no match."""
        matches = scores > 0
        scores = np.round(scores, places)
        row, query = np.nonzero(matches & (scores >= self.least))
        if not len(row):
            return
        held = pa.concat_arrays([*self.names, names.take(pa.array(row))])
        query, score = np.concatenate([self.query, query]), np.concatenate([self.score, scores[row, query]])
        coded = held.dictionary_encode(null_encoding="encode")
        rank = pc.rank(coded.dictionary, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy()[coded.indices.to_numpy()]
        order = np.lexsort((rank, -score, query))
        place = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        keep = order[place < self.k]
        full = order[place == self.k - 1]
        self.least[query[full]] = score[full]
        self.query, self.score, self.names = query[keep], score[keep], [held.take(pa.array(keep))]


def hybrid(dense: DataFrame, sparse: DataFrame, k: int, places: int = 9) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists."""
    a = dense.select("query_id", "chunk_id", F.col("rank").alias("_r1"))
    b = sparse.select("query_id", "chunk_id", F.col("rank").alias("_r2"))
    part = [F.coalesce(F.lit(1.0) / (F.lit(RRF) + F.col(c)), F.lit(0.0)) for c in ("_r1", "_r2")]
    fused = a.join(b, ["query_id", "chunk_id"], "full").select("query_id", "chunk_id", F.round(part[0] + part[1], places).alias("score"))
    return top(fused, k)


def rerank(candidates: DataFrame, queries: DataFrame, chunks: DataFrame, n: int,
           score: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Second stage: top-k in, top-n out, by ``score(query_text, chunk_text)``.

    Default: share of the query's words and of its word pairs found in the chunk. A model plugs
    in as a pandas function with the same two arguments.
    """
    texts = candidates.select("query_id", "chunk_id").join(
        queries.select("query_id", F.col("text").alias("_q")), "query_id").join(
        chunks.select("chunk_id", F.col("text").alias("_c")), "chunk_id")
    scored = texts.select("query_id", "chunk_id", F.round((score or coverage)(F.col("_q"), F.col("_c")), 6).alias("score"))
    return top(scored, n)


def coverage(query: Column, text: Column) -> Column:
    def both(w: Column) -> Column:
        def share(wanted: Column, given: Column) -> Column:
            return F.when(F.size(wanted) > 0, F.size(F.array_intersect(wanted, given)) / F.size(F.array_distinct(wanted))).otherwise(0.0)
        return share(w["q"], w["c"]) + share(ngrams(w["q"], 2), ngrams(w["c"], 2))

    return let(F.struct(words(query).alias("q"), words(text).alias("c")), both)


def assemble(ranked: DataFrame, chunks: DataFrame, budget: int) -> DataFrame:
    """``query_id, n_chunks, n_tokens, context``: best chunks first while they fit into ``budget`` tokens, each cited.

    A query whose best chunk does not fit keeps its row, with an empty context.
    """
    texts = ranked.select("query_id", "chunk_id", "rank").join(
        chunks.select("chunk_id", "text", "n_tokens", "source", "start", "end"), "chunk_id")
    order = W.partitionBy("query_id").orderBy("rank")
    fitting = texts.withColumn("_total", F.sum("n_tokens").over(order.rowsBetween(W.unboundedPreceding, 0))).filter(F.col("_total") <= budget)
    cite = F.format_string("[%d] %s:%d-%d ", F.col("rank"), F.col("source"), F.col("start"), F.col("end"))
    made = fitting.withColumn("_line", F.concat(cite, F.col("text"))).groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_chunks"), F.sum("n_tokens").alias("n_tokens"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "_line"))), lambda x: x["_line"]), "\n").alias("context"))
    return (ranked.select("query_id").distinct().join(made, "query_id", "left")
            .na.fill(0, ["n_chunks", "n_tokens"]).na.fill("", ["context"]))


def filtered_search(queries: DataFrame, vectors: DataFrame, k: int, where: Column, when: str = "before") -> DataFrame:
    """Dense search with a condition on the payload, applied before or after the ranking.

    ``before`` reaches the scan (pushed filters, pruned partitions); ``after`` ranks all and drops
    what does not match, so fewer than ``k`` rows may be left.
    """
    if when == "before":
        return dense_topk(queries, vectors, k, where)
    ranked = dense_topk(queries, vectors, k)
    return ranked.join(vectors.filter(where).select("chunk_id"), "chunk_id", "left_semi")


def refusal_flag(queries: DataFrame, ranked: DataFrame, threshold: float) -> DataFrame:
    """``query_id, best_score, refuse``: no candidate, or the best one scores below ``threshold``."""
    best = ranked.groupBy("query_id").agg(F.max("score").alias("best_score"))
    return queries.select("query_id").join(best, "query_id", "left").withColumn(
        "refuse", F.coalesce(F.col("best_score") < threshold, F.lit(True)))


# Rules that tag a query.
QUERY_RULES = (
    ("date", r"(?i)\b(?:date|when|year|month)\b|\b(?:19|20|25)\d\d\b|พ\.ศ\.|ค\.ศ\.|วันที่|ปี"),
    ("as_of", r"(?i)\bas of\b|\bas at\b|\bback then\b|ณ วันที่"),
    ("count", r"(?i)\bhow many\b|\bnumber of\b|\bcount\b|\btotal\b|กี่|จำนวน"),
    ("thai", r"[\x{0E00}-\x{0E7F}]"),
)


def tag_queries(queries: DataFrame) -> DataFrame:
    """Add ``tags``: every rule that matches, or ``lookup``."""
    found = F.array_compact(F.array(*[F.when(F.regexp_like("text", F.lit(p)), tag) for tag, p in QUERY_RULES]))
    return queries.withColumn("tags", F.when(F.size(found) > 0, found).otherwise(F.array(F.lit("lookup"))))


def count_answers(facts: DataFrame, by: Sequence[str], where: Column | None = None, value: str | None = None) -> DataFrame:
    """Counting answers, computed: rows (and a sum) per group."""
    base = facts if where is None else facts.filter(where)
    sums = [F.count(F.lit(1)).alias("n")] + ([F.sum(value).alias("total")] if value else [])
    return base.groupBy(*by).agg(*sums)


# Phrases that try to steer a model from inside a text.
INJECTION_PATTERNS = (
    ("override", r"(?i)\b(?:ignore|disregard|forget)\b(?s:.){0,40}\b(?:previous|above|prior|all)\b(?s:.){0,20}\b(?:instruction|rule|prompt)s?"),
    ("exfiltrate", r"(?i)\b(?:reveal|print|show|repeat)\b(?s:.){0,40}\b(?:system prompt|hidden|password|secret|token)"),
    ("tool", r"(?i)\b(?:call|run|execute|invoke)\b(?s:.){0,20}\b(?:tool|function|command|shell)\b"),
    ("role_play", r"(?i)\b(?:you are now|pretend to be|act as|roleplay)\b"),
    ("markup", r"<\|[a-z_]+>|<[a-z_]+\|>"),
)


def injection_scan(df: DataFrame, key: str, text: str = "text", patterns: Sequence[tuple[str, str]] = INJECTION_PATTERNS) -> DataFrame:
    """``key, kind, n_matches`` for every pattern that matches; one pass over the text."""
    counts = F.array(*[F.struct(F.lit(kind).alias("kind"), F.regexp_count(text, F.lit(p)).alias("n_matches")) for kind, p in patterns])
    return df.select(key, F.inline(counts)).filter("n_matches > 0")


def injection_by_conversation(turns: DataFrame) -> DataFrame:
    """Matches over the turns of a conversation: kinds, turns hit, and whether they spread over turns."""
    hits = injection_scan(turns.withColumn("_key", F.struct("conv_id", "turn")), "_key")
    return hits.groupBy(F.col("_key.conv_id").alias("conv_id")).agg(
        F.sum("n_matches").alias("n_matches"), F.count_distinct("_key.turn").alias("n_turns"),
        F.count_distinct("kind").alias("n_kinds")).withColumn("across_turns", F.col("n_turns") > 1)


def as_of(queries: DataFrame, facts: DataFrame, keep: Sequence[str] = ("query_id",)) -> DataFrame:
    """The fact of ``key`` valid at ``valid_at`` as known at ``known_at``; null ends are open.

    A join on the key alone would pair every query with every version of a hot key. Each validity
    interval is therefore cut into aligned spans of 1, 2, 4, ... days (at most two per length), and
    each query looks up the one span of every length that holds its day: an equi-join on
    (key, length, span) in which a hot key is spread over time. Days count from the earliest to
    the latest one in either table, so every date is inside; the facts are read once.
    """
    day = "bigint"

    def number(ts: Column) -> Column:
        return F.unix_date(ts.cast("date")).cast(day)

    asked_days = queries.agg(F.min(number(F.col("valid_at"))), F.max(number(F.col("valid_at")))).first()
    if asked_days[0] is None:
        return queries.select(*keep, "key").withColumn("value", F.lit(None).cast(facts.schema["value"].dataType))
    first, far = asked_days[0], asked_days[1] - asked_days[0] + 1  # a fact matters only where a query asks
    levels = max(far - 1, 1).bit_length()
    whole = 1 << levels

    def inside(n: Column) -> Column:
        return F.greatest(F.lit(0).cast(day), F.least(F.lit(whole).cast(day), n - F.lit(first)))

    begin = inside(number(F.col("valid_from")))
    end = F.when(F.col("valid_to").isNull(), F.lit(whole).cast(day)).otherwise(inside(number(F.col("valid_to")) + 1))

    def spans(level: int) -> Column:
        a = F.ceil(F.col("_a") / (1 << level)).cast(day)
        b = F.floor(F.col("_b") / (1 << level)).cast(day)
        left = F.when((a < b) & (a % 2 == 1), F.struct(F.lit(level).alias("level"), a.alias("span")))
        right = F.when((a < b) & (b % 2 == 1), F.struct(F.lit(level).alias("level"), (b - 1).alias("span")))
        return F.array(left, right)

    every = F.array_compact(F.flatten(F.array(*[spans(level) for level in range(levels + 1)])))
    placed = facts.withColumn("_a", begin).withColumn("_b", end).filter("_a < _b").withColumn("_s", F.explode(F.array_distinct(every)))
    placed = placed.select("key", "value", "valid_from", "valid_to", "sys_from", "sys_to", "_s.level", "_s.span")
    asked = queries.withColumn("_day", number(F.col("valid_at")) - F.lit(first)).withColumn(
        "level", F.explode(F.array(*[F.lit(i) for i in range(levels + 1)])))
    asked = asked.withColumn("span", F.floor(F.col("_day") / F.pow(F.lit(2), F.col("level"))).cast(day))
    met = asked.join(placed, ["key", "level", "span"]).filter(
        (F.col("valid_from") <= F.col("valid_at")) & (F.col("valid_to").isNull() | (F.col("valid_at") < F.col("valid_to")))
        & (F.col("sys_from") <= F.col("known_at")) & (F.col("sys_to").isNull() | (F.col("known_at") < F.col("sys_to"))))
    best = met.groupBy(*keep).agg(F.max_by("value", F.struct("sys_from", "valid_from", "value")).alias("value"))
    return queries.select(*keep, "key").join(best, list(keep), "left")


def to_intervals(events: DataFrame) -> DataFrame:
    """``key, value, valid_from, valid_to`` from change events ``key, value, ts``; the last one stays open."""
    closed = following(events, "ts", ["ts", "value"], ["key"], out="valid_to")
    return closed.select("key", "value", F.col("ts").alias("valid_from"), "valid_to")
