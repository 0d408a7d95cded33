"""Vocabulary, tokens, packed blocks, accounting and perplexity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tamra.functions.text import PLAIN, Rules, surface_tokens, words
from tamra.operators.ordering import rank_by_value, running
from tamra.session import cut

# Ids kept for marks.
PAD, EOS, BOS, UNK = 0, 1, 2, 3
RESERVED = 4
MAX_LOOKUP = 1_000_000
SYMBOL_GAP = "  "


def build_vocab(df: DataFrame, size: int, rules: Rules = PLAIN) -> DataFrame:
    """``token, n, token_id``: the ``size`` most frequent tokens, ids by frequency after the reserved ones."""
    found = df.select(F.explode_outer(surface_tokens(F.col("text"), rules)).alias("token")).filter("token IS NOT NULL")
    counts = found.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    kept = counts.orderBy(F.desc("n"), "token").limit(size)  # bounded by ``size``, so one task may number it
    return kept.withColumn("token_id", (F.row_number().over(W.orderBy(F.desc("n"), "token")) + RESERVED - 1).cast("int"))


def _lookup(vocab: DataFrame):
    """An Arrow function from token arrays to id arrays; the vocabulary is bounded by ``MAX_LOOKUP``."""
    table = vocab.select("token", "token_id").toArrow()
    shared = vocab.sparkSession.sparkContext.broadcast(
        (table.column("token").to_pylist(), table.column("token_id").to_pylist()))

    @F.arrow_udf("array<int>")
    def ids(tokens):
        import pyarrow as pa
        import pyarrow.compute as pc

        names, numbers = shared.value
        lists = tokens.combine_chunks() if isinstance(tokens, pa.ChunkedArray) else tokens
        places = pc.index_in(lists.flatten(), value_set=pa.array(names, lists.type.value_type))
        flat = pc.fill_null(pc.take(pa.array(numbers, pa.int32()), places), UNK)
        sizes = pc.fill_null(pc.list_value_length(lists), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(sizes).cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, flat)

    return ids


def tokenise(df: DataFrame, vocab: DataFrame, keep: tuple[str, ...] = ("source",), rules: Rules = PLAIN) -> DataFrame:
    """``doc_id, n_tokens, input_ids`` with the end mark after each document; unknown tokens get ``UNK``.

    ``rules`` are those that built the vocabulary. A vocabulary of up to a million tokens is looked up batch-wise inside the scan task, without
    a shuffle. A larger one is joined.
    """
    kept = [c for c in keep if c in df.columns]
    vocab = cut(vocab.select("token", "token_id"))  # counted and then looked up; it may be made from the whole corpus
    split = df.select("doc_id", *kept, surface_tokens(F.col("text"), rules).alias("_tokens"))
    n_tokens = (F.size("_tokens") + 1).cast("int").alias("n_tokens")
    if vocab.limit(MAX_LOOKUP + 1).count() <= MAX_LOOKUP:
        ids = F.concat(_lookup(vocab)(F.col("_tokens")), F.array(F.lit(EOS)))
        return split.select("doc_id", *kept, n_tokens, ids.alias("input_ids"))
    rows = split.select("doc_id", F.posexplode("_tokens").alias("pos", "token"))
    found = rows.join(vocab.select("token", "token_id"), "token", "left").groupBy("doc_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("token_id", F.lit(UNK)).alias("id")))).alias("_ids"))
    ids = F.concat(F.coalesce(F.col("_ids.id"), F.array().cast("array<int>")), F.array(F.lit(EOS)))
    return split.join(found, "doc_id", "left").select("doc_id", *kept, n_tokens, ids.alias("input_ids"))


def tokenise_bytes(df: DataFrame) -> DataFrame:
    """UTF-8 bytes as ids, for text without a vocabulary."""
    pairs = F.regexp_extract_all(F.hex(F.encode("text", "UTF-8")), F.lit(".."), F.lit(0))
    ids = F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int") + RESERVED)
    return df.select("doc_id", F.concat(ids, F.array(F.lit(EOS))).alias("input_ids")).withColumn(
        "n_tokens", F.size("input_ids"))


def learn_bpe(df: DataFrame, rounds: int, cut_every: int = 8) -> DataFrame:
    """``merge_rank, left, right, n``: the most frequent neighbouring pair of each round, merged for the next.

    Works on distinct words with counts. A round is one aggregate over the pairs and brings one
    row to the driver.
    """
    counts = df.select(F.explode_outer(words(F.col("text"))).alias("w")).filter("w IS NOT NULL").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    # every symbol stands between blanks of its own, so a merge is a plain replacement
    spelled = F.concat(F.lit(" "), F.array_join(F.split("w", ""), SYMBOL_GAP), F.lit(" "))
    state = cut(counts.select(spelled.alias("s"), "n"))
    merges = []
    for rank in range(1, rounds + 1):
        symbols = state.select(F.split(F.trim("s"), SYMBOL_GAP).alias("a"), "n").filter(F.size("a") > 1)
        pairs = symbols.select(
            F.explode(F.zip_with(F.slice("a", F.lit(1), F.size("a") - 1), F.slice("a", F.lit(2), F.size("a") - 1),
                                 lambda x, y: F.struct(x.alias("left"), y.alias("right")))).alias("p"), "n")
        top = (pairs.groupBy("p.left", "p.right").agg(F.sum("n").alias("n"))
               .orderBy(F.desc("n"), "left", "right").limit(1).first())
        if top is None:
            break
        merges.append((rank, top["left"], top["right"], top["n"]))
        before = f" {top['left']}{SYMBOL_GAP}{top['right']} "
        state = state.withColumn("s", F.replace("s", F.lit(before), F.lit(f" {top['left']}{top['right']} ")))
        if rank % cut_every == 0:
            state = cut(state)
    return df.sparkSession.createDataFrame(merges, "merge_rank int, left string, right string, n bigint")


def pack(tokens: DataFrame, length: int, key: str | None = None, order: str = "doc_id") -> DataFrame:
    """``pack_key, block_id, input_ids, labels``: token lists end to end, cut into blocks of ``length``.

    The tail of each key (of the whole corpus for ``key=None``) is dropped. A block is put
    together from the pieces of the documents it overlaps, at most ``length`` tokens.
    """
    by = [] if key is None else [key]
    placed = running(tokens, F.col("n_tokens").cast("bigint"), order, by, out="_start")
    first, last = F.floor(F.col("_start") / length), F.floor((F.col("_start") + F.col("n_tokens") - 1) / length)

    def piece(block: Column) -> Column:
        begin = F.greatest(block * length - F.col("_start"), F.lit(0))
        end = F.least((block + 1) * length - F.col("_start"), F.col("n_tokens").cast("bigint"))
        return F.struct(block.alias("block_id"), (F.col("_start") + begin).alias("at"),
                        F.slice("input_ids", (begin + 1).cast("int"), (end - begin).cast("int")).alias("ids"))

    pieces = placed.filter("n_tokens > 0").select(
        *[F.col(c).alias("pack_key") for c in by], F.inline_outer(F.transform(F.sequence(first, last), piece)))
    keys = [*(["pack_key"] if by else []), "block_id"]
    blocks = pieces.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("_p"))
    return with_labels(blocks.select(*keys, F.flatten("_p.ids").alias("input_ids"))
                       .filter(F.size("input_ids") == length))


def pack_batches(tokens: DataFrame, length: int, batch: int = 1000, order: str = "doc_id") -> DataFrame:
    """Packing in batches of ``batch`` documents, each losing its own tail."""
    numbered = rank_by_value(tokens, order, out="_rn").withColumn("_batch", F.floor((F.col("_rn") - 1) / batch))
    return pack(numbered.drop("_rn"), length, "_batch", order)


def with_labels(blocks: DataFrame) -> DataFrame:
    """Labels are a copy of the inputs; the shift is the trainer's."""
    return blocks.withColumn("labels", F.col("input_ids"))


def next_token_pairs(blocks: DataFrame) -> DataFrame:
    """``context, target, n``: how often a token follows another inside a block."""
    ids = F.col("input_ids")
    pairs = blocks.select(F.explode(F.zip_with(
        F.slice(ids, F.lit(1), F.size(ids) - 1), F.slice(ids, F.lit(2), F.size(ids) - 1),
        lambda a, b: F.struct(a.alias("context"), b.alias("target")))).alias("p"))
    return pairs.groupBy("p.context", "p.target").agg(F.count(F.lit(1)).alias("n"))


def human(n: Column) -> Column:
    """Two decimals and a unit: 1234 is ``1.23K``."""
    value = n.cast("double")
    size = F.abs(value)
    result = F.when(size < 1e3, F.format_string("%.2f", value))
    for power, unit in ((1e3, "K"), (1e6, "M"), (1e9, "B"), (1e12, "T")):
        result = result.when(size < power * 1e3, F.format_string(f"%.2f{unit}", value / power))
    return result.otherwise(F.format_string("%.2fP", value / 1e15))


def token_report(tokens: DataFrame, length: int) -> DataFrame:
    """Documents, tokens, whole blocks and tokens in them, per source and in total (``source`` null)."""
    return tokens.rollup("source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("n_tokens").cast("bigint")).alias("n_tokens")
    ).withColumn("n_blocks", F.floor(F.col("n_tokens") / length)).withColumn(
        "packed_tokens", F.col("n_blocks") * length).withColumn("readable", human(F.col("packed_tokens")))


def perplexity(losses: DataFrame, order: str, batch: int = 4, most: int | None = 256) -> DataFrame:
    """``n_rows, mean_loss, perplexity``: exp of the mean of batch means over the first ``most`` rows."""
    rows = losses.select(order, "loss")
    if most is not None:
        rows = rows.orderBy(order).limit(most)
    ranked = rank_by_value(rows, order)
    batches = ranked.groupBy(F.floor((F.col("rn") - 1) / batch).alias("b")).agg(
        F.avg("loss").alias("m"), F.count(F.lit(1)).alias("n"))
    return batches.agg(F.sum("n").alias("n_rows"), F.avg("m").alias("mean_loss")).withColumn(
        "perplexity", F.exp("mean_loss"))


def _bigrams(df: DataFrame, *keep: str) -> DataFrame:
    tokens = df.select(*keep, words(F.col("text")).alias("w"))
    return tokens.select(*keep, F.inline_outer(F.zip_with(
        F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b"))))).filter("a IS NOT NULL")


def ngram_perplexity(train: DataFrame, validation: DataFrame, add_k: float = 0.1) -> DataFrame:
    """``doc_id, n_pairs, perplexity`` of validation texts under add-k bigram counts of the training texts."""
    pair_counts = _bigrams(train).groupBy("a", "b").agg(F.count(F.lit(1)).alias("n_ab"))
    pair_counts = cut(pair_counts)
    context = pair_counts.groupBy("a").agg(F.sum("n_ab").alias("n_a"))
    size = pair_counts.agg(F.count_distinct("b")).first()[0]  # one number
    wanted = _bigrams(validation, "doc_id").groupBy("doc_id", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    p = (F.coalesce("n_ab", F.lit(0)) + add_k) / (F.coalesce("n_a", F.lit(0)) + F.lit(add_k * size))
    scored = wanted.join(pair_counts, ["a", "b"], "left").join(context, "a", "left").withColumn("_log", F.log(p) * F.col("n"))
    return scored.groupBy("doc_id").agg(
        F.sum("n").alias("n_pairs"), F.exp(-F.sum("_log") / F.sum("n")).alias("perplexity"))
