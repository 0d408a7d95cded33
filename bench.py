"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma separated; ``all`` for every registered query).
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

HEADLINE = (
    "s4_parquet_globs p6_interleave p9_split c2_html_to_text c3_boilerplate c5_language_gate c6_exact_dedup c7_minhash_pairs "
    "c8_simhash_pairs c12_repetition c16_funnel c18_decontaminate r8_pii_hits r9_redact t1_tokenise t2_build_vocab t4_pack "
    "t8_ngram_perplexity k1_segment k2_chunk x2_sparse_weights x4_postings q1_dense_topk q2_ann_topk q3_bm25_topk q8_as_of "
    "e1_e2_retrieval_scores e4_token_f1 e11_bootstrap v1_render w3_stream_redact w5_monitor corpus_to_blocks"
).split()


# The fixture's text tables are one file of one row group each, which only one task can read; a corpus
# on a cluster is many files. They are dealt over this many files first; the time of that counts.
TEXT_TABLES, FILES = ("documents", "pages"), 16


def dealt(sf_dir: str) -> str:
    """The tables with the text tables in several files each; all others are links to the given ones."""
    import pyarrow.parquet as pq

    folder = tempfile.mkdtemp(prefix="bench-")
    for path in Path(sf_dir).glob("*.parquet"):
        to = Path(folder, path.name)
        if path.stem in TEXT_TABLES and path.is_file():
            to.mkdir()
            rows = pq.read_table(path)
            size = -(-len(rows) // FILES)
            for i in range(FILES):
                pq.write_table(rows.slice(i * size, size), to / f"part-{i:05d}.parquet")
        else:
            to.symlink_to(path.resolve())
    return folder


def main() -> int:
    from tamra.plans import QUERIES
    from tamra.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else (chosen.split(",") if chosen else HEADLINE)
    start = time.time()
    data = dealt(sf_dir)
    dealing = round(time.time() - start, 3)
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads
    seconds, failed = {"deal_files": dealing}, {}
    for name in names:
        start = time.time()
        try:
            QUERIES[name].run(spark, data).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.time() - start, 3)
        except Exception as error:  # noqa: BLE001 - report the rest
            failed[name] = str(error)[:200]
        print(f"{name}: {seconds.get(name, 'failed')}", file=sys.stderr, flush=True)
    result = {"metric": "total wall time of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
              "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1]}
    if failed:
        result["failed"] = failed
    print(json.dumps(result))
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
