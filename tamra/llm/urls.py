"""URL filters by a sort-merge range join on reversed hosts.

A host's canonical key is its labels reversed, each closed by a dot (``com.example.www.``), so
a rule's host and all its subdomains are one interval of sorted keys. Rules and urls are dealt
by ranges of the key, sorted together, and swept once: a stack holds the rule hosts whose
interval is open, each with its path prefixes by length. A rule whose interval goes over range
borders is dealt to every range it touches. Memory of a task is the stack, not its urls.

The host is what stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
lower case, port and user included; the path goes on from there to ``?``, ``#`` or the end. A
rule fits if its host is the url's or a parent of it and the url's path starts with the rule's
path; of several the longest (host and path) wins, then the longest host, then the first in
order of verdict. A url that no rule fits gets the default verdict.

Cases: a null url, or one without ``://``, has an empty host and path and no rule; rules with a
null or empty host never fit; a null rule path is empty; repeated urls and rules are judged
each like the first; empty tables give no rows, or the default; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLED = 40  # url keys looked at for each range border
_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), *_LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


class Sweep:
    """The open rule hosts above the present key."""

    def __init__(self, default: str) -> None:
        self.default, self.stack = default, []

    def move(self, key: str) -> None:
        while self.stack and not key.startswith(self.stack[-1][0]):
            self.stack.pop()

    def open(self, key: str, host: str, path: str, verdict: str) -> None:
        if not self.stack or self.stack[-1][0] != key:
            self.stack.append((key, host, {}, []))
        paths, lengths = self.stack[-1][2:]
        if path not in paths or verdict < paths[path]:
            paths[path] = verdict
        if len(path) not in lengths:
            lengths.append(len(path))
            lengths.sort(reverse=True)

    def judge(self, path: str) -> tuple[str | None, str]:
        best = None
        for _, host, paths, lengths in self.stack:
            for n in lengths:
                if n <= len(path) and path[:n] in paths:
                    found = (len(host) + n, len(host), host + path[:n], paths[path[:n]])
                    best = found if best is None or found[:2] > best[:2] else best
                    break
        return (best[2], best[3]) if best else (None, self.default)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict) for every page; ``rules`` has (host, path, verdict)."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType.simpleString()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    urls = pages.select(F.col(key).alias("id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    urls = urls.withColumn("key", canonical(F.col("host")))
    # Borders only balance the ranges: a hash sample of bounded size. They hold path and a hash of the
    # id too, so a host or a url of many pages is cut as well.
    urls = urls.withColumn("tie", F.xxhash64("id", "path"))
    sample = (urls.select("key", "path", "tie").orderBy(F.xxhash64("tie", "key")).limit(SAMPLED * parts)
              .toPandas().sort_values(["key", "path", "tie"]).itertuples(index=False, name=None))
    borders = list(dict.fromkeys(list(sample)[SAMPLED::SAMPLED]))
    columns = "range int, key string, kind int, host string, path string, verdict string"

    def deal_urls(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(range=pd.array([bisect_right(borders, b) for b in zip(f["key"], f["path"], f["tie"])], "int32"))

    def deal_rules(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            spans = [range(bisect_right(borders, (k, "")), bisect_right(borders, (k + "\U0010ffff", "")) + 1) for k in f["key"]]
            f = f.assign(range=spans).explode("range")
            yield f.assign(range=f["range"].astype("int32"), kind=0)[["range", "key", "kind", "host", "path", "verdict"]]

    dealt = urls.select("id", "host", "path", "key", "tie").mapInPandas(
        deal_urls, f"id {kind}, host string, path string, key string, tie bigint, range int")
    dealt = dealt.select("range", "key", F.lit(1).alias("kind"), "host", "path", F.lit(None).cast("string").alias("verdict"), "id")
    laws = (rules.where("host is not null and host <> ''")
            .select(F.translate("host", *_LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict"))
    laws = laws.withColumn("key", canonical(F.col("host"))).select("key", "host", "path", "verdict").mapInPandas(deal_rules, columns)
    both = dealt.unionByName(laws, allowMissingColumns=True)
    swept = both.repartition(parts, "range").sortWithinPartitions("range", "key", "kind", "path")

    def sweep(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, state = None, Sweep(default)
        for f in frames:
            out = []
            for row in f.itertuples(index=False):
                if row.range != at:
                    at, state = row.range, Sweep(default)
                state.move(row.key)
                if row.kind == 0:
                    state.open(row.key, row.host, row.path, row.verdict)
                else:
                    out.append((row.id, row.host, row.path, *state.judge(row.path)))
            made = pd.DataFrame(out, columns=[key, "host", "path", "rule", "verdict"], dtype=object)
            yield made

    return swept.select("range", "key", "kind", "host", "path", "verdict", "id").mapInPandas(
        sweep, f"`{key}` {kind}, host string, path string, rule string, verdict string")
