import json

import pytest
from pyspark.sql import functions as F

from tamra.operators import shape
from tamra.sources import readers, sinks


def test_markdown_tree(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.md").write_text("ขอความ", encoding="utf-8")
    (tmp_path / "deep" / "b.md").write_bytes(b"a\xffb")
    (tmp_path / "deep" / "er" / "blank.md").write_text(" \n\t ")
    (tmp_path / "c.txt").write_text("not markdown")
    rows = readers.read_markdown(spark, str(tmp_path), "law").select("text", "source").collect()
    assert sorted((r.text, r.source) for r in rows) == [("ab", "law"), ("ขอความ", "law")]


def test_social_jsonl(spark, tmp_path):
    lines = [
        json.dumps({"title": "T", "body_text": "B"}), json.dumps({"text": "only"}), json.dumps({"title": "just title"}),
        json.dumps({"title": "kept", "body_text": None, "text": "unused"}), "  ", '{"title": ', json.dumps({"text": "after the bad line"}),
        "[1, 2]", json.dumps({"title": "", "text": " "})]
    (tmp_path / "x.jsonl").write_text("\n".join(lines))
    texts = sorted(r.text for r in readers.read_social_jsonl(spark, str(tmp_path)).collect())
    assert texts == ["T\nB", "after the bad line", "just title", "kept", "only"]
    assert readers.social_rejects(spark, str(tmp_path)).first().rejected == 2


def test_parquet_globs_count_a_file_once(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a.parquet"))
    globs = [f"{tmp_path}/*.parquet/*.parquet", f"{tmp_path}/a.parquet/*.parquet"]
    assert readers.read_parquet_globs(spark, globs).count() == 5


def test_mixed_parquet(spark, tmp_path):
    def write(name, df):
        df.coalesce(1).write.parquet(str(tmp_path / name))

    one = spark.range(1)
    write("t", one.select(F.lit("from text").alias("text"), F.lit("no").alias("body")))
    write("u", one.select(F.lit("from txt").alias("txt")))
    write("b", one.select(F.lit("from body").alias("body"), F.lit("no").alias("content")))
    write("none", one)
    write("number", one.select(F.lit(7).alias("text")))
    (tmp_path / "broken.parquet").write_bytes(b"PAR1 nothing")
    df, skipped = readers.read_mixed_parquet(spark, str(tmp_path))
    assert sorted(r.text for r in df.collect()) == ["from body", "from text", "from txt"]
    assert skipped.count() == 3


def test_sources_and_normalise_errors(spark):
    with pytest.raises(ValueError):
        readers.load_sources(spark, [])
    with pytest.raises(ValueError):
        shape.normalise(spark.range(1), "body")


def test_manifest_and_splits(spark, tmp_path):
    df = spark.range(100).withColumnRenamed("id", "doc_id")
    path = str(tmp_path / "splits")
    sinks.write_splits(shape.split(df, 0.05, 42), path)
    train, validation = (sinks.read_split(spark, path, s) for s in ("train", "validation"))
    assert (train.count(), validation.count()) == (95, 5)
    assert train.join(validation, "doc_id").count() == 0
    assert "split" not in shape.split(df, 0.0, 42).columns
    assert "split" not in shape.split(df.limit(1), 0.5, 42).columns
