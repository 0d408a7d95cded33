"""A tree in a mounted folder is listed and read by the tasks and gives what Spark's reader of files gives."""

import os

import pytest

from tamra.sources import readers


@pytest.fixture()
def tree(tmp_path):
    root = tmp_path / "tree with blank"
    for at, content in [("a.md", b"one"), ("b.txt", b"no"), ("sub/c.md", b"a\xffb"), ("sub/deep/er/d.md", "\u0e01".encode()), ("_hidden/e.md", b"x"), (".f.md", b"x"),
                        ("k=1/_g=2/h.md", b"yes"), ("sub/_i.md", b"x"), ("blank.md", b" \n"), ("empty.md", b""), ("sub/j._COPYING_", b"x"), ("l.MD", b"x")]:
        path = root / at
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)
    for i in range(40):
        (root / f"sub/n{i}.md").write_bytes(b"n%d" % i)
    (root / "\u0e02.md").write_bytes(b"named")
    os.symlink(root / "a.md", root / "link.md")
    return root


@pytest.mark.parametrize("pattern", ["*.md", "n?.md", "*"])
def test_the_files_are_those_of_sparks_reader(spark, tree, monkeypatch, pattern):
    for folder in (str(tree), f"file://{tree}".replace(" ", " "), f"{tree}/"):
        got = readers.read_markdown(spark, folder, "s", pattern).collect()
        with monkeypatch.context() as patched:
            patched.setattr(readers, "mounted_files", lambda *_: None)
            want = readers.read_markdown(spark, folder, "s", pattern).collect()
        assert sorted(got) == sorted(want) and len(got) > 5


def test_no_list_of_files_stands_in_the_plan(spark, tree, monkeypatch):
    monkeypatch.setattr(readers, "BATCH_BYTES", 5)
    rows = readers.read_markdown(spark, str(tree), "s")
    assert rows.inputFiles() == []
    assert {r.text for r in rows.select("text").collect()} >= {"one", "ab", "n39", "yes", "named"}


def test_other_folders_are_left_to_spark(spark, tree):
    assert readers.mounted_files(spark, "hdfs://host/folder", "*.md") is None
    assert readers.mounted_files(spark, f"{tree}/s*", "*.md") is None
    assert readers.mounted_files(spark, str(tree), "{a,b}.md") is None
    assert readers.mounted_files(spark, f"{tree}/none", "*.md") is None
