"""Fill-in-middle against a plain form of the same rule, long texts in pieces, odd rows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tamra.llm import infill
from tests.llm.test_llm import LONG, ODD, SCHEMA, rows

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
MARKED = [(20, "has <M> inside"), (21, "<<P"), (22, "S><"), (23, "a\x00\x01\xffb\n\r\n c"), (24, "Z" * 5000), (25, "9" * 5000)]


def plainly(key, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(u) for u in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return key, len(units), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return key, len(units), form, len(prefix), len(middle), output


def order(r):
    return (r[0] is None, r[0] or 0, r[5])


def test_rows_equal_the_plain_rule_and_give_their_texts_back(spark):
    docs = ODD + MARKED + [(100 + i, "ab, c<d>e\n" * (i % 7)) for i in range(60)]
    made = infill.transform(spark.createDataFrame(rows(docs), SCHEMA))
    got = made.withColumn("back", infill.restored(F.col("form"), F.col("output"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=order) == sorted((plainly(i, t) for i, t in docs), key=order)
    assert sorted(r.back for r in got) == sorted(t or "" for _, t in docs)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    made = infill.transform(spark.createDataFrame([], SCHEMA))
    assert made.withColumn("back", infill.restored(F.col("form"), F.col("output"))).collect() == []


@given(st.lists(st.text(alphabet="aZ <\n9é你\x00", max_size=60), max_size=8), st.integers(0, 2 ** 32), st.integers(0, 2 ** 32), st.sampled_from([3, 11, 1 << 20]))
@settings(max_examples=150, deadline=None)
def test_pieces_change_nothing(texts, x, y, most):
    cut, row = infill.pieces(pa.array(texts, pa.large_string()), most)
    assert ["".join(p.as_py() for p, r in zip(cut, row) if r == i) for i in range(len(texts))] == texts
    kept, infill.pieces.__defaults__ = infill.pieces.__defaults__, (most,)
    try:
        n, found = infill.parts(pa.array(texts, pa.large_string()), np.full((len(texts), 2), [x, y]))
    finally:
        infill.pieces.__defaults__ = kept
    for i, text in enumerate(texts):
        units = UNIT.findall(text)
        low, high = sorted(v % (len(units) + 1) for v in (x, y))
        assert n[i] == len(units)
        assert [f[i].as_py() for f in found] == ["".join(units[:low]), "".join(units[low:high]), "".join(units[high:])]


@pytest.mark.parametrize("text", [LONG * 12, "x" * 9_000_000, "语" * 3_000_000])
def test_very_long_texts(text):
    n, (prefix, middle, suffix) = infill.parts(pa.array([text, "a b"], pa.large_string()), np.array([[999_331, 1_999_993], [1, 2]]))
    assert prefix[0].as_py() + middle[0].as_py() + suffix[0].as_py() == text
    assert n[0] == len(UNIT.findall(text))
    assert [x[1].as_py() for x in (prefix, middle, suffix)] == ["a", " ", "b"]
