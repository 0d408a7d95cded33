"""What a Python worker keeps of its memory between two tasks that encode."""

import subprocess
import sys
from pathlib import Path

import pytest

KEPT_MB = 60

SCRIPT = """
import random, re, sys
from unittest.mock import MagicMock
import pyarrow as pa
from tamra.llm import bpe
from tamra.llm.tables import tokenizer_path

def held():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"Private_Dirty: +(\\d+)", file.read()))) / 1024

def batches(n, words):
    draw = random.Random(n)
    letters = "abcdefghijklmnopqrstuvwxyz"
    for first in range(n):
        texts = [" ".join("".join(draw.choices(letters, k=draw.randint(3, 9))) for _ in range(words)) for _ in range(1000)]
        yield pa.RecordBatch.from_arrays([pa.array(range(1000)), pa.array(texts)], names=["doc_id", "text"])

docs = MagicMock()
docs.sparkSession.conf.get.return_value = "2000"
docs.select.return_value.mapInArrow.side_effect = lambda run, schema: run
run = getattr(bpe, sys.argv[1])(docs, tokenizer_path())
rows = sum(b.num_rows for b in run(batches(1, 1)))
before = held()
rows += sum(b.num_rows for b in run(batches(2, 200)))
print(rows, held() - before)
"""


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
@pytest.mark.parametrize("name", ["digests", "encode_text"])
def test_a_worker_gives_back_what_a_task_has_freed(name):
    ran = subprocess.run([sys.executable, "-c", SCRIPT, name], cwd=Path(__file__).resolve().parents[2], capture_output=True, text=True, check=True)
    rows, kept = ran.stdout.split()[-2:]
    assert int(rows) == 3000
    assert float(kept) < KEPT_MB
