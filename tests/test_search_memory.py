"""A task of the vector search holds a few slices of scores, also where its block and shard are full."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from tamra.operators.search import BLOCK, _best


@pytest.mark.parametrize("metric", ["cosine", "distance"])
def test_memory_of_a_full_block(metric):
    rng = np.random.default_rng(1)
    asked = pd.DataFrame({"query_id": np.arange(BLOCK), "embedding": list(rng.normal(size=(BLOCK, 8))), "least": np.full(BLOCK, np.nan)})
    items = pd.DataFrame({"item": np.arange(9_000), "vector": list(rng.normal(size=(9_000, 8)))})
    tracemalloc.start()
    found = _best(5, metric, 6)(asked, items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 5 * BLOCK
    assert peak < 200e6
