import ctypes
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from signalmill.llm import language_id
from signalmill.llm.common import batches_of


def held_mb() -> int:
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text()).group(1)) // 1024


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="another C library")
def test_batches_that_are_through_give_memory_back():
    few = pa.RecordBatch.from_arrays([pa.array(["a", "b"])], ["text"])
    blocks = [np.ones(1 << 16, np.uint8) for _ in range(4000)]
    last = [blocks.pop() for _ in range(10)]
    before = held_mb()
    del blocks
    assert sum(b.num_rows for b in batches_of([few, few], tidy=True)) == 4
    assert len(last) == 10 and held_mb() < before - 150


def test_languages_of_many_texts_take_bounded_memory():
    rng = np.random.default_rng(5)
    words = np.array(["".join(rng.choice(list("abcdefgh"), 5)) for _ in range(500)])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(900)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    table = np.log(rng.random((4, 1 << language_id.GRAM_BITS))).astype(np.float32)
    model = language_id.LanguageModel(["a", "b", "c", "d"], table)
    tracemalloc.start()
    found = []
    for part in batches_of([batch], language_id.BATCH_BYTES):
        found += language_id.language_sets(part.column("text"), model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20
    whole = language_id.language_sets(batch.column("text"), model)
    assert found == whole
