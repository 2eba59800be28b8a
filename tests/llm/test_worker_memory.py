"""What Python workers hold: small batches in, freed memory given back."""

import re
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanloom.llm import ngrams, text

BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def resident_mb():
    return int(re.search(r"VmRSS:\s+(\d+)", Path("/proc/self/status").read_text())[1]) / 1024


@pytest.mark.skipif(text._trim is None, reason="the allocator has no trim")
def test_freed_memory_goes_back_to_the_system():
    def rows():
        held = [np.ones(8 << 10) for _ in range(2000)]  # 64 KB each, from the heap
        last = held.pop()  # keeps the heap's end in use
        peaks.append(resident_mb())
        del held
        yield pa.RecordBatch.from_pydict({"n": [int(last.size)]})

    peaks = []
    for _ in text.released(rows()):
        pass
    assert peaks[0] - resident_mb() > 80


def test_katz_steps_get_chunks_in_small_batches(spark, monkeypatch):
    """The sizes hold when a step runs, so its result is written within them."""
    sizes = {}

    def noted(kind):
        kept = getattr(ngrams, kind)

        def run(df, label, *rest):
            sizes[label] = spark.conf.get(BATCH)
            return kept(df, label, *rest)

        monkeypatch.setattr(ngrams, kind, run, raising=False)

    before = spark.conf.get(BATCH)
    noted("_kept")
    noted("stored")
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (2, "b c"), (None, "a")], "doc_id long, text string")
    found = ngrams.score_texts(docs, F.col("doc_id") == 1, parts=2)
    assert {sizes[k] for k in ("text-chunks", "bigrams", "scores")} == {"4m"}
    assert spark.conf.get(BATCH) == before
    assert sorted((r.n_tokens, r.n_known) for r in found.collect()) == [(1, 1), (2, 2), (3, 3), (4, 4)]
    assert "MapInArrow" not in found._jdf.queryExecution().executedPlan().toString()
