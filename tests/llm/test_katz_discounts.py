"""Good-Turing discounts on the given counts of counts, and histories that they leave nothing for."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loanloom.llm import ngrams

SF_01_PAIRS = [1579638, 246704, 51653, 21705, 18939, 7580]


def valid(numbers):
    d = ngrams.discounts(numbers)
    kept = [1 - d[r] / r for r in range(1, ngrams.CUTOFF + 1)]
    return d[-1] == ngrams.FLAT and all(0 < k < 1 for k in kept) and kept == sorted(kept)


def numbers_of(counts):
    of = Counter(counts.values())
    return [of[r] for r in range(1, ngrams.CUTOFF + 2)]


def test_uneven_classes_get_good_turing_discounts():
    assert valid(SF_01_PAIRS)
    assert valid([40, 0, 9, 3, 0, 1]) and valid([5, 5, 5, 5, 5, 5]) and valid([1, 2, 3, 4, 5, 6]) and valid([9, 3, 0, 0, 0, 0])
    d = ngrams.discounts([round(10**9 / r**3) for r in range(1, 7)])
    share = 6 * 6**-3
    for r in range(1, 6):
        assert 1 - d[r] / r == pytest.approx(((1 + 1 / r) ** -2 - share) / (1 - share), rel=1e-6)
    assert ngrams.discounts([7, 0, 0, 0, 0, 0]).tolist() == ngrams.discounts([0] * 6).tolist() == [0.0, *[ngrams.FLAT] * 6]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sample_tables_use_good_turing(sf):
    rows = pq.read_table(f"/root/testdata/{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    words, pairs = Counter(), Counter()
    for r in rows:
        if zlib.crc32(str(r["doc_id"]).encode()) % 7 != 2:
            own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), r["text"] or ""))
            words.update([*own, "</s>"])
            pairs.update(zip(["<s>", *own], [*own, "</s>"]))
    assert valid(numbers_of(words)) and valid(numbers_of(pairs))


@pytest.mark.parametrize("parts", [1, 4])
def test_history_of_frequent_pairs_only(spark, monkeypatch, parts):
    """``p q`` occurs 1,500 times and p is followed by nothing else; ``m n`` 8 times. Unseen words follow both."""
    texts = ["p q"] * 1500 + ["m n"] * 8 + [f"w{i % 40} v{i * i % 70}" for i in range(200)] + ["p z", "m z", "p q", "m n"]
    held = len(texts) - 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r.score for r in ngrams.score_texts(docs, F.col("doc_id") >= held, parts=parts).collect()}
    uni, big = Counter(), Counter()
    for t in texts[:held]:
        w = t.split()
        uni.update([*w, "</s>"])
        big.update(zip(["<s>", *w], [*w, "</s>"]))
    assert valid(numbers_of(uni)) and valid(numbers_of(big))
    total, d1, d2 = sum(uni.values()), ngrams.discounts(numbers_of(uni)), ngrams.discounts(numbers_of(big))
    lower = lambda w: (uni[w] - d1[min(uni[w], 6)]) / total if uni[w] else sum(d1[min(c, 6)] for c in uni.values()) / total

    def chance(h, w):
        after = {b: c for (a, b), c in big.items() if a == h}
        if not after:
            return lower(w)
        d = lambda c: d2[min(c, 6)]
        count = sum(after.values())
        if w in after:
            return (after[w] - d(after[w])) / count
        return sum(map(d, after.values())) / count / (1 - sum(map(lower, after))) * lower(w)

    for i in range(held, len(texts)):
        w = texts[i].split()
        want = sum(math.log10(chance(a, b)) for a, b in zip(["<s>", *w], [*w, "</s>"]))
        assert rows[i] == pytest.approx(want, rel=1e-9) and np.isfinite(rows[i])


def test_a_chunks_backoff_weights_stay_arrays():
    """Python workers hold them beside the JVM: a dictionary a row took a multiple of the rows."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from loanloom.llm import ngrams

    n = 200_000
    history = np.arange(n, dtype=np.int64)[::-1]
    found = pa.table({"history": np.concatenate([history, history[:5]]), "weight": np.concatenate([history / n, history[:5] / n])})
    tracemalloc.start()
    known, weight = ngrams._backoff(found)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (known == np.arange(n)).all() and np.allclose(weight, np.arange(n) / n)
    assert peak < 100 * n, peak
    assert [x.tolist() for x in ngrams._backoff(None)] == [[-1], [1.0]]
