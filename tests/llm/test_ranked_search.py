"""Ranked search against plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from loanloom.llm import ranked_search as R

TERM = re.compile("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def terms_of(text):
    upper = "".join(map(chr, range(65, 91)))
    return [t.translate(str.maketrans(upper, upper.lower())) for t in TERM.findall(text or "")]


def brute(docs, queries, top):
    counts = [(d, Counter(terms_of(t))) for d, t in docs]
    n_docs = sum(bool(c) for _, c in counts)
    total = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in queries:
        scored = []
        for doc, c in counts:
            m = 50 + (50 * sum(c.values()) * n_docs) // total if total else 0
            score = 0
            for t in set(terms_of(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, k, row[3], -row[0]) for k, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def results(spark, docs, queries, **options):
    index = R.build_index(spark.createDataFrame(docs, "doc_id long, text string"))
    found = R.search(index, spark.createDataFrame(queries, "item_id long, text string"), "item_id", **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, found.collect()), key=str)


def made(seed, n, words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(words)] + ["É", "é", "Straße", "x9"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 5, 30, 200]))).upper()) for k in range(n)]


@pytest.mark.parametrize("options", [{}, {"block_pairs": 7}, {"top": 3}])
def test_equals_brute_force(spark, options):
    docs = made(1, 120)
    docs += docs[:15] + [(None, docs[3][1]), (None, docs[3][1]), (500, None), (501, ""), (502, "... !"), (503, "w0 " * 700)]
    queries = made(2, 12) + [(3, "w0 w0 w1"), (3, "w0 w1"), (None, "w2"), (77, None), (78, "unknown words"), (79, "é É")]
    assert results(spark, docs, queries, **options) == brute(docs, queries, options.get("top", R.TOP))


def test_ties_rank_by_id(spark):
    docs = [(k, "same text here") for k in range(200, 0, -1)] + [(k + 1000, "other") for k in range(300)]
    found = results(spark, docs, [(1, "same")])
    assert [r[2] for r in sorted(found, key=lambda r: r[1])] == list(range(1, 51))


def test_empty_tables_and_clashing_columns(spark):
    docs, queries = [(1, "a b"), (2, "b")], [(1, "a")]
    assert results(spark, [(1, None)], queries) == [] == results(spark, docs, [(1, None)])
    none = spark.createDataFrame([], "doc_id long, text string")
    assert R.search(R.build_index(none), spark.createDataFrame(queries, "item_id long, text string"), "item_id").count() == 0
    wide = spark.createDataFrame([(1, "a b", 5, 6, 7), (2, "b", 5, 6, 7)], "doc_id long, text string, n long, terms long, sketch long")
    more = spark.createDataFrame([(1, "a", 1, 2)], "item_id long, text string, rank long, query long")
    assert [tuple(r) for r in R.search(R.build_index(wide), more, "item_id").collect()] == brute(docs, queries, 50)


def test_a_long_text_is_one_row(spark):
    text = "common " * 400_000 + "rare"
    docs = [(1, text), (2, "rare common"), (3, "nothing")]
    assert results(spark, docs, [(1, "rare common")]) == brute(docs, [(1, "rare common")], 50)


def test_sketch_bounds_every_impact():
    import pyarrow as pa

    texts = [t for _, t in made(5, 50, words=900)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(texts)], names=["doc_id", "__text"])
    (row,) = R._index_rows(iter([batch]), 1)
    for terms, occurrences, sketch in zip(*(row.column(c).to_pylist() for c in ("terms", "occurrences", "sketch")), strict=True):
        folded = np.frombuffer(sketch, dtype=np.uint8)
        words = R.Words(pa.array([" ".join(t.decode() for t in terms)]), R.WORD_BYTES)
        for part in R.coordinates(words.hashes()):
            assert (folded[part] >= np.minimum(occurrences, R.FULL)).all()
    assert R.length_factor(np.array([3 * 10**9]), 10**11, 10**13).tolist() == [50 + 50 * 3 * 10**9 * 10**11 // 10**13]
