"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest

from loanloom.llm import resampling as R
from loanloom.llm.queries import QUERIES
from loanloom.llm.text import WORD_BYTES, Words

WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")


def words_of(text):
    upper = "".join(map(chr, range(65, 91)))
    return WORD.findall((text or "").translate(str.maketrans(upper, upper.lower())))


def buckets_of(words):
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def brute(docs, target, least=20, share=(5, 100)):
    source, wanted = Counter(), Counter()
    for _, text in docs:
        source += buckets_of(words_of(text))
    for text in target:
        wanted += buckets_of(words_of(text))
    S, T = sum(source.values()), sum(wanted.values())
    rows = []
    for doc, text in docs:
        own = buckets_of(words_of(text))
        weight = sum(n * math.floor(1000 * math.log((wanted[b] + 1) * (S + 10000) / ((source[b] + 1) * (T + 10000)))) for b, n in own.items())
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, sum(own.values()), weight, score, None, len(words_of(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[1]))
    for k, row in enumerate(fit[: share[0] * len(fit) // share[1]], 1):
        row[4] = k
    return sorted((tuple(r[:5]) for r in rows), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(60)] + ["Straße", "É", "x" * 300, "y" * 70_000]
    weights = [1 / (k + 1) for k in range(60)] + [0.1, 0.1, 0.02, 0.0005]
    return [(k, " ".join(rng.choices(vocabulary, weights, k=rng.choice([0, 1, 2, 19, 20, 60])))) for k in range(n)]


def test_equals_plain_version(spark):
    docs = made(1, 400)
    docs += docs[:40] + [(None, docs[5][1]), (None, None), (900, ""), (901, "... !"), (902, "w0 " * 50_000)]
    target = ["w1 w2 W3 w4 w5 " * 5, None, "", "É w1 Straße"]
    make = spark.createDataFrame([(d, t, 1, 2) for d, t in docs], "doc_id long, text string, rank int, score int")
    found = R.resample(make, spark.createDataFrame([(t,) for t in target], "text string"))
    assert rows_of(found) == brute(docs, target)


def test_sample_table_equals_plain_version(spark, sf_dir):
    read = lambda name, *cols: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols).collect()]
    want = brute(read("documents", "doc_id", "text"), [t for (t,) in read("benchmark", "text")])
    assert rows_of(QUERIES["op13_resample"](spark, sf_dir)) == want


def test_empty_tables(spark):
    none, one = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert R.resample(none, one).count() == 0
    assert rows_of(R.resample(one, none)) == brute([(1, "a b c")], [])


def test_crc32_of_all_runs():
    texts = [t for _, t in made(7, 30)] + ["z" * 1_000_000 + " a " + "b" * 257 + " c" * 3, "é" * 128 + " x", ""]
    words = Words(pa.array(texts), WORD_BYTES)
    doc, bucket = R.features(words)
    for k, text in enumerate(texts):
        assert Counter(bucket[doc == k].tolist()) == buckets_of(words_of(text))


@pytest.mark.parametrize("accuracy", [2, 10, 2000])
@pytest.mark.parametrize("kind", ["distinct", "ties", "equal"])
def test_bracket_holds_the_cutoff(spark, accuracy, kind):
    rng = random.Random(4)
    value = {"distinct": lambda: rng.randrange(10**9), "ties": lambda: rng.randrange(3), "equal": lambda: 7}[kind]
    rows = [(value(), k % 300 if k % 7 else None, k % 5, 20) for k in range(1000)]
    made_ = spark.createDataFrame(rows, "score long, doc_id long, n_features long, n_words long")
    order = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, -r[2]))
    for share in [(1, 1000), (5, 100), (1, 2), (1, 1)]:
        wanted = share[0] * 1000 // share[1]
        low, high, above = R.bracket(made_.select("score"), 1000, wanted, accuracy)
        assert low <= order[wanted - 1][0] <= high and above == sum(r[0] > high for r in rows) < wanted
        drawn = R.draw(made_, 20, share, accuracy).filter("rank IS NOT NULL").orderBy("rank").collect()
        assert [r["rank"] for r in drawn] == list(range(1, wanted + 1))
        assert [(r.score, r.doc_id, r.n_features) for r in drawn] == [r[:3] for r in order[:wanted]]
