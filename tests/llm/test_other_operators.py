"""Embeddings, archives, mixing, components and the pipeline on small tables."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from loanloom.llm import embeddings, mixing, warc
from loanloom.llm.components import components, joined_by
from loanloom.llm.shared import with_row_key


# --- components -------------------------------------------------------------


@pytest.mark.parametrize("shape", ["chain", "random", "star", "empty"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "chain": [(i, i + 1) for i in range(40)] + [(100, 99)],
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(150)],
        "star": [(7, i) for i in range(8, 60)] + [(3, 3)],
        "empty": [],
    }[shape]
    root = {n: n for e in edges for n in e}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    want = {n: top(n) for n in root if top(n) != n}
    make = lambda rows: spark.createDataFrame(rows, "a long, b long")
    assert {r.u: r.v for r in components(make(edges)).collect()} == want
    half = len(edges) // 2
    assert {r.u: r.v for r in joined_by(components(make(edges[:half])), make(edges[half:])).collect()} == want


# --- embeddings -------------------------------------------------------------


def brute_links(rows, least=0.98):
    def unit(x):
        if x is None or not x or any(c is None or not np.isfinite(c) for c in x) or not any(x):
            return None
        v = np.array(x, dtype=np.float64)
        return v / np.sqrt(v @ v)

    units = [unit(x) for _, x, _ in rows]
    links, root = [0] * len(rows), list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = units[i], units[j]
            if a is not None and b is not None and a.size == b.size and rows[i][2] is not None and rows[i][2] == rows[j][2] and a @ b >= least:
                links[i] += 1
                links[j] += 1
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(top(i), []).append(rows[i][0])
    return [(r[0], n, min(groups[top(i)])) for i, (r, n) in enumerate(zip(rows, links))]


@pytest.mark.parametrize(("leaf", "block"), [(256, 1024), (20, 8)])
def test_links_against_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = np.random.default_rng(2)
    rows = []
    for _ in range(40):
        centre = rng.normal(size=16)
        for _ in range(rng.integers(1, 9)):
            rows.append((len(rows), [float(np.float32(x)) for x in centre + rng.normal(scale=0.08, size=16)], int(rng.integers(0, 2))))
    same = rows[0][1]
    rows += [(len(rows) + k, same, 0) for k in range(5)]
    odd = [None, [], [0.0] * 16, [None] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [1.0, 2.0]]
    rows += [(1000 + k, x, 0) for k, x in enumerate(odd)] + [(2000, same, None), (2001, same, None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, label int, node string")
    got = embeddings.link(df.repartition(3), leaf=leaf).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == Counter(brute_links(rows))
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.link(df).count() == 0


def test_forest_recall_on_clusters():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(300, 64))
    x = np.repeat(centres, 10, axis=0) + rng.normal(scale=0.1, size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    pairs = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)))}
    found = set()
    for _ in range(embeddings.TREES):
        rows, leaves = embeddings.Tree.fit(x, 1.0, rng).leaves(x)
        for leaf in np.unique(leaves):
            own = np.sort(rows[leaves == leaf])
            i, j = np.nonzero(np.triu(x[own] @ x[own].T >= 0.98, 1))
            found |= set(zip(own[i], own[j]))
    assert len(found & pairs) >= 0.99 * len(pairs) > 0


# --- archives ---------------------------------------------------------------


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "FILE_BYTES", 3000)
    big, long = "x" * 150, "é" * 200_000
    html = [big, big, "short", "short", None, "", long, long, "WARC/1.1\r\n\r\n" * 20, big, "\r\n" * 60]
    rows = [(i, f"http://x/{i}\n", h, "x") for i, h in enumerate(html)] + [(1, None, big, "x"), (0, "u", big, "x"), (None, "u", long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    got = warc.archive(pages.repartition(2)).collect()
    want = Counter()
    for page, _, h, _ in rows:
        payload = (h or "").encode()
        first = min((p for p, _, o, _ in rows if p is not None and (o or "") == (h or "")), default=None)
        revisit = len(payload) >= 100 and page != first
        want[(page, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if revisit else "response", first if revisit else None)] += 1
    assert Counter(tuple(r) for r in got) == want
    assert warc.archive(pages.filter("false")).count() == 0


# --- mixing -----------------------------------------------------------------


def test_targets_and_taken_words(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", "c", None, "Z", "é"]), rng.randint(0, 30), "x") for i in range(600)]
    rows += [(9, "a", 5, "x"), (None, "b", 5, "x"), (9, "a", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, bucket_size string")
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, s, n, _ in rows:
        sizes[s] += n
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, full = {}, set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        share = sum(w for s, w in weight.items() if s not in full)
        target = {s: 2 * sizes[s] if s in full else rest * weight[s] / share for s in order}
        over = {s for s in order if target[s] > 2 * sizes[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in got:
        assert r.target == pytest.approx(target[r.source]) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    largest = max(r.size for r in got)
    assert all(abs(taken[s] - target[s]) <= largest for s in order)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in got) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, size long")
    assert mixing.mix(docs).count() == 0
    blank = spark.createDataFrame([(1, "a", 0), (2, None, 0)], "doc_id long, source string, size long")
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]


def test_size_counts_tokens(spark):
    texts = [None, "", " a  b\tc\n", "é x y", "\x0b\x0c", "x" * 9]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.size_of(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_mixing_plan_has_no_python(spark):
    queued, _ = mixing.virtual_times(spark.createDataFrame([(1, "a", 3)], "doc_id long, source string, size long"))
    assert "Python" not in queued._jdf.queryExecution().executedPlan().toString()


# --- pipeline ---------------------------------------------------------------


def test_row_keys_are_unique(spark):
    made = with_row_key(spark.range(50).repartition(4))
    assert made.select("__file", "__row").distinct().count() == 50


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = docs.columns
    extra = [(10**6, None), (10**6 + 1, ""), (10**6 + 2, "123 !")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), allowMissingColumns=True)
    from loanloom.llm.shared import stored

    stages = dict(corpus_pipeline.STAGES)
    assert len(stages) == 5
    kept = stored(stages["language ID"](spark, docs, sf_dir), "t1")
    assert kept.columns == names and kept.filter("doc_id >= 1000000").count() == 0
    assert kept.count() >= 0.99 * (docs.count() - 3)
    unique = stored(stages["MinHash near-dedup"](spark, kept, sf_dir), "t2")
    assert unique.columns == names and 0 < unique.count() < kept.count()
    assert unique.count() == unique.select("text").distinct().count()
    twice = stages["MinHash near-dedup"](spark, stored(kept.union(kept), "t3"), sf_dir)
    assert sorted(r.doc_id for r in twice.select("doc_id").collect()) == sorted(r.doc_id for r in unique.select("doc_id").collect())
    clean = stored(stages["benchmark decontamination"](spark, unique, sf_dir), "t4")
    assert clean.columns == names and 0 < clean.count() <= unique.count()
    mixed = stored(stages["mixing sources to target weights"](spark, clean, sf_dir), "t5")
    assert mixed.columns == names
    assert mixed.groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 2
    last = stages["token-ID / binary output"](spark, mixed, sf_dir)
    assert last.count() == mixed.count()
    nothing = docs.filter("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, sf_dir).count() == 0
