"""Operators on texts against plain Python, with nulls, empty and long texts, repeats and clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from loanloom.llm import decontaminate, language, licenses, near_duplicates, ngrams, pii, text, tokens
from loanloom.llm.queries import tokenizer_path

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TOKEN = r"[^\x20\x09-\x0D]+"


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def documents(spark, texts, **more):
    """Rows of documents, with columns whose names clash with those of results."""
    rows = [(i, t, "en", None, 0, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, spans int, node string")


def random_texts(seed, pieces, count=200, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choices(pieces, k=rng.randint(0, longest))) for _ in range(count)]


EDGE = [None, "", " ", "\n", "é", "𝄞 x", "a" * 20000, "word " * 5000]


# --- helpers ----------------------------------------------------------------


def test_words_match_the_expression():
    texts = random_texts(1, ["a", "B", " ", "é", "9", "-", "\t", "ß", "日", "\x7f"]) + EDGE
    column = pa.array(texts)
    for kind, pattern in ((text.WORD_BYTES, WORD), (text.TOKEN_BYTES, TOKEN)):
        words = text.Words(column, kind)
        got = [w.decode() for w in words.array().to_pylist()]
        want = [re.findall(pattern, lower(t)) for t in texts]
        assert got == [w for ws in want for w in ws]
        assert words.counts.tolist() == [len(w) for w in want]
        seen = {}
        assert all(seen.setdefault(h, w) == w for h, w in zip(words.hashes().tolist(), got))
        assert len(seen) == len(set(got))


def test_slices_of_batches_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 5, 100, 3, 3, 50)]})
    parts = list(text.steps([batch], "text", 10))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 2
    sliced = text.Words(batch.slice(2, 2).column("text"), text.WORD_BYTES)
    assert sliced.counts.tolist() == [1, 1]


# --- personal data ----------------------------------------------------------


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def figures(m):
    return re.sub("[^0-9]", "", m)


BASE = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(figures(m)) <= 19 and luhn(figures(m))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(figures(m)) <= 15),
)


def test_pii_base_spans(spark):
    pieces = [
        "a@b.co", "x_y", "@", "..", "1.2.3.4", "255.255.0.1", "256.1.1.1", "4111 1111 1111 1111", "4337166598464399",
        "+1 (988) 555-2485", "+", "é", "𝄞", " ", "-", "12", "a", "b.com", "001.002.003.0004", "\n", "card ", "٣",
    ]
    texts = random_texts(3, pieces, 400, 25) + EDGE + ["a.b@c.d " * 700, "1" * 3000, "1.1.1.1 " * 600, "+1" * 2000]
    found = {r.doc_id: r for r in pii.digest(pii.find(documents(spark, texts), ["doc_id"])).collect()}
    assert len(found) == len(texts)
    for i, t in enumerate(texts):
        spans = []
        for k, (kind, pattern, valid) in enumerate(BASE):
            spans += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, t or "") if valid(m.group())]
        spans.sort()
        row = found[i]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
        assert row.base_sha256 == hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest()
        ours = [s for s in row.spans.split(",") if s.split(":")[0] in ("email", "ip", "card", "phone")]
        assert ours == [s[2] for s in spans]


def test_pii_checksums_and_context(spark):
    texts = ["iban GB82 WEST 1234 5698 7654 32.", "iban GB82 WEST 1234 5698 7654 33.", "ssn 123-45-6789", "part 123-45-6789", "my card 4111111111111111"]
    rows = {r.doc_id: r for r in pii.digest(pii.find(documents(spark, texts), ["doc_id"])).collect()}
    assert rows[0].spans.startswith("iban:5:32") and "iban" not in rows[1].spans
    assert rows[2].spans == "ssn:4:15" and rows[3].spans == ""
    assert float(rows[4].scores) > 0.8


def test_pii_plan_has_no_python(spark):
    plan = pii.find(documents(spark, ["x"]), ["doc_id", "spans"], prefix="__")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# --- decontamination --------------------------------------------------------


def brute_hits(texts, items, window=10):
    words = [re.findall(WORD, lower(t)) for t in texts]
    spans = defaultdict(set)
    for item, t in items:
        own = re.findall(WORD, lower(t))
        for k in range(max(1, len(own) - window + 1) if own else 0):
            spans[tuple(own[k : k + window])].add(str(item))
    out = []
    for w in words:
        hit, found = set(), set()
        for n in {len(s) for s in spans}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in spans:
                    hit |= set(range(k, k + n))
                    found |= spans[tuple(w[k : k + n])]
        out.append((len(w), len(hit), sorted(found), hit))
    return out


@pytest.mark.parametrize("block_pairs", [10**6, 7])
def test_decontamination_against_brute_force(spark, monkeypatch, block_pairs):
    rng = random.Random(5)
    vocabulary = ["a", "b", "c", "É", "the", "7"]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([3, 4, 10, 12, 15, 2, 10])]
    items += [(7, items[2][1]), (2, items[2][1]), (8, None), (9, ""), (10, "...")]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(0, 60))) for _ in range(60)] + EDGE
    texts += [f"x {items[3][1].upper()} y", items[4][1], items[4][1]]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, words string")
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (10, block_pairs))
    rows = decontaminate.decontaminate(documents(spark, texts), benchmark, ["doc_id", "spans"], prefix="__").collect()
    assert len(rows) == len(texts)
    want = brute_hits(texts, items)
    for r in rows:
        n, hits, found, places = want[r.doc_id]
        assert (r["__n_words"], r["__n_hit"], r["__items"]) == (n, hits, found)
        assert {k for s in r["__spans"] for k in range(s.start, s.end)} == places


def test_decontamination_without_benchmark(spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    rows = decontaminate.digest(decontaminate.decontaminate(documents(spark, ["a b", None]), empty, ["doc_id"])).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(2, 0, False), (0, 0, False)]
    nothing = documents(spark, ["a"]).filter("false")
    assert decontaminate.decontaminate(nothing, empty, ["doc_id"]).count() == 0


def test_fm_index_finds_all_places():
    rng = np.random.default_rng(0)
    for _ in range(60):
        size, n = int(rng.integers(2, 6)), int(rng.integers(1, 80))
        s = np.append(rng.integers(0, size, n), 0).astype(np.int64)
        assert decontaminate.suffix_array(s, size).tolist() == sorted(range(n + 1), key=lambda i: s[i:].tolist())
        index = decontaminate.FMIndex(s, size, 3)
        patterns, lengths = np.minimum(rng.integers(1, max(size, 2), (10, 4)), size - 1), rng.integers(1, 5, 10)
        for p, k, lo, hi in zip(patterns, lengths, *index.search(patterns, lengths)):
            places = [i for i in range(n + 2 - k) if s[i : i + k].tolist() == p[:k].tolist()]
            assert sorted(index.locate(np.arange(lo, max(lo, hi))).tolist()) == places


# --- licenses ---------------------------------------------------------------


def test_license_base_phrases(spark):
    pieces = ["cc ", "by ", "CC-BY ", "general public license ", "all rights reserved. ", "x ", "all ", "rights ", "é", "cc0 "]
    texts = random_texts(9, pieces, 200, 12) + EDGE + ["cc", "by cc by"]
    rows = {r.doc_id: r for r in licenses.digest(licenses.scan(documents(spark, texts), ["doc_id"])).collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        words = re.findall(WORD, lower(t))
        hits = [(k, name) for p, name in licenses.BASE.items() for k in range(len(words)) if tuple(words[k : k + len(p)]) == p]
        places = [k for k, _ in hits]
        want = (len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in hits})))
        assert (rows[i].n_words, rows[i].n_base, rows[i].first_word, rows[i].last_word, rows[i].base_labels) == want
        assert set(filter(None, rows[i].base_labels.split(","))) <= set(rows[i].labels.split(","))
        assert 0 <= rows[i].score <= 1


def test_license_rules(spark):
    assert len(licenses.RULES) > 200
    texts = {
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0",
        "Licensed under the Apache License, Version 2.0": "apache-2.0",
        "under the terms of the MIT license": "mit",
        "This work is CC BY-NC-SA 4.0.": "cc-by,cc-by-nc-sa-4.0",
        "GNU Lesser General Public License version 3": "gpl,lgpl-3.0",
        "nothing here": "",
    }
    rows = licenses.digest(licenses.scan(documents(spark, list(texts)), ["doc_id", "spans"], prefix="").drop("spans")).collect()
    assert [r.labels for r in sorted(rows, key=lambda r: r.doc_id)] == list(texts.values())


# --- language ---------------------------------------------------------------


def test_language_is_learned_from_other_folds(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    extra = spark.createDataFrame([(10**6, None), (10**6 + 1, "12 34 !!"), (10**6 + 2, "")], "doc_id long, text string")
    both = docs.unionByName(extra, allowMissingColumns=True)
    rows = language.identify_held_out(both).join(both.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == both.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.doc_id >= 10**6:
            assert r.lang_pred == "und"
    held = [r for r in rows if r.held_out and r.doc_id < 10**6]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.95


def test_language_without_labels(spark):
    docs = documents(spark, ["some text", None]).withColumn("lang", F.lit(None).cast("string"))
    assert [r.lang_pred for r in language.identify_held_out(docs).collect()] == ["und", "und"]
    assert language.identify_held_out(docs.filter("false")).count() == 0


# --- language model ---------------------------------------------------------


def katz(texts, held):
    """The same model in dictionaries; checks that every history's probabilities add up to 1."""
    uni, big = Counter(), Counter()
    for t, h in zip(texts, held):
        words = re.findall(TOKEN, lower(t))
        if not h:
            uni.update([*words, "</s>"])
            big.update(zip(["<s>", *words], [*words, "</s>"]))
    total = sum(uni.values())

    def taken(counts):
        numbers = Counter(counts.values())
        d = ngrams.discounts([numbers[r] for r in range(1, ngrams.CUTOFF + 2)])
        return lambda c: d[min(c, ngrams.CUTOFF + 1)]

    d1, d2 = taken(uni), taken(big)
    unknown = sum(d1(c) for c in uni.values()) / total if total else 1.0
    lower_ = lambda w: (uni[w] - d1(uni[w])) / total if uni[w] else unknown
    after = defaultdict(dict)
    for (h, w), c in big.items():
        after[h][w] = c
    weight, count = {}, {}
    for h, ws in after.items():
        count[h] = sum(ws.values())
        weight[h] = sum(map(d2, ws.values())) / count[h] / (1 - sum(map(lower_, ws)))

    def chance(h, w):
        c = after.get(h, {}).get(w, 0)
        return (c - d2(c)) / count[h] if c else weight.get(h, 1.0) * lower_(w)

    for h in after:
        assert abs(sum(chance(h, w) for w in uni) + weight[h] * unknown - 1) < 1e-9
    out = []
    for t in texts:
        words = re.findall(TOKEN, lower(t))
        ends = [*words, "</s>"]
        base = sum(math.log10((uni[w] + 1) / (total + len(uni) + 1)) for w in ends)
        score = sum(math.log10(chance(h, w)) for h, w in zip(["<s>", *words], ends))
        out.append((len(ends), sum(uni[w] > 0 for w in ends), total, base, score))
    return out


@pytest.mark.parametrize("hot", [None, 2])
def test_katz_against_dictionaries(spark, monkeypatch, hot):
    texts = random_texts(11, ["a ", "b ", "C ", "dé ", "e\n", "f", "the "], 150, 50) + EDGE + ["a b", "a b"]
    held = [i % 5 == 2 for i in range(len(texts))]
    if hot:
        monkeypatch.setattr(ngrams, "max", lambda *a, **k: hot if a[0] == 1000 else __builtins__["max"](*a, **k), raising=False)
    monkeypatch.setattr(ngrams, "CHUNK_BYTES", 2000)
    rows = ngrams.score_texts(documents(spark, texts).repartition(3), F.col("doc_id") % 5 == 2, parts=5).collect()
    want = katz(texts, held)
    assert len(rows) == len(texts)
    for r in rows:
        n, known, total, base, score = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def test_katz_without_training_texts(spark):
    rows = ngrams.score_texts(documents(spark, ["a b", None]), F.lit(True), parts=3).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in sorted(rows, key=lambda r: r.doc_id)] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert ngrams.score_texts(documents(spark, []), F.lit(True), parts=3).count() == 0


# --- token ids --------------------------------------------------------------


def test_elias_fano_round_trip():
    rng = np.random.default_rng(0)
    for _ in range(60):
        values = np.sort(rng.integers(0, rng.integers(1, 5000), rng.integers(1, 1200)))
        packed = tokens.EliasFano.encode(values)
        assert (packed.select(np.arange(values.size)) == values).all()
    long = np.arange(0, 10**7, 1000)
    packed = tokens.EliasFano.encode(long)
    assert (packed.select(np.arange(long.size)) == long).all()
    assert 8 * (packed.low.nbytes + packed.high.nbytes + packed.ranks.nbytes) < long.size * (math.log2(1000) + 3.5)


def test_ids_equal_the_library(spark):
    from tokenizers import Tokenizer

    pieces = ["a", " ", "  ", "\n", "é", " the", "'s", "1", ".", "<|endoftext|>", "\t", "日", "ß", " x", "\x85", " ", " "]
    texts = random_texts(2, pieces, 500, 30) + [t for t in EDGE]
    docs = spark.createDataFrame([(i - 3, t) for i, t in enumerate(texts)] + [(5, "again"), (None, "no id")], "doc_id long, text string")
    path = tokenizer_path()
    manifest = tokens.write_ids(docs.repartition(4), path)
    rows = tokens.read_back(manifest).collect()
    ordered = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    library = Tokenizer.from_file(path)
    want = Counter()
    for r, e in zip(ordered, library.encode_batch([r.text or "" for r in ordered], add_special_tokens=False)):
        ids = np.array([*e.ids, tokens.END_ID], dtype="<u4")
        want[(r.doc_id, len(ids), zlib.crc32(ids.tobytes()))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ids == [r.doc_id for r in ordered]
    assert tokens.read_back(tokens.write_ids(docs.filter("false"), path)).count() == 0


# --- near duplicates --------------------------------------------------------


def brute_groups(texts, least=0.8):
    sets = []
    for t in texts:
        words = re.findall(WORD, lower(t))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("weighted", [False, True])
def test_near_duplicates_against_brute_force(spark, weighted):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for size in (6, 40, 120, 120):
        base = rng.choices(vocabulary, k=size)
        for _ in range(14):
            copy = base[:]
            for _ in range(rng.randint(0, max(1, size // 25))):
                copy[rng.randrange(size)] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [texts[0], texts[0].upper(), "a b", "a b", "a  B!", "x"] + EDGE + ["", None]
    rows = near_duplicates.near_duplicates(documents(spark, texts), ["doc_id", "node"], weighted=weighted).collect()
    assert len(rows) == len(texts)
    want = brute_groups(texts)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(3)
    shared = rng.integers(1, 2**62, 300, dtype=np.uint64)
    own = rng.integers(1, 2**62, 100, dtype=np.uint64)
    elements = np.concatenate([shared, shared, own])
    bounds = np.array([0, 300, 700])
    z = near_duplicates.prob_min_hash(elements, bounds, 2000)
    assert abs((z[0] == z[1]).mean() - 300 / 400) < 0.05
    weights = np.concatenate([np.full(300, 1.0), np.full(300, 1.0), np.full(100, 6.0)])
    z = near_duplicates.prob_min_hash(elements, bounds, 2000, weights)
    assert abs((z[0] == z[1]).mean() - 300 / 900) < 0.05
    empty = near_duplicates.prob_min_hash(np.zeros(0, dtype=np.uint64), np.array([0, 0]), 5)
    assert empty.tolist() == [[0] * 5]


def test_empty_table_of_documents(spark):
    assert near_duplicates.near_duplicates(documents(spark, []), ["doc_id"]).count() == 0
    assert near_duplicates.near_duplicates(documents(spark, [None, ""]), ["doc_id"]).count() == 2
