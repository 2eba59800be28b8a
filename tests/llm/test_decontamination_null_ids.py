"""Benchmark rows without an id against the SQL."""

import duckdb
import pytest

from loanloom.llm import decontaminate
from loanloom.llm.queries import ORACLES

ITEMS = [
    (None, "one two three four five six seven eight nine ten eleven"),
    (None, "a b c"),
    (1, "a b c"),
    (2, "q w e r"),
    (None, None),
    (None, "..."),
]
TEXTS = [
    "x one two three four five six seven eight nine ten y",
    "so A b, c. and one two three four five six seven eight nine ten eleven",
    "q w e r",
    "one two three",
    None,
    "",
]


@pytest.mark.parametrize("block_pairs", [10**6, 1])
def test_items_without_an_id(spark, monkeypatch, block_pairs):
    monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (10, block_pairs))
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontaminate.digest(decontaminate.decontaminate(docs, benchmark, ["doc_id"]))
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(TEXTS)))
    db.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    db.executemany("INSERT INTO benchmark VALUES (?, ?)", ITEMS)
    rows = db.execute(ORACLES["op10_decontaminate"])
    columns = [d[0] for d in rows.description]
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == sorted(rows.fetchall())
    assert [r.contaminated for r in got.orderBy("doc_id").collect()] == [True, True, True, False, False, False]
