"""Queries that SQL can express, against DuckDB over the same tables."""

import glob
import os

import duckdb
import pytest

from loanloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    rows = db.execute(ORACLES[name])
    columns = [d[0] for d in rows.description]
    want = sorted(map(repr, rows.fetchall()))
    got = QUERIES[name](spark, sf_dir)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == want


def test_every_operator_has_a_query():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
