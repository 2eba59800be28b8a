"""Row-by-row comparison of every query with its SQL twin."""

from __future__ import annotations

import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from loanloom.sources.sample_views import BASE_TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return float(value)
    return value


def normalised(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, con, run, sql, sf_dir):
    """Message describing the first difference, or None; and the row count."""
    df = run(spark, sf_dir)
    ours = normalised(df.collect(), df.columns)
    relation = con.sql(sql)
    theirs = normalised(relation.fetchall(), relation.columns)
    if sorted(df.columns) != sorted(relation.columns):
        return f"columns {sorted(df.columns)} != {sorted(relation.columns)}", len(ours)
    if ours != theirs:
        mine, other = set(ours), set(theirs)
        only = [r for r in ours if r not in other][:2], [r for r in theirs if r not in mine][:2]
        return f"rows {len(ours)} != {len(theirs)}; ours {only[0]} theirs {only[1]}", len(ours)
    return None, len(ours)


if __name__ == "__main__":
    import __spark_entry__ as entry
    from loanloom.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, oracle = local_session("compare"), connect(sf_dir), entry.oracle_sql()
    for key, run in entry.queries().items():
        if wanted and key not in wanted:
            continue
        start = time.time()
        try:
            message, rows = differences(spark, con, run, oracle[key], sf_dir)
        except Exception as error:  # report and go on
            message, rows = f"{type(error).__name__}: {str(error)[:700]}", -1
        print(f"{'OK  ' if message is None else 'FAIL'} {key} rows={rows} {time.time() - start:.1f}s", flush=True)
        if message:
            print("     ", message[:1500], flush=True)
