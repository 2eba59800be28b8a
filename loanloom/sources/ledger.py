"""Which events Bronze holds already: an index of their keys beside it.

A repeated event may come on any day, so looking for it in Bronze would read all of
Bronze for each micro-batch. The ledger keeps the keys alone, in hash buckets, and a
batch reads the buckets of its own keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.sources.landing import IDEMPOTENCY, one_per_key, with_event_key
from loanloom.sources.layers import has_table, read_table, table_path
from loanloom.sources.runs import RunTable

BUCKETS = 64


def ledger_of(spark: SparkSession, root: str, table: str, source: str) -> RunTable:
    """The ledger of a Bronze table; where Bronze came first, it is filled from it once."""
    keys = list(IDEMPOTENCY[source][0])
    ledger = RunTable(spark, f"{table_path(root, table)}_ledger")
    if ledger.manifest() is None:
        held = with_event_key(read_table(spark, root, table)).select(*keys)
        ledger.create(held.withColumn("token", F.lit("")).schema, keys, buckets=BUCKETS)
        if has_table(spark, root, table):
            ledger.append(held.distinct().withColumn("token", F.lit("")))
    return ledger


def land_once(
    spark: SparkSession, root: str, table: str, source: str, envelope: DataFrame, token: str, write: Callable[[DataFrame], None]
) -> None:
    """Write the batch's rows whose keys the ledger does not know, and note them.

    Keys are noted before their rows are written, under the batch's ``token``. If the
    job dies between the two, the batch comes again with its token: then its own keys
    count as unwritten, except for rows found in Bronze on the batch's days.
    """
    keys = list(IDEMPOTENCY[source][0])
    ledger = ledger_of(spark, root, table, source)
    keyed = with_event_key(envelope)
    wanted = keyed.select(*keys).distinct()  # whole rows move once, when those to write are known
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in keys]

    def noted(mine: bool) -> DataFrame:
        held = ledger.read(wanted)
        held = held.filter(F.col("token") == token) if mine else held
        return held.select(*[F.col(c).alias(f"__{c}") for c in keys])

    again = not wanted.join(noted(True), same, "left_semi").isEmpty()
    fresh = wanted.join(noted(False), same, "left_anti")
    ledger.append(fresh.withColumn("token", F.lit(token)))
    held = noted(True)
    if held.isEmpty():  # every event is known from other batches
        write(envelope.limit(0))
        return
    # The pick is grouped by what the join compares, so its rows stay where they are.
    parts = {c: _null_safe(c) for c in keys}
    of_key = [name for columns in parts.values() for name in columns]
    one = one_per_key(keyed.withColumns({n: v for columns in parts.values() for n, v in columns.items()}), of_key, source)
    mine = held.select(*[F.col(f"__{c}").alias(c) for c in keys])
    mine = mine.select(*[v.alias(n) for columns in parts.values() for n, v in columns.items()])
    rows = one.join(mine, of_key, "left_semi").select(*envelope.columns)
    if again:
        days = rows.agg(F.min("ingest_date").alias("lo"), F.max("ingest_date").alias("hi")).first()
        written = read_table(spark, root, table).filter(F.col("ingest_date").between(F.lit(days.lo), F.lit(days.hi)))
        rows = rows.join(written.select("bronze_id"), "bronze_id", "left_anti").select(*envelope.columns)
    write(rows)


def _null_safe(key: str) -> dict[str, Column]:
    """Columns that are equal, and never NULL, where the key is the same or missing on both sides."""
    column = F.col(key)
    return {f"__{key}": F.coalesce(column.cast("string"), F.lit("")), f"__no_{key}": column.isNull()}
