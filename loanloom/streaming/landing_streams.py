"""Structured Streaming jobs that land raw vendor payloads in Bronze.

Arrival time is the landed file's modification time, not the clock of the task:
a replayed micro-batch then produces the same rows, ids and partitions, and the
idempotent append adds nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loanloom.schemas import conform
from loanloom.sources.landing import (
    IDEMPOTENCY,
    append_idempotent,
    bronze_envelope,
    correlate_context,
    correlate_requests,
    dedupe_batch,
    explode_bureau_batch,
    ingest_aml_callbacks,
    ingest_bureau_xml,
    ingest_fraud_messages,
    ingest_profile_cdc,
    replace_by_key,
    split_malformed,
    split_unmatched,
    with_event_key,
)
from loanloom.sources.ledger import land_once
from loanloom.sources.layers import has_table, read_table, table_path, write_partitioned

TABLE_OF = {
    "aecb": "bronze.aecb",
    "fraud": "bronze.fraud",
    "aml": "bronze.aml",
    "internal": "bronze.internal_profile",
}
FEW_RECORDS = 200_000  # a micro-batch up to this size has its keys broadcast
CDC_EVENT = "source_event_id STRING, internal_uuid STRING, source_generated_at TIMESTAMP, raw_payload STRING"


def bureau_files(spark: SparkSession, path: str) -> DataFrame:
    """A stream of landed XML files, each one row of text."""
    return (
        spark.readStream.format("text")
        .option("wholetext", "true")
        .load(path)
        .select("value", F.col("_metadata.file_path"), F.col("_metadata.file_modification_time").alias("arrived_at"))
    )


def message_lines(spark: SparkSession, path: str) -> DataFrame:
    """A stream of JSON messages, one per line."""
    return (
        spark.readStream.format("text")
        .load(path)
        .select("value", F.col("_metadata.file_modification_time").alias("arrived_at"))
    )


def parse_payloads(batch: DataFrame, source: str) -> DataFrame:
    """Envelope input out of a batch of raw payloads, not yet attributed."""
    arrived = F.col("arrived_at")
    if source == "aecb":
        return ingest_bureau_xml(explode_bureau_batch(batch), arrived)
    if source == "aml":
        return ingest_aml_callbacks(batch, arrived)
    if source == "fraud":
        return ingest_fraud_messages(batch, arrived)
    changes = batch.select("value", F.from_json("value", CDC_EVENT).alias("e"), arrived.alias("received_at"))
    kept = changes.select("e.*", "received_at", "value").withColumn("raw_payload", F.coalesce("raw_payload", "value"))
    return ingest_profile_cdc(kept.drop("value"))


def attribute(
    parsed: DataFrame, source: str, lookup_side: DataFrame | None, few: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Records with their application and customer, and the exceptions.

    ``lookup_side`` is the request log (bureau) or application context (AML);
    the other two sources bring both ids along, or are malformed.
    """
    if source == "aecb":
        return split_unmatched(correlate_requests(parsed, lookup_side, few), "UNMATCHED", "emirates_id")
    if source == "aml":
        return split_unmatched(correlate_context(parsed, lookup_side, few), "CONTEXT_NOT_FOUND", "application_id")
    return split_malformed(parsed, "application_id" if source == "fraud" else "source_event_id")


def land(spark: SparkSession, root: str, envelope: DataFrame, source: str, token: str) -> None:
    """Append what is new; where the last delivery wins, replace what it changes.

    Repeats of a source whose keys hold the day are looked for in the batch's days;
    those of the others may lie on any day, and the ledger knows them. ``token`` names
    the batch, and is the same if the batch is replayed.
    """
    table = TABLE_OF[source]
    keys, keep = IDEMPOTENCY[source]
    if "ingest_date" not in keys:
        land_once(spark, root, table, source, envelope, token, lambda rows: write_partitioned(rows, root, table))
        return
    days = envelope.agg(F.min("ingest_date").alias("lo"), F.max("ingest_date").alias("hi")).first()

    def held() -> DataFrame:
        return read_table(spark, root, table).filter(F.col("ingest_date").between(F.lit(days.lo), F.lit(days.hi)))

    if keep == "last":
        existing = held()
        before = with_event_key(existing).select(*keys, F.col("content_hash").alias("held_hash"))
        latest = with_event_key(dedupe_batch(envelope, source))
        changed = latest.join(before, list(keys), "inner").filter(F.col("content_hash") != F.col("held_hash"))
        changed = changed.select(*envelope.columns)
        touched = [r[0] for r in changed.select("ingest_date").distinct().collect()]
        if touched:
            days_held = with_event_key(existing.filter(F.col("ingest_date").isin(touched)))
            rows = replace_by_key(days_held, with_event_key(changed), keys)
            write_partitioned(rows.select(*envelope.columns), root, table, mode="replay")
    # Read again: a replaced day has new files.
    write_partitioned(append_idempotent(envelope, held(), source), root, table)


def land_exceptions(spark: SparkSession, root: str, exceptions: DataFrame, source: str) -> None:
    """Keep what could not be attributed, with its reason; a replay adds nothing."""
    rows = exceptions.select(
        F.lit(source).alias("source_system"),
        "exception_reason",
        "source_event_id",
        "received_at",
        F.to_date("received_at").alias("ingest_date"),
        "raw_payload",
    ).dropDuplicates(["source_event_id", "exception_reason", "received_at", "raw_payload"])
    table = "bronze.ingest_exceptions"
    if has_table(spark, root, table):
        held = spark.read.schema(rows.schema).parquet(table_path(root, table))
        # The same arrival time means the same day: earlier days hold no repeat of these rows.
        days = rows.agg(F.min("ingest_date").alias("lo"), F.max("ingest_date").alias("hi")).first()
        held = held.filter((F.col("source_system") == source) & F.col("ingest_date").between(F.lit(days.lo), F.lit(days.hi)))
        same = [rows[c].eqNullSafe(held[c]) for c in rows.columns]
        rows = rows.join(held, same, "left_anti")
    rows.write.mode("append").partitionBy("source_system", "ingest_date").parquet(table_path(root, table))


def stream_bronze(
    stream: DataFrame,
    source: str,
    root: str,
    checkpoint: str,
    lookup_side: Callable[[SparkSession], DataFrame] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start the landing job of one source.

    ``lookup_side`` is called per micro-batch, so a request logged meanwhile is
    found. The default trigger empties the backlog and stops.
    """
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        side = lookup_side(spark) if lookup_side else None
        parsed = parse_payloads(batch, source).persist()
        try:
            few = side is not None and parsed.count() <= FEW_RECORDS
            records, exceptions = attribute(parsed, source, side, few)
            land(spark, root, conform(bronze_envelope(records, source), TABLE_OF[source]), source, f"{stream_id}-{batch_id}")
            land_exceptions(spark, root, exceptions, source)
        finally:
            parsed.unpersist()

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_dedupe(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """Absorb repeats that come within ``delay``; later ones meet the idempotent append."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


