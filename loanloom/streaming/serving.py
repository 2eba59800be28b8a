"""The serving copy: the latest answer per key, kept current by a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from loanloom.operators.keys import latest_per_key
from loanloom.sources.runs import BUCKETS, RunTable

def merge_latest(
    batch: DataFrame,
    path: str,
    keys: Sequence[str],
    order: Sequence[str],
    buckets: int = BUCKETS,
    withdrawn: DataFrame | None = None,
) -> None:
    """Add a batch to the copy as a run of its own; readers see each key's latest row.

    What is written grows with the batch, not with the copy. Adding the same batch
    again changes nothing that is read, so a replay is safe. Rows of the keys in
    ``withdrawn`` leave the copy, unless the batch brings them again. A copy written
    with other keys, order or number of buckets is refused.
    """
    copy = RunTable(batch.sparkSession, path)
    copy.create(batch.schema, keys, order, buckets)
    copy.append(latest_per_key(batch, keys, order), withdrawn)


def serving_latest(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The copy's latest row of each key; with ``wanted``, read from the buckets of its keys only."""
    return RunTable(spark, path).read(wanted)


def stream_serving_latest(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str] = ("application_id", "source_system"),
    order: Sequence[str] = ("received_at", "bronze_id"),
    buckets: int = BUCKETS,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep the serving copy current as each vendor answers."""

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            merge_latest(batch, path, keys, order, buckets)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
