"""The customers' current images, kept up to date from the change log by its new days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.schemas import schema_of
from loanloom.sources.landing import PROFILE_IMAGE, profile_current
from loanloom.sources.layers import read_table, table_path
from loanloom.sources.runs import RunTable

LOG, TABLE = "bronze.internal_profile", "silver.internal_profile_current"
KEYS, ORDER = ["internal_uuid"], ["source_generated_at", "received_at", "source_event_id"]


def _images(log: DataFrame) -> DataFrame:
    """Typed identity columns of each customer's latest change, and what makes it the latest."""
    latest = profile_current(log.select(*KEYS, *ORDER, "raw_payload"))
    image = F.from_json("raw_payload", PROFILE_IMAGE).alias("p")
    return latest.select(*KEYS, *ORDER, image).select(*schema_of(TABLE).names[:1], "p.*", *ORDER)


def refresh_profile(spark: SparkSession, root: str) -> None:
    """Merge the days of the log that came since the last call.

    The last merged day and the one before are taken again, since files may land late on
    them; a change event that is merged twice changes nothing. The log before is not read.
    """
    current = RunTable(spark, table_path(root, TABLE))
    log = read_table(spark, root, LOG)
    manifest = current.create(_images(log).schema, KEYS, ORDER)
    upto = manifest.notes.get("upto")
    if upto is not None:
        log = log.filter(F.col("ingest_date") >= F.date_sub(F.lit(upto).cast("date"), 1))
    last = log.agg(F.max("ingest_date")).first()[0]
    if last is not None:
        current.append(_images(log), notes={"upto": str(last)})


def current_profile(spark: SparkSession, root: str, wanted: DataFrame | None = None) -> DataFrame:
    """The identity columns of each customer as of the last `refresh_profile`.

    With ``wanted`` (rows with ``internal_uuid``) only the buckets of those customers are read.
    """
    return RunTable(spark, table_path(root, TABLE)).read(wanted).select(*schema_of(TABLE).names)
