"""Raw vendor payloads to the append-only envelope.

Every function takes and returns a DataFrame and works alike on a batch and on
a micro-batch of a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.functions.text import content_hash, name_uuid
from loanloom.operators.keys import first_per_key, latest_per_key, lookup

SCHEMA_VERSION = "1.0"

# Keys under which a repeated delivery is the same record, and which delivery
# stays: the bureau's files are identical, the fraud queue overwrites, the AML
# callback that came first wins on whatever day it is repeated.
IDEMPOTENCY = {
    "aecb": (("ingest_date", "application_id", "content_hash"), "first"),
    "fraud": (("ingest_date", "application_id", "event_key"), "last"),
    "aml": (("event_key",), "first"),
    "internal": (("event_key",), "first"),
}

_REPORT_HEAD = "_reportId STRING, _generatedAt STRING, Subject STRUCT<EmiratesId: STRING>"

_FRAUD_MESSAGE = "application_id STRING, internal_uuid STRING, captured_at STRING"
_FRAUD_HEAD = "request_id STRING, scored_at STRING"
_AML_HEAD = "event_id STRING, callback_reference STRING, callback_at STRING"


def _received(received_at: Column | None) -> Column:
    return F.current_timestamp() if received_at is None else received_at


def bronze_envelope(df: DataFrame, source: str) -> DataFrame:
    """Add the envelope columns around ``raw_payload``.

    ``df`` carries ``source_event_id, application_id, internal_uuid,
    received_at, source_generated_at, raw_payload``.
    """
    hashed = df.withColumns(
        {
            "source_system": F.lit(source),
            "ingest_date": F.to_date("received_at"),
            "content_hash": content_hash(F.col("raw_payload")),
            "schema_version": F.lit(SCHEMA_VERSION),
        }
    )
    return hashed.withColumn(
        "bronze_id",
        name_uuid(*[F.col(c) for c in ("source_system", "source_event_id", "content_hash", "received_at")]),
    ).select(
        "bronze_id", "source_system", "source_event_id", "application_id", "internal_uuid", "received_at",
        "source_generated_at", "ingest_date", "content_hash", "schema_version", "raw_payload",
    )


# --- bureau: XML files ------------------------------------------------------


def explode_bureau_batch(files: DataFrame, tag: str = "Report") -> DataFrame:
    """One row per report of a landed file; ``value`` is the report's exact text.

    A file that is one report, or in which none can be told apart, stays whole.
    What a wrapper holds beside whole reports (a report that was cut off, say) is
    a row of its own, so no text is lost; correlation finds no id in it.
    """
    whole = rf"(?s)<{tag}[\s>].*?</{tag}>"
    reports = F.regexp_extract_all("value", F.lit(whole), F.lit(0))
    around = F.regexp_replace(F.regexp_replace("value", whole, ""), r"(?s)<\?.*?\?>|<!--.*?-->", "")
    around = F.regexp_replace(around, r"^\s+|\s+$", "")
    wrapper = around.rlike(r"^<(\w+)[^<>]*>\s*</\1>$")
    parts = (
        F.when((F.size(reports) == 0) | (F.size(reports) == 1) & (around == ""), F.array("value"))
        .when(wrapper | (around == ""), reports)
        .otherwise(F.concat(reports, F.array(around)))
    )
    others = [c for c in files.columns if c != "value"]
    return files.select(*others, F.posexplode(parts).alias("report_position", "value"))


def ingest_bureau_xml(reports: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Pull what correlation needs out of each report; the text itself is kept.

    ``reports`` has ``value`` and ``file_path``. Text that is not XML, or has no
    Emirates ID, gives a NULL ``emirates_id`` and never fails the batch.
    """
    head = F.from_xml("value", _REPORT_HEAD)
    arrived = _received(received_at)
    position = F.col("report_position") if "report_position" in reports.columns else F.lit(0)
    return reports.withColumn("head", head).select(
        F.col("head.Subject.EmiratesId").alias("emirates_id"),
        F.coalesce("head._reportId", F.concat_ws("#", "file_path", F.nullif(position, F.lit(0)).cast("string"))).alias(
            "source_event_id"
        ),
        F.coalesce(F.try_to_timestamp("head._generatedAt"), arrived).alias("source_generated_at"),
        arrived.alias("received_at"),
        F.col("value").alias("raw_payload"),
    )


def _asked(side: DataFrame, records: DataFrame, key: str, few: bool) -> DataFrame:
    """The part of a lookup table that ``records`` can ask for.

    ``few`` says that the caller counted the records and found them broadcastable:
    a micro-batch then filters the large table in place instead of shuffling it.
    """
    if not few:
        return side
    return side.join(F.broadcast(records.select(key).distinct()), key, "left_semi")


def correlate_requests(reports: DataFrame, request_log: DataFrame, few: bool = False) -> DataFrame:
    """Attach the application a report answers; the bureau does not echo our id.

    The latest request of an Emirates ID counts. Unmatched reports stay, with a
    NULL ``application_id``.
    """
    log = request_log.select("emirates_id", "application_id", "internal_uuid", "requested_at")
    latest = latest_per_key(
        _asked(log, reports, "emirates_id", few),
        ["emirates_id"],
        ["requested_at", "application_id"],
    ).drop("requested_at")
    return lookup(reports, latest, "emirates_id", ["raw_payload", "source_event_id"])


# --- fraud: queue messages --------------------------------------------------


def ingest_fraud_messages(messages: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Queue messages (``value``) to envelope input.

    A response without its own id gets one derived from the message, and one
    without a time stamp takes the capture time. Text without a payload is kept
    as it came.
    """
    payload = F.coalesce(F.get_json_object("value", "$.payload"), F.col("value"))
    parsed = messages.withColumns({"m": F.from_json("value", _FRAUD_MESSAGE), "raw_payload": payload}).withColumn(
        "p", F.from_json("raw_payload", _FRAUD_HEAD)
    )
    return parsed.select(
        F.coalesce("p.request_id", name_uuid(F.col("value"))).alias("source_event_id"),
        F.col("m.application_id").alias("application_id"),
        F.col("m.internal_uuid").alias("internal_uuid"),
        _received(received_at).alias("received_at"),
        F.try_to_timestamp(F.coalesce("p.scored_at", "m.captured_at")).alias("source_generated_at"),
        "raw_payload",
    )


# --- AML: callbacks ---------------------------------------------------------


def ingest_aml_callbacks(callbacks: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Webhook callbacks (``value``) to envelope input, still without a customer."""
    arrived = _received(received_at)
    return callbacks.withColumn("m", F.from_json("value", _AML_HEAD)).select(
        F.col("m.event_id").alias("source_event_id"),
        F.col("m.callback_reference").alias("application_id"),
        arrived.alias("received_at"),
        F.coalesce(F.try_to_timestamp("m.callback_at"), arrived).alias("source_generated_at"),
        F.col("value").alias("raw_payload"),
    )


def correlate_context(callbacks: DataFrame, context: DataFrame, few: bool = False) -> DataFrame:
    """Attach the customer of the echoed application id (NULL if unknown)."""
    known = _asked(context.select("application_id", "internal_uuid"), callbacks, "application_id", few)
    side = known.groupBy("application_id").agg(F.max("internal_uuid").alias("internal_uuid"))
    return lookup(callbacks, side, "application_id", ["raw_payload"])


# --- profile: change events -------------------------------------------------


def ingest_profile_cdc(changes: DataFrame) -> DataFrame:
    """Change events to envelope input; a change has no application of its own."""
    application = F.col("application_id") if "application_id" in changes.columns else F.lit(None).cast("string")
    return changes.select(
        "source_event_id", application.alias("application_id"), "internal_uuid", "received_at",
        "source_generated_at", "raw_payload",
    )


def profile_current(cdc_log: DataFrame) -> DataFrame:
    """The latest change event of each customer."""
    return latest_per_key(cdc_log, ["internal_uuid"], ["source_generated_at", "received_at", "source_event_id"])


PROFILE_IMAGE = "emirates_id STRING, full_name STRING, dob DATE, email STRING, phone STRING"


def parse_profile(current: DataFrame) -> DataFrame:
    """Typed identity columns of the latest row images."""
    return current.select("internal_uuid", F.from_json("raw_payload", PROFILE_IMAGE).alias("p")).select(
        "internal_uuid", "p.*"
    )


# --- exceptions and idempotency ---------------------------------------------


def exception_reason(correlated: DataFrame, missing: str, key: str) -> Column:
    """Why a record could not be attributed; NULL if it could."""
    malformed = F.col(key).isNull() | F.col("source_event_id").isNull()
    return F.when(malformed, "MALFORMED").when(F.col("internal_uuid").isNull(), missing)


def split_unmatched(correlated: DataFrame, missing: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Attributed records, and the exceptions with their reason.

    ``missing`` is the reason of a failed lookup (``UNMATCHED`` for the bureau,
    ``CONTEXT_NOT_FOUND`` for AML); a record without ``key`` is ``MALFORMED``.
    """
    return _split(correlated.withColumn("exception_reason", exception_reason(correlated, missing, key)))


def split_malformed(parsed: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Records of a source that brings its ids along, and those without ``key``."""
    return _split(parsed.withColumn("exception_reason", F.when(F.col(key).isNull(), "MALFORMED")))


def _split(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (
        tagged.filter(F.col("exception_reason").isNull()).drop("exception_reason"),
        tagged.filter(F.col("exception_reason").isNotNull()),
    )


def with_event_key(envelope: DataFrame) -> DataFrame:
    """The vendor's event id, or the content where it sent none: such rows are not one event."""
    return envelope.withColumn("event_key", F.coalesce("source_event_id", "content_hash"))


def dedupe_batch(envelope: DataFrame, source: str) -> DataFrame:
    """One envelope per idempotency key within a batch."""
    return one_per_key(with_event_key(envelope), IDEMPOTENCY[source][0], source).select(*envelope.columns)


def one_per_key(keyed: DataFrame, keys: Sequence[str], source: str) -> DataFrame:
    """The delivery of each key that the source keeps."""
    pick = first_per_key if IDEMPOTENCY[source][1] == "first" else latest_per_key
    return pick(keyed, keys, ["received_at", "source_generated_at", "bronze_id"])


def append_idempotent(envelope: DataFrame, existing: DataFrame, source: str) -> DataFrame:
    """The rows of ``envelope`` that are new with respect to ``existing``."""
    keys, _ = IDEMPOTENCY[source]
    seen = with_event_key(existing).select(*keys)
    fresh = with_event_key(dedupe_batch(envelope, source))
    return fresh.join(seen, list(keys), "left_anti").select(*envelope.columns)


def replace_by_key(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``existing`` with the rows of ``incoming`` put over those of the same key."""
    kept = existing.join(incoming.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(incoming)
