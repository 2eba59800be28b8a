"""Blocking data-quality rules; a NULL input fails its rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.keys import with_duplicate_count

# Fixed values of the rules.
EMIRATES_ID_PATTERN = r"^784-\d{4}-\d{7}-\d$"
FRESHNESS_DAYS = 30

DUPLICATE_COUNT = "duplicate_count_application_id"


def _is_match(name: str) -> Column:
    return F.col(name) == "MATCH"


def blocking_rules(as_of: str) -> dict[str, Column]:
    """What must hold for a row of the batch of ``as_of``, by the rule's name."""
    age = F.datediff(F.lit(as_of).cast("date"), "aecb_report_date")
    holds = {
        "uuid_present": F.length("internal_uuid") > 0,
        "emirates_id_format": F.col("emirates_id").rlike(EMIRATES_ID_PATTERN),
        "no_duplicate_application_id": F.col(DUPLICATE_COUNT) == 1,
        "dob_present": F.col("dob").isNotNull(),
        "aecb_freshness": age <= FRESHNESS_DAYS,
        "aml_resolved": F.col("aml_match_decision") != "NO_MATCH",
        "identity_validated": _is_match("aecb_identity_status") & _is_match("fraud_identity_status"),
    }
    return {name: F.coalesce(condition, F.lit(False)) for name, condition in holds.items()}


# Names alone need no session.
BLOCKING = (
    "uuid_present", "emirates_id_format", "no_duplicate_application_id", "dob_present", "aecb_freshness",
    "aml_resolved", "identity_validated",
)


def evaluate_must_pass(df: DataFrame, as_of: str) -> DataFrame:
    """Add the duplicate count, one ``passes_<rule>`` per rule and ``dq_status``."""
    counted = with_duplicate_count(df, "application_id", DUPLICATE_COUNT)
    flags = {f"passes_{name}": holds for name, holds in blocking_rules(as_of).items()}
    tested = counted.select("*", *[flag.alias(name) for name, flag in flags.items()])
    passed = F.lit(True)
    for name in flags:
        passed = passed & F.col(name)
    return tested.withColumn("dq_status", F.when(passed, "PASS").otherwise("BLOCKED"))


def blocked_records(df: DataFrame, as_of: str) -> DataFrame:
    return evaluate_must_pass(df, as_of).filter(F.col("dq_status") == "BLOCKED")


def passed_records(df: DataFrame, as_of: str) -> DataFrame:
    return evaluate_must_pass(df, as_of).filter(F.col("dq_status") == "PASS")


def blocked_count(evaluated: DataFrame) -> DataFrame:
    """Rows and blocked rows of an evaluated batch, in one pass."""
    return evaluated.agg(
        F.count(F.lit(1)).alias("records_evaluated"),
        F.count_if(F.col("dq_status") == "BLOCKED").alias("blocked_count"),
    )


def gold_sql_gate(silver: DataFrame, as_of: str) -> DataFrame:
    """The shorter gate: everybody answered, AML resolved, both identities match."""
    return silver.filter(
        (F.col("batch_date") == F.lit(as_of).cast("date"))
        & (F.size("pending_sources") == 0)
        & (F.col("aml_match_decision") != "NO_MATCH")
        & _is_match("aecb_identity_status")
        & _is_match("fraud_identity_status")
    )
