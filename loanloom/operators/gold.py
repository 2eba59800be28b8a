"""Governed request, response and joined decision tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.keys import first_per_key
from loanloom.operators.rules import evaluate_must_pass, gold_sql_gate
from loanloom.schemas import conform
from loanloom.sizing import small_side


def _assembled(df: DataFrame, as_of: str) -> DataFrame:
    stamps = {"assembled_at": F.current_timestamp(), "batch_date": F.lit(as_of).cast("date")}
    return conform(df.withColumns(stamps), "gold.lending_application_request")


def decision_input_of(evaluated: DataFrame, as_of: str) -> DataFrame:
    """The rows of an already evaluated batch that may be decided on."""
    ready = (F.col("dq_status") == "PASS") & (F.size("pending_sources") == 0)
    return _assembled(evaluated.filter(ready), as_of)


def build_decision_input(silver: DataFrame, as_of: str) -> DataFrame:
    """The day's applications that pass all blocking rules and that all vendors answered."""
    day = silver.filter(F.col("batch_date") == F.lit(as_of).cast("date"))
    return decision_input_of(evaluate_must_pass(day, as_of), as_of)


def build_gold_request(silver: DataFrame, as_of: str) -> DataFrame:
    """The shorter variant: four conditions, without outstanding amount and status."""
    return _assembled(gold_sql_gate(silver, as_of), as_of).drop("total_outstanding", "dq_status")


def decision_date(decided_at: Column) -> Column:
    return F.to_date(decided_at)


def build_lending_applications(
    request: DataFrame, response: DataFrame, product: DataFrame, as_of: str | None = None
) -> DataFrame:
    """Decided applications with their inputs and product; undecided ones stay out.

    With ``as_of`` only the responses of that run date. The product dimension has
    a row per application, so it is broadcast only while it is small.
    """
    decided = response.select(
        "application_id", "decision_outcome", "decision_reason_code", "policy_version", "decided_at", "batch_date"
    )
    if as_of is not None:
        decided = decided.filter(F.col("batch_date") == F.lit(as_of).cast("date"))
    inputs = request.select(
        "application_id", "internal_uuid", "application_date", "aecb_score", "fraud_score", "aml_status"
    )
    joined = (
        inputs.join(decided.drop("batch_date"), "application_id", "inner")
        .join(small_side(product.select("application_id", "product_type")), "application_id", "inner")
        .withColumn("decision_date", decision_date(F.col("decided_at")))
    )
    return conform(joined, "gold.lending_applications")


def write_decision_response(decisions: DataFrame, existing: DataFrame) -> DataFrame:
    """Verdicts to append: the first of each application that has none yet."""
    shaped = conform(decisions, "gold.lending_application_response")
    order = ["decided_at", "decision_outcome", "decision_reason_code"]
    first = first_per_key(shaped, ["application_id"], order)
    return first.join(existing.select("application_id"), "application_id", "left_anti").select(*shaped.columns)


def decision_snapshot(request: DataFrame, response: DataFrame) -> DataFrame:
    """Inputs and verdict frozen together, sealed by a hash over both.

    The hash is of the row as JSON with its column names, nulls written out, so
    that rows that differ in any column have different texts.
    """
    inputs = [c for c in request.columns if c not in ("application_id", "assembled_at", "batch_date")]
    verdict = [c for c in response.columns if c not in ("application_id", "internal_uuid")]
    frozen = request.select("application_id", *inputs).join(
        response.select("application_id", *verdict), "application_id", "inner"
    )
    sealed = F.to_json(F.struct("application_id", *inputs, *verdict), {"ignoreNullFields": "false"})
    return frozen.withColumn("row_hash", F.sha2(sealed, 256))
