"""Payloads to typed columns, cross-validated against the profile."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.text import normalize_email, normalize_phone
from loanloom.operators.identity import (
    aecb_identity_status,
    aml_match_decision,
    aml_match_score,
    aml_raw_score,
    fraud_identity_status,
    join_profile,
)
from loanloom.schemas import conform

BUREAU_REPORT = (
    "Subject STRUCT<EmiratesId: STRING, FullName: STRING, DateOfBirth: STRING>, "
    "Score STRUCT<value: STRING, band: STRING>, Accounts STRUCT<totalOutstanding: STRING>, "
    "Defaults STRUCT<count: STRING>, Inquiries STRUCT<last6Months: STRING>"
)
FRAUD_RESPONSE = (
    "phone STRING, email STRING, fraud_score STRING, risk_band STRING, device_reputation STRING, "
    "velocity_24h STRING, email_age_days STRING"
)
AML_CALLBACK = "full_name STRING, dob STRING, status STRING, pep_flag STRING, sanctions_hit STRING"

_LINEAGE = ("application_id", "internal_uuid", "bronze_id", "received_at", "source_generated_at")


def parse_bureau(bronze: DataFrame) -> DataFrame:
    """Typed fields of the XML report; what cannot be read is NULL."""
    return bronze.select(*_LINEAGE, F.from_xml("raw_payload", BUREAU_REPORT).alias("r")).select(
        *_LINEAGE,
        F.col("r.Subject.EmiratesId").alias("emirates_id"),
        F.col("r.Subject.FullName").alias("full_name"),
        F.col("r.Subject.DateOfBirth").try_cast("date").alias("dob"),
        F.col("r.Score.value").try_cast("int").alias("aecb_score"),
        F.col("r.Score.band").alias("aecb_band"),
        F.col("r.Accounts.totalOutstanding").try_cast("decimal(18,2)").alias("total_outstanding"),
        F.col("r.Defaults.count").try_cast("int").alias("defaults_count"),
        F.col("r.Inquiries.last6Months").try_cast("int").alias("inquiries_last_6_months"),
    )


def parse_fraud(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_LINEAGE, F.from_json("raw_payload", FRAUD_RESPONSE).alias("r")).select(
        *_LINEAGE,
        "r.phone",
        "r.email",
        F.col("r.fraud_score").try_cast("int").alias("fraud_score"),
        "r.risk_band",
        "r.device_reputation",
        F.col("r.velocity_24h").try_cast("int").alias("velocity_24h"),
        F.col("r.email_age_days").try_cast("int").alias("email_age_days"),
    )


def parse_aml(bronze: DataFrame) -> DataFrame:
    return bronze.select(*_LINEAGE, F.from_json("raw_payload", AML_CALLBACK).alias("r")).select(
        *_LINEAGE,
        F.col("r.full_name").alias("returned_name"),
        F.col("r.dob").try_cast("date").alias("returned_dob"),
        F.col("r.status").alias("aml_status"),
        F.col("r.pep_flag").try_cast("boolean").alias("pep_flag"),
        F.col("r.sanctions_hit").try_cast("boolean").alias("sanctions_hit"),
    )


def _stamped(df: DataFrame, as_of: str) -> DataFrame:
    return df.withColumns({"conformed_at": F.current_timestamp(), "batch_date": F.lit(as_of).cast("date")})


def conform_bureau(bronze: DataFrame, profile: DataFrame, as_of: str) -> DataFrame:
    joined = join_profile(parse_bureau(bronze), profile).withColumns(
        {
            "aecb_report_date": F.col("source_generated_at"),
            "aecb_received_at": F.col("received_at"),
            "identity_validation_status": aecb_identity_status(F.col("emirates_id"), F.col("profile_emirates_id")),
        }
    )
    return conform(_stamped(joined, as_of), "silver.aecb_conformed")


def conform_fraud(bronze: DataFrame, profile: DataFrame, as_of: str) -> DataFrame:
    joined = join_profile(parse_fraud(bronze), profile).withColumns(
        {
            "phone_normalized": normalize_phone(F.col("phone")),
            "email_normalized": normalize_email(F.col("email")),
            "fraud_scored_at": F.col("source_generated_at"),
            "identity_validation_status": fraud_identity_status(
                F.col("phone"), F.col("email"), F.col("profile_phone"), F.col("profile_email")
            ),
        }
    )
    return conform(_stamped(joined, as_of), "silver.fraud_conformed")


def score_aml(bronze: DataFrame, profile: DataFrame) -> DataFrame:
    """Parsed callbacks with their profile and the unrounded match score."""
    return join_profile(parse_aml(bronze), profile).withColumn(
        "raw_score",
        aml_raw_score(
            F.col("profile_full_name"), F.col("profile_dob"), F.col("returned_name"), F.col("returned_dob")
        ),
    )


def conform_aml(bronze: DataFrame, profile: DataFrame, as_of: str) -> DataFrame:
    return conform_scored_aml(score_aml(bronze, profile), as_of)


def conform_scored_aml(scored: DataFrame, as_of: str) -> DataFrame:
    """Conformed rows of callbacks that were scored before."""
    scored = scored.withColumns(
        {
            "match_score": aml_match_score(F.col("raw_score")),
            "match_decision": aml_match_decision(F.col("raw_score")),
            "aml_screened_at": F.col("source_generated_at"),
        }
    )
    return conform(_stamped(scored, as_of), "silver.aml_conformed")
