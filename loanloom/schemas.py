"""Declared column types of every table; nothing is ever inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ENVELOPE = (
    "bronze_id STRING, source_system STRING, source_event_id STRING, application_id STRING, internal_uuid STRING, "
    "received_at TIMESTAMP, source_generated_at TIMESTAMP, ingest_date DATE, content_hash STRING, "
    "schema_version STRING, raw_payload STRING"
)

_RISK_PARAMETER_TAIL = "model_id STRING, model_version STRING, model_segment STRING, calculated_at TIMESTAMP, batch_date DATE"

TABLES: dict[str, str] = {
    "bronze.aecb": _ENVELOPE,
    "bronze.fraud": _ENVELOPE,
    "bronze.aml": _ENVELOPE,
    "bronze.internal_profile": _ENVELOPE,
    "silver.internal_profile_current": (
        "internal_uuid STRING, emirates_id STRING, full_name STRING, dob DATE, email STRING, phone STRING"
    ),
    "silver.aecb_conformed": (
        "application_id STRING, internal_uuid STRING, bronze_id STRING, emirates_id STRING, full_name STRING, dob DATE, "
        "aecb_score INT, aecb_band STRING, total_outstanding DECIMAL(18,2), defaults_count INT, "
        "inquiries_last_6_months INT, aecb_report_date TIMESTAMP, aecb_received_at TIMESTAMP, "
        "identity_validation_status STRING, conformed_at TIMESTAMP, batch_date DATE"
    ),
    "silver.fraud_conformed": (
        "application_id STRING, internal_uuid STRING, bronze_id STRING, phone_normalized STRING, "
        "email_normalized STRING, fraud_score INT, risk_band STRING, device_reputation STRING, velocity_24h INT, "
        "email_age_days INT, fraud_scored_at TIMESTAMP, identity_validation_status STRING, conformed_at TIMESTAMP, "
        "batch_date DATE"
    ),
    "silver.aml_conformed": (
        "application_id STRING, internal_uuid STRING, bronze_id STRING, returned_name STRING, returned_dob DATE, "
        "aml_status STRING, pep_flag BOOLEAN, sanctions_hit BOOLEAN, match_score DECIMAL(4,3), match_decision STRING, "
        "aml_screened_at TIMESTAMP, conformed_at TIMESTAMP, batch_date DATE"
    ),
    "silver.match_audit": (
        "audit_id STRING, application_id STRING, internal_uuid STRING, source_system STRING, "
        "submitted_identifier STRING, returned_identifier STRING, match_type STRING, match_score DECIMAL(4,3), "
        "match_decision STRING, exception_reason STRING, rule_version STRING, evaluated_at TIMESTAMP, batch_date DATE"
    ),
    # The three columns after aml_match_decision are needed by the blocking rules.
    "silver.lending_application_request": (
        "application_id STRING, internal_uuid STRING, application_date DATE, aecb_score INT, aecb_band STRING, "
        "total_outstanding DECIMAL(18,2), aecb_identity_status STRING, fraud_score INT, risk_band STRING, "
        "fraud_identity_status STRING, aml_status STRING, pep_flag BOOLEAN, match_score DECIMAL(4,3), "
        "aml_match_decision STRING, emirates_id STRING, dob DATE, aecb_report_date TIMESTAMP, "
        "pending_sources ARRAY<STRING>, batch_date DATE"
    ),
    "gold.lending_application_request": (
        "application_id STRING, internal_uuid STRING, application_date DATE, aecb_score INT, aecb_band STRING, "
        "total_outstanding DECIMAL(18,2), fraud_score INT, risk_band STRING, aml_status STRING, pep_flag BOOLEAN, "
        "match_score DECIMAL(4,3), dq_status STRING, pending_sources ARRAY<STRING>, assembled_at TIMESTAMP, "
        "batch_date DATE"
    ),
    "gold.lending_application_response": (
        "application_id STRING, internal_uuid STRING, decision_outcome STRING, decision_reason_code STRING, "
        "policy_version STRING, decided_at TIMESTAMP, decided_by STRING, batch_date DATE"
    ),
    "gold.lending_applications": (
        "application_id STRING, internal_uuid STRING, product_type STRING, application_date DATE, aecb_score INT, "
        "fraud_score INT, aml_status STRING, decision_outcome STRING, decision_reason_code STRING, "
        "policy_version STRING, decided_at TIMESTAMP, decision_date DATE"
    ),
    "gold.dq_scorecard": (
        "source_system STRING, batch_date DATE, rule_name STRING, rule_tier STRING, pass_rate DECIMAL(5,4), "
        "records_evaluated BIGINT, records_failed BIGINT, score INT, evaluated_at TIMESTAMP"
    ),
    "gold.dq_alert": (
        "source_system STRING, rule_name STRING, alert_state STRING, severity STRING, metric_value DOUBLE, opened_on DATE, "
        "worst_severity STRING, runs_open INT, evaluated_at TIMESTAMP, batch_date DATE"
    ),
    "gold.decision_snapshot": (
        "application_id STRING, internal_uuid STRING, application_date DATE, aecb_score INT, aecb_band STRING, "
        "total_outstanding DECIMAL(18,2), fraud_score INT, risk_band STRING, aml_status STRING, pep_flag BOOLEAN, "
        "match_score DECIMAL(4,3), dq_status STRING, pending_sources ARRAY<STRING>, decision_outcome STRING, "
        "decision_reason_code STRING, policy_version STRING, decided_at TIMESTAMP, decided_by STRING, batch_date DATE, "
        "row_hash STRING"
    ),
    "mart.dim_customer": (
        "internal_uuid STRING, customer_segment STRING, emirate STRING, onboarded_date DATE, is_active BOOLEAN"
    ),
    "mart.dim_product": (
        "product_id STRING, application_id STRING, product_type STRING, product_name STRING, launch_date DATE"
    ),
    "mart.dim_date": (
        "date_key DATE, day_of_week STRING, month_name STRING, month_number INT, quarter STRING, year INT, "
        "is_month_end BOOLEAN"
    ),
    "mart.dim_source": "source_system STRING, source_name STRING, match_pattern STRING, delivery_pattern STRING",
    "mart.dim_loan_terms": "loan_id STRING, effective_interest_rate DECIMAL(8,6)",
    "mart.fact_loan_performance": (
        "loan_id STRING, application_id STRING, internal_uuid STRING, product_type STRING, status STRING, "
        "creation_date DATE, closure_date DATE, loan_amount DECIMAL(18,2), outstanding_amount DECIMAL(18,2), "
        "days_past_due INT, delinquency_bucket STRING, repayment_amount_mtd DECIMAL(18,2), is_default BOOLEAN, "
        "months_on_book INT, snapshot_date DATE, decision_date DATE"
    ),
    "ecl.credit_risk_signals": (
        "loan_id STRING, current_rating_notch INT, origination_rating_notch INT, watchlist_flag BOOLEAN, "
        "forbearance_flag BOOLEAN, unlikely_to_pay_flag BOOLEAN"
    ),
    "ecl.exposure_stage_history": (
        "stage_history_id STRING, loan_id STRING, reporting_date DATE, current_stage INT, previous_stage INT, "
        "stage_transition_type STRING, days_past_due INT, dpd_backstop_triggered BOOLEAN, "
        "pd_at_origination DECIMAL(8,6), pd_at_reporting_date DECIMAL(8,6), pd_deterioration_ratio DECIMAL(18,4), "
        "rating_notches_downgraded INT, watchlist_flag BOOLEAN, forbearance_flag BOOLEAN, "
        "unlikely_to_pay_flag BOOLEAN, sicr_backstop_rebutted BOOLEAN, rebuttal_reason STRING, primary_trigger STRING, "
        "classification_method STRING, override_approved_by STRING, override_justification STRING, "
        "credit_policy_version STRING, classified_at TIMESTAMP, batch_date DATE"
    ),
    "ecl.risk_parameters_pit": (
        "parameter_id STRING, loan_id STRING, reporting_date DATE, scenario_id STRING, parameter_type STRING, "
        "horizon_type STRING, period_number INT, parameter_value DECIMAL(12,6), " + _RISK_PARAMETER_TAIL
    ),
    "ecl.risk_parameters_ttc": (
        "parameter_id STRING, loan_id STRING, reporting_date DATE, parameter_type STRING, horizon_type STRING, "
        "period_number INT, parameter_value DECIMAL(12,6), cycle_window_start DATE, cycle_window_end DATE, "
        + _RISK_PARAMETER_TAIL
    ),
    "ecl.macro_scenario": (
        "scenario_id STRING, reporting_date DATE, scenario_name STRING, scenario_weight DECIMAL(5,4), "
        "uae_unemployment_rate DECIMAL(6,4), eibor_3m DECIMAL(6,4), oil_price_usd_bbl DECIMAL(8,2), "
        "real_gdp_growth_pct DECIMAL(6,4), scenario_set_version STRING, approved_by STRING, defined_at TIMESTAMP, "
        "batch_date DATE"
    ),
    "ecl.ecl_calculation": (
        "ecl_calculation_id STRING, loan_id STRING, reporting_date DATE, stage_history_id STRING, scenario_id STRING, "
        "is_probability_weighted_result BOOLEAN, current_stage INT, ecl_horizon STRING, pd_used DECIMAL(8,6), "
        "lgd_used DECIMAL(8,6), ead_used DECIMAL(18,2), gross_ecl_undiscounted DECIMAL(18,2), "
        "effective_interest_rate DECIMAL(8,6), ecl_present_value DECIMAL(18,2), pd_parameter_id STRING, "
        "lgd_parameter_id STRING, ead_parameter_id STRING, management_overlay_amount DECIMAL(18,2), "
        "overlay_justification STRING, overlay_approved_by STRING, calculation_method_version STRING, "
        "calculated_at TIMESTAMP, batch_date DATE"
    ),
    "ecl.ecl_lifetime_period_detail": (
        "period_detail_id STRING, ecl_calculation_id STRING, period_number INT, marginal_pd_this_period DECIMAL(8,6), "
        "lgd_this_period DECIMAL(8,6), ead_this_period DECIMAL(18,2), undiscounted_shortfall DECIMAL(18,2), "
        "discount_factor DECIMAL(10,8), discounted_shortfall DECIMAL(18,2), batch_date DATE"
    ),
    "bronze.aecb_request_log": "emirates_id STRING, application_id STRING, internal_uuid STRING, requested_at TIMESTAMP",
    "bronze.application_context": "application_id STRING, internal_uuid STRING",
}

# Partition columns at rest.
PARTITION_COLUMNS: dict[str, tuple[str, ...]] = {
    **{name: ("ingest_date",) for name in TABLES if name.startswith("bronze.") and TABLES[name] is _ENVELOPE},
    **{
        name: ("batch_date",)
        for name in TABLES
        if name.split(".")[0] in ("silver", "gold", "ecl") and "batch_date DATE" in TABLES[name]
    },
    "gold.lending_applications": ("product_type", "decision_date"),
    "mart.fact_loan_performance": ("product_type", "snapshot_date"),
}


def schema_of(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """``df`` with exactly the declared columns, cast; absent ones become NULL."""
    present = set(df.columns)
    return df.select(
        [
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema_of(table).fields
        ]
    )
