"""The same questions in plain SQL for DuckDB, written the straightforward way.

They share the input views with the queries and nothing else: joins where the
library aggregates, windows where it reduces, a full outer join where it uses
placeholders. ``CHECK_VIEWS`` are intermediate results several checks start from.
"""

from __future__ import annotations

import re

from loanloom.operators.rules import BLOCKING
from loanloom.plans.catalogue import AS_OF, DQ_AS_OF
from loanloom.sources import sample_views

D = f"DATE '{AS_OF}'"


def _uuid_of(*parts: str) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({p} AS VARCHAR), '')" for p in parts)
    return (
        f"regexp_replace(substr(sha256({text}), 1, 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', "
        r"'\1-\2-\3-\4-\5')"
    )


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _stamp(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


def _num(column: str) -> str:
    return f"CAST({column} AS DOUBLE)"


def _r(value: str, digits: int) -> str:
    """A computed double rounded half up as its decimal value would be."""
    return f"CAST(CAST(CAST({value} AS DECIMAL(30,8)) AS DECIMAL({22 + digits},{digits})) AS DOUBLE)"


def _digits(column: str) -> str:
    return f"regexp_replace({column}, '[^0-9]', '', 'g')"


def _phone(column: str) -> str:
    d = _digits(column)
    return (
        f"CASE WHEN {d} LIKE '971%' THEN '+' || {d} WHEN {d} LIKE '0%' THEN '+971' || substr({d}, 2) "
        f"ELSE '+971' || {d} END"
    )


def _email(column: str) -> str:
    return f"lower(trim({column}))"


CHECK_VIEWS: dict[str, str] = {
    "o_bureau": """
        SELECT *, CASE WHEN trim(emirates_id) = trim(profile_emirates_id) THEN 'MATCH' ELSE 'MISMATCH' END
                  AS identity_validation_status FROM bureau_answers""",
    "o_fraud": f"""
        SELECT *, CASE WHEN {_phone('phone')} = {_phone('profile_phone')} AND {_email('email')} = {_email('profile_email')}
                       THEN 'MATCH' ELSE 'MISMATCH' END AS identity_validation_status FROM fraud_answers""",
    "o_aml_raw": """
        SELECT *, jaro_winkler_similarity(lower(trim(profile_name)), lower(trim(returned_name))) AS similarity,
               0.6e0 * jaro_winkler_similarity(lower(trim(profile_name)), lower(trim(returned_name)))
               + 0.4e0 * CASE WHEN profile_dob = returned_dob THEN 1e0 ELSE 0e0 END AS raw_score FROM aml_answers""",
    "o_aml": """
        SELECT *, round(raw_score, 3) AS match_score,
               CASE WHEN raw_score >= 0.92e0 THEN 'AUTO_MATCH' WHEN raw_score >= 0.8e0 THEN 'MANUAL_REVIEW'
                    ELSE 'NO_MATCH' END AS match_decision FROM o_aml_raw""",
    # All vendors' answers one below the other; rows without an application are on their own.
    "o_answer": """
        SELECT source, coalesce(application_id, source || row_number() OVER ()) AS key, columns(* EXCLUDE (source)) FROM (
          SELECT 'aecb' AS source, * FROM o_bureau UNION ALL BY NAME
          SELECT 'fraud' AS source, * FROM o_fraud UNION ALL BY NAME
          SELECT 'aml' AS source, * FROM o_aml) answers""",
    "o_open": f"""
        SELECT key, any_value(application_id) AS application_id,
               list_filter(['aecb', 'fraud', 'aml'], lambda s: NOT list_contains(list(if(application_id IS NULL, '', source)), s)) AS waiting
        FROM o_answer GROUP BY key HAVING bool_or(batch_date = {D})""",
    "o_request": f"""
        SELECT k.application_id,
               coalesce(a.internal_uuid, f.internal_uuid, m.internal_uuid) AS internal_uuid,
               CAST(coalesce(a.aecb_report_date, f.fraud_scored_at, m.aml_screened_at) AS DATE) AS application_date,
               a.aecb_score, a.aecb_band, a.total_outstanding, a.identity_validation_status AS aecb_identity_status,
               f.fraud_score, f.risk_band, f.identity_validation_status AS fraud_identity_status,
               m.aml_status, m.pep_flag, m.match_score, m.match_decision AS aml_match_decision,
               a.emirates_id, a.dob, a.aecb_report_date, array_to_string(k.waiting, ',') AS pending_sources, {D} AS batch_date
        FROM o_open k LEFT JOIN o_answer a ON a.source = 'aecb' AND a.key = k.key
        LEFT JOIN o_answer f ON f.source = 'fraud' AND f.key = k.key
        LEFT JOIN o_answer m ON m.source = 'aml' AND m.key = k.key
        WHERE {D} IN (a.batch_date, f.batch_date, m.batch_date)""",
    "o_flags": f"""
        SELECT *, coalesce(length(internal_uuid) > 0, false) AS passes_uuid_present,
               coalesce(regexp_matches(emirates_id, '^784-[0-9]{{4}}-[0-9]{{7}}-[0-9]$'), false) AS passes_emirates_id_format,
               count(*) OVER (PARTITION BY application_id) AS duplicate_count_application_id,
               count(*) OVER (PARTITION BY application_id) = 1 AS passes_no_duplicate_application_id,
               dob IS NOT NULL AS passes_dob_present,
               coalesce(date_diff('day', CAST(aecb_report_date AS DATE), {D}) <= 30, false) AS passes_aecb_freshness,
               coalesce(aml_match_decision <> 'NO_MATCH', false) AS passes_aml_resolved,
               coalesce(aecb_identity_status = 'MATCH' AND fraud_identity_status = 'MATCH', false)
                 AS passes_identity_validated
        FROM o_request""",
    "o_evaluated": "SELECT *, CASE WHEN "
    + " AND ".join(f"passes_{r}" for r in BLOCKING)
    + " THEN 'PASS' ELSE 'BLOCKED' END AS dq_status FROM o_flags",
    "o_audit_aecb": f"""
        SELECT {_uuid_of("'aecb'", 'application_id', 'bronze_id', "'v1.0'", f"'{AS_OF}'")} AS audit_id,
               application_id, internal_uuid, 'aecb' AS source_system, profile_emirates_id AS submitted_identifier,
               emirates_id AS returned_identifier, 'DETERMINISTIC' AS match_type, CAST(NULL AS DOUBLE) AS match_score,
               CASE identity_validation_status WHEN 'MATCH' THEN 'AUTO_MATCH' ELSE 'MISMATCH' END AS match_decision,
               CASE identity_validation_status WHEN 'MATCH' THEN NULL ELSE 'emirates_id_mismatch' END AS exception_reason,
               'v1.0' AS rule_version, '{AS_OF}' AS batch_date FROM o_bureau""",
    "o_audit_fraud": f"""
        SELECT {_uuid_of("'fraud'", 'application_id', 'bronze_id', "'v1.0'", f"'{AS_OF}'")} AS audit_id,
               application_id, internal_uuid, 'fraud' AS source_system,
               profile_phone || '|' || profile_email AS submitted_identifier,
               phone || '|' || email AS returned_identifier, 'DETERMINISTIC' AS match_type,
               CAST(NULL AS DOUBLE) AS match_score,
               CASE identity_validation_status WHEN 'MATCH' THEN 'AUTO_MATCH' ELSE 'MISMATCH' END AS match_decision,
               CASE identity_validation_status WHEN 'MATCH' THEN NULL ELSE 'cross_uuid_collision' END AS exception_reason,
               'v1.0' AS rule_version, '{AS_OF}' AS batch_date FROM o_fraud""",
    "o_audit_aml": f"""
        SELECT {_uuid_of("'aml'", 'application_id', 'bronze_id', "'v1.0'", f"'{AS_OF}'")} AS audit_id,
               application_id, internal_uuid, 'aml' AS source_system,
               profile_name || '|' || coalesce(CAST(profile_dob AS VARCHAR), '') AS submitted_identifier,
               returned_name || '|' || coalesce(CAST(returned_dob AS VARCHAR), '') AS returned_identifier,
               'PROBABILISTIC' AS match_type, match_score, match_decision,
               CASE match_decision WHEN 'MANUAL_REVIEW' THEN 'weak_name_similarity'
                    WHEN 'NO_MATCH' THEN 'no_match_against_watchlist_screening' END AS exception_reason,
               'v1.0' AS rule_version, '{AS_OF}' AS batch_date FROM o_aml""",
    "o_audit": "SELECT * FROM o_audit_aecb UNION ALL SELECT * FROM o_audit_fraud UNION ALL SELECT * FROM o_audit_aml",
    "o_facts": """
        SELECT r.application_id, r.internal_uuid, p.product_type, r.application_date, r.aecb_score, r.fraud_score,
               r.aml_status, d.decision_outcome, d.decision_reason_code, d.policy_version, d.decided_at,
               CAST(d.decided_at AS DATE) AS decision_date
        FROM gold_request r JOIN decisions d USING (application_id) JOIN dim_product p USING (application_id)""",
    "o_perf": """
        SELECT *, CASE WHEN days_past_due = 0 THEN 'CURRENT' WHEN days_past_due BETWEEN 1 AND 30 THEN '1-30'
                       WHEN days_past_due BETWEEN 31 AND 60 THEN '31-60' WHEN days_past_due BETWEEN 61 AND 90 THEN '61-90'
                       ELSE '90+' END AS delinquency_bucket,
               CAST((year(snapshot_date) - year(creation_date)) * 12 + month(snapshot_date) - month(creation_date)
                    - CASE WHEN day(creation_date) > day(snapshot_date) AND snapshot_date <> last_day(snapshot_date)
                           THEN 1 ELSE 0 END AS INTEGER) AS months_on_book
        FROM servicing""",
    "o_month_end": "SELECT * FROM o_perf WHERE snapshot_date = date_trunc('month', DATE '2001-07-15') - INTERVAL 1 DAY",
    "o_pd12": """
        SELECT p.loan_id, p.reporting_date, p.parameter_value FROM pit p
        JOIN macro_scenario s ON s.scenario_id = p.scenario_id AND s.reporting_date = p.reporting_date
        WHERE p.parameter_type = 'PD' AND p.horizon_type = '12_MONTH' AND s.scenario_name = 'BASELINE'""",
    "o_first_pd": """
        SELECT o.loan_id, o.parameter_value AS pd_at_origination, o.reporting_date AS origination_reporting_date
        FROM o_pd12 o JOIN (SELECT loan_id, min(reporting_date) AS first_date FROM o_pd12 GROUP BY loan_id) e
          ON e.loan_id = o.loan_id AND e.first_date = o.reporting_date""",
    "o_pd_comparison": f"""
        SELECT c.loan_id, CAST(c.parameter_value AS DOUBLE) AS pd_at_reporting_date,
               CAST(o.pd_at_origination AS DOUBLE) AS pd_at_origination,
               CAST(c.parameter_value AS DOUBLE) / nullif(CAST(o.pd_at_origination AS DOUBLE), 0) AS pd_deterioration_ratio
        FROM o_pd12 c JOIN o_first_pd o USING (loan_id) WHERE c.reporting_date = {D}""",
    "o_triggers": f"""
        SELECT s.loan_id, s.snapshot_date, s.days_past_due, r.watchlist_flag, r.forbearance_flag, r.unlikely_to_pay_flag,
               r.origination_rating_notch - r.current_rating_notch AS rating_notches_downgraded,
               p.pd_at_origination, p.pd_at_reporting_date, p.pd_deterioration_ratio,
               coalesce(s.days_past_due >= 90, false) AS t90, coalesce(r.unlikely_to_pay_flag, false) AS tu,
               coalesce(s.days_past_due >= 30, false) AS t30, coalesce(r.watchlist_flag, false) AS tw,
               coalesce(r.forbearance_flag, false) AS tf,
               coalesce(r.origination_rating_notch - r.current_rating_notch >= 2, false) AS tn,
               coalesce(p.pd_deterioration_ratio >= 2, false) AS tp
        FROM o_perf s LEFT JOIN risk_signals r ON r.loan_id = s.loan_id
        LEFT JOIN o_pd_comparison p ON p.loan_id = s.loan_id
        WHERE s.snapshot_date = {D} AND s.status = 'ACTIVE'""",
    "o_staged": """
        SELECT *, CASE WHEN t90 OR tu THEN 3 WHEN t30 OR tw OR tf OR tn OR tp THEN 2 ELSE 1 END AS recommended_stage,
               CASE WHEN t90 THEN 'DPD_90_BACKSTOP' WHEN tu THEN 'UNLIKELY_TO_PAY' WHEN t30 THEN 'DPD_30_BACKSTOP'
                    WHEN tw THEN 'WATCHLIST' WHEN tf THEN 'FORBEARANCE' WHEN tn THEN 'RATING_DOWNGRADE_2_NOTCH'
                    WHEN tp THEN 'PD_DETERIORATION' ELSE 'NO_TRIGGER' END AS primary_trigger,
               CASE WHEN tu THEN 3 WHEN tw OR tf OR tn OR tp THEN 2 ELSE 1 END AS soft_stage,
               CASE WHEN tu THEN 'UNLIKELY_TO_PAY' WHEN tw THEN 'WATCHLIST' WHEN tf THEN 'FORBEARANCE'
                    WHEN tn THEN 'RATING_DOWNGRADE_2_NOTCH' WHEN tp THEN 'PD_DETERIORATION' ELSE 'NO_TRIGGER' END AS soft_trigger
        FROM o_triggers""",
    "o_history": f"""
        SELECT s.loan_id, '{AS_OF}' AS reporting_date, b.previous_stage, s.t30 AS dpd_backstop_triggered,
               (s.t30 AND r.loan_id IS NOT NULL) AS sicr_backstop_rebutted,
               CASE WHEN s.t30 THEN r.rebuttal_reason END AS rebuttal_reason,
               coalesce(o.override_stage, CASE WHEN s.t30 AND r.rebuttal_reason IS NOT NULL THEN s.soft_stage
                                               ELSE s.recommended_stage END) AS current_stage,
               CASE WHEN s.t30 AND r.rebuttal_reason IS NOT NULL THEN s.soft_trigger ELSE s.primary_trigger END AS primary_trigger,
               CASE WHEN o.loan_id IS NULL THEN 'AUTOMATED_RULE' ELSE 'MANUAL_OVERRIDE' END AS classification_method,
               o.override_approved_by, o.override_justification
        FROM o_staged s
        LEFT JOIN (SELECT loan_id, current_stage AS previous_stage FROM (
                     SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY reporting_date DESC) AS rn
                     FROM stage_history WHERE reporting_date < {D}) x WHERE rn = 1) b ON b.loan_id = s.loan_id
        LEFT JOIN stage_rebuttals r ON r.loan_id = s.loan_id
        LEFT JOIN stage_overrides o ON o.loan_id = s.loan_id""",
    "o_value": f"""
        SELECT p.loan_id, p.scenario_id, p.parameter_id, p.parameter_type, p.horizon_type, p.period_number,
               CAST(p.parameter_value AS DOUBLE) AS v, ms.scenario_name, CAST(ms.scenario_weight AS DOUBLE) AS w
        FROM pit p JOIN macro_scenario ms ON ms.scenario_id = p.scenario_id AND ms.reporting_date = p.reporting_date
        WHERE p.reporting_date = {D}""",
    "o_stage_now": f"SELECT loan_id, current_stage, stage_history_id FROM stage_history WHERE reporting_date = {D}",
    # Every parameter in a column: one row per loan and scenario, and one per period.
    "o_point": """
        SELECT loan_id, scenario_id, scenario_name, w,
               max(v) FILTER (kind = 'PD') AS pd, max(parameter_id) FILTER (kind = 'PD') AS pd_id,
               max(v) FILTER (kind = 'LGD') AS lgd, max(parameter_id) FILTER (kind = 'LGD') AS lgd_id,
               max(v) FILTER (kind = 'EAD') AS ead, max(parameter_id) FILTER (kind = 'EAD') AS ead_id
        FROM (SELECT *, CASE WHEN parameter_type = 'PD' AND horizon_type = '12_MONTH' THEN 'PD'
                             WHEN parameter_type <> 'PD' AND period_number IS NULL THEN parameter_type END AS kind FROM o_value) x
        GROUP BY ALL""",
    "o_by_period": """
        SELECT loan_id, scenario_id, period_number,
               max(v) FILTER (parameter_type = 'PD' AND horizon_type = 'LIFETIME') AS pd,
               max(v) FILTER (parameter_type = 'EAD') AS ead
        FROM o_value WHERE period_number IS NOT NULL GROUP BY ALL""",
    "o_stage1": """
        SELECT loan_id, current_stage, stage_history_id, scenario_id, scenario_name, w,
               pd AS pd_used, lgd AS lgd_used, ead AS ead_used, pd * lgd * ead AS ecl, pd * lgd * ead AS gross, pd_id, lgd_id, ead_id
        FROM o_point SEMI JOIN (SELECT loan_id FROM o_stage_now WHERE current_stage = 1) USING (loan_id)
        JOIN o_stage_now USING (loan_id) WHERE pd * lgd * ead IS NOT NULL""",
    "o_periods": """
        SELECT loan_id, current_stage, stage_history_id, scenario_id, scenario_name, w, period_number,
               b.pd AS marginal_pd, q.lgd AS lgd_used, coalesce(b.ead, q.ead) AS ead_this_period, q.ead AS point_ead,
               b.pd * q.lgd * coalesce(b.ead, q.ead) AS shortfall,
               power(1 + CAST(effective_interest_rate AS DOUBLE), -period_number) AS factor, lgd_id, ead_id
        FROM o_by_period b JOIN o_point q USING (loan_id, scenario_id)
        JOIN (SELECT * FROM o_stage_now WHERE current_stage = 2) h USING (loan_id)
        JOIN loan_terms USING (loan_id)
        WHERE b.pd IS NOT NULL AND q.lgd IS NOT NULL AND q.ead IS NOT NULL""",
    "o_stage2": """
        SELECT loan_id, current_stage, stage_history_id, scenario_id, scenario_name, w, CAST(NULL AS DOUBLE) AS pd_used,
               max(lgd_used) AS lgd_used, max(point_ead) AS ead_used, sum(shortfall * factor) AS ecl, sum(shortfall) AS gross,
               CAST(NULL AS VARCHAR) AS pd_id, max(lgd_id) AS lgd_id, max(ead_id) AS ead_id
        FROM o_periods GROUP BY ALL""",
    "o_stage3": """
        SELECT loan_id, current_stage, stage_history_id, scenario_id, scenario_name, w, CAST(NULL AS DOUBLE) AS pd_used,
               lgd AS lgd_used, ead AS ead_used, lgd * ead AS ecl, lgd * ead AS gross, CAST(NULL AS VARCHAR) AS pd_id, lgd_id, ead_id
        FROM (SELECT * FROM o_stage_now WHERE current_stage = 3) h JOIN o_point USING (loan_id) WHERE lgd * ead IS NOT NULL""",
    "o_figures": "SELECT * FROM o_stage1 UNION ALL SELECT * FROM o_stage2 UNION ALL SELECT * FROM o_stage3",
    "o_weighted": f"""
        SELECT loan_id, '{AS_OF}' AS reporting_date, stage, {_r('weighted', 2)} AS probability_weighted_ecl,
               {_r("by_name['BASELINE']", 2)} AS baseline_ecl, {_r("by_name['ADVERSE']", 2)} AS adverse_ecl,
               {_r("by_name['SEVERE']", 2)} AS severe_ecl
        FROM (SELECT loan_id, current_stage AS stage, sum(ecl * w) AS weighted, map_from_entries(list((scenario_name, ecl))) AS by_name
              FROM o_figures GROUP BY ALL) x""",
    "o_calculation": f"""
        SELECT loan_id, scenario_id, false AS is_probability_weighted_result, current_stage, stage_history_id,
               CASE WHEN current_stage = 1 THEN '12_MONTH' ELSE 'LIFETIME' END AS ecl_horizon,
               {_r('gross', 2)} AS gross_ecl_undiscounted, {_r('ecl', 2)} AS ecl_present_value, pd_id AS pd_parameter_id,
               lgd_id AS lgd_parameter_id, ead_id AS ead_parameter_id, 0e0 AS management_overlay_amount,
               CAST(NULL AS VARCHAR) AS overlay_justification FROM o_figures
        UNION ALL
        SELECT f.loan_id, NULL, true, f.current_stage, f.stage_history_id,
               CASE WHEN f.current_stage = 1 THEN '12_MONTH' ELSE 'LIFETIME' END,
               {_r('sum(gross * w)', 2)}, {_r('sum(ecl * w)', 2)}, NULL, NULL, NULL,
               coalesce(CAST(max(o.management_overlay_amount) AS DOUBLE), 0e0), max(o.overlay_justification)
        FROM o_figures f LEFT JOIN overlays o ON o.loan_id = f.loan_id
        GROUP BY f.loan_id, f.current_stage, f.stage_history_id""",
    "o_pairs": f"""
        SELECT loan_id, reporting_date, parameter_type, horizon_type, p.period_number,
               CAST(p.parameter_value AS DOUBLE) AS pit_value, CAST(t.parameter_value AS DOUBLE) AS ttc_value
        FROM (FROM pit WHERE reporting_date = {D}
              AND scenario_id IN (SELECT scenario_id FROM macro_scenario WHERE scenario_name = 'BASELINE')) p
        JOIN ttc t USING (loan_id, reporting_date, parameter_type, horizon_type)
        WHERE p.period_number IS NOT DISTINCT FROM t.period_number""",
    "o_divergence": """
        SELECT *, pit_value - ttc_value AS absolute_divergence,
               100 * (pit_value - ttc_value) / nullif(ttc_value, 0) AS pct FROM o_pairs""",
    "o_flagged": """
        SELECT *, CASE WHEN abs(pct) > 50 THEN 'INVESTIGATE' WHEN abs(pct) > 20 THEN 'MONITOR'
                       ELSE 'WITHIN_TOLERANCE' END AS divergence_flag FROM o_divergence""",
    "o_latest_request": """
        SELECT emirates_id, application_id, internal_uuid FROM (
          SELECT *, row_number() OVER (PARTITION BY emirates_id ORDER BY requested_at DESC, application_id DESC) AS rn
          FROM request_log) x WHERE rn = 1""",
    "o_psi_edges": """
        SELECT list_distinct(list_transform(quantile_cont(CAST(fraud_score AS DOUBLE),
               [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), lambda x: round(x, 9))) AS edges
        FROM fraud_scores WHERE is_baseline""",
    "o_psi_bins": """
        SELECT len(list_filter((SELECT list_sort(edges)[2:-2] FROM o_psi_edges), lambda e: e < fraud_score)) AS bin,
               count(*) FILTER (WHERE is_baseline) AS expected, count(*) FILTER (WHERE NOT is_baseline) AS actual
        FROM fraud_scores GROUP BY 1""",
    "o_psi": """
        SELECT sum((a - e) * ln(a / e)) AS psi FROM (
          SELECT greatest(expected / (SELECT sum(expected) FROM o_psi_bins), 1e-6) AS e,
                 greatest(actual / (SELECT sum(actual) FROM o_psi_bins), 1e-6) AS a FROM o_psi_bins) s""",
    "o_warnings": """
        SELECT 'source_completeness' AS rule_name,
               (avg(CASE WHEN aecb_score IS NULL THEN 0e0 ELSE 1e0 END) + avg(CASE WHEN fraud_score IS NULL THEN 0e0 ELSE 1e0 END)
                + avg(CASE WHEN aml_status IS NULL THEN 0e0 ELSE 1e0 END) + avg(CASE WHEN dob IS NULL THEN 0e0 ELSE 1e0 END)) / 4 AS value,
               4 AS digits, 0.95e0 AS warn_threshold, 0.9e0 AS page_threshold, false AS up FROM o_request
        UNION ALL
        SELECT 'duplicate_rate', CAST(sum(CASE WHEN n > 1 THEN n ELSE 0 END) AS DOUBLE) / sum(n), 4, 0.01e0, 0.05e0, true
        FROM (SELECT application_id, count(*) AS n FROM o_request GROUP BY application_id) c
        UNION ALL SELECT 'fraud_score_drift_psi', psi, 4, 0.1e0, 0.2e0, true FROM o_psi
        UNION ALL
        SELECT 'aecb_arrival_lag_hours', max(epoch(aecb_received_at) - epoch(CAST(batch_date AS TIMESTAMP))) / 3600e0,
               2, 2e0, 4e0, true FROM bureau_answers
        UNION ALL
        SELECT 'manual_review_queue_age_hours',
               coalesce((epoch(TIMESTAMP '2001-06-30 06:00:00') - epoch(min(aml_screened_at))) / 3600e0, 0),
               2, 4e0, 8e0, true FROM o_aml WHERE match_decision = 'MANUAL_REVIEW'""",
    "o_metrics": """
        SELECT rule_name, CASE digits WHEN 4 THEN round(value, 4) ELSE round(value, 2) END AS metric_value,
               warn_threshold, page_threshold,
               CASE WHEN up AND value >= page_threshold OR NOT up AND value <= page_threshold THEN 'PAGE'
                    WHEN up AND value >= warn_threshold OR NOT up AND value <= warn_threshold THEN 'WARN'
                    ELSE 'OK' END AS severity FROM o_warnings""",
    "o_daily": """
        WITH answers AS (
          SELECT 'aecb' AS source_system, CAST(aecb_report_date AS DATE) AS batch_date, application_id,
                 CAST(application_id IS NOT NULL AS INTEGER) + CAST(emirates_id IS NOT NULL AS INTEGER) AS held FROM bureau_answers
          UNION ALL SELECT 'aml', CAST(aml_screened_at AS DATE), application_id,
                 CAST(returned_name IS NOT NULL AS INTEGER) + CAST(returned_dob IS NOT NULL AS INTEGER) FROM aml_answers
        ), counted AS (SELECT *, count(*) OVER (PARTITION BY source_system, batch_date, application_id) AS same FROM answers),
        days AS (
          SELECT source_system, batch_date, CAST(sum(held) AS DOUBLE) / (2 * count(*)) AS complete,
                 CAST(count(*) FILTER (same > 1) AS DOUBLE) / count(*) AS repeated FROM counted GROUP BY ALL
        )
        SELECT source_system, batch_date, 'source_completeness' AS rule_name, round(complete, 4) AS metric_value, 0.95e0 AS warn_threshold,
               0.9e0 AS page_threshold, CASE WHEN complete <= 0.9e0 THEN 'PAGE' WHEN complete <= 0.95e0 THEN 'WARN' ELSE 'OK' END AS severity FROM days
        UNION ALL
        SELECT source_system, batch_date, 'duplicate_rate', round(repeated, 4), 0.01e0, 0.05e0,
               CASE WHEN repeated >= 0.05e0 THEN 'PAGE' WHEN repeated >= 0.01e0 THEN 'WARN' ELSE 'OK' END FROM days""",
    "o_owners": f"""
        SELECT DISTINCT 'phone' AS matched_on, {_phone('phone')} AS matched_value, internal_uuid AS owner_uuid FROM profile
        UNION ALL SELECT DISTINCT 'email', {_email('email')}, internal_uuid FROM profile""",
    "o_envelopes_aml": """
        SELECT c.event_id AS source_event_id, c.application_id, x.internal_uuid, c.received_at,
               'sha256:' || sha256(c.message) AS content_hash
        FROM aml_callbacks c JOIN application_context x USING (application_id)""",
}

_LAST_SIX_DATES = "decision_date >= DATE '2000-12-30'"

_TRANSITION = """CASE WHEN previous_stage IS NULL THEN 'NEW_ORIGINATION' WHEN current_stage > previous_stage THEN 'STAGE_DOWNGRADE'
    WHEN current_stage < previous_stage AND current_stage = 1 THEN 'CURE' WHEN current_stage < previous_stage THEN 'STAGE_UPGRADE'
    ELSE 'NO_CHANGE' END"""

_PCT_OF_MONTH = f"""
    WITH counted AS (
      SELECT product_type, strftime(decision_date, '%Y-%m-01') AS decision_month, decision_outcome, count(*) AS decision_count
      FROM o_facts WHERE {_LAST_SIX_DATES} GROUP BY ALL
    ), whole AS (SELECT product_type, decision_month, sum(decision_count) AS n FROM counted GROUP BY ALL)
    SELECT counted.*, {_r('100e0 * decision_count / n', 2)} AS pct_of_month
    FROM counted JOIN whole USING (product_type, decision_month)"""

_DELINQUENCY = f"""
    WITH counted AS (
      SELECT product_type, delinquency_bucket, count(*) FILTER (status = 'ACTIVE') AS loan_count FROM o_month_end GROUP BY ALL
    ), whole AS (SELECT product_type, sum(loan_count) AS n FROM counted GROUP BY ALL)
    SELECT product_type, delinquency_bucket, loan_count, {_r('100e0 * loan_count / n', 2)} AS pct_of_product
    FROM counted JOIN whole USING (product_type) WHERE loan_count > 0"""

_EVALUATED = (
    "application_id, internal_uuid, aecb_score, duplicate_count_application_id, "
    + ", ".join(f"passes_{r}" for r in BLOCKING) + ", dq_status"
)

_GATE = (
    "pending_sources = '' AND aml_match_decision <> 'NO_MATCH' AND aecb_identity_status = 'MATCH' "
    "AND fraud_identity_status = 'MATCH'"
)

CHECKS: dict[str, str] = {
    "read_layer": f"""SELECT application_id, bronze_id, aecb_score, {_day('batch_date')} AS batch_date
        FROM bureau_answers WHERE batch_date = {D}""",
    "ingest_bureau_xml": f"""SELECT emirates_id, 'R-' || b.bronze_id AS source_event_id,
        {_stamp('b.aecb_report_date')} AS source_generated_at, {_stamp('b.aecb_received_at')} AS received_at, r.raw_payload
        FROM bureau_answers b JOIN bureau_raw r USING (bronze_id)""",
    "explode_bureau_batch": """SELECT 'f-' || bronze_id AS file_path, unnest([0, 1]) AS report_position,
        raw_payload AS value FROM bureau_raw""",
    "ingest_fraud_messages": f"""SELECT coalesce(json_extract_string(message, '$.payload.request_id'), {_uuid_of('message')}) AS source_event_id,
        json_extract_string(message, '$.application_id') AS application_id,
        json_extract_string(message, '$.internal_uuid') AS internal_uuid, {_stamp('fraud_scored_at')} AS received_at,
        {_stamp("CAST(coalesce(json_extract_string(message, '$.payload.scored_at'), json_extract_string(message, '$.captured_at')) AS TIMESTAMP)")} AS source_generated_at,
        CAST(json_extract(message, '$.payload') AS VARCHAR) AS raw_payload FROM fraud_messages""",
    "ingest_aml_callbacks": f"""SELECT event_id AS source_event_id, application_id, {_stamp('received_at')} AS received_at,
        {_stamp("CAST(json_extract_string(message, '$.callback_at') AS TIMESTAMP)")} AS source_generated_at, message AS raw_payload
        FROM aml_callbacks""",
    "ingest_profile_cdc": f"""SELECT source_event_id, CAST(NULL AS VARCHAR) AS application_id, internal_uuid,
        {_stamp('received_at')} AS received_at, {_stamp('source_generated_at')} AS source_generated_at, raw_payload FROM cdc_log""",
    "bronze_envelope": f"""SELECT {_uuid_of("'internal'", 'source_event_id', "'sha256:' || sha256(raw_payload)",
                                            "rtrim(rtrim(strftime(received_at, '%Y-%m-%d %H:%M:%S.%f'), '0'), '.')")} AS bronze_id,
        'internal' AS source_system, source_event_id, CAST(NULL AS VARCHAR) AS application_id, internal_uuid,
        {_stamp('received_at')} AS received_at, {_stamp('source_generated_at')} AS source_generated_at,
        {_day('received_at')} AS ingest_date, 'sha256:' || sha256(raw_payload) AS content_hash, '1.0' AS schema_version,
        raw_payload FROM cdc_log""",
    "correlate_requests": """SELECT 'R-' || b.bronze_id AS source_event_id, b.emirates_id, r.application_id, r.internal_uuid
        FROM bureau_answers b LEFT JOIN o_latest_request r ON r.emirates_id = b.emirates_id""",
    "correlate_context": """SELECT event_id AS source_event_id, c.application_id, x.internal_uuid
        FROM aml_callbacks c LEFT JOIN application_context x ON x.application_id = c.application_id""",
    "split_unmatched": """SELECT 'R-' || b.bronze_id AS source_event_id, 'UNMATCHED' AS exception_reason FROM bureau_answers b
        WHERE NOT EXISTS (SELECT 1 FROM request_log r WHERE r.emirates_id = b.emirates_id)
        UNION ALL SELECT event_id, 'CONTEXT_NOT_FOUND' FROM aml_callbacks c
        WHERE NOT EXISTS (SELECT 1 FROM application_context x WHERE x.application_id = c.application_id)""",
    "append_idempotent": f"""SELECT source_event_id, application_id, internal_uuid, {_stamp('received_at')} AS received_at, content_hash
        FROM (SELECT *, row_number() OVER (PARTITION BY source_event_id ORDER BY received_at) AS rn FROM o_envelopes_aml) x
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM o_envelopes_aml e WHERE e.source_event_id = x.source_event_id
                                     AND e.received_at < TIMESTAMP '1998-01-01 00:00:00')""",
    "append_idempotent_bureau": f"""WITH matched AS (
          SELECT l.application_id, l.internal_uuid, {_day('r.received_at')} AS ingest_date, hour(r.received_at) AS h,
                 substr(sha256(r.raw_payload), 1, 12) AS content_key
          FROM bureau_answers b JOIN bureau_raw r USING (bronze_id) JOIN o_latest_request l ON l.emirates_id = b.emirates_id)
        SELECT DISTINCT application_id, internal_uuid, ingest_date, content_key FROM matched m
        WHERE NOT EXISTS (SELECT 1 FROM matched e WHERE e.h < 2 AND e.application_id = m.application_id
                          AND e.ingest_date = m.ingest_date AND e.content_key = m.content_key)""",
    "append_idempotent_fraud": f"""SELECT {_day('fraud_scored_at')} AS ingest_date, application_id,
        coalesce(json_extract_string(m.message, '$.payload.request_id'), {_uuid_of('m.message')}) AS source_event_id,
        'sha256:' || sha256(CAST(json_extract(m.message, '$.payload') AS VARCHAR)) AS content_hash
        FROM fraud_messages m JOIN (SELECT k, application_id FROM fraud_answers) a USING (k)
        WHERE fraud_scored_at >= TIMESTAMP '1998-01-01 00:00:00'""",
    "write_partitioned": f"""SELECT loan_id, product_type, delinquency_bucket, {_num('outstanding_amount')} AS outstanding_amount,
        {_day('snapshot_date')} AS snapshot_date FROM o_perf""",
    "export_feature_snapshot": f"""SELECT DISTINCT application_id, internal_uuid, aecb_score, {_day('batch_date')} AS batch_date
        FROM bureau_answers WHERE application_id IS NOT NULL""",
    "dim_source": """SELECT d.*, n.scorecard_rows FROM (VALUES
          ('aecb', 'UAE Credit Bureau', 'DETERMINISTIC', 'ASYNC_FILE'),
          ('fraud', 'Fraud Detection Provider', 'DETERMINISTIC', 'SYNC_API'),
          ('aml', 'AML / PEP Screening', 'PROBABILISTIC', 'ASYNC_WEBHOOK'),
          ('internal', 'Internal Customer Profile', 'DETERMINISTIC', 'CDC')) d(source_system, source_name, match_pattern, delivery_pattern)
        LEFT JOIN (SELECT source_system, count(*) AS scorecard_rows FROM scorecard_rows GROUP BY source_system) n USING (source_system)""",
    "dim_customer": """SELECT 'U' || lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS internal_uuid, c_mktsegment AS customer_segment,
        n_name AS emirate, c_acctbal >= 0 AS is_active FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "dim_product": f"""SELECT product_id, application_id, product_type, product_name, {_day('launch_date')} AS launch_date FROM dim_product""",
    "loan_terms": f"""SELECT loan_id, {_num('effective_interest_rate')} AS effective_interest_rate FROM loan_terms""",
    "dim_date": f"""SELECT {_day('d')} AS date_key, dayname(d) AS day_of_week, monthname(d) AS month_name,
        CAST(month(d) AS INTEGER) AS month_number, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter, CAST(year(d) AS INTEGER) AS year,
        last_day(d) = d AS is_month_end
        FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT min(order_date) AS lo, max(order_date) AS hi FROM applications) b) s""",
    "conform_bureau": f"""SELECT application_id, internal_uuid, bronze_id, emirates_id, full_name, {_day('dob')} AS dob, aecb_score,
        aecb_band, {_num('total_outstanding')} AS total_outstanding, defaults_count, inquiries_last_6_months,
        {_stamp('aecb_report_date')} AS aecb_report_date, {_stamp('aecb_received_at')} AS aecb_received_at,
        identity_validation_status, '{AS_OF}' AS batch_date FROM o_bureau""",
    "conform_fraud": f"""SELECT application_id, internal_uuid, bronze_id, {_phone('phone')} AS phone_normalized,
        {_email('email')} AS email_normalized, fraud_score, risk_band, device_reputation, velocity_24h, email_age_days,
        {_stamp('fraud_scored_at')} AS fraud_scored_at, identity_validation_status, '{AS_OF}' AS batch_date FROM o_fraud""",
    "conform_aml": f"""SELECT a.application_id, a.internal_uuid, a.event_id AS bronze_id, a.returned_name,
        {_day('a.returned_dob')} AS returned_dob, a.aml_status, a.pep_flag, a.sanctions_hit, a.match_score, a.match_decision,
        {_stamp('a.aml_screened_at')} AS aml_screened_at, '{AS_OF}' AS batch_date
        FROM o_aml a JOIN aml_callbacks c ON c.event_id = a.event_id""",
    "incremental_slice": f"""SELECT bronze_id, application_id, {_day('ingest_date')} AS ingest_date FROM bureau_raw
        WHERE ingest_date BETWEEN {D} - 1 AND {D}
          AND bronze_id NOT IN (SELECT bronze_id FROM bureau_answers WHERE batch_date < {D} AND batch_date >= {D} - 1)""",
    "normalize_phone": f"SELECT application_id, phone, {_phone('phone')} AS phone_normalized FROM fraud_answers",
    "normalize_email": f"SELECT application_id, email, {_email('email')} AS email_normalized FROM fraud_answers",
    "aecb_identity_status": "SELECT bronze_id, emirates_id, identity_validation_status FROM o_bureau",
    "fraud_identity_status": "SELECT bronze_id, phone, email, identity_validation_status FROM o_fraud",
    "cross_uuid_collision": f"""SELECT f.application_id, f.internal_uuid, 'phone' AS matched_on, {_phone('f.phone')} AS matched_value,
          CASE WHEN min(p.internal_uuid) = f.internal_uuid THEN max(p.internal_uuid)
               WHEN min(p.internal_uuid) <> f.internal_uuid THEN min(p.internal_uuid) END AS other_internal_uuid,
          count(*) FILTER (WHERE p.internal_uuid <> f.internal_uuid) AS other_owner_count
        FROM fraud_answers f JOIN profile p ON {_phone('p.phone')} = {_phone('f.phone')}
        GROUP BY f.application_id, f.internal_uuid, f.phone HAVING count(*) FILTER (WHERE p.internal_uuid <> f.internal_uuid) > 0
        UNION ALL
        SELECT f.application_id, f.internal_uuid, 'email', {_email('f.email')},
          CASE WHEN min(p.internal_uuid) = f.internal_uuid THEN max(p.internal_uuid) ELSE min(p.internal_uuid) END,
          count(*) FILTER (WHERE p.internal_uuid <> f.internal_uuid)
        FROM fraud_answers f JOIN profile p ON {_email('p.email')} = {_email('f.email')}
        GROUP BY f.application_id, f.internal_uuid, f.email HAVING count(*) FILTER (WHERE p.internal_uuid <> f.internal_uuid) > 0""",
    "owner_index": "SELECT * FROM o_owners",
    "collision_owners": f"""WITH returned AS (
          SELECT internal_uuid, 'phone' AS matched_on, {_phone('phone')} AS matched_value FROM fraud_answers
          UNION ALL SELECT internal_uuid, 'email', {_email('email')} FROM fraud_answers
        ), shared AS (
          SELECT DISTINCT matched_on, matched_value FROM returned JOIN o_owners USING (matched_on, matched_value)
          WHERE owner_uuid <> internal_uuid
        ) SELECT * FROM o_owners SEMI JOIN shared USING (matched_on, matched_value)""",
    "jaro_winkler": "SELECT application_id, profile_name, returned_name, round(similarity, 6) AS similarity FROM o_aml_raw",
    "aml_match_score": "SELECT application_id, match_score FROM o_aml",
    "aml_match_decision": "SELECT application_id, match_decision FROM o_aml",
    "pending_sources": "SELECT application_id, internal_uuid, pending_sources FROM o_request",
    "delinquency_bucket": f"SELECT loan_id, {_day('snapshot_date')} AS snapshot_date, days_past_due, delinquency_bucket FROM o_perf",
    "months_on_book": f"SELECT loan_id, {_day('snapshot_date')} AS snapshot_date, months_on_book FROM o_perf",
    "is_default": f"SELECT loan_id, {_day('snapshot_date')} AS snapshot_date, status, is_default FROM o_perf",
    "decision_date": f"SELECT application_id, {_day('decided_at')} AS decision_date FROM decisions",
    "discount_factor": """SELECT loan_id, period_number, round(power(1 + CAST(effective_interest_rate AS DOUBLE), -period_number), 8) AS discount_factor
        FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS period_number FROM loan_terms) t""",
    "divergence": f"""SELECT loan_id, parameter_type, horizon_type, pit_value, ttc_value,
        {_r('absolute_divergence', 6)} AS absolute_divergence, divergence_flag FROM o_flagged""",
    **{
        f"rule_{r}": f"SELECT application_id, internal_uuid, aecb_score, passes_{r} FROM o_evaluated"
        for r in BLOCKING
    },
    "evaluate_must_pass": f"SELECT {_EVALUATED} FROM o_evaluated",
    "blocked_records": f"SELECT {_EVALUATED} FROM o_evaluated WHERE dq_status = 'BLOCKED'",
    "passed_records": f"SELECT {_EVALUATED} FROM o_evaluated WHERE dq_status = 'PASS'",
    "gold_sql_gate": f"SELECT application_id, internal_uuid, aecb_score FROM o_request WHERE {_GATE}",
    "match_exceptions": "SELECT * FROM o_audit WHERE match_decision IN ('MANUAL_REVIEW', 'NO_MATCH', 'MISMATCH')",
    "loan_snapshot": f"""SELECT loan_id, product_type, days_past_due, {_num('outstanding_amount')} AS outstanding_amount, status,
        {_day('snapshot_date')} AS reporting_date FROM o_perf WHERE snapshot_date = {D} AND status = 'ACTIVE'""",
    "risk_signals": """SELECT loan_id, current_rating_notch, origination_rating_notch, watchlist_flag, forbearance_flag,
        unlikely_to_pay_flag FROM risk_signals""",
    "loans_in_stage": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, current_stage, stage_history_id
        FROM stage_history WHERE reporting_date = {D} AND current_stage IN (2, 3)""",
    "manual_review_queue": "SELECT application_id, source_system, match_score FROM o_audit WHERE match_decision = 'MANUAL_REVIEW'",
    "last_n_days": f"""SELECT application_id, '30 days' AS "window" FROM decisions WHERE batch_date >= {D} - 30
        UNION ALL SELECT application_id, '6 months' FROM decisions WHERE batch_date >= DATE '2000-12-30'""",
    "join_profile": """SELECT c.bronze_id, c.internal_uuid, p.emirates_id AS profile_emirates_id, p.phone AS profile_phone
        FROM cdc_log c JOIN profile p ON p.internal_uuid = c.internal_uuid""",
    "assemble_application_request": f"""SELECT application_id, internal_uuid, {_day('application_date')} AS application_date, aecb_score,
        aecb_band, {_num('total_outstanding')} AS total_outstanding, aecb_identity_status, fraud_score, risk_band, fraud_identity_status,
        aml_status, pep_flag, match_score, aml_match_decision, emirates_id, {_day('dob')} AS dob,
        {_stamp('aecb_report_date')} AS aecb_report_date, pending_sources, {_day('batch_date')} AS batch_date FROM o_request""",
    "build_lending_applications": f"""SELECT application_id, internal_uuid, product_type, {_day('application_date')} AS application_date,
        aecb_score, fraud_score, aml_status, decision_outcome, decision_reason_code, policy_version,
        {_stamp('decided_at')} AS decided_at, {_day('decision_date')} AS decision_date FROM o_facts""",
    "decision_snapshot": """SELECT r.application_id, r.internal_uuid, r.aecb_score, r.aml_status, d.decision_outcome, d.policy_version,
        sha256(CAST(to_json({'application_id': r.application_id, 'internal_uuid': r.internal_uuid, 'aecb_score': r.aecb_score,
               'aml_status': r.aml_status, 'decision_outcome': d.decision_outcome, 'policy_version': d.policy_version}) AS VARCHAR)) AS row_hash
        FROM gold_request r JOIN decisions d ON d.application_id = r.application_id""",
    "vintage_join": """SELECT loan_id, application_id, months_on_book, delinquency_bucket FROM o_month_end
        WHERE application_id IN (SELECT application_id FROM o_facts)""",
    "stage1_param_joins": "SELECT loan_id, scenario_name, w AS scenario_weight, pd_used, lgd_used, ead_used FROM o_stage1",
    "stage2_param_joins": f"""SELECT loan_id, scenario_name, period_number, marginal_pd, lgd_used, ead_this_period,
        {_r('shortfall', 4)} AS undiscounted_shortfall, {_r('factor', 4)} AS discount_factor FROM o_periods""",
    "stage3_param_joins": f"SELECT loan_id, scenario_name, lgd_used, ead_used, {_r('ecl', 2)} AS scenario_ecl FROM o_stage3",
    "signals_left_join": f"""SELECT s.loan_id, r.current_rating_notch, r.watchlist_flag, p.pd_at_reporting_date, p.pd_at_origination
        FROM o_perf s LEFT JOIN risk_signals r ON r.loan_id = s.loan_id LEFT JOIN o_pd_comparison p ON p.loan_id = s.loan_id
        WHERE s.snapshot_date = {D} AND s.status = 'ACTIVE'""",
    "pd_comparison": f"""SELECT loan_id, pd_at_reporting_date, pd_at_origination, {_r('pd_deterioration_ratio', 6)} AS pd_deterioration_ratio
        FROM o_pd_comparison""",
    "rollup_joins": f"""SELECT e.loan_id, p.product_type, e.current_stage, e.ecl_present_value FROM o_calculation e
        JOIN o_perf p ON p.loan_id = e.loan_id AND p.snapshot_date = {D} WHERE e.is_probability_weighted_result""",
    "pit_ttc_join": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, parameter_type, horizon_type, period_number,
        pit_value, ttc_value FROM o_pairs""",
    "scenario_scalar": f"""SELECT scenario_id, parameter_type, count(*) AS parameter_count FROM pit
        WHERE scenario_id = (SELECT scenario_id FROM macro_scenario WHERE reporting_date = {D} AND scenario_name = 'BASELINE')
        GROUP BY scenario_id, parameter_type""",
    "approval_rate_by_product_month": _PCT_OF_MONTH,
    "portfolio_health": f"""SELECT product_type, {_day('snapshot_date')} AS snapshot_date, status, count(*) AS loan_count,
        {_num('sum(outstanding_amount)')} AS total_outstanding, {_r('avg(outstanding_amount)', 2)} AS avg_outstanding
        FROM o_month_end GROUP BY product_type, snapshot_date, status""",
    "delinquency_distribution": _DELINQUENCY,
    "vintage_analysis": f"""SELECT strftime(decision_date, '%Y-%m-01') AS origination_cohort, months_on_book,
        delinquency_bucket, count(*) AS loan_count, {_num('sum(outstanding_amount)')} AS cohort_outstanding
        FROM o_month_end SEMI JOIN o_facts USING (application_id) GROUP BY ALL""",
    "volume_vs_capacity": f"""SELECT {_day('decision_date')} AS decision_date, count(*) AS decisions_made, 10000 AS launch_capacity_target,
        {_r('100e0 * count(*) / 10000', 1)} AS pct_of_launch_capacity FROM o_facts WHERE decision_date >= {D} - 30 GROUP BY decision_date""",
    "dq_trend": f"""SELECT source_system, {_day('batch_date')} AS batch_date, {_r('avg(score)', 4)} AS avg_dq_score FROM scorecard_rows
        WHERE batch_date >= DATE '{DQ_AS_OF}' - 30 GROUP BY source_system, batch_date""",
    "dq_scorecard_summary": f"""SELECT source_system, {_day('batch_date')} AS batch_date,
        {_r('sum(score * weight) / sum(weight)', 4)} AS composite_score
        FROM scorecard_rows JOIN (VALUES ('MUST_PASS', 2), ('WARNING', 1)) tiers(rule_tier, weight) USING (rule_tier)
        GROUP BY source_system, batch_date""",
    "scenario_pivot": "SELECT loan_id, baseline_ecl, adverse_ecl, severe_ecl FROM o_weighted",
    "probability_weighted_ecl": "SELECT loan_id, stage, probability_weighted_ecl FROM o_weighted",
    "stage2_lifetime_ecl": f"SELECT loan_id, scenario_name, {_r('ecl', 2)} AS scenario_ecl FROM o_stage2",
    "ecl_portfolio_rollup": f"""SELECT p.product_type, h.current_stage, count(DISTINCT e.loan_id) AS loan_count,
        {_num('sum(CAST(e.ecl_present_value AS DECIMAL(18,2)))')} AS total_ecl_provision,
        {_r('avg(CAST(e.ecl_present_value AS DECIMAL(18,2)))', 2)} AS avg_ecl_per_loan
        FROM o_calculation e JOIN stage_history h ON h.stage_history_id = e.stage_history_id
        JOIN o_perf p ON p.loan_id = e.loan_id AND p.snapshot_date = {D}
        WHERE e.is_probability_weighted_result GROUP BY p.product_type, h.current_stage""",
    "blocked_count": "SELECT count(*) AS records_evaluated, count(*) FILTER (WHERE dq_status = 'BLOCKED') AS blocked_count FROM o_evaluated",
    "scenario_weight_check": f"""SELECT {_day('s.reporting_date')} AS reporting_date, s.total_weight, s.scenario_count,
        abs(s.total_weight - 1) <= 1e-6 AS weights_valid, l.loan_count
        FROM (SELECT reporting_date, {_num('sum(scenario_weight)')} AS total_weight, count(*) AS scenario_count
              FROM macro_scenario GROUP BY reporting_date) s
        JOIN (SELECT snapshot_date, count(*) AS loan_count FROM o_perf GROUP BY snapshot_date) l ON l.snapshot_date = s.reporting_date""",
    "profile_current": f"""SELECT bronze_id, source_event_id, internal_uuid, {_stamp('received_at')} AS received_at,
        {_stamp('source_generated_at')} AS source_generated_at, {_day('ingest_date')} AS ingest_date, raw_payload FROM (
          SELECT *, row_number() OVER (PARTITION BY internal_uuid ORDER BY source_generated_at DESC, received_at DESC,
                 source_event_id DESC) AS rn FROM cdc_log) x WHERE rn = 1""",
    "profile_refresh": f"""SELECT internal_uuid, {_stamp('source_generated_at')} AS source_generated_at,
        {_stamp('received_at')} AS received_at, source_event_id FROM (
          SELECT *, row_number() OVER (PARTITION BY internal_uuid ORDER BY source_generated_at DESC, received_at DESC,
                 source_event_id DESC) AS rn FROM cdc_log) x WHERE rn = 1""",
    "current_stage": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, current_stage, stage_history_id FROM (
        SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY reporting_date DESC) AS rn FROM stage_history) x WHERE rn = 1""",
    "latest_per_key": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, current_stage FROM (
        SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY reporting_date DESC) AS rn FROM stage_history) x WHERE rn = 1""",
    "origination_pd": f"""SELECT loan_id, {_num('pd_at_origination')} AS pd_at_origination,
        {_day('origination_reporting_date')} AS origination_reporting_date FROM o_first_pd""",
    "classify_severity": """SELECT application_id, fraud_score,
        CASE WHEN fraud_score >= 90 THEN 'PAGE' WHEN fraud_score >= 60 THEN 'WARN' ELSE 'OK' END AS high_is_bad,
        CASE WHEN fraud_score <= 10 THEN 'PAGE' WHEN fraud_score <= 40 THEN 'WARN' ELSE 'OK' END AS low_is_bad FROM fraud_answers""",
    "warn_source_completeness": "SELECT * FROM o_metrics WHERE rule_name = 'source_completeness'",
    "warn_duplicate_rate": "SELECT * FROM o_metrics WHERE rule_name = 'duplicate_rate'",
    "warn_fraud_score_drift_psi": "SELECT * FROM o_metrics WHERE rule_name = 'fraud_score_drift_psi'",
    "warn_score_drift_wide": """WITH s AS (
          SELECT CAST(floor(value * 10000) AS BIGINT) AS score, ts < TIMESTAMP '2024-01-16 00:00:00' AS is_baseline FROM events
        ), edges AS (
          SELECT list_sort(list_distinct(list_transform(quantile_cont(CAST(score AS DOUBLE),
                 [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]), lambda x: round(x, 9))))[2:-2] AS inside FROM s WHERE is_baseline
        ), bins AS (
          SELECT len(list_filter(inside, lambda e: e < score)) AS bin, count(*) FILTER (WHERE is_baseline) AS expected,
                 count(*) FILTER (WHERE NOT is_baseline) AS actual FROM s, edges GROUP BY 1
        ), shares AS (
          SELECT greatest(expected / sum(expected) OVER (), 1e-6) AS e, greatest(actual / sum(actual) OVER (), 1e-6) AS a FROM bins
        ), psi AS (SELECT sum((a - e) * ln(a / e)) AS psi FROM shares)
        SELECT 'fraud_score_drift_psi' AS rule_name, round(psi, 4) AS metric_value, 0.1e0 AS warn_threshold, 0.2e0 AS page_threshold,
               CASE WHEN psi >= 0.2e0 THEN 'PAGE' WHEN psi >= 0.1e0 THEN 'WARN' ELSE 'OK' END AS severity FROM psi""",
    "warn_bureau_arrival_lag": "SELECT * FROM o_metrics WHERE rule_name = 'aecb_arrival_lag_hours'",
    "warn_manual_review_queue_age": "SELECT * FROM o_metrics WHERE rule_name = 'manual_review_queue_age_hours'",
    "bureau_arrival_lag": """SELECT bronze_id, round(lag, 2) AS lag_hours,
        CASE WHEN lag >= 4 THEN 'PAGE' WHEN lag >= 2 THEN 'WARN' ELSE 'OK' END AS lag_severity
        FROM (SELECT bronze_id, (epoch(aecb_received_at) - epoch(CAST(batch_date AS TIMESTAMP))) / 3600e0 AS lag FROM bureau_answers) x""",
    "build_dq_scorecard": "\nUNION ALL\n".join(
        f"""SELECT 'internal' AS source_system, '{AS_OF}' AS batch_date, '{r}' AS rule_name, 'MUST_PASS' AS rule_tier,
            round(avg(CASE WHEN passes_{r} THEN 1e0 ELSE 0e0 END), 4) AS pass_rate, count(*) AS records_evaluated,
            count(*) FILTER (WHERE NOT passes_{r}) AS records_failed,
            CAST(round(100 * avg(CASE WHEN passes_{r} THEN 1e0 ELSE 0e0 END)) AS INTEGER) AS score FROM o_evaluated"""
        for r in BLOCKING
    )
    + f"""\nUNION ALL SELECT 'internal', '{AS_OF}', rule_name, 'WARNING', NULL, NULL, NULL,
          CASE severity WHEN 'OK' THEN 100 WHEN 'WARN' THEN 50 ELSE 0 END FROM o_metrics""",
    "raise_alerts": "SELECT * FROM o_metrics WHERE severity <> 'OK'",
    "batch_metrics": f"SELECT source_system, {_day('batch_date')} AS batch_date, rule_name, metric_value, warn_threshold, page_threshold, severity FROM o_daily",
    "alert_episodes": f"""SELECT source_system, rule_name, {_day('min(batch_date)')} AS opened_on, {_day('max(batch_date)')} AS last_seen_on,
          {_day('any_value(ends)')} AS resolved_on, count(*) AS runs_open,
          if(max(severity = 'PAGE'), 'PAGE', 'WARN') AS worst_severity
        FROM (SELECT d.*, (SELECT min(n.batch_date) FROM o_daily n WHERE n.source_system = d.source_system
                           AND n.rule_name = d.rule_name AND n.batch_date > d.batch_date AND n.severity = 'OK') AS ends
              FROM o_daily d WHERE severity <> 'OK') bad
        GROUP BY source_system, rule_name, ends""",
    "advance_alerts": """
        WITH y AS (SELECT * FROM o_daily WHERE batch_date = DATE '2001-06-11' AND severity <> 'OK'), t AS (SELECT * FROM o_daily WHERE batch_date = DATE '2001-06-12')
        SELECT source_system, rule_name, CASE WHEN t.severity IS NULL THEN 'UNMEASURED' WHEN t.severity = 'OK' THEN 'RESOLVED'
                 WHEN y.severity IS NULL THEN 'OPENED' ELSE 'REPEATED' END AS alert_state,
               t.severity, t.metric_value, strftime(coalesce(y.batch_date, t.batch_date), '%Y-%m-%d') AS opened_on,
               if('PAGE' IN (coalesce(t.severity, ''), coalesce(y.severity, '')), 'PAGE', 'WARN') AS worst_severity,
               if(t.severity IN ('WARN', 'PAGE'), 1, 0) + if(y.severity IS NULL, 0, 1) AS runs_open, '2001-06-12' AS batch_date
        FROM t FULL JOIN y USING (source_system, rule_name) WHERE t.severity <> 'OK' OR y.severity IS NOT NULL""",
    "dup_count": """SELECT bronze_id, application_id, count(*) OVER (PARTITION BY application_id) AS duplicate_count FROM bureau_answers""",
    "pct_of_month": f"SELECT product_type, decision_month, decision_outcome, pct_of_month FROM ({_PCT_OF_MONTH}) q",
    "pct_of_product": f"SELECT product_type, delinquency_bucket, pct_of_product FROM ({_DELINQUENCY}) q",
    "stage_transition": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, current_stage, previous_stage,
        {_TRANSITION} AS stage_transition_type
        FROM (SELECT *, lag(current_stage) OVER (PARTITION BY loan_id ORDER BY reporting_date) AS previous_stage FROM stage_history) x""",
    "order_presentations": f"""SELECT *, CASE delinquency_bucket WHEN 'CURRENT' THEN 0 WHEN '1-30' THEN 1 WHEN '31-60' THEN 2
        WHEN '61-90' THEN 3 ELSE 4 END AS bucket_rank FROM ({_DELINQUENCY}) q ORDER BY product_type, bucket_rank""",
    "combine_stage_2_3": f"""SELECT loan_id, current_stage, scenario_name, {_r('ecl', 2)} AS scenario_ecl FROM o_stage2
        UNION ALL SELECT loan_id, current_stage, scenario_name, {_r('ecl', 2)} FROM o_stage3""",
    "union_match_audit": "SELECT * FROM o_audit",
    "audit_aecb": "SELECT * FROM o_audit_aecb",
    "audit_fraud": "SELECT * FROM o_audit_fraud",
    "audit_aml": "SELECT * FROM o_audit_aml",
    "build_decision_input": f"""SELECT application_id, internal_uuid, {_day('application_date')} AS application_date, aecb_score, aecb_band,
        {_num('total_outstanding')} AS total_outstanding, fraud_score, risk_band, aml_status, pep_flag, match_score, dq_status,
        pending_sources, '{AS_OF}' AS batch_date FROM o_evaluated WHERE dq_status = 'PASS' AND pending_sources = ''""",
    "build_gold_request": f"""SELECT application_id, internal_uuid, {_day('application_date')} AS application_date, aecb_score, aecb_band,
        fraud_score, risk_band, aml_status, pep_flag, match_score, pending_sources, '{AS_OF}' AS batch_date
        FROM o_request WHERE {_GATE}""",
    "write_decision_response": f"""SELECT application_id, internal_uuid, decision_outcome, decision_reason_code, policy_version,
        {_stamp('decided_at')} AS decided_at, decided_by, {_day('batch_date')} AS batch_date FROM decisions
        WHERE batch_date >= DATE '1998-01-01'""",
    "fact_loan_performance": f"""SELECT loan_id, application_id, internal_uuid, product_type, status, {_day('creation_date')} AS creation_date,
        {_num('loan_amount')} AS loan_amount, {_num('outstanding_amount')} AS outstanding_amount, days_past_due, delinquency_bucket,
        {_num('repayment_amount_mtd')} AS repayment_amount_mtd, is_default, months_on_book, {_day('snapshot_date')} AS snapshot_date,
        {_day('decision_date')} AS decision_date FROM o_perf""",
    "stage_classification": f"""SELECT loan_id, '{AS_OF}' AS reporting_date, recommended_stage, primary_trigger, days_past_due,
        pd_at_origination, pd_at_reporting_date, {_r('pd_deterioration_ratio', 6)} AS pd_deterioration_ratio,
        rating_notches_downgraded, watchlist_flag, forbearance_flag, unlikely_to_pay_flag FROM o_staged""",
    "write_stage_history": f"SELECT *, {_TRANSITION} AS stage_transition_type FROM o_history",
    "stage1_ecl": "SELECT * FROM o_weighted WHERE stage = 1",
    "stage23_ecl": "SELECT * FROM o_weighted WHERE stage IN (2, 3)",
    "write_ecl_calculation": "SELECT * EXCLUDE (stage_history_id) FROM o_calculation",
    "write_lifetime_detail": f"""SELECT {_uuid_of(_uuid_of('loan_id', f"'{AS_OF}'", 'scenario_id', "'v1.0'"), 'period_number')} AS period_detail_id,
        {_uuid_of('loan_id', f"'{AS_OF}'", 'scenario_id', "'v1.0'")} AS ecl_calculation_id, period_number,
        marginal_pd AS marginal_pd_this_period, lgd_used AS lgd_this_period, ead_this_period,
        {_r('shortfall', 2)} AS undiscounted_shortfall, round(factor, 8) AS discount_factor,
        {_r('shortfall * factor', 2)} AS discounted_shortfall FROM o_periods""",
    "overlay_check": """SELECT loan_id, management_overlay_amount FROM o_calculation
        WHERE management_overlay_amount <> 0 AND overlay_justification IS NULL""",
    "override_check": """SELECT loan_id, violations FROM (SELECT loan_id, concat_ws(',',
          CASE WHEN classification_method = 'MANUAL_OVERRIDE' AND override_approved_by IS NULL THEN 'override_without_approver' END,
          CASE WHEN classification_method = 'MANUAL_OVERRIDE' AND override_justification IS NULL THEN 'override_without_justification' END,
          CASE WHEN sicr_backstop_rebutted AND rebuttal_reason IS NULL THEN 'rebuttal_without_reason' END) AS violations
        FROM o_history) x WHERE violations <> ''""",
    "pit_vs_ttc": f"""SELECT loan_id, {_day('reporting_date')} AS reporting_date, parameter_type, horizon_type, 'BASELINE' AS pit_scenario,
        pit_value, ttc_value, {_r('absolute_divergence', 4)} AS absolute_divergence, {_r('pct', 2)} AS pct_divergence, divergence_flag
        FROM o_flagged""",
    "undefined_divergence": """SELECT parameter_type, count(*) FILTER (WHERE ttc_value = 0) AS undefined_count,
        count(*) AS parameter_count FROM o_pairs GROUP BY parameter_type""",
    "coverage_check": f"""SELECT loan_id, current_stage, covered_weight FROM (
          SELECT l.loan_id, l.current_stage, round(coalesce(sum(CASE WHEN f.scenario_name = 'SEVERE' AND p.product_type = 'bnpl'
                 THEN 0 ELSE f.w END), 0), 4) AS covered_weight
          FROM o_stage_now l LEFT JOIN o_figures f ON f.loan_id = l.loan_id
          LEFT JOIN o_perf p ON p.loan_id = l.loan_id AND p.snapshot_date = {D}
          GROUP BY l.loan_id, l.current_stage) x WHERE abs(covered_weight - 1) > 1e-6""",
    "period_gaps": f"""WITH p AS (
          SELECT s.loan_id, scenario_name, parameter_type AS kind, period_number AS n FROM pit
          JOIN (SELECT loan_id FROM o_stage_now WHERE current_stage = 2) s USING (loan_id)
          JOIN macro_scenario m ON m.scenario_id = pit.scenario_id AND m.reporting_date = {D}
          WHERE pit.reporting_date = {D} AND parameter_type IN ('PD', 'EAD')
            AND (parameter_type = 'EAD' OR (horizon_type = 'LIFETIME' AND period_number IS NOT NULL))
            AND NOT (parameter_type = 'PD' AND CAST(substr(s.loan_id, 2) AS BIGINT) % 7 = 0 AND period_number IN (2, 3))
            AND NOT (parameter_type = 'PD' AND CAST(substr(s.loan_id, 2) AS BIGINT) % 11 = 0 AND period_number = 5)
            AND NOT (parameter_type = 'EAD' AND CAST(substr(s.loan_id, 2) AS BIGINT) % 13 = 0 AND period_number IS DISTINCT FROM 4)
        ), wanted AS (
          SELECT loan_id, scenario_name, kind, unnest(generate_series(1, last)) AS n
          FROM (SELECT DISTINCT loan_id, scenario_name FROM p) l JOIN (SELECT loan_id, max(n) AS last FROM p GROUP BY 1) x USING (loan_id),
               (VALUES ('PD'), ('EAD')) AS v(kind)
        ), missing AS (
          SELECT *, n - row_number() OVER (PARTITION BY loan_id, scenario_name, kind ORDER BY n) AS island FROM wanted w
          WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.loan_id = w.loan_id AND p.scenario_name = w.scenario_name AND p.kind = w.kind
                            AND (p.n = w.n OR (p.kind = 'EAD' AND p.n IS NULL)))
        )
        SELECT loan_id, scenario_name, kind AS parameter_type, min(n) AS first_period, max(n) AS last_period, count(*) AS missing_periods
        FROM missing GROUP BY loan_id, scenario_name, kind, island""",
    "in_force": f"""SELECT loan_id, override_approved_by, {_day('valid_from')} AS valid_from, {_day('valid_to')} AS valid_to FROM (
          SELECT *, row_number() OVER (PARTITION BY loan_id ORDER BY valid_from DESC, override_approved_by DESC) AS rn FROM (
            SELECT internal_uuid AS loan_id, application_id AS override_approved_by, batch_date AS valid_from,
                   CASE WHEN decided_by = 'AUTO' THEN CAST(batch_date + INTERVAL 3000 DAY AS DATE) END AS valid_to FROM decisions) d
          WHERE valid_from <= {D} AND (valid_to IS NULL OR valid_to >= {D})) x WHERE rn = 1""",
    "reproduce_as_of": f"""SELECT parameter_id, loan_id, model_version, {_num('parameter_value')} AS parameter_value FROM pit
        WHERE model_version = 'v1' AND batch_date = DATE '2001-04-30'""",
    "reproduce_ecl": f"""SELECT known_at, loan_id, scenario_name, {_r('ecl * factor', 2)} AS scenario_ecl FROM o_figures,
        (VALUES ('{AS_OF}', false), ('2001-07-31', true)) AS v(known_at, later),
        LATERAL (SELECT CASE WHEN later AND CAST(substr(loan_id, 2) AS BIGINT) % 17 = 0 THEN 2 ELSE 1 END AS factor) f""",
    "stream_bronze": """SELECT 'internal' AS source_system, CAST(event_id AS VARCHAR) AS source_event_id,
        'U' || lpad(CAST(user_id AS VARCHAR), 12, '0') AS internal_uuid, strftime(ts, '%Y-%m-%d') AS ingest_date,
        'sha256:' || sha256(props) AS content_hash, '1.0' AS schema_version, props AS raw_payload FROM events""",
    **{
        f"stream_bronze_{name}": f"""SELECT '{source}' AS source_system, '{letter}' || event_id AS source_event_id,
        'A' || user_id AS application_id, 'U' || user_id AS internal_uuid,
        {_stamp("date_trunc('second', ts)")} AS source_generated_at, strftime(ts, '%Y-%m-%d') AS ingest_date,
        '1.0' AS schema_version FROM events WHERE {which}"""
        for name, source, letter, which in (
            ("aml", "aml", "E", "user_id % 10 <> 0"),
            ("fraud", "fraud", "Q", "true"),
            ("bureau", "aecb", "R", "user_id % 10 <> 0"),
        )
    },
    "stream_dedupe": "SELECT DISTINCT event_id, user_id, event_type FROM events",
    "stream_dedupe_batches": "SELECT DISTINCT event_id, user_id, event_type FROM events",
    "stream_serving_latest": """SELECT application_id, source_system, bronze_id, value FROM (
        SELECT user_id AS application_id, event_type AS source_system, event_id AS bronze_id, value,
               row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1""",
}


def _mentioned(sql: str) -> list[str]:
    words = set(re.findall(r"\bo_[a-z0-9_]+\b", sql))
    ordered: list[str] = []
    for name in CHECK_VIEWS:
        if name in words:
            ordered += [n for n in _mentioned(CHECK_VIEWS[name]) if n not in ordered]
            if name not in ordered:
                ordered.append(name)
    return ordered


def check_sql(key: str) -> str:
    """One self-contained statement over the given tables."""
    body = CHECKS[key].strip()
    names = _mentioned(body)
    if names:
        ctes = ",\n".join(f"{n} AS ({CHECK_VIEWS[n].strip()})" for n in names)
        body = f"WITH {ctes},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {ctes}\n{body}"
    return sample_views.duckdb_sql(body)
