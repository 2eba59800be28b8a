"""Lending-shaped views of the generic test tables.

Each view is one SELECT in the SQL that Spark and DuckDB share, so both engines
read the very same input rows; only what the views feed (the operators and the
check queries) is written twice. ``{explode:a,b}`` is the one place where the
two dialects differ: a generator over literal values.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-06-30"  # a month end inside the range of order dates

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Declared types of the tables the views read, so that no footer is opened to
# find them out.
BASE_SCHEMAS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, "
        "o_orderpriority STRING"
    ),
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}

_UUID = "'U' || lpad(CAST({key} AS STRING), 12, '0')"
_PHONE_DIGITS = "lpad(CAST({key} AS STRING), 8, '0')"


def _uuid(key: str) -> str:
    return _UUID.format(key=key)


def _digits(key: str) -> str:
    return _PHONE_DIGITS.format(key=key)


VIEWS: dict[str, str] = {}

# --- customers and applications -------------------------------------------

# One office line is shared by every customer of a nation: a hot phone number.
VIEWS["profile"] = f"""
SELECT {_uuid('c_custkey')} AS internal_uuid,
       '784-' || CAST(1950 + c_custkey % 50 AS STRING) || '-'
         || lpad(CAST(c_custkey AS STRING), 7, '0') || '-' || CAST(c_custkey % 10 AS STRING) AS emirates_id,
       c_name AS full_name,
       CASE WHEN c_custkey % 97 = 0 THEN NULL
            ELSE DATE '1950-01-01' + CAST(c_custkey * 131 % 18000 AS INT) END AS dob,
       lower(c_name) || '@mail.ae' AS email,
       CASE WHEN c_nationkey = 7 THEN '0500000000'
            WHEN c_custkey % 3 = 0 THEN '05' || {_digits('c_custkey')}
            ELSE '9715' || {_digits('c_custkey')} END AS phone
FROM customer
"""

VIEWS["applications"] = f"""
SELECT o_orderkey AS k,
       o_custkey AS custkey,
       'APP-' || CAST(o_orderkey AS STRING) AS application_id,
       {_uuid('o_custkey')} AS internal_uuid,
       CASE o_orderkey % 3 WHEN 0 THEN 'personal_finance' WHEN 1 THEN 'bnpl'
            ELSE 'credit_card_alternative' END AS product_type,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(floor(o_totalprice) AS BIGINT) AS price,
       o_orderstatus AS order_status,
       o_orderpriority AS priority
FROM orders
"""

# Small-ticket applications are the ones some vendors have not answered yet.
# Large-ticket ones were answered twice (duplicate application ids).
VIEWS["bureau_answers"] = f"""
SELECT a.k,
       CASE WHEN a.k % 211 = 0 THEN NULL ELSE a.application_id END AS application_id,
       a.internal_uuid,
       'B-' || CAST(a.k AS STRING) || '-' || CAST(a.copy AS STRING) AS bronze_id,
       CASE WHEN a.k % 19 = 0 THEN '784-1900-0000000-0' ELSE p.emirates_id END AS emirates_id,
       p.full_name,
       p.dob,
       CAST(300 + a.k * 17 % 600 AS INT) AS aecb_score,
       CASE WHEN a.k * 17 % 600 >= 450 THEN 'EXCELLENT' WHEN a.k * 17 % 600 >= 300 THEN 'GOOD'
            WHEN a.k * 17 % 600 >= 150 THEN 'FAIR' ELSE 'POOR' END AS aecb_band,
       CAST(a.k * 1301 % 9000000 / 100e0 AS DECIMAL(18,2)) AS total_outstanding,
       CAST(a.k % 4 AS INT) AS defaults_count,
       CAST(a.k % 7 AS INT) AS inquiries_last_6_months,
       CAST(DATE '{AS_OF}' - CAST(a.custkey % 45 AS INT) AS TIMESTAMP) AS aecb_report_date,
       CAST(DATE '{AS_OF}' AS TIMESTAMP) + (a.k % 6) * INTERVAL 1 HOUR AS aecb_received_at,
       CASE WHEN a.order_status = 'F' THEN DATE '{AS_OF}' - 1 ELSE DATE '{AS_OF}' END AS batch_date,
       p.emirates_id AS profile_emirates_id
FROM (SELECT *, {{explode:0,1}} AS copy FROM applications) a
JOIN profile p ON p.internal_uuid = a.internal_uuid
WHERE a.price >= 50000 AND (a.copy = 0 OR a.price >= 490000)
"""

VIEWS["fraud_answers"] = f"""
SELECT a.k, a.application_id, a.internal_uuid,
       'F-' || CAST(a.k AS STRING) AS bronze_id,
       CASE WHEN a.k % 23 = 0 THEN '05' || {_digits('a.custkey + 3')}
            WHEN a.k % 4 = 0 THEN ' ' || p.phone || ' ' ELSE p.phone END AS phone,
       CASE WHEN a.k % 29 = 0 THEN 'customer#' || lpad(CAST(a.custkey + 1 AS STRING), 9, '0') || '@mail.ae'
            WHEN a.k % 4 = 1 THEN upper(p.email) ELSE p.email END AS email,
       CAST(a.k * 31 % 100 AS INT) AS fraud_score,
       CASE WHEN a.k * 31 % 100 >= 80 THEN 'HIGH' WHEN a.k * 31 % 100 >= 40 THEN 'MEDIUM' ELSE 'LOW' END AS risk_band,
       CASE WHEN a.k % 9 = 0 THEN 'BAD' ELSE 'GOOD' END AS device_reputation,
       CAST(a.k % 12 AS INT) AS velocity_24h,
       CAST(a.k * 7 % 3000 AS INT) AS email_age_days,
       CAST(a.order_date AS TIMESTAMP) AS fraud_scored_at,
       CASE WHEN a.priority IN ('1-URGENT', '2-HIGH') THEN DATE '{AS_OF}' - 1 ELSE DATE '{AS_OF}' END AS batch_date,
       p.phone AS profile_phone, p.email AS profile_email
FROM applications a JOIN profile p ON p.internal_uuid = a.internal_uuid
WHERE a.price >= 20000
"""

VIEWS["aml_answers"] = f"""
SELECT a.k, a.application_id, a.internal_uuid,
       'M-' || CAST(a.k AS STRING) AS bronze_id,
       'EV-' || CAST(a.k AS STRING) AS event_id,
       CASE a.k % 7 WHEN 0 THEN replace(p.full_name, 'Customer', 'Cutsomer')
                    WHEN 1 THEN upper(p.full_name)
                    WHEN 2 THEN 'Kastomr ' || p.full_name
                    WHEN 3 THEN 'Unrelated Person'
                    ELSE p.full_name END AS returned_name,
       CASE WHEN a.k % 23 = 0 THEN NULL WHEN a.k % 17 = 0 THEN DATE '1970-01-01' ELSE p.dob END AS returned_dob,
       CASE WHEN a.k % 13 = 0 THEN 'FLAGGED' ELSE 'CLEAR' END AS aml_status,
       (a.k % 41 = 0) AS pep_flag,
       (a.k % 83 = 0) AS sanctions_hit,
       CAST(a.order_date AS TIMESTAMP) + INTERVAL 3 HOUR AS aml_screened_at,
       CASE WHEN a.priority = '1-URGENT' THEN DATE '{AS_OF}' - 1 ELSE DATE '{AS_OF}' END AS batch_date,
       p.full_name AS profile_name, p.dob AS profile_dob
FROM applications a JOIN profile p ON p.internal_uuid = a.internal_uuid
WHERE NOT (a.priority = '3-MEDIUM' AND a.price < 30000)
"""

# --- raw payloads -----------------------------------------------------------

VIEWS["bureau_raw"] = """
SELECT bronze_id, application_id, internal_uuid, aecb_received_at AS received_at,
       aecb_report_date AS source_generated_at, CAST(aecb_received_at AS DATE) AS ingest_date, k,
       '<Report reportId="R-' || bronze_id || '" generatedAt="' || CAST(CAST(aecb_report_date AS DATE) AS STRING)
       || 'T00:00:00Z"><Subject><EmiratesId>' || emirates_id || '</EmiratesId><FullName>' || full_name
       || '</FullName>'
       || CASE WHEN dob IS NULL THEN '' ELSE '<DateOfBirth>' || CAST(dob AS STRING) || '</DateOfBirth>' END
       || '</Subject><Score><value>' || CAST(aecb_score AS STRING) || '</value><band>' || aecb_band
       || '</band></Score><Accounts><totalOutstanding>' || CAST(total_outstanding AS STRING)
       || '</totalOutstanding></Accounts><Defaults><count>' || CAST(defaults_count AS STRING)
       || '</count></Defaults><Inquiries><last6Months>' || CAST(inquiries_last_6_months AS STRING)
       || '</last6Months></Inquiries></Report>' AS raw_payload
FROM bureau_answers
"""

# Every tenth response lacks its own id and time stamp, so the defaults apply.
VIEWS["fraud_messages"] = """
SELECT k, fraud_scored_at,
       '{"application_id":"' || application_id || '","internal_uuid":"' || internal_uuid || '","payload":{'
       || CASE WHEN k % 10 = 0 THEN '' ELSE '"request_id":"FR-' || CAST(k AS STRING) || '","scored_at":"'
            || CAST(CAST(fraud_scored_at AS DATE) AS STRING) || 'T00:00:00",' END
       || '"phone":"' || phone || '","email":"' || email || '","fraud_score":' || CAST(fraud_score AS STRING)
       || ',"risk_band":"' || risk_band || '","device_reputation":"' || device_reputation
       || '","velocity_24h":' || CAST(velocity_24h AS STRING)
       || ',"email_age_days":' || CAST(email_age_days AS STRING)
       || '},"captured_at":"' || CAST(CAST(fraud_scored_at AS DATE) AS STRING) || 'T01:00:00"}' AS message
FROM fraud_answers
"""

VIEWS["fraud_raw"] = """
SELECT bronze_id, application_id, internal_uuid, fraud_scored_at AS source_generated_at,
       fraud_scored_at AS received_at, CAST(fraud_scored_at AS DATE) AS ingest_date,
       '{"phone":"' || phone || '","email":"' || email || '","fraud_score":' || CAST(fraud_score AS STRING)
       || ',"risk_band":"' || risk_band || '","device_reputation":"' || device_reputation
       || '","velocity_24h":' || CAST(velocity_24h AS STRING)
       || ',"email_age_days":' || CAST(email_age_days AS STRING) || '}' AS raw_payload
FROM fraud_answers
"""

# Callbacks of FLAGGED people are delivered twice, the second time next day.
VIEWS["aml_callbacks"] = """
SELECT k, event_id, application_id, received_at, message FROM (
  SELECT a.k, a.event_id, a.application_id, {explode:0,1} AS copy, a.aml_status,
         a.aml_screened_at AS received_at,
         '{"event_id":"' || a.event_id || '","callback_reference":"' || a.application_id
         || '","callback_at":"' || CAST(CAST(a.aml_screened_at AS DATE) AS STRING) || 'T03:00:00","full_name":"'
         || a.returned_name || '",'
         || CASE WHEN a.returned_dob IS NULL THEN '' ELSE '"dob":"' || CAST(a.returned_dob AS STRING) || '",' END
         || '"status":"' || a.aml_status || '","pep_flag":' || CASE WHEN a.pep_flag THEN 'true' ELSE 'false' END
         || ',"sanctions_hit":' || CASE WHEN a.sanctions_hit THEN 'true' ELSE 'false' END || '}' AS message
  FROM aml_answers a) d
WHERE copy = 0 OR aml_status = 'FLAGGED'
"""

VIEWS["aml_raw"] = """
SELECT event_id AS bronze_id, c.application_id, p.internal_uuid, c.received_at,
       c.received_at AS source_generated_at, CAST(c.received_at AS DATE) AS ingest_date, message AS raw_payload
FROM aml_callbacks c JOIN applications p ON p.application_id = c.application_id
"""

VIEWS["request_log"] = """
SELECT p.emirates_id, a.application_id, a.internal_uuid, CAST(a.order_date AS TIMESTAMP) AS requested_at
FROM applications a JOIN profile p ON p.internal_uuid = a.internal_uuid
"""

# Context of applications that were cancelled (status P, urgent) is gone.
VIEWS["application_context"] = """
SELECT application_id, internal_uuid FROM applications
WHERE NOT (order_status = 'P' AND priority = '1-URGENT')
"""

VIEWS["cdc_log"] = """
SELECT 'C-' || CAST(event_id AS STRING) AS bronze_id, CAST(event_id AS STRING) AS source_event_id,
       'U' || lpad(CAST(user_id AS STRING), 12, '0') AS internal_uuid,
       CAST(ts AS TIMESTAMP) AS received_at, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS source_generated_at,
       CAST(ts AS DATE) AS ingest_date, props AS raw_payload
FROM events
"""

# --- gold -------------------------------------------------------------------

VIEWS["gold_request"] = """
SELECT application_id, internal_uuid, order_date AS application_date,
       CAST(300 + k * 17 % 600 AS INT) AS aecb_score, CAST(k * 31 % 100 AS INT) AS fraud_score,
       CASE WHEN k % 13 = 0 THEN 'FLAGGED' ELSE 'CLEAR' END AS aml_status, order_date AS batch_date
FROM applications
"""

VIEWS["decisions"] = """
SELECT application_id, internal_uuid,
       CASE order_status WHEN 'F' THEN 'APPROVED' WHEN 'P' THEN 'DECLINED' ELSE 'REFER' END AS decision_outcome,
       'RC' || CAST(k % 9 AS STRING) AS decision_reason_code, 'P1' AS policy_version,
       CAST(order_date AS TIMESTAMP) + (k % 20) * INTERVAL 1 HOUR AS decided_at,
       CASE WHEN k % 5 = 0 THEN 'UW-1' ELSE 'AUTO' END AS decided_by, order_date AS batch_date
FROM applications
"""

VIEWS["dim_product"] = """
SELECT 'PR-' || CAST(k % 3 AS STRING) AS product_id, application_id, product_type,
       upper(product_type) AS product_name, DATE '1995-01-01' AS launch_date
FROM applications
"""

# --- servicing --------------------------------------------------------------

VIEWS["servicing"] = """
SELECT k, 'L' || CAST(k AS STRING) AS loan_id, application_id, internal_uuid, product_type,
       CASE WHEN k % 7 = 0 THEN 'CLOSED' WHEN k % 53 = 0 THEN 'DEFAULTED' ELSE 'ACTIVE' END AS status,
       order_date AS creation_date,
       CAST(price AS DECIMAL(18,2)) AS loan_amount,
       CAST(price * (10 - k % 10) / 10e0 AS DECIMAL(18,2)) AS outstanding_amount,
       CASE WHEN k % 301 = 0 THEN NULL
            ELSE CAST((k * 37 + CAST(extract(month FROM snapshot_date) AS INT) * 17) % 121 AS INT) END AS days_past_due,
       CAST(price / 10e0 AS DECIMAL(18,2)) AS repayment_amount_mtd,
       (k % 53 = 0) AS is_default, snapshot_date, order_date AS decision_date
FROM (SELECT *, {explode:DATE '2001-04-30',DATE '2001-05-31',DATE '2001-06-30'} AS snapshot_date
      FROM applications) a
WHERE order_date <= snapshot_date
"""

# A third of the low-priority book has no row in the credit-risk system.
VIEWS["risk_signals"] = """
SELECT 'L' || CAST(k AS STRING) AS loan_id, CAST(k % 8 AS INT) AS current_rating_notch,
       CAST(k % 6 AS INT) AS origination_rating_notch, (k % 31 = 0) AS watchlist_flag,
       (k % 37 = 0) AS forbearance_flag, (k % 41 = 0) AS unlikely_to_pay_flag
FROM applications WHERE NOT (priority = '5-LOW' AND order_status = 'O')
"""

# The three conventional scenarios and their weights per date.
VIEWS["macro_scenario"] = """
SELECT 'S-' || CAST(reporting_date AS STRING) || '-' || scenario_name AS scenario_id, reporting_date,
       scenario_name, CAST(scenario_weight AS DECIMAL(5,4)) AS scenario_weight
FROM (SELECT reporting_date, scenario_name,
             CASE scenario_name WHEN 'BASELINE' THEN 0.6 WHEN 'ADVERSE' THEN 0.3 ELSE 0.1 END AS scenario_weight
      FROM (SELECT reporting_date, {explode:'BASELINE','ADVERSE','SEVERE'} AS scenario_name
            FROM (SELECT {explode:DATE '2001-04-30',DATE '2001-05-31',DATE '2001-06-30'} AS reporting_date) d) n) w
"""

# kind 0: 12-month PD, 1-5: lifetime PD of that period, 6: LGD, 7: point EAD,
# 8-12: EAD of period 1-5 (fixed-schedule product only).
VIEWS["pit"] = """
SELECT 'PIT-' || CAST(k AS STRING) || '-' || CAST(kind AS STRING) || '-' || CAST(reporting_date AS STRING)
         || '-' || scenario_name AS parameter_id,
       'L' || CAST(k AS STRING) AS loan_id, reporting_date,
       'S-' || CAST(reporting_date AS STRING) || '-' || scenario_name AS scenario_id,
       CASE WHEN kind <= 5 THEN 'PD' WHEN kind = 6 THEN 'LGD' ELSE 'EAD' END AS parameter_type,
       CASE WHEN kind IN (0, 6, 7) THEN '12_MONTH' ELSE 'LIFETIME' END AS horizon_type,
       CAST(CASE WHEN kind BETWEEN 1 AND 5 THEN kind WHEN kind >= 8 THEN kind - 7 END AS INT) AS period_number,
       CAST(CASE WHEN kind = 0 THEN (100 + k * 7919 % 400 * (CAST(extract(month FROM reporting_date) AS INT) - 3)) * factor / 1000000e0
                 WHEN kind <= 5 THEN (100 + k * 104729 % 300) * factor * kind / 1000000e0
                 WHEN kind = 6 THEN (300 + k % 50 * 10) * factor / 10000e0
                 WHEN kind = 7 THEN price * (10 - k % 10) / 10e0
                 ELSE price * (10 - k % 10) * (13 - kind) / 50e0 END AS DECIMAL(12,6)) AS parameter_value,
       'M1' AS model_id, CASE WHEN reporting_date = DATE '2001-06-30' THEN 'v2' ELSE 'v1' END AS model_version,
       reporting_date AS batch_date
FROM (SELECT *, {explode:0,1,2,3,4,5,6,7,8,9,10,11,12} AS kind,
             CASE scenario_name WHEN 'BASELINE' THEN 10 WHEN 'ADVERSE' THEN 13 ELSE 17 END AS factor
      FROM (SELECT *, {explode:'BASELINE','ADVERSE','SEVERE'} AS scenario_name
            FROM (SELECT *, {explode:DATE '2001-04-30',DATE '2001-06-30'} AS reporting_date
                  FROM applications) d) s) p
WHERE order_date <= reporting_date AND (kind <= 7 OR product_type = 'personal_finance')
  AND (kind = 0 OR reporting_date = DATE '2001-06-30')
"""

VIEWS["ttc"] = """
SELECT 'TTC-' || CAST(k AS STRING) || '-' || CAST(kind AS STRING) AS parameter_id,
       'L' || CAST(k AS STRING) AS loan_id, DATE '2001-06-30' AS reporting_date,
       CASE WHEN kind <= 5 THEN 'PD' WHEN kind = 6 THEN 'LGD' ELSE 'EAD' END AS parameter_type,
       CASE WHEN kind IN (0, 6, 7) THEN '12_MONTH' ELSE 'LIFETIME' END AS horizon_type,
       CAST(CASE WHEN kind BETWEEN 1 AND 5 THEN kind END AS INT) AS period_number,
       CAST(CASE WHEN k % 101 = 0 THEN 0e0
                 WHEN kind = 0 THEN (800 + k % 9 * 500) / 100000e0
                 WHEN kind <= 5 THEN (1500 + k % 9 * 200) * kind / 1000000e0
                 WHEN kind = 6 THEN (350 + k % 9 * 50) / 1000e0
                 ELSE price * (10 - k % 9) / 10e0 END AS DECIMAL(12,6)) AS parameter_value
FROM (SELECT *, {explode:0,1,2,3,4,5,6,7} AS kind FROM applications) p
WHERE order_date <= DATE '2001-06-30'
"""

VIEWS["loan_terms"] = """
SELECT 'L' || CAST(k AS STRING) AS loan_id, CAST((2 + k % 10) / 100e0 AS DECIMAL(8,6)) AS effective_interest_rate
FROM applications
"""

VIEWS["stage_history"] = """
SELECT 'SH-' || loan_id || '-' || CAST(snapshot_date AS STRING) AS stage_history_id, loan_id,
       snapshot_date AS reporting_date,
       CAST(CASE WHEN days_past_due >= 90 THEN 3 WHEN days_past_due >= 30 THEN 2 ELSE 1 END AS INT) AS current_stage
FROM servicing WHERE status = 'ACTIVE'
"""

VIEWS["stage_overrides"] = """
SELECT 'L' || CAST(k AS STRING) AS loan_id, CAST(1 AS INT) AS override_stage,
       CASE WHEN k % 2 = 0 THEN 'committee' END AS override_approved_by,
       CASE WHEN k % 3 = 0 THEN 'documented' END AS override_justification
FROM applications WHERE price >= 480000
"""

VIEWS["stage_rebuttals"] = """
SELECT 'L' || CAST(k AS STRING) AS loan_id,
       CASE WHEN k % 4 = 0 THEN NULL ELSE 'administrative delay' END AS rebuttal_reason
FROM applications WHERE price < 20000
"""

VIEWS["overlays"] = """
SELECT 'L' || CAST(k AS STRING) AS loan_id, CAST(k % 3 * 100 AS DECIMAL(18,2)) AS management_overlay_amount,
       CASE WHEN k % 4 = 0 THEN 'model gap' END AS overlay_justification,
       CASE WHEN k % 4 = 0 THEN 'cro' END AS overlay_approved_by
FROM applications WHERE price >= 450000
"""

# --- data quality -----------------------------------------------------------

VIEWS["scorecard_rows"] = """
SELECT CASE event_type WHEN 'click' THEN 'aecb' WHEN 'view' THEN 'fraud' WHEN 'purchase' THEN 'aml'
            ELSE 'internal' END AS source_system,
       CAST(ts AS DATE) AS batch_date, 'rule_' || CAST(event_id % 12 AS STRING) AS rule_name,
       CASE WHEN event_id % 2 = 0 THEN 'MUST_PASS' ELSE 'WARNING' END AS rule_tier,
       CAST(event_id % 101 AS INT) AS score
FROM events
"""

VIEWS["fraud_scores"] = """
SELECT CAST(floor(value) AS INT) AS fraud_score, ts < TIMESTAMP '2024-01-16 00:00:00' AS is_baseline FROM events
"""

_EXPLODE = re.compile(r"\{explode:([^}]*)\}")


def _words(sql: str) -> set[str]:
    return set(re.findall(r"\b[a-z_]+\b", sql))


def _needed(names: tuple[str, ...]) -> list[str]:
    """The named views and those they read, each after its inputs."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in VIEWS:
            if other != name and other in _words(VIEWS[name]):
                visit(other)
        ordered.append(name)

    for name in names:
        visit(name)
    return ordered


def _read_by(sql: str) -> tuple[str, ...]:
    return tuple(name for name in VIEWS if name in _words(sql))


def duckdb_sql(body: str) -> str:
    """``body`` with the views it names in front, in DuckDB's dialect."""
    names = _needed(_read_by(body))
    ctes = ",\n".join(f"{n} AS ({_EXPLODE.sub(r'unnest([\1])', VIEWS[n])})" for n in names)
    body = body.strip()
    if not ctes:
        return body
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.schema(BASE_SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Views that make many rows, or feed much work per row.
HEAVY = {"pit", "ttc", "bureau_answers", "fraud_answers", "aml_answers", "servicing"}


def _spread(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Give an input that sits in too few files at least one partition per core.

    A split of a file is no measure: the rows of a row group all come in the split that
    holds its middle. Input that comes in as many files as there are cores is left as it is.
    """
    cores = spark.sparkContext.defaultParallelism
    if len(df.inputFiles()) >= cores:
        return df
    return df.repartition(max(cores, df.rdd.getNumPartitions()))


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A lending-shaped view as a DataFrame."""
    names = _needed((name,))
    text = " ".join(VIEWS[n] for n in names)
    bases = {t: table(spark, sf_dir, t) for t in BASE_TABLES if t in _words(text)}
    if HEAVY & set(names):
        bases = {t: _spread(spark, df) for t, df in bases.items()}
    ctes = [f"{t} AS (SELECT * FROM {{{t}_input}})" for t in bases]
    for n in names:
        sql = _EXPLODE.sub(r"explode(array(\1))", VIEWS[n])
        ctes.append(f"{n} AS ({sql.replace('{', '{{').replace('}', '}}')})")  # braces of JSON texts
    inputs = {f"{t}_input": df for t, df in bases.items()}
    return spark.sql("WITH " + ",\n".join(ctes) + f"\nSELECT * FROM {name}", **inputs)
