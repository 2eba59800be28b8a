"""Every operator as a query over the given tables.

The queries read the lending-shaped views of the test tables, run one operator
(or a composition of them) on all rows, and shape the result for comparison.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property
from itertools import pairwise

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions import credit
from loanloom.functions.quality import classify_severity
from loanloom.functions.text import normalize_email, normalize_phone
from loanloom.operators import (
    alerts,
    assemble,
    conform as conforming,
    gold,
    identity,
    keys,
    mart,
    provisions,
    reconciliation,
    rules,
    scorecard,
    staging,
    warnings,
)
from loanloom.schemas import schema_of
from loanloom.session import scratch_path, tune
from loanloom.sizing import small_side
from loanloom.sources import dimensions, landing, layers, profile
from loanloom.sources.runs import RunTable
from loanloom.sources.sample_views import AS_OF, table, view
from loanloom.streaming import landing_streams, serving

QueryFn = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, QueryFn] = {}

DQ_AS_OF = "2024-01-30"
# Run stamps differ between two runs of the same query.
RUN_STAMPS = {"assembled_at", "evaluated_at", "conformed_at", "classified_at", "calculated_at", "queued_at"}


class Inputs:
    """The views of one scale factor, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return view(self.spark, self.sf_dir, name)

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    # Conformed tables, derived from what the vendors answered.

    @property
    def conformed_bureau(self) -> DataFrame:
        return self.bureau_answers.withColumn(
            "identity_validation_status",
            identity.aecb_identity_status(F.col("emirates_id"), F.col("profile_emirates_id")),
        )

    @property
    def conformed_fraud(self) -> DataFrame:
        return self.fraud_answers.withColumn(
            "identity_validation_status",
            identity.fraud_identity_status(*map(F.col, ("phone", "email", "profile_phone", "profile_email"))),
        )

    @property
    def conformed_aml(self) -> DataFrame:
        scored = self.aml_answers.withColumn(
            "raw_score", identity.aml_raw_score(*map(F.col, ("profile_name", "profile_dob", "returned_name", "returned_dob")))
        )
        return scored.withColumns(
            {
                "match_score": identity.aml_match_score(F.col("raw_score")),
                "match_decision": identity.aml_match_decision(F.col("raw_score")),
            }
        )

    def stored(self, name: str) -> DataFrame:
        """A derived table written to the shared folder, as its readers find it."""
        path = scratch_path(self.spark, name)
        getattr(self, name).write.parquet(path)
        return self.spark.read.parquet(path)

    @cached_property
    def request(self) -> DataFrame:
        """Assembled from stored vendor tables: assembling reads each of them twice."""
        vendors = [self.stored(n) for n in ("conformed_bureau", "conformed_fraud", "conformed_aml")]
        return assemble.assemble_application_request(*vendors, AS_OF)

    @cached_property
    def request_table(self) -> DataFrame:
        """The assembled requests as the stored table that the gate reads."""
        return self.stored("request")

    @property
    def owners(self) -> DataFrame:
        return identity.owner_index(self.profile)

    @property
    def daily_metrics(self) -> DataFrame:
        """Two vendors' metrics of every day on which they answered."""
        reports = self.bureau_answers.withColumn("batch_date", F.col("aecb_report_date").cast("date"))
        screened = self.aml_answers.withColumn("batch_date", F.col("aml_screened_at").cast("date"))
        return alerts.batch_metrics(reports, "aecb", ("application_id", "emirates_id"), by=("batch_date",)).unionByName(
            alerts.batch_metrics(screened, "aml", ("returned_name", "returned_dob"), by=("batch_date",))
        )

    @property
    def evaluated(self) -> DataFrame:
        return rules.evaluate_must_pass(self.request_table, AS_OF)

    @property
    def decision_facts(self) -> DataFrame:
        return gold.build_lending_applications(self.gold_request, self.decisions, self.dim_product)

    @property
    def perf(self) -> DataFrame:
        return mart.fact_loan_performance(self.servicing)

    @property
    def audit(self) -> DataFrame:
        return identity.union_match_audit(
            identity.audit_aecb(self.bureau_answers, AS_OF),
            identity.audit_fraud(self.fraud_answers, AS_OF),
            identity.audit_aml(self.aml_answers.withColumnRenamed("profile_name", "profile_full_name"), AS_OF),
        )

    @property
    def ecl_inputs(self) -> tuple[DataFrame, ...]:
        return self.stage_history, self.pit, self.macro_scenario, self.loan_terms

    @property
    def classification(self) -> DataFrame:
        return staging.stage_classification(self.perf, self.risk_signals, self.pit, self.macro_scenario, AS_OF)

    @property
    def history_rows(self) -> DataFrame:
        return staging.write_stage_history(
            self.classification, self.stage_history, self.stage_overrides, self.stage_rebuttals, AS_OF
        )

    @property
    def calculation(self) -> DataFrame:
        figures = provisions.per_scenario(*self.ecl_inputs, AS_OF, with_ids=True)
        return provisions.write_ecl_calculation(figures, self.overlays, AS_OF)


def presentable(df: DataFrame) -> DataFrame:
    """Columns in types every engine prints alike; run stamps are left out."""

    def shown(field: T.StructField) -> Column:
        column = F.col(field.name)
        kind = field.dataType
        if isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        return column.alias(field.name)

    return df.select([shown(f) for f in df.schema.fields if f.name not in RUN_STAMPS])


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a query under its function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(fn(Inputs(tune(spark), sf_dir)))

    REGISTRY[fn.__name__] = run
    return fn


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: credit.exact_round(F.col(c), digits).cast("double") for c in columns})


# --- sources and sinks --------------------------------------------------------


@query
def read_layer(v):
    return layers.on_day(v.bureau_answers, AS_OF).select("application_id", "bronze_id", "aecb_score", "batch_date")


def _bureau_files(v) -> DataFrame:
    return v.bureau_raw.select(
        F.col("raw_payload").alias("value"), F.concat(F.lit("f-"), "bronze_id").alias("file_path"), "received_at"
    )


@query
def ingest_bureau_xml(v):
    return landing.ingest_bureau_xml(_bureau_files(v), F.col("received_at"))


@query
def explode_bureau_batch(v):
    files = _bureau_files(v).withColumn("value", F.concat(F.lit("<Reports>"), "value", "value", F.lit("</Reports>")))
    return landing.explode_bureau_batch(files).select("file_path", "report_position", "value")


@query
def ingest_fraud_messages(v):
    messages = v.fraud_messages.withColumnRenamed("message", "value")
    return landing.ingest_fraud_messages(messages, F.col("fraud_scored_at"))


def _aml_callbacks(v) -> DataFrame:
    return landing.ingest_aml_callbacks(v.aml_callbacks.withColumnRenamed("message", "value"), F.col("received_at"))


@query
def ingest_aml_callbacks(v):
    return _aml_callbacks(v)


@query
def ingest_profile_cdc(v):
    return landing.ingest_profile_cdc(v.cdc_log)


@query
def bronze_envelope(v):
    return landing.bronze_envelope(landing.ingest_profile_cdc(v.cdc_log), "internal")


def _correlated_bureau(v) -> DataFrame:
    return landing.correlate_requests(landing.ingest_bureau_xml(_bureau_files(v), F.col("received_at")), v.request_log)


@query
def correlate_requests(v):
    return _correlated_bureau(v).select("source_event_id", "emirates_id", "application_id", "internal_uuid")


def _correlated_aml(v) -> DataFrame:
    return landing.correlate_context(_aml_callbacks(v), v.application_context)


@query
def correlate_context(v):
    return _correlated_aml(v).select("source_event_id", "application_id", "internal_uuid")


@query
def split_unmatched(v):
    _, unmatched = landing.split_unmatched(_correlated_bureau(v), "UNMATCHED", "emirates_id")
    _, no_context = landing.split_unmatched(_correlated_aml(v), "CONTEXT_NOT_FOUND", "application_id")
    columns = ["source_event_id", "exception_reason"]
    return unmatched.select(*columns).unionByName(no_context.select(*columns))


@query
def append_idempotent(v):
    matched, _ = landing.split_unmatched(_correlated_aml(v), "CONTEXT_NOT_FOUND", "application_id")
    envelope = landing.bronze_envelope(matched, "aml")
    existing = envelope.filter(F.col("ingest_date") < F.lit("1998-01-01").cast("date"))
    fresh = landing.append_idempotent(envelope, existing, "aml")
    return fresh.select("source_event_id", "application_id", "internal_uuid", "received_at", "content_hash")


@query
def append_idempotent_bureau(v):
    matched, _ = landing.split_unmatched(_correlated_bureau(v), "UNMATCHED", "emirates_id")
    envelope = landing.bronze_envelope(matched, "aecb")
    existing = envelope.filter(F.hour("received_at") < 2)
    fresh = landing.append_idempotent(envelope, existing, "aecb")
    return fresh.select("application_id", "internal_uuid", "ingest_date", F.substring("content_hash", 8, 12).alias("content_key"))


@query
def append_idempotent_fraud(v):
    messages = v.fraud_messages.withColumnRenamed("message", "value")
    envelope = landing.bronze_envelope(
        landing.ingest_fraud_messages(messages, F.col("fraud_scored_at")), "fraud"
    )
    existing = envelope.filter(F.col("ingest_date") < F.lit("1998-01-01").cast("date"))
    fresh = landing.append_idempotent(envelope, existing, "fraud")
    return fresh.select("ingest_date", "application_id", "source_event_id", "content_hash")


@query
def write_partitioned(v):
    root = scratch_path(v.spark, "write-partitioned")
    layers.write_partitioned(v.perf, root, "mart.fact_loan_performance")
    return layers.read_table(v.spark, root, "mart.fact_loan_performance").select("loan_id", "product_type", "delinquency_bucket", "outstanding_amount", "snapshot_date")


@query
def export_feature_snapshot(v):
    assembled = v.bureau_answers.filter(F.col("application_id").isNotNull()).select(
        "application_id", "internal_uuid", "aecb_score", "batch_date", F.col("aecb_received_at").alias("assembled_at")
    )
    return layers.export_feature_snapshot(assembled)


@query
def dim_source(v):
    counts = v.scorecard_rows.groupBy("source_system").agg(F.count(F.lit(1)).alias("scorecard_rows"))
    return dimensions.dim_source(v.spark).join(counts, "source_system", "left")


@query
def dim_customer(v):
    nation = v.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("emirate"))
    raw = v.table("customer").join(small_side(nation), "c_nationkey").select(
        F.concat(F.lit("U"), F.lpad(F.col("c_custkey").cast("string"), 12, "0")).alias("internal_uuid"),
        F.col("c_mktsegment").alias("customer_segment"),
        "emirate",
        (F.col("c_acctbal") >= 0).alias("is_active"),
    )
    return dimensions.dim_customer(raw).drop("onboarded_date")


@query
def dim_product(v):
    return dimensions.dim_product(v.dim_product)


@query
def loan_terms(v):
    return dimensions.loan_terms(v.loan_terms)


@query
def dim_date(v):
    bounds = v.applications.agg(F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day"))
    return dimensions.dim_date(bounds)


# --- projections ----------------------------------------------------------------


@query
def conform_bureau(v):
    return conforming.conform_bureau(v.bureau_raw, v.profile, AS_OF)


@query
def conform_fraud(v):
    return conforming.conform_fraud(v.fraud_raw, v.profile, AS_OF)


@query
def conform_aml(v):
    return conforming.conform_aml(v.aml_raw, v.profile, AS_OF)


@query
def incremental_slice(v):
    earlier = v.bureau_answers.filter(F.col("batch_date") < F.lit(AS_OF).cast("date"))
    return layers.incremental_slice(v.bureau_raw, AS_OF, earlier).select("bronze_id", "application_id", "ingest_date")


@query
def normalize_phone_query(v):
    return v.fraud_answers.select("application_id", "phone", normalize_phone(F.col("phone")).alias("phone_normalized"))


@query
def normalize_email_query(v):
    return v.fraud_answers.select("application_id", "email", normalize_email(F.col("email")).alias("email_normalized"))


REGISTRY["normalize_phone"] = REGISTRY.pop("normalize_phone_query")
REGISTRY["normalize_email"] = REGISTRY.pop("normalize_email_query")


@query
def aecb_identity_status(v):
    return v.conformed_bureau.select("bronze_id", "emirates_id", "identity_validation_status")


@query
def fraud_identity_status(v):
    return v.conformed_fraud.select("bronze_id", "phone", "email", "identity_validation_status")


@query
def cross_uuid_collision(v):
    return identity.cross_uuid_collision(v.fraud_answers, v.profile)


@query
def owner_index(v):
    return identity.owner_index(v.profile)


@query
def collision_owners(v):
    index = v.stored("owners")
    return identity.collision_owners(identity.cross_uuid_collision(v.fraud_answers, v.profile, index), index)


@query
def jaro_winkler(v):
    similarity = identity.name_similarity(F.col("profile_name"), F.col("returned_name"))
    return v.aml_answers.select(
        "application_id", "profile_name", "returned_name", F.round(similarity, 6).alias("similarity")
    )


@query
def aml_match_score(v):
    return v.conformed_aml.select("application_id", "match_score")


@query
def aml_match_decision(v):
    decision = identity.aml_decision_only(
        *map(F.col, ("profile_name", "profile_dob", "returned_name", "returned_dob"))
    )
    return v.aml_answers.select("application_id", decision.alias("match_decision"))


@query
def pending_sources(v):
    return v.request.select("application_id", "internal_uuid", "pending_sources")


@query
def delinquency_bucket(v):
    return v.servicing.select(
        "loan_id", "snapshot_date", "days_past_due",
        credit.delinquency_bucket(F.col("days_past_due")).alias("delinquency_bucket"),
    )


@query
def months_on_book(v):
    return v.servicing.select(
        "loan_id", "snapshot_date",
        credit.months_on_book(F.col("creation_date"), F.col("snapshot_date")).alias("months_on_book"),
    )


@query
def is_default(v):
    return v.perf.select("loan_id", "snapshot_date", "status", "is_default")


@query
def decision_date(v):
    return v.decisions.select("application_id", gold.decision_date(F.col("decided_at")).alias("decision_date"))


@query
def discount_factor(v):
    terms = v.loan_terms.withColumn("period_number", F.explode(F.sequence(F.lit(1), F.lit(5))))
    factor = credit.discount_factor(F.col("effective_interest_rate"), F.col("period_number"))
    return terms.select("loan_id", "period_number", F.round(factor, 8).alias("discount_factor"))


@query
def divergence(v):
    return _rounded(
        reconciliation.pit_vs_ttc(v.pit, v.ttc, v.macro_scenario, AS_OF).select(
            "loan_id", "parameter_type", "horizon_type", "pit_value", "ttc_value", "absolute_divergence",
            "divergence_flag",
        ),
        6, "absolute_divergence",
    )


# --- blocking rules ---------------------------------------------------------------


def _rule_query(rule: str) -> None:
    def run(v):
        flag = f"passes_{rule}"
        return v.evaluated.select("application_id", "internal_uuid", "aecb_score", flag)

    run.__name__ = f"rule_{rule}"
    query(run)


for _rule in rules.BLOCKING:
    _rule_query(_rule)

_EVALUATED = (
    "application_id", "internal_uuid", "aecb_score", rules.DUPLICATE_COUNT,
    *[f"passes_{r}" for r in rules.BLOCKING], "dq_status",
)


@query
def evaluate_must_pass(v):
    return v.evaluated.select(*_EVALUATED)


@query
def blocked_records(v):
    return rules.blocked_records(v.request_table, AS_OF).select(*_EVALUATED)


@query
def passed_records(v):
    return rules.passed_records(v.request_table, AS_OF).select(*_EVALUATED)


@query
def gold_sql_gate(v):
    return rules.gold_sql_gate(v.request_table, AS_OF).select("application_id", "internal_uuid", "aecb_score")


@query
def match_exceptions(v):
    return identity.match_exceptions(v.audit)


@query
def loan_snapshot(v):
    return staging.loan_snapshot(v.perf, AS_OF)


@query
def risk_signals(v):
    return staging.risk_signals(v.risk_signals)


@query
def loans_in_stage(v):
    return provisions.loans_in_stage(v.stage_history, AS_OF, (2, 3))


@query
def manual_review_queue(v):
    return identity.manual_review_queue(v.audit).select("application_id", "source_system", "match_score")


@query
def last_n_days(v):
    recent = mart.last_n_days(v.decisions, "batch_date", AS_OF, 30).select("application_id", F.lit("30 days").alias("window"))
    half_year = mart.last_n_months(v.decisions, "batch_date", AS_OF, 6).select("application_id", F.lit("6 months").alias("window"))
    return recent.unionByName(half_year)


# --- joins ---------------------------------------------------------------------------


@query
def join_profile(v):
    return identity.join_profile(v.cdc_log, v.profile).select("bronze_id", "internal_uuid", "profile_emirates_id", "profile_phone")


@query
def assemble_application_request(v):
    return v.request


@query
def build_lending_applications(v):
    return v.decision_facts


@query
def decision_snapshot(v):
    request = v.gold_request.select("application_id", "internal_uuid", "aecb_score", "aml_status")
    response = v.decisions.select("application_id", "decision_outcome", "policy_version")
    return gold.decision_snapshot(request, response)


@query
def vintage_join(v):
    loans = mart.decided_loans(mart.at_last_month_end(v.perf, "2001-07-15"), v.decision_facts)
    return loans.select("loan_id", "application_id", "months_on_book", "delinquency_bucket")


def _by_period(v, stages) -> DataFrame:
    history, pit, scenarios, terms = v.ecl_inputs
    loans = provisions.loans_in_stage(history, AS_OF, stages)
    return provisions.parameters_by_period(provisions.staged_parameters(loans, pit, scenarios, AS_OF), terms)


@query
def stage1_param_joins(v):
    return provisions.scenario_ecl(_by_period(v, (1,))).select(
        "loan_id", "scenario_name", "scenario_weight", "pd_used", "lgd_used", "ead_used"
    )


@query
def stage2_param_joins(v):
    rows = provisions.period_shortfalls(_by_period(v, (2,)))
    return _rounded(
        rows.select("loan_id", "scenario_name", "period_number", "marginal_pd", "lgd_used", "ead_this_period",
                    "undiscounted_shortfall", "discount_factor"),
        4, "undiscounted_shortfall", "discount_factor",
    )


@query
def stage3_param_joins(v):
    rows = provisions.scenario_ecl(_by_period(v, (3,)))
    return _rounded(rows.select("loan_id", "scenario_name", "lgd_used", "ead_used", "scenario_ecl"), 2, "scenario_ecl")


@query
def signals_left_join(v):
    comparison = staging.pd_comparison(v.pit, v.macro_scenario, AS_OF)
    joined = staging.signals_left_join(staging.loan_snapshot(v.perf, AS_OF), v.risk_signals, comparison)
    return joined.select("loan_id", "current_rating_notch", "watchlist_flag", "pd_at_reporting_date", "pd_at_origination")


@query
def pd_comparison(v):
    return _rounded(staging.pd_comparison(v.pit, v.macro_scenario, AS_OF), 6, "pd_deterioration_ratio")


@query
def rollup_joins(v):
    calculation = v.calculation.drop("current_stage").filter(F.col("is_probability_weighted_result"))
    stages = v.stage_history.select("stage_history_id", "current_stage")
    products = v.perf.select("loan_id", F.col("snapshot_date").alias("reporting_date"), "product_type")
    return (
        calculation.join(stages, "stage_history_id").join(products, ["loan_id", "reporting_date"])
        .select("loan_id", "product_type", "current_stage", "ecl_present_value")
    )


@query
def pit_ttc_join(v):
    return reconciliation.pit_ttc_join(v.pit, v.ttc, v.macro_scenario, AS_OF)


@query
def scenario_scalar(v):
    baseline = small_side(staging.baseline_scenarios(v.macro_scenario, AS_OF).select("scenario_id"))
    return v.pit.join(baseline, "scenario_id", "left_semi").groupBy("scenario_id", "parameter_type").agg(
        F.count(F.lit(1)).alias("parameter_count")
    )


# --- aggregations -------------------------------------------------------------------


@query
def approval_rate_by_product_month(v):
    return mart.approval_rate_by_product_month(v.decision_facts, AS_OF)


@query
def portfolio_health(v):
    return _rounded(mart.portfolio_health(v.perf, "2001-07-15"), 2, "avg_outstanding")


@query
def delinquency_distribution(v):
    return mart.delinquency_distribution(v.perf, "2001-07-15")


@query
def vintage_analysis(v):
    return mart.vintage_analysis(v.perf, v.decision_facts, "2001-07-15")


@query
def volume_vs_capacity(v):
    return mart.volume_vs_capacity(v.decision_facts, AS_OF)


@query
def dq_trend(v):
    return _rounded(mart.dq_trend(v.scorecard_rows, DQ_AS_OF), 4, "avg_dq_score")


@query
def dq_scorecard_summary(v):
    return _rounded(scorecard.dq_scorecard_summary(v.scorecard_rows), 4, "composite_score")


@query
def scenario_pivot(v):
    figures = provisions.per_scenario(*v.ecl_inputs, AS_OF)
    pivot = figures.groupBy("loan_id").agg(*provisions.scenario_pivot())
    return _rounded(pivot, 2, "baseline_ecl", "adverse_ecl", "severe_ecl")


@query
def probability_weighted_ecl(v):
    figures = provisions.per_scenario(*v.ecl_inputs, AS_OF)
    rows = provisions.probability_weighted_ecl(figures).select("loan_id", "stage", "probability_weighted_ecl")
    return _rounded(rows, 2, "probability_weighted_ecl")


@query
def stage2_lifetime_ecl(v):
    rows = provisions.stage2_lifetime_ecl(*v.ecl_inputs, AS_OF)
    return _rounded(rows.select("loan_id", "scenario_name", "scenario_ecl"), 2, "scenario_ecl")


@query
def ecl_portfolio_rollup(v):
    rows = provisions.ecl_portfolio_rollup(v.calculation, v.stage_history, v.perf, AS_OF)
    return _rounded(rows, 2, "avg_ecl_per_loan")


@query
def blocked_count(v):
    return rules.blocked_count(v.evaluated)


@query
def scenario_weight_check(v):
    checked = provisions.scenario_weight_check(v.macro_scenario)
    loans = v.perf.groupBy(F.col("snapshot_date").alias("reporting_date")).agg(F.count(F.lit(1)).alias("loan_count"))
    return _rounded(checked.join(loans, "reporting_date"), 4, "total_weight")


@query
def profile_current(v):
    return landing.profile_current(v.cdc_log)


@query
def profile_refresh(v):
    """The change log lands in three portions, and the table follows each; a second refresh adds nothing."""
    root = scratch_path(v.spark, "profile")
    days = ["0001-01-01", "2024-01-11", "2024-01-21", "9999-12-31"]
    for since, until in pairwise(days):
        portion = v.cdc_log.filter(f"ingest_date >= DATE '{since}' AND ingest_date < DATE '{until}'")
        layers.write_partitioned(portion, root, "bronze.internal_profile")
        for _ in range(2):
            profile.refresh_profile(v.spark, root)
    held = RunTable(v.spark, layers.table_path(root, profile.TABLE)).read()
    return held.select("internal_uuid", *profile.ORDER)


@query
def current_stage(v):
    return staging.current_stage(v.stage_history)


@query
def latest_per_key(v):
    return keys.latest_per_key(
        v.stage_history.select("loan_id", "reporting_date", "current_stage"), ["loan_id"], ["reporting_date"]
    )


@query
def origination_pd(v):
    return staging.origination_pd(v.pit, v.macro_scenario)


# --- warning metrics ---------------------------------------------------------------


@query
def classify_severity_query(v):
    score = F.col("fraud_score")
    return v.fraud_answers.select(
        "application_id", "fraud_score",
        classify_severity(score, 60, 90, True).alias("high_is_bad"),
        classify_severity(score, 40, 10, False).alias("low_is_bad"),
    )


REGISTRY["classify_severity"] = REGISTRY.pop("classify_severity_query")

_REQUIRED = ("aecb_score", "fraud_score", "aml_status", "dob")


@query
def warn_source_completeness(v):
    return warnings.warn_source_completeness(v.request_table, _REQUIRED)


@query
def warn_duplicate_rate(v):
    return warnings.warn_duplicate_rate(v.request_table)


@query
def warn_fraud_score_drift_psi(v):
    return warnings.warn_fraud_score_drift_psi(v.fraud_scores)


@query
def warn_score_drift_wide(v):
    """Scores of many values: their quantiles come from ranges."""
    fine = F.floor(F.col("value") * 10000).cast("bigint").alias("fraud_score")
    events = v.table("events").select(fine, (F.col("ts") < F.lit("2024-01-16").cast("timestamp")).alias("is_baseline"))
    return warnings.warn_fraud_score_drift_psi(events)


def _lagged(v) -> DataFrame:
    return v.bureau_answers.withColumn("submitted_at", F.col("batch_date").cast("timestamp"))


@query
def bureau_arrival_lag(v):
    return warnings.bureau_arrival_lag(_lagged(v), "submitted_at", "aecb_received_at").select(
        "bronze_id", "lag_hours", "lag_severity"
    )


@query
def warn_bureau_arrival_lag(v):
    return warnings.warn_bureau_arrival_lag(_lagged(v), "submitted_at", "aecb_received_at")


def _review_queue(v) -> DataFrame:
    return v.conformed_aml.filter(F.col("match_decision") == "MANUAL_REVIEW").withColumn(
        "waiting_since", F.col("aml_screened_at")
    )


@query
def warn_manual_review_queue_age(v):
    return warnings.warn_manual_review_queue_age(_review_queue(v), AS_OF + " 06:00:00", "waiting_since")


def _warning_metrics(v) -> DataFrame:
    return (
        warnings.warn_source_completeness(v.request_table, _REQUIRED)
        .unionByName(warnings.warn_duplicate_rate(v.request_table))
        .unionByName(warnings.warn_fraud_score_drift_psi(v.fraud_scores))
        .unionByName(warnings.warn_bureau_arrival_lag(_lagged(v), "submitted_at", "aecb_received_at"))
        .unionByName(warnings.warn_manual_review_queue_age(_review_queue(v), AS_OF + " 06:00:00", "waiting_since"))
    )


@query
def build_dq_scorecard(v):
    must_pass = scorecard.must_pass_rows(v.evaluated, F.lit("internal"))
    return scorecard.build_dq_scorecard(must_pass, scorecard.warning_rows(_warning_metrics(v), "internal", AS_OF))


@query
def raise_alerts(v):
    return warnings.raise_alerts(_warning_metrics(v))


@query
def batch_metrics(v):
    return v.daily_metrics


@query
def alert_episodes(v):
    return alerts.alert_episodes(v.daily_metrics)


@query
def advance_alerts(v):
    metrics = v.stored("daily_metrics")
    yesterday, today = (metrics.filter(F.col("batch_date") == F.lit(d).cast("date")) for d in ("2001-06-11", "2001-06-12"))
    before = alerts.advance_alerts(_unwritten(v, "gold.dq_alert"), yesterday, "2001-06-11")
    return alerts.advance_alerts(before, today, "2001-06-12")


def _unwritten(v, name: str) -> DataFrame:
    """A declared table before anything was written to it."""
    return v.spark.createDataFrame([], schema_of(name))


# --- windows, order, sets ------------------------------------------------------------


@query
def dup_count(v):
    return keys.with_duplicate_count(v.bureau_answers, "application_id", "duplicate_count").select(
        "bronze_id", "application_id", "duplicate_count"
    )


@query
def pct_of_month(v):
    rows = mart.approval_rate_by_product_month(v.decision_facts, AS_OF)
    return rows.select("product_type", "decision_month", "decision_outcome", "pct_of_month")


@query
def pct_of_product(v):
    rows = mart.delinquency_distribution(v.perf, "2001-07-15")
    return rows.select("product_type", "delinquency_bucket", "pct_of_product")


@query
def stage_transition(v):
    return staging.stage_transition(v.stage_history).drop("stage_history_id")


@query
def order_presentations(v):
    rows = mart.delinquency_distribution(v.perf, "2001-07-15")
    ranked = rows.withColumn("bucket_rank", credit.bucket_rank(F.col("delinquency_bucket")))
    return mart.by_bucket(ranked, "product_type")


@query
def combine_stage_2_3(v):
    parts = [
        provisions.per_scenario(*v.ecl_inputs, AS_OF, (stage,)).select(
            "loan_id", "current_stage", "scenario_name", "scenario_ecl"
        )
        for stage in (2, 3)
    ]
    return _rounded(provisions.combine_stage_2_3(*parts), 2, "scenario_ecl")


@query
def union_match_audit(v):
    return v.audit


# --- composite pipelines ---------------------------------------------------------------


@query
def audit_aecb(v):
    return identity.audit_aecb(v.bureau_answers, AS_OF)


@query
def audit_fraud(v):
    return identity.audit_fraud(v.fraud_answers, AS_OF)


@query
def audit_aml(v):
    return identity.audit_aml(v.aml_answers.withColumnRenamed("profile_name", "profile_full_name"), AS_OF)


@query
def build_decision_input(v):
    return gold.build_decision_input(v.request_table, AS_OF)


@query
def build_gold_request(v):
    return gold.build_gold_request(v.request_table, AS_OF)


@query
def write_decision_response(v):
    existing = v.decisions.filter(F.col("batch_date") < F.lit("1998-01-01").cast("date"))
    again = v.decisions.unionByName(v.decisions.withColumn("decided_at", F.col("decided_at") + F.expr("INTERVAL 1 DAY")))
    return gold.write_decision_response(again, existing)


@query
def fact_loan_performance(v):
    return v.perf.drop("closure_date")


@query
def stage_classification(v):
    return _rounded(v.classification, 6, "pd_deterioration_ratio")


@query
def write_stage_history(v):
    return v.history_rows.select(
        "loan_id", "reporting_date", "current_stage", "previous_stage", "stage_transition_type",
        "dpd_backstop_triggered", "sicr_backstop_rebutted", "rebuttal_reason", "primary_trigger",
        "classification_method", "override_approved_by", "override_justification",
    )


_ECL_FIGURES = ("probability_weighted_ecl", "baseline_ecl", "adverse_ecl", "severe_ecl")


@query
def stage1_ecl(v):
    return _rounded(provisions.stage1_ecl(*v.ecl_inputs, AS_OF), 2, *_ECL_FIGURES)


@query
def stage23_ecl(v):
    return _rounded(provisions.stage23_ecl(*v.ecl_inputs, AS_OF), 2, *_ECL_FIGURES)


@query
def write_ecl_calculation(v):
    return v.calculation.select(
        "loan_id", "scenario_id", "is_probability_weighted_result", "current_stage", "ecl_horizon",
        "gross_ecl_undiscounted", "ecl_present_value", "pd_parameter_id", "lgd_parameter_id", "ead_parameter_id",
        "management_overlay_amount", "overlay_justification",
    )


@query
def write_lifetime_detail(v):
    rows = provisions.write_lifetime_detail(provisions.period_shortfalls(_by_period(v, (2,))), AS_OF)
    return rows.drop("batch_date")


@query
def overlay_check(v):
    return provisions.overlay_check(v.calculation).select("loan_id", "management_overlay_amount")


@query
def override_check(v):
    return staging.override_check(v.history_rows).select("loan_id", "violations")


@query
def pit_vs_ttc(v):
    return _rounded(
        reconciliation.pit_vs_ttc(v.pit, v.ttc, v.macro_scenario, AS_OF), 4, "absolute_divergence"
    )


@query
def undefined_divergence(v):
    return reconciliation.undefined_divergence(v.pit, v.ttc, v.macro_scenario, AS_OF)


@query
def coverage_check(v):
    figures = provisions.per_scenario(*v.ecl_inputs, AS_OF)
    # The severe scenario of the bnpl book was never computed.
    bnpl = v.perf.filter(F.col("product_type") == "bnpl").select("loan_id", F.lit(True).alias("is_bnpl")).distinct()
    kept = (F.col("scenario_name") != "SEVERE") | (F.col("scenario_name").isNotNull() & F.col("is_bnpl").isNull())
    partial = figures.join(bnpl, "loan_id", "left").filter(kept).drop("is_bnpl")
    rows = provisions.coverage_check(v.stage_history, partial, AS_OF)
    return _rounded(rows, 4, "covered_weight").select("loan_id", "current_stage", "covered_weight")


def _thinned_pit(v) -> DataFrame:
    """The parameters without the PDs of two periods, the last PD, and the EADs, of some loans."""
    k = F.substring("loan_id", 2, 12).cast("bigint")
    pd = (F.col("parameter_type") == "PD") & F.col("period_number").isNotNull()
    gone = (pd & (k % 7 == 0) & F.col("period_number").isin(2, 3)) | (pd & (k % 11 == 0) & (F.col("period_number") == 5))
    no_ead = (F.col("parameter_type") == "EAD") & (k % 13 == 0) & F.coalesce(F.col("period_number") != 4, F.lit(True))
    return v.pit.filter(~gone & ~no_ead)


@query
def period_gaps(v):
    history, _, scenarios, _ = v.ecl_inputs
    loans = provisions.loans_in_stage(history, AS_OF, (1, 2, 3))
    return provisions.period_gaps(provisions.staged_parameters(loans, _thinned_pit(v), scenarios, AS_OF))


@query
def in_force(v):
    """Decisions as overrides, the automatic ones for three thousand days, on the run date."""
    held = v.decisions.select(
        F.col("internal_uuid").alias("loan_id"), F.col("application_id").alias("override_approved_by"),
        F.col("batch_date").alias("valid_from"),
        F.when(F.col("decided_by") == "AUTO", F.date_add("batch_date", 3000)).alias("valid_to"),
    )
    return keys.in_force(held, "loan_id", AS_OF)


@query
def reproduce_as_of(v):
    return provisions.reproduce_as_of(v.pit, "v1", "2001-04-30").select(
        "parameter_id", "loan_id", "model_version", "parameter_value"
    )


@query
def reproduce_ecl(v):
    """A month later the exposures of some loans were restated: the figures of then, and those of now."""
    history, pit, scenarios, terms = v.ecl_inputs
    k = F.substring("loan_id", 2, 12).cast("bigint")
    restated = pit.filter((F.col("reporting_date") == F.lit(AS_OF).cast("date")) & (F.col("parameter_type") == "EAD") & (k % 17 == 0))
    restated = restated.withColumns(
        {
            "parameter_id": F.concat("parameter_id", F.lit("-R")),
            "parameter_value": (F.col("parameter_value") * 2).cast("decimal(18,6)"),
            "model_version": F.lit("v3"),
            "batch_date": F.lit("2001-07-31").cast("date"),
        }
    )
    path = scratch_path(v.spark, "restated")
    pit.unionByName(restated).write.parquet(path)
    both = v.spark.read.parquet(path)
    figures = [
        provisions.reproduce_ecl(history, both, scenarios, terms, AS_OF, day).withColumn("known_at", F.lit(day))
        for day in (AS_OF, "2001-07-31")
    ]
    return _rounded(figures[0].unionByName(figures[1]), 2, "scenario_ecl").select("known_at", "loan_id", "scenario_name", "scenario_ecl")


# --- streams over the given tables ---------------------------------------------------


def _event_stream(v) -> DataFrame:
    schema = v.table("events").schema
    events = v.spark.readStream.schema(schema).parquet(f"{v.sf_dir.rstrip('/')}/events.parq*")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_bronze(v):
    scratch = scratch_path(v.spark, "stream-bronze")
    changes = _event_stream(v).select(
        F.to_json(
            F.struct(
                F.col("event_id").cast("string").alias("source_event_id"),
                F.concat(F.lit("U"), F.lpad(F.col("user_id").cast("string"), 12, "0")).alias("internal_uuid"),
                F.col("ts").alias("source_generated_at"),
                F.col("props").alias("raw_payload"),
            )
        ).alias("value"),
        F.col("ts").alias("arrived_at"),
    )
    for _ in range(2):  # the second run finds nothing new
        landing_streams.stream_bronze(changes, "internal", scratch, f"{scratch}/_checkpoint").awaitTermination()
    return layers.read_table(v.spark, scratch, "bronze.internal_profile").select(
        "source_system", "source_event_id", "internal_uuid", "ingest_date", "content_hash", "schema_version", "raw_payload"
    )


def _landed(v, source: str, value: Column, side: DataFrame | None = None, times: int = 2) -> DataFrame:
    """Bronze of a source whose payloads arrive twice: by a stream, and by another with its own checkpoint."""
    scratch = scratch_path(v.spark, f"stream-{source}")
    payloads = _event_stream(v).select(
        value.alias("value"), F.col("ts").alias("arrived_at"), F.concat(F.lit("file:/in/"), "event_id").alias("file_path")
    )
    for turn in range(times):
        landing_streams.stream_bronze(payloads, source, scratch, f"{scratch}/_checkpoint-{turn}", lambda _: side).awaitTermination()
    return layers.read_table(v.spark, scratch, landing_streams.TABLE_OF[source]).select(
        "source_system", "source_event_id", "application_id", "internal_uuid", "source_generated_at", "ingest_date", "schema_version"
    )


def _stamp_text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _known_users(v) -> DataFrame:
    """Nine of ten users of the events, as customers with an application."""
    users = v.table("events").filter("user_id % 10 <> 0").select("user_id").distinct()
    return users.selectExpr(
        "concat('784-', user_id) AS emirates_id", "concat('A', user_id) AS application_id", "concat('U', user_id) AS internal_uuid",
        "TIMESTAMP '2001-01-01 00:00:00' AS requested_at",
    )


@query
def stream_bronze_aml(v):
    call = F.struct(
        F.concat(F.lit("E"), "event_id").alias("event_id"), F.concat(F.lit("A"), "user_id").alias("callback_reference"),
        _stamp_text("ts").alias("callback_at"),
    )
    return _landed(v, "aml", F.to_json(call), _known_users(v))


@query
def stream_bronze_fraud(v):
    payload = F.struct(F.concat(F.lit("Q"), "event_id").alias("request_id"), _stamp_text("ts").alias("scored_at"), F.col("value").alias("fraud_score"))
    message = F.struct(
        F.concat(F.lit("A"), "user_id").alias("application_id"), F.concat(F.lit("U"), "user_id").alias("internal_uuid"),
        payload.alias("payload"), _stamp_text("ts").alias("captured_at"),
    )
    return _landed(v, "fraud", F.to_json(message))


@query
def stream_bronze_bureau(v):
    report = F.format_string(
        '<Report reportId="R%d" generatedAt="%s"><Subject><EmiratesId>784-%d</EmiratesId></Subject></Report>',
        "event_id", _stamp_text("ts"), "user_id",
    )
    return _landed(v, "aecb", report, _known_users(v))


@query
def stream_dedupe(v):
    scratch = scratch_path(v.spark, "stream-dedupe")
    events = _event_stream(v).select("event_id", "user_id", "event_type", "ts")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("copy")
    deduped = landing_streams.stream_dedupe(twice, ["event_id"], "ts", "1 hour")
    job = (
        deduped.writeStream.format("parquet")
        .option("path", f"{scratch}/out")
        .option("checkpointLocation", f"{scratch}/_checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    job.awaitTermination()
    return v.spark.read.schema(events.schema).parquet(f"{scratch}/out").drop("ts")


@query
def stream_dedupe_batches(v):
    """The events in four files, each with the last half hour of the one before; a restart after each."""
    scratch = scratch_path(v.spark, "stream-dedupe-batches")
    events = v.table("events").withColumn("ts", F.col("ts").cast("timestamp")).select("event_id", "user_id", "event_type", "ts")
    for since, until in pairwise(["0001-01-02", "2024-01-08", "2024-01-15", "2024-01-22", "9999-12-30"]):
        overlap = (F.col("ts") >= F.lit(since).cast("timestamp") - F.expr("INTERVAL 30 MINUTES")) & (F.col("ts") < F.lit(until).cast("timestamp"))
        events.filter(overlap).sortWithinPartitions(F.xxhash64("event_id")).write.mode("append").parquet(f"{scratch}/in")
        stream = v.spark.readStream.schema(events.schema).parquet(f"{scratch}/in")
        job = landing_streams.stream_dedupe(stream, ["event_id"], "ts", "1 hour").writeStream.format("parquet")
        job = job.option("path", f"{scratch}/out").option("checkpointLocation", f"{scratch}/_checkpoint").trigger(availableNow=True)
        job.start().awaitTermination()
    return v.spark.read.schema(events.schema).parquet(f"{scratch}/out").drop("ts")


@query
def stream_serving_latest(v):
    scratch = scratch_path(v.spark, "stream-serving")
    answers = _event_stream(v).select(
        F.col("user_id").alias("application_id"), F.col("event_type").alias("source_system"),
        F.col("ts").alias("received_at"), F.col("event_id").alias("bronze_id"), "value",
    )
    serving.stream_serving_latest(answers, f"{scratch}/out", f"{scratch}/_checkpoint").awaitTermination()
    return serving.serving_latest(v.spark, f"{scratch}/out").drop("received_at")
