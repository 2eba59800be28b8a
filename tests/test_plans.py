"""Physical plans keep the shape they were designed for."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from loanloom.functions.text import name_uuid
from loanloom.operators import mart, provisions, rules, staging
from loanloom.plans.catalogue import REGISTRY, Inputs
from loanloom.schemas import conform
from loanloom.sources import layers
from loanloom.sources.sample_views import AS_OF, view

# These write stored tables or run streams while the plan is built.
LIGHT = sorted(
    k for k in REGISTRY
    if not k.startswith(("stream_", "rule_")) and k not in {
        "write_partitioned", "evaluate_must_pass", "blocked_records", "passed_records", "gold_sql_gate", "blocked_count",
        "warn_source_completeness", "warn_duplicate_rate", "build_dq_scorecard", "raise_alerts", "build_decision_input",
        "build_gold_request", "pending_sources", "assemble_application_request",
    }
)
# The only windows: over aggregated rows, one loan's periods, scenarios or reporting dates.
WINDOWED = {
    "alert_episodes",  # over the days of one source and rule
    "approval_rate_by_product_month", "delinquency_distribution", "pct_of_month", "pct_of_product", "order_presentations",
    "warn_fraud_score_drift_psi", "warn_score_drift_wide", "stage_transition", "stage2_param_joins", "write_lifetime_detail",
    "write_ecl_calculation", "overlay_check", "rollup_joins", "ecl_portfolio_rollup",
}
PYTHON = {"jaro_winkler", "aml_match_score", "aml_match_decision", "conform_aml", "audit_aml", "match_exceptions",
          "manual_review_queue", "union_match_audit", "warn_manual_review_queue_age"}


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", LIGHT)
def test_no_pairing_joins_and_known_windows(key, spark, sf_dir):
    plan = physical(REGISTRY[key](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert bool(re.search(r"\bWindow\b", plan)) == (key in WINDOWED)
    assert ("ArrowEvalPython" in plan) == (key in PYTHON)
    assert "BatchEvalPython" not in plan


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    layers.write_partitioned(mart.fact_loan_performance(view(spark, sf_dir, "servicing")), root, "mart.fact_loan_performance")
    layers.write_partitioned(view(spark, sf_dir, "pit"), root, "ecl.risk_parameters_pit")
    decisions = view(spark, sf_dir, "decisions")
    layers.write_partitioned(decisions, root, "gold.lending_application_response")
    return root


def test_dashboard_scan_prunes_partitions_and_columns(spark, lake):
    df = mart.portfolio_health(layers.read_table(spark, lake, "mart.fact_loan_performance"), "2001-07-15")
    plan = physical(df)
    assert re.search(r"PartitionFilters: \[isnotnull\(snapshot_date[^\]]*\(snapshot_date[^\]]*= 2001-06-30\)", plan)
    assert re.search(r"ReadSchema: struct<status:string,outstanding_amount:decimal\(18,2\)>", plan)


def test_run_date_is_a_partition_filter(spark, lake):
    plan = physical(layers.read_layer(spark, lake, "gold.lending_application_response", AS_OF))
    assert "PartitionFilters: [isnotnull(batch_date" in plan


def test_parameter_filters_reach_the_scan(spark, lake, sf_dir):
    pit = layers.read_table(spark, lake, "ecl.risk_parameters_pit")
    plan = physical(staging.origination_pd(pit, view(spark, sf_dir, "macro_scenario")))
    assert "EqualTo(parameter_type,PD)" in plan and "EqualTo(horizon_type,12_MONTH)" in plan
    assert "ReadSchema: struct<loan_id:string,reporting_date:date,scenario_id:string,parameter_type:string,horizon_type:string,parameter_value" in plan


def test_provisions_move_parameters_once(spark, lake, sf_dir):
    """One exchange of the parameter rows; all aggregates run on its partitioning."""
    v = Inputs(spark, sf_dir)
    pit = layers.read_table(spark, lake, "ecl.risk_parameters_pit")
    df = provisions.stage23_ecl(v.stage_history, pit, v.macro_scenario, v.loan_terms, AS_OF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(df)
        exchanges = [line for line in plan.splitlines() if re.search(r"\bExchange hashpartitioning", line)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(exchanges) <= 3, plan  # parameters, loans, loan terms
    assert all(re.search(r"hashpartitioning\(loan_id#\d+, \d+\)", line) for line in exchanges), plan


def test_figures_of_two_days_move_the_versions_once(spark, lake, sf_dir):
    """The version is picked on the loan's partitioning, and both days read one exchange of the versions."""
    v = Inputs(spark, sf_dir)
    pit = layers.read_table(spark, lake, "ecl.risk_parameters_pit")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        days = [provisions.reproduce_ecl(v.stage_history, pit, v.macro_scenario, v.loan_terms, AS_OF, day) for day in (AS_OF, "2001-07-31")]
        plan = physical(days[0].unionByName(days[1]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "ReusedExchange" not in line]
    assert all(re.search(r"hashpartitioning\(loan_id#\d+, \d+\)", line) for line in exchanges), plan
    assert len(exchanges) <= 3, plan  # versions, loans, loan terms


def test_gate_counts_without_a_window(spark, lake):
    silver = conform(layers.read_table(spark, lake, "gold.lending_application_response"), "silver.lending_application_request")
    plan = physical(rules.evaluate_must_pass(silver, AS_OF))
    assert not re.search(r"\bWindow\b", plan) and "partial_count" in plan


def test_scorecard_unpivots_only_aggregates(spark, lake):
    from loanloom.operators.scorecard import must_pass_rows

    silver = conform(layers.read_table(spark, lake, "gold.lending_application_response"), "silver.lending_application_request")
    plan = physical(must_pass_rows(rules.evaluate_must_pass(silver, AS_OF), F.lit("internal")))
    assert plan.index("Expand") < plan.index("HashAggregate")  # printed top down


def _without_broadcasts(spark, df) -> str:
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return physical(df())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_coverage_makes_the_parameters_once(spark, sf_dir):
    """Leaving the severe scenario of one product out takes no second pass over the parameters."""
    plan = physical(REGISTRY["coverage_check"](spark, sf_dir))
    assert plan.count("explode([0,1,2,3,4,5,6,7,8,9,10,11,12])") == 1, plan


def test_terms_join_sorts_no_parameters(spark, lake, sf_dir):
    v = Inputs(spark, sf_dir)
    pit = layers.read_table(spark, lake, "ecl.risk_parameters_pit")
    plan = _without_broadcasts(spark, lambda: provisions.stage23_ecl(v.stage_history, pit, v.macro_scenario, v.loan_terms, AS_OF))
    assert not re.search(r"SortMergeJoin.*LeftOuter", plan) and "ShuffledHashJoin" in plan, plan


def test_only_ids_of_point_parameters_are_shuffled(spark, lake, sf_dir):
    v = Inputs(spark, sf_dir)
    pit = layers.read_table(spark, lake, "ecl.risk_parameters_pit")
    plan = _without_broadcasts(
        spark, lambda: provisions.per_scenario(v.stage_history, pit, v.macro_scenario, v.loan_terms, AS_OF, with_ids=True)
    )
    assert re.search(r"CASE WHEN isnull\(period_number#\d+\) THEN parameter_id#\d+ END AS parameter_id", plan), plan


def test_ids_take_no_regular_expression(spark):
    df = spark.sql("SELECT 'a' AS a, CAST(NULL AS INT) AS b").select(name_uuid(F.col("a"), F.col("b")).alias("id"))
    assert "regexp" not in df._jdf.queryExecution().analyzed().toString()
    digest = hashlib.sha256(b"a|").hexdigest()
    assert df.first().id == "-".join((digest[:8], digest[8:12], digest[12:16], digest[16:20], digest[20:32]))
