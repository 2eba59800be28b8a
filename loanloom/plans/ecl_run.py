"""The reporting-date run: stages, provisions, roll-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.provisions import (
    coverage_check,
    ecl_portfolio_rollup,
    loans_in_stage,
    parameters_by_period,
    period_shortfalls,
    scenario_ecl,
    staged_parameters,
    write_ecl_calculation,
    write_lifetime_detail,
)
from loanloom.operators.staging import stage_classification, write_stage_history
from loanloom.session import scratch_path
from loanloom.sources.layers import read_layer, read_table, write_partitioned


def run_stages(
    spark: SparkSession, root: str, reporting_date: str, overrides: DataFrame, rebuttals: DataFrame
) -> None:
    """Classify the date's loans and append their history rows."""
    recommended = stage_classification(
        read_table(spark, root, "mart.fact_loan_performance"),
        read_table(spark, root, "ecl.credit_risk_signals"),
        read_table(spark, root, "ecl.risk_parameters_pit"),
        read_table(spark, root, "ecl.macro_scenario"),
        reporting_date,
    )
    prior = read_table(spark, root, "ecl.exposure_stage_history")
    rows = write_stage_history(recommended, prior, overrides, rebuttals, reporting_date)
    write_partitioned(rows, root, "ecl.exposure_stage_history", mode="replay", as_of=reporting_date)


def run_provisions(spark: SparkSession, root: str, reporting_date: str, overlays: DataFrame) -> DataFrame:
    """Book the date's provisions and return the loans with incomplete scenarios.

    The parameters side by side feed three results. They are written once to the
    shared scratch folder, so neither a lost executor nor the second and third
    reader repeats the large join.
    """
    history = read_layer(spark, root, "ecl.exposure_stage_history", reporting_date)
    scenarios = read_table(spark, root, "ecl.macro_scenario")
    params = staged_parameters(
        loans_in_stage(history, reporting_date, (1, 2, 3)),
        read_table(spark, root, "ecl.risk_parameters_pit"),
        scenarios,
        reporting_date,
    )
    scratch = scratch_path(spark, "parameters-by-period")
    terms = read_table(spark, root, "mart.dim_loan_terms")
    parameters_by_period(params, terms, with_ids=True).write.parquet(scratch)
    by_period = spark.read.parquet(scratch)

    figures = scenario_ecl(by_period)
    write_partitioned(
        write_ecl_calculation(figures, overlays, reporting_date), root, "ecl.ecl_calculation", mode="replay", as_of=reporting_date
    )
    write_partitioned(
        write_lifetime_detail(period_shortfalls(by_period), reporting_date),
        root, "ecl.ecl_lifetime_period_detail", mode="replay", as_of=reporting_date,
    )
    return coverage_check(history, figures, reporting_date)


def report_rollup(spark: SparkSession, root: str, reporting_date: str) -> DataFrame:
    """Booked provision per product and stage."""
    perf = read_table(spark, root, "mart.fact_loan_performance").filter(
        F.col("snapshot_date") == F.lit(reporting_date).cast("date")
    )
    return ecl_portfolio_rollup(
        read_layer(spark, root, "ecl.ecl_calculation", reporting_date),
        read_layer(spark, root, "ecl.exposure_stage_history", reporting_date),
        perf,
        reporting_date,
    )
