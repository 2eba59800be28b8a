"""Portfolio facts and the risk dashboard's questions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.credit import (
    bucket_rank,
    days_ago,
    delinquency_bucket,
    exact_round,
    last_month_end,
    month_start,
    months_ago,
    months_on_book,
)
from loanloom.schemas import conform

LAUNCH_CAPACITY = 10000  # decisions per day
APPROVAL_MONTHS = 6
TREND_DAYS = 30


def fact_loan_performance(servicing: DataFrame) -> DataFrame:
    """Monthly snapshot rows with the two derived columns."""
    return conform(
        servicing.withColumns(
            {
                "delinquency_bucket": delinquency_bucket(F.col("days_past_due")),
                "months_on_book": months_on_book(F.col("creation_date"), F.col("snapshot_date")),
            }
        ),
        "mart.fact_loan_performance",
    )


def last_n_days(df: DataFrame, column: str, as_of: str, days: int) -> DataFrame:
    return df.filter(F.col(column) >= days_ago(as_of, days))


def last_n_months(df: DataFrame, column: str, as_of: str, months: int) -> DataFrame:
    return df.filter(F.col(column) >= months_ago(as_of, months))


def at_last_month_end(perf: DataFrame, as_of: str) -> DataFrame:
    """Snapshot rows of the most recent month end (one partition per product)."""
    return perf.filter(F.col("snapshot_date") == last_month_end(as_of))


def share_pct(count: str, within: list[str], digits: int = 2) -> Column:
    """Percentage of a group's count within its parent group.

    Runs over already aggregated rows, so the window is as small as the result.
    """
    share = 100.0 * F.col(count) / F.sum(count).over(Window.partitionBy(*within))
    return exact_round(share, digits).cast("double")


def approval_rate_by_product_month(applications: DataFrame, as_of: str) -> DataFrame:
    """Outcome mix per product and month of the last six months."""
    counts = (
        last_n_months(applications, "decision_date", as_of, APPROVAL_MONTHS)
        .groupBy("product_type", month_start(F.col("decision_date")).alias("decision_month"), "decision_outcome")
        .agg(F.count(F.lit(1)).alias("decision_count"))
    )
    return counts.withColumn("pct_of_month", share_pct("decision_count", ["product_type", "decision_month"]))


def portfolio_health(perf: DataFrame, as_of: str) -> DataFrame:
    """Loan count and outstanding balance per product and status at the last month end."""
    return (
        at_last_month_end(perf, as_of)
        .groupBy("product_type", "snapshot_date", "status")
        .agg(
            F.count(F.lit(1)).alias("loan_count"),
            F.sum("outstanding_amount").alias("total_outstanding"),
            F.avg("outstanding_amount").alias("avg_outstanding"),
        )
    )


def delinquency_distribution(perf: DataFrame, as_of: str) -> DataFrame:
    """Active loans per product and delinquency bucket at the last month end."""
    counts = (
        at_last_month_end(perf, as_of)
        .filter(F.col("status") == "ACTIVE")
        .groupBy("product_type", "delinquency_bucket")
        .agg(F.count(F.lit(1)).alias("loan_count"))
    )
    return counts.withColumn("pct_of_product", share_pct("loan_count", ["product_type"]))


def by_bucket(df: DataFrame, *columns: str) -> DataFrame:
    """Sort by ``columns``, then by bucket in reporting order."""
    return df.orderBy(*columns, bucket_rank(F.col("delinquency_bucket")))


def decided_loans(perf: DataFrame, applications: DataFrame) -> DataFrame:
    """Snapshot rows whose application was decided.

    No column of the decision is used, so this is a semi join: a decision that
    was recorded twice does not count a loan twice.
    """
    return perf.join(applications.select("application_id"), "application_id", "left_semi")


def vintage_analysis(perf: DataFrame, applications: DataFrame, as_of: str) -> DataFrame:
    """Delinquency by months on book per origination cohort."""
    return (
        decided_loans(at_last_month_end(perf, as_of), applications)
        .groupBy(
            month_start(F.col("decision_date")).alias("origination_cohort"), "months_on_book", "delinquency_bucket"
        )
        .agg(F.count(F.lit(1)).alias("loan_count"), F.sum("outstanding_amount").alias("cohort_outstanding"))
    )


def volume_vs_capacity(applications: DataFrame, as_of: str, capacity: int = LAUNCH_CAPACITY) -> DataFrame:
    """Daily decisions of the last thirty days against the capacity target."""
    return (
        last_n_days(applications, "decision_date", as_of, TREND_DAYS)
        .groupBy("decision_date")
        .agg(F.count(F.lit(1)).alias("decisions_made"))
        .withColumns(
            {
                "launch_capacity_target": F.lit(capacity),
                "pct_of_launch_capacity": exact_round(100.0 * F.col("decisions_made") / capacity, 1).cast("double"),
            }
        )
    )


def dq_trend(scorecard: DataFrame, as_of: str) -> DataFrame:
    """Mean score per source and batch of the last thirty days."""
    return (
        last_n_days(scorecard, "batch_date", as_of, TREND_DAYS)
        .groupBy("source_system", "batch_date")
        .agg(F.avg("score").alias("avg_dq_score"))
    )
