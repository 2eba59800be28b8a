"""Per source, batch and rule: how many records passed, and a 0-100 score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.operators.rules import BLOCKING
from loanloom.schemas import conform

MUST_PASS_WEIGHT = 2
WARNING_WEIGHT = 1
WARNING_SCORES = {"OK": 100, "WARN": 50, "PAGE": 0}


def must_pass_rows(evaluated: DataFrame, source: Column) -> DataFrame:
    """Scorecard rows of the blocking rules.

    Passes are counted for all rules in one aggregate per source and batch; only
    those few rows are unpivoted, never the records.
    """
    names = list(BLOCKING)
    counts = evaluated.groupBy(source.alias("source_system"), "batch_date").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col(f"passes_{n}")).alias(n) for n in names]
    )
    rows = counts.unpivot(["source_system", "batch_date", "n"], names, "rule_name", "passed")
    return conform(
        rows.withColumns(
            {
                "rule_tier": F.lit("MUST_PASS"),
                "pass_rate": F.col("passed") / F.col("n"),
                "records_evaluated": F.col("n"),
                "records_failed": F.col("n") - F.col("passed"),
                "score": F.round(100 * F.col("passed") / F.col("n")),
                "evaluated_at": F.current_timestamp(),
            }
        ),
        "gold.dq_scorecard",
    )


def warning_rows(results: DataFrame, source: str | None, as_of: str) -> DataFrame:
    """Scorecard rows of batch metrics, scored by severity.

    Without a ``source`` the metrics name their own.
    """
    score = F.lit(WARNING_SCORES["OK"])
    for severity, points in WARNING_SCORES.items():
        score = F.when(F.col("severity") == severity, points).otherwise(score)
    return conform(
        results.withColumns(
            {
                "source_system": F.col("source_system") if source is None else F.lit(source),
                "batch_date": F.lit(as_of).cast("date"),
                "rule_tier": F.lit("WARNING"),
                "score": score,
            }
        ),
        "gold.dq_scorecard",
    )


def build_dq_scorecard(must_pass: DataFrame, *warnings: DataFrame) -> DataFrame:
    combined = must_pass
    for rows in warnings:
        combined = combined.unionByName(rows)
    return combined


def dq_scorecard_summary(scorecard: DataFrame) -> DataFrame:
    """Weighted mean score per source and batch; blocking rules weigh double."""
    weight = F.when(F.col("rule_tier") == "MUST_PASS", MUST_PASS_WEIGHT).otherwise(WARNING_WEIGHT)
    return scorecard.groupBy("source_system", "batch_date").agg(
        (F.sum(F.col("score") * weight) / F.sum(weight)).alias("composite_score")
    )
