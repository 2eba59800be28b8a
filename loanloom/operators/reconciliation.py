"""Point-in-time against through-the-cycle parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.functions.credit import divergence_flag, exact_round, pct_divergence
from loanloom.operators.staging import baseline_scenarios
from loanloom.sizing import small_side

_KEYS = ("loan_id", "reporting_date", "parameter_type", "horizon_type")


def pit_ttc_join(pit: DataFrame, ttc: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """Baseline PIT rows beside their TTC twin; a NULL period equals a NULL period."""
    day = F.lit(reporting_date).cast("date")
    point = (
        pit.filter(F.col("reporting_date") == day)
        .join(
            small_side(baseline_scenarios(scenarios).select("scenario_id")), "scenario_id", "left_semi"
        )
        .select(*_KEYS, "period_number", F.col("parameter_value").cast("double").alias("pit_value"))
    )
    cycle = ttc.filter(F.col("reporting_date") == day).select(
        *[F.col(c).alias(f"t_{c}") for c in (*_KEYS, "period_number")],
        F.col("parameter_value").cast("double").alias("ttc_value"),
    )
    condition = F.col("period_number").eqNullSafe(F.col("t_period_number"))
    for key in _KEYS:
        condition = condition & (F.col(key) == F.col(f"t_{key}"))
    # Both sides grow with loans times periods: a sort-merge join, which can spill.
    return point.join(cycle.hint("merge"), condition, "inner").select(*_KEYS, "period_number", "pit_value", "ttc_value")


def pit_vs_ttc(pit: DataFrame, ttc: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """Divergence of each parameter and whether it needs a look."""
    pct = pct_divergence(F.col("pit_value"), F.col("ttc_value"))
    return pit_ttc_join(pit, ttc, scenarios, reporting_date).select(
        *_KEYS,
        F.lit("BASELINE").alias("pit_scenario"),
        "pit_value",
        "ttc_value",
        (F.col("pit_value") - F.col("ttc_value")).alias("absolute_divergence"),
        exact_round(pct, 2).cast("double").alias("pct_divergence"),
        divergence_flag(pct).alias("divergence_flag"),
    )


def undefined_divergence(pit: DataFrame, ttc: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """How many parameters have no percentage because their TTC value is zero."""
    return (
        pit_ttc_join(pit, ttc, scenarios, reporting_date)
        .groupBy("parameter_type")
        .agg(F.count_if(F.col("ttc_value") == 0).alias("undefined_count"), F.count(F.lit(1)).alias("parameter_count"))
    )
