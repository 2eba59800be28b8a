"""Metrics per source, and alerts that open, repeat and are resolved.

An alert belongs to a source and a rule. It opens on the first run whose metric
warns or pages, repeats while that lasts, and is resolved by the first run whose
metric is fine again; a run that did not measure leaves it open. `advance_alerts`
goes one run further from the last one's rows, `alert_episodes` tells the same
from the metrics of all days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.quality import classify_severity
from loanloom.operators.warnings import COMPLETENESS_THRESHOLDS, DUPLICATE_THRESHOLDS
from loanloom.schemas import conform

KEYS = ("source_system", "rule_name")
OPEN_STATES = ("OPENED", "REPEATED", "UNMEASURED")
RANKS = {"OK": 0, "WARN": 1, "PAGE": 2}


def _rank(severity: Column) -> Column:
    ranked = F.lit(None).cast("int")
    for name, rank in RANKS.items():
        ranked = F.when(severity == name, rank).otherwise(ranked)
    return ranked


def _worse(left: Column, right: Column) -> Column:
    return F.when(F.coalesce(_rank(left), F.lit(-1)) >= F.coalesce(_rank(right), F.lit(-1)), left).otherwise(right)


def batch_metrics(
    df: DataFrame, source: str, required: Sequence[str], key: str = "application_id", by: Sequence[str] = ()
) -> DataFrame:
    """Completeness and duplicate rate of a source, both out of one pass.

    Rows are counted per key map-side, with the non-null values beside them, so
    a key with very many rows is one row in the shuffle. With ``by`` (a run date,
    say) there are two rows for each of its values; without rows the value is NULL
    and the severity OK.
    """
    present = [F.count(c).alias(f"__has_{i}") for i, c in enumerate(required)]
    per_key = df.groupBy(*by, F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"), *present)
    held = sum((F.sum(f"__has_{i}") for i in range(len(required))), F.lit(0))
    totals = per_key.groupBy(*by).agg(
        F.sum("__n").alias("n"),
        F.sum(F.when(F.col("__n") > 1, F.col("__n")).otherwise(0)).alias("repeated"),
        held.alias("held"),
    )
    rules = (
        ("source_completeness", F.try_divide(F.col("held"), F.col("n") * len(required)), COMPLETENESS_THRESHOLDS, False),
        ("duplicate_rate", F.try_divide(F.col("repeated"), F.col("n")), DUPLICATE_THRESHOLDS, True),
    )
    metrics = [
        F.struct(
            F.lit(rule).alias("rule_name"),
            F.round(value, 4).alias("metric_value"),
            F.lit(warn).alias("warn_threshold"),
            F.lit(page).alias("page_threshold"),
            classify_severity(value, warn, page, higher_is_worse).alias("severity"),
        )
        for rule, value, (warn, page), higher_is_worse in rules
    ]
    rows = totals.select(*by, F.explode(F.array(*metrics)).alias("m"))
    return rows.select(F.lit(source).alias("source_system"), *by, "m.*", F.current_timestamp().alias("evaluated_at"))


def of_source(metrics: DataFrame, source: str) -> DataFrame:
    """Rows of `warnings` under the source they speak of."""
    return metrics.select(F.lit(source).alias("source_system"), *metrics.columns)


def advance_alerts(previous: DataFrame, metrics: DataFrame, as_of: str) -> DataFrame:
    """The alert rows of one run, from those of the run before and the run's metrics.

    ``previous`` are the rows of the last run that wrote any; resolved ones count
    no longer. Both sides have a row per source and rule. A rule without a metric
    today (no row, or a NULL value) stays open as ``UNMEASURED``.
    """
    before = previous.filter(F.col("alert_state").isin(*OPEN_STATES)).select(
        *[F.col(k).alias(f"__{k}") for k in KEYS],
        F.col("opened_on").alias("__opened_on"),
        F.col("worst_severity").alias("__worst"),
        F.col("runs_open").alias("__runs"),
    )
    today = metrics.filter(F.col("metric_value").isNotNull())
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in KEYS]
    joined = today.join(before, same, "full_outer")
    held, bad = F.col("__opened_on").isNotNull(), F.col("severity").isin("WARN", "PAGE")
    state = (
        F.when(F.col("severity").isNull(), "UNMEASURED")
        .when(bad & held, "REPEATED")
        .when(bad, "OPENED")
        .when(held, "RESOLVED")
    )
    day = F.lit(as_of).cast("date")
    rows = joined.select(
        *[F.coalesce(k, f"__{k}").alias(k) for k in KEYS],
        state.alias("alert_state"),
        "severity",
        "metric_value",
        F.coalesce("__opened_on", day).alias("opened_on"),
        _worse(F.col("__worst"), F.col("severity")).alias("worst_severity"),
        (F.coalesce("__runs", F.lit(0)) + F.when(bad, 1).otherwise(0)).alias("runs_open"),
        F.current_timestamp().alias("evaluated_at"),
        day.alias("batch_date"),
    )
    return conform(rows.filter(F.col("alert_state").isNotNull()), "gold.dq_alert")


def alert_episodes(metrics: DataFrame) -> DataFrame:
    """Every alert that ever was: when it opened, how long and how bad it was, when it ended.

    ``metrics`` has a row per source, rule and ``batch_date``. An episode is a run of
    warning days with no measured fine day in between (gaps and islands over the
    days of one source and rule). ``resolved_on`` is NULL while it is open.
    """
    days = Window.partitionBy(*KEYS).orderBy("batch_date")
    measured = metrics.filter(F.col("metric_value").isNotNull()).select(
        *KEYS, "batch_date", "severity", F.col("severity").isin("WARN", "PAGE").alias("bad")
    )
    ordered = measured.withColumns(
        {
            "fine_before": F.sum(F.when(F.col("bad"), 0).otherwise(1)).over(days),
            "next_fine": F.min(F.when(~F.col("bad"), F.col("batch_date"))).over(
                days.rowsBetween(0, Window.unboundedFollowing)
            ),
        }
    )
    return (
        ordered.filter("bad")
        .groupBy(*KEYS, "fine_before")
        .agg(
            F.min("batch_date").alias("opened_on"),
            F.max("batch_date").alias("last_seen_on"),
            F.first("next_fine").alias("resolved_on"),
            F.count(F.lit(1)).alias("runs_open"),
            F.max(F.struct(_rank(F.col("severity")), F.col("severity")))["severity"].alias("worst_severity"),
        )
        .drop("fine_before")
    )
