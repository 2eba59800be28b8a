"""Batch metrics that warn or page but never block; each is one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanloom.functions.quality import classify_severity
from loanloom.operators.quantiles import by_ranges, exact_quantiles

# Warn and page threshold of each metric.
COMPLETENESS_THRESHOLDS = (0.95, 0.90)
DUPLICATE_THRESHOLDS = (0.01, 0.05)
DRIFT_THRESHOLDS = (0.1, 0.2)
BUREAU_SLA_HOURS = 2.0
REVIEW_SLA_HOURS = 4.0
SHARE_FLOOR = 1e-6
EDGE_DIGITS = 9


def _result(
    metrics: DataFrame, rule: str, value: Column, thresholds: tuple[float, float], higher_is_worse: bool, digits: int
) -> DataFrame:
    """Severity from the unrounded value; the stored value is rounded."""
    warn, page = thresholds
    return metrics.select(
        F.lit(rule).alias("rule_name"),
        F.round(value, digits).alias("metric_value"),
        F.lit(warn).alias("warn_threshold"),
        F.lit(page).alias("page_threshold"),
        classify_severity(value, warn, page, higher_is_worse).alias("severity"),
        F.current_timestamp().alias("evaluated_at"),
    )


def warn_source_completeness(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Mean over the required columns of the share of non-null values."""
    shares = df.agg(*[F.avg(F.col(c).isNotNull().cast("int")).alias(c) for c in required])
    mean = sum((F.col(c) for c in required), F.lit(0.0)) / len(required)
    return _result(shares, "source_completeness", mean, COMPLETENESS_THRESHOLDS, False, 4)


def warn_duplicate_rate(df: DataFrame, key: str = "application_id") -> DataFrame:
    """Share of rows whose key occurs more than once."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated"), F.sum("n").alias("n"))
    return _result(
        totals, "duplicate_rate", F.try_divide(F.col("repeated"), F.col("n")), DUPLICATE_THRESHOLDS, True, 4
    )


def _inner_edges(cuts: Column) -> tuple[Column, Column]:
    """Bin edges between the two open ends, and whether there is any bin at all.

    Rounding hides last-digit noise of the interpolation, which would otherwise
    move a score across an edge.
    """
    distinct = F.array_distinct(F.transform(cuts, lambda c: F.round(c.cast("double"), EDGE_DIGITS)))
    inner = F.when(F.size(distinct) > 2, F.slice(distinct, F.lit(2), F.size(distinct) - 2))
    return F.coalesce(inner, F.array().cast("array<double>")), F.coalesce(F.size(distinct) > 1, F.lit(False))


def _bin_of(edges: Column, score: Column) -> Column:
    """Bins are closed on the right: a score on an edge stays below it."""
    return F.size(F.filter(edges, lambda edge: edge < score))


#: Integers between the least and the greatest score up to which one task takes all frequencies.
FEW_VALUES = 1 << 18


def _exact_bins(known: DataFrame, quantiles: list[float]) -> DataFrame:
    """Bin counts through the score frequencies.

    Rows are counted per score before the shuffle. Few possible scores are handled as one
    array in one plan; else the quantiles come from ranges of the scores, and the bins are
    counted where the frequencies lie. Both give the same numbers.
    """
    frequencies = known.groupBy("score").agg(
        F.count_if("is_baseline").alias("expected"), F.count_if(~F.col("is_baseline")).alias("actual")
    )
    if not isinstance(known.schema["score"].dataType, (T.ByteType, T.ShortType)):
        least, most = known.agg(F.min("score"), F.max("score")).first()
        if least is not None and most - least >= FEW_VALUES:
            return _ranged_bins(by_ranges(frequencies, "score"), quantiles)
    whole = frequencies.agg(
        F.percentile("score", F.array(*map(F.lit, quantiles)), F.col("expected")).alias("cuts"),
        F.collect_list(F.struct("score", "expected", "actual")).alias("table"),
    )
    edges, has_bins = _inner_edges(F.col("cuts"))
    return (
        whole.select(edges.alias("edges"), has_bins.alias("has_bins"), F.explode("table").alias("f"))
        .groupBy(_bin_of(F.col("edges"), F.col("f.score")).alias("bin"), "has_bins")
        .agg(F.sum("f.expected").alias("expected"), F.sum("f.actual").alias("actual"))
    )


def _ranged_bins(ranged: DataFrame, quantiles: list[float]) -> DataFrame:
    cuts = exact_quantiles(ranged, "score", "expected", quantiles)
    edges, has_bins = _inner_edges(F.array(*map(F.lit, cuts)) if cuts else F.lit(None).cast("array<double>"))
    return ranged.groupBy(_bin_of(edges, F.col("score")).alias("bin"), has_bins.alias("has_bins")).agg(
        F.sum("expected").alias("expected"), F.sum("actual").alias("actual")
    )


def _approximate_bins(known: DataFrame, quantiles: list[float], accuracy: int) -> DataFrame:
    """Bin counts with edges from a mergeable quantile sketch: two scans, nothing per value."""
    cuts = known.filter("is_baseline").agg(F.percentile_approx("score", quantiles, accuracy).alias("cuts"))
    edges, has_bins = _inner_edges(F.col("cuts"))
    found = cuts.select(edges.alias("edges"), has_bins.alias("has_bins"))
    edge_values = found.select("edges").scalar()
    above = [
        F.when(F.get(edge_values, F.lit(i)) < F.col("score"), 1).otherwise(0) for i in range(len(quantiles) - 2)
    ]
    return known.groupBy(
        sum(above, F.lit(0)).alias("bin"), found.select("has_bins").scalar().alias("has_bins")
    ).agg(F.count_if("is_baseline").alias("expected"), F.count_if(~F.col("is_baseline")).alias("actual"))


def warn_fraud_score_drift_psi(
    scores: DataFrame,
    score: str = "fraud_score",
    baseline: str = "is_baseline",
    bins: int = 10,
    approximate: int | None = None,
) -> DataFrame:
    """Population Stability Index over baseline-quantile bins.

    Scores are declared as integers and get exact quantiles, however many values they
    have. A fractional score needs ``approximate``, the accuracy of ``percentile_approx``.
    """
    if approximate is None and not isinstance(scores.schema[score].dataType, T.IntegralType):
        raise ValueError("exact quantiles need an integer score; pass approximate=<accuracy> otherwise")
    known = scores.filter(F.col(score).isNotNull()).select(
        F.col(score).alias("score"), F.col(baseline).alias("is_baseline")
    )
    quantiles = [i / bins for i in range(bins + 1)]
    binned = _exact_bins(known, quantiles) if approximate is None else _approximate_bins(known, quantiles, approximate)

    over_bins = Window.partitionBy()  # at most ``bins`` rows

    def share(side: str) -> Column:
        part = F.try_divide(F.col(side), F.sum(side).over(over_bins))
        return F.greatest(F.coalesce(part, F.lit(0.0)), F.lit(SHARE_FLOOR))

    parts = binned.select("has_bins", share("expected").alias("e"), share("actual").alias("a"))
    term = (F.col("a") - F.col("e")) * F.ln(F.col("a") / F.col("e"))
    psi = parts.agg(F.coalesce(F.sum(F.when(F.col("has_bins"), term)), F.lit(0.0)).alias("psi"))
    return _result(psi, "fraud_score_drift_psi", F.col("psi"), DRIFT_THRESHOLDS, True, 4)


def hours_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(3600.0 * 1e6)


def bureau_arrival_lag(df: DataFrame, submitted: str, received: str, sla_hours: float = BUREAU_SLA_HOURS) -> DataFrame:
    """Lag and severity of every response."""
    lag = hours_between(F.col(submitted), F.col(received))
    return df.withColumns(
        {
            "lag_hours": F.round(lag, 2),
            "lag_severity": classify_severity(lag, sla_hours, 2 * sla_hours, True),
        }
    )


def warn_bureau_arrival_lag(
    df: DataFrame, submitted: str, received: str, sla_hours: float = BUREAU_SLA_HOURS
) -> DataFrame:
    """The worst lag of the batch."""
    worst = df.agg(F.max(hours_between(F.col(submitted), F.col(received))).alias("lag"))
    return _result(worst, "aecb_arrival_lag_hours", F.col("lag"), (sla_hours, 2 * sla_hours), True, 2)


def warn_manual_review_queue_age(
    queue: DataFrame, as_of: str, column: str = "queued_at", sla_hours: float = REVIEW_SLA_HOURS
) -> DataFrame:
    """Age of the oldest queued item at the instant ``as_of``; an empty queue has age 0."""
    oldest = queue.agg(F.min(column).alias("oldest"))
    age = F.coalesce(hours_between(F.col("oldest"), F.lit(as_of).cast("timestamp")), F.lit(0.0))
    return _result(oldest, "manual_review_queue_age_hours", age, (sla_hours, 2 * sla_hours), True, 2)


def raise_alerts(results: DataFrame) -> DataFrame:
    """Metrics somebody has to look at."""
    return results.filter(F.col("severity").isin("WARN", "PAGE"))
