"""Scalar derivations of the servicing and provisioning tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names in reporting order, with their inclusive bounds.
DELINQUENCY_BUCKETS = (
    ("CURRENT", 0, 0),
    ("1-30", 1, 30),
    ("31-60", 31, 60),
    ("61-90", 61, 90),
)
WORST_BUCKET = "90+"

INVESTIGATE_ABOVE_PCT = 50
MONITOR_ABOVE_PCT = 20


def _first_match(branches: list[tuple[Column, object]], default: object) -> Column:
    chain = None
    for condition, value in branches:
        chain = F.when(condition, value) if chain is None else chain.when(condition, value)
    return chain.otherwise(default)


def delinquency_bucket(dpd: Column) -> Column:
    """Bucket of days past due; missing and negative values fall into the worst."""
    return _first_match(
        [(dpd.between(low, high), F.lit(name)) for name, low, high in DELINQUENCY_BUCKETS], F.lit(WORST_BUCKET)
    )


def bucket_rank(bucket: Column) -> Column:
    """Reporting order of a bucket, for ``orderBy``."""
    return _first_match(
        [(bucket == name, F.lit(rank)) for rank, (name, _, _) in enumerate(DELINQUENCY_BUCKETS)],
        F.lit(len(DELINQUENCY_BUCKETS)),
    )


def months_on_book(creation_date: Column, snapshot_date: Column) -> Column:
    """Whole months since origination."""
    return F.floor(F.months_between(snapshot_date, creation_date)).cast("int")


def exact_round(value: Column, digits: int) -> Column:
    """Round a computed double half up, as its decimal value would be.

    Eight decimals are taken first: they drop the binary noise of the
    computation, which would otherwise decide a tie.
    """
    return value.cast("decimal(30,8)").cast(f"decimal({22 + digits},{digits})")


def money(value: Column) -> Column:
    """A computed amount in cents."""
    return exact_round(value, 2).cast("decimal(18,2)")


def discount_factor(rate: Column, period: Column) -> Column:
    return F.pow(F.lit(1.0) + rate.cast("double"), -period.cast("double"))


def pct_divergence(value: Column, benchmark: Column) -> Column:
    """Unrounded percentage; NULL where the benchmark is zero."""
    return F.try_divide(F.lit(100.0) * (value - benchmark), benchmark)


def divergence_flag(pct: Column) -> Column:
    return (
        F.when(F.abs(pct) > INVESTIGATE_ABOVE_PCT, "INVESTIGATE")
        .when(F.abs(pct) > MONITOR_ABOVE_PCT, "MONITOR")
        .otherwise("WITHIN_TOLERANCE")
    )


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def last_month_end(as_of: str) -> Column:
    """The most recent month end strictly before the month of ``as_of``."""
    return F.date_sub(F.trunc(F.lit(as_of).cast("date"), "MM"), 1)


def months_ago(as_of: str, months: int) -> Column:
    return F.add_months(F.lit(as_of).cast("date"), -months)


def days_ago(as_of: str, days: int) -> Column:
    return F.date_sub(F.lit(as_of).cast("date"), days)
