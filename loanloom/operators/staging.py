"""IFRS 9 stage per loan and reporting date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.text import name_uuid
from loanloom.operators.keys import in_force, latest_per_key
from loanloom.schemas import conform
from loanloom.sizing import small_side

# Fixed values of the credit policy.
POLICY_VERSION = "v1.0"
DPD_STAGE_2 = 30
DPD_STAGE_3 = 90
NOTCHES_STAGE_2 = 2
PD_RATIO_STAGE_2 = 2.0

BASELINE = "BASELINE"

SIGNAL_COLUMNS = (
    "loan_id", "current_rating_notch", "origination_rating_notch", "watchlist_flag", "forbearance_flag",
    "unlikely_to_pay_flag",
)


def loan_snapshot(perf: DataFrame, reporting_date: str, status: str = "ACTIVE") -> DataFrame:
    """The loans to be staged at a date."""
    return perf.filter(
        (F.col("snapshot_date") == F.lit(reporting_date).cast("date")) & (F.col("status") == status)
    ).select(
        "loan_id", "product_type", "days_past_due", "outstanding_amount", "status",
        F.col("snapshot_date").alias("reporting_date"),
    )


def risk_signals(signals: DataFrame) -> DataFrame:
    return signals.select(*SIGNAL_COLUMNS)


def baseline_scenarios(scenarios: DataFrame, reporting_date: str | None = None) -> DataFrame:
    """The baseline scenario id of each date; two of one date are an error."""
    chosen = scenarios.filter(F.col("scenario_name") == BASELINE)
    if reporting_date is not None:
        chosen = chosen.filter(F.col("reporting_date") == F.lit(reporting_date).cast("date"))
    counted = chosen.groupBy("reporting_date").agg(
        F.count(F.lit(1)).alias("n"), F.max("scenario_id").alias("scenario_id")
    )
    return counted.select(
        "reporting_date",
        F.when(F.col("n") == 1, F.col("scenario_id"))
        .otherwise(F.raise_error(F.lit("more than one baseline scenario for a reporting date")))
        .alias("scenario_id"),
    )


def _twelve_month_pd(pit: DataFrame, scenarios: DataFrame) -> DataFrame:
    """12-month PD rows under the baseline scenario of their own date."""
    wanted = pit.filter((F.col("parameter_type") == "PD") & (F.col("horizon_type") == "12_MONTH")).select(
        "loan_id", "reporting_date", "scenario_id", "parameter_value"
    )
    return wanted.join(small_side(baseline_scenarios(scenarios)), ["reporting_date", "scenario_id"], "left_semi")


def origination_pd(pit: DataFrame, scenarios: DataFrame) -> DataFrame:
    """The earliest baseline 12-month PD of each loan."""
    return (
        _twelve_month_pd(pit, scenarios)
        .groupBy("loan_id")
        .agg(
            F.min_by("parameter_value", "reporting_date").alias("pd_at_origination"),
            F.min("reporting_date").alias("origination_reporting_date"),
        )
    )


def pd_comparison(pit: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """Current against origination PD of the loans that have a current one.

    Both come out of one aggregate per loan: no self-join, one exchange.
    """
    current = F.when(F.col("reporting_date") == F.lit(reporting_date).cast("date"), F.col("parameter_value"))
    return (
        _twelve_month_pd(pit, scenarios)
        .groupBy("loan_id")
        .agg(
            F.max(current).alias("pd_at_reporting_date"),
            F.min_by("parameter_value", "reporting_date").alias("pd_at_origination"),
        )
        .filter(F.col("pd_at_reporting_date").isNotNull())
        .withColumn(
            "pd_deterioration_ratio",
            F.try_divide(F.col("pd_at_reporting_date").cast("double"), F.col("pd_at_origination").cast("double")),
        )
    )


def signals_left_join(snapshot: DataFrame, signals: DataFrame, comparison: DataFrame) -> DataFrame:
    """Snapshot with whatever is known about each loan; nothing is dropped."""
    return snapshot.join(risk_signals(signals), "loan_id", "left").join(comparison, "loan_id", "left")


# --- triggers ---------------------------------------------------------------


def _known(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


def _triggers() -> dict[str, Column]:
    """Each trigger as a never-NULL flag, in order of precedence within its stage."""
    dpd = F.col("days_past_due")
    return {
        "DPD_90_BACKSTOP": _known(dpd >= DPD_STAGE_3),
        "UNLIKELY_TO_PAY": _known(F.col("unlikely_to_pay_flag")),
        "DPD_30_BACKSTOP": _known(dpd >= DPD_STAGE_2),
        "WATCHLIST": _known(F.col("watchlist_flag")),
        "FORBEARANCE": _known(F.col("forbearance_flag")),
        "RATING_DOWNGRADE_2_NOTCH": _known(F.col("rating_notches_downgraded") >= NOTCHES_STAGE_2),
        "PD_DETERIORATION": _known(F.col("pd_deterioration_ratio") >= PD_RATIO_STAGE_2),
    }


STAGE_3_TRIGGERS = ("DPD_90_BACKSTOP", "UNLIKELY_TO_PAY")
DPD_TRIGGERS = ("DPD_90_BACKSTOP", "DPD_30_BACKSTOP")


def _decide(skip: tuple[str, ...] = ()) -> tuple[Column, Column]:
    """Stage and primary trigger by precedence, leaving out the skipped triggers."""
    stage = trigger = None
    for name, fired in _triggers().items():
        if name in skip:
            continue
        level = 3 if name in STAGE_3_TRIGGERS else 2
        stage = F.when(fired, level) if stage is None else stage.when(fired, level)
        trigger = F.when(fired, name) if trigger is None else trigger.when(fired, name)
    return stage.otherwise(1), trigger.otherwise("NO_TRIGGER")


def stage_classification(
    perf: DataFrame, signals: DataFrame, pit: DataFrame, scenarios: DataFrame, reporting_date: str
) -> DataFrame:
    """The stage the automated rules recommend per loan, with its evidence."""
    evidence = signals_left_join(
        loan_snapshot(perf, reporting_date), signals, pd_comparison(pit, scenarios, reporting_date)
    ).withColumn("rating_notches_downgraded", F.col("origination_rating_notch") - F.col("current_rating_notch"))
    stage, trigger = _decide()
    return evidence.select(
        "loan_id", "reporting_date", stage.alias("recommended_stage"), trigger.alias("primary_trigger"),
        "days_past_due", "pd_at_origination", "pd_at_reporting_date", "pd_deterioration_ratio",
        "rating_notches_downgraded", "watchlist_flag", "forbearance_flag", "unlikely_to_pay_flag",
    )


# --- history ----------------------------------------------------------------


def transition_type(previous: Column, current: Column) -> Column:
    return (
        F.when(previous.isNull(), "NEW_ORIGINATION")
        .when(current > previous, "STAGE_DOWNGRADE")
        .when((current < previous) & (current == 1), "CURE")
        .when(current < previous, "STAGE_UPGRADE")
        .otherwise("NO_CHANGE")
    )


def stage_transition(history: DataFrame) -> DataFrame:
    """Previous stage and kind of transition for every loan and reporting date.

    The history is first brought to its grain (one row per loan and date) by an
    aggregate, so a window partition is never longer than the reporting calendar.
    """
    grain = latest_per_key(
        history.select("loan_id", "reporting_date", "current_stage", "stage_history_id"),
        ["loan_id", "reporting_date"],
        ["stage_history_id"],
    )
    by_date = Window.partitionBy("loan_id").orderBy("reporting_date")
    return grain.withColumn("previous_stage", F.lag("current_stage").over(by_date)).withColumn(
        "stage_transition_type", transition_type(F.col("previous_stage"), F.col("current_stage"))
    )


def current_stage(history: DataFrame) -> DataFrame:
    """The most recent stage row of each loan."""
    return latest_per_key(
        history.select("loan_id", "reporting_date", "current_stage", "stage_history_id"),
        ["loan_id"],
        ["reporting_date", "stage_history_id"],
    )


def write_stage_history(
    recommended: DataFrame,
    prior: DataFrame,
    overrides: DataFrame,
    rebuttals: DataFrame,
    reporting_date: str,
) -> DataFrame:
    """History rows to append for a reporting date.

    A days-past-due backstop is only set aside by a rebuttal with a reason: the
    stage is then what the other triggers give. An override replaces the result
    but the automated trigger stays recorded. Of a loan's overrides and rebuttals the one
    in force on the date counts, so each loan gives one row.
    """
    day = F.lit(reporting_date).cast("date")
    overrides, rebuttals = in_force(overrides, "loan_id", reporting_date), in_force(rebuttals, "loan_id", reporting_date)
    before = (
        prior.filter(F.col("reporting_date") < day)
        .groupBy("loan_id")
        .agg(F.max_by("current_stage", "reporting_date").alias("previous_stage"))
    )
    rows = (
        recommended.join(before, "loan_id", "left")
        .join(rebuttals.select("loan_id", "rebuttal_reason", F.lit(True).alias("rebutted")), "loan_id", "left")
        .join(
            overrides.select("loan_id", "override_stage", "override_approved_by", "override_justification"),
            "loan_id",
            "left",
        )
    )
    dpd_fired = _known(F.col("days_past_due") >= DPD_STAGE_2)
    rebutted = dpd_fired & _known(F.col("rebutted"))
    set_aside = rebutted & F.col("rebuttal_reason").isNotNull()
    stage, trigger = _decide()
    softer_stage, softer_trigger = _decide(skip=DPD_TRIGGERS)
    automated = F.when(set_aside, softer_stage).otherwise(stage)
    current = F.coalesce("override_stage", automated)
    return conform(
        rows.withColumns(
            {
                "current_stage": current,
                "stage_transition_type": transition_type(F.col("previous_stage"), current),
                "dpd_backstop_triggered": dpd_fired,
                "sicr_backstop_rebutted": rebutted,
                "rebuttal_reason": F.when(rebutted, F.col("rebuttal_reason")),
                "primary_trigger": F.when(set_aside, softer_trigger).otherwise(trigger),
                "classification_method": F.when(F.col("override_stage").isNotNull(), "MANUAL_OVERRIDE").otherwise(
                    "AUTOMATED_RULE"
                ),
                "credit_policy_version": F.lit(POLICY_VERSION),
                "stage_history_id": name_uuid(F.col("loan_id"), F.col("reporting_date"), F.lit(POLICY_VERSION)),
                "classified_at": F.current_timestamp(),
                "batch_date": day,
            }
        ),
        "ecl.exposure_stage_history",
    )


def override_check(history: DataFrame) -> DataFrame:
    """Rows that break the documentation duty of overrides or rebuttals."""
    override = F.col("classification_method") == "MANUAL_OVERRIDE"
    violations = F.array_compact(
        F.array(
            F.when(override & F.col("override_approved_by").isNull(), F.lit("override_without_approver")),
            F.when(override & F.col("override_justification").isNull(), F.lit("override_without_justification")),
            F.when(
                F.col("sicr_backstop_rebutted") & F.col("rebuttal_reason").isNull(), F.lit("rebuttal_without_reason")
            ),
        )
    )
    return history.withColumn("violations", violations).filter(F.size("violations") > 0)
