"""Expected credit loss: per scenario, weighted, recorded and rolled up.

All stages come out of one pass over the parameters. The parameters of the date
meet their loan first (an inner join on ``loan_id`` with one row on the loan
side), which drops the term structures of stage 1 loans and leaves the rows
partitioned by loan: the aggregates per period, per scenario and per loan, and
the join of the loan terms between them, need no further exchange of
parameters. Should one loan hold very many rows, AQE splits it in that join and
the aggregates collapse it before they shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanloom.functions.credit import discount_factor, money
from loanloom.functions.text import name_uuid
from loanloom.operators.keys import in_force
from loanloom.schemas import conform
from loanloom.sizing import small_side

METHOD_VERSION = "v1.0"
SCENARIO_NAMES = ("BASELINE", "ADVERSE", "SEVERE")
WEIGHT_TOLERANCE = 1e-6

_LOAN = ("loan_id", "reporting_date", "current_stage", "stage_history_id")
_TERMS = ("effective_interest_rate",)
_SCENARIO = ("scenario_id", "scenario_name", "scenario_weight")


def _on(df: DataFrame, reporting_date: str) -> DataFrame:
    return df.filter(F.col("reporting_date") == F.lit(reporting_date).cast("date"))


def loans_in_stage(history: DataFrame, reporting_date: str, stages: Sequence[int]) -> DataFrame:
    """Loans of the date that are in one of the stages."""
    return _on(history, reporting_date).filter(F.col("current_stage").isin(*stages)).select(
        "loan_id", "reporting_date", "current_stage", "stage_history_id"
    )


def scenario_weight_check(scenarios: DataFrame) -> DataFrame:
    """Whether the weights of each reporting date sum to one."""
    return (
        scenarios.groupBy("reporting_date")
        .agg(F.sum("scenario_weight").cast("double").alias("total_weight"), F.count(F.lit(1)).alias("scenario_count"))
        .withColumn("weights_valid", F.abs(F.col("total_weight") - 1.0) <= WEIGHT_TOLERANCE)
    )


def reproduce_as_of(params: DataFrame, model_version: str, batch_date: str | None = None) -> DataFrame:
    """The parameters as a given model version delivered them."""
    chosen = params.filter(F.col("model_version") == model_version)
    return chosen if batch_date is None else chosen.filter(F.col("batch_date") == F.lit(batch_date).cast("date"))


def staged_parameters(loans: DataFrame, pit: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """The parameter rows each loan's stage uses, with loan and scenario attributes.

    Stage 1 uses the 12-month PD, stage 2 the PD term structure, stage 3 none;
    point LGD and EAD serve all, an EAD per period only stage 2.
    """
    return _weighted(_of_loans(loans, pit, reporting_date), scenarios, reporting_date)


def _of_loans(loans: DataFrame, pit: DataFrame, reporting_date: str, also: Sequence[str] = ()) -> DataFrame:
    """The parameter rows each loan's stage uses, partitioned by loan; ``also`` names more columns of them."""
    parameters = _on(pit, reporting_date).select(
        "loan_id", "scenario_id", "parameter_id", "parameter_type", "horizon_type", "period_number",
        F.col("parameter_value").cast("double").alias("value"), *also,
    )
    stage, kind = F.col("current_stage"), F.col("parameter_type")
    lifetime_pd = (kind == "PD") & (F.col("horizon_type") == "LIFETIME") & F.col("period_number").isNotNull()
    twelve_month_pd = (kind == "PD") & (F.col("horizon_type") == "12_MONTH")
    point = kind.isin("LGD", "EAD") & F.col("period_number").isNull()
    period_ead = (kind == "EAD") & F.col("period_number").isNotNull()
    used = point | ((stage == 1) & twelve_month_pd) | ((stage == 2) & (lifetime_pd | period_ead))
    # A hash table of loans per partition: no sort of the parameters, and their
    # (much larger) side is never the one that is broadcast or built.
    return (
        parameters.filter(point | twelve_month_pd | lifetime_pd | period_ead)
        .join(loans.hint("shuffle_hash"), "loan_id", "inner")
        .filter(used)
    )


def _weighted(params: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    weights = _on(scenarios, reporting_date).select(
        "scenario_id", "scenario_name", F.col("scenario_weight").cast("double").alias("scenario_weight")
    )
    return params.join(small_side(weights), "scenario_id", "inner")


def _preferred(value: Column, condition: Column) -> Column:
    """A point value in the horizon of the loan's stage, else in the other one."""
    own = F.when(F.col("current_stage") == 1, "12_MONTH").otherwise("LIFETIME")
    own_horizon = F.col("horizon_type") == own
    return F.coalesce(F.max(F.when(condition & own_horizon, value)), F.max(F.when(condition, value)))


def parameters_by_period(params: DataFrame, terms: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per loan, scenario and period: PD, LGD and EAD side by side.

    A conditional aggregate takes the place of one join per parameter type, and
    makes a repeated parameter row harmless. The interest rate joins the
    collapsed rows; a stage 2 loan needs it for discounting.
    """
    is_pd, is_lgd, is_ead = (F.col("parameter_type") == t for t in ("PD", "LGD", "EAD"))
    wanted = [
        F.max(F.when(is_pd, F.col("value"))).alias("pd"),
        _preferred(F.col("value"), is_lgd).alias("lgd"),
        _preferred(F.col("value"), is_ead).alias("ead"),
    ]
    if with_ids:
        stamped = F.struct("value", "parameter_id")
        wanted += [
            F.max(F.when(is_pd, stamped))["parameter_id"].alias("pd_parameter_id"),
            _preferred(stamped, is_lgd)["parameter_id"].alias("lgd_parameter_id"),
            _preferred(stamped, is_ead)["parameter_id"].alias("ead_parameter_id"),
        ]
    collapsed = params.groupBy(*_LOAN, *_SCENARIO, "period_number").agg(*wanted)
    # A hash table of terms per partition: the collapsed rows, which are at their loan already, are not sorted.
    rated = collapsed.join(terms.select("loan_id", *_TERMS).hint("shuffle_hash"), "loan_id", "left")
    return rated.filter((F.col("current_stage") != 2) | F.col("effective_interest_rate").isNotNull())


def scenario_ecl(by_period: DataFrame) -> DataFrame:
    """ECL of every loan under every scenario for which all its parameters exist.

    Stage 2 sums PD x EAD x discount over the periods; a period without its own
    EAD takes the point EAD. LGD and point EAD are constant over the periods, so
    they are multiplied in after the sum and need no join to the periods.
    """
    periodic = F.col("period_number").isNotNull()
    own_ead = periodic & F.col("ead").isNotNull()
    rate, period = F.col("effective_interest_rate"), F.col("period_number")
    pd_value, ead_value = F.col("pd"), F.col("ead")
    factor = discount_factor(rate, period)
    no_period = ~periodic

    ids = [c for c in ("pd_parameter_id", "lgd_parameter_id", "ead_parameter_id") if c in by_period.columns]
    sums = by_period.groupBy(*_LOAN, *_TERMS, *_SCENARIO).agg(
        F.max(F.when(no_period, pd_value)).alias("pd_12m"),
        F.max(F.when(no_period, F.col("lgd"))).alias("lgd_used"),
        F.max(F.when(no_period, ead_value)).alias("ead_used"),
        F.sum(F.when(own_ead, pd_value * ead_value)).alias("own_gross"),
        F.sum(F.when(own_ead, pd_value * ead_value * factor)).alias("own_pv"),
        F.sum(F.when(periodic & ~own_ead, pd_value)).alias("point_gross"),
        F.sum(F.when(periodic & ~own_ead, pd_value * factor)).alias("point_pv"),
        *[F.max(F.when(no_period, F.col(c))).alias(c) for c in ids],
    )
    lgd, ead = F.col("lgd_used"), F.col("ead_used")

    def lifetime(own: str, point: str) -> Column:
        # NULL only if neither kind of period can be computed.
        at_point = F.col(point) * ead
        return lgd * F.coalesce(F.col(own) + at_point, F.col(own), at_point)

    stage = F.col("current_stage")
    flat = F.when(stage == 1, F.col("pd_12m") * lgd * ead).when(stage == 3, lgd * ead)
    return sums.select(
        *_LOAN,
        *_TERMS,
        *_SCENARIO,
        F.when(stage == 1, F.col("pd_12m")).alias("pd_used"),
        "lgd_used",
        "ead_used",
        F.when(stage == 2, lifetime("own_gross", "point_gross")).otherwise(flat).alias("gross_ecl"),
        F.when(stage == 2, lifetime("own_pv", "point_pv")).otherwise(flat).alias("scenario_ecl"),
        *ids,
    ).filter(F.col("scenario_ecl").isNotNull())


def per_scenario(
    history: DataFrame,
    pit: DataFrame,
    scenarios: DataFrame,
    terms: DataFrame,
    reporting_date: str,
    stages: Sequence[int] = (1, 2, 3),
    with_ids: bool = False,
) -> DataFrame:
    """Scenario ECL of the date's loans in the given stages.

    The ids it names are those of point parameters; a period's id is not shuffled and sorted.
    """
    loans = loans_in_stage(history, reporting_date, stages)
    if with_ids:
        pit = pit.withColumn("parameter_id", F.when(F.col("period_number").isNull(), F.col("parameter_id")))
    params = staged_parameters(loans, pit, scenarios, reporting_date)
    return scenario_ecl(parameters_by_period(params, terms, with_ids))


#: What tells one parameter of a reporting date from another, whichever version it is.
PARAMETER = ("reporting_date", "loan_id", "scenario_id", "parameter_type", "horizon_type", "period_number")


def parameters_known(
    params: DataFrame, reporting_date: str, known_at: str, per: Sequence[str] = PARAMETER
) -> DataFrame:
    """A reporting date's parameters as they were known on a day.

    A parameter has two times: the date it is about (``reporting_date``) and the day it was
    delivered (``batch_date``). Of the versions delivered until ``known_at`` the last one counts;
    those of one day go by model version, then id. ``per`` are the columns that tell one
    parameter from another.
    """
    rows = _on(params, reporting_date)
    rest = [c for c in rows.columns if c not in per]
    # Later versions are passed over in the pick, not filtered before it: the figures of several days
    # then come out of one and the same shuffle of the versions.
    until = F.col("batch_date") <= F.lit(known_at).cast("date")
    order = F.when(until, F.struct("batch_date", "model_version", "parameter_id"))
    last = rows.groupBy(*per).agg(F.max_by(F.struct(*rest), order).alias("__last")).filter("__last IS NOT NULL")
    return last.select(*per, "__last.*").select(*rows.columns)


def reproduce_ecl(
    history: DataFrame, params: DataFrame, scenarios: DataFrame, terms: DataFrame, reporting_date: str, known_at: str
) -> DataFrame:
    """The scenario ECL of a reporting date, computed again from what was known on a day.

    The versions meet their loan before the last one is picked: what the loan's stage does not
    use is never sorted, and the pick finds the rows partitioned by loan, so the versions are
    shuffled once and as narrow as the ECL needs them.
    """
    loans = loans_in_stage(history, reporting_date, (1, 2, 3))
    versions = _of_loans(loans, params, reporting_date, ("batch_date", "model_version"))
    known = parameters_known(versions, reporting_date, known_at, (*_LOAN, *(c for c in PARAMETER if c not in _LOAN)))
    return scenario_ecl(parameters_by_period(_weighted(known, scenarios, reporting_date), terms))


def scenario_pivot(value: str = "scenario_ecl") -> list[Column]:
    """One aggregate column per conventional scenario."""
    return [
        F.max(F.when(F.col("scenario_name") == name, F.col(value))).alias(f"{name.lower()}_ecl")
        for name in SCENARIO_NAMES
    ]


def probability_weighted_ecl(scenarios: DataFrame) -> DataFrame:
    """Weighted ECL per loan with the per-scenario figures beside it."""
    return scenarios.groupBy("loan_id", "reporting_date", F.col("current_stage").alias("stage")).agg(
        F.sum(F.col("scenario_ecl") * F.col("scenario_weight")).alias("probability_weighted_ecl"), *scenario_pivot()
    )


def stage1_ecl(
    history: DataFrame, pit: DataFrame, scenarios: DataFrame, terms: DataFrame, reporting_date: str
) -> DataFrame:
    return probability_weighted_ecl(per_scenario(history, pit, scenarios, terms, reporting_date, (1,)))


def stage23_ecl(
    history: DataFrame, pit: DataFrame, scenarios: DataFrame, terms: DataFrame, reporting_date: str
) -> DataFrame:
    return probability_weighted_ecl(per_scenario(history, pit, scenarios, terms, reporting_date, (2, 3)))


def stage2_lifetime_ecl(
    history: DataFrame, pit: DataFrame, scenarios: DataFrame, terms: DataFrame, reporting_date: str
) -> DataFrame:
    """Discounted lifetime shortfall of stage 2 loans per scenario."""
    return per_scenario(history, pit, scenarios, terms, reporting_date, (2,)).select(
        "loan_id", "reporting_date", *_SCENARIO, "scenario_ecl"
    )


def combine_stage_2_3(stage_2: DataFrame, stage_3: DataFrame) -> DataFrame:
    return stage_2.unionByName(stage_3)


def period_shortfalls(by_period: DataFrame) -> DataFrame:
    """Per-period breakdown of stage 2: PD, LGD, EAD, shortfall and its present value.

    The window spreads the two point values over the periods of one loan and
    scenario; the rows are at one per period already, so it stays short.
    """
    same = Window.partitionBy("loan_id", "scenario_id")
    no_period = F.col("period_number").isNull()
    spread = by_period.filter(F.col("current_stage") == 2).withColumns(
        {
            "lgd_used": F.max(F.when(no_period, F.col("lgd"))).over(same),
            "point_ead": F.max(F.when(no_period, F.col("ead"))).over(same),
        }
    )
    ead = F.coalesce("ead", "point_ead")
    shortfall = F.col("marginal_pd") * F.col("lgd_used") * F.col("ead_this_period")
    return (
        spread.filter(F.col("period_number").isNotNull())
        .select(
            *_LOAN, *_TERMS, *_SCENARIO, "period_number", F.col("pd").alias("marginal_pd"), "lgd_used",
            ead.alias("ead_this_period"),
            discount_factor(F.col("effective_interest_rate"), F.col("period_number")).alias("discount_factor"),
        )
        .withColumn("undiscounted_shortfall", shortfall)
        .filter(F.col("undiscounted_shortfall").isNotNull())
        .withColumn("discounted_shortfall", F.col("undiscounted_shortfall") * F.col("discount_factor"))
    )


def _calculation_id(scenario: Column) -> Column:
    return name_uuid(
        F.col("loan_id"), F.col("reporting_date"), F.coalesce(scenario, F.lit("WEIGHTED")), F.lit(METHOD_VERSION)
    )


def write_lifetime_detail(shortfalls: DataFrame, reporting_date: str) -> DataFrame:
    """Period rows to append, tied to their calculation row."""
    calculation = _calculation_id(F.col("scenario_id"))
    return conform(
        shortfalls.withColumns(
            {
                "ecl_calculation_id": calculation,
                "period_detail_id": name_uuid(calculation, F.col("period_number")),
                "marginal_pd_this_period": F.col("marginal_pd"),
                "lgd_this_period": F.col("lgd_used"),
                "undiscounted_shortfall": money(F.col("undiscounted_shortfall")),
                "discounted_shortfall": money(F.col("discounted_shortfall")),
                "batch_date": F.lit(reporting_date).cast("date"),
            }
        ),
        "ecl.ecl_lifetime_period_detail",
    )


def write_ecl_calculation(scenarios: DataFrame, overlays: DataFrame, reporting_date: str) -> DataFrame:
    """Calculation rows to append: one per scenario and one weighted row per loan.

    The weighted sums come from a window over a loan's scenarios (one row each,
    so it is as short as the scenario set); the loan's first row then also emits
    the booked row. The scenario figures are computed once and nothing but them
    is sorted. The overlay stays a column of its own, on the booked row; of a loan's
    overlays the one in force on the date counts.
    """
    overlays = in_force(overlays, "loan_id", reporting_date)
    ids = ("pd_parameter_id", "lgd_parameter_id", "ead_parameter_id")
    of_loan = Window.partitionBy(*_LOAN)
    is_first = F.row_number().over(of_loan.orderBy("scenario_id")) == 1
    summed = scenarios.withColumns(
        {
            "weighted_gross": F.sum(F.col("gross_ecl") * F.col("scenario_weight")).over(of_loan),
            "weighted_ecl": F.sum(F.col("scenario_ecl") * F.col("scenario_weight")).over(of_loan),
            "emits": F.when(is_first, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False))),
        }
    ).withColumn("is_weighted", F.explode("emits"))
    weighted = F.col("is_weighted")

    def of_scenario(name: str) -> Column:
        return F.when(~weighted, F.col(name)).alias(name)

    rows = summed.select(
        *_LOAN,
        *_TERMS,
        "is_weighted",
        money(F.when(weighted, F.col("weighted_gross")).otherwise(F.col("gross_ecl"))).alias("gross_ecl_undiscounted"),
        money(F.when(weighted, F.col("weighted_ecl")).otherwise(F.col("scenario_ecl"))).alias("ecl_present_value"),
        *[of_scenario(c) for c in ("scenario_id", "pd_used", "lgd_used", "ead_used", *ids)],
    )
    overlay_columns = ("management_overlay_amount", "overlay_justification", "overlay_approved_by")
    booked = overlays.select("loan_id", F.lit(True).alias("is_weighted"), *overlay_columns)
    return conform(
        rows.join(booked, ["loan_id", "is_weighted"], "left").withColumns(
            {
                "ecl_calculation_id": _calculation_id(F.col("scenario_id")),
                "is_probability_weighted_result": F.col("is_weighted"),
                "ecl_horizon": F.when(F.col("current_stage") == 1, "12_MONTH").otherwise("LIFETIME"),
                "management_overlay_amount": F.coalesce("management_overlay_amount", F.lit(0)),
                "calculation_method_version": F.lit(METHOD_VERSION),
                "calculated_at": F.current_timestamp(),
                "batch_date": F.lit(reporting_date).cast("date"),
            }
        ),
        "ecl.ecl_calculation",
    )


def overlay_check(calculation: DataFrame) -> DataFrame:
    """Rows whose overlay lacks its justification."""
    return calculation.filter((F.col("management_overlay_amount") != 0) & F.col("overlay_justification").isNull())


def coverage_check(history: DataFrame, scenarios: DataFrame, reporting_date: str) -> DataFrame:
    """Loans of the date whose computed scenarios do not carry the full weight.

    A scenario that lacks a parameter yields no ECL, which would silently lower
    the weighted sum; a loan without any ECL shows with weight 0.
    """
    loans = loans_in_stage(history, reporting_date, (1, 2, 3))
    covered = scenarios.groupBy("loan_id").agg(F.sum("scenario_weight").alias("covered_weight"))
    return (
        loans.join(covered, "loan_id", "left")
        .withColumn("covered_weight", F.coalesce("covered_weight", F.lit(0.0)))
        .filter(F.abs(F.col("covered_weight") - 1.0) > WEIGHT_TOLERANCE)
    )


def period_gaps(params: DataFrame) -> DataFrame:
    """Runs of periods for which a stage 2 loan has no PD, or no EAD, in a scenario.

    ``params`` comes from `staged_parameters`. A loan's periods go from 1 to the last that any
    of its parameters names; a point EAD serves every period. Such a period adds nothing to the
    lifetime loss, and the loan's scenarios still carry their full weight. One row per run:
    its first and last period and their number. A loan with no period at all has no row here
    (it has no loss, which `coverage_check` reports).
    """
    period, kind = F.col("period_number"), F.col("parameter_type")
    keys = ["loan_id", "scenario_id", "scenario_name"]
    used = params.filter((F.col("current_stage") == 2) & kind.isin("PD", "EAD"))
    # A set of periods is as long as the term, however often a parameter is repeated.
    found = used.groupBy(*keys).agg(
        F.collect_set(F.when(kind == "PD", period)).alias("PD"),
        F.collect_set(F.when(kind == "EAD", period)).alias("EAD"),
        F.max((kind == "EAD") & period.isNull()).alias("point"),
    )
    last = used.groupBy(F.col("loan_id").alias("__loan")).agg(F.max(period).alias("last")).filter("last IS NOT NULL")
    both = F.array(
        F.struct(F.lit("PD").alias("parameter_type"), F.col("PD").alias("held")),
        F.struct(F.lit("EAD").alias("parameter_type"), F.when(~F.col("point"), F.col("EAD")).alias("held")),
    )
    each = (
        found.join(last, F.col("loan_id") == F.col("__loan"))
        .select(*keys, "last", F.explode(both).alias("k"))
        .select(*keys, "k.parameter_type", F.concat(F.array(F.lit(0)), F.array_sort("k.held"), F.array(F.col("last") + 1)).alias("at"))
    )
    before = F.slice("at", F.lit(1), F.size("at") - 1)
    after = F.slice("at", F.lit(2), F.size("at") - 1)
    steps = F.zip_with(before, after, lambda a, b: F.struct((a + 1).alias("first_period"), (b - 1).alias("last_period")))
    runs = each.select(*keys, "parameter_type", F.explode(F.filter(steps, lambda s: s["first_period"] <= s["last_period"])).alias("g"))
    return runs.select(
        "loan_id", "scenario_name", "parameter_type", "g.first_period", "g.last_period",
        (F.col("g.last_period") - F.col("g.first_period") + 1).alias("missing_periods"),
    )


def ecl_portfolio_rollup(
    calculation: DataFrame, history: DataFrame, perf: DataFrame, reporting_date: str
) -> DataFrame:
    """Booked provision per product and stage."""
    booked = _on(calculation, reporting_date).filter(F.col("is_probability_weighted_result")).select(
        "loan_id", "reporting_date", "stage_history_id", "ecl_present_value"
    )
    stages = _on(history, reporting_date).select("stage_history_id", "current_stage")
    products = perf.filter(F.col("snapshot_date") == F.lit(reporting_date).cast("date")).select(
        "loan_id", F.col("snapshot_date").alias("reporting_date"), "product_type"
    )
    return (
        booked.join(stages, "stage_history_id", "inner")
        .join(products, ["loan_id", "reporting_date"], "inner")
        .groupBy("product_type", "current_stage")
        .agg(
            F.count_distinct("loan_id").alias("loan_count"),
            F.sum("ecl_present_value").alias("total_ecl_provision"),
            F.avg("ecl_present_value").alias("avg_ecl_per_loan"),
        )
    )
