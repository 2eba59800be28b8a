import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loanloom.functions import credit
from loanloom.operators import provisions, reconciliation, staging

DAY = dt.date(2001, 6, 30)
AS_OF = "2001-06-30"


@pytest.mark.parametrize(
    "dpd,bucket",
    [(-1, "90+"), (0, "CURRENT"), (1, "1-30"), (30, "1-30"), (31, "31-60"), (60, "31-60"), (61, "61-90"), (90, "61-90"),
     (91, "90+"), (None, "90+")],
)
def test_bucket_boundaries(spark, dpd, bucket):
    df = spark.createDataFrame([(dpd,)], "d INT")
    assert df.select(credit.delinquency_bucket(F.col("d"))).first()[0] == bucket


def test_exact_round_ignores_binary_noise(spark):
    df = spark.createDataFrame([(103095.0, 1.105), (-0.00145, 1.0)], "a DOUBLE, b DOUBLE")
    values = df.select(credit.money(F.col("a") * F.col("b")), credit.exact_round(F.col("a"), 4)).collect()
    assert str(values[0][0]) == "113919.98" and str(values[1][1]) == "-0.0015"


# --- staging ------------------------------------------------------------------


def classify(spark, dpd, signals=None, pds=None):
    perf = spark.createDataFrame(
        [("L", "bnpl", dpd, 1.0, "ACTIVE", DAY)],
        "loan_id STRING, product_type STRING, days_past_due INT, outstanding_amount DOUBLE, status STRING, snapshot_date DATE",
    )
    risk = spark.createDataFrame(
        [("L", *signals)] if signals else [],
        "loan_id STRING, current_rating_notch INT, origination_rating_notch INT, watchlist_flag BOOLEAN, "
        "forbearance_flag BOOLEAN, unlikely_to_pay_flag BOOLEAN",
    )
    first = dt.date(2000, 1, 31)
    rows = [("L", first, "S0", "PD", "12_MONTH", pds[0]), ("L", first, "X0", "PD", "12_MONTH", 9.0),
            ("L", DAY, "S1", "PD", "12_MONTH", pds[1])] if pds else []
    pit = spark.createDataFrame(
        rows, "loan_id STRING, reporting_date DATE, scenario_id STRING, parameter_type STRING, horizon_type STRING, parameter_value DOUBLE"
    )
    scenarios = spark.createDataFrame(
        [("S0", first, "BASELINE"), ("X0", first, "SEVERE"), ("S1", DAY, "BASELINE")],
        "scenario_id STRING, reporting_date DATE, scenario_name STRING",
    )
    row = staging.stage_classification(perf, risk, pit, scenarios, AS_OF).first()
    return row.recommended_stage, row.primary_trigger


CALM = (3, 3, False, False, False)


@pytest.mark.parametrize(
    "dpd,signals,pds,expected",
    [
        (29, CALM, None, (1, "NO_TRIGGER")),
        (30, CALM, None, (2, "DPD_30_BACKSTOP")),
        (89, CALM, None, (2, "DPD_30_BACKSTOP")),
        (90, CALM, None, (3, "DPD_90_BACKSTOP")),
        (None, CALM, None, (1, "NO_TRIGGER")),
        (0, None, None, (1, "NO_TRIGGER")),
        (0, (3, 3, True, True, False), None, (2, "WATCHLIST")),
        (0, (3, 3, False, True, False), None, (2, "FORBEARANCE")),
        (40, (3, 3, True, True, True), None, (3, "UNLIKELY_TO_PAY")),
        (95, (3, 3, True, True, True), None, (3, "DPD_90_BACKSTOP")),
        (0, (2, 3, False, False, False), None, (1, "NO_TRIGGER")),
        (0, (1, 3, False, False, False), None, (2, "RATING_DOWNGRADE_2_NOTCH")),
        (0, CALM, (0.01, 0.0199), (1, "NO_TRIGGER")),
        (0, CALM, (0.01, 0.02), (2, "PD_DETERIORATION")),
        (0, CALM, (0.0, 0.02), (1, "NO_TRIGGER")),
        (0, (None, 3, None, None, None), (0.01, 0.02), (2, "PD_DETERIORATION")),
    ],
)
def test_triggers_and_precedence(spark, dpd, signals, pds, expected):
    assert classify(spark, dpd, signals, pds) == expected


def test_two_baselines_of_a_date_are_an_error(spark):
    scenarios = spark.createDataFrame(
        [("S0", DAY, "BASELINE"), ("S1", DAY, "BASELINE")], "scenario_id STRING, reporting_date DATE, scenario_name STRING"
    )
    with pytest.raises(Exception, match="more than one baseline"):
        staging.baseline_scenarios(scenarios).collect()


def test_transitions(spark):
    stages = [1, 2, 3, 2, 1, 1]
    rows = [(f"H{i}", "L", dt.date(2001, i + 1, 1), s) for i, s in enumerate(stages)]
    history = spark.createDataFrame(rows, "stage_history_id STRING, loan_id STRING, reporting_date DATE, current_stage INT")
    got = [r.stage_transition_type for r in staging.stage_transition(history).orderBy("reporting_date").collect()]
    assert got == ["NEW_ORIGINATION", "STAGE_DOWNGRADE", "STAGE_DOWNGRADE", "STAGE_UPGRADE", "CURE", "NO_CHANGE"]
    assert staging.current_stage(history).first().stage_history_id == "H5"


def history_row(spark, dpd, flag, override=None, rebuttal=None, prior=None, pds=(None, None, None)):
    recommended = spark.createDataFrame(
        [("L", DAY, 3 if dpd >= 90 else 2 if dpd >= 30 else 1, "x", dpd, *pds, 0, flag, False, False)],
        "loan_id STRING, reporting_date DATE, recommended_stage INT, primary_trigger STRING, days_past_due INT, "
        "pd_at_origination DOUBLE, pd_at_reporting_date DOUBLE, pd_deterioration_ratio DOUBLE, rating_notches_downgraded INT, "
        "watchlist_flag BOOLEAN, forbearance_flag BOOLEAN, unlikely_to_pay_flag BOOLEAN",
    )
    before = spark.createDataFrame([("L", dt.date(2001, 5, 31), prior)] if prior else [], "loan_id STRING, reporting_date DATE, current_stage INT")
    overrides = spark.createDataFrame(
        [("L", *override)] if override else [],
        "loan_id STRING, override_stage INT, override_approved_by STRING, override_justification STRING",
    )
    rebuttals = spark.createDataFrame([("L", rebuttal[0])] if rebuttal else [], "loan_id STRING, rebuttal_reason STRING")
    return staging.write_stage_history(recommended, before, overrides, rebuttals, AS_OF)


def test_rebuttal_with_reason_sets_the_backstop_aside(spark):
    row = history_row(spark, 95, True, rebuttal=("late posting",), prior=3).first()
    assert (row.current_stage, row.primary_trigger, row.stage_transition_type) == (2, "WATCHLIST", "STAGE_UPGRADE")
    assert row.dpd_backstop_triggered and row.sicr_backstop_rebutted


def test_the_greatest_ratio_of_two_pds_is_booked(spark):
    row = history_row(spark, 0, False, pds=(0.000001, 99.999999, 99.999999 / 0.000001)).first()
    assert float(row.pd_deterioration_ratio) == pytest.approx(99999999.0, rel=1e-9)


def test_rebuttal_without_reason_changes_nothing_and_is_reported(spark):
    rows = history_row(spark, 95, True, rebuttal=(None,))
    assert rows.first().current_stage == 3
    assert staging.override_check(rows).first().violations == ["rebuttal_without_reason"]


def test_override_keeps_the_automated_trigger(spark):
    rows = history_row(spark, 35, False, override=(1, "cro", None), prior=2)
    row = rows.first()
    assert (row.current_stage, row.primary_trigger, row.classification_method) == (1, "DPD_30_BACKSTOP", "MANUAL_OVERRIDE")
    assert row.stage_transition_type == "CURE"
    assert staging.override_check(rows).first().violations == ["override_without_justification"]


# --- provisions ----------------------------------------------------------------

SCENARIOS = [("S1", DAY, "BASELINE", 0.6), ("S2", DAY, "ADVERSE", 0.3), ("S3", DAY, "SEVERE", 0.1)]
PIT = ("parameter_id STRING, loan_id STRING, reporting_date DATE, scenario_id STRING, parameter_type STRING, "
       "horizon_type STRING, period_number INT, parameter_value DOUBLE")


def inputs(spark, stages, params, terms):
    history = spark.createDataFrame(
        [(f"H{loan}", loan, DAY, stage) for loan, stage in stages.items()],
        "stage_history_id STRING, loan_id STRING, reporting_date DATE, current_stage INT",
    )
    pit = spark.createDataFrame([(f"P{i}", loan, DAY, *rest) for i, (loan, *rest) in enumerate(params)], PIT)
    scenarios = spark.createDataFrame(
        SCENARIOS, "scenario_id STRING, reporting_date DATE, scenario_name STRING, scenario_weight DOUBLE"
    )
    rates = spark.createDataFrame(list(terms.items()) or [], "loan_id STRING, effective_interest_rate DOUBLE")
    return history, pit, scenarios, rates


def for_all(loan, *rows):
    return [(loan, s[0], *row) for s in SCENARIOS for row in rows]


BOOK = (
    for_all("A", ("PD", "12_MONTH", None, 0.02), ("PD", "LIFETIME", 1, 0.5), ("LGD", "12_MONTH", None, 0.4), ("EAD", "12_MONTH", None, 1000.0),
            ("EAD", "LIFETIME", 1, 7.0))
    + for_all("B", ("PD", "12_MONTH", None, 0.9), ("PD", "LIFETIME", 1, 0.1), ("PD", "LIFETIME", 2, 0.2), ("LGD", "12_MONTH", None, 0.5),
              ("EAD", "12_MONTH", None, 100.0), ("EAD", "LIFETIME", 1, 80.0))
    + for_all("C", ("PD", "12_MONTH", None, 0.9), ("LGD", "12_MONTH", None, 0.5), ("EAD", "12_MONTH", None, 200.0))
)
STAGES = {"A": 1, "B": 2, "C": 3}


def test_ecl_of_each_stage(spark):
    frames = inputs(spark, STAGES, BOOK, {"B": 0.1})
    rows = {r.loan_id: r for r in provisions.probability_weighted_ecl(provisions.per_scenario(*frames, AS_OF)).collect()}
    assert rows["A"].probability_weighted_ecl == pytest.approx(0.02 * 0.4 * 1000)
    lifetime = 0.5 * (0.1 * 80 / 1.1 + 0.2 * 100 / 1.1**2)  # period 2 falls back to the point EAD
    assert rows["B"].probability_weighted_ecl == pytest.approx(lifetime)
    assert rows["C"].severe_ecl == pytest.approx(0.5 * 200)
    assert sorted(rows) == ["A", "B", "C"]


def test_period_detail_sums_to_the_scenario_figure(spark):
    history, pit, scenarios, terms = inputs(spark, STAGES, BOOK, {"B": 0.1})
    loans = provisions.loans_in_stage(history, AS_OF, (2,))
    by_period = provisions.parameters_by_period(provisions.staged_parameters(loans, pit, scenarios, AS_OF), terms)
    detail = provisions.period_shortfalls(by_period).groupBy("loan_id", "scenario_id").agg(F.sum("discounted_shortfall").alias("s"))
    both = detail.join(provisions.scenario_ecl(by_period), ["loan_id", "scenario_id"])
    assert both.filter(F.abs(F.col("s") - F.col("scenario_ecl")) > 1e-9).count() == 0 and both.count() == 3


def test_repeated_parameters_do_not_inflate(spark):
    once = inputs(spark, STAGES, BOOK, {"B": 0.1})
    twice = inputs(spark, STAGES, BOOK + BOOK, {"B": 0.1})
    total = lambda f: provisions.per_scenario(*f, AS_OF).agg(F.sum("scenario_ecl"), F.count(F.lit(1))).first()
    assert total(once) == total(twice)


def test_missing_parameter_shows_in_the_coverage(spark):
    holed = [r for r in BOOK if not (r[0] == "C" and r[1] == "S3" and r[2] == "LGD")]
    history, *rest = inputs(spark, {**STAGES, "D": 1}, holed, {})
    figures = provisions.per_scenario(history, *rest, AS_OF)
    rows = {r.loan_id: round(r.covered_weight, 6) for r in provisions.coverage_check(history, figures, AS_OF).collect()}
    assert rows == {"B": 0.0, "C": 0.9, "D": 0.0}  # B has no interest rate, D no parameters


def test_calculation_rows(spark):
    frames = inputs(spark, STAGES, BOOK, {"B": 0.1})
    figures = provisions.per_scenario(*frames, AS_OF, with_ids=True)
    overlays = spark.createDataFrame(
        [("A", 5.0, None, None), ("C", 0.0, None, None)],
        "loan_id STRING, management_overlay_amount DOUBLE, overlay_justification STRING, overlay_approved_by STRING",
    )
    rows = provisions.write_ecl_calculation(figures, overlays, AS_OF)
    assert rows.count() == 12 and rows.select("ecl_calculation_id").distinct().count() == 12
    booked = {r.loan_id: r for r in rows.filter("is_probability_weighted_result").collect()}
    assert float(booked["A"].ecl_present_value) == 8.0 and booked["A"].scenario_id is None
    assert float(booked["A"].management_overlay_amount) == 5.0 and float(booked["B"].management_overlay_amount) == 0.0
    detail = rows.filter("NOT is_probability_weighted_result AND loan_id = 'A'").first()
    assert detail.pd_parameter_id and detail.lgd_parameter_id and detail.ecl_horizon == "12_MONTH"
    assert [r.loan_id for r in provisions.overlay_check(rows).collect()] == ["A"]


def test_random_book_against_brute_force(spark):
    rng = random.Random(11)
    stages = {f"L{i}": rng.choice([1, 2, 3]) for i in range(30)}
    rates = {loan: rng.choice([0.02, 0.07]) for loan in stages if rng.random() < 0.9}
    params = []
    for loan in stages:
        for s, *_ in SCENARIOS:
            kinds = [("PD", "12_MONTH", None), ("LGD", "12_MONTH", None), ("EAD", "12_MONTH", None)]
            kinds += [("PD", "LIFETIME", p) for p in range(1, 6)] + [("EAD", "LIFETIME", p) for p in range(1, 4)]
            params += [(loan, s, *k, round(rng.random() * 100, 3)) for k in kinds if rng.random() < 0.9]
    held = {(r[0], r[1], r[2], r[3], r[4]): r[5] for r in params}
    expected = {}
    for loan, stage in stages.items():
        for s, *_ in SCENARIOS:
            get = lambda *k: held.get((loan, s, *k))
            lgd, ead, pd12 = get("LGD", "12_MONTH", None), get("EAD", "12_MONTH", None), get("PD", "12_MONTH", None)
            if lgd is None or (stage == 2 and loan not in rates):
                continue
            if stage == 2:
                parts = []
                for p in range(1, 6):
                    pd_p, ead_p = get("PD", "LIFETIME", p), get("EAD", "LIFETIME", p)
                    ead_p = ead if ead_p is None else ead_p
                    if pd_p is not None and ead_p is not None:
                        parts.append(pd_p * lgd * ead_p * (1 + rates[loan]) ** -p)
                value = sum(parts) if parts else None
            else:
                value = None if ead is None else lgd * ead if stage == 3 else None if pd12 is None else pd12 * lgd * ead
            if value is not None:
                expected[loan, s] = value
    got = {(r.loan_id, r.scenario_id): r.scenario_ecl for r in provisions.per_scenario(*inputs(spark, stages, params, rates), AS_OF).collect()}
    assert got.keys() == expected.keys()
    assert all(got[k] == pytest.approx(v) for k, v in expected.items())


def test_hot_loan_is_split(spark):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        history, _, scenarios, terms = inputs(spark, {f"L{i}": 1 for i in range(2000)}, BOOK, {})
        loan = F.when(F.col("id") % 3 == 0, "L0").otherwise(F.concat(F.lit("L"), (F.col("id") % 2000).cast("string")))
        pit = spark.range(0, 60000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("parameter_id"), loan.alias("loan_id"), F.lit(DAY).alias("reporting_date"),
            F.lit("S1").alias("scenario_id"), F.element_at(F.array(F.lit("PD"), F.lit("LGD"), F.lit("EAD")), (F.col("id") % 3 + 1).cast("int")).alias("parameter_type"),
            F.lit("12_MONTH").alias("horizon_type"), F.lit(None).cast("int").alias("period_number"), F.lit(2.0).alias("parameter_value"),
        )
        df = provisions.parameters_by_period(provisions.staged_parameters(
            provisions.loans_in_stage(history, AS_OF, (1,)), pit, scenarios, AS_OF), terms, with_ids=True)
        rows = df.count()
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert "skew=true" in plan
        assert rows == 2000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_divergence_flags(spark):
    pit = spark.createDataFrame(
        [(f"P{i}", f"L{i}", DAY, "S1", "PD", "12_MONTH", None, v) for i, v in enumerate([1.5, 1.51, 1.2, 1.21, 0.4, 1.0])], PIT
    )
    ttc = spark.createDataFrame(
        [(f"L{i}", DAY, "PD", "12_MONTH", None, 0.0 if i == 5 else 1.0) for i in range(6)],
        "loan_id STRING, reporting_date DATE, parameter_type STRING, horizon_type STRING, period_number INT, parameter_value DOUBLE",
    )
    scenarios = spark.createDataFrame([("S1", DAY, "BASELINE")], "scenario_id STRING, reporting_date DATE, scenario_name STRING")
    rows = reconciliation.pit_vs_ttc(pit, ttc, scenarios, AS_OF).orderBy("loan_id").collect()
    assert [r.divergence_flag for r in rows] == ["MONITOR", "INVESTIGATE", "WITHIN_TOLERANCE", "MONITOR", "INVESTIGATE", "WITHIN_TOLERANCE"]
    assert rows[5].pct_divergence is None
    assert reconciliation.undefined_divergence(pit, ttc, scenarios, AS_OF).first().undefined_count == 1


# --- validity, gaps, versions -------------------------------------------------


def test_the_row_in_force(spark):
    from loanloom.operators.keys import in_force

    rows = [("A", "2001-01-01", "2001-06-29", "expired"), ("A", "2001-01-01", None, "old"), ("A", "2001-06-30", "2001-06-30", "today"),
            ("A", "2001-07-01", None, "future"), ("B", None, None, "x"), ("B", None, None, "y"), ("C", "2001-01-01", "2001-06-29", "expired")]
    df = spark.createDataFrame(rows, "loan_id STRING, valid_from STRING, valid_to STRING, v STRING").selectExpr(
        "loan_id", "CAST(valid_from AS DATE) AS valid_from", "CAST(valid_to AS DATE) AS valid_to", "v")
    assert {r.loan_id: r.v for r in in_force(df, "loan_id", AS_OF).collect()} == {"A": "today", "B": "y"}
    bare = df.select("loan_id", "v")  # without dates every row holds, and a key still has one
    assert {r.loan_id: r.v for r in in_force(bare, "loan_id", AS_OF).collect()} == {"A": "today", "B": "y", "C": "expired"}
    assert in_force(df.limit(0), "loan_id", AS_OF).count() == 0


def gaps(spark, rows):
    params = spark.createDataFrame(
        [(loan, stage, scenario, scenario, kind, n) for loan, stage, scenario, kind, n in rows],
        "loan_id STRING, current_stage INT, scenario_id STRING, scenario_name STRING, parameter_type STRING, period_number INT")
    return sorted(tuple(r) for r in provisions.period_gaps(params).collect())


def test_period_gaps(spark):
    pd = lambda loan, scenario, *ns: [(loan, 2, scenario, "PD", n) for n in ns]
    ead = lambda loan, scenario, *ns: [(loan, 2, scenario, "EAD", n) for n in ns]
    assert gaps(spark, pd("L", "S", 1, 2, 3) + ead("L", "S", None)) == []
    assert gaps(spark, pd("L", "S", 2, 2, 5) + ead("L", "S", 1, 2, 3, 4, 5, 6)) == [
        ("L", "S", "PD", 1, 1, 1), ("L", "S", "PD", 3, 4, 2), ("L", "S", "PD", 6, 6, 1)]
    assert gaps(spark, pd("L", "S", 1, 2, 3) + ead("L", "S", 2)) == [("L", "S", "EAD", 1, 1, 1), ("L", "S", "EAD", 3, 3, 1)]
    # the loan's last period is that of all its scenarios; other loans and stages play no part
    rows = pd("L", "S", 1, 2) + pd("L", "T", 1, 2, 3) + ead("L", "S", None) + ead("L", "T", None)
    assert gaps(spark, rows + pd("M", "S", 1) + ead("M", "S", None) + [("N", 1, "S", "PD", 3)]) == [("L", "S", "PD", 3, 3, 1)]
    assert gaps(spark, ead("L", "S", None)) == [] and gaps(spark, []) == []


def test_restated_parameters_are_known_from_their_day_on(spark):
    day = lambda x: dt.date.fromisoformat(x)
    rows = [("p1", "PD", 1, 0.1, "v1", "2001-06-30"), ("p2", "PD", 1, 0.05, "v2", "2001-07-31"), ("p3", "PD", 1, 0.2, "v3", "2001-07-31"),
            ("p4", "LGD", None, 0.4, "v1", "2001-06-30"), ("p5", "PD", 2, 0.3, "v1", "2001-08-31")]
    params = spark.createDataFrame(
        [(i, "L", DAY, "S", kind, "LIFETIME", n, x, version, day(at)) for i, kind, n, x, version, at in rows],
        "parameter_id STRING, loan_id STRING, reporting_date DATE, scenario_id STRING, parameter_type STRING, horizon_type STRING, "
        "period_number INT, parameter_value DOUBLE, model_version STRING, batch_date DATE")
    known = lambda at: sorted(r.parameter_id for r in provisions.parameters_known(params, AS_OF, at).collect())
    assert known("2001-06-29") == [] and known("2001-06-30") == ["p1", "p4"] == known("2001-07-30")
    assert known("2001-07-31") == ["p3", "p4"] and known("2001-12-31") == ["p3", "p4", "p5"]
