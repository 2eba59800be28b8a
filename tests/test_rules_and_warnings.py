import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import rules, scorecard, warnings
from loanloom.schemas import schema_of

AS_OF = "2001-06-30"
DAY = dt.date(2001, 6, 30)

GOOD = dict(
    application_id="A1", internal_uuid="U1", application_date=DAY, aecb_score=700, aecb_band="GOOD",
    total_outstanding=None, aecb_identity_status="MATCH", fraud_score=1, risk_band="LOW", fraud_identity_status="MATCH",
    aml_status="CLEAR", pep_flag=False, match_score=None, aml_match_decision="AUTO_MATCH",
    emirates_id="784-1990-1234567-8", dob=DAY, aecb_report_date=dt.datetime(2001, 5, 31, 23, 59), pending_sources=[],
    batch_date=DAY,
)


def frame(spark, *changes):
    schema = schema_of("silver.lending_application_request")
    rows = [{**GOOD, "application_id": f"A{i}", **c} for i, c in enumerate(changes)]
    return spark.createDataFrame([tuple(r[f] for f in schema.fieldNames()) for r in rows], schema)


def test_good_record_passes(spark):
    row = rules.evaluate_must_pass(frame(spark, {}), AS_OF).first()
    assert row.dq_status == "PASS" and row.duplicate_count_application_id == 1


@pytest.mark.parametrize(
    "change,rule",
    [
        ({"internal_uuid": None}, "uuid_present"),
        ({"internal_uuid": ""}, "uuid_present"),
        ({"emirates_id": None}, "emirates_id_format"),
        ({"emirates_id": "784-199-1234567-8"}, "emirates_id_format"),
        ({"dob": None}, "dob_present"),
        ({"aecb_report_date": None}, "aecb_freshness"),
        ({"aecb_report_date": dt.datetime(2001, 5, 30, 23, 59)}, "aecb_freshness"),
        ({"aml_match_decision": None}, "aml_resolved"),
        ({"aml_match_decision": "NO_MATCH"}, "aml_resolved"),
        ({"aecb_identity_status": None}, "identity_validated"),
        ({"fraud_identity_status": "MISMATCH"}, "identity_validated"),
    ],
)
def test_each_bad_input_blocks_by_its_rule_alone(spark, change, rule):
    row = rules.evaluate_must_pass(frame(spark, change), AS_OF).first().asDict()
    failed = [r for r in rules.BLOCKING if not row[f"passes_{r}"]]
    assert failed == [rule] and row["dq_status"] == "BLOCKED"


def test_duplicates_block_all_copies_and_missing_ids_are_one_group(spark):
    df = frame(spark, {"application_id": "X"}, {"application_id": "X"}, {"application_id": "Y"},
               {"application_id": None}, {"application_id": None})
    counts = rules.evaluate_must_pass(df, AS_OF).select("application_id", rules.DUPLICATE_COUNT).collect()
    assert sorted(counts, key=str) == sorted([("X", 2), ("X", 2), ("Y", 1), (None, 2), (None, 2)], key=str)


def test_passed_and_blocked_split_the_input(spark):
    df = frame(spark, {}, {"dob": None}, {"application_id": "Z"}, {"application_id": "Z"})
    assert rules.passed_records(df, AS_OF).count() == 1
    assert rules.blocked_records(df, AS_OF).count() == 3
    assert rules.blocked_count(rules.evaluate_must_pass(df, AS_OF)).first() == (4, 3)


def test_sql_gate_drops_unknown_decisions(spark):
    df = frame(spark, {}, {"aml_match_decision": None}, {"pending_sources": ["aml"]}, {"batch_date": dt.date(2001, 6, 29)})
    assert rules.gold_sql_gate(df, AS_OF).count() == 1


def test_scorecard_rows(spark):
    evaluated = rules.evaluate_must_pass(frame(spark, {}, {"dob": None}, {"dob": None}), AS_OF)
    rows = {r.rule_name: r for r in scorecard.must_pass_rows(evaluated, F.lit("internal")).collect()}
    assert len(rows) == 7
    assert (float(rows["dob_present"].pass_rate), rows["dob_present"].records_failed, rows["dob_present"].score) == (0.3333, 2, 33)


def test_completeness_demo(spark):
    df = spark.createDataFrame(
        [("A1", 700, 10), ("A2", None, 20), ("A3", 650, 15), ("A4", 710, None)], "id STRING, aecb_score INT, fraud_score INT"
    )
    row = warnings.warn_source_completeness(df, ["aecb_score", "fraud_score"]).first()
    assert (row.metric_value, row.severity) == (0.75, "PAGE")
    empty = warnings.warn_source_completeness(df.limit(0), ["aecb_score"]).first()
    assert (empty.metric_value, empty.severity) == (None, "OK")


def test_duplicate_demo(spark):
    df = spark.createDataFrame([("A1",), ("A1",), ("A2",), ("A3",)], "application_id STRING")
    row = warnings.warn_duplicate_rate(df).first()
    assert (row.metric_value, row.severity) == (0.5, "PAGE")


@pytest.mark.parametrize("lag,severity", [(1.99, "OK"), (2.0, "WARN"), (3.99, "WARN"), (4.0, "PAGE")])
def test_arrival_lag_bounds_are_inclusive(spark, lag, severity):
    start = dt.datetime(2001, 6, 30)
    df = spark.createDataFrame([(start, start + dt.timedelta(hours=lag)), (start, start)], "s TIMESTAMP, r TIMESTAMP")
    assert warnings.warn_bureau_arrival_lag(df, "s", "r").first().severity == severity


def test_queue_age(spark):
    queue = spark.createDataFrame([(dt.datetime(2001, 6, 30, 1),), (dt.datetime(2001, 6, 30, 5),)], "queued_at TIMESTAMP")
    row = warnings.warn_manual_review_queue_age(queue, "2001-06-30 06:00:00").first()
    assert (row.metric_value, row.severity) == (5.0, "WARN")
    assert warnings.warn_manual_review_queue_age(queue.limit(0), "2001-06-30 06:00:00").first().metric_value == 0.0


def brute_psi(baseline, current, bins=10):
    edges = np.unique(np.round(np.quantile(np.array(baseline, float), np.linspace(0, 1, bins + 1)), 9))
    if len(edges) < 2:
        return 0.0
    inner = edges[1:-1]
    count = lambda xs: np.bincount(np.searchsorted(inner, xs, side="left"), minlength=len(inner) + 1) / max(len(xs), 1)
    e, a = (np.maximum(count(x), 1e-6) for x in (np.array(baseline, float), np.array(current, float)))
    return float(((a - e) * np.log(a / e)).sum())


CASES = {
    "same": (list(range(100)), list(range(100))),
    "shifted": (list(range(100)), list(range(30, 130))),
    "tied minimum": ([0] * 50 + list(range(50)), list(range(100))),
    "constant baseline": ([5] * 10, [1, 5, 9]),
    "two values": ([1] * 5 + [2] * 5, [1, 2, 2, 2, 3]),
    "empty bins": ([0, 100], [50, 50, 51]),
}


@pytest.mark.parametrize("few", [1 << 18, 0])
@pytest.mark.parametrize("name", CASES)
def test_psi_against_brute_force(spark, name, few, monkeypatch):
    monkeypatch.setattr(warnings, "FEW_VALUES", few)  # by one array, and by ranges
    baseline, current = CASES[name]
    rows = [(x, True) for x in baseline] + [(x, False) for x in current] + [(None, True), (None, False)]
    df = spark.createDataFrame(rows, "fraud_score INT, is_baseline BOOLEAN")
    value = warnings.warn_fraud_score_drift_psi(df).first().metric_value
    assert value == pytest.approx(round(brute_psi(baseline, current), 4), abs=1e-4)
    assert math.isfinite(value)
    if name == "same":
        assert value == 0.0


def test_psi_of_fractional_scores_needs_a_sketch(spark):
    rng = np.random.default_rng(5)
    base, cur = rng.normal(size=4000), rng.normal(0.4, size=4000)
    pdf = pd.DataFrame({"fraud_score": np.concatenate([base, cur]), "is_baseline": [True] * 4000 + [False] * 4000})
    df = spark.createDataFrame(pdf)
    with pytest.raises(ValueError):
        warnings.warn_fraud_score_drift_psi(df)
    row = warnings.warn_fraud_score_drift_psi(df, approximate=10000).first()
    assert row.metric_value == pytest.approx(brute_psi(base, cur), abs=0.01)


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
def test_quantiles_by_ranges(spark, n):
    from loanloom.operators.quantiles import by_ranges, exact_quantiles

    rng = np.random.default_rng(n)
    values = rng.integers(-(1 << 50), 1 << 50, n) if n > 7 else np.arange(n) * 10
    weight = rng.integers(0, 4, n) if n > 7 else np.ones(n, int)
    rows = spark.createDataFrame([(int(v), int(w)) for v, w in zip(values, weight, strict=True)], "v BIGINT, w BIGINT")
    found = exact_quantiles(by_ranges(rows, "v"), "v", "w", [0, 0.1, 0.25, 0.5, 0.9, 1])
    every = np.repeat(values, weight)
    want = np.quantile(every.astype(float), [0, 0.1, 0.25, 0.5, 0.9, 1]) if every.size else None
    assert found is None if want is None else found == pytest.approx(want, rel=1e-12, abs=1e-9)


def test_no_task_takes_all_values(spark):
    """Many values: the only window is within a range, and nothing is gathered into an array."""
    from loanloom.operators.quantiles import by_ranges

    wide = spark.range(50_000).selectExpr("id * 1000003 AS fraud_score", "id % 2 = 0 AS is_baseline")
    plan = warnings.warn_fraud_score_drift_psi(wide)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "percentile" not in plan
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so small a table would be one range
    sizes = by_ranges(wide, "fraud_score").groupBy("__part").count().collect()
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 50_000 * 0.6
