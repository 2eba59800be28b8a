"""Metrics by source, the alert lifecycle, the owner index, and the decision run."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loanloom.operators import alerts, gold, identity, warnings
from loanloom.plans import gold_run
from loanloom.schemas import conform, schema_of
from loanloom.sources.layers import read_layer, read_table, table_path, write_partitioned

METRICS = "source_system STRING, rule_name STRING, batch_date DATE, metric_value DOUBLE, severity STRING"
START = dt.date(2001, 6, 1)


def day(n):
    return START + dt.timedelta(days=n)


def states(rows):
    return {(r.source_system, r.rule_name): (r.alert_state, r.opened_on, r.worst_severity, r.runs_open) for r in rows}


def test_batch_metrics_equal_the_two_single_metrics(spark):
    rng = random.Random(3)
    rows = [(rng.choice([None, "A", "B", *map(str, range(60))]), rng.choice([None, 1, 2]), rng.choice(["x", None])) for _ in range(200)]
    df = spark.createDataFrame(rows, "application_id STRING, a INT, b STRING")
    both = {r.rule_name: r for r in alerts.batch_metrics(df, "aml", ("a", "b")).collect()}
    for single in (warnings.warn_source_completeness(df, ("a", "b")), warnings.warn_duplicate_rate(df)):
        row = single.first()
        found = both[row.rule_name]
        assert found.source_system == "aml"
        assert (found.metric_value, found.severity, found.warn_threshold) == (row.metric_value, row.severity, row.warn_threshold)


def test_batch_metrics_of_nothing(spark):
    none = spark.createDataFrame([], "application_id STRING, a INT")
    rows = alerts.batch_metrics(none, "aml", ("a",)).collect()
    assert [(r.rule_name, r.metric_value, r.severity) for r in rows] == [("source_completeness", None, "OK"), ("duplicate_rate", None, "OK")]


def test_an_alert_opens_repeats_and_is_resolved(spark):
    held, seen = spark.createDataFrame([], schema_of("gold.dq_alert")), []
    course = [("WARN", 1.0), ("PAGE", 2.0), ("OK", None), ("WARN", 1.0), ("OK", 0.0), ("OK", 0.0)]
    for n, (severity, value) in enumerate(course):
        today = spark.createDataFrame([("aml", "r", day(n), value, severity)], METRICS)
        rows = alerts.advance_alerts(held, today, str(day(n))).collect()
        held = spark.createDataFrame(rows, schema_of("gold.dq_alert"))
        seen.append(states(rows).get(("aml", "r")))
    assert seen == [
        ("OPENED", day(0), "WARN", 1), ("REPEATED", day(0), "PAGE", 2), ("UNMEASURED", day(0), "PAGE", 2),
        ("REPEATED", day(0), "PAGE", 3), ("RESOLVED", day(0), "PAGE", 3), None,
    ]


def test_day_by_day_equals_all_days(spark):
    rng, rows = random.Random(5), []
    for n in range(12):
        for source in ("aecb", "aml", None):
            if rng.random() < 0.85:
                severity = rng.choice(["OK", "WARN", "PAGE"])
                rows.append((source, "r", day(n), rng.choice([1.0, 1.0, 1.0, None]), severity))
    metrics = spark.createDataFrame(rows, METRICS)
    held, ended, going = spark.createDataFrame([], schema_of("gold.dq_alert")), [], {}
    for n in range(12):
        today = alerts.advance_alerts(held, metrics.filter(F.col("batch_date") == F.lit(day(n))), str(day(n))).collect()
        held = spark.createDataFrame(today, schema_of("gold.dq_alert"))
        for r in today:
            if r.alert_state == "RESOLVED":
                ended.append((r.source_system, r.opened_on, day(n), r.runs_open, r.worst_severity))
        going = {(r.source_system, r.opened_on, None, r.runs_open, r.worst_severity) for r in today if r.alert_state != "RESOLVED"}
    whole = [(r.source_system, r.opened_on, r.resolved_on, r.runs_open, r.worst_severity) for r in alerts.alert_episodes(metrics).collect()]
    assert sorted(whole, key=str) == sorted([*ended, *going], key=str) and len(whole) > 4


def test_every_owner_of_a_shared_value_is_found(spark):
    profile = spark.createDataFrame(
        [("U1", "050", "a@x"), ("U2", "051", "A@x "), ("U3", "052", "a@x"), ("U4", "053", "d@x"), ("U4", "053", "d@x"), (None, "053", None)],
        "internal_uuid STRING, phone STRING, email STRING")
    fraud = spark.createDataFrame([("A1", "U1", "050", "a@x"), ("A4", "U4", "053", "d@x"), ("A5", None, "050", None)],
                                  "application_id STRING, internal_uuid STRING, phone STRING, email STRING")
    index = identity.owner_index(profile)
    hits = identity.cross_uuid_collision(fraud, profile, index)
    assert [(r.application_id, r.matched_on, r.other_internal_uuid, r.other_owner_count) for r in hits.collect()] == [("A1", "email", "U3", 2)]
    assert hits.collect() == identity.cross_uuid_collision(fraud, profile).collect()
    owners = identity.collision_owners(hits, index).collect()
    assert sorted((r.matched_on, r.matched_value, r.owner_uuid) for r in owners) == [("email", "a@x", u) for u in ("U1", "U2", "U3")]


def test_the_seal_tells_apart_what_a_pipe_does_not(spark):
    request = spark.createDataFrame([("A1", "x|y", None), ("A2", "x", "y"), ("A3", "", ""), ("A4", None, "")],
                                    "application_id STRING, aml_status STRING, risk_band STRING")
    response = spark.createDataFrame([(f"A{i}", "APPROVED") for i in range(1, 5)], "application_id STRING, decision_outcome STRING")
    same = request.withColumn("application_id", F.lit("A"))
    hashes = gold.decision_snapshot(same.limit(0).unionByName(same), response.limit(1).withColumn("application_id", F.lit("A"))).select("row_hash")
    assert hashes.distinct().count() == 4


VERDICT = "application_id STRING, decision_outcome STRING, decided_at TIMESTAMP"


def verdicts(spark, *rows):
    return spark.createDataFrame([(a, o, dt.datetime(2001, 6, 30, h)) for a, o, h in rows], VERDICT)


@pytest.fixture
def lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = spark.createDataFrame(
        [(a, s, dt.date.fromisoformat(d)) for a, s, d in (("A1", 1, "2001-06-29"), ("A1", 2, "2001-06-30"), ("A1", 3, "2001-07-02"), ("A2", 5, "2001-06-30"))],
        "application_id STRING, aecb_score INT, batch_date DATE")
    write_partitioned(conform(rows, "gold.lending_application_request"), root, "gold.lending_application_request")
    return root


@pytest.mark.parametrize("served", [False, True])
def test_a_verdict_counts_once_and_is_frozen_with_its_inputs(spark, lake, served):
    if served:
        for d in ("2001-06-29", "2001-06-30", "2001-07-02"):
            gold_run.refresh_serving(spark, lake, d)
    table = "gold.lending_application_response"
    first = verdicts(spark, ("A1", "APPROVED", 8), ("A1", "DECLINED", 9), ("A2", "REFER", 8))
    for _ in range(2):  # a rerun of the day gives the same
        gold_run.run_responses(spark, lake, "2001-06-30", first)
    gold_run.run_responses(spark, lake, "2001-07-01", verdicts(spark, ("A1", "DECLINED", 10), ("A3", "APPROVED", 10)))
    rows = sorted((r.application_id, r.decision_outcome, str(r.batch_date)) for r in read_table(spark, lake, table).collect())
    assert rows == [("A1", "APPROVED", "2001-06-30"), ("A2", "REFER", "2001-06-30"), ("A3", "APPROVED", "2001-07-01")]
    frozen = read_layer(spark, lake, "gold.decision_snapshot", "2001-06-30").collect()
    # A1 was assembled again on a later day: what it was decided on stays.
    assert sorted((r.application_id, r.aecb_score, r.decision_outcome) for r in frozen) == [("A1", 2, "APPROVED"), ("A2", 5, "REFER")]
    assert all(len(r.row_hash) == 64 for r in frozen)
    # A rerun without A2 opens it again for a later day.
    gold_run.run_responses(spark, lake, "2001-06-30", verdicts(spark, ("A1", "APPROVED", 8)))
    gold_run.run_responses(spark, lake, "2001-07-02", verdicts(spark, ("A2", "DECLINED", 11)))
    rows = {r.application_id: r.decision_outcome for r in read_table(spark, lake, table).collect()}
    assert rows == {"A1": "APPROVED", "A2": "DECLINED", "A3": "APPROVED"}


def test_verdicts_from_before_the_index_count(spark, lake):
    table = "gold.lending_application_response"
    old = verdicts(spark, ("A1", "APPROVED", 8)).withColumn("batch_date", F.lit("2001-06-20").cast("date"))
    write_partitioned(conform(old, table), lake, table)
    gold_run.run_responses(spark, lake, "2001-06-30", verdicts(spark, ("A1", "DECLINED", 9)))
    assert [r.decision_outcome for r in read_table(spark, lake, table).collect()] == ["APPROVED"]


def test_alert_partitions_follow_reruns(spark, tmp_path):
    root = str(tmp_path / "lake")
    bad = spark.createDataFrame([("aml", "r", day(0), 2.0, "PAGE")], METRICS)
    fine = spark.createDataFrame([("aml", "r", day(0), 0.0, "OK")], METRICS)
    for n, metrics in enumerate((bad, bad, fine, fine, bad)):
        for _ in range(2):
            gold_run.refresh_alerts(spark, root, metrics, str(day(n)))
    rows = read_table(spark, root, "gold.dq_alert").orderBy("batch_date").collect()
    assert [(r.alert_state, r.opened_on) for r in rows] == [("OPENED", day(0)), ("REPEATED", day(0)), ("RESOLVED", day(0)), ("OPENED", day(4))]
    assert table_path(root, "gold.dq_alert").startswith(root)
