"""The daily and the reporting-date run, end to end on small written tables."""

import datetime as dt
import json

from pyspark.sql import functions as F

from loanloom.plans import ecl_run, gold_run, silver_run
from loanloom.schemas import conform
from loanloom.sources.landing import bronze_envelope
from loanloom.streaming.serving import serving_latest
from loanloom.sources.layers import read_layer, read_table, table_path, write_partitioned
from loanloom.sources.sample_views import AS_OF, view

DAY = dt.datetime(2001, 6, 30, 6)
PEOPLE = {
    "U1": ("784-1990-0000001-1", "Ahmed Al Mansoori", "1990-03-15", "a@x.ae", "0501111111"),
    "U2": ("784-1991-0000002-2", "Sara Haddad", "1991-04-16", "s@x.ae", "0502222222"),
    "U3": ("784-1992-0000003-3", "Omar Saleh", None, "o@x.ae", "0503333333"),
}


def report(emirates, name, dob):
    born = f"<DateOfBirth>{dob}</DateOfBirth>" if dob else ""
    return (f'<Report reportId="R" generatedAt="2001-06-20T00:00:00Z"><Subject><EmiratesId>{emirates}</EmiratesId>'
            f"<FullName>{name}</FullName>{born}</Subject><Score><value>700</value><band>GOOD</band></Score>"
            "<Accounts><totalOutstanding>10.50</totalOutstanding></Accounts><Defaults><count>0</count></Defaults>"
            "<Inquiries><last6Months>1</last6Months></Inquiries></Report>")


def land(spark, root, source, table, rows):
    df = spark.createDataFrame(
        [(f"{source}-{a or u}", a, u, DAY, DAY, raw) for a, u, raw in rows],
        "source_event_id STRING, application_id STRING, internal_uuid STRING, received_at TIMESTAMP, source_generated_at TIMESTAMP, raw_payload STRING",
    )
    write_partitioned(conform(bronze_envelope(df, source), table), root, table)


def test_bronze_to_gold(spark, tmp_path):
    root = str(tmp_path / "lake")
    fields = ("emirates_id", "full_name", "dob", "email", "phone")
    land(spark, root, "internal", "bronze.internal_profile", [(None, u, json.dumps(dict(zip(fields, p)))) for u, p in PEOPLE.items()])
    land(spark, root, "aecb", "bronze.aecb", [(f"A{u}", u, report(*p[:3])) for u, p in PEOPLE.items()])
    land(spark, root, "fraud", "bronze.fraud", [
        (f"A{u}", u, json.dumps({"phone": p[4], "email": p[3].upper(), "fraud_score": 5, "risk_band": "LOW"})) for u, p in PEOPLE.items()])
    land(spark, root, "aml", "bronze.aml", [
        (f"A{u}", u, json.dumps({"full_name": p[1], "dob": p[2], "status": "CLEAR", "pep_flag": False})) for u, p in PEOPLE.items() if u != "U2"])
    spark.range(1).write.parquet(table_path(root, "unrelated.table"))

    for _ in range(2):  # a rerun of the day replaces it
        silver_run.run_silver(spark, root, AS_OF)
        counts = gold_run.run_gold(spark, root, AS_OF).first()
    silver = {r.application_id: r for r in read_table(spark, root, "silver.lending_application_request").collect()}
    assert sorted(silver) == ["AU1", "AU2", "AU3"]
    assert silver["AU2"].pending_sources == ["aml"] and silver["AU1"].pending_sources == []
    assert silver["AU1"].aml_match_decision == "AUTO_MATCH"
    assert silver["AU3"].aml_match_decision == "NO_MATCH"  # no date of birth on either side
    gold = read_table(spark, root, "gold.lending_application_request").collect()
    assert [(r.application_id, float(r.total_outstanding), r.dq_status) for r in gold] == [("AU1", 10.5, "PASS")]
    assert tuple(counts) == (3, 2)
    assert read_table(spark, root, "silver.match_audit").count() == 8
    scored = read_table(spark, root, "gold.dq_scorecard").groupBy("source_system").count().collect()
    assert {r[0]: r[1] for r in scored} == {"internal": 9, "aecb": 3, "fraud": 3, "aml": 3}
    assert serving_latest(spark, table_path(root, "serving.decision_input")).count() == 1

    # Next day: nothing new landed, so nothing is conformed a second time.
    silver_run.run_silver(spark, root, "2001-07-01")
    assert read_table(spark, root, "silver.aecb_conformed").count() == 3


def test_reporting_date(spark, tmp_path, sf_dir):
    root = str(tmp_path / "lake")
    v = lambda name: view(spark, sf_dir, name)
    from loanloom.operators.mart import fact_loan_performance

    write_partitioned(fact_loan_performance(v("servicing")), root, "mart.fact_loan_performance")
    write_partitioned(v("pit"), root, "ecl.risk_parameters_pit")
    scenarios = v("macro_scenario").withColumn("batch_date", F.col("reporting_date"))
    write_partitioned(scenarios, root, "ecl.macro_scenario")
    conform(v("risk_signals"), "ecl.credit_risk_signals").write.parquet(table_path(root, "ecl.credit_risk_signals"))
    conform(v("loan_terms"), "mart.dim_loan_terms").write.parquet(table_path(root, "mart.dim_loan_terms"))

    for _ in range(2):
        ecl_run.run_stages(spark, root, AS_OF, v("stage_overrides"), v("stage_rebuttals"))
        gaps = ecl_run.run_provisions(spark, root, AS_OF, v("overlays"))
    history = read_layer(spark, root, "ecl.exposure_stage_history", AS_OF)
    active = read_table(spark, root, "mart.fact_loan_performance").filter(
        (F.col("snapshot_date") == F.lit(AS_OF).cast("date")) & (F.col("status") == "ACTIVE"))
    assert history.count() == active.count() == history.select("loan_id").distinct().count()
    assert gaps.count() == 0
    calculation = read_layer(spark, root, "ecl.ecl_calculation", AS_OF)
    assert calculation.count() == 4 * history.count()
    rollup = ecl_run.report_rollup(spark, root, AS_OF)
    booked = calculation.filter("is_probability_weighted_result").agg(F.sum("ecl_present_value")).first()[0]
    assert rollup.agg(F.sum("total_ecl_provision"), F.sum("loan_count")).first() == (booked, history.count())
    detail = read_layer(spark, root, "ecl.ecl_lifetime_period_detail", AS_OF)
    assert detail.join(calculation, "ecl_calculation_id", "left_anti").count() == 0


def gold_rows(spark, rows):
    fields = "application_id STRING, aecb_score INT, dq_status STRING, assembled_at TIMESTAMP, batch_date DATE"
    df = spark.createDataFrame([(a, s, "PASS", DAY, dt.date.fromisoformat(d)) for a, s, d in rows], fields)
    return conform(df, "gold.lending_application_request")


def serving(spark, root):
    rows = serving_latest(spark, table_path(root, "serving.decision_input")).collect()
    return {r.application_id: r.aecb_score for r in rows}


def test_serving_copy_keeps_other_days_and_follows_reruns(spark, tmp_path):
    root, table = str(tmp_path / "lake"), "gold.lending_application_request"
    write_partitioned(gold_rows(spark, [("A1", 1, "2001-06-30"), ("A2", 2, "2001-06-30")]), root, table)
    gold_run.refresh_serving(spark, root, "2001-06-30")
    day = "2001-07-01"
    write_partitioned(gold_rows(spark, [("A2", 20, day), ("A3", 30, day)]), root, table, mode="replay", as_of=day)
    gold_run.refresh_serving(spark, root, day)
    assert serving(spark, root) == {"A1": 1, "A2": 20, "A3": 30}
    # A rerun in which all of the day is blocked: no row of it stays, earlier answers come back.
    write_partitioned(gold_rows(spark, []), root, table, mode="replay", as_of=day)
    assert read_layer(spark, root, table, day).count() == 0
    gold_run.refresh_serving(spark, root, day)
    assert serving(spark, root) == {"A1": 1, "A2": 2}


def test_serving_copy_refuses_another_bucket_count(spark, tmp_path):
    import pytest

    from loanloom.streaming.serving import merge_latest

    path = str(tmp_path / "copy")
    rows = spark.createDataFrame([("A", 1)], "k STRING, t INT")
    merge_latest(rows, path, ["k"], ["t"], buckets=4)
    with pytest.raises(ValueError, match="4 buckets"):
        merge_latest(rows, path, ["k"], ["t"], buckets=8)


def test_late_verdict_keeps_earlier_facts(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_partitioned(gold_rows(spark, [("A1", 1, "2001-06-30"), ("A2", 2, "2001-06-30")]), root, "gold.lending_application_request")
    spark.createDataFrame([("A1", "bnpl"), ("A2", "bnpl")], "application_id STRING, product_type STRING").write.parquet(
        table_path(root, "mart.dim_product"))
    for a, day in (("A1", "2001-06-30"), ("A2", "2001-07-01")):  # both decided on the same day, loaded on two
        verdict = spark.createDataFrame([(a, "APPROVED", DAY, dt.date.fromisoformat(day))],
                                        "application_id STRING, decision_outcome STRING, decided_at TIMESTAMP, batch_date DATE")
        write_partitioned(conform(verdict, "gold.lending_application_response"), root, "gold.lending_application_response")
        for _ in range(2):
            gold_run.run_decisions(spark, root, day)
    facts = read_table(spark, root, "gold.lending_applications").collect()
    assert sorted(r.application_id for r in facts) == ["A1", "A2"]


def test_rerun_takes_no_later_rows(spark, tmp_path):
    root = str(tmp_path / "lake")
    for u, day in (("U1", 30), ("U2", 31)):
        rows = spark.createDataFrame([(f"e-{u}", f"A{u}", u, DAY + dt.timedelta(days=day - 30), DAY, report(*PEOPLE[u][:3]))],
            "source_event_id STRING, application_id STRING, internal_uuid STRING, received_at TIMESTAMP, source_generated_at TIMESTAMP, raw_payload STRING")
        write_partitioned(conform(bronze_envelope(rows, "aecb"), "bronze.aecb"), root, "bronze.aecb")
    taken = silver_run.newly_landed(spark, root, "aecb", AS_OF)
    assert [r.internal_uuid for r in taken.collect()] == ["U1"]


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from loanloom.session import scratch_path

    class Nothing:
        def isDefined(self):
            return False

    class Context:
        master = "spark://somewhere:7077"
        _jsc = type("J", (), {"sc": lambda self: type("S", (), {"getCheckpointDir": lambda self: Nothing()})()})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": lambda self, key, default=None: default})()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(), "x")
