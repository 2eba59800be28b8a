import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from loanloom.schemas import TABLES
from loanloom.sources.layers import read_table, table_path
from loanloom.streaming import landing_streams as ls
from loanloom.streaming import serving


def report(n, emirates, extra=""):
    subject = f"<Subject><EmiratesId>{emirates}</EmiratesId></Subject>" if emirates else "<Subject/>"
    return f'<Report reportId="R{n}" generatedAt="2001-06-01T10:00:00Z">{subject}{extra}</Report>'


@pytest.fixture
def dirs(tmp_path):
    for name in ("in", "root"):
        (tmp_path / name).mkdir()
    return tmp_path


def put(dirs, name, text, at="2001-06-30T08:00:00"):
    path = dirs / "in" / name
    path.write_text(text)
    stamp = dt.datetime.fromisoformat(at + "+00:00").timestamp()
    os.utime(path, (stamp, stamp))


def run(spark, dirs, source, stream, side=None, tag="c"):
    query = ls.stream_bronze(stream, source, str(dirs / "root"), str(dirs / f"checkpoint-{tag}"), side)
    query.awaitTermination()


def exceptions(spark, dirs):
    df = spark.read.parquet(table_path(str(dirs / "root"), "bronze.ingest_exceptions"))
    return sorted(r.exception_reason for r in df.collect())


def test_bureau_files(spark, dirs):
    log = [("784-1", "A0", "U1", dt.datetime(2001, 1, 1)), ("784-1", "A1", "U1", dt.datetime(2001, 6, 1)),
           ("784-2", "A2", "U2", dt.datetime(2001, 6, 1))]
    side = lambda s: s.createDataFrame(log, TABLES["bronze.aecb_request_log"])
    put(dirs, "one.xml", '<?xml version="1.0"?>\n' + report(1, "784-1"))
    put(dirs, "batch.xml", f"<Reports>{report(2, '784-2')}\n{report(3, '784-9')}</Reports>")
    put(dirs, "noid.xml", report(4, None))
    put(dirs, "broken.xml", "<Report reportId='5'><Subject>")
    source = str(dirs / "in")
    run(spark, dirs, "aecb", ls.bureau_files(spark, source), side)
    bronze = read_table(spark, str(dirs / "root"), "bronze.aecb")
    rows = {r.application_id: r for r in bronze.collect()}
    assert sorted(rows) == ["A1", "A2"]
    assert rows["A1"].raw_payload.startswith("<?xml") and rows["A1"].source_event_id == "R1"
    assert rows["A2"].raw_payload == report(2, "784-2")
    assert rows["A1"].source_generated_at == dt.datetime(2001, 6, 1, 10) and rows["A1"].ingest_date == dt.date(2001, 6, 30)
    assert exceptions(spark, dirs) == ["MALFORMED", "MALFORMED", "UNMATCHED"]

    # The same delivery again, once through a new checkpoint and once as a new file.
    put(dirs, "again.xml", '<?xml version="1.0"?>\n' + report(1, "784-1"), at="2001-06-30T09:00:00")
    run(spark, dirs, "aecb", ls.bureau_files(spark, source), side, tag="other")
    assert read_table(spark, str(dirs / "root"), "bronze.aecb").count() == 2
    assert len(exceptions(spark, dirs)) == 3


def callback(event, application, name="x"):
    return json.dumps({"event_id": event, "callback_reference": application, "callback_at": "2001-06-30T07:00:00", "full_name": name})


def test_aml_callbacks_are_kept_once_across_days(spark, dirs):
    side = lambda s: s.createDataFrame([("A1", "U1"), ("A2", "U2")], TABLES["bronze.application_context"])
    source = str(dirs / "in")
    put(dirs, "a.json", "\n".join([callback("E1", "A1"), callback("E1", "A1"), callback("E2", "A9"), "not json"]))
    run(spark, dirs, "aml", ls.message_lines(spark, source), side)
    put(dirs, "b.json", "\n".join([callback("E1", "A1"), callback("E3", "A2")]), at="2001-07-01T08:00:00")
    run(spark, dirs, "aml", ls.message_lines(spark, source), side)
    rows = read_table(spark, str(dirs / "root"), "bronze.aml").orderBy("source_event_id").collect()
    assert [(r.source_event_id, r.internal_uuid, str(r.ingest_date)) for r in rows] == [
        ("E1", "U1", "2001-06-30"), ("E3", "U2", "2001-07-01"),
    ]
    assert exceptions(spark, dirs) == ["CONTEXT_NOT_FOUND", "MALFORMED"]


def message(request, score, application="A1"):
    payload = {"fraud_score": score, "risk_band": "LOW"}
    if request:
        payload = {"request_id": request, "scored_at": "2001-06-30T07:30:00", **payload}
    return json.dumps({"application_id": application, "internal_uuid": "U1", "payload": payload, "captured_at": "2001-06-30T07:45:00"})


def test_fraud_messages_last_delivery_wins(spark, dirs):
    source = str(dirs / "in")
    put(dirs, "a.json", "\n".join([message("Q1", 10), message(None, 20), message("Q2", 5, "A2")]))
    run(spark, dirs, "fraud", ls.message_lines(spark, source))
    put(dirs, "b.json", message("Q1", 99), at="2001-06-30T09:00:00")
    run(spark, dirs, "fraud", ls.message_lines(spark, source))
    rows = read_table(spark, str(dirs / "root"), "bronze.fraud").collect()
    scores = sorted(json.loads(r.raw_payload)["fraud_score"] for r in rows)
    assert scores == [5, 20, 99]
    without_id = next(r for r in rows if json.loads(r.raw_payload)["fraud_score"] == 20)
    assert len(without_id.source_event_id) == 36
    assert without_id.source_generated_at == dt.datetime(2001, 6, 30, 7, 45)


def test_serving_copy_is_current_and_replay_safe(spark, dirs):
    path = str(dirs / "serving")
    make = lambda rows: spark.createDataFrame(rows, "application_id STRING, source_system STRING, received_at INT, bronze_id STRING")
    first = make([("A1", "aml", 1, "b1"), ("A1", "fraud", 1, "b2"), ("A2", "aml", 5, "b3")])
    second = make([("A1", "aml", 3, "b4"), ("A2", "aml", 2, "b5")])
    for batch in (first, second, second, first):
        serving.merge_latest(batch, path, ("application_id", "source_system"), ("received_at", "bronze_id"), buckets=4)
    rows = sorted((r.application_id, r.source_system, r.bronze_id) for r in serving.serving_latest(spark, path).collect())
    assert rows == [("A1", "aml", "b4"), ("A1", "fraud", "b2"), ("A2", "aml", "b3")]


def test_stream_dedupe_absorbs_repeats(spark, dirs):
    put(dirs, "a.json", "\n".join(json.dumps({"id": i % 5, "ts": f"2001-06-30T00:0{i % 5}:00"}) for i in range(20)))
    stream = spark.readStream.schema("id INT, ts TIMESTAMP").json(str(dirs / "in"))
    out = ls.stream_dedupe(stream, ["id"], "ts", "1 hour")
    query = (
        out.writeStream.format("parquet").option("path", str(dirs / "out"))
        .option("checkpointLocation", str(dirs / "ck")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.schema("id INT, ts TIMESTAMP").parquet(str(dirs / "out")).select(F.count_distinct("id"), F.count("id")).first() == (5, 5)


def test_no_text_is_lost_in_splitting(spark):
    from loanloom.sources.landing import explode_bureau_batch

    one, two = "<Report reportId='1'><a/></Report>", "<Report reportId='2'><a/></Report>"
    files = {
        "single": f"<?xml version='1.0'?>\n{one}",
        "wrapped": f"<Reports>{one}</Reports>",
        "batch": f"<Reports>{one}\n{two}</Reports>",
        "cut": f"<Reports>{one}{two}<Report reportId='3'><a/>",
        "none": "no report",
        "empty": "",
    }
    rows = spark.createDataFrame(list(files.items()), "file_path STRING, value STRING")
    got = {}
    for r in explode_bureau_batch(rows).orderBy("file_path", "report_position").collect():
        got.setdefault(r.file_path, []).append(r.value)
    assert got["single"] == [files["single"]] and got["wrapped"] == [one] and got["batch"] == [one, two]
    assert got["cut"][:2] == [one, two] and "reportId='3'" in got["cut"][2]
    assert got["none"] == ["no report"] and got["empty"] == [""]


def test_events_without_an_id_are_exceptions_or_stay_apart(spark):
    from loanloom.sources.landing import append_idempotent, split_unmatched
    from loanloom.streaming.landing_streams import attribute, parse_payloads

    lines = spark.createDataFrame([("not json",), ('{"x": 1}',), ("not json",)], "value STRING").selectExpr(
        "value", "TIMESTAMP '2001-06-30 00:00:00' AS arrived_at")
    for source in ("fraud", "internal"):
        landed, exceptions = attribute(parse_payloads(lines, source), source, None)
        assert landed.count() == 0
        assert sorted(r.raw_payload for r in exceptions.collect()) == ["not json", "not json", '{"x": 1}']
    calls = spark.createDataFrame(
        [(None, "A", "U", f"p{i}", f"h{i}", "2001-06-30") for i in (1, 2, 2)],
        "source_event_id STRING, application_id STRING, internal_uuid STRING, raw_payload STRING, content_hash STRING, ingest_date STRING",
    ).selectExpr("*", "TIMESTAMP '2001-06-30 00:00:00' AS received_at", "TIMESTAMP '2001-06-30 00:00:00' AS source_generated_at", "content_hash AS bronze_id")
    kept, exceptions = split_unmatched(calls, "CONTEXT_NOT_FOUND", "application_id")
    assert kept.count() == 0 and exceptions.count() == 3
    assert append_idempotent(calls, calls.limit(0), "aml").count() == 2  # the same content twice is one event
