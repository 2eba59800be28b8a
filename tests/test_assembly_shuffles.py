import datetime as dt

import pytest
from pyspark.sql import functions as F

from loanloom.operators import assemble

AS_OF = "2001-06-30"
EARLIER, TODAY = dt.date(2001, 6, 29), dt.date(2001, 6, 30)

BUREAU = ("application_id STRING, internal_uuid STRING, batch_date DATE, aecb_score INT, aecb_band STRING, "
          "total_outstanding DECIMAL(18,2), identity_validation_status STRING, emirates_id STRING, dob DATE, aecb_report_date TIMESTAMP")
FRAUD = ("application_id STRING, internal_uuid STRING, batch_date DATE, fraud_score INT, risk_band STRING, "
         "identity_validation_status STRING, fraud_scored_at TIMESTAMP")
AML = ("application_id STRING, internal_uuid STRING, batch_date DATE, match_score DECIMAL(4,3), aml_status STRING, "
       "pep_flag BOOLEAN, match_decision STRING, aml_screened_at TIMESTAMP")


def frames(spark, bureau, fraud, aml):
    stamp = dt.datetime(2001, 6, 1)
    return (
        spark.createDataFrame([(k, "U", d, i, "B", None, "MATCH", "E", None, stamp) for k, d, i in bureau], BUREAU),
        spark.createDataFrame([(k, "U", d, i, "R", "MATCH", stamp) for k, d, i in fraud], FRAUD),
        spark.createDataFrame([(k, "U", d, None, f"S{i}", True, "AUTO_MATCH", stamp) for k, d, i in aml], AML),
    )


@pytest.fixture
def beyond_broadcast(spark, monkeypatch):
    monkeypatch.setattr(assemble, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(assemble, "small_side", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_vendor_rows_are_shuffled_once(spark, beyond_broadcast):
    rows = [("A1", TODAY, 1), ("A2", EARLIER, 2), (None, TODAY, 3), (None, EARLIER, 4)]
    got = assemble.assemble_application_request(*frames(spark, rows, rows[1:], rows[:2]), AS_OF)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    # Either the applications' counts or, on id and slots, the rows and the applications themselves.
    assert not [line for line in exchanges if "coalesce(" in line or "isnull(" in line], plan
    found = sorted(map(repr, (tuple(r) for r in got.select("application_id", "aecb_score", "fraud_score", "aml_status").collect())))
    assert found == sorted(map(repr, [("A1", 1, None, "S1"), (None, 3, None, None), (None, None, 3, None)]))


@pytest.mark.parametrize("small", [True, False])
def test_empty_slots_of_a_hot_application_join_nothing(spark, monkeypatch, small):
    """Answers that repeat one row all lie in one slot; the others are empty."""
    monkeypatch.setattr(assemble, "fits_broadcast", lambda df: small)
    same, own = [("HOT", TODAY, 7)] * 12, [("HOT", EARLIER, i) for i in range(9)]
    old = [("OLD", EARLIER, i) for i in range(8)]
    got = assemble.assemble_application_request(*frames(spark, same + old, own + old, old), AS_OF, hot_rows=3)
    counts = got.groupBy("application_id", "aecb_score", "fraud_score", F.array_join("pending_sources", ",")).count().collect()
    assert sorted(tuple(r) for r in counts) == [("HOT", 7, i, "aml", 12) for i in range(9)]
