import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loanloom.functions.similarity import jaro_winkler_array
from loanloom.functions.text import normalize_email, normalize_phone
from loanloom.operators import identity

AS_OF = "2001-06-30"
BIRTH = dt.date(1990, 3, 15)


def similarity(a, b):
    return jaro_winkler_array(pd.Series([a], dtype=object), pd.Series([b], dtype=object))[0]


def brute_jaro_winkler(a, b):
    """The published definition, one pair at a time."""
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    taken, hits = set(), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if j not in taken and b[j] == ch:
                taken.add(j)
                hits.append(ch)
                break
    if not hits:
        return 0.0
    other = [b[j] for j in sorted(taken)]
    halves = sum(x != y for x, y in zip(hits, other)) // 2
    m = len(hits)
    jaro = (m / len(a) + m / len(b) + (m - halves) / m) / 3
    prefix = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * 0.1 * (1 - jaro) if jaro > 0.7 else jaro


def test_known_pair():
    assert similarity("ahmed al mansoori", "ahmed al mansouri") == pytest.approx(0.97647, abs=1e-5)


def test_null_and_empty():
    assert pd.isna(similarity(None, "a"))
    assert similarity("", "") == 0.0
    assert similarity("", "a") == 0.0
    assert similarity("same", "same") == 1.0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("abcdeé 𝄞", max_size=14), st.text("abcdeé 𝄞", max_size=14)), min_size=1, max_size=20))
def test_batch_equals_one_at_a_time(pairs):
    left, right = zip(*pairs)
    got = jaro_winkler_array(pd.Series(left, dtype=object), pd.Series(right, dtype=object))
    for (a, b), value in zip(pairs, got):
        assert value == pytest.approx(brute_jaro_winkler(a, b), abs=1e-12)


def test_agrees_with_duckdb_on_mixed_lengths():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh ") for _ in range(rng.choice([1, 3, 12, 40, 300]))) for _ in range(400)]
    pairs = [(rng.choice(words), rng.choice(words)) for _ in range(600)]
    frame = pd.DataFrame(pairs, columns=["a", "b"])
    expected = duckdb.sql("SELECT jaro_winkler_similarity(a, b) AS s FROM frame").df()["s"]
    got = jaro_winkler_array(frame["a"], frame["b"])
    assert (got - expected).abs().max() < 1e-9


def test_phone_forms(spark):
    forms = ["+971501234567", "0501234567", "501234567", "971 50 123 4567", " (050) 123-4567 "]
    df = spark.createDataFrame([(f,) for f in forms] + [(None,)], "p STRING")
    got = [r[0] for r in df.select(normalize_phone(F.col("p"))).collect()]
    assert got == ["+971501234567"] * 5 + [None]


def test_email(spark):
    df = spark.createDataFrame([("\t A@B.ae \n",), (None,)], "e STRING")
    assert [r[0] for r in df.select(normalize_email(F.col("e"))).collect()] == ["a@b.ae", None]


def joined(spark, rows):
    return spark.createDataFrame(
        rows,
        "application_id STRING, internal_uuid STRING, bronze_id STRING, emirates_id STRING, phone STRING, email STRING, "
        "returned_name STRING, returned_dob DATE, profile_emirates_id STRING, profile_phone STRING, "
        "profile_email STRING, profile_full_name STRING, profile_dob DATE",
    )


WORKED = ("A1", "U1", "B1", "784-1990-1234567-8", "0501234567", " AHMED@email.ae", "Ahmed Al Mansouri", BIRTH,
          "784-1990-1234567-8", "+971501234567", "ahmed@email.ae", "Ahmed Al Mansoori", BIRTH)


def test_worked_example(spark):
    frame = joined(spark, [WORKED])
    assert identity.audit_aecb(frame, AS_OF).first().match_decision == "AUTO_MATCH"
    assert identity.audit_fraud(frame, AS_OF).first().match_decision == "AUTO_MATCH"
    row = identity.audit_aml(frame, AS_OF).first()
    assert (float(row.match_score), row.match_decision, row.exception_reason) == (0.986, "AUTO_MATCH", None)
    assert row.submitted_identifier == "Ahmed Al Mansoori|1990-03-15"


def test_missing_values_never_match(spark):
    missing = ("A1", "U1", "B1", None, None, "x", "Ahmed Al Mansoori", None, None, None, "x", "Ahmed Al Mansoori", None)
    frame = joined(spark, [missing])
    assert identity.audit_aecb(frame, AS_OF).first().match_decision == "MISMATCH"
    fraud = identity.audit_fraud(frame, AS_OF).first()
    assert (fraud.match_decision, fraud.exception_reason, fraud.returned_identifier) == ("MISMATCH", "cross_uuid_collision", "|x")
    aml = identity.audit_aml(frame, AS_OF).first()
    assert (float(aml.match_score), aml.match_decision) == (0.6, "NO_MATCH")
    assert aml.submitted_identifier == "Ahmed Al Mansoori|"


def test_decision_thresholds_on_unrounded_score(spark):
    scores = [0.92, 0.9199999, 0.8, 0.7999999, 0.79996, None]
    df = spark.createDataFrame([(s,) for s in scores], "s DOUBLE")
    rows = df.select(identity.aml_match_score(F.col("s")), identity.aml_match_decision(F.col("s"))).collect()
    assert [r[1] for r in rows] == ["AUTO_MATCH", "MANUAL_REVIEW", "MANUAL_REVIEW", "NO_MATCH", "NO_MATCH", "NO_MATCH"]
    assert float(rows[4][0]) == 0.8  # rounds up, yet stays NO_MATCH


def test_decision_only_equals_decision_of_score(spark):
    rng = random.Random(3)
    names = ["Ahmed Al Mansoori", "Ahmad Mansouri", "Zed", "", None, "Mohammed", "Muhammad"]
    dobs = [BIRTH, dt.date(1991, 1, 1), None]
    rows = [tuple(rng.choice(x) for x in (names, dobs, names, dobs)) for _ in range(300)]
    df = spark.createDataFrame(rows, "n1 STRING, d1 DATE, n2 STRING, d2 DATE")
    args = [F.col(c) for c in ("n1", "d1", "n2", "d2")]
    both = df.select(
        identity.aml_decision_only(*args).alias("a"), identity.aml_match_decision(identity.aml_raw_score(*args)).alias("b")
    )
    assert both.filter("a <> b").count() == 0


def test_collision_lists_each_response_once(spark):
    profile = spark.createDataFrame(
        [(f"U{i}", "e", "n", BIRTH, f"m{i}@x", "050" if i < 4 else f"05{i}") for i in range(6)],
        "internal_uuid STRING, emirates_id STRING, full_name STRING, dob DATE, email STRING, phone STRING",
    )
    fraud = spark.createDataFrame(
        [("A0", "U0", "050", "m0@x"), ("A5", "U5", "050", "M1@X "), ("A4", "U4", "054", "m4@x"), ("A9", "U9", None, "m2@x")],
        "application_id STRING, internal_uuid STRING, phone STRING, email STRING",
    )
    rows = {
        (r.application_id, r.matched_on): (r.other_internal_uuid, r.other_owner_count)
        for r in identity.cross_uuid_collision(fraud, profile).collect()
    }
    assert rows == {
        ("A0", "phone"): ("U3", 3), ("A5", "phone"): ("U0", 4), ("A5", "email"): ("U1", 1), ("A9", "email"): ("U2", 1),
    }
