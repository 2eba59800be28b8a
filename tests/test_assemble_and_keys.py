import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loanloom.operators import assemble, keys
from loanloom.operators.assemble import assemble_application_request

AS_OF = "2001-06-30"
DAYS = [dt.date(2001, 6, 29), dt.date(2001, 6, 30)]

BUREAU = ("application_id STRING, internal_uuid STRING, batch_date DATE, aecb_score INT, aecb_band STRING, "
          "total_outstanding DECIMAL(18,2), identity_validation_status STRING, emirates_id STRING, dob DATE, aecb_report_date TIMESTAMP")
FRAUD = ("application_id STRING, internal_uuid STRING, batch_date DATE, fraud_score INT, risk_band STRING, "
         "identity_validation_status STRING, fraud_scored_at TIMESTAMP")
AML = ("application_id STRING, internal_uuid STRING, batch_date DATE, match_score DECIMAL(4,3), aml_status STRING, "
       "pep_flag BOOLEAN, match_decision STRING, aml_screened_at TIMESTAMP")


def toy(rng, n, keys_, hot=0):
    rows = [(rng.choice(keys_), rng.choice(DAYS), i) for i in range(n)]
    return rows + [("HOT", rng.choice(DAYS), 1000 + i) for i in range(hot)]


def frames(spark, a, f, m):
    stamp = dt.datetime(2001, 6, 1)
    return (
        spark.createDataFrame([(k, "U", d, i, "B", None, "MATCH", "E", None, stamp) for k, d, i in a], BUREAU),
        spark.createDataFrame([(k, "U", d, i, "R", "MATCH", stamp) for k, d, i in f], FRAUD),
        spark.createDataFrame([(k, "U", d, None, f"S{i}", True, "AUTO_MATCH", stamp) for k, d, i in m], AML),
    )


PLAIN = f"""
    SELECT application_id, a.i AS aecb_score, f.i AS fraud_score, 'S' || m.i AS aml_status,
           concat_ws(',', CASE WHEN a.application_id IS NULL THEN 'aecb' END,
                     CASE WHEN f.application_id IS NULL THEN 'fraud' END,
                     CASE WHEN m.application_id IS NULL THEN 'aml' END) AS pending
    FROM pa a FULL OUTER JOIN pf f USING (application_id) FULL OUTER JOIN pm m USING (application_id)
    WHERE a.d = DATE '{AS_OF}' OR f.d = DATE '{AS_OF}' OR m.d = DATE '{AS_OF}'"""


@pytest.mark.parametrize("seed,hot", [(1, 0), (2, 0), (3, 0), (4, 40)])
def test_equals_plain_full_outer_join(spark, seed, hot):
    rng = random.Random(seed)
    names = [f"A{i}" for i in range(12)] + [None]
    a, f, m = (toy(rng, rng.randint(0, 14), names, h) for h in (hot, 3 if hot else 0, 1 if hot else 0))
    frame = lambda rows: pd.DataFrame(rows, columns=["application_id", "d", "i"]).astype({"application_id": object})
    con = duckdb.connect()
    for name, rows in (("pa", a), ("pf", f), ("pm", m)):
        con.execute(f"CREATE TABLE {name} (application_id VARCHAR, d DATE, i INTEGER)")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?, ?)", rows)
    expected = sorted(con.sql(PLAIN).fetchall(), key=repr)
    got = assemble_application_request(*frames(spark, a, f, m), AS_OF, hot_rows=5).select(
        "application_id", "aecb_score", "fraud_score", "aml_status", F.array_join("pending_sources", ",")
    )
    assert sorted([tuple(r) for r in got.collect()], key=repr) == expected


def test_counts_of_the_run_sort_and_join_nothing(spark, monkeypatch):
    """Of a run whose keys fit no broadcast only the vendors' rows are joined with them."""
    rng, found = random.Random(5), {}
    rows = [toy(rng, 30, [f"A{i}" for i in range(12)] + [None]) for _ in range(3)]
    for small in (True, False):
        monkeypatch.setattr(assemble, "fits_broadcast", lambda df: small, raising=False)
        monkeypatch.setattr(assemble, "small_side", F.broadcast if small else lambda df: df)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        try:
            got = assemble_application_request(*frames(spark, *rows), AS_OF).drop("assembled_at")
            plan = got._jdf.queryExecution().executedPlan().toString()
            found[small] = sorted(map(repr, got.collect()))
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        sorted_joins = sum("SortMergeJoin" in line and "LeftSemi" in line for line in plan.splitlines())
        assert sorted_joins == (0 if small else 3), plan
    assert found[True] == found[False] != []


def test_latest_and_first_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, None), ("b", 1, None)], "k STRING, t INT, v STRING")
    assert sorted(tuple(r) for r in keys.latest_per_key(df, ["k"], ["t"]).select("k", "t").collect()) == [("a", 3), ("b", 1)]
    assert keys.first_per_key(df, ["k"], ["t"]).filter("k = 'a'").first() == ("a", 1, "x")


def test_lookup_keeps_rows_without_a_key(spark):
    df = spark.createDataFrame([("a", "r1"), (None, "r2"), (None, "r2"), ("z", "r3")], "k STRING, raw STRING")
    side = spark.createDataFrame([("a", 1)], "k STRING, v INT")
    rows = keys.lookup(df, side, "k", ["raw"]).select("k", "raw", "v").collect()
    assert sorted(map(tuple, rows), key=repr) == sorted([("a", "r1", 1), (None, "r2", None), (None, "r2", None), ("z", "r3", None)], key=repr)


@pytest.fixture
def small_skew_limits(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot_rows(spark, n, share_of_three=3):
    """``n`` rows of which a third share one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % share_of_three == 0, "HOT").otherwise(F.concat(F.lit("A"), F.col("id").cast("string"))).alias("application_id"),
        F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )


def split_joins(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("skew=true")


def test_hot_key_takes_no_part_in_the_shuffle_join(spark):
    df = keys.with_duplicate_count(hot_rows(spark, 60000), "application_id", "n", hot_rows=1000)
    assert df.groupBy("n").count().orderBy("n").collect() == [(1, 40000), (20000, 20000)]
    nulls = hot_rows(spark, 3000).withColumn("application_id", F.nullif("application_id", F.lit("HOT")))
    counted = keys.with_duplicate_count(nulls, "application_id", "n", hot_rows=100)
    assert counted.groupBy("n").count().orderBy("n").collect() == [(1, 2000), (1000, 1000)]


def test_hot_key_is_split_in_a_lookup(spark, small_skew_limits):
    side = spark.createDataFrame([("HOT", 1), ("A1", 2)], "application_id STRING, v INT").groupBy("application_id").agg(F.max("v").alias("v"))
    df = keys.lookup(hot_rows(spark, 60000), side, "application_id", ["id"])
    assert split_joins(df) > 0
    assert df.groupBy("v").count().orderBy("v").collect() == [(None, 39999), (1, 20000), (2, 1)]


def test_hot_application_is_cut_into_slots(spark):
    stamp = F.lit("2001-06-01").cast("timestamp")
    day = F.lit(AS_OF).cast("date")
    bureau = hot_rows(spark, 6000).select(
        "application_id", F.lit("U").alias("internal_uuid"), day.alias("batch_date"), F.col("id").cast("int").alias("aecb_score"),
        F.col("filler").alias("aecb_band"), F.lit(None).cast("decimal(18,2)").alias("total_outstanding"),
        F.lit("MATCH").alias("identity_validation_status"), F.lit("E").alias("emirates_id"), day.alias("dob"),
        stamp.alias("aecb_report_date"),
    )
    _, fraud, aml = frames(spark, [], [("HOT", DAYS[1], i) for i in range(25)], [("A1", DAYS[0], 1)])
    df = assemble_application_request(bureau, fraud, aml, AS_OF, hot_rows=10)
    pending = {r[0]: r[1] for r in df.groupBy(F.array_join("pending_sources", ",")).count().collect()}
    assert pending == {"aml": 2000 * 25, "fraud,aml": 3999, "fraud": 1}
    pairs = df.filter("application_id = 'HOT'").select("aecb_score", "fraud_score").distinct().count()
    assert pairs == 2000 * 25
