"""Tables of runs and the key ledger: merging, compaction, replays, what is read and written."""

import os
import random

import pytest
from pyspark.sql import functions as F

from loanloom.schemas import TABLES, conform
from loanloom.sources import ledger as ledger_module
from loanloom.sources.landing import IDEMPOTENCY, bronze_envelope
from loanloom.sources.layers import read_table, table_path, write_partitioned
from loanloom.sources.runs import FANOUT, RunTable
from loanloom.streaming import serving

SCHEMA = "k STRING, at INT, v STRING"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def table(spark, path, order=("at",), buckets=4):
    found = RunTable(spark, str(path))
    found.create(make(spark, []).schema, ["k"], order, buckets)
    return found


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.startswith("part-"))


def test_merging_equals_a_fold_of_all_rows(spark, tmp_path):
    rng, runs, want = random.Random(1), table(spark, tmp_path / "t"), {}
    clock = iter(rng.sample(range(100_000), 2000))
    for turn in range(2 * FANOUT + 3):
        batch = {}
        for _ in range(rng.randrange(0, 25)):
            key = rng.choice([None, *map(str, range(30))])
            row = (key, next(clock), f"v{turn}")
            if key not in batch or row[1] > batch[key][1]:
                batch[key] = row
        removed = None
        if turn % 5 == 4:
            gone = [str(k) for k in rng.sample(range(30), 4)]
            removed = make(spark, [(k, None, None) for k in gone])
            for k in gone:
                want.pop(k, None)
        runs.append(make(spark, list(batch.values())), removed)
        for key, row in batch.items():
            if key not in want or row[1] > want[key][1]:
                want[key] = row
        if turn % 4 == 3:
            assert rows_of(runs.read()) == sorted(want.values(), key=str)
    assert rows_of(runs.read()) == sorted(want.values(), key=str)
    some = make(spark, [("3", 0, ""), (None, 0, "")])
    found = {r[0]: r for r in rows_of(runs.read(some))}
    assert all(found.get(k) == want.get(k) for k in ("3", None))
    assert len(runs.manifest().runs) < 2 * FANOUT
    runs.compact(whole=True)
    assert len(runs.manifest().runs) == 1
    assert rows_of(runs.read()) == sorted(want.values(), key=str)


def test_a_later_removal_lets_an_earlier_row_back(spark, tmp_path):
    runs = table(spark, tmp_path / "t")
    runs.append(make(spark, [("a", 9, "new"), ("b", 1, "b")]))
    runs.append(make(spark, [("a", 3, "old")]), make(spark, [("a", 0, ""), ("b", 0, "")]))
    assert rows_of(runs.read()) == [("a", 3, "old")]
    for k in range(FANOUT):  # compaction keeps what was removed removed
        runs.append(make(spark, [("c", k, "c")]))
    assert rows_of(runs.read()) == [("a", 3, "old"), ("c", FANOUT - 1, "c")]


def test_empty_table_and_empty_batches(spark, tmp_path):
    runs = table(spark, tmp_path / "t")
    assert runs.read().count() == 0 and runs.read().columns == ["k", "at", "v"]
    runs.append(make(spark, []))
    assert runs.read().count() == 0
    with pytest.raises(ValueError):
        runs.create(make(spark, []).schema, ["k"], ["at"], 5)


def test_an_unpublished_run_is_not_read(spark, tmp_path):
    runs = table(spark, tmp_path / "t")
    runs.append(make(spark, [("a", 1, "a")]))
    runs._write(make(spark, [("b", 1, "b")]).withColumns({"__seq": F.lit(9).cast("long"), "__gone": F.lit(False)}), runs.manifest())
    assert rows_of(runs.read()) == [("a", 1, "a")]


def test_an_append_writes_its_own_rows_only(spark, tmp_path):
    path = str(tmp_path / "copy")
    big = spark.range(200_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    serving.merge_latest(big, path, ["k"], ["at"], 4)
    before = size_of(path)
    serving.merge_latest(make(spark, [("7", 2, "x")]), path, ["k"], ["at"], 4)
    assert size_of(path) - before < before / 100
    assert serving.serving_latest(spark, path).filter("k = '7'").collect() == [("7", 2, "x")]
    assert serving.serving_latest(spark, path).count() == 200_000
    plan = RunTable(spark, path).read(make(spark, [("7", 0, "")]))._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_the_large_run_is_compared_and_not_aggregated(spark, tmp_path, monkeypatch):
    from loanloom.sources import runs as module

    runs = table(spark, tmp_path / "t")
    for k in range(FANOUT + 2):
        runs.append(make(spark, [(str(k), 1, "a"), ("same", k, "b")]))
    assert sorted(r["level"] for r in runs.manifest().runs) == [0, 0, 1]
    folded = []
    monkeypatch.setattr(module, "latest_per_key", lambda df, keys, order: folded.append(df) or ls_latest(df, keys, order))
    from loanloom.operators.keys import latest_per_key as ls_latest

    assert runs.read().count() == FANOUT + 3
    assert [df.count() for df in folded] == [4]  # the two small runs


# --- the ledger -------------------------------------------------------------


def events(spark, ids, day="2001-06-30"):
    rows = spark.createDataFrame([(str(k),) for k in ids], "source_event_id STRING").selectExpr(
        "source_event_id", "'A' AS application_id", "'U' AS internal_uuid", f"TIMESTAMP '{day} 08:00:00' AS received_at",
        "TIMESTAMP '2001-06-01 00:00:00' AS source_generated_at", "concat('{\"n\":', source_event_id, '}') AS raw_payload")
    return conform(bronze_envelope(rows, "aml"), "bronze.aml")


def land(spark, root, ids, token, day="2001-06-30", write=None):
    write = write or (lambda rows: write_partitioned(rows, root, "bronze.aml"))
    ledger_module.land_once(spark, root, "bronze.aml", "aml", events(spark, ids, day), token, write)


def landed(spark, root):
    return sorted(int(r.source_event_id) for r in read_table(spark, root, "bronze.aml").select("source_event_id").collect())


def test_repeats_on_any_day_are_found_without_reading_bronze(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    land(spark, root, range(0, 20), "s-0")
    monkeypatch.setattr(ledger_module, "read_table", lambda *a: pytest.fail("Bronze was read"))
    land(spark, root, [*range(15, 25), 24], "s-1", "2001-07-09")
    land(spark, root, range(0, 25), "s-2", "2001-08-01")
    assert landed(spark, root) == list(range(25))


def test_whole_rows_are_shuffled_once_and_only_if_some_are_new(spark, tmp_path):
    root, plans = str(tmp_path), []

    def write(rows):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        write_partitioned(rows, root, "bronze.aml")

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        land(spark, root, range(20), "s-0", write=write)
        land(spark, root, range(20), "s-1", "2001-07-09", write=write)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plans[0].count("Exchange hashpartitioning") == 2, plans[0]  # the rows, and the ledger's keys
    assert "Exchange" not in plans[1], plans[1]
    assert landed(spark, root) == list(range(20))


def test_a_batch_that_died_after_its_keys_were_noted_is_written_on_replay(spark, tmp_path):
    root = str(tmp_path)
    land(spark, root, range(5), "s-0")

    def dies(rows):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        land(spark, root, range(3, 9), "s-1", write=dies)
    assert landed(spark, root) == list(range(5))
    land(spark, root, range(3, 9), "s-1")
    assert landed(spark, root) == list(range(9))
    for token in ("s-1", "s-0", "other-0"):  # and a replay of what was written adds nothing
        land(spark, root, range(3, 9) if token == "s-1" else range(5), token)
    assert landed(spark, root) == list(range(9))


def test_a_ledger_is_filled_from_bronze_that_came_first(spark, tmp_path):
    root = str(tmp_path)
    write_partitioned(events(spark, range(6)), root, "bronze.aml")
    land(spark, root, range(4, 8), "s-0", "2001-07-01")
    assert landed(spark, root) == list(range(8))
    assert os.path.exists(table_path(root, "bronze.aml") + "_ledger")
    assert IDEMPOTENCY["aml"][0] == ("event_key",) and "event_key" not in TABLES["bronze.aml"]


# --- merging by key over all partitions -------------------------------------


def facts(spark, rows):
    made = spark.createDataFrame(rows, "application_id STRING, product_type STRING, decision_date STRING, aecb_score INT")
    return conform(made.withColumn("decision_date", F.col("decision_date").cast("date")), "gold.lending_applications")


def test_a_row_that_moves_leaves_its_old_partition(spark, tmp_path):
    from loanloom.sources.layers import merge_partitioned

    root, table_ = str(tmp_path), "gold.lending_applications"
    read = lambda: sorted((r.application_id, str(r.decision_date), r.aecb_score) for r in read_table(spark, root, table_).collect())
    write_partitioned(facts(spark, [("A0", "card: x", "2001-06-29", 1)]), root, table_)  # before there was an index
    merge_partitioned(facts(spark, [("A1", "bnpl", "2001-06-30", 1), ("A2", "bnpl", "2001-06-30", 2)]), root, table_, ["application_id"])
    merge_partitioned(facts(spark, [("A1", "bnpl", "2001-07-01", 3)]), root, table_, ["application_id"])
    assert read() == [("A0", "2001-06-29", 1), ("A1", "2001-07-01", 3), ("A2", "2001-06-30", 2)]
    merge_partitioned(facts(spark, [("A0", "bnpl", "2001-07-01", 9)]), root, table_, ["application_id"])  # its partition is left empty
    merge_partitioned(facts(spark, []), root, table_, ["application_id"])
    assert read() == [("A0", "2001-07-01", 9), ("A1", "2001-07-01", 3), ("A2", "2001-06-30", 2)]
    for _ in range(2):
        merge_partitioned(facts(spark, [("A1", "bnpl", "2001-06-30", 4)]), root, table_, ["application_id"])
    assert read() == [("A0", "2001-07-01", 9), ("A1", "2001-06-30", 4), ("A2", "2001-06-30", 2)]


def test_an_empty_reporting_date_keeps_no_provisions(spark, tmp_path):
    root, table_ = str(tmp_path), "ecl.ecl_calculation"
    row = conform(spark.createDataFrame([("L1", "2001-06-30")], "loan_id STRING, day STRING").selectExpr(
        "loan_id", "CAST(day AS DATE) AS batch_date"), table_)
    write_partitioned(row, root, table_, mode="replay", as_of="2001-06-30")
    write_partitioned(row.filter("false"), root, table_, mode="replay", as_of="2001-06-30")
    assert read_table(spark, root, table_).count() == 0


# --- the current profile ----------------------------------------------------


def change(uuid, event, day, at, phone):
    return (uuid, event, f"{day} 08:00:00", f"{at} 00:00:00", '{"phone": "%s"}' % phone)


def log_changes(spark, root, rows):
    made = spark.createDataFrame(rows, "internal_uuid STRING, source_event_id STRING, r STRING, g STRING, raw_payload STRING").selectExpr(
        "internal_uuid", "source_event_id", "CAST(NULL AS STRING) AS application_id", "CAST(r AS TIMESTAMP) AS received_at",
        "CAST(g AS TIMESTAMP) AS source_generated_at", "raw_payload")
    write_partitioned(conform(bronze_envelope(made, "internal"), "bronze.internal_profile"), root, "bronze.internal_profile")


def test_profile_follows_the_log_by_its_new_days(spark, tmp_path, monkeypatch):
    from loanloom.sources import profile

    root = str(tmp_path)
    phones = lambda wanted=None: {r.internal_uuid: r.phone for r in profile.current_profile(spark, root, wanted).collect()}
    profile.refresh_profile(spark, root)  # before anything landed
    assert phones() == {}
    log_changes(spark, root, [change("U1", "1", "2001-06-01", "2001-06-01", "a"), change("U2", "2", "2001-06-01", "2001-06-01", "b")])
    for _ in range(2):
        profile.refresh_profile(spark, root)
        assert phones() == {"U1": "a", "U2": "b"}
    # a newer change, one that was generated before the held one, and a new customer
    log_changes(spark, root, [change("U1", "3", "2001-06-20", "2001-06-20", "c"), change("U2", "4", "2001-06-20", "2001-05-01", "old"),
                              change("U3", "5", "2001-06-20", "2001-06-20", "d")])
    log_changes(spark, root, [change("U3", "6", "2001-06-19", "2001-06-21", "late file")])
    seen = []
    monkeypatch.setattr(profile, "_images", lambda log, f=profile._images: seen.append(log) or f(log))
    profile.refresh_profile(spark, root)
    assert phones() == {"U1": "c", "U2": "b", "U3": "late file"}
    plan = seen[-1]._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in plan.split("PartitionFilters: [")[1].split("]")[0]  # no day before is read
    assert phones(spark.createDataFrame([("U3",)], "internal_uuid STRING"))["U3"] == "late file"
