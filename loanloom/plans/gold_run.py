"""The daily run from the Silver request table to Gold."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.alerts import advance_alerts, batch_metrics, of_source
from loanloom.operators.gold import (
    build_lending_applications,
    decision_input_of,
    decision_snapshot,
    write_decision_response,
)
from loanloom.operators.keys import latest_per_key
from loanloom.operators.rules import blocked_count, evaluate_must_pass
from loanloom.operators.scorecard import build_dq_scorecard, must_pass_rows, warning_rows
from loanloom.operators.warnings import (
    warn_bureau_arrival_lag,
    warn_fraud_score_drift_psi,
    warn_manual_review_queue_age,
)
from loanloom.sizing import small_side
from loanloom.sources.layers import (
    export_feature_snapshot,
    has_table,
    merge_partitioned,
    on_day,
    read_layer,
    read_table,
    table_path,
    write_partitioned,
)
from loanloom.sources.runs import RunTable
from loanloom.streaming.serving import merge_latest, serving_latest

REQUIRED = ("internal_uuid", "emirates_id", "dob", "aecb_score", "fraud_score", "aml_status")
VENDOR_REQUIRED = {
    "aecb": ("application_id", "internal_uuid", "emirates_id", "aecb_score", "aecb_report_date"),
    "fraud": ("application_id", "internal_uuid", "phone_normalized", "email_normalized", "fraud_score"),
    "aml": ("application_id", "internal_uuid", "returned_name", "aml_status"),
}
#: Days before the run whose fraud scores the day's are compared with.
BASELINE_DAYS = 90


def run_gold(spark: SparkSession, root: str, as_of: str, now: str | None = None) -> DataFrame:
    """Gate the day's applications, score the batch, raise alerts, and feed the serving copy.

    The gated batch is computed once and kept for its readers. ``now`` is the
    instant up to which the review queue has aged (else the clock's). Returns the
    one-row count of evaluated and blocked records.
    """
    silver = read_layer(spark, root, "silver.lending_application_request", as_of)
    evaluated = evaluate_must_pass(silver, as_of).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        write_partitioned(
            decision_input_of(evaluated, as_of), root, "gold.lending_application_request", mode="replay", as_of=as_of
        )
        # A row per source and rule, kept for the scorecard and the alerts.
        metrics = day_metrics(spark, root, evaluated, as_of, now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            scorecard = build_dq_scorecard(
                must_pass_rows(evaluated, F.lit("internal")), warning_rows(metrics, None, as_of)
            )
            write_partitioned(scorecard, root, "gold.dq_scorecard", mode="replay", as_of=as_of)
            refresh_alerts(spark, root, metrics, as_of)
        finally:
            metrics.unpersist()
        counts = blocked_count(evaluated).first()
    finally:
        evaluated.unpersist()
    refresh_serving(spark, root, as_of)
    return spark.createDataFrame([counts])


def day_metrics(spark: SparkSession, root: str, evaluated: DataFrame, as_of: str, now: str | None = None) -> DataFrame:
    """All warning metrics of the day, each under the source it speaks of.

    Each vendor's conformed partition is read once for its completeness and
    duplicates. Lags run from the bureau request that was last before the answer;
    the review queue holds what no verdict has settled yet.
    """
    day = F.lit(as_of).cast("date")
    metrics = batch_metrics(evaluated, "internal", REQUIRED)
    for source, required in VENDOR_REQUIRED.items():
        metrics = metrics.unionByName(batch_metrics(read_layer(spark, root, f"silver.{source}_conformed", as_of), source, required))

    scores = read_table(spark, root, "silver.fraud_conformed").filter(F.col("batch_date").between(F.date_sub(day, BASELINE_DAYS), day))
    drift = warn_fraud_score_drift_psi(scores.select("fraud_score", (F.col("batch_date") < day).alias("is_baseline")))

    answers = read_layer(spark, root, "silver.aecb_conformed", as_of).select("bronze_id", "application_id", "aecb_received_at")
    asked = read_table(spark, root, "bronze.aecb_request_log").select("application_id", "requested_at")
    asked = asked.join(small_side(answers.select("application_id").distinct()), "application_id", "left_semi")
    lagged = (
        answers.join(asked, "application_id")
        .filter(F.col("requested_at") <= F.col("aecb_received_at"))
        .groupBy("bronze_id")
        .agg(F.max("requested_at").alias("requested_at"), F.max("aecb_received_at").alias("aecb_received_at"))
    )
    lag = warn_bureau_arrival_lag(lagged, "requested_at", "aecb_received_at")

    waiting = read_table(spark, root, "silver.match_audit").filter(
        (F.col("batch_date") <= day) & (F.col("match_decision") == "MANUAL_REVIEW")
    )
    settled = read_table(spark, root, "gold.lending_application_response").filter(F.col("batch_date") <= day)
    waiting = waiting.select("application_id", "evaluated_at").join(settled.select("application_id"), "application_id", "left_anti")
    age = warn_manual_review_queue_age(waiting, now or _clock(spark), "evaluated_at")
    for source, rows in (("fraud", drift), ("aecb", lag), ("aml", age)):
        metrics = metrics.unionByName(of_source(rows, source))
    return metrics


def _clock(spark: SparkSession) -> str:
    return spark.range(1).select(F.current_timestamp().cast("string")).first()[0]


def refresh_alerts(spark: SparkSession, root: str, metrics: DataFrame, as_of: str) -> None:
    """Write the day's alert rows, from those of the last earlier day that had any.

    An open alert has a row on every day, so that one partition is all that is
    read. After a replay of an earlier day the later ones are to be replayed too.
    """
    held = read_table(spark, root, "gold.dq_alert").filter(F.col("batch_date") < F.lit(as_of).cast("date"))
    last = held.agg(F.max("batch_date")).first()[0]
    rows = advance_alerts(held.filter(F.col("batch_date") == F.lit(last)), metrics, as_of)
    write_partitioned(rows, root, "gold.dq_alert", mode="replay", as_of=as_of)


def refresh_serving(spark: SparkSession, root: str, as_of: str) -> None:
    """Bring the serving copy up to the day's decidable applications.

    Applications of other days stay. One that an earlier run of the same day had
    passed and this one blocks goes back to its latest earlier row, or out.
    """
    path, keys, order = table_path(root, "serving.decision_input"), ["application_id"], ["batch_date", "assembled_at"]
    gold = read_table(spark, root, "gold.lending_application_request")
    fresh = export_feature_snapshot(on_day(gold, as_of))
    withdrawn = None
    if has_table(spark, root, "serving.decision_input"):
        served = on_day(serving_latest(spark, path), as_of)
        withdrawn = served.select(*keys).join(fresh.select(*keys), keys, "left_anti").persist(StorageLevel.MEMORY_AND_DISK)
        if withdrawn.isEmpty():  # the usual day: no earlier Gold is read
            withdrawn = None
        else:
            earlier = gold.filter(F.col("batch_date") < F.lit(as_of).cast("date")).join(withdrawn, keys, "left_semi")
            fresh = fresh.unionByName(export_feature_snapshot(earlier))
    merge_latest(fresh, path, keys, order, withdrawn=withdrawn)


def run_responses(spark: SparkSession, root: str, as_of: str, decisions: DataFrame) -> None:
    """Take the day's verdicts, the first of each application, and freeze what they were made on.

    A key index says on which day each application was decided, so a day's batch
    reads the buckets of its own applications and none of the history. Keys are
    noted before rows are written: a run that died in between is completed, and a
    rerun replaces its day, by running it again. Verdicts that the rerun no longer
    has are open again.
    """
    table, day = "gold.lending_application_response", F.lit(as_of).cast("date")
    index = _decided(spark, root)
    rows = write_decision_response(
        decisions.withColumn("batch_date", day), read_table(spark, root, table).limit(0)
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        known = index.read(rows)
        fresh = rows.join(known.filter(F.col("batch_date") != day), "application_id", "left_anti").select(*rows.columns)
        unnoted = fresh.select("application_id", "batch_date").join(known, "application_id", "left_anti")
        withdrawn = read_layer(spark, root, table, as_of).join(fresh, "application_id", "left_anti")
        index.append(unnoted, removed=withdrawn)
        write_partitioned(fresh, root, table, mode="replay", as_of=as_of)
    finally:
        rows.unpersist()
    verdicts = read_layer(spark, root, table, as_of)
    snapshot = decision_snapshot(_decided_on(spark, root, verdicts.select("application_id"), as_of), verdicts)
    write_partitioned(snapshot, root, "gold.decision_snapshot", mode="replay", as_of=as_of)


def _decided(spark: SparkSession, root: str) -> RunTable:
    """The index of decided applications; where verdicts came first, it is filled from them once."""
    table = "gold.lending_application_response"
    index = RunTable(spark, f"{table_path(root, table)}_keys")
    if index.manifest() is None:
        held = read_table(spark, root, table).groupBy("application_id").agg(F.min("batch_date").alias("batch_date"))
        index.create(held.schema, ["application_id"])
        if has_table(spark, root, table):
            index.append(held)
    return index


def _decided_on(spark: SparkSession, root: str, ids: DataFrame, as_of: str) -> DataFrame:
    """The inputs that the given applications last had on a day.

    The serving copy holds them by key, unless an application was assembled again
    later; only for those is earlier Gold read.
    """
    day = F.lit(as_of).cast("date")
    gold = read_table(spark, root, "gold.lending_application_request")
    found = gold.limit(0)
    if has_table(spark, root, "serving.decision_input"):
        served = RunTable(spark, table_path(root, "serving.decision_input")).read(ids)
        found = served.join(ids, "application_id", "left_semi").filter(F.col("batch_date") <= day).select(*gold.columns)
    other = ids.join(found, "application_id", "left_anti")
    if other.isEmpty():
        return found
    earlier = gold.filter(F.col("batch_date") <= day).join(small_side(other), "application_id", "left_semi")
    return found.unionByName(latest_per_key(earlier, ["application_id"], ["batch_date", "assembled_at"]))


def run_decisions(spark: SparkSession, root: str, as_of: str) -> None:
    """Join the day's verdicts to their inputs, beside the facts of other days."""
    facts = build_lending_applications(
        read_table(spark, root, "gold.lending_application_request"),
        read_table(spark, root, "gold.lending_application_response"),
        spark.read.parquet(table_path(root, "mart.dim_product")),
        as_of,
    )
    merge_partitioned(facts, root, "gold.lending_applications", ["application_id"])
