"""The daily run from Bronze to the joined Silver request table."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators.assemble import assemble_application_request
from loanloom.operators.conform import (
    conform_bureau,
    conform_fraud,
    conform_scored_aml,
    parse_bureau,
    parse_fraud,
    score_aml,
)
from loanloom.operators.identity import audit_aecb, audit_aml, audit_fraud, join_profile, union_match_audit
from loanloom.sources.layers import incremental_slice, read_table, write_partitioned
from loanloom.sources.profile import current_profile, refresh_profile

VENDORS = ("aecb", "fraud", "aml")


def newly_landed(spark: SparkSession, root: str, source: str, as_of: str) -> DataFrame:
    """Bronze rows that no run before ``as_of`` has conformed.

    What the run of ``as_of`` itself wrote does not count, so a rerun of the day
    computes, and replaces, the same partition.
    """
    done = read_table(spark, root, f"silver.{source}_conformed").filter(
        F.col("batch_date") < F.lit(as_of).cast("date")
    )
    return incremental_slice(read_table(spark, root, f"bronze.{source}"), as_of, done)


def run_silver(spark: SparkSession, root: str, as_of: str) -> None:
    """Conform the newly landed rows, audit them, and assemble the day's applications."""
    refresh_profile(spark, root)
    # Read once for its five readers.
    profile = current_profile(spark, root).persist(StorageLevel.MEMORY_AND_DISK)
    landed = {source: newly_landed(spark, root, source, as_of) for source in VENDORS}
    # Name matching is the one costly step: its result serves two tables.
    scored = score_aml(landed["aml"], profile).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        conformed = {
            "aecb": conform_bureau(landed["aecb"], profile, as_of),
            "fraud": conform_fraud(landed["fraud"], profile, as_of),
            "aml": conform_scored_aml(scored, as_of),
        }
        for source, rows in conformed.items():
            write_partitioned(rows, root, f"silver.{source}_conformed", mode="replay", as_of=as_of)
        audit = union_match_audit(
            audit_aecb(join_profile(parse_bureau(landed["aecb"]), profile), as_of),
            audit_fraud(join_profile(parse_fraud(landed["fraud"]), profile), as_of),
            audit_aml(scored, as_of),
        )
        write_partitioned(audit, root, "silver.match_audit", mode="replay", as_of=as_of)
    finally:
        scored.unpersist()
        profile.unpersist()

    sides = [read_table(spark, root, f"silver.{source}_conformed") for source in VENDORS]
    request = assemble_application_request(*sides, as_of)
    write_partitioned(request, root, "silver.lending_application_request", mode="replay", as_of=as_of)
